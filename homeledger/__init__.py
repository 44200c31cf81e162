"""homeledger — property-listing analytics on Spark.

Cleans listing tables, checks them with a declarative quality suite, keeps a
quarantine/review trail as tables, engineers features, trains and promotes
tree regressors with Spark ML, and scores batches of requests.  Every
operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; see ``plans.registry`` for the query catalogue.
"""

__version__ = "0.1.0"
