"""Operators for large training-text pipelines (one module per operator).

The package is pickled by value, so Python workers need neither an installed
copy nor a shared ``PYTHONPATH``.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
