"""Commit log of a stored table: readers see whole published versions only.

A store is a folder of rows written in versions, ``data/version=…/<keys>``, and
of a log.  ``publish`` writes the rows of a version, counts and fingerprints
what it wrote per unit (the key columns: a stage and a snapshot, a report run, a
reviewed file) into ``manifest/version=…``, and last of all adds the version's
commit: one row in one file, which appears at once or not at all.  Readers start
at the commits.  A version without a commit (its job was killed) is invisible,
whatever files it left, and file times play no part.

Each unit is read from the newest committed version that holds it, so a repeated
or corrected publication replaces the unit's rows and leaves all others.  A
version name that is committed already is not written again, so a job started
once more under its own name adds nothing; one that was killed half-way starts
its version afresh.

Publications to one store are made one after another.  Where two jobs do publish
at the same time under one number, both are kept, and the version name that
sorts last wins the units that both hold.

The commit also names the rows' schema and format, so readers need neither; a
store whose newer versions have more columns reads as null where older ones lack
them.  The log grows with the units published, not with the rows.  It is written,
joined and filtered by Spark; the driver reads single rows of it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeledger.operators.quality import dataset_fingerprint
from homeledger.session import materialize

COMMIT_SCHEMA = "version string, number long, step string, format string, schema string, committed_at timestamp"
#: Names of the log's own columns, which no key can have (and no stored column the first).
LOG_COLUMNS = ("version", "number", "step", "format", "schema", "committed_at", "rows", "files", "fingerprint")


def _part(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(version, number, step, format, schema, committed_at) of every published version; none for a new store."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true").json(_part(path, "commits"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def _rows(spark: SparkSession, folder: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Stored rows; key values stay the text they are (``007`` is no number), broken JSON records are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").format(fmt).load(folder)


def publish(df: DataFrame, path: str, keys: list[str], version: str | None = None, step: str = "",
            fmt: str = "parquet") -> str:
    """Write ``df`` as one version of the store and commit it; returns the version's name.

    ``keys`` (text columns; the same ones for all versions of a store) name the
    unit of each row; a null or empty one raises, as such a unit has no folder.
    An empty ``df`` commits a version without units.  ``step`` is the job's name
    in the log.
    """
    spark = df.sparkSession
    taken = [c for c in df.columns if c == "version" or c in keys and c in LOG_COLUMNS]
    if taken:
        raise ValueError(f"columns with names of the log: {', '.join(taken)}")
    version = version or uuid.uuid4().hex
    log = commits(spark, path)
    if not log.where(F.col("version") == version).isEmpty():
        return version
    own = _part(path, f"data/version={version}")
    named = df.withColumns({k: F.when(F.col(k) != "", F.col(k)).otherwise(
        F.raise_error(F.lit(f"a row to publish has no {k}"))) for k in keys})
    # a version that was killed half-way starts afresh
    zipped = {"compression": "zstd"} if fmt == "parquet" else {}
    named.write.mode("overwrite").partitionBy(*keys).format(fmt).options(**zipped).save(own)
    # counted from the files, so the log says what readers will find
    stored = _rows(spark, own, df.schema, fmt)
    files = stored.groupBy(*keys).agg(F.count_distinct("_metadata.file_path").alias("files"))
    units = dataset_fingerprint(stored, keys).withColumnRenamed("row_count", "rows").join(files, keys)
    units.write.mode("overwrite").parquet(_part(path, f"manifest/version={version}"))
    number = (log.agg(F.max("number")).first()[0] or 0) + 1
    (spark.range(1).coalesce(1).select(
        F.lit(version).alias("version"), F.lit(number).alias("number"), F.lit(step).alias("step"), F.lit(fmt).alias("format"),
        F.lit(df.schema.json()).alias("schema"), F.current_timestamp().alias("committed_at"))
     .write.mode("overwrite").json(_part(path, f"commits/version={version}")))
    return version


def _newest(spark: SparkSession, path: str):
    """The newest commit's row; a store without one raises."""
    row = commits(spark, path).orderBy(F.desc("number"), F.desc("version")).first()
    if row is None:
        raise FileNotFoundError(f"nothing was published to {path}")
    return row


def history(spark: SparkSession, path: str) -> DataFrame:
    """(version, keys, rows, fingerprint, files, number, step, committed_at): every committed version of
    every unit, superseded ones included."""
    newest = _newest(spark, path)["version"]
    schema = spark.read.parquet(_part(path, f"manifest/version={newest}")).schema
    entries = (spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.StringType())]))
               .parquet(_part(path, "manifest")))
    # the manifests of versions that were not committed find no partner
    return entries.join(commits(spark, path).drop("format", "schema"), "version")


def manifest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The version of each unit that readers see, with its rows, files and fingerprint."""
    w = Window.partitionBy(*keys).orderBy(F.desc("number"), F.desc("version"))
    return history(spark, path).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def read(spark: SparkSession, path: str, keys: list[str], units: DataFrame | None = None,
         schema: T.StructType | None = None) -> DataFrame:
    """The published rows (of ``units`` alone, a table with the key columns), each unit from its newest version.

    The units are joined on version and keys, which are the folders of the rows,
    so Spark can prune the folders that no unit names.  ``schema`` (which holds the
    keys) replaces the newest commit's; a column that was not stored is null.
    """
    newest = _newest(spark, path)
    current = manifest(spark, path, keys).select("version", *keys)
    if units is not None:
        current = current.join(units.select(*keys).distinct(), keys, "left_semi")
    schema = schema or T.StructType.fromJson(json.loads(newest["schema"]))
    rows = _rows(spark, _part(path, "data"), T.StructType([*schema.fields, T.StructField("version", T.StringType())]),
                 newest["format"])
    # written, so its size is known: a log of few units is broadcast, and the rows are not dealt by unit
    current = materialize(current, "units")
    return rows.join(current, ["version", *keys], "left_semi").select(*schema.names)


def read_unit(spark: SparkSession, path: str, unit: dict[str, str]) -> DataFrame:
    """The published rows of one unit; only its newest version's folder is read, and an unknown unit raises."""
    cond = F.lit(True)
    for k, v in unit.items():
        cond = cond & (F.col(k) == v)
    row = manifest(spark, path, list(unit)).where(cond).select("version").first()
    if row is None:
        raise FileNotFoundError(f"{unit} was not published to {path}")
    newest = _newest(spark, path)
    schema = T.StructType.fromJson(json.loads(newest["schema"]))
    return _rows(spark, _part(path, f"data/version={row['version']}"), schema, newest["format"]).where(cond).select(
        *schema.names)


def newest_unit(spark: SparkSession, path: str, keys: list[str], **where: str) -> dict[str, str]:
    """The unit published last (in one version: the largest key values) among those with the given key values."""
    found = manifest(spark, path, keys)
    for k, v in where.items():
        found = found.where(F.col(k) == v)
    row = found.orderBy(F.desc("number"), F.desc("version"), *[F.desc(k) for k in keys]).select(*keys).first()
    if row is None:
        raise FileNotFoundError(f"nothing was published to {path} with {where}")
    return row.asDict()


def damaged(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Units whose rows are no longer those that were published: (keys, rows, found_rows)."""
    now = dataset_fingerprint(read(spark, path, keys), keys).select(
        *keys, F.col("row_count").alias("found_rows"), F.col("fingerprint").alias("__now"))
    return (manifest(spark, path, keys).join(now, keys, "left")
            .where(~F.col("fingerprint").eqNullSafe(F.col("__now")) | ~F.col("rows").eqNullSafe(F.col("found_rows")))
            .select(*keys, "rows", F.coalesce("found_rows", F.lit(0)).alias("found_rows")))
