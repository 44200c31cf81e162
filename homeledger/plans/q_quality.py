"""Queries for quality and profiling: 7, 27-34, 37."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger.operators import clean as C
from homeledger.operators import quality as Q
from homeledger.plans.registry import register
from homeledger.plans.sqlbits import qlist, with_cleaned
from homeledger.schema import LISTING_COLUMNS
from homeledger.session import scratch_path
from homeledger.sources import commits, io
from homeledger.sources.fixture import listings

LISTING_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT",
                 "boolean": "BOOLEAN"}


def suite_sql(src: str, kinds: set[str] | None = None, by: str | None = None,
              columns: list[str] = LISTING_COLUMNS) -> str:
    """SQL twin of evaluate_suite over relation ``src`` (a CTE name); returns (ctes, body)."""
    aggs = ["count(*) AS rows_"]
    sels = []
    g = f"{by}, " if by else ""
    for i, e in enumerate(Q.default_suite()):
        if kinds and e.kind not in kinds:
            continue
        has = e.column in columns if e.column else False
        kw = e.kwargs_text().replace("'", "''")
        colv = f"'{e.column}'" if e.column else "CAST(NULL AS VARCHAR)"
        if e.kind == Q.ROW_COUNT:
            obs, ok = "CAST(rows_ AS DOUBLE)", f"rows_ >= {e.min_value}"
        elif e.kind == Q.COLUMN_COUNT:
            obs, ok = f"CAST({len(columns)} AS DOUBLE)", str(len(columns) >= e.min_value).upper()
        elif e.kind == Q.EXISTS:
            obs, ok = ("1.0", "TRUE") if has else ("0.0", "FALSE")
        elif not has:
            obs, ok = "CAST(NULL AS DOUBLE)", "FALSE"
        else:
            c = e.column
            if e.kind == Q.NOT_NULL:
                aggs.append(f"count({c}) AS a{i}")
                obs = f"CAST(a{i} AS DOUBLE) / NULLIF(CAST(rows_ AS DOUBLE), 0)"
            else:
                cond = (f"{c} >= {e.min_value} AND {c} <= {e.max_value}" if e.kind == Q.BETWEEN
                        else f"{c} IN ({qlist(e.value_set)})")
                aggs.append(f"count(*) FILTER (WHERE {cond}) AS a{i}, count({c}) AS b{i}")
                obs = f"CAST(a{i} AS DOUBLE) / NULLIF(CAST(b{i} AS DOUBLE), 0)"
            ok = f"COALESCE({obs} >= {e.mostly}, TRUE)"
        sels.append(f"SELECT {g}{i} AS ordinal, '{e.kind}' AS expectation, {colv} AS \"column\", "
                    f"'{kw}' AS kwargs, round({obs}, 6) AS observed, {ok} AS success FROM agg_{src}")
    grp = f" GROUP BY {by}" if by else ""
    ctes = f"agg_{src} AS (SELECT {g}{', '.join(aggs)} FROM {src}{grp})"
    return ctes, "\nUNION ALL\n".join(sels)


def _results_both(spark, sf, kinds=None):
    raw = listings(spark, sf)
    cleaned = C.clean_data(raw)
    suite = [e for e in Q.default_suite() if not kinds or e.kind in kinds]
    r1 = Q.evaluate_suite(raw, suite).withColumn("dataset", F.lit("raw"))
    r2 = Q.evaluate_suite(cleaned, suite).withColumn("dataset", F.lit("cleaned"))
    if kinds:  # keep suite ordinals stable when a subset is evaluated
        full = {e: i for i, e in enumerate(Q.default_suite())}
        m = F.create_map(*[x for i, e in enumerate(suite) for x in (F.lit(i), F.lit(full[e]))])
        r1 = r1.withColumn("ordinal", m[F.col("ordinal")])
        r2 = r2.withColumn("ordinal", m[F.col("ordinal")])
    return raw, cleaned, r1.unionByName(r2)


def _both_sql(kinds=None, wrap=lambda body: body):
    c1, b1 = suite_sql("listings", kinds)
    c2, b2 = suite_sql("cleaned", kinds)
    body = (f"SELECT *, 'raw' AS dataset FROM ({b1})\nUNION ALL\n"
            f"SELECT *, 'cleaned' AS dataset FROM ({b2})")
    return with_cleaned(c1, c2) + wrap(body)


def _kind_query(kinds):
    def q(spark, sf):
        return _results_both(spark, sf, kinds)[2]
    return q


register("expect_table_shape", lambda: _both_sql({Q.ROW_COUNT, Q.COLUMN_COUNT, Q.EXISTS}))(
    _kind_query({Q.ROW_COUNT, Q.COLUMN_COUNT, Q.EXISTS}))
register("expect_not_null", lambda: _both_sql({Q.NOT_NULL}))(_kind_query({Q.NOT_NULL}))
register("expect_between", lambda: _both_sql({Q.BETWEEN}))(_kind_query({Q.BETWEEN}))
register("expect_in_set", lambda: _both_sql({Q.IN_SET}))(_kind_query({Q.IN_SET}))


SUMMARY = ("SELECT dataset, CAST(count(*) AS INTEGER) AS evaluated, "
           "CAST(count(*) FILTER (WHERE success) AS INTEGER) AS passed, "
           "CAST(count(*) FILTER (WHERE NOT success) AS INTEGER) AS failed, "
           "count(*) FILTER (WHERE NOT success) = 0 AS success FROM ({}) GROUP BY dataset")


@register("validation_suite", lambda: _both_sql(wrap=SUMMARY.format))
def q_validation_suite(spark, sf):
    return Q.summarize_suite(_results_both(spark, sf)[2], ["dataset"])


@register("validation_failures", lambda: _both_sql(wrap=lambda b: f"SELECT * FROM ({b}) WHERE NOT success"))
def q_validation_failures(spark, sf):
    return Q.validation_failures(_results_both(spark, sf)[2])


def _pass_rate_sql():
    def wrap(b):
        return (f"SELECT s.dataset, round(passed / greatest(evaluated, 1), 4) AS pass_rate, evaluated, passed, "
                f"r.row_count, {len(LISTING_COLUMNS)} AS column_count FROM ({SUMMARY.format(b)}) s JOIN "
                "(SELECT 'raw' AS dataset, count(*) AS row_count FROM listings UNION ALL "
                "SELECT 'cleaned', count(*) FROM cleaned) r ON s.dataset = r.dataset")
    return _both_sql(wrap=wrap)


@register("dq_pass_rate", _pass_rate_sql)
def q_dq_pass_rate(spark, sf):
    raw, cleaned, res = _results_both(spark, sf)
    d = (raw.withColumn("dataset", F.lit("raw"))
         .unionByName(cleaned.withColumn("dataset", F.lit("cleaned"))))
    return Q.dq_pass_rate(d, res, ["dataset"])


def _route_sql():
    def wrap(b):
        return (f"SELECT dataset, success, CASE WHEN success THEN 'processed' ELSE 'errors' END AS route, "
                f"CASE WHEN success THEN 'validated_' ELSE 'quarantined_' END || 'Cincinnati_OH_365d_20250414_183022' "
                f"AS target_snapshot, CASE dataset WHEN 'raw' THEN (SELECT count(*) FROM listings) ELSE "
                f"(SELECT count(*) FROM cleaned) END AS rows FROM ({SUMMARY.format(b)})")
    return _both_sql(wrap=wrap)


@register("route_snapshot", _route_sql)
def q_route_snapshot(spark, sf):
    """#7: verdict -> route; the rows are written there and the place is read back."""
    raw, clean, res = _results_both(spark, sf)
    name = "Cincinnati_OH_365d_20250414_183022"
    v = Q.summarize_suite(res, ["dataset"])
    routed = io.route_verdict(v, F.lit(name))
    tables = {"raw": raw, "cleaned": clean}
    written = None
    for r in routed.collect():  # one verdict per dataset
        d, base = r["dataset"], scratch_path(spark, "routed")
        unit = io.route_snapshot(tables[d], r["success"], base, name)
        found = commits.read_unit(spark, base, unit).groupBy(
            F.col("stage").alias("route"), F.col("snapshot").alias("target_snapshot")).agg(F.count(F.lit(1)).alias("rows"))
        found = found.withColumns({"dataset": F.lit(d), "success": F.lit(r["success"])})
        written = found if written is None else written.unionByName(found)
    return written.select("dataset", "success", "route", "target_snapshot", "rows")


def _null_audit_sql():
    return with_cleaned() + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM listings "
        f"HAVING count(*) FILTER (WHERE {c} IS NULL) > 0" for c in LISTING_COLUMNS)


@register("final_null_audit", _null_audit_sql)
def q_final_null_audit(spark, sf):
    return Q.final_null_audit(listings(spark, sf))


def _schema_snapshot_sql():
    from homeledger.schema import LISTING_SCHEMA
    parts = []
    for i, f in enumerate(LISTING_SCHEMA.fields):
        parts.append(f"SELECT {i} AS position, '{f.name}' AS \"column\", "
                     f"CASE typeof(any_value({f.name})) " +
                     " ".join(f"WHEN '{d}' THEN '{s}'" for s, d in LISTING_TYPES.items()) +
                     f" END AS dtype, count(*) FILTER (WHERE {f.name} IS NULL) AS null_count, "
                     f"round(100.0 * count(*) FILTER (WHERE {f.name} IS NULL) / count(*), 2) AS null_pct, "
                     f"count(*) AS row_count, {len(LISTING_SCHEMA.fields)} AS column_count FROM listings")
    return with_cleaned() + "\nUNION ALL\n".join(parts)


@register("schema_snapshot", _schema_snapshot_sql)
def q_schema_snapshot(spark, sf):
    return Q.schema_snapshot(listings(spark, sf))


def fingerprint_sql(src: str, cols=LISTING_COLUMNS, doubles=None, by: str | None = None) -> str:
    from homeledger.schema import LISTING_SCHEMA
    types = {f.name: f.dataType.typeName() for f in LISTING_SCHEMA.fields}
    if doubles is not None:
        types.update({c: "double" for c in doubles})
    parts = []
    for c in cols:
        v = f"CAST({c} AS DECIMAL(38,6))" if types.get(c) == "double" else c
        parts.append(f"COALESCE(CAST({v} AS VARCHAR), chr(0))")
    text = "concat_ws(chr(1), " + ", ".join(parts) + ")"
    g, grp = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return (f"SELECT {g}count(*) AS row_count, CAST(CAST(sum(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT)) "
            f"AS DECIMAL(38,0)) AS VARCHAR) AS fingerprint FROM {src}{grp}")


@register("dataset_fingerprint", lambda: with_cleaned() +
          f"SELECT 'raw' AS dataset, * FROM ({fingerprint_sql('listings')}) UNION ALL "
          f"SELECT 'cleaned', * FROM ({fingerprint_sql('cleaned')})")
def q_dataset_fingerprint(spark, sf):
    raw = listings(spark, sf)
    return (Q.dataset_fingerprint(raw).select(F.lit("raw").alias("dataset"), "*")
            .unionByName(Q.dataset_fingerprint(C.clean_data(raw)).select(F.lit("cleaned").alias("dataset"), "*")))


@register("target_profile", lambda: with_cleaned() +
          "SELECT round(min(sold_price), 2) AS min, round(max(sold_price), 2) AS max, "
          "round(avg(sold_price), 2) AS mean, round(median(sold_price), 2) AS median FROM cleaned")
def q_target_profile(spark, sf):
    return Q.target_profile(C.clean_data(listings(spark, sf)))
