"""DuckDB oracle SQL building blocks (independent re-statement of each operator).

These strings are the correctness oracle: each registered Spark query has a
SQL twin built from these CTEs over the pre-registered test tables.
"""

from __future__ import annotations

from homeledger.schema import (
    IQR_MULTIPLIER, LISTING_COLUMNS, OUTLIER_COLUMNS, VALID_STYLES,
)
from homeledger.sources.fixture import LISTINGS_SQL


def qlist(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def all_null_pred(cols=LISTING_COLUMNS) -> str:
    return " AND ".join(f"{c} IS NULL" for c in cols)


def iqr_ctes(src: str, out: str, mult: float = IQR_MULTIPLIER) -> str:
    """CTEs ``<out>_qb`` (quartiles of ``src``) and ``out`` (rows of ``src`` inside the fences)."""
    b_cols, inside = [], []
    for c in OUTLIER_COLUMNS:
        v = f"TRY_CAST({c} AS DOUBLE)"
        b_cols.append(f"quantile_cont({v}, 0.25) AS {c}__q1, quantile_cont({v}, 0.75) AS {c}__q3")
        inside.append(f"COALESCE(({v} >= {c}__q1 - {mult}*({c}__q3-{c}__q1) "
                      f"AND {v} <= {c}__q3 + {mult}*({c}__q3-{c}__q1)) OR {v} IS NULL, TRUE)")
    cols = ", ".join(f"{src}.{c}" for c in LISTING_COLUMNS)
    return (f"{out}_qb AS (SELECT {', '.join(b_cols)} FROM {src}),\n"
            f"{out} AS (SELECT {cols} FROM {src}, {out}_qb WHERE {' AND '.join(inside)})")


def clean_ctes(src: str = "listings", mult: float = IQR_MULTIPLIER) -> str:
    """CTEs s1..s4 and ``cleaned``, starting from relation ``src``."""
    return f"""
s1 AS (SELECT * FROM {src} WHERE NOT ({all_null_pred()})),
s2 AS (SELECT DISTINCT * FROM s1),
s3 AS (SELECT * FROM s2 WHERE sold_price IS NOT NULL),
s4 AS (SELECT * FROM s3 WHERE style IN ({qlist(VALID_STYLES)}) OR style IS NULL),
{iqr_ctes("s4", "cleaned", mult)}
"""


def with_listings(*ctes: str) -> str:
    parts = [f"listings AS ({LISTINGS_SQL})"] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n"


def with_cleaned(*ctes: str) -> str:
    return with_listings(clean_ctes(), *ctes)


KEYS_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def mode_sql(col: str, src: str) -> str:
    return f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"


def feature_ctes(src: str = "cleaned") -> str:
    """Steps 1-6 of the feature pipeline (before one-hot) as CTEs ending in ``fe``;
    the six median imputations run one at a time, in plan order."""
    from homeledger.functions.columns import season_sql
    from homeledger.schema import MEDIAN_IMPUTE_PLAN
    ctes = [
        f"fa AS (SELECT {KEYS_SQL}, style, sold_price, year_built, sqft, beds, full_baths, half_baths, "
        f"new_construction, city, lot_sqft, stories, parking_garage, hoa_fee, county, state, zip_code, "
        f"month(TRY_CAST(list_date AS DATE)) AS m_ FROM {src})",
        f"fb AS (SELECT *, {season_sql('m_')} AS s_ FROM fa)",
        f"fmode AS (SELECT {mode_sql('m_', 'fb')} AS mm, {mode_sql('s_', 'fb')} AS ms)",
        "fc AS (SELECT fb.* EXCLUDE (m_, s_), CAST(COALESCE(m_, mm, 6) AS INTEGER) AS sale_month, "
        "COALESCE(s_, ms, 'Summer') AS sale_season FROM fb, fmode)",
        "fd AS (SELECT * FROM fc WHERE style IS NOT NULL AND city IS NOT NULL)",
        "i0 AS (SELECT * REPLACE (CAST(COALESCE(half_baths, 0) AS INTEGER) AS half_baths, "
        "CAST(COALESCE(parking_garage, 0) AS INTEGER) AS parking_garage, COALESCE(hoa_fee, 0.0) AS hoa_fee), "
        "CAST(hoa_fee IS NOT NULL AS INTEGER) AS has_hoa, CAST(parking_garage IS NOT NULL AS INTEGER) AS has_garage "
        "FROM fd)",
    ]
    prev = "i0"
    for i, (col, keys) in enumerate(MEDIAN_IMPUTE_PLAN, start=1):
        on = " AND ".join(f"{prev}.{k} = g{i}.{k}" for k in keys)
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        ctes += [
            f"g{i} AS (SELECT {', '.join(keys)}, median({col}) AS gm FROM {prev} WHERE {nn} GROUP BY {', '.join(keys)})",
            f"h{i} AS (SELECT {prev}.* REPLACE (COALESCE(CAST({prev}.{col} AS DOUBLE), g{i}.gm) AS {col}) "
            f"FROM {prev} LEFT JOIN g{i} ON {on})",
            f"i{i} AS (SELECT h{i}.* REPLACE (COALESCE({col}, (SELECT median({col}) FROM h{i})) AS {col}) FROM h{i})",
        ]
        prev = f"i{i}"
    ctes.append(f"fe AS (SELECT * FROM {prev})")
    return ",\n".join(ctes)
