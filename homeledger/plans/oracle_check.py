"""Order-insensitive comparison of a Spark result with its DuckDB twin."""

from __future__ import annotations

import math


def norm(v) -> str:
    import numpy as np
    import pandas as pd
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if v is None or v is pd.NA or v is pd.NaT:
        return "None"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return "None"
        return f"{round(float(v), 4):.4f}".replace("-0.0000", "0.0000")
    return str(v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False))


def duck_connection(sf_dir: str):
    import duckdb

    from homeledger.sources.fixture import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_pdf, duck_pdf) -> str | None:
    """None when equal, else a short reason."""
    c1, r1 = rows_of(spark_pdf)
    c2, r2 = rows_of(duck_pdf)
    if c1 != c2:
        return f"columns differ: spark={c1} duck={c2}"
    if r1 != r2:
        s1, s2 = set(r1), set(r2)
        return (f"rows {len(r1)} vs {len(r2)}; only spark {list(s1 - s2)[:2]}; "
                f"only duck {list(s2 - s1)[:2]}")
    return None
