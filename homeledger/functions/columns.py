"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeledger.schema import SEASON_OF_MONTH

_FLOATS = (T.DoubleType, T.FloatType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL: turn float NaN into NULL so comparisons and percentiles agree."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _FLOATS):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def scalar_columns(df: DataFrame) -> list[str]:
    """Columns usable as a dedup key: everything that is not array/map/struct."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, _NESTED)]


def any_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def season_of(month: Column) -> Column:
    """Month number -> season name (NULL stays NULL)."""
    expr = None
    for m, s in SEASON_OF_MONTH.items():
        expr = F.when(month == m, s) if expr is None else expr.when(month == m, s)
    return expr


def season_sql(month_sql: str) -> str:
    whens = " ".join(f"WHEN {month_sql} = {m} THEN '{s}'" for m, s in SEASON_OF_MONTH.items())
    return f"CASE {whens} END"


def digest_sum(cols: list[str]) -> Column:
    """Sum of the rows' digests, an order-free fingerprint that still counts repeated rows.

    The digest is a 52-bit number from the md5 of the row's text.  Its halves are
    summed as long numbers (exact for 2^37 rows of a group) and put together at the
    end: wide decimals cost more to add, row by row, than the text and its md5.
    """
    digest = row_digest(cols)
    high, low = F.sum(F.shiftright(digest, 26)), F.sum(digest.bitwiseAND(F.lit((1 << 26) - 1)))
    return high.cast("decimal(38,0)") * F.lit(1 << 26) + low


def row_digest(cols: list[str]) -> Column:
    """Per-row 52-bit number from the md5 of the row's text."""
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def money_text(x: Column) -> Column:
    """'$1,234,568' — half-even rounding to whole dollars, like Python's format."""
    return F.concat(F.lit("$"), F.format_number(x, 0))
