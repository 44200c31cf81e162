"""Filter-rule text -> Spark ``Column`` predicate.

Rules look like ``beds>20`` or ``style==MULTI_FAMILY``: a column name, one of
``> >= < <= == !=`` and a value (a number when it parses as one, else text
with optional quotes).  ``!=`` is true on a missing value (the row is
removed); the other five are false on a missing value.
"""

from __future__ import annotations

from contextlib import suppress
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: the comparison signs; of two that start at one place the longer counts
SIGNS = (">=", "<=", "!=", "==", ">", "<")


@dataclass(frozen=True)
class Rule:
    text: str
    column: str
    op: str
    value: object

    def value_text(self) -> str:
        return repr(self.value) if isinstance(self.value, float) else str(self.value)


def _literal(raw: str) -> object:
    """A number where the text is one, else the text without quotes around it."""
    with suppress(ValueError):
        return float(raw)
    return raw.strip("'\"")


def parse_rule(text: str) -> Rule:
    """Cut a rule at its first comparison sign into column, sign and typed value."""
    places = [(text.index(s), -len(s), s) for s in SIGNS if s in text]
    sign = min(places)[2] if places else ""
    column, _, raw = (part.strip() for part in text.partition(sign)) if sign else ("", "", "")
    if not (column.isascii() and column.isidentifier() and raw):
        raise ValueError(f"Invalid filter rule: {text!r}; expected e.g. 'beds>20' or 'sold_price<=10000'")
    return Rule(text, column, sign, _literal(raw))


def predicate(rule: Rule, df: DataFrame | None = None) -> Column:
    """Null-safe predicate: TRUE where the rule matches the row."""
    if df is not None and rule.column not in df.columns:
        raise ValueError(f"Column {rule.column!r} not found. Available: {df.columns}")
    c, v = F.col(f"`{rule.column}`"), F.lit(rule.value)
    if rule.op == "!=":
        return ~c.eqNullSafe(v)
    cmp = {">": c > v, ">=": c >= v, "<": c < v, "<=": c <= v, "==": c == v}[rule.op]
    return F.coalesce(cmp, F.lit(False))
