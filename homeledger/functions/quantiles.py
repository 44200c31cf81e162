"""Exact quantiles by counting (linear interpolation, like ``percentile``).

One algorithm at every size, for whole tables and for groups:

1. count every distinct (key, column, value); counts combine per task, so a hot
   value or a hot group shuffles one row per task and value;
2. deal the counted values by range over many partitions (a large group is cut
   into as many of them as it needs) and write them with their partition
   number;
3. sum each partition and run a prefix over the sums, one row per partition of
   a group, which tells in which partition a wanted rank lies;
4. run the cumulative count inside those partitions only and read the values.

A table dealt in value order serves every grouping by a subset of its keys, and
:func:`with_filled` adds what an imputation fills in without another scan of the
rows.  No task holds more than a range of one column's values, and nothing
reaches the driver.  Result: v_k + (h - k) (v_{k+1} - v_k) with h = (n - 1) p
and k the whole part of h.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homeledger.session import materialize


def _value(c: str) -> Column:
    v = F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return F.when(~F.isnan(v), v)


def count_values(df: DataFrame, columns: list[str], keys: list[str] | None = None, by_group: bool = False,
                 nulls: bool = False) -> DataFrame:
    """Written table (g0, g1, ..., item, v, c, part): how often each value stands under each key combination.

    ``item`` is the number of the column, ``part`` rises with the order in which
    the values were dealt: by value for every column, or by group first
    (``by_group``: for as many groups as there may be, but that grouping only).
    ``nulls`` also counts missing values (``v`` null).  Null, NaN and
    non-numeric values are missing.
    """
    keys = list(keys or [])
    group = [f"g{i}" for i in range(len(keys))]
    pairs = df.select(*[F.col(f"`{k}`").alias(g) for k, g in zip(keys, group)],
                      F.inline(F.array(*[F.struct(F.lit(i).alias("item"), _value(c).alias("v"))
                                         for i, c in enumerate(columns)])))
    if not nulls:
        pairs = pairs.where("v IS NOT NULL")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*group, "item", "v"] if by_group else ["item", "v", *group]
    return materialize(pairs.groupBy(*group, "item", "v").agg(F.count(F.lit(1)).alias("c"))
                       .repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "value-counts")


def counted_quantiles(counted: DataFrame, columns: list[str], probs: list[float],
                      by: list[str] | None = None) -> DataFrame:
    """Quantiles from counted values (``by`` columns, item, v, c, part): ``by`` columns and ``__q_<column>``.

    Values must rise with ``part`` inside each group.  Missing values and rows
    with a null ``by`` column do not count.
    """
    group = list(by or [])
    item = [*group, "item"]
    counted = counted.where(" AND ".join(["v IS NOT NULL", *(f"{g} IS NOT NULL" for g in group)]))
    before = Window.partitionBy(*item).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (counted.groupBy(*item, "part").agg(F.sum("c").alias("s"))
            .withColumn("below", F.coalesce(F.sum("s").over(before), F.lit(0)))
            .withColumn("n", F.sum("s").over(Window.partitionBy(*item))))
    # the ranks on either side of each quantile that lie in this partition, counted from its start
    ranks = ", ".join(f"struct({k} AS k, {side} AS side, (n - 1) * {float(p)!r}D - floor((n - 1) * {float(p)!r}D) AS frac, "
                      f"least(floor((n - 1) * {float(p)!r}D) + {side}, n - 1) - below AS at)"
                      for k, p in enumerate(probs) for side in (0, 1))
    here = sums.select(*item, "part", F.expr(f"filter(array({ranks}), r -> r.at >= 0 AND r.at < s)").alias("ranks"))
    inside = Window.partitionBy(*item, "part").orderBy("v")
    run = (counted.join(here.where(F.size("ranks") > 0), [*item, "part"]).repartition(*item, "part")
           .groupBy(*item, "part", "v").agg(F.sum("c").alias("c"), F.any_value("ranks").alias("ranks"))
           .withColumn("upto", F.sum("c").over(inside)))
    hit = run.select(*item, "v", F.inline(F.expr("filter(ranks, r -> upto > r.at AND upto - c <= r.at)")))
    found = ((hit.repartition(*group) if group else hit.repartition(1)).groupBy(*item, "k")
             .agg(F.max(F.expr("CASE WHEN side = 0 THEN v END")).alias("v0"),
                  F.max(F.expr("CASE WHEN side = 1 THEN v END")).alias("v1"), F.any_value("frac").alias("frac"))
             .withColumn("q", F.expr("CASE WHEN frac = 0 OR v0 = v1 THEN v0 ELSE v0 + frac * (v1 - v0) END")))
    arrays = [F.array(*[F.max(F.expr(f"CASE WHEN item = {i} AND k = {k} THEN q END")) for k in range(len(probs))])
              for i in range(len(columns))]
    out = [F.when(a[0].isNotNull(), a).alias(f"__q_{c}") for a, c in zip(arrays, columns)]
    return (found.groupBy(*group) if group else found.groupBy()).agg(*out)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None) -> DataFrame:
    """``by`` columns and ``__q_<column>``: the quantiles at ``probs`` as array<double>.

    Null, NaN and non-numeric values do not count.  Without ``by`` the result is
    one row (null arrays where a column has no value); with ``by``, one row per
    group that has any value (null keys form no group).
    """
    by = list(by or [])
    group = [f"g{i}" for i in range(len(by))]
    counted = count_values(df, columns, by, by_group=True)
    return counted_quantiles(counted, columns, probs, group).select(
        *[F.col(g).alias(k) for g, k in zip(group, by)], *[f"`__q_{c}`" for c in columns])


def with_filled(counted: DataFrame, fills: DataFrame) -> DataFrame:
    """(item, v, c, part): the counted values, with missing ones counted under what ``fills`` gives them.

    ``fills`` has (item, v, c); each of its values goes to the partition in whose
    range it falls.  The partitions' upper ends, one number per column and
    partition, are broadcast: their count is a setting, not a share of the data.
    """
    ends = (counted.where("v IS NOT NULL").groupBy("item", "part").agg(F.max("v").alias("end"))
            .groupBy("item").agg(F.array_sort(F.collect_list(F.struct("part", "end"))).alias("ends")))
    placed = fills.join(F.broadcast(ends), "item").select(
        "item", "v", "c", F.expr("ends[least(size(filter(ends, e -> e.end < v)), size(ends) - 1)].part").alias("part"))
    return counted.where("v IS NOT NULL").select("item", "v", "c", "part").unionByName(placed)
