"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import sys
import types
from contextlib import suppress

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeledger.session import materialize


def worker_state(name: str, factory):
    """A value kept for the life of a Python worker (tokenizers, word caches).

    Functions of this package travel by value, so module globals do not outlive
    a task; a holder module in ``sys.modules`` does.
    """
    box = sys.modules.setdefault("_homeledger_worker", types.ModuleType("_homeledger_worker"))
    if not hasattr(box, name):
        setattr(box, name, factory())
    return getattr(box, name)


def tidy(keep: str | None = None) -> None:
    """Give back what a Python worker holds of earlier stages (all kept state but ``keep``).

    Workers outlive stages, so without this the caches and the free memory of
    one operator stay with the executor while the next one runs.
    """
    import pyarrow as pa

    box = sys.modules.get("_homeledger_worker")
    for name in [n for n in vars(box or types.SimpleNamespace()) if not n.startswith("__") and n != keep]:
        delattr(box, name)
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library without it keeps its free memory
        ctypes.CDLL(None).malloc_trim(0)


def ship(spark, model):
    """Broadcast a model's plain state; the returned function builds the model anew in a worker.

    Broadcasts are unpickled by name, classes of this package travel by value.
    """
    kind, held = type(model), spark.sparkContext.broadcast(model.__getstate__())

    def load():
        out = kind.__new__(kind)
        (getattr(out, "__setstate__", None) or out.__dict__.update)(held.value)
        return out

    return load


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` (as it is) and ``text`` (null: empty); every other column is left behind."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in have:
        k += 1
        name = f"{stem}_{k}"
    return name


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def min_reachable(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node reachable over undirected ``edges`` (u, v).

    Large-star / small-star rounds: each round hangs every node's neighbours on
    the smallest node it knows, until the edges form stars.  A round is a few
    shuffles of the edge list with minima combined before the shuffle; it is
    written as a table, so lost executors cost at most one round.  Nodes
    without edges do not appear.
    """
    cur = materialize(edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
                      .where("a > b").distinct(), f"{name}-edges")
    state = None
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a > b").distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a > b").distinct())
        cur = materialize(small, f"{name}-round")
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
