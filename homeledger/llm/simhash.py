"""SimHash near-duplicates by deletion-variant signatures (operator 10).

A fingerprint of ``bits`` bits is cut into ``distance // 2 + 1`` segments: two
fingerprints that differ in at most ``distance`` bits differ in at most one bit
in some segment.  Each distinct fingerprint is indexed under every one-wildcard
variant of every segment (segment number, wildcard position, segment with that
bit deleted); an equality join on the variants finds all candidates, and the
bit distance of each is verified.

Variants that more than ``hot`` fingerprints share are not joined as they are:
their members are indexed again under variants of the two halves of the bits
that the first key leaves open, with the same argument on the halves.  Three
levels leave at most 2**11 possible values under one key, so no bucket grows
with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import fresh_name, id_and_text, min_reachable, tidy
from homeledger.session import materialize

BITS = 64
SEED = 42
#: Variants that one task makes, about.
VARIANTS = 1 << 21


def text_fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of one text: majority of the bits of XXH64 over word shingles."""
    import numpy as np
    import xxhash

    # bytes.lower() touches A-Z only; bytes.split() cuts at \x20 and \x09-\x0D only
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    h64 = xxhash.xxh64_intdigest
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        part = words[lo:hi + shingle - 1]
        if len(words) < shingle:
            grams = [b" ".join(words)]
        else:
            grams = map(b" ".join, zip(*[part[k:k + hi - lo] for k in range(shingle)]))
        h = np.fromiter((h64(g, SEED) for g in grams), dtype="<u8", count=hi - lo)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) per row; a null or wordless text has fingerprint 0."""
    rows = id_and_text(docs)

    def run(batches):
        import pyarrow as pa

        tidy()
        for b in batches:
            fp = [text_fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])
        tidy()

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _variants(rows: DataFrame, carry: list[str], level: int, distance: int) -> DataFrame:
    """One row per one-wildcard variant of each segment of the still open bits [lo, lo + width)."""
    pieces = distance // 2 + 1
    width = BITS >> level if pieces == 2 else BITS
    seg = width // pieces
    t = F.explode(F.sequence(F.lit(0), F.lit(pieces * seg - 1)))
    out = rows.select(*carry, t.alias("t")).withColumn("s", F.expr(f"int(t div {seg})"))
    mask = (1 << seg) - 1
    value = (f"(shiftrightunsigned(fp, lo + s * {seg}) & {mask if seg < 64 else -1}L)"
             f" & ~shiftleft(1L, t % {seg})")
    return out.withColumn("value", F.expr(value))


def _found_here(level: int, distance: int, lo: str = "lo", tag: str = "t") -> str:
    """SQL: this variant is the first (segment, wildcard) under which the pair meets, so it counts once."""
    pieces = distance // 2 + 1
    width = BITS >> level if pieces == 2 else BITS
    seg = width // pieces
    mask = (1 << seg) - 1 if seg < 64 else -1
    part = lambda k: f"(shiftrightunsigned(a.fp ^ b.fp, a.{lo} + {k}) & {mask}L)"
    earlier = " AND ".join(f"(a.{tag} < {(k + 1) * seg} OR bit_count({part(k * seg)}) > 1)" for k in range(pieces - 1))
    own = f"({part(f'int(a.{tag} div {seg}) * {seg}')} <> 0 OR a.{tag} % {seg} = 0)"
    return own + (f" AND {earlier}" if earlier else "")


def links(fps: DataFrame, distance: int = 2, hot: int = 1024) -> DataFrame:
    """(u, v) with u < v: all pairs of distinct values of ``fp`` at ``distance`` bits or fewer, once each."""
    pieces = distance // 2 + 1
    levels = 3 if pieces == 2 else 1
    base = fps.select("fp").distinct().withColumn("lo", F.lit(0)).withColumn("key", F.lit(0).cast("long"))
    # a fingerprint becomes one row per bit: deal them round robin into enough tasks for that many rows, as a
    # repartitioning by key would be folded into the distinct's own exchange and its small parts joined again
    spread = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-fps.count() * BITS // VARIANTS))
    base = base.repartition(spread)
    carry, conds, out = ["fp", "lo", "key"], [], []
    for level in range(levels):
        lo, tag = f"lo{level}", f"t{level}"
        rows = _variants(base, carry, level, distance)
        rows = (rows.withColumn("key", F.xxhash64("key", "t", "value")).drop("value")
                .withColumnRenamed("t", tag).withColumn(lo, F.col("lo")))
        conds.append(_found_here(level, distance, lo, tag))
        sizes = rows.groupBy("key").count().where(F.col("count") > hot).select("key")
        last = level == levels - 1
        big = None if last else materialize(sizes, "simhash-hot")
        some = big is not None and bool(big.take(1))
        cold = rows.join(big, "key", "left_anti") if some else rows
        cond = " AND ".join(["a.key = b.key", "a.fp < b.fp", f"bit_count(a.fp ^ b.fp) <= {distance}", *conds])
        # the planner takes the exploded rows for as small as the fingerprints and would broadcast them, 64 rows for one
        out.append(cold.alias("a").hint("merge").join(cold.alias("b"), F.expr(cond))
                   .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
        if not some:
            break
        seg = (BITS >> level) // 2
        base = rows.join(big, "key", "left_semi").withColumn("lo", F.expr(f"lo + (1 - s) * {seg}")).drop("s")
        carry = base.columns
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _classes(fp: DataFrame, distance: int) -> DataFrame:
    """(fp, n_copies, root, component_id) of every fingerprint of ``fp`` (doc_id, fp)."""
    reps = materialize(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies")),
                       "simhash-reps")
    roots = materialize(min_reachable(links(reps, distance), "simhash"), "simhash-roots")
    named = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.join(first, "root").select("fp", "n_copies", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Fingerprint and component of every document.

    Returns ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (the
    smallest ``doc_id`` reachable over links of at most ``distance`` bits, equal
    fingerprints included) and ``n_copies`` (rows with the same fingerprint).

    Null and wordless texts share fingerprint 0 and link like any other; null
    ids are kept and never become a component's id unless all are null; rows
    repeated in the input are repeated in the result; an empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    fp = materialize(fingerprints(docs, shingle), "simhash-fp")
    return fp.join(_classes(fp, distance), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_copies")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, all columns.

    The row with the group's smallest ``doc_id`` stays (of several with that id
    the one whose text has the smallest hash; of repeated rows one).  Rows with
    a null id stay only in groups where all ids are null.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    mark, key = fresh_name(docs, "simhash_text"), ["doc_id", "h"]
    fp = materialize(fingerprints(docs.withColumn("doc_id", F.struct(F.col("doc_id"), F.xxhash64(text).alias("h"))),
                                  shingle), "simhash-fp")
    ids = fp.select("doc_id.doc_id", "doc_id.h", "fp")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), *key)).alias("best")
    stays = (ids.join(_classes(ids, distance), "fp").groupBy("root").agg(best)
             .select(F.coalesce("best.doc_id", F.lit(0)).alias("w_id"), F.col("best.none").alias("w_none"),
                     F.col("best.h").alias("w_h")))
    id_col = F.col("doc_id")
    rows = docs.withColumn(mark, F.struct(F.coalesce(id_col, F.lit(0)).alias("i"), id_col.isNull().alias("none"),
                                          F.xxhash64(text).alias("h")))
    m = F.col(mark)
    one = rows.dropDuplicates([mark])
    return one.join(stays, (m["i"] == F.col("w_id")) & (m["none"] == F.col("w_none")) & (m["h"] == F.col("w_h")),
                    "left_semi").drop(mark)
