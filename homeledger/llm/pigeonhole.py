"""Embedding near-duplicates by a subspace pigeonhole join (operator 6).

Unit vectors with cosine >= c lie at squared distance <= 2 - 2c.  After one
fixed random rotation, which spreads that distance over all coordinates, the
vector is split into blocks of at most ``BLOCK`` dimensions, each with a share
of the squared-distance budget in proportion to its dimensions: a pair within
the budget is within the share of at least one block.  Each block is a range
join: cells of ``SIDE`` times the block's radius, where a vector is at home in
one cell and visits those neighbours (with a larger first coordinate) that its
ball reaches; home and visiting rows meet by an equality join on the cell, and
the block distance is checked in the join.  The union of the blocks' candidates
is verified by the exact cosine in double precision.

Copies (same label, same components) are collapsed into one vector with a count
first, so a hot vector costs no more than any other.  Rows per vector do not
depend on the data: ``BLOCK``-dimensional cells keep the visits low.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import min_reachable
from homeledger.session import materialize

BLOCK = 8
SIDE = 3.0
SEED = 20240607
COORDS = [f"c{k}" for k in range(BLOCK)]


def rotation(dims: int):
    """Fixed random orthogonal matrix."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng(SEED + dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_rows(vectors, ids, budget: float):
    """Home and visiting rows of unit vectors of one dimension, block by block:
    (id, block, cell key, home, limit of the block's squared distance, coordinates)."""
    import numpy as np

    n, dims = vectors.shape
    y = vectors @ rotation(dims)
    for b, cols in enumerate(np.array_split(np.arange(dims), -(-dims // BLOCK))):
        x = y[:, cols]
        share = budget * len(cols) / dims
        limit = share * (1 + 1e-5) + 1e-7  # room for the rounding of 4-byte coordinates
        radius = np.sqrt(limit)
        scaled = x / (SIDE * radius)
        cell = np.floor(scaled)
        low = scaled - cell
        step = np.where(low < 0.5, -1, 1).astype(np.int64)
        gap2 = (np.minimum(low, 1 - low) * SIDE * radius) ** 2
        masks = (np.arange(1, 1 << len(cols))[:, None] >> np.arange(len(cols)) & 1).astype(float)
        first = masks.argmax(axis=1)
        # a visit goes to the neighbour whose first differing coordinate is larger: each pair meets once
        who, way = np.nonzero((gap2 @ masks.T <= limit * (1 + 1e-9)) & (step[:, first] > 0))
        cell = cell.astype(np.int64)
        there = cell[who] + masks[way].astype(np.int64) * step[who]
        cells = np.concatenate([cell, there])
        key = np.full(len(cells), dims * 64 + b, np.uint64)
        for k in range(len(cols)):
            key = (key ^ cells[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        at = np.concatenate([np.arange(n), who])
        out = np.zeros((len(at), BLOCK), np.float32)
        out[:, :len(cols)] = x[at]
        yield ids[at], b, key.view(np.int64), np.arange(len(at)) < n, limit, out


def near_duplicates(embeddings: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector.

    Vectors link when their labels are equal and not null and their cosine, in
    double precision, is at least ``cosine``.  Null, empty and zero vectors and
    those with a null or non-finite component link with nothing (very small and very large
    ones link like any other), and neither do
    vectors of different lengths.  ``n_links`` counts other rows linked
    directly, ``component_id`` is the smallest ``vec_id`` reachable, ``kept``
    tells whether it is the row's own (true for a null id alone in its
    component).  Repeated rows are rows of their own; an empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    e = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", e.alias("embedding"), "label").withColumn("rid", F.monotonically_increasing_id())
    # a vector is divided by the power of two below its largest component: exact, and no square under- or overflows
    rows = rows.withColumn("top", F.expr("aggregate(embedding, 0D, (m, x) -> if(x IS NULL OR isnan(x), NULL, greatest(m, abs(x))))"))
    rows = rows.withColumn("sound", F.expr("label IS NOT NULL AND top > 0 AND top < double('inf')"
                                           " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x))"))
    rows = rows.withColumn("sound", F.coalesce("sound", F.lit(False)))
    rows = rows.withColumn("embedding", F.expr("if(sound, transform(embedding, x -> x / pow(2D, floor(log2(top)))), embedding)")).drop("top")
    rows = materialize(rows.withColumn("norm", F.expr("sqrt(aggregate(embedding, 0D, (s, x) -> s + x * x))")), "vectors")
    reps = materialize(rows.where("sound").groupBy("label", "embedding").agg(
        F.min("rid").alias("rep"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id"),
        F.first("norm").alias("norm")), "vector-reps")
    label = reps.schema["label"].dataType.simpleString()
    budget = max(0.0, 2 - 2 * cosine) + 1e-9

    def cells(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            label_of, rep = b.column(0), np.asarray(b.column(1))
            vec = [np.asarray(v, float) for v in b.column(2).to_pylist()]
            dims = np.fromiter(map(len, vec), np.int64, len(vec))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for lo in range(0, len(at), 2000):
                    part = at[lo:lo + 2000]
                    x = np.stack([vec[i] for i in part])
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    for i, block, key, home, limit, c in block_rows(x, part, budget):
                        yield pa.RecordBatch.from_arrays(
                            [label_of.take(pa.array(i)), pa.array(rep[i]), pa.array(np.full(len(i), block, np.int16)),
                             pa.array(key), pa.array(home), pa.array(np.full(len(i), limit)),
                             *(pa.array(c[:, k]) for k in range(BLOCK))],
                            names=["label", "rep", "block", "key", "home", "limit", *COORDS])

    schema = (f"label {label}, rep long, block short, key long, home boolean, limit double, "
              + ", ".join(f"{c} float" for c in COORDS))
    placed = materialize(reps.select("label", "rep", "embedding").mapInArrow(cells, schema), "vector-cells")
    near = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in COORDS)
    found = (placed.where("home").alias("a").join(
        placed.alias("b"), F.expr("a.label = b.label AND a.block = b.block AND a.key = b.key "
                                  f"AND (NOT b.home OR a.rep < b.rep) AND {near} <= a.limit"))
        .select(F.least("a.rep", "b.rep").alias("u"), F.greatest("a.rep", "b.rep").alias("v")).distinct())
    side = lambda n: reps.select(F.col("rep").alias(n), F.col("embedding").alias(f"e{n}"),
                                 F.col("norm").alias(f"n{n}"), F.col("copies").alias(f"k{n}"))
    exact = F.expr("aggregate(zip_with(eu, ev, (x, y) -> x * y), 0D, (s, x) -> s + x) / (nu * nv)")
    links = materialize(found.join(side("u"), "u").join(side("v"), "v").where(exact >= cosine)
                        .select("u", "v", "ku", "kv"), "vector-links")
    n_links = (links.select(F.col("u").alias("rep"), F.col("kv").alias("k"))
               .unionByName(links.select(F.col("v").alias("rep"), F.col("ku").alias("k")))
               .groupBy("rep").agg(F.sum("k").alias("others")))
    roots = materialize(min_reachable(links.select("u", "v"), "vectors"), "vector-roots")
    named = (reps.select("rep", "copies", "first_id").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("root", F.coalesce("root", "rep")))
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    done = (named.join(first, "root").join(n_links, "rep", "left")
            .select("rep", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    of_copy = reps.select("label", "embedding", "rep").join(done, "rep")
    out = (rows.where("sound").select("vec_id", "label", "embedding").join(of_copy, ["label", "embedding"])
           .select("vec_id", "n_links", "component_id"))
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def duck_sql(cosine: float = 0.98) -> str:
    """DuckDB twin over the view ``embeddings``: every pair of one label, then reachability."""
    return f"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
f AS (SELECT rid, vec_id, label, list_transform(v, lambda x: x / pow(2, floor(log2(list_max(list_transform(v, lambda y: abs(y))))))) AS v FROM e
      WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM f),
s AS (SELECT * FROM n WHERE norm > 0),
link AS (SELECT a.rid AS a, b.rid AS b, b.vec_id AS id FROM s a JOIN s b ON a.label = b.label AND a.rid <> b.rid
         AND len(a.v) = len(b.v) WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {cosine}),
reach AS (SELECT rid AS a, rid AS b, vec_id AS id FROM e UNION
          SELECT reach.a, link.b, link.id FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT a, min(id) AS component_id FROM reach GROUP BY a),
cnt AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(cnt.n, 0)::BIGINT AS n_links, comp.component_id,
       e.vec_id IS NOT DISTINCT FROM comp.component_id AS kept
FROM e JOIN comp ON comp.a = e.rid LEFT JOIN cnt ON cnt.a = e.rid"""
