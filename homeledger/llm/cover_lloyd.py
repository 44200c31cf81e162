"""Vector code compression by cover-tree Lloyd (operator 13).

Vectors are cut into equal parts, and each part position gets a codebook by
Lloyd's rounds over integer components.  The rows lie in a written table in
groups of some thousands; each group keeps one cover tree per part position:
nodes with a centre, the radius that covers all points below, their number and
their sum, stored level by level, points in tree order.

A round walks every tree from its root.  An entry that is farther from a node's
centre than the nearest one by more than twice the radius is nearest to no
point below, so it is dropped for the subtree; where one entry is left the
node's sum and number go to it at once.  Only the other nodes descend, down to
leaves of a few points, which are compared exactly.  The groups' sums are added
up by Spark; only the codebooks, whose size is fixed, pass through the driver.

Squared distances are exact integers; square roots appear only in the bound,
with a margin that covers their rounding.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import tidy
from homeledger.session import materialize

SCALE = 4096
#: Components beyond this (after scaling) could overflow squared distances; such rows are left out.
LARGEST = 1 << 27
#: Vectors of a group (one tree per part), and points that a leaf may hold.
GROUP_ROWS = 8192
LEAF = 24


# ---- trees --------------------------------------------------------------

def build_tree(points):
    """Cover tree of integer ``points`` (n, d): arrays of nodes in level order and the points' tree order.

    The children of a node stand at least half its radius apart and cover its
    points within that; a node of ``LEAF`` points or fewer, or of radius 0, is a
    leaf.  Children are consecutive, and so are the points below a node.
    """
    import numpy as np

    n = len(points)
    order = np.arange(n)
    far = points.astype(np.float64)
    centre, lo, hi, first, last, rho = [points[0]], [0], [n], [0], [0], []
    k = 0
    while k < len(lo):
        own = order[lo[k]:hi[k]]
        c = far[own] - centre[k]
        dist = np.sqrt(np.einsum("ij,ij->i", c, c))
        radius = float(dist.max())
        rho.append(radius)
        first[k] = last[k] = len(lo)
        if len(own) > LEAF and radius > 0:
            left, sorted_own, at = np.arange(len(own)), [], lo[k]
            while len(left):
                # the next centre: the node's own first, then the farthest point that is left
                pick = left[dist[left].argmin()] if at == lo[k] else left[dist[left].argmax()]
                c = far[own[left]] - far[own[pick]]
                near = np.einsum("ij,ij->i", c, c) <= radius * radius / 4
                took = own[left[near]]
                sorted_own.append(took)
                centre.append(points[own[pick]])
                lo.append(at)
                at += len(took)
                hi.append(at)
                first.append(0)
                last.append(0)
                left = left[~near]
            order[lo[k]:hi[k]] = np.concatenate(sorted_own)
            last[k] = len(lo)
        k += 1
    total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order], axis=0)])
    lo, hi = np.array(lo), np.array(hi)
    return {"order": order, "centre": np.array(centre), "lo": lo, "hi": hi, "first": np.array(first),
            "last": np.array(last), "rho": np.array(rho), "total": total}


def squared(points, entries):
    """Exact squared distances (n, entries) of integer vectors."""
    import numpy as np

    out = np.empty((len(points), len(entries)), np.int64)
    for j, e in enumerate(entries):
        d = points - e
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def ranges(lo, hi):
    """All numbers of the ranges [lo, hi), and the range that each is from."""
    import numpy as np

    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size), which


def assign(tree, points, book):
    """(code of each point in tree order, sums, numbers, exact distances worked out) for a codebook."""
    import numpy as np

    n, m = len(points), len(book)
    step = np.zeros(n + 1, np.int64)  # codes of whole subtrees, as differences along the tree order
    code = np.zeros(n, np.int64)
    sums, count, work = np.zeros((m, points.shape[1]), np.int64), np.zeros(m, np.int64), 0
    nodes = np.zeros(1, np.int64)
    loose = []
    while len(nodes):
        dist = np.sqrt(squared(tree["centre"][nodes], book).astype(np.float64))
        work += dist.size
        best = dist.argmin(axis=1)
        low = dist[np.arange(len(nodes)), best]
        bound = low + 2 * tree["rho"][nodes]
        # an entry beyond the bound is strictly farther from every point below
        rivals = (dist <= (bound * (1 + 1e-9) + 1e-6)[:, None]).sum(axis=1)
        sure = rivals == 1
        a, b, e = tree["lo"][nodes[sure]], tree["hi"][nodes[sure]], best[sure]
        np.add.at(sums, e, tree["total"][b] - tree["total"][a])
        np.add.at(count, e, b - a)
        np.add.at(step, a, e)
        np.add.at(step, b, -e)
        open_ = nodes[~sure]
        leaf = tree["first"][open_] == tree["last"][open_]
        loose.append(open_[leaf])
        nodes = ranges(tree["first"][open_[~leaf]], tree["last"][open_[~leaf]])[0]
    code += np.cumsum(step[:-1])
    loose = np.concatenate(loose)
    at, _ = ranges(tree["lo"][loose], tree["hi"][loose])
    if len(at):
        exact = points[tree["order"][at]]
        near = squared(exact, book).argmin(axis=1)  # the first of equals: the lower index
        work += len(at) * m
        code[at] = near
        np.add.at(sums, near, exact)
        np.add.at(count, near, 1)
    return code, sums, count, work


# ---- tables -------------------------------------------------------------

def _edges(dims: int, parts: int) -> list[int]:
    return [k * dims // parts for k in range(parts + 1)]


def kept_vectors(rows: DataFrame, vec: str = "embedding") -> DataFrame:
    """(vec_id, label, v array<long>): scaled vectors, without null, non-finite or too large components."""
    x = F.transform(F.col(vec), lambda c: F.floor(c.cast("double") * SCALE))
    fine = F.forall(F.col(vec), lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST / SCALE))  # NaN compares as larger
    label = F.col("label") if "label" in rows.columns else F.lit(None).cast("int").alias("label")
    return rows.where(F.coalesce(fine, F.lit(False)) & (F.size(vec) > 0)).select(
        "vec_id", label, x.cast("array<bigint>").alias("v"))


def first_codebooks(kept: DataFrame, entries: int, parts: int):
    """Per part position the parts of the vectors with the smallest ids (equal ids: the smaller vector)."""
    import numpy as np

    top = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not top:
        return None, 0
    dims = len(top[0]["v"])
    top = np.array([r["v"] for r in top if len(r["v"]) == dims], np.int64)
    cut = _edges(dims, parts)
    return [top[:, a:b].copy() for a, b in zip(cut, cut[1:])], dims


def grow_trees(kept: DataFrame, dims: int, parts: int) -> DataFrame:
    """Written table of groups: ids, labels, the vectors and one tree per part, as bytes."""
    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    cut = _edges(dims, parts)

    def run(batches):
        import pickle

        import numpy as np
        import pyarrow as pa

        tidy()

        def group(held):
            t = pa.Table.from_batches(held).combine_chunks()
            v = t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)
            trees = [build_tree(v[:, a:b]) for a, b in zip(cut, cut[1:])]
            state = pickle.dumps([{k: x for k, x in tr.items() if k != "total"} for tr in trees], 5)
            ids, labels = (pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column(c).combine_chunks())
                           for c in ("vec_id", "label"))
            return pa.RecordBatch.from_arrays(
                [ids, labels, pa.array([v.astype("<i4").tobytes()], pa.binary()), pa.array([state], pa.binary())],
                names=["ids", "labels", "v", "trees"])

        held, n = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, GROUP_ROWS - n)
                b = b.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == GROUP_ROWS:
                    yield group(held)
                    held, n = [], 0
        if held:
            yield group(held)
        tidy()

    out = kept.where(F.size("v") == dims).mapInArrow(
        run, f"ids array<{id_type}>, labels array<{label_type}>, v binary, trees binary")
    return materialize(out, "cover-trees")


def _load(v: bytes, trees: bytes, dims: int, cut: list[int]):
    """Per part: (points, tree with its running sums)."""
    import pickle

    import numpy as np

    points = np.frombuffer(v, "<i4").reshape(-1, dims).astype(np.int64)
    out = []
    for tree, a, b in zip(pickle.loads(trees), cut, cut[1:]):
        own = points[:, a:b]
        tree["total"] = np.concatenate([np.zeros((1, b - a), np.int64), np.cumsum(own[tree["order"]], axis=0)])
        out.append((own, tree))
    return out


def round_sums(trees: DataFrame, books, dims: int):
    """(part, entry) -> (number, sums) over all groups for the given codebooks."""
    cut = _edges(dims, len(books))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for v, t in zip(b.column(0), b.column(1)):
                rows = []
                for p, (points, tree) in enumerate(_load(v.as_py(), t.as_py(), dims, cut)):
                    _, sums, count, work = assign(tree, points, books[p])
                    rows += [(p, e, int(count[e]), sums[e].tolist(), work if e == 0 else 0) for e in range(len(count))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                                 names=["part", "entry", "n", "total", "work"])

    per = trees.select("v", "trees").mapInArrow(run, "part long, entry long, n long, total array<long>, work long")
    width = max(b - a for a, b in zip(cut, cut[1:]))
    return per.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.sum("work").alias("work"),
        F.array(*[F.sum(F.expr(f"cast(get(total, {k}) AS decimal(38, 0))")) for k in range(width)]).alias("total")).collect()


def lloyd(trees: DataFrame, books, dims: int, rounds: int):
    """Codebooks after ``rounds`` rounds, and the distances worked out in each."""
    books, works = [b.copy() for b in books], []
    for _ in range(rounds):
        rows = round_sums(trees, books, dims)
        for r in rows:
            if r["n"]:
                width = books[r["part"]].shape[1]
                books[r["part"]][r["entry"]] = [int(t) // r["n"] for t in r["total"][:width]]
        works.append(sum(r["work"] for r in rows))
    return books, works


def encode(trees: DataFrame, books, dims: int, like: DataFrame) -> DataFrame:
    """(vec_id, label, code, error) of every vector of the groups."""
    cut = _edges(dims, len(books))
    id_type, label_type = (like.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hexa = np.array([f"{k:02x}" for k in range(256)])
        for b in batches:
            for row in range(b.num_rows):
                ids, labels, v, t = (b.column(k)[row] for k in range(4))
                n = len(ids)
                codes, error = np.zeros((n, len(books)), np.int64), np.zeros(n, np.int64)
                for p, (points, tree) in enumerate(_load(v.as_py(), t.as_py(), dims, cut)):
                    codes[tree["order"], p] = assign(tree, points, books[p])[0]
                    d = points - books[p][codes[:, p]]
                    error += np.einsum("ij,ij->i", d, d)
                text = ["".join(r) for r in hexa[codes].tolist()]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(text), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    return trees.select("ids", "labels", "v", "trees").mapInArrow(
        run, f"vec_id {id_type}, label {label_type}, code string, error long")


def compress(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, vec: str = "embedding"):
    """(codes, codebooks): codes and errors of every vector, and the codebooks (one integer matrix per part).

    ``codes`` has ``vec_id``, ``label``, ``code`` (two hex digits a part) and
    ``error`` (squared distances of the scaled parts, summed).  Codebooks start
    as the parts of the vectors with the smallest ids (equal ids: the smaller
    vector first, null ids last; with fewer vectors, fewer entries).

    Vectors that are null, empty, or hold null, non-finite or too large
    components (2**27 / 4096 or more) are left out, and so are vectors of another
    length than the one with the smallest id.  Parts are as equal as the length
    allows.  A missing ``label`` column counts as null; repeated rows count and
    come back as often as they stand; an empty table gives an empty result and
    no codebooks; other columns are ignored, whatever their names.
    """
    if not (1 <= entries <= 256 and parts >= 1):
        raise ValueError("a codebook has 1 to 256 entries")
    kept = materialize(kept_vectors(rows, vec), "cover-vectors")
    books, dims = first_codebooks(kept, entries, parts)
    if books is None:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    trees = grow_trees(kept, dims, parts)
    books, _ = lloyd(trees, books, dims, rounds)
    return encode(trees, books, dims, kept), books


def books_digest(books) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()


def digests(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """Codes with the error summed over equal labels and the codebooks' digest."""
    codes, books = compress(rows, parts, entries, rounds)
    codes = materialize(codes, "cover-codes")
    per = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    # a label may hold a third of the rows and labels may be many: deal each over several tasks
    salts = 16
    per = per.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    same = left["label"].eqNullSafe(per["label"]) & (left["salt"] == per["salt"])
    return left.join(per, same).select("vec_id", "code", "error", "label_error",
                                       F.lit(books_digest(books)).alias("codebooks_sha256"))


def duck_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """DuckDB twin of ``digests`` over the view ``embeddings``: every distance, every round."""
    size = f"(dims // {parts})"
    out = [f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding, len(embedding) AS dims
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
x AS MATERIALIZED (SELECT rid, (i - 1) // {size} AS part, (i - 1) % {size} AS pos, floor(4096 * c::DOUBLE)::BIGINT AS v
  FROM (SELECT rid, dims, unnest(embedding) AS c, generate_subscripts(embedding, 1) AS i FROM k)),
b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, v AS c FROM x WHERE rid <= {entries})"""]
    for r in range(rounds + 1):
        out.append(f"""
a{r} AS MATERIALIZED (SELECT rid, part, min_by(entry, d * {entries} + entry) AS entry, min(d) AS d FROM
  (SELECT rid, part, entry, sum((v - c) * (v - c))::BIGINT AS d FROM x JOIN b{r} USING (part, pos)
   GROUP BY rid, part, entry) GROUP BY rid, part)""")
        if r < rounds:
            out.append(f"""
b{r + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m, c) AS c FROM b{r} LEFT JOIN
  (SELECT part, entry, pos, floor(sum(v)::DOUBLE / count(*))::BIGINT AS m FROM x JOIN a{r} USING (rid, part)
   GROUP BY part, entry, pos) USING (part, entry, pos))""")
    out.append(f"""
e AS MATERIALIZED (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY rid)""")
    return ",".join(out) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
FROM k JOIN e USING (rid)"""
