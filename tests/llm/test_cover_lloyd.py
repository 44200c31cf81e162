import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from homeledger.llm import cover_lloyd as C
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """{(vec_id, vector): (code, error, label_error)} and the codebooks' digest, in plain integers."""
    kept = [(i, label, [math.floor(4096 * x) for x in v]) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * size:(p + 1) * size]
    books = [[cut(v, p) for _, _, v in kept[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (dist(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            codes = [nearest(v, p) for _, _, v in kept]
            book = []
            for e, old in enumerate(books[p]):
                own = [cut(v, p) for (_, _, v), c in zip(kept, codes) if c == e]
                book.append([sum(x) // len(own) for x in zip(*own)] if own else old)
            new.append(book)
        books = new
    out, per = [], {}
    for i, label, v in kept:
        codes = [nearest(v, p) for p in range(parts)]
        error = sum(dist(cut(v, p), books[p][c]) for p, c in enumerate(codes))
        per[label] = per.get(label, 0) + error
        out.append((i, label, "".join(f"{c:02x}" for c in codes), error))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, c, e, per[label], hashlib.sha256(text.encode()).hexdigest()) for i, label, c, e in out), key=repr)


def got(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def random_rows(seed, n, dims=16, grid=None):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (5, dims))
    v = centres[rng.integers(0, 5, n)] + rng.normal(0, 0.05, (n, dims))
    if grid:  # few values: many equal parts and equal distances
        v = np.round(v * grid) / grid
    label = [None if k % 9 == 0 else int(k % 3) for k in range(n)]
    return [(int(i), [float(x) for x in row], lab) for i, row, lab in zip(rng.permutation(n), v, label)]


@pytest.mark.parametrize("n, dims, spread", [(1, 3, 5), (30, 8, 50), (2000, 8, 300), (1500, 2, 3), (900, 8, 0), (700, 1, 10_000)])
def test_tree_covers_its_points_and_assigns_like_brute_force(n, dims, spread):
    rng = np.random.default_rng(n)
    points = rng.integers(-spread, spread + 1, (n, dims)) + rng.integers(0, 4, (n, 1)) * 400
    tree = C.build_tree(points)
    assert sorted(tree["order"]) == list(range(n))
    own = points[tree["order"]]
    for k in range(len(tree["lo"])):
        below = own[tree["lo"][k]:tree["hi"][k]]
        assert len(below) and np.sqrt(((below - tree["centre"][k]) ** 2).sum(axis=1).max()) <= tree["rho"][k]
        a, b = tree["first"][k], tree["last"][k]
        if a < b:  # children share out the points, at most half as far, at least half a radius apart
            assert tree["lo"][a] == tree["lo"][k] and tree["hi"][b - 1] == tree["hi"][k]
            assert (tree["hi"][a:b - 1] == tree["lo"][a + 1:b]).all()
            assert (tree["rho"][a:b] <= tree["rho"][k] / 2 * (1 + 1e-12)).all()
            gap = np.sqrt(((tree["centre"][a:b, None] - tree["centre"][None, a:b]) ** 2).sum(axis=2))
            assert gap[~np.eye(b - a, dtype=bool)].min() > tree["rho"][k] / 2 * (1 - 1e-12)
        else:
            assert len(below) <= C.LEAF or tree["rho"][k] == 0
    for m in (1, 2, 16):
        book = points[rng.integers(0, n, m)] + rng.integers(-1, 2, (m, dims))
        book[m // 2] = book[0]  # equal entries: the lower index wins
        code, sums, count, _ = C.assign(tree, points, book)
        want = C.squared(points, book).argmin(axis=1)
        assert (code == want[tree["order"]]).all()
        assert (count == np.bincount(want, minlength=m)).all()
        assert (sums == [points[want == e].sum(axis=0) for e in range(m)]).all()


def test_whole_subtrees_are_assigned():
    rng = np.random.default_rng(1)
    points = (rng.integers(0, 16, (8000, 1)) * 1000 + rng.integers(0, 40, (8000, 8))).astype(np.int64)
    book = np.repeat(np.arange(16)[:, None] * 1000, 8, axis=1)
    assert C.assign(C.build_tree(points), points, book)[3] < 8000 * 16 / 20


@pytest.mark.parametrize("seed, grid", [(1, None), (2, 8), (3, 2)])
def test_against_plain_integers(spark, monkeypatch, seed, grid):
    monkeypatch.setattr(C, "GROUP_ROWS", 64)
    rows = random_rows(seed, 400, grid=grid)
    rows += [(500 + k, *rows[7][1:]) for k in range(30)]
    assert got(C.digests(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_awkward_rows(spark):
    rows = random_rows(5, 40)
    odd = [(None, rows[0][1], None), (3, rows[1][1], 1), (3, rows[1][1], 1), (1000, None, 1), (1001, [], 1),
           (1002, [None] + rows[0][1][1:], 1), (1003, [float("nan")] + rows[0][1][1:], 2),
           (1004, [float("inf")] + rows[0][1][1:], 2), (-5, [float("-inf")] * 16, 2), (1005, [0.0] * 16, 0)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    assert got(C.digests(df)) == brute(rows + odd)
    clash = df.select("*", *[F.lit("x").alias(c) for c in ("v", "code", "error", "salt", "part", "entry", "ids", "n")])
    assert got(C.digests(clash)) == got(C.digests(df))
    few = [r for r in rows if r[0] < 5]
    assert got(C.digests(spark.createDataFrame(few, SCHEMA))) == brute(few)
    codes, books = C.compress(df.where("vec_id = 1000"))
    assert codes.count() == 0 and books == [] and codes.columns == ["vec_id", "label", "code", "error"]
    assert C.digests(df.where("vec_id = 1000")).count() == 0
    # left out: another length than the first's, and components whose squares would overflow
    more = df.unionByName(spark.createDataFrame([(7000, [0.5] * 8, 1), (7001, [1e30] * 16, 1)], SCHEMA))
    assert got(C.digests(more)) == got(C.digests(df))
    assert {r["label"] for r in C.compress(df.drop("label"))[0].select("label").distinct().collect()} == {None}


def test_query_matches_sql(spark):
    import __spark_entry__ as E
    from homeledger.plans.oracle_check import compare, duck_connection

    key = "op13_cover_lloyd"
    why = compare(E.queries()[key](spark, SF_SMALL).toPandas(),
                  duck_connection(SF_SMALL).execute(E.oracle_sql()[key]).df())
    assert why is None, why
