import numpy as np
from pyspark.sql import functions as F

from homeledger.llm import pigeonhole as P
from homeledger.llm.queries import op6_pigeonhole_join
from tests.llm.helpers import SF, rows_of


def brute(rows, cosine=0.98):
    """{row number: (links, smallest id reachable)} of (vec_id, embedding, label)."""
    n = len(rows)
    vec = [np.asarray(e, float) if e is not None and None not in list(e) else None for _, e, _ in rows]
    sound = [v is not None and len(v) and np.isfinite(v).all() and (v != 0).any() and rows[i][2] is not None
             for i, v in enumerate(vec)]
    vec = [v / np.abs(v).max() if s else v for v, s in zip(vec, sound)]
    links = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if sound[i] and sound[j] and rows[i][2] == rows[j][2] and len(vec[i]) == len(vec[j]):
                if vec[i] @ vec[j] / np.sqrt((vec[i] @ vec[i]) * (vec[j] @ vec[j])) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    out, seen = {}, set()
    for i in range(n):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                more = links[todo.pop()] - group
                group |= more
                todo += more
            seen |= group
            ids = [rows[k][0] for k in group if rows[k][0] is not None]
            for k in group:
                out[k] = (len(links[k]), min(ids) if ids else None)
    return [(rows[k][0], *out[k]) for k in range(n)]


def compare(spark, rows, kind="array<double>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int")
    got = P.near_duplicates(df)
    assert sorted(map(repr, ((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()))) == \
        sorted(map(repr, brute(rows)))
    return got


def near(rng, v, cosine):
    w = rng.standard_normal(len(v))
    w -= (w @ v) / (v @ v) * v
    w /= np.linalg.norm(w)
    return (cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine ** 2) * w) * rng.uniform(0.1, 9)


def test_planted_neighbours_at_the_edge(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(60):
        v = rng.standard_normal(64)
        rows.append((len(rows), v.tolist(), k % 3))
        for c in (0.9799, 0.97999, 0.98001, 0.9801, 0.99, 0.9999):
            rows.append((len(rows), near(rng, v, c).tolist(), k % 3 if k % 7 else (k + 1) % 3))
    chain = rng.standard_normal(64)
    for _ in range(20):
        rows.append((len(rows), chain.tolist(), 1))
        chain = near(rng, chain, 0.985)
    compare(spark, rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1.0, 0.01], 0),
            (11, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (None, [0.0, 1.0], 0), (12, [-1.0, 0.0], 0),
            (13, [1e-200, 0.0], 0), (17, [1e200, 0.0], 0), (18, [1e200, 1e200], 0), (19, [1e-310, 1e-310], 0), (14, [3.0], 1), (15, [4.0], 1), (16, [1.0, 0.0], 1)]
    got = compare(spark, rows)
    assert got.where("vec_id = 1 AND kept AND n_links = 0 AND component_id = 1").count() == 1
    more = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "*", *[F.lit("x").alias(c) for c in ("norm", "rep", "key", "rid", "root", "u", "c0")])
    assert rows_of(P.near_duplicates(more)) == rows_of(got)
    assert P.near_duplicates(more.where("vec_id = 99")).count() == 0


def test_registered_sql(spark):
    import __spark_entry__ as E
    from homeledger.plans.oracle_check import compare as same
    from homeledger.plans.oracle_check import duck_connection

    why = same(op6_pigeonhole_join(spark, SF).toPandas(), duck_connection(SF).execute(E.oracle_sql()["op6_pigeonhole_join"]).df())
    assert why is None, why


def test_hot_copies_and_whole_table(spark):
    rng = np.random.default_rng(2)
    hot = rng.standard_normal(64).astype("float32").tolist()
    rows = [(k, hot, 0) for k in range(80)] + [(100 + k, near(rng, np.asarray(hot), 0.99).tolist(), 0) for k in range(20)]
    compare(spark, rows)
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = op6_pigeonhole_join(spark, SF).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute(table))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_every_near_pair_meets_in_a_block():
    """Pigeonhole with visits: home and visiting cells of a near pair coincide in some block."""
    rng = np.random.default_rng(8)
    budget = 2 - 2 * 0.98 + 1e-9
    for dims in (3, 8, 15, 64):
        v = rng.standard_normal((50, dims))
        w = np.stack([near(rng, x, 0.98) for x in v])
        both = np.concatenate([v, w])
        both /= np.linalg.norm(both, axis=1, keepdims=True)
        home, visit = {}, {}
        for ids, b, key, at_home, _, _ in P.block_rows(both, np.arange(100), budget):
            for i, k, h in zip(ids.tolist(), key.tolist(), at_home.tolist()):
                (home if h else visit).setdefault((b, k), set()).add(i)
        for i in range(50):
            met = any(i in own and i + 50 in own or i in own and i + 50 in visit.get(c, ())
                      or i + 50 in own and i in visit.get(c, ()) for c, own in home.items())
            assert met, (dims, i)
