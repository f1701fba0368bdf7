import numpy as np

from marlstone.llm.forest import neighbours, op4_prefix_forest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, q in good:
        if i in queries:
            scored = sorted((-float((x * q).sum()), j) for j, x in good if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def test_recall_on_test_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    got = op4_prefix_forest(spark, "/root/testdata/sf0.1").collect()
    pairs = {(r.query_id, r.vec_id): r.score for r in got}
    hits = sum((q, j) in pairs for q, found in want.items() for j, _ in found)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {(q, j): s for q, found in want.items() for j, s in found}
    assert all(abs(pairs[p] - exact[p]) < 1e-12 for p in exact if p in pairs)
    assert len(got) == 20 * len(want) and {r.rank for r in got} == set(range(1, 21))


def test_odd_rows_ties_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [float("nan"), 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, [float("inf"), 0.0])]
    table = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in neighbours(table, table.where("vec_id % 20 = 0"), 2, least=1.0).collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, -1.0)]
    assert neighbours(table.limit(0), table.limit(0), 2).count() == 0


def test_cells_and_hot_vectors_with_all_candidates_are_exact(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(8).astype(np.float32).tolist()) for i in range(300)] + [(i, [1.0] * 8) for i in range(300, 500)]
    table = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    got = neighbours(table, table.where("vec_id % 20 = 0"), 8, cell=60, least=1.0).orderBy("query_id", "rank").collect()
    for q, found in want.items():
        own = [x for x in got if x.query_id == q]
        assert [x.vec_id for x in own] == [j for j, _ in found]


def _recall(spark, x, k=10):
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = {i for i in range(len(x)) if i % 50 == 0}
    want = brute(rows, queries, k)
    got = {(r.query_id, r.vec_id) for r in neighbours(table, table.where("vec_id % 50 = 0"), x.shape[1], k=k).collect()}
    return sum((q, j) in got for q, f in want.items() for j, _ in f) / (k * len(want))


def test_recall_with_unequal_lengths_and_clusters(spark):
    r = np.random.default_rng(5)
    plain = r.standard_normal((3000, 32)) * np.exp(r.standard_normal((3000, 1)))
    assert _recall(spark, plain) >= 0.9
    centres = 4 * r.standard_normal((60, 32))
    assert _recall(spark, centres[r.integers(0, 60, 3000)] + 0.5 * r.standard_normal((3000, 32))) >= 0.9


def test_clustered_vectors_need_a_small_share():
    from marlstone.llm.forest import BITS, TREES, share_for

    r = np.random.default_rng(6)
    centres = 4 * r.standard_normal((100, 32))
    x = centres[np.repeat(np.arange(100), 30)] + 0.3 * r.standard_normal((3000, 32))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    ids = np.arange(3000)
    assert share_for(ids, x, ids[::60], x[::60], 10, TREES, BITS) <= 0.05
    y = r.standard_normal((3000, 64))
    assert share_for(ids, y, ids[::60], y[::60], 10, TREES, BITS) >= 0.2


def test_queries_over_large_shares_are_cheap_and_exact():
    import time

    from marlstone.llm.forest import BITS, TREES, Forest

    r = np.random.default_rng(9)
    x = r.standard_normal((12_000, 64))
    x[5000:5100] = x[40]  # ties
    ids = r.permutation(12_000)
    forest, q = Forest(ids, x, TREES, BITS), x[:128]
    began = time.perf_counter()
    plain = [(x * v).sum(axis=1) for v in np.concatenate([q, q[:64]])]
    limit, began = time.perf_counter() - began, time.perf_counter()
    got = list(forest.nearest(ids[:128], q, 20, 5000))
    assert time.perf_counter() - began < limit and len(plain) == 192
    for i, rows in list(enumerate(forest.candidates(q, 5000)))[::8]:
        assert len(rows) >= 5000
        rows = rows[rows != i]
        exact = (x[rows] * q[i]).sum(axis=1)
        order = np.lexsort((ids[rows], -exact))[:20]
        assert got[i][1].tolist() == ids[rows][order].tolist() and got[i][2].tolist() == exact[order].tolist()
