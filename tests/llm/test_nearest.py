from collections import defaultdict

import numpy as np

from scholmill.llm.nearest import nearest
from scholmill.llm.query_nearest import op1_permutation_index

SCHEMA = "vec_id long, embedding array<float>, entry int, score string"


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in queries:
        s = (x * x[list(ids).index(q)]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), s[j]) for j in order]
    return out


def lists(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_exact_when_all_is_reranked(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 6)) * rng.uniform(0.2, 3, (300, 1))
    x[50:120] = x[50]  # a hot vector, with queries among it
    rows = [(i * 2, [float(np.float32(v)) for v in y]) for i, y in enumerate(x)]
    got = lists(nearest(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), "id % 10 = 0", k=7, pivots=8, posts=8, share=1.0, part_rows=40))
    want = brute(rows, [i for i, _ in rows if i % 10 == 0], 7)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = lists(op1_permutation_index(spark, sf))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) > 0.93


def recall(spark, x, step=50):
    rows = [(i, [float(np.float32(v)) for v in y]) for i, y in enumerate(x)]
    want = brute(rows, range(0, len(rows), step), 20)
    got = lists(nearest(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), f"id % {step} = 0"))
    assert got.keys() == want.keys()
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])


def test_recall_in_a_dense_cluster(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(12_000, 64))
    x[::3] = x[0] + 0.1 * rng.normal(size=(4000, 64))
    assert recall(spark, x / np.sqrt((x * x).sum(1, keepdims=True))) >= 0.9


def test_recall_with_uneven_lengths(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(12_000, 64))
    assert recall(spark, x / np.sqrt((x * x).sum(1, keepdims=True)) * np.exp(0.5 * rng.normal(size=(12_000, 1)))) >= 0.9


def test_recall_of_the_query_without_structure(spark, tmp_path):
    """The registered query on 20,000 vectors without structure, for two ways of dealing them out."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(20_000, 32)).astype(np.float32)
    table = spark.createDataFrame([(i, [float(v) for v in y], 1, "x") for i, y in enumerate(x)], SCHEMA)
    got = []
    for n in (3, 7):
        table.repartition(n, "vec_id").write.parquet(f"{tmp_path}/{n}/embeddings.parquet")
        got.append(lists(op1_permutation_index(spark, f"{tmp_path}/{n}")))
    assert got[0] == got[1] and len(got[0]) == 1000
    x, hits = x.astype(float), 0
    for q in range(0, 20_000, 400):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & {i for i, _ in got[0][q]})
    print("recall", hits / 1000)
    assert hits / 1000 >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [-0.0, 2.0]), (20, [3e38, 3e38]), (40, [])]
    got = lists(nearest(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), "id % 20 = 0"))
    big = float(np.float32(3e38))
    assert got == {0: [(20, big), (1, 1.0), (7, 1.0), (8, 0.0)], 20: [(8, 2 * big), (0, big), (1, big), (7, big)]}
    assert nearest(spark.createDataFrame([], SCHEMA), "id % 20 = 0").collect() == []
    assert nearest(spark.createDataFrame([(0, [1.0], 1, "x")], SCHEMA), "id % 20 = 0").collect() == []
