import numpy as np
import pytest
from pyspark.sql import functions as F

from corridor.llm import ann
from corridor.llm.queries import op7_ann
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, x, own, q, k):
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    keep = ids != own
    order = np.lexsort((ids[keep], d[keep]))[:k]
    return list(zip(ids[keep][order].tolist(), d[keep][order].tolist()))


def check(rows, got, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    recall = []
    for qid, found in by.items():
        want = brute(ids, x, qid, x[ids == qid][0], k)
        assert [r.rank for r in found] == list(range(1, len(want) + 1))
        for r in found:
            exact = np.sqrt(((x[ids == r.vec_id][0] - x[ids == qid][0]) ** 2).sum())
            assert r.score == pytest.approx(exact, rel=1e-12, abs=1e-12)
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        recall.append(len({r.vec_id for r in found} & {i for i, _ in want}) / len(want))
    return by, float(np.mean(recall))


def data(n=3000, seed=0, dims=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(30, dims)) * 3
    x = (centers[rng.integers(0, 30, n)] + rng.normal(size=(n, dims))).astype(np.float32)
    return [(i, x[i].tolist()) for i in range(n)]


def test_recall_against_brute_force(spark):
    rows = data()
    got = ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    by, recall = check(rows, got)
    assert len(by) == 60 and recall >= 0.95


@pytest.mark.parametrize("copies", [1, 15])
def test_small_leaves_are_topped_up(spark, copies):
    """One visit and leaves of few rows: a query still gets k rows other than those of its own id."""
    rows = [(i, x) for i, x in data(200) for _ in range(copies if i == 7 else 1)]
    used = ann.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    tree = ann.fit_tree(np.array([x for _, x in rows], np.float32).astype(float), 4)
    tree.visits = 1
    index = ann.build_index(used, tree)
    got = ann.search(index, used.where("vec_id % 50 = 7"), tree).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(q, n) for q in (7, 57, 107, 157) for n in range(1, 11)]
    few = ann.search(index, used.where("vec_id = 7"), tree, k=500).collect()
    assert sorted(r.vec_id for r in few) == [i for i in range(200) if i != 7]


def test_common_vector_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    rows = data(400) + [(1000 + i, [1.0] * 16) for i in range(300)]
    got = ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    by, recall = check(rows, got)
    assert recall >= 0.9
    assert [(r.vec_id, r.score) for r in by[1000]] == [(i, 0.0) for i in range(1001, 1011)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, []), (2, [5.0, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("s"))
    got = ann.nearest_neighbours(df, F.col("vec_id") % 2 == 0).orderBy("query_id", "rank").collect()
    zero = [(r.vec_id, r.score) for r in got if r.query_id == 0]
    assert zero == [(1, 0.0), (2, 1.0), (2, 5.0)]
    assert {r.query_id for r in got} == {0, 2}
    assert ann.nearest_neighbours(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    lone = ann.nearest_neighbours(spark.createDataFrame([(0, [1.0])], SCHEMA), F.col("vec_id") % 2 == 0)
    assert lone.count() == 0


def test_query_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    by, recall = check(rows, op7_ann(spark, SF_SMALL).collect())
    assert set(by) == {i for i, _ in rows if i % 100 == 0} and recall >= 0.9
