"""Graph search against exhaustive comparison."""

import numpy as np
import pytest
from llm_data import SMALL, MEDIUM
from pyspark.sql import functions as F

from termweave.llm import graph_search, queries


def brute(rows, picks, k):
    """rows: (vec_id, vector); exact lists for the ids that picks."""
    out = {}
    for qid, q in rows:
        if picks(qid):
            near = sorted((-float(np.dot(q, v)), i) for i, v in rows if i != qid and len(v) == len(q))[:k]
            out[qid] = [(i, -s) for s, i in near]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    assert set(got) == set(want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_query_recall(spark, folder):
    rows = [(r[0], np.array(r[1])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = lists(queries.op13_graph_search(spark, folder))
    assert recall(got, want) >= 0.98 and all(len(v) == 20 for v in got.values())
    vectors = dict(rows)
    for q, v in got.items():
        assert all(abs(s - float(np.dot(vectors[q], vectors[i]))) < 1e-12 for i, s in v)
        assert v == sorted(v, key=lambda x: (-x[1], x[0])) and q not in dict(v)


def test_many_shards_and_uneven_lengths(spark):
    """Inner product, not cosine: long vectors win."""
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 24)) * r.uniform(0.2, 3, size=(1500, 1))
    rows = [(i, v) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = lists(graph_search.neighbours(df, F.col("vec_id") % 20 == 0, shard_rows=400, query_rows=30))
    assert recall(got, brute(rows, lambda i: i % 20 == 0, 20)) >= 0.95


def test_odd_rows(spark):
    """Vectors that take no part, copies beyond a list's length, ties, two widths, few candidates."""
    r = np.random.default_rng(2)
    hot, other = r.normal(size=8), r.normal(size=8)
    rows = [(i, hot) for i in range(0, 300)] + [(i, r.normal(size=8)) for i in range(300, 340)] + [(340, -hot), (360, other)]
    rows += [(400, np.ones(3)), (401, np.ones(3)), (402, np.array([0.0, -1, 0]))]
    odd = [(1000, None), (1020, []), (1040, [0.0] * 8), (1060, [1.0, None] * 4), (1080, [float("nan")] * 8),
           (1100, [float("inf")] * 8), (None, hot.tolist())]
    data = [(i, v.tolist()) for i, v in rows] + [(i, v.tolist()) for i, v in rows[:5]] + odd
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 as h1", "2 as score", "3 as shard", "4 as width", "5 as ids")
    got = lists(graph_search.neighbours(df, F.col("vec_id") % 20 == 0, beam=400))
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_empty_and_single(spark):
    schema = "vec_id long, embedding array<float>"
    assert lists(graph_search.neighbours(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0)) == {}
    assert lists(graph_search.neighbours(spark.createDataFrame([(0, [1.0])], schema), F.col("vec_id") % 20 == 0)) == {}


def test_every_vector_can_be_reached():
    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(size=(300, 6)), 50 + r.normal(size=(5, 6)), 1e-6 * r.normal(size=(300, 6))])
    graph, order = graph_search.build(x, degree=6, beam=16, batch=64)
    found = graph.search(graph.points, len(x))
    assert sorted(order) == list(range(len(x)))
    assert all(set(row) == set(range(len(x))) for row in found[:20])


def test_pruning_keeps_the_nearest_and_diverse_ones():
    line = np.array([[0.0, 0], [1, 0], [2, 0], [0, 3], [9, 0]])
    graph = graph_search.Graph(line.astype(np.float32), np.full((5, 4), -1), 0)
    kept = graph_search.robust_prune(graph, np.array([0]), np.array([[1, 2, 3, 4]]), 4, 1.0)
    assert [i for i in kept[0] if i >= 0] == [1, 3]


def test_a_search_marks_what_it_met(monkeypatch):
    """Nodes met twice in a step are told by marks, not by sorting all that was met."""
    x = np.random.default_rng(5).normal(size=(700, 8))
    graph, order = graph_search.build(x, degree=8, beam=24, batch=64)
    q = np.hstack([x[:40], np.zeros((40, 1))]).astype(np.float32)
    want = np.argsort(-(x[:40] @ x[order].T), 1)[:, :10]

    def none(*args, **kwargs):
        raise AssertionError("np.unique in a search")
    monkeypatch.setattr(np, "unique", none)
    found = graph.search(q, 64)
    assert all(len(set(row)) == 64 for row in found)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(want, found)]) > 0.95
