"""Tiled search against the plain one, which is held against brute force elsewhere."""
import numpy as np
import pandas as pd
import pytest

from docweave.operators import search, tiled

VEC = "id long, values array<double>"


def data(spark, seed=3, n=600, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 5
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.1
    x[50:90] = x[50]                       # equal vectors: ties by id
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(9001, None), (9002, [float("nan")] * dim), (9003, [0.0] * dim)]
    queries = [(i, [float(a) for a in x[i * 7] + 0.01]) for i in range(40)] + [(99, [0.0] * dim), (100, None), (101, [float(a) for a in x[50]])]
    return spark.createDataFrame(rows, VEC), spark.createDataFrame(queries, "qid long, values array<double>")


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_equals_plain_search(spark, monkeypatch, metric):
    monkeypatch.setattr(tiled, "PIECE", 40)
    monkeypatch.setattr(tiled, "QUERY_PART", 10)
    v, q = data(spark)
    index = tiled.build(v, metric, pivots=24)
    got, met = tiled.top_k(index, q, 5)
    want = search.top_k(v, q, 5, metric)
    rows = lambda d: sorted((r.qid, r.rank, r.id, round(r.score, 7)) for r in d.collect())
    assert rows(got) == rows(want)
    met = {r.folder: r.n_queries for r in met.collect()}
    if metric == "euclidean":   # clustered vectors: most of the pairs of query and folder are ruled out
        assert sum(met.values()) < 0.5 * 42 * (index.counts > 0).sum()


def test_queries_leave_in_frames_of_bounded_size():
    """However many queries a batch has, one frame holds at most _MAX_CELLS values of their vectors."""
    rng = np.random.default_rng(4)
    folders, dim, n = 64, 64, 3000
    index = tiled.Index("", "cosine", ["id"], "values", dim, tiled._unit(rng.normal(size=(folders, dim))), np.full(folders, 7), np.full(folders, 2.0))
    q = pd.DataFrame({"qid": np.arange(n), "qv": list(rng.normal(size=(n, dim))), "kth": np.full(n, -1e18)})
    frames = list(tiled._folders(index, 5, False)(iter([q])))
    assert max(len(f) for f in frames) * dim <= search._MAX_CELLS
    met = pd.concat(frames)
    assert len(met) == n * (folders - 1) and met.groupby("qid").folder.nunique().eq(folders - 1).all()   # all but the opening one


def test_few_vectors_and_refusals(spark):
    v, q = data(spark)
    assert tiled.build(v.limit(0)) is None
    few = v.where("id < 3")
    index = tiled.build(few, "cosine")
    got, _ = tiled.top_k(index, q, 5)
    assert got.where("qid = 0").count() == 3
    assert tiled.top_k(index, q.limit(0), 5)[0].count() == 0
    with pytest.raises(ValueError):
        tiled.top_k(index, q, 0)
    with pytest.raises(ValueError):
        tiled.top_k(index, spark.createDataFrame([(1, [1.0])], "qid long, values array<double>"), 5)
    with pytest.raises(ValueError):
        tiled.build(few.unionByName(spark.createDataFrame([(7, [1.0])], VEC)))


def test_unneeded_folders_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(tiled, "PIECE", 50)
    v, q = data(spark)
    index = tiled.build(v, "euclidean", pivots=24)
    _, met = tiled.top_k(index, q.where("qid = 101"), 3)
    assert met.count() < (index.counts > 0).sum()
