import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.functions import vectors as vx
from docweave.operators import search


def test_fit_dimension_golden(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<float>")
    r = df.select(vx.fit_dimension("v", 2).alias("a"), vx.fit_dimension("v", 3).alias("b"),
                  vx.fit_dimension("v", 5).alias("c")).first()
    assert r.a == [1.0, 2.0] and r.b == [1.0, 2.0, 3.0] and r.c == [1.0, 2.0, 3.0, 0.0, 0.0]


def test_similarity_functions_match_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=7).astype(np.float32), rng.normal(size=7).astype(np.float32)
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<float>, b array<float>")
    r = df.select(vx.dot("a", "b").alias("d"), vx.cosine("a", "b").alias("c"),
                  vx.euclidean("a", "b").alias("e")).first()
    a64, b64 = a.astype(np.float64), b.astype(np.float64)
    assert r.d == pytest.approx(a64 @ b64)
    assert r.c == pytest.approx(a64 @ b64 / np.linalg.norm(a64) / np.linalg.norm(b64))
    assert r.e == pytest.approx(np.linalg.norm(a64 - b64))


def test_hashed_embedding_unit_norm_and_deterministic(spark):
    df = spark.createDataFrame([(["alpha", "beta", "alpha"],), ([],)], "t array<string>")
    rows = df.select(vx.embed_tokens("t", 16).alias("v")).collect()
    v = np.array(rows[0].v, dtype=np.float64)
    assert len(v) == 16 and abs(np.linalg.norm(v) - 1) < 1e-6
    assert rows[1].v == [0.0] * 16
    again = df.select(vx.embed_tokens("t", 16).alias("v")).collect()
    assert again[0].v == rows[0].v


def _brute(vecs, queries, k, metric):
    out = {}
    for qid, q in queries.items():
        scores = []
        for vid, v in vecs.items():
            if metric == "cosine":
                s = v @ q / (np.linalg.norm(v) * np.linalg.norm(q))
            elif metric == "dot":
                s = v @ q
            else:
                s = -np.linalg.norm(v - q)
            scores.append((-round(s, 6), vid))
        out[qid] = [vid for _, vid in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
@pytest.mark.parametrize("block", [4096, 3])
def test_top_k_matches_brute_force(spark, metric, block):
    rng = np.random.default_rng(7)
    vecs = {i: rng.normal(size=8) for i in range(60)}
    vecs[60] = vecs[3].copy()          # exact tie, broken by id
    queries = {100 + j: rng.normal(size=8) for j in range(7)}
    vdf = spark.createDataFrame([(i, v.tolist()) for i, v in vecs.items()], "id long, values array<double>") \
        .repartition(5)
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in queries.items()], "qid long, values array<double>")
    res = search.top_k(vdf, qdf, k=4, metric=metric, max_broadcast_queries=block).collect()
    got = {}
    for r in sorted(res, key=lambda r: (r.qid, r["rank"])):
        got.setdefault(r.qid, []).append(r.id)
    assert got == _brute(vecs, queries, 4, metric)


def test_top_k_single_and_format(spark):
    vdf = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id long, values array<double>")
    q = spark.createDataFrame([([1.0, 0.0],)], "values array<double>")
    res = search.format_matches(search.top_k_single(vdf, q, k=3, metric="dot")).collect()
    assert [r.id for r in sorted(res, key=lambda r: r["rank"])] == [9, 8, 7]
    assert sorted(res, key=lambda r: r["rank"])[0].score_text == "9.0000"


def test_mean_vectors(spark):
    from docweave.operators.vectorops import mean_vectors
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 5.0])], "g int, v array<double>")
    got = {r.g: r.centroid for r in mean_vectors(df, ["g"], "v").collect()}
    assert got == {1: [2.0, 3.0], 2: [5.0, 5.0]}


def test_plugin_encoder_batches(spark):
    def factory():
        def encode(texts):
            return [[float(len(t)), float(t.count(" "))] for t in texts]
        return encode
    df = spark.createDataFrame([("a b c",), ("",)], "t string")
    got = [r.v for r in df.select(vx.plugin_encoder(factory, 2)("t").alias("v")).collect()]
    assert got == [[5.0, 2.0], [0.0, 0.0]]


def test_search_store_namespace_and_metadata(spark):
    store = spark.createDataFrame(
        [("ns0", "a", [1.0, 0.0], "A"), ("ns0", "b", [0.0, 1.0], "B"), ("ns1", "c", [1.0, 0.1], "C")],
        "namespace string, id string, values array<double>, metadata string")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid int, values array<double>")
    r = search.search_store(store, q, k=1, namespace="ns1", include_metadata=True).first()
    assert (r.id, r.metadata) == ("c", "C")
    r0 = search.search_store(store, q, k=1).first()
    assert r0.id == "a" and "metadata" not in r0.asDict()


def test_empty_inputs_give_empty_results(spark):
    v = spark.createDataFrame([], "id long, values array<double>")
    q = spark.createDataFrame([], "qid long, values array<double>")
    assert search.top_k(v, q).count() == 0
    with pytest.raises(ValueError):
        search.top_k(v, q, k=0)


def test_partial_topk_is_bounded_under_massive_ties(spark):
    # a third of the vectors are the same copy: each partition still ships k rows per query
    import pandas as pd
    from docweave.operators.search import _partial_topk_fn

    class B:  # stand-in for a broadcast variable
        value = ([10, 11], np.array([[1.0, 0.0], [0.0, 1.0]]))

    n = 3000
    vecs = [[1.0, 0.0] if i % 3 == 0 else [0.5, 0.5 + i / n] for i in range(n)]
    pdf = pd.DataFrame({"id": np.arange(n), "values": vecs})
    out = list(_partial_topk_fn(B(), 5, "dot", ["id"], "values", 2)(iter([pdf.iloc[:1700], pdf.iloc[1700:]])))
    res = pd.concat(out)
    assert len(res) == 10
    assert sorted(res[res.qid == 10]["id"]) == [0, 3, 6, 9, 12]      # ties broken by smallest id


def test_mixed_lengths_are_refused_whatever_the_block(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0, 9.0]), ("b", [0.8, 0.6, 0.0])], "id string, values array<double>")
    mixed = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0])], "qid int, values array<double>")
    for block in (1, 4096):
        with pytest.raises(ValueError):
            search.top_k(v, mixed, k=1, max_broadcast_queries=block)
    short = spark.createDataFrame([(1, [1.0, 0.0])], "qid int, values array<double>")
    with pytest.raises(Exception, match="fit them first"):
        search.top_k(v, short, k=1).collect()


def test_null_vectors_match_nothing(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("n", None)], "id string, values array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "qid int, values array<double>")
    assert [(r.qid, r.id) for r in search.top_k(v, q, k=5).collect()] == [(1, "a")]


def test_one_id_in_two_namespaces_keeps_both_metadata(spark):
    st = spark.createDataFrame(
        [("ns0", "a", [1.0, 0.0], "first"), ("ns1", "a", [1.0, 0.0], "second"), ("ns1", "b", [0.0, 1.0], "third")],
        "namespace string, id string, values array<double>, metadata string")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "qid int, values array<double>")
    rows = sorted(search.search_store(st, q, k=2, include_metadata=True).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r.namespace, r.id, r.metadata) for r in rows] == [(1, "ns0", "a", "first"),
                                                                          (2, "ns1", "a", "second")]


def test_vectors_that_are_not_finite_match_nothing(spark):
    nan, inf = float("nan"), float("inf")
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 0.0]), (5, [0.0, 1.0]), (6, None)], "id long, values array<float>")
    qs = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [nan, 0.0]), ("c", [0.0, -inf]), ("d", [None, 1.0])], "qid string, values array<float>")
    got = [(r.qid, r.rank, r.id) for r in search.top_k(vecs, qs, k=5).orderBy("qid", "rank").collect()]
    assert got == [("a", 1, 1), ("a", 2, 5)]
