"""Criteria, case summaries and searches by encoder against values worked out by hand,
and the golden summary of the profile sample."""
import pytest
from pyspark.sql import functions as F

from docweave.functions import vectors as vx
from docweave.operators import evaluate as E
from docweave.operators import ingest, lemmas, search

PAIR = "conv_id long, turn long, question string, response string"


def test_token_overlap_counts_repeats(spark):
    pairs = spark.createDataFrame([(1, 0, "red red blue", "Red, red red!"), (1, 2, "one two", "three"), (2, 0, "", None)], PAIR)
    got = {(r.conv_id, r.turn): (r.n_question, r.n_response, r.n_shared) for r in E.token_overlap(pairs, ["conv_id", "turn"]).collect()}
    assert got == {(1, 0): (3, 3, 2), (1, 2): (2, 1, 0)}


def test_case_summary(spark):
    pairs = spark.createDataFrame([(1, 0, "red red blue?", "Red, red red!"), (2, 0, "red  blue?", "Red blue"), (3, 0, "one two", "three"),
                                   (4, 0, "", None)], PAIR)
    kind = F.when(F.col("question").contains("?"), "question").otherwise("other")
    got = {r.case_type: tuple(r)[1:] for r in E.case_summary(pairs, kind).collect()}
    assert got["other"] == (2, 0.0, 0.0, 0.0, 0.0, 1.0)
    n, exact, precision, recall, f1, low = got["question"]
    assert (n, low) == (2, 0.0) and precision == recall == f1 == round((2 / 3 + 1) / 2, 6) and exact in (0.0, 0.5)
    assert E.case_summary(pairs.limit(0), kind).count() == 0


@pytest.mark.parametrize("good", [True, False])
def test_success_criteria_both_outcomes(spark, good):
    bad = [] if good else [("c", None)]
    nodes = spark.createDataFrame([("a", "first"), ("b", "second")] + bad, "id string, definition string")
    edges = spark.createDataFrame([("a", "b", "p")] + ([] if good else [("a", "x", "p")]), "src string, dst string, type string")
    runs = spark.createDataFrame([("own", "d", True), ("other", "d", good), ("own", "r", True), ("other", "r", good)],
                                 "model string, query_type string, correct boolean")
    times = spark.createDataFrame([("own", 1.0 if good else 2.0), ("other", 9.0)], "model string, response_time double")
    calls = spark.createDataFrame([(True,)] * 19 + [(False,)] * (1 if good else 2), "ok boolean")
    rows = E.success_criteria(nodes, edges, runs, times, calls, "own", "other", ["d"], ["r"], "own").collect()
    assert [r.criterion for r in rows] == [c[0] for c in E.CRITERIA]
    assert all(r.met == good for r in rows)
    want = {"concept_coverage": 0.666667, "isolated_nodes": 1.0, "verified_relationships": 0.5, "definition_gap": 1.0,
            "relationship_gap": 1.0, "mean_response_s": 2.0, "uptime": 0.904762}
    if not good:
        assert {r.criterion: r.value for r in rows} == want


def test_criteria_without_rows_are_not_met(spark):
    none = lambda ddl: spark.createDataFrame([], ddl)
    rows = E.success_criteria(none("id string, definition string"), none("src string, dst string, type string"),
                              none("model string, query_type string, correct boolean"), none("model string, response_time double"),
                              none("ok boolean"), "own", "other", ["d"], ["r"], "own").collect()
    assert {r.criterion for r in rows if r.met} == {"isolated_nodes"}   # there is none
    assert sum(r.value is None for r in rows) == 6


def test_search_keeps_encoders_apart(spark):
    store = spark.createDataFrame([("a", [1.0, 0.0], "x"), ("b", [1.0, 0.0], "y"), ("c", [0.6, 0.8], "x"), ("d", [1.0, 0.0, 0.0], "z"),
                                   ("e", [1.0, 0.0], None)], "id string, values array<double>, encoder string")
    asked = lambda *rows: spark.createDataFrame(rows, "qid string, values array<double>, encoder string")
    got = search.top_k_by_encoder(store, asked(("p", [1.0, 0.0], "x"), ("q", [0.0, 1.0], "y"), ("r", [1.0, 0.0, 0.0], "z")), k=5)
    assert sorted((r.encoder, r.qid, r["rank"], r.id) for r in got.collect()) == [
        ("x", "p", 1, "a"), ("x", "p", 2, "c"), ("y", "q", 1, "b"), ("z", "r", 1, "d")]
    for encoder in ("unknown", None):
        with pytest.raises(ValueError, match="no vector comes from"):
            search.top_k_by_encoder(store, asked(("p", [1.0, 0.0], encoder)))
    assert search.top_k_by_encoder(store, asked()).count() == 0


def test_encoder_names_say_what_differs(spark):
    df = spark.createDataFrame([("alpha beta",)], "chunk_text string")
    name = lambda **kw: ingest.embed_texts(df, encoder_col="encoder", **kw).first().encoder
    assert name() == vx.encoder_name() == "hashed-md5-64"
    assert len({name(), name(dim=32), name(max_tokens=512)}) == 3


def test_questions_get_the_documents_lemmas(spark):
    docs = spark.createDataFrame([(1, "cats chase cat"), (2, "dogs sleep")], "doc_id long, text string")
    out, table = lemmas.lemmatized_with_table(docs)
    assert {(r.word, r.lemma) for r in table.collect()} == {("cats", "cat")}   # "dog" is no word of theirs
    assert {r.doc_id: r.tokens for r in out.collect()} == {1: ["cat", "chase", "cat"], 2: ["dogs", "sleep"]}
    asked = ingest.with_tokens(spark.createDataFrame([(7, "Cats, dogs")], "item_id long, text string")).select("item_id", "tokens")
    assert lemmas.apply_lemmas(asked, table, id_col="item_id").first().tokens == ["cat", "dogs"]
