from docweave.operators import lemmas, profile


def test_profile_first_page_semantics_and_tables(spark):
    docs = spark.createDataFrame([
        (1, "Hello big world\nrow | cell | cell\n"),   # table on page 2
        (2, "   \nscanned text later"),                  # blank first page -> scanned, 0 words
        (3, "one"),
    ], "doc_id long, text string")
    p = {r.doc_id: r for r in profile.profile_documents(docs).collect()}
    assert p[1].is_text_based and p[1].estimated_word_count == 3 and p[1].has_tables
    assert p[1].page_count == 3
    assert p[2].is_scanned and p[2].estimated_word_count == 0 and not p[2].has_tables
    assert not p[3].has_tables and not p[3].has_images          # no table -> False
    s = profile.profile_summary(profile.profile_documents(docs)).first()
    assert (s.total_files, s.text_based, s.scanned, s.with_tables, s.total_words) == (3, 2, 1, 1, 4)
    assert s.mean_words == round(4 / 3, 2)


def test_page_profile_equals_document_profile(spark):
    from docweave.operators.ingest import split_pages
    docs = spark.createDataFrame([(1, "a b\nc | d"), (2, "\nx"), (3, "")], "doc_id long, text string")
    a = {r.doc_id: (r.is_text_based, r.page_count, r.has_tables, r.estimated_word_count)
         for r in profile.profile_documents(docs).collect()}
    b = {r.doc_id: (r.is_text_based, r.page_count, r.has_tables, r.estimated_word_count)
         for r in profile.profile_pages(split_pages(docs)).collect()}
    assert a == b


def test_lemmas_rules_need_dictionary_word(spark):
    docs = spark.createDataFrame([(1, ["boxes", "box", "cats", "cat", "women", "woman", "ponies", "pony",
                                       "glass", "wolves"])], "doc_id long, tokens array<string>")
    table = {r.word: r.lemma for r in lemmas.lemma_table(docs).collect()}
    assert table == {"boxes": "box", "cats": "cat", "women": "woman", "ponies": "pony"}
    out = lemmas.apply_lemmas(docs, lemmas.lemma_table(docs)).first().tokens
    assert out == ["box", "box", "cat", "cat", "woman", "woman", "pony", "pony", "glass", "wolves"]


def test_lemmas_keep_null_tokens_and_rows_of_one_id(spark):
    docs = spark.createDataFrame([(1, ["cats"]), (1, ["dogs", "cat"]), (None, ["cats"]), (2, None), (3, [])],
                                 "doc_id long, tokens array<string>")
    table = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "word string, lemma string")
    got = [(r.doc_id, r.tokens) for r in lemmas.apply_lemmas(docs, table).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, ["cat"]), (1, ["dog", "cat"]), (None, ["cat"]), (2, None), (3, [])], key=str)


def test_exact_percentiles_match_numpy(spark):
    import numpy as np
    from docweave.operators.evaluate import exact_percentiles
    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.normal(size=101)] + [("b", float(x)) for x in rng.integers(0, 5, 40)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: (r.p50, r.p95) for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    for g in ("a", "b"):
        vals = np.array([v for k, v in rows if k == g])
        assert got[g][0] == np.percentile(vals, 50) or abs(got[g][0] - np.percentile(vals, 50)) < 1e-12
        assert abs(got[g][1] - np.percentile(vals, 95)) < 1e-12


def test_exact_percentiles_with_a_hot_value(spark):
    from docweave.operators.evaluate import exact_percentiles
    rows = [("m", 0.0)] * 500 + [("m", float(i)) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    r = exact_percentiles(df, ["g"], "v", {"p50": 0.5}).first()
    import numpy as np
    assert r.p50 == np.percentile([v for _, v in rows], 50)


def test_empty_and_all_stopword_documents_give_no_chunks(spark):
    from docweave.operators import ingest
    docs = spark.createDataFrame([(1, ""), (2, "the and of it"), (3, "real words here")], "doc_id long, text string")
    chunks = ingest.ingest_chunks(docs, 200).collect()
    assert [r.doc_id for r in chunks] == [3]
    q = {r.doc_id: r.status for r in ingest.quarantine(docs).collect()}
    assert q == {1: "error", 2: "error", 3: "ok"}


def _echo_model():
    return lambda prompt: prompt


def _upper_model():
    return lambda prompt: prompt.upper()


def test_answer_plugin_runs_every_case_per_model(spark):
    from pyspark.sql import functions as F

    from docweave.operators.evaluate import accuracy_by_model, run_models
    cases = spark.createDataFrame([(i, f"q{i}", f"q{i}") for i in range(20)], "case_id int, prompt string, expected string")
    runs = run_models(cases, {"echo": _echo_model, "upper": _upper_model})
    rows = runs.collect()
    assert len(rows) == 40
    assert {r.response for r in rows if r.model == "upper"} == {f"Q{i}" for i in range(20)}
    assert all(r.response_time >= 0 for r in rows)
    acc = {r.model: r.accuracy for r in accuracy_by_model(
        runs.withColumn("correct", F.col("response") == F.col("expected"))).collect()}
    assert acc == {"echo": 1.0, "upper": 0.0}
