"""Cases at the edges of the operators' contracts."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docweave.llm import jaccard, langid, packing, quality, warc

A = " ".join(f"alpha{i}" for i in range(80))
B = " ".join(f"beta{i}" for i in range(80))


def test_rows_that_share_an_id_are_told_apart(spark):
    rows = [(1, A, "x"), (1, B, "y"), (None, A, "z"), (None, B + " more", "q"), (None, "other words here", "w"), (2, B, "v"), (3, None, "n"), (3, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row string").repartition(3)
    kept = jaccard.distinct_documents(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[1], rows[4], rows[6], rows[7]], key=str)


def test_lists_of_two_and_of_many_lose_no_link(spark):
    """Chains of sets, each near the next only, whose members share few lists."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:4 * i + 60])) for i in range(80)] + [(200 + i, " ".join(words[4 * i:4 * i + 64])) for i in range(0, 80, 7)]
    from tests.llm.test_groups import python_components
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()} == python_components(rows)


def test_filter_of_ids_lets_all_wanted_through(spark):
    ids = spark.range(0, 5000, 3).select(F.col("id").alias("rep")).unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS rep"))
    for bits in (1 << 16, 1 << 20):
        found = jaccard._ids_filter(ids, bits)
        at = np.array([r[0] for r in ids.select(jaccard._slot("rep", bits)).collect()])
        assert (found[at >> 3] >> (at & 7) & 1).all()
        assert int(np.unpackbits(found).sum()) == len(np.unique(at))


def test_language_of_long_texts_only_is_learned(spark):
    long = [(i, "zyxw vutsr " * 6000 + str(i), "xx") for i in range(8)]
    short = [(100 + i, "the quick brown fox and the dog " * 5 + str(i), "en") for i in range(8)]
    docs = spark.createDataFrame(long + short, "doc_id long, text string, lang string")
    model = langid.learn(docs, max_text_bytes=5000, sample_bytes=20_000)
    assert model["langs"] == ["en", "xx"]
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert all(got[i] == "xx" for i in range(8)) and all(got[100 + i] == "en" for i in range(8))


def test_stop_words_are_asked_only_where_the_list_can_judge(spark):
    russian = " ".join(f"слово{i}" for i in range(120))
    turkish = " ".join(f"gün{i}ğışı" for i in range(120))
    noise = " ".join(f"xkcd{i}" for i in range(120))
    french = " ".join(f"le mot{i} où été{i}" for i in range(60))
    docs = spark.createDataFrame([(1, russian), (2, turkish), (3, noise), (4, french)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality.judge(docs).collect()} == {1: True, 2: True, 3: False, 4: True}


def test_special_strings_have_the_tokenizers_ids():
    path = packing.default_tokenizer()
    encoder, plain = packing.WordEncoder(path), Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> world", "a<|ENDOFTEXT|>b", "<|startoftext|>", "é<|startoftext|>ß x", "no <| special |>", "", "日本<|endoftext|>"]
    want = [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.ids(texts) == want and encoder.ids(texts) == want


def plain_best_fit(lengths, capacity, limit):
    """Open sequences as a list: best fit, the fullest closes."""
    open_, made, out = [], 0, []
    for n in lengths:
        fits = [b for b in open_ if b[0] >= n]
        if fits:
            best = min(b[0] for b in fits)
            b = [b for b in open_ if b[0] == best][-1]
            open_.remove(b)
        else:
            b = [capacity, made]
            made += 1
        out.append((b[1], capacity - b[0]))
        b[0] -= n
        if b[0]:
            if len(open_) == limit:
                fullest = min(x[0] for x in open_)
                open_.remove([x for x in open_ if x[0] == fullest][-1])
            open_.append(b)
    return out


@pytest.mark.parametrize("limit", [1, 4, 64])
def test_bitset_packs_as_a_plain_best_fit(limit):
    rng = np.random.default_rng(limit)
    lengths = rng.integers(1, 101, 3000).tolist() + [100, 1, 99, 100]
    bins = packing.OpenBins(100, limit, 0)
    assert [bins.place(n) for n in lengths] == plain_best_fit(lengths, 100, limit)


def test_archives_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BYTES_PER_FILE", 1 << 18)
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" + "x" * size) for i, size in enumerate([10, 10, 70_000, 70_000, 300_000, 300_001, 0, 80_000])] + [(50, None, None), (51, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    per = {}
    for r in warc.read_archives(spark, path).withColumn("f", F.lit(1)).collect():
        per[r.page_id] = (r.record_type, r.payload_bytes)
    assert len(per) == len(rows) and per[4] == ("response", 300_000 + len("<p>4</p>")) and per[50][0] == "revisit"
    import glob
    import gzip
    for f in glob.glob(f"{path}/responses-*/*.gz"):
        data = gzip.open(f).read()
        assert len(data) < 2 * (1 << 18) or data.count(b"WARC/1.1\r\n") == 1
    assert b"WARC-Date: 2" in gzip.open(glob.glob(f"{path}/responses-07/*.gz")[0]).read()
