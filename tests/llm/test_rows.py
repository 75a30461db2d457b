"""Operators that decide row by row or by group sums: quality, mixing, sharding,
packing, token counts - against plain Python."""

import collections
import re
import zlib

import pytest
from pyspark.sql import functions as F

from docweave.llm import mixing, packing, quality, rollup, sharding
from docweave.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"the word{i} of" for i in range(30000))
DOCS = [
    (1, "a b c a b c x", "en", "s1"), (2, None, "en", None), (3, "", None, "s1"), (4, " \t\n", "de", "s2"),
    (5, LONG, "en", "s3"), (6, "one\ntwo\none\n\n \none #$", "en", "s2"), (6, "one\ntwo\none\n\n \none #$", "en", "s2"),
    (7, "the " * 80, "en", "s1"), (8, "é ñ ü " * 30 + "the of and", "fr", ""), (None, "no id here", "en", "s4"),
    (9, " ".join(f"the w{i}" for i in range(60)), "en", "s1"), (10, " ".join(f"w{i}##$" for i in range(60)), "en", "s1"),
]


def python_measures(text):
    s = text or ""
    w = WORD.findall(s)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = collections.Counter(grams)
    cover = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in s.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in s), len(lines) - len(set(lines)), len(cover))


def test_quality_measures_and_verdict(spark, make_documents):
    sf = make_documents(DOCS)
    got = collections.Counter(tuple(r)[:6] for r in quality.op9_quality_rules(spark, sf).collect())
    assert got == collections.Counter((d[0], *python_measures(d[1])) for d in DOCS)
    kept = {r.doc_id: r.kept for r in quality.op9_quality_rules(spark, sf).collect()}
    assert kept[9] and kept[5] and not kept[7] and not kept[2] and not kept[10]
    clash = table(spark, sf, "documents").withColumn("n_words", F.lit("x")).withColumn("Kept", F.lit(1))
    assert quality.judge(clash).columns.count("kept") == 1
    assert quality.kept_documents(spark, table(spark, sf, "documents"), sf).columns == ["doc_id", "text", "lang", "source"]


def python_targets(sizes, cap=3):
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.discard(s)


def test_mixing_targets_and_copies(spark, make_documents):
    rows = [(i, "w " * (i % 7 + 1), "en", f"s{i % 11 if i % 3 else 0}") for i in range(3000)] + DOCS
    sf = make_documents(rows)
    got = mixing.op5_mix_sources(spark, sf).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for d in rows:
        sizes[d[3]] += len(WORD.findall(d[1] or ""))
    want = python_targets(sizes)
    by_id = {}
    for d in rows:
        by_id.setdefault(d[0], set()).add((len(WORD.findall(d[1] or "")), sizes[d[3]], round(want[d[3]], 6)))
    for r in got:
        assert (r["size"], r.source_size, round(r.target, 6)) in by_id[r.doc_id]
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
    assert sorted(map(str, got)) == sorted(map(str, mixing.op5_mix_sources(spark, sf).collect()))
    docs = table(spark, sf, "documents").withColumn("size", F.lit("x")).withColumn("Taken", F.lit("y"))
    mixed = mixing.mix_sources(docs)
    assert mixed.where("copies > 0").agg(F.sum("copies")).first()[0] == mixing.emit_copies(mixed, ["doc_id"]).count()


def test_shards_are_even_gapless_and_complete(spark, make_documents):
    hot = "copy of the same text " * 20
    rows = [(i, hot if i % 3 == 0 else f"text {i} " * (i % 40), "en", "s") for i in range(4000)]
    sf = make_documents(rows + [(77, hot, "en", "s")] * 50 + [(None, None, None, None)])
    got = sharding.op1_histogram_shards(spark, sf).toPandas()
    assert len(got) == len(rows) + 51
    by = got.groupby("shard")
    assert set(got["shard"]) == set(range(16))
    for _, g in by:
        assert sorted(g["slot"]) == list(range(len(g)))
    size = by["size"].sum()
    assert (size.max() - size.min()) <= 0.02 * size.mean() + 2 * got["size"].max()
    text = {i: t for i, t, *_ in rows}
    some = got[got["doc_id"] == 5].iloc[0]
    assert some["size"] == len(text[5].encode()) + 1 and some["text_crc32"] == zlib.crc32(text[5].encode())
    null = got[got["doc_id"].isna()].iloc[0]
    assert (null["size"], null["text_crc32"]) == (1, 0)


@pytest.mark.parametrize("query", [quality.op9_quality_rules, mixing.op5_mix_sources, sharding.op1_histogram_shards,
                                   packing.op10_best_fit_packing])
def test_empty_tables(spark, make_documents, query):
    assert query(spark, make_documents([])).count() == 0


def test_packing_round_trip(spark, make_documents):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    exact = " ".join(["the"] * 4095)  # with the end id exactly one sequence
    odd = [(20, exact, "en", "s"), (21, "café \x1c A B <|endoftext|> don't 漢字", "en", "s")]
    rows = DOCS + odd
    sf = make_documents(rows)
    got = packing.op10_best_fit_packing(spark, sf).toPandas()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for d in rows:
        ids = np.array([*t.encode(d[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[(d[0] if d[0] is not None else -1, k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))] += 1
    got["doc_id"] = got["doc_id"].fillna(-1).astype(int)
    assert collections.Counter(tuple(int(x) for x in r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].values) == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g["offset"]) == list(g["length"].cumsum() - g["length"]) and g["length"].sum() <= 4096


def test_open_bins_best_fit_and_fullest_closes_first():
    bins = packing.OpenBins(10, 2, 0)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)          # best fit, bin 1 is full now
    assert bins.place(5) == (2, 0)          # bins 0 (4 free) and 2 (5 free)
    assert bins.place(8) == (3, 0)          # the fullest, bin 0, closes
    assert bins.place(4) == (2, 5) and bins.place(2) == (3, 8)
    assert bins.place(10) == (4, 0) and bins.open == 1


def test_rollup_batches_are_idempotent(spark, tmp_path):
    schema = "kind string, source string, lang string, version string, tokens long, old_tokens long, extra int"
    frame = lambda *rows: spark.createDataFrame([(*r, 0) for r in rows], schema)
    r = rollup.TokenRollup(spark, str(tmp_path / "counts"))
    assert r.totals().count() == 0
    first = frame(("insert", "a", "en", "v", 5, None), ("insert", "a", "en", "v", 5, None), ("insert", None, None, "v", None, None))
    assert r.commit("1", first) and not r.commit("1", first)
    (tmp_path / "counts/batches/dead").mkdir()  # a batch whose writer died
    r.compact()
    assert not r.commit("1", first)
    assert r.commit("2", frame(("delete", "a", "en", "v", None, 5), ("revise", "a", "en", "v", 9, 5)))
    assert r.commit("dead", frame(("insert", "b", "en", "v", 1, None))) and r.commit("3", frame())
    r.compact()
    r.compact()
    assert {tuple(x) for x in r.totals().collect()} == {("a", "en", "v", 1, 9), (None, None, "v", 1, 0), ("b", "en", "v", 1, 1)}
    with pytest.raises(Exception, match="unknown kind"):
        r.commit("4", frame(("upsert", "a", "en", "v", 1, None)))
    with pytest.raises(ValueError):
        r.commit("../x", first)
