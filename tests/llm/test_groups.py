"""Operators on pairs, archives, conversations and languages against brute force."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import chat, jaccard, langid, shingles, vectors, warc
from docweave.llm.components import connected_components
from docweave.llm.common import table
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(items, links):
    up = {x: x for x in items}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in items}


def python_shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def python_components(rows):
    sets = {i: python_shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    top = roots(ids, links)
    return {i: (len(sets[i]), top[i]) for i in ids}


def near_copies(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    passage = [rnd.choice(words) for _ in range(60)]
    base = [rnd.choice(words) for _ in range(120)]
    rows = []
    for i in range(n):
        if i % 3 == 0:  # copies of one text with a few words changed, at and around the threshold
            t = list(base)
            for _ in range(rnd.randrange(6)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
        elif i % 3 == 1:  # a shared passage in texts of their own
            t = [rnd.choice(words) for _ in range(rnd.randrange(5, 80))] + passage
        else:  # short sets, many alike
            t = [f"x{rnd.randrange(3)}" if rnd.random() < 0.05 else f"y{k}" for k in range(rnd.randrange(1, 14))]
        rows.append((i, " ".join(t)))
    return rows


@pytest.mark.parametrize("pairs_of_a_list, boundary", [(2000, None), (0, None), (2000, 0), (5, 64)])
def test_jaccard_components(spark, monkeypatch, pairs_of_a_list, boundary):
    """The same links whether lists are compared pair by pair or in tiles, and wherever the boundary lies."""
    monkeypatch.setattr(jaccard, "PAIRS_OF_A_LIST", pairs_of_a_list)
    monkeypatch.setattr(jaccard, "TILE_SETS", 40)
    monkeypatch.setattr(jaccard, "REPEATS", 2)
    if boundary is not None:
        monkeypatch.setattr(jaccard, "choose_boundary", lambda *a: boundary)
    rows = near_copies(3, 240) + [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "É two"), (906, "é two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sid", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == python_components(rows)


def test_jaccard_null_ids_repeats_and_empty(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (None, "other words of its own here")], "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in jaccard.jaccard_components(docs).collect())
    assert got == {(None, 4, 5): 1, (5, 4, 5): 2, (None, 2, None): 1}
    assert jaccard.jaccard_components(docs.where("false")).count() == 0
    rows = [(1, text, "x"), (2, text, "y"), (1, text, "x"), (None, text, "z")]
    kept = jaccard.distinct_documents(spark, spark.createDataFrame(rows, "doc_id long, text string, sid string"), "")
    assert [r.doc_id for r in kept.collect()] == [1]  # the row without an id is a copy as well


def test_shingles_of_very_long_texts(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = shingles.shingle_set(text)
    monkeypatch.setattr(shingles, "PIECE", 1000)
    monkeypatch.setattr(shingles, "_POW", [])
    assert (shingles.shingle_set(text) == whole).all() and len(whole) == 977


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_shingles_of_words_longer_than_a_piece(monkeypatch, piece):
    long = "ab" * 150
    texts = [long, f"one {long} two", f"{long} x", f" {long}  {long}c", "a" * 64 + " b", "a" * 63 + " b", f"x {'é' * 70}\n", "\t" * 90 + long]
    whole = [shingles.word_hashes(t) for t in texts]
    monkeypatch.setattr(shingles, "PIECE", piece)
    monkeypatch.setattr(shingles, "_POW", [])
    for t, w in zip(texts, whole, strict=True):
        got = shingles.word_hashes(t)
        assert len(got) == len(WORD.findall(t)) and got.tolist() == w.tolist()
    a, b = (set(shingles.shingle_set("y" * 1000 + end).tolist()) for end in "pq")
    assert len(a) == len(b) == 1 and not a & b


def test_sketch_bounds_the_overlap():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rnd.integers(0, 1 << 64, rnd.integers(1, 900), dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate((b, a[:rnd.integers(0, len(a) + 1)])))
        most = shingles.overlap_bound(*(np.frombuffer(shingles.sketch(x), np.uint8) for x in (a, b)))
        assert len(np.intersect1d(a, b)) <= most <= min(len(a), len(b))


def test_sets_and_sketches_are_moved_small(spark):
    """A set is moved as its compressed text where that is shorter, a sketch in half bytes; both come back whole."""
    rnd = np.random.default_rng(2)
    words = ["".join(chr(97 + c) for c in rnd.integers(0, 26, rnd.integers(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(words[w] for w in rnd.integers(0, 400, rnd.integers(1, 600)))) for i in range(60)] + [(60, "a " * 5000), (61, "é Ü"), (62, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {jaccard.class_id(s): s for s in (shingles.shingle_set(t) for _, t in rows) if len(s)}
    classes = spark.createDataFrame([(jaccard.class_id(s), i) for i, t in rows if len(s := shingles.shingle_set(t))], "sid long, rep long")
    got = {r.sid: bytes(r.set) for r in jaccard.sets_of(docs, classes.select("sid"), classes, "doc_id", "text").collect()}
    assert {k: shingles.unpack_set(v).tolist() for k, v in got.items()} == {k: s.tolist() for k, s in want.items()}
    assert 2 * sum(map(len, got.values())) < sum(s.nbytes for s in want.values())
    assert all(len(v) <= s.nbytes + 1 for v, s in ((got[k], s) for k, s in want.items()))
    for s in [*want.values(), np.arange(1, 41, dtype=np.uint64), np.arange(1, 400, dtype=np.uint64)]:   # the last two crowd one range
        plain = shingles.sketch(s)
        moved = shingles.pack_sketch(plain)
        assert shingles.unpack_sketch(moved).tolist() == list(plain) and len(moved) <= len(plain) + 1
    assert len(shingles.pack_sketch(shingles.sketch(rnd.integers(0, 1 << 64, 500, dtype=np.uint64)))) == 65


def test_connected_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == roots({x for e in real for x in e}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("tile", [16, 2048])
def test_vector_near_duplicates(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    monkeypatch.setattr(vectors, "VISIT", 2)
    monkeypatch.setattr(vectors, "BLOCK", 10)
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=(40, 24))
    v = [list(map(float, base[i % 40] + rnd.normal(size=24) * 0.2 * (i % 4))) for i in range(200)]
    v += [v[0], v[0], [2 * x for x in v[0]], None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [float("inf")] * 24, [1.0, 0.0], [1.0, 0.001]]
    rows = [(i, x) for i, x in enumerate(v)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicate_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("x"))).collect()}
    fine = [(i, np.array(x)) for i, x in rows if x and None not in x and np.isfinite(x).all() and np.any(x)]
    links = [(i, j) for k, (i, x) in enumerate(fine) for j, y in fine[k + 1:]
             if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95]
    top, n = roots(range(len(rows)), links), collections.Counter(i for e in links for i in e)
    assert got == {i: (n[i], top[i], top[i] == i) for i in range(len(rows))}
    assert vectors.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vector_blocks_hold_no_more_than_their_pairs():
    rnd = np.random.default_rng(6)
    raw = rnd.normal(size=12) + rnd.normal(size=(2500, 12)) * 0.01  # all near, none equal
    unit = vectors.units(raw)
    found = vectors.linked(unit, unit, 0.95, True)
    assert not isinstance(found, tuple)  # one block after another
    sizes = [len(p) for p, _ in found]
    assert sum(sizes) == 2500 * 2499 // 2 and max(sizes) <= vectors.BLOCK ** 2
    links, root = vectors.unit_links(unit, unit, np.full(2500, 2), np.arange(2500) < 700, True, 0.95)
    assert (links[:700] == 2 * 2499).all() and (links[700:] == 2 * 700).all() and not root.any()


def test_vector_units_do_not_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 16)
    monkeypatch.setattr(vectors, "VISIT", 2)
    monkeypatch.setattr(vectors, "MAX_TILES", 2)
    rnd = np.random.default_rng(7)
    base = rnd.normal(size=(4, 10))
    rows = [(i, list(map(float, base[i % 4] + rnd.normal(size=10) * (0.02 if i % 8 else 0.6)))) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, classes = vectors.classes_of(df, "vec_id", "embedding")
    work = vectors.work_units(classes, 10, 400, 0.95)[0].groupBy("tile", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("home") == F.col("tile")).cast("int")).alias("own")).collect()
    assert max(r.own for r in work) <= 3 * 16 and max(r.n for r in work) <= 3 * 3 * 16
    unit = vectors.units(np.array([v for _, v in rows]))
    links = np.argwhere(np.triu(unit @ unit.T >= 0.95, 1)).tolist()
    top, n = roots(range(400), links), collections.Counter(i for e in links for i in e)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicate_vectors(df).collect()}
    assert len(links) > 10000 and got == {i: (n[i], top[i]) for i in range(400)}


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "u", "same"), (9, "u\r\nX: y", "same"), (4, None, "same"), (2, "u", None), (3, "u", ""), (5, "u", tricky),
            (6, "u", "é" * 70000), (7, "u", "twice"), (7, "u", "twice"), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    warc.write_archives(pages, str(tmp_path / "w"))
    got = collections.Counter(tuple(r) for r in warc.resolve_revisits(warc.read_archives(spark, str(tmp_path / "w"))).collect())
    want = collections.Counter()
    for html, n, ids in (("same", 4, [9, 1, 4, None]), (None, 0, [3, 2]), (tricky, len(tricky), [5]), ("é" * 70000, 140000, [6]), ("twice", 5, [7, 7])):
        for k, i in enumerate(ids):
            want[(i, n, b32(html), "revisit" if k else "response", ids[0] if k else None)] += 1
    assert got == want
    payloads = {bytes(r.payload) for r in warc.read_archives(spark, str(tmp_path / "w"), True).collect() if r.payload is not None}
    assert payloads == {(r[2] or "").encode() for r in rows}
    warc.write_archives(pages, str(tmp_path / "all"), min_bytes=1 << 20)
    assert warc.read_archives(spark, str(tmp_path / "all")).where("record_type = 'response'").count() == len(rows)


def test_warc_empty(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert warc.op8_warc_revisits(spark, str(tmp_path)).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_digests(spark, tmp_path):
    nasty = "[INST] x [/INST]</s><s>[¦INST][¦¦/INST] <¦/s> [ROLE a] [/ROLE] \\1 $2 \n é😀 [ <"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 2, "user", None), (1, 3, "assistant", ""), (2, 5, "system", "[ROLE"),
            (2, 7, "a] b/é", " spaced "), (2, 6, None, "null role"), (None, 0, "assistant", "x"), (3, 0, "user", "tie"), (3, 0, "user", "tie"), (3, 0, "assistant", "tie")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"turn {i} " + "</s>" * (i % 3)) for i in range(75)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("x")).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in chat.op6_reply_trees(spark, str(tmp_path)).collect()}
    by = collections.defaultdict(list)
    for c, t, r, x in rows + chat.PROBE:
        by[c].append((t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))


def test_reply_trees_rank_branches(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 1.0), ("t", 3, 1, "assistant", "good", 2.0),
            ("t", 4, 3, "user", "more", 0.5), ("t", 5, 2, "user", "other", 0.1), ("t", 8, 9, "user", "cycle", 5.0), ("t", 9, 8, "user", "cycle", 5.0),
            ("o", 1, 77, "user", "parent is missing", None)]
    m = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double").withColumn("conv_id", F.col("tree"))
    got = [tuple(r) for r in chat.format_trees(m, top=2).select("conv_id", "leaf", "branch_rank", "branch_score", "formatted").collect()]
    assert sorted(got) == [("o", 1, 1, 0.0, "[INST] parent is missing [/INST]"),
                           ("t", 4, 1, 2.5, "[INST] q [/INST]<s>good</s>[INST] more [/INST]"),
                           ("t", 5, 2, 1.1, "[INST] q [/INST]<s>bad</s>[INST] other [/INST]")]


def test_language_codes_sum_to_one_and_match_a_plain_tree():
    texts = {"aa": [b"abab abc", b"ab"], "bb": [b"xyx yx", b"xy"]}
    rows = []
    for x, (name, part) in enumerate(sorted(texts.items())):
        for k in range(langid.ORDER + 1):
            g = np.concatenate([langid._grams(langid.PAD + t, k) for t in part])
            rows += [(x, k, int(c), int(n)) for c, n in zip(*np.unique(g, return_counts=True), strict=True)]
    a = np.array(rows)
    model = {"langs": ["aa", "bb"], "lang": a[:, 0], "k": a[:, 1], "gram": a[:, 2], "n": a[:, 3]}
    trees = langid.Trees(model)
    assert np.allclose(np.exp2(-trees.cost.reshape(-1, 256, 2).astype(float)).sum(1), 1, atol=1e-4)

    def plain(x, context, byte):  # PPM with exclusion, straight from the counts
        if context is None:
            return 1 / 256, np.full(256, 1 / 256)
        code = int.from_bytes(context, "big")
        seen = {int(g) & 255: int(n) for l, k, g, n in rows if l == x and k == len(context) and int(g) >> 8 == code}
        _, below = plain(x, context[1:] if context else None, byte)
        if not seen:
            return below[byte], below
        total, kinds = sum(seen.values()), len(seen)
        p = below.copy()
        p[list(seen)] = 0
        p *= kinds / (total + kinds) / p.sum()
        for s, n in seen.items():
            p[s] = n / total * (1 - kinds / (total + kinds))
        return p[byte], p
    text = b"abx yab\xc3\xa9"
    want = [sum(-np.log2(plain(x, (langid.PAD + text)[i:i + 3], text[i])[0]) for i in range(len(text))) for x in (0, 1)]
    assert np.allclose(trees.lengths([text])[0], want, rtol=1e-4)
    many = [b"", text * 3, b"a", text]
    whole = trees.lengths(many)
    langid_slice, langid.SLICE = langid.SLICE, 5
    try:
        assert np.allclose(trees.lengths(many), whole, rtol=1e-5) and (whole[0] == 0).all()
    finally:
        langid.SLICE = langid_slice
    small = langid.Trees(model, max_cells=256 * 2 * 12)
    assert len(small.cost) < len(trees.cost) and np.allclose(np.exp2(-small.cost.reshape(-1, 256, 2).astype(float)).sum(1), 1, atol=1e-4)


def test_language_trees_keep_every_context(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = langid.learn(docs)
    dense, sparse = langid.Trees(model), langid.Sparse(model)
    texts = [r.text.encode() for r in docs.where("text <> ''").limit(40).collect()] + [b"", "Ωмега x".encode(), bytes(range(256))]
    assert np.allclose(sparse.lengths(texts), dense.lengths(texts), rtol=1e-5)
    every = np.arange(256, dtype=np.uint32)
    for x in range(len(model["langs"])):
        mine = (model["lang"] == x) & (model["k"] == langid.ORDER)
        contexts = np.unique(model["gram"][mine] >> 8)
        assert len(sparse.own[x][langid.ORDER][2]) == len(contexts)
        for c in [*contexts[::97].tolist(), 0xFFFFFF]:
            assert abs(np.exp2(-sparse._bits(x, np.uint32(c << 8) | every)).sum() - 1) < 1e-6


def test_language_memory_follows_the_sample():
    # sixty languages of 4,000 contexts of their own, more than a capped table holds
    langs, rnd = 60, np.random.default_rng(4)
    parts = []
    for x in range(langs):
        letters = rnd.choice(np.arange(97, 123), 20, replace=False).astype(np.uint8)
        data = langid.PAD + rnd.choice(letters, 8_000).tobytes()
        for k in range(langid.ORDER + 1):
            g, n = np.unique(langid._grams(data, k), return_counts=True)
            parts.append((np.full(len(g), x), np.full(len(g), k), g, n))
    lang, k, gram, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    trees = langid.Sparse({"langs": list(map(str, range(langs))), "lang": lang, "k": k, "gram": gram, "n": n})
    assert sum(len(o[0]) for own in trees.own for o in own) == len(gram)
    assert sum(a.nbytes for own in trees.own for o in own for a in o) <= 24 * len(gram)


def test_language_sample_ignores_copies(spark):
    rnd = random.Random(8)
    rows = [(lang, " ".join("".join(rnd.choices(letters, k=5)) for _ in range(50)))
            for lang, letters in (("aa", "abcdefgh"), ("bb", "stuvwxyz")) for _ in range(40)]

    def counts(rows):
        m = langid.learn(spark.createDataFrame(rows, "lang string, text string"), sample_bytes=3000)
        return m["langs"], sorted(zip(*(m[c].tolist() for c in ("lang", "k", "gram", "n")), strict=True))
    once = counts(rows)
    assert counts(rows + rows[:1] * 500 + rows[50:60] * 70) == once
    sampled = sum(n for _, k, _, n in once[1] if k == 0)
    assert 2000 < sampled < 14000  # about 3,000 bytes a language of 12,000
    few = langid.learn(spark.createDataFrame(rows, "lang string, text string"), sample_bytes=1)
    assert [few["n"][(few["lang"] == x) & (few["k"] == 0)].sum() for x in (0, 1)] == [299, 299]  # one text each


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = langid.identify(docs.withColumn("score", F.lit("x")).withColumn("held", langid.held_out()))
    n, ok = got.where("held").agg(F.count(F.lit(1)), F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 20 and ok >= 0.95


def test_language_defined_cases(spark, make_documents):
    rows = [(i, "the cat and the dog", "en", "s") for i in range(20)] + [(i, "der Hund und die Katze", "de", "s") for i in range(20, 40)]
    rows += [(50, None, "en", "s"), (51, "", "en", "s"), (52, "123 !?", "en", "s"), (53, "the dog", None, None), (None, "die Katze", None, None)]
    sf = make_documents(rows)
    got = {r.doc_id: r for r in langid.op4_language_id(spark, sf).collect()}
    assert [got[i].lang_pred for i in (50, 51, 52, 53, None)] == ["und", "und", "und", "en", "de"]
    assert got[50].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert langid.op4_language_id(spark, make_documents([])).count() == 0
    unlabelled = make_documents([(1, "text", None, "s")])
    assert langid.op4_language_id(spark, unlabelled).first().lang_pred == "und"
