"""Spelling variants against a comparison of all words."""

import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from docweave.llm import spelling


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(docs):
    n = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    form, near = {}, {}
    for w in n:
        others = [x for x in n if one_apart(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], near[w], n.get(form[w])))
    return sorted(out)


def run(spark, docs, extra=False):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    if extra:
        df = df.withColumn("word", F.lit("x")).withColumn("N", F.lit(1)).withColumn("run", F.lit("y")).withColumn("id", F.lit(0))
    return sorted(tuple(r) for r in spelling.spelling_variants(df).collect())


def test_variants_equal_a_comparison_of_all_words(spark):
    rng = np.random.default_rng(3)
    base = ["letter", "lettre", "straße", "Éclair", "éclair", "aaaaa", "aaaaaa", "aaaaaaa", "bananas", "bandanas", "×÷×÷×", "listen", "silent", "tinsel"]
    docs = []
    for i in range(120):
        words = []
        for w in rng.choice(base, 60, p=np.arange(14, 0, -1) / 105):
            w, k = str(w), int(rng.integers(0, 12))
            at = int(rng.integers(0, len(w)))
            words.append({0: w[:at] + w[at + 1:], 1: w[:at] + "x" + w[at:], 2: w[:at] + "q" + w[at + 1:], 3: w.upper()}.get(k, w))
        docs.append((i, " ".join(words)))
    docs += [(7, docs[7][1]), (None, "letter " * 4), (500, None), (501, ""), (502, " 1234 \t"), (503, "hot hotter " * 4000), (504, "y" * 30000 + " x" * 3),
             (505, ("z" * 3000 + " ") * 3 + ("z" * 2999 + " ") * 7)]
    got = run(spark, docs, extra=True)
    assert got == plain_variants(docs)
    assert sum(r[1] is not None for r in got) > 20


def test_every_near_pair_shares_a_signature():
    rng = np.random.default_rng(4)
    for _ in range(300):
        w = "".join(rng.choice(list("abcdeé"), int(rng.integers(5, 14))))
        at = int(rng.integers(0, len(w)))
        for other in (w[:at] + w[at + 1:], w[:at] + "f" + w[at + 1:], w[:at] + "a" + w[at:]):
            s = spelling.signature_matrix([w, other])
            assert s.shape == (2, 28) and (s[0] == s[1]).any()


def test_chain_of_forms_ends_at_its_root(spark):
    docs = [(i, f"{w} " * 2 ** k * 3) for k, w in enumerate(["abcdef", "abcdeg", "abcdhg", "abckhg", "abmkhg", "anmkhg"]) for i in (1,)]
    got = {r[0]: r for r in run(spark, docs)}
    assert got["abcdef"][2] == "anmkhg" and got["abcdef"][1] == "abcdeg" and got["anmkhg"][1] is None


def test_empty_table(spark):
    assert run(spark, []) == []


def test_nothing_is_gathered_to_be_broadcast(spark, monkeypatch):
    made = []
    materialize = spelling.materialize
    monkeypatch.setattr(spelling, "materialize", lambda df, name: made.append(df) or materialize(df, name))
    docs = spark.createDataFrame([(1, "letter letter letters " * 8 + "latter latters " * 3)], "doc_id long, text string")
    out = spelling.spelling_variants(docs)
    assert {r.word: r.root for r in out.collect()} == {"letter": "letter", "letters": "letter", "latter": "letter", "latters": "letter"}
    plans = [df._jdf.queryExecution().sparkPlan().toString() for df in [*made, out]]
    assert sum("SortMergeJoin" in p for p in plans) >= 4   # signatures, best, roots, result
    assert not any("Broadcast" in p for p in plans)
