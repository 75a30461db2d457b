"""Names in texts and response checks, against hand-written rows."""

import numpy as np
from pyspark.sql import functions as F

from docweave.operators import concepts as C
from docweave.operators import evaluate as E
from docweave.operators import graph as G


def spans(spark, texts, names):
    t = spark.createDataFrame(texts, "text_id string, text string").repartition(3)
    n = spark.createDataFrame([(x,) for x in names], "name string")
    return sorted((r.text_id, r.start, r.name) for r in C.name_spans(t, n).collect())


def test_leftmost_longest(spark):
    names = ["small", "small ring", "ring of fire", "Fire", "new york city", "york", None, "", "small"]
    texts = [("a", "A Small ring of fire"), ("b", "new york, new york city"), ("c", None), ("d", ""), ("e", "small small ring"), ("f", "ringing smaller")]
    assert spans(spark, texts, names) == [
        ("a", 1, "small ring"), ("a", 4, "fire"), ("b", 1, "york"), ("b", 2, "new york city"), ("e", 0, "small"), ("e", 1, "small ring")]
    assert spans(spark, texts, [None, " "]) == [] and spans(spark, [], names) == []


def test_many_texts_equal_a_plain_search(spark):
    rng = np.random.default_rng(8)
    words = list("abcdef")
    names = sorted({" ".join(rng.choice(words, int(rng.integers(1, 5)))) for _ in range(40)} - set(words[2:]))
    texts = [(f"t{i}", " ".join(rng.choice(words, int(rng.integers(0, 40))))) for i in range(200)] + [("hot", "a b " * 3000)]
    want = []
    for i, t in texts:
        tok, at = t.split(), 0
        while at < len(tok):
            fits = [n for n in (x.split() for x in names) if tok[at:at + len(n)] == n]
            if fits:
                best = max(fits, key=len)
                want.append((i, at, " ".join(best)))
                at += len(best)
            else:
                at += 1
    assert spans(spark, texts, names) == sorted(want)


def test_response_checks_by_hand(spark):
    edges = spark.createDataFrame([("a:1", "b:1", "contains"), ("a:1", "b:2", "contains"), ("b:1", "c:1", "supplied_by"), ("a:2", "b:1", "contains")],
                                  "src string, dst string, type string")
    rows = [(1, "What does a:1 contain?", "a:1 contains b:1. A:1 contains b:9; b:1 Is Supplied By c:1."),
            (2, "What does a:1 contain?", "a:1 returned b:2. a:1 contains b:2 contains b:1! a:1 likes b:1"),
            (3, "What does a:2 contain?", None), (4, None, "a:2 contains b:1"), (5, "And z:1?", "")]
    relations = {"contains": "contains", "returned": "returned", "is supplied by": "supplied_by"}
    got = {r.id: r.asDict() for r in E.graph_response_checks(spark.createDataFrame(rows, "id long, question string, response string"), edges, relations).collect()}
    key = ("n_statements", "n_supported", "n_conflicts", "n_targets", "n_covered", "factual", "completeness", "consistent")
    assert [got[1][k] for k in key] == [3, 2, 0, 2, 1, 0.666667, 0.5, True]
    assert [got[2][k] for k in key] == [3, 1, 1, 2, 2, 0.333333, 1.0, False]
    assert [got[3][k] for k in key] == [0, 0, 0, 1, 0, 0.0, 0.0, True]
    assert [got[4][k] for k in key] == [1, 1, 0, 0, 0, 1.0, 0.0, True]
    assert [got[5][k] for k in key] == [0, 0, 0, 0, 0, 0.0, 0.0, True]


def test_response_checks_in_rounds(spark, monkeypatch):
    """Edges that pass in rounds give the same sums; ids that come again, or are null, are one response."""
    edges = spark.createDataFrame([(f"a:{i}", f"b:{i * j % 7}", "contains" if j % 2 else "likes") for i in range(9) for j in range(1, 4) if j == 1 or i * j % 7 != i % 7],
                                  "src string, dst string, type string").dropDuplicates(["src", "dst"])
    rows = [(i % 12 if i % 12 else None, f"What of a:{i % 9} and a:{i % 4}?", f"a:{i % 9} contains b:{i % 7}. a:{i % 4} likes b:{i % 5}; b:1 contains b:2") for i in range(40)]
    known, asked, said, given = {(r.src, r.dst): r.type for r in edges.collect()}, {}, {}, {}
    for i, (k, _, _) in enumerate(rows):
        asked.setdefault(k, set()).update((f"a:{i % 9}", f"a:{i % 4}"))
        said.setdefault(k, set()).update(((f"a:{i % 9}", "contains", f"b:{i % 7}"), (f"a:{i % 4}", "likes", f"b:{i % 5}"), ("b:1", "contains", "b:2")))
        given.setdefault(k, set()).update(x for a, _, b in said[k] for x in (a, b))
    want = {}
    for k, told in said.items():
        targets = {b for a, b in known if a in asked[k]}
        want[k] = [len(told), sum(known.get((a, b)) == t for a, t, b in told), sum(known.get((a, b), t) != t for a, t, b in told),
                   len(targets), len(targets & given[k])]
    df = spark.createDataFrame(rows, "id long, question string, response string").repartition(3)
    steps = []
    written = E.written
    monkeypatch.setattr(E, "written", lambda frame, name: steps.append(name) or written(frame, name))
    for most, rounds in ((1000, 1), (-(-edges.count() // 3), 3)):
        monkeypatch.setattr(E, "ROUND_EDGES", most)
        steps.clear()
        got = {r.id: [r.n_statements, r.n_supported, r.n_conflicts, r.n_targets, r.n_covered] for r in
               E.graph_response_checks(df, edges, {"contains": "contains", "likes": "likes"}).collect()}
        assert got == want and steps == ["told", *["facts", "covered"] * rounds]


def test_contexts_have_a_limit_for_hubs(spark):
    nodes = spark.createDataFrame([("hub", "the hub"), ("x0", None)], "id string, definition string")
    edges = spark.range(60).select(F.lit("hub").alias("src"), F.format_string("x%02d", "id").alias("dst"), F.lit("to").alias("type"))
    got = {r.id: r.context for r in G.fact_contexts(nodes, edges, 3).collect()}
    assert got == {"hub": "the hub. hub -to-> x00; hub -to-> x01; hub -to-> x02 (and 57 more)", "x0": ". "}


def test_filter_of_first_tokens_lets_all_of_them_through(spark):
    from docweave.operators import concepts
    firsts = spark.createDataFrame([(f"w{i}",) for i in range(300)] + [("é",), ("",)], "first string")
    maybe = concepts._maybe_first(firsts)
    assert firsts.where(maybe(F.col("first"))).count() == 302
    others = spark.createDataFrame([(f"x{i}",) for i in range(2000)], "first string")
    assert others.where(maybe(F.col("first"))).count() < 60


def test_edges_by_source(spark):
    """Sources with few edges are dealt whole, a hub's edges are not."""
    edges = spark.createDataFrame([*[("h", "p", f"x{i}") for i in range(9)], ("a", "p", "b"), ("a", "q", "c"), (None, "p", "a")],
                                  "src string, type string, dst string")
    nodes = spark.createDataFrame([("h", "hub"), ("a", None), ("b", "end")], "id string, definition string")
    parts = G.by_source(nodes, edges, 3)
    assert sorted((r.src, r.dst) for r in parts[1].collect()) == [("a", "b"), ("a", "c")]
    assert {(r.src, r._n) for r in parts[2].collect()} == {("h", 9)} and parts[2].count() == 9 and parts[3] == 11
    for given in (None, parts):
        got = {r.id: r.context for r in G.fact_contexts(nodes, edges, 3, parts=given).collect()}
        assert got == {"h": "hub. h -p-> x0; h -p-> x1; h -p-> x2 (and 6 more)", "a": ". a -p-> b; a -q-> c", "b": "end. "}
