"""Mask expansion and paths against plain Python on random small graphs."""
import random

from pyspark.sql import functions as F

from docweave.operators import graph as G
from docweave.operators import reach


def _graph(seed, n=40, m=90):
    rnd = random.Random(seed)
    return sorted({(f"n{rnd.randrange(n)}", f"n{rnd.randrange(n)}", rnd.choice("pqr")) for _ in range(m)})


def _bfs(edges, start, depth):
    """{node: (depth, smallest type, smallest path text)} by levels."""
    out = {}
    for s, d, t in edges:
        out.setdefault(s, []).append((d, t))
    found, level = {start: (0, None, start)}, {start: start}
    for i in range(1, depth + 1):
        nxt = {}
        for node, text in level.items():
            for d, t in out.get(node, []):
                if d not in found:
                    nxt.setdefault(d, []).append((t, f"{text} -{t}-> {d}"))
        level = {d: min(x[1] for x in v) for d, v in nxt.items()}
        found.update({d: (i, min(x[0] for x in v), level[d]) for d, v in nxt.items()})
    return found


def test_expand_many_sources_over_words(spark):
    """More sources than bits of a word, two starts for one source, loops and parallel edges."""
    edges = _graph(1)
    e = spark.createDataFrame(edges, "src string, dst string, type string")
    src = spark.createDataFrame([(f"s{i}", f"n{i % 40}") for i in range(150)] + [("n3", "n3"), ("n3", "n3")],
                                "source string, node string")
    got = {(r.source, r.node): (r.depth, r.type) for r in G.expand(src, e, 3).collect()}
    want = {}
    for source, node in [(f"s{i}", f"n{i % 40}") for i in range(150)] + [("n3", "n3")]:
        want.update({(source, d): v[:2] for d, v in _bfs(edges, node, 3).items() if v[0]})
    assert got == want
    reached, _ = reach.expand_masks(src, e, 3)
    counts = {(r.node, r.depth): r.n_sources for r in reach.source_counts(reached).collect()}
    plain = {}
    for (_, d), (depth, _t) in want.items():
        plain[d, depth] = plain.get((d, depth), 0) + 1
    assert counts == plain


def test_expand_nothing(spark):
    e = spark.createDataFrame([], "src string, dst string, type string")
    src = spark.createDataFrame([("a", "a"), (None, "b"), ("c", None)], "source string, node string")
    assert G.expand(src, e, 3).count() == 0
    assert G.expand(src.limit(0), e, 3).count() == 0


def test_paths_between_random_pairs(spark):
    for seed in (2, 3):
        edges = _graph(seed)
        e = spark.createDataFrame(edges + [(None, "n1", "p"), ("n1", None, "p")], "src string, dst string, type string")
        rnd = random.Random(seed)
        pairs = [(f"n{rnd.randrange(40)}", f"n{rnd.randrange(44)}") for _ in range(120)] + [("n1", "n1"), ("n1", None), (None, "n1")]
        got = {(r.start, r.end): (r.depth, r.path_text) for r in G.paths_between(
            spark.createDataFrame(pairs, "start string, end string"), e, 4).collect()}
        assert set(got) == set(pairs)
        for (a, b), row in got.items():
            hit = _bfs(edges, a, 4).get(b) if a is not None and b is not None else None
            assert row == ((hit[0], hit[2]) if hit else (None, None))


def test_paths_to_targets_only(spark):
    edges = _graph(4)
    e = spark.createDataFrame(edges, "src string, dst string, type string")
    src = spark.createDataFrame([("n0",), ("n1",), ("n2",)], "source string")
    everything = {(r.source, r.node): r.path_text for r in G.shortest_paths(src, e, 4).collect()}
    want = {(s, d): v[2] for s in ("n0", "n1", "n2") for d, v in _bfs(edges, s, 4).items()}
    assert everything == want
    ends = spark.createDataFrame([(f"n{i}",) for i in range(0, 40, 7)], "node string")
    some = {(r.source, r.node): (r.path_text, len(r.path)) for r in G.shortest_paths(src, e, 4, ends).collect()}
    assert {k: v[0] for k, v in some.items()} == {k: v for k, v in want.items() if int(k[1][1:]) % 7 == 0}
    one = spark.createDataFrame([("n1", max(d for s, d in want if s == "n1"))], "source string, node string")
    assert G.shortest_paths(src, e, 4, one).count() == 1


def test_rebuilt_path_is_the_text(spark):
    e = spark.createDataFrame(_graph(5), "src string, dst string, type string")
    pairs = spark.createDataFrame([(f"n{i}", f"n{j}") for i in range(6) for j in range(40)], "start string, end string")
    rows = G.paths_between(pairs, e, 4).where(F.col("depth") > 0).collect()
    assert rows
    for r in rows:
        text = r.path[0].src + "".join(f" -{h.type}-> {h.dst}" for h in r.path)
        assert text == r.path_text and len(r.path) == r.depth and r.path[-1].dst == r.end


def test_paths_by_masks_over_words_and_beginnings(spark):
    """More starts and ends than bits of a word, repeated edges, and a node whose name
    goes on as an edge's text does: its path is the greater one, its beginning the smaller."""
    edges = _graph(6, 80, 170)
    e = spark.createDataFrame(edges + edges[:50], "src string, dst string, type string")
    pairs = [(f"n{i}", f"n{(7 * i + 11 * j) % 80}") for i in range(80) for j in range(4)]
    got = {(r.start, r.end): (r.depth, r.path_text) for r in G.paths_between(spark.createDataFrame(pairs, "start string, end string"), e, 4).collect()}
    want = {}
    for a, b in pairs:
        hit = _bfs(edges, a, 4).get(b)
        want[a, b] = (hit[0], hit[2]) if hit else (None, None)
    assert got == want and {d for d, _ in want.values()} >= {None, 1, 2, 3, 4}
    odd = [("a", "x", "p"), ("a", "x -!", "p"), ("x", "z", "q"), ("x -!", "z", "q")]
    e = spark.createDataFrame(odd + [("z", "y", "p")], "src string, dst string, type string")
    row = G.paths_between(spark.createDataFrame([("a", "y")], "start string, end string"), e, 4).first()
    assert row.path_text == min("a -p-> x -q-> z", "a -p-> x -! -q-> z") + " -p-> y"


def test_sources_counted_over_words_and_long_lists(spark, monkeypatch):
    """As counted from the rows, with lists cut short, few and many words, and a start that a source reaches again."""
    monkeypatch.setattr(reach, "_LIST", 2)
    edges = _graph(8, 60, 260)
    e = spark.createDataFrame(edges + edges[:20] + [(None, "n1", "p"), ("n1", None, "p")], "src string, dst string, type string")
    for many, depths in ((3, (1, 3)), (300, (3,))):
        starts = [(f"s{i}", f"n{i % 60}") for i in range(many)] + [("s0", "n9"), (None, "n1"), ("s1", None)]
        src = spark.createDataFrame(starts, "source string, node string")
        for depth in depths:
            want = reach.source_counts(reach.expand_masks(src, e, depth)[0])
            assert sorted(map(tuple, reach.count_sources(src, e, depth).collect())) == sorted(map(tuple, want.collect()))
    assert reach.count_sources(src.limit(0), e, 1).count() == 0


def test_last_hop_in_rounds_and_no_edges_kept(spark, monkeypatch):
    """Words that take turns in the last hop give the same counts, and no edge is kept."""
    edges = _graph(9, 60, 260)
    e = spark.createDataFrame(edges, "src string, dst string, type string")
    src = spark.createDataFrame([(f"s{i}", f"n{i % 60}") for i in range(300)], "source string, node string")
    want = sorted(map(tuple, reach.source_counts(reach.expand_masks(src, e, 3)[0]).collect()))
    steps, written, kept = [], reach.written, []
    monkeypatch.setattr(reach, "written", lambda frame, name: steps.append(name) or written(frame, name))
    monkeypatch.setattr(reach, "keyed", lambda *a: kept.append(a))
    monkeypatch.setattr(reach, "ROUND", 900)
    assert sorted(map(tuple, reach.count_sources(src, e, 3).collect())) == want
    assert 2 <= steps.count("counts") <= 5 and not kept   # 300 sources are 5 words
