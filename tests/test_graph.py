import pytest
from pyspark.sql import functions as F

from docweave import schemas
from docweave.operators import graph as G


@pytest.fixture(scope="module")
def small_graph(spark):
    concepts = spark.createDataFrame([
        ("a", "first", {"category": "x"}, [("depends_on", "b"), ("influences", "c")], 1),
        ("b", "second", {}, [("depends_on", "d")], 1),
        ("c", "third", {"category": "y"}, [("influences", "d")], 1),
        ("a", "first again", {"category": "x"}, [("depends_on", "b")], 2),   # re-added: wins
        ("lonely", "alone", {}, [], 1),
    ], "concept string, definition string, properties map<string,string>, "
       "relationships array<struct<type:string,target:string>>, seq int")
    return G.build_graph(concepts, seq_col="seq")


def test_build_endpoint_completion_and_overwrite(small_graph):
    nodes, edges = small_graph
    n = {r.id: r for r in nodes.collect()}
    assert set(n) == {"a", "b", "c", "d", "lonely"}
    assert n["a"].definition == "first again"
    assert n["d"].definition is None and n["d"].properties == {}
    assert not any(r.verified for r in n.values())
    e = {(r.src, r.dst): r.type for r in edges.collect()}
    assert e == {("a", "b"): "depends_on", ("a", "c"): "influences", ("b", "d"): "depends_on",
                 ("c", "d"): "influences"}


def test_validate(small_graph):
    issues = {(r.kind, r.id) for r in G.validate(*small_graph).collect()}
    assert ("missing_definition", "d") in issues
    assert ("no_successor", "d") in issues and ("no_successor", "lonely") in issues
    assert ("isolated", "lonely") in issues and ("isolated", "d") not in issues
    assert ("no_successor", "a") not in issues


def test_node_group_default(small_graph):
    nodes, _ = small_graph
    g = {r.id: r.g for r in nodes.select("id", G.node_group().alias("g")).collect()}
    assert g["a"] == "x" and g["b"] == "default"


def test_expand_hop_by_hop(spark, small_graph):
    _, edges = small_graph
    src = spark.createDataFrame([("a", "a")], "source string, node string")
    got = {(r.node, r.depth, r.type) for r in G.expand(src, edges, 3).collect()}
    assert got == {("b", 1, "depends_on"), ("c", 1, "influences"), ("d", 2, "depends_on")}
    one = {(r.node, r.depth) for r in G.expand(src, edges, 1).collect()}
    assert one == {("b", 1), ("c", 1)}
    rev = {(r.node, r.depth) for r in G.expand(
        spark.createDataFrame([("d", "d")], "source string, node string"), edges, 5, reverse=True).collect()}
    assert rev == {("b", 1), ("c", 1), ("a", 2)}


def test_shortest_paths(spark, small_graph):
    _, edges = small_graph
    src = spark.createDataFrame([("a",)], "source string")
    p = {r.node: r for r in G.shortest_paths(src, edges, 3).collect()}
    assert p["a"].depth == 0 and p["a"].path == []          # start = end: empty path
    assert p["d"].depth == 2 and len(p["d"].path) == 2     # hops = BFS depth
    assert p["d"].path_text == "a -depends_on-> b -depends_on-> d"   # smallest among equals
    assert "lonely" not in p                                # unreachable: absent
    capped = {r.node for r in G.shortest_paths(src, edges, 1).collect()}
    assert capped == {"a", "b", "c"}                        # max_depth honoured


def test_schema_of_concepts():
    assert schemas.CONCEPT["relationships"].dataType.elementType.names == ["type", "target"]


def test_lookup_unknown_gives_null_row(spark, small_graph):
    nodes, _ = small_graph
    req = spark.createDataFrame([("a",), ("nope",)], "id string")
    got = {r.id: (r.known, r.definition) for r in G.lookup(nodes, req).collect()}
    assert got == {"a": (True, "first again"), "nope": (False, None)}
