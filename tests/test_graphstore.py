"""The stored graph: ordered merges, folders read, and chains against brute force."""
import itertools
import random

import pytest

from docweave import session
from docweave.operators import graphstore as S
from docweave.operators import versions

CONCEPT = ("concept string, definition string, properties map<string,string>, "
           "relationships array<struct<type:string,target:string>>, seq int")
EDGE = "src string, dst string, type string, seq int"


def shown(spark, path, version=None):
    return ({r.id: (r.definition, r.properties.get("category")) for r in S.nodes(spark, path, version=version).collect()},
            {(r.src, r.dst): r.type for r in S.edges(spark, path, version=version).collect()})


def test_merges_are_ordered(spark, tmp_path):
    path = str(tmp_path / "g")
    assert S.nodes(spark, path).count() == 0 and S.edges(spark, path, "p").count() == 0
    assert S.merge(spark, path, spark.createDataFrame([], CONCEPT)) == 0
    S.merge(spark, path, spark.createDataFrame([
        ("a", "first", {"category": "x"}, [("p", "b")], 5), ("a", "older", {"category": "y"}, [], 4),
        (None, "no id", {}, [("p", "b")], 5)], CONCEPT),
        spark.createDataFrame([("b", "c", "p", 5), ("b", None, "p", 5)], EDGE))
    first = ({"a": ("first", "x"), "b": (None, None), "c": (None, None)}, {("a", "b"): "p", ("b", "c"): "p"})
    assert shown(spark, path) == first
    # a declared end, an edge of another type, a moved category, and rows that come too late
    S.merge(spark, path, spark.createDataFrame([("c", "third", {"category": "x"}, [], 1), ("a", "again", {"category": "z"}, [], 6)], CONCEPT),
            spark.createDataFrame([("b", "c", "q", 6), ("a", "b", "q", 4)], EDGE))
    second = ({"a": ("again", "z"), "b": (None, None), "c": ("third", "x")}, {("a", "b"): "p", ("b", "c"): "q"})
    assert shown(spark, path) == second and shown(spark, path, 1) == first
    assert [r.id for r in S.nodes(spark, path, "x").collect()] == ["c"]
    assert S.edges(spark, path, "none").count() == 0
    # nothing of a folder is left: it is gone, not kept from the version before
    S.merge(spark, path, None, spark.createDataFrame([("a", "b", "q", 7)], EDGE))
    assert shown(spark, path)[1] == {("a", "b"): "q", ("b", "c"): "q"}
    last = versions.current_version(spark, path)
    assert S.merge(spark, path, None, spark.createDataFrame([("a", "b", "r", 1)], EDGE)) == last
    assert shown(spark, path)[1] == {("a", "b"): "q", ("b", "c"): "q"}
    with pytest.raises(ValueError):
        S.merge(spark, path)


def test_a_merge_that_ends_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "g")
    S.merge(spark, path, None, spark.createDataFrame([("a", "b", "p", 1)], EDGE))
    before = shown(spark, path)
    monkeypatch.setattr(versions, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        S.merge(spark, path, None, spark.createDataFrame([("a", "b", "q", 2)], EDGE))
    assert shown(spark, path) == before


def test_one_type_reads_its_folder(spark, tmp_path):
    path = str(tmp_path / "g")
    S.merge(spark, path, None, spark.createDataFrame([("a", "b", "p", 1), ("b", "c", "q", 1)], EDGE))
    files = S.edges(spark, path, "q")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in files and "edge:q" in files


def test_chains_match_brute_force(spark):
    rnd = random.Random(7)
    sets = [sorted({(rnd.randrange(15), rnd.randrange(15)) for _ in range(40)}) for _ in range(3)]
    frames = [spark.createDataFrame([*s, *s[:3], (None, 1)], "src int, dst int") for s in sets]   # repeated and null rows
    starts, ends = {1, 2, 3, 4, 5}, {0, 7, 8, 9}
    ids = [spark.createDataFrame([(i,) for i in x], "id int") for x in (starts, ends)]
    got = sorted(tuple(r) for r in S.match_chain(frames, [ids[0], None, None, ids[1]]).collect())
    want = sorted((a, b, d, f) for (a, b), (c, d), (e, f) in itertools.product(*sets)
                  if b == c and d == e and a in starts and f in ends)
    assert got == want and want
    assert sorted(tuple(r) for r in S.match_chain(frames[:1], [None, None]).collect()) == sets[0]
    assert S.match_chain([frames[0].limit(0), frames[1]], [None] * 3).count() == 0
    with pytest.raises(ValueError):
        S.match_chain(frames, [None])


def test_stored_once_per_state_of_its_sources(spark, tmp_path):
    source, calls = tmp_path / "t.parquet", []
    spark.createDataFrame([("a", "b", "p")], "src string, dst string, type string").write.parquet(str(source))

    def inputs():
        calls.append(1)
        return spark.createDataFrame([], CONCEPT), spark.read.parquet(str(source)).selectExpr("*", "1 AS seq")

    path = S.stored_once(spark, [str(source)], inputs)
    assert S.stored_once(spark, [str(source)], inputs) == path and len(calls) == 1
    spark.createDataFrame([("b", "c", "q")], "src string, dst string, type string").write.mode("append").parquet(str(source))
    again = S.stored_once(spark, [str(source)], inputs)
    assert again != path and len(calls) == 2
    assert shown(spark, again)[1] == {("a", "b"): "p", ("b", "c"): "q"}
    plan = S.edges(spark, again, "q")._jdf.queryExecution().executedPlan().toString()
    assert any("PartitionFilters" in line and "(ns#" in line and "= n_edge:q" in line for line in plan.splitlines())


def test_no_task_writes_a_whole_folder(spark, tmp_path):
    path = str(tmp_path / "g")
    rows = spark.range(4000).selectExpr("concat('a', id) AS src", "concat('b', id % 7) AS dst", "'p' AS type", "1 AS seq")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # as if they were too large to join
    try:
        S.merge(spark, path, None, rows)
        S.merge(spark, path, None, rows.where("src < 'a2'").selectExpr("src", "dst", "'p' AS type", "2 AS seq"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    commits = sorted((tmp_path / "g" / "data").glob("commit=*"))
    assert len(commits) == 2 and all(len(list(c.glob("ns=n_edge*p/*.parquet"))) > 1 for c in commits)
    assert S.edges(spark, path).count() == 4000 and S.nodes(spark, path).count() == 4007


def test_large_merges_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    """A task gets about so many rows whatever they compress to, and a merge on the way of
    large ones (dealt, looked up) gives the graph that one of small ones gives."""
    rows = spark.range(3000).selectExpr("concat('a', id % 1000) AS src", "concat('b', id) AS dst", "'p' AS type", "1 AS seq")
    again = rows.where("src < 'a3'").selectExpr("src", "dst", "if(dst < 'b2', 'q', 'p') AS type", "if(src < 'a2', 2, 0) AS seq")
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    for path, most in ((small, session.ROWS_PER_TASK), (large, 100)):
        monkeypatch.setattr(session, "ROWS_PER_TASK", most)
        monkeypatch.setattr(S, "ROWS_PER_TASK", most)
        S.merge(spark, path, None, rows)
        S.merge(spark, path, None, again)
    assert shown(spark, small) == shown(spark, large)
    assert len(list((tmp_path / "large" / "data").glob("commit=*/ns=n_edge*p/*.parquet"))) >= 30


def test_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    frame = spark.range(4000).selectExpr("id", "id % 3 AS k")
    assert session.dealt(frame, 4000, "id").rdd.getNumPartitions() == 40
    assert session.dealt(frame, 4000, "k").distinct().count() == 4000
    assert session.dealt(frame, 50, "id").count() == 4000


def test_a_written_step_leaves_no_shuffle_files(spark):
    """What a step has shuffled is dropped when it has ended; what is run beside is not."""
    import time
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    conf = spark.conf.get(name, None)
    shuffled = spark.range(1000).selectExpr("id % 3 AS k").groupBy("k").count()
    before = files()
    step = session.written(shuffled, "counted")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(name, None) == conf
    assert sorted(r["count"] for r in step.collect()) == [333, 333, 334]
    assert sorted(r["count"] for r in shuffled.collect()) == [333, 333, 334]
