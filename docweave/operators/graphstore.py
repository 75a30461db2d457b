"""The knowledge graph as one versioned table, merged in order.

Nodes and edges are rows of one store of ``operators.versions``: a node lies in the
namespace ``node:<category>``, an edge in ``edge:<type>`` (folders, so a type or a
category is a partition filter), and a merge of both becomes visible in one step. A
concept or an edge that comes again replaces the kept one if its sequence number is
not smaller (a row without one replaces none), also when its category or type has changed; an endpoint that nobody
declared is a bare node until it is. Rewritten are only the namespaces that a merge
brings rows to or takes rows from.

rows: namespace, id (an edge's source), dst (null for a node), definition, properties,
seq (null for a bare node).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators import graph, versions
from docweave.session import ROWS_PER_TASK, dealt, ensure_checkpoint_dir, scratch_path, written

_KEY = ["_edge", "id", "_dst"]
_COLS = ["namespace", "id", "dst", "definition", "properties", "seq"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_edge", F.col("dst").isNotNull()).withColumn("_dst", F.coalesce("dst", F.lit("")))


def _incoming(concepts: DataFrame | None, edges: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) as rows of the store, repeated ones too: concepts with the ends of
    all edges as bare nodes, and edges with the concepts' relationships. Rows without
    an id, and edges without an end, are no part of a graph and go."""
    text, props = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    parts, links = [], []
    if concepts is not None:
        c = concepts.where(F.col("concept").isNotNull())
        kind = F.concat(F.lit("node:"), F.coalesce(F.col("properties")["category"], F.lit("default")))
        parts.append(c.select(kind.alias("namespace"), F.col("concept").alias("id"), text.alias("dst"), "definition",
                              "properties", F.col("seq").cast("long").alias("seq")))
        links.append(c.select(F.col("concept").alias("src"), F.explode("relationships").alias("r"), "seq")
                     .select("src", F.col("r.target").alias("dst"), F.col("r.type").alias("type"), "seq"))
    if edges is not None:
        links.append(edges.select("src", "dst", "type", "seq"))
    links = reduce(DataFrame.unionByName, [e.select("src", "dst", "type", F.col("seq").cast("long").alias("seq"))
                                           .where(F.col("src").isNotNull() & F.col("dst").isNotNull()) for e in links])
    ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    parts.append(ends.select(F.lit("node:default").alias("namespace"), "id", text.alias("dst"), text.alias("definition"),
                             graph.empty_props().alias("properties"), F.lit(None).cast("long").alias("seq")))
    rows = links.select(F.concat(F.lit("edge:"), F.coalesce("type", F.lit(""))).alias("namespace"), F.col("src").alias("id"),
                        "dst", text.alias("definition"), props.alias("properties"), "seq")
    return reduce(DataFrame.unionByName, parts), rows


def _winners(nodes: DataFrame, edges: DataFrame, rows: int) -> list[DataFrame]:
    """Edges and nodes, one row per key: the greatest sequence number (bare last), then the greatest
    namespace, definition and properties. Rows are dealt by key first, so each passes a
    shuffle once, as it is, and both steps of the aggregate run where it lands; edges,
    the many, are compared without the columns that only nodes have. ``rows`` (concepts
    and edges) say how many tasks they are dealt to."""
    order = F.struct("seq", "namespace", "definition", F.array_sort(F.map_entries("properties")))
    n = dealt(nodes, rows, "id").groupBy("id").agg(F.max_by(F.struct(*_COLS[:1], *_COLS[2:]), order).alias("w")).select("id", "w.*")
    e = (dealt(edges.select("id", "dst", "seq", "namespace"), rows, "id", "dst").groupBy("id", "dst")
         .agg(F.max(F.struct("seq", "namespace")).alias("w")).select("id", "dst", "w.*"))
    e = e.withColumn("definition", F.lit(None).cast("string")).withColumn("properties", F.lit(None).cast("map<string,string>"))
    return [e.select(*_COLS), n.select(*_COLS)]


def merge(spark: SparkSession, path: str, concepts: DataFrame | None = None, edges: DataFrame | None = None,
          files_per_namespace: int | None = None) -> int:
    """concepts(concept, definition, properties, relationships, seq) and edges(src, dst,
    type, seq), either may be missing, into the graph at ``path``; the new version's
    number (the last one's if no row is new). Merging the same rows again changes nothing
    but that number."""
    if concepts is None and edges is None:
        raise ValueError("nothing to merge")
    ensure_checkpoint_dir(spark)
    base = versions.current_version(spark, path)
    told = _incoming(concepts, edges)
    rows = told[1].count() + (0 if concepts is None else concepts.where(F.col("concept").isNotNull()).count())
    if not rows:
        return base
    if not base:   # nothing to compare with: written as it comes out of the aggregate
        return versions.commit(spark, path, _winners(*told, rows), 0, files_per_namespace=files_per_namespace)
    # steps are written as files, whose size is known: what is small is broadcast, and the kept rows stay where they are
    incoming = _keyed(reduce(DataFrame.unionByName, [written(w, "incoming") for w in _winners(*told, rows)]))
    kept = _keyed(versions.read(spark, path, base))
    n_kept = kept.count()

    def beside(frame, keys, how):   # many keys: the kept rows are dealt by them and looked up, not sorted
        if rows <= ROWS_PER_TASK:
            return frame.join(keys, _KEY, how)
        return dealt(frame, n_kept, *_KEY).join(keys.hint("shuffle_hash"), _KEY, how)

    # what the kept rows of the incoming keys are, without their payload
    old = (beside(kept.select(*_KEY, "namespace", "seq"), incoming.select(*_KEY), "left_semi")
           .select(*_KEY, F.col("namespace").alias("old_namespace"), F.col("seq").alias("old_seq")))
    newer = F.col("old_seq").isNull() | (F.col("seq") >= F.col("old_seq"))
    new = written(incoming.join(old, _KEY, "left")
                  .where(F.col("old_namespace").isNull() | (F.col("seq").isNotNull() & newer)), "new")
    if new.isEmpty():
        return base
    touched = written(new.select(F.explode(F.array("namespace", "old_namespace")).alias("namespace"))
                      .where(F.col("namespace").isNotNull()).distinct(), "touched")
    rest = beside(kept.join(touched, "namespace", "left_semi"), new.select(*_KEY), "left_anti")
    return versions.commit(spark, path, rest.select(*_COLS).unionByName(new.select(*_COLS)), base,
                           files_per_namespace=files_per_namespace, replaced=touched)


_STORED: dict[tuple, str] = {}


def stored_once(spark: SparkSession, sources: list[str], inputs, files_per_namespace: int | None = None) -> str:
    """The path of a store with the graph of ``inputs()`` (concepts, edges), both with a
    seq, written by the first caller of an application and read by the others. It is
    written anew when the size or the time of a path of ``sources`` has changed (a file's
    own, a folder's as of its last file), or the store has gone."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    state = []
    for source in sources:
        where = jvm.org.apache.hadoop.fs.Path(source)
        status = where.getFileSystem(conf).getFileStatus(where)
        state.append((source, status.getLen(), status.getModificationTime()))
    key = (spark.sparkContext.applicationId, *state)
    path = _STORED.get(key)
    if path is None or not versions.current_version(spark, path):
        path = scratch_path(spark, "graph")
        merge(spark, path, *inputs(), files_per_namespace=files_per_namespace)
        _STORED[key] = path
    return path


def _read(spark: SparkSession, path: str, version: int | None, **which) -> DataFrame:
    version = versions.current_version(spark, path) if version is None else version
    if not version:   # nothing was merged yet
        return spark.createDataFrame([], "namespace string, id string, dst string, definition string, "
                                         "properties map<string,string>, seq long")
    return versions.read(spark, path, version, **which)


def nodes(spark: SparkSession, path: str, category: str | None = None, version: int | None = None) -> DataFrame:
    """(id, definition, properties, verified), of one category if given: its folder only."""
    rows = _read(spark, path, version, **({"prefix": "node:"} if category is None else {"namespace": f"node:{category}"}))
    return rows.select("id", "definition", "properties", F.lit(False).alias("verified"))


def edges(spark: SparkSession, path: str, type: str | None = None, version: int | None = None) -> DataFrame:
    """(src, dst, type), of one type if given: its folder only."""
    rows = _read(spark, path, version, **({"prefix": "edge:"} if type is None else {"namespace": f"edge:{type}"}))
    kind = F.substring("namespace", 6, 1 << 20)
    return rows.select(F.col("id").alias("src"), "dst", kind.alias("type"))


# --- patterns ---------------------------------------------------------------------

def match_chain(edge_sets: list[DataFrame], node_sets: list[DataFrame | None], distinct: bool = False) -> DataFrame:
    """All matches (n0, n1, .., nk) of a chain of k hops: hop i is an edge (src, dst) of
    ``edge_sets[i]``, node i one of ``node_sets[i]`` (id), or any if None.

    Each hop's edges are first reduced by semi joins, forwards to those that a match of
    the hops before can reach, then backwards to those that lead to a match of the hops
    after. What is joined at last holds no row without a match, so no step is larger
    than its edges or the answer. Edges that come twice count once; ``distinct`` says
    that none does."""
    if not edge_sets or len(node_sets) != len(edge_sets) + 1:
        raise ValueError("a chain of k hops, k at least 1, has k + 1 nodes")
    ensure_checkpoint_dir(edge_sets[0].sparkSession)

    def ids(frame, col="id"):
        return frame.select(F.col(col).alias("_id")).where(F.col("_id").isNotNull()).distinct()

    def within(frame, col, allowed):
        return frame.join(allowed, frame[col] == allowed["_id"], "left_semi")

    hops = []
    reachable = None if node_sets[0] is None else ids(node_sets[0])
    for e, after in zip(edge_sets, node_sets[1:]):
        e = e.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
        e = e if distinct else e.distinct()
        if reachable is not None:
            e = within(e, "src", reachable)
        if after is not None:
            e = within(e, "dst", ids(after))
        hops.append(written(e, "hop"))   # files, not a checkpoint: a small hop is seen to be small and broadcast
        reachable = ids(hops[-1], "dst")
    for i in reversed(range(len(hops) - 1)):
        hops[i] = written(within(hops[i], "dst", ids(hops[i + 1], "src")), "hop")
    out = hops[0].select(F.col("src").alias("n0"), F.col("dst").alias("n1"))
    for i, e in enumerate(hops[1:], 1):
        out = out.join(e.select(F.col("src").alias(f"n{i}"), F.col("dst").alias(f"n{i + 1}")), f"n{i}")
    return out.select(*(f"n{i}" for i in range(len(hops) + 1)))


def match_pattern(spark: SparkSession, path: str, types: list[str], categories: list[str | None],
                  version: int | None = None) -> DataFrame:
    """``match_chain`` in a stored graph: hop i has ``types[i]``, node i lies in
    ``categories[i]`` (None: any). Reads the folders of those types and categories."""
    version = versions.current_version(spark, path) if version is None else version   # one for all reads
    return match_chain([edges(spark, path, t, version) for t in types],
                       [None if c is None else nodes(spark, path, c, version) for c in categories], distinct=True)   # one row per pair
