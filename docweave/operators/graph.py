"""Knowledge graph as two tables: nodes(id, definition, properties, verified)
and edges(src, dst, type).

Traversals are level-synchronous joins: expansion on bit masks of sources
(``operators.reach``), paths with predecessor tables (``operators.paths``).
Each hop's result is a reliable checkpoint in the shared checkpoint directory,
so a lost executor recomputes at most one hop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators import reach
from docweave.operators.paths import paths_between, shortest_paths  # noqa: F401
from docweave.session import dealt, written

def empty_props() -> F.Column:
    return F.create_map().cast("map<string,string>")


# --- building -------------------------------------------------------------------

def build_graph(concepts: DataFrame, extra_edges: DataFrame | None = None,
                seq_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """concepts(concept, definition, properties, relationships array<struct<type,target>>)
    (+ optional edge rows src/dst/type) -> (nodes, edges).

    Re-adding a concept or an edge overwrites it (highest ``seq_col`` wins,
    else the greatest value, deterministically); an edge to an undeclared
    concept creates a bare node (null definition, empty properties)."""
    seq = F.col(seq_col) if seq_col else F.lit(0)
    c = concepts.withColumn("_seq", seq)
    declared = (c.groupBy(F.col("concept").alias("id"))
                .agg(F.max_by(F.struct("definition", "properties"), F.struct("_seq", "definition")).alias("_w"))
                .select("id", F.col("_w.definition").alias("definition"),
                        F.col("_w.properties").alias("properties")))
    rel = c.select(F.col("concept").alias("src"), "_seq", F.explode("relationships").alias("r")) \
           .select("src", F.col("r.target").alias("dst"), F.col("r.type").alias("type"), "_seq")
    if extra_edges is not None:
        rel = rel.unionByName(extra_edges.select("src", "dst", "type").withColumn("_seq", F.lit(0)))
    edges = (rel.groupBy("src", "dst")
             .agg(F.max_by("type", F.struct("_seq", "type")).alias("type")))
    # one pass over the edges for both endpoints (a union of two projections
    # lets the optimizer push the anti join into each branch and recompute
    # the edge aggregation per branch)
    endpoints = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    declared_ids = c.select(F.col("concept").alias("id")).distinct()   # hash distinct, no payload
    bare = (endpoints.join(declared_ids, "id", "left_anti")
            .select("id", F.lit(None).cast("string").alias("definition"), empty_props().alias("properties")))
    nodes = declared.unionByName(bare).withColumn("verified", F.lit(False))
    return nodes, edges


def node_group(properties_col: str = "properties", key: str = "category") -> F.Column:
    return F.coalesce(F.col(properties_col)[key], F.lit("default"))


# --- validation ------------------------------------------------------------------

def validate(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Issues: missing definition; no successor (no outgoing edge, what the
    plan's check calls 'isolated'); truly isolated (no edge at all)."""
    outs = edges.select(F.col("src").alias("id")).distinct()
    ins = edges.select(F.col("dst").alias("id")).distinct()
    missing = nodes.filter(F.col("definition").isNull()).select(
        F.lit("missing_definition").alias("kind"), "id",
        F.concat(F.lit("Missing definition for "), F.col("id")).alias("message"))
    no_succ = nodes.join(outs, "id", "left_anti").select(
        F.lit("no_successor").alias("kind"), "id",
        F.concat(F.lit("Isolated concept: "), F.col("id")).alias("message"))
    isolated = nodes.join(outs, "id", "left_anti").join(ins, "id", "left_anti").select(
        F.lit("isolated").alias("kind"), "id",
        F.concat(F.lit("No edge at all: "), F.col("id")).alias("message"))
    return missing.unionByName(no_succ).unionByName(isolated)


# --- neighbourhoods --------------------------------------------------------------

def neighbors(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Outgoing relationships with the target's definition."""
    tgt = nodes.select(F.col("id").alias("dst"), F.col("definition").alias("dst_definition"))
    return edges.join(tgt, "dst", "left").select("src", "type", "dst", "dst_definition")


def context(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Depth-1 context of every concept in long form: one row per outgoing
    relationship, or one row with null type/target and depth 0 for a concept
    without any. Written as an inner join (the edge side streams, so AQE can
    split a hub's skewed partition) plus an anti join for the concepts
    without edges, instead of a left join whose build side would be the hub."""
    with_rel = (edges.select(F.col("src").alias("id"), "type", F.col("dst").alias("target"))
                .join(nodes, "id").withColumn("depth", F.lit(1)))
    outs = edges.select(F.col("src").alias("id")).distinct()
    without = (nodes.join(outs, "id", "left_anti")
               .withColumn("type", F.lit(None).cast("string"))
               .withColumn("target", F.lit(None).cast("string")).withColumn("depth", F.lit(0)))
    return with_rel.unionByName(without)


def expand(sources: DataFrame, edges: DataFrame, max_depth: int, reverse: bool = False) -> DataFrame:
    """Multi-source breadth-first expansion.

    sources(source, node) -> (source, node, depth, type) for every node first
    reached at ``depth`` (1..max_depth) with the type of the edge that
    reached it (smallest type if several). The start nodes are not listed. Runs on
    bit masks (``operators.reach``), unpacked here at the end."""
    reached, numbers = reach.expand_masks(sources, edges, max_depth, reverse)
    return reach.unpacked(reached, numbers).select("source", "node", "type", F.col("depth").cast("int"))


def lookup(nodes: DataFrame, requested: DataFrame, id_col: str = "id") -> DataFrame:
    """Membership test: every requested id with its node attributes; an
    unknown id yields a row with null attributes and known = false."""
    n = nodes.withColumn("known", F.lit(True))
    return (requested.select(F.col(id_col).alias("id")).distinct().join(n, "id", "left")
            .withColumn("known", F.coalesce(F.col("known"), F.lit(False))))


# --- contexts ----------------------------------------------------------------------

def fact(src="src", kind="type", dst="dst") -> F.Column:
    return F.concat(F.col(src), F.lit(" -"), F.col(kind), F.lit("-> "), F.col(dst))


def by_source(nodes: DataFrame, edges: DataFrame, limit: int = 50) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(nodes, few, many, rows): nodes(id, definition) dealt by id, the edges of sources
    with at most ``limit`` of them dealt by source alike, the others' with their number
    ``_n``, not dealt, as a hub would be in one task, and the number of all edges. An edge
    without a source is none."""
    edges = edges.where(F.col("src").isNotNull())
    hubs = written(edges.groupBy("src").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit), "hubs")
    rows = edges.count()
    few = dealt(edges.join(hubs, "src", "left_anti").select("src", "type", "dst"), rows, "src")
    return dealt(nodes.select("id", "definition"), rows, "id"), few, edges.join(hubs, "src").select("src", "type", "dst", "_n"), rows


def fact_contexts(nodes: DataFrame, edges: DataFrame, limit: int = 50, parts: tuple | None = None) -> DataFrame:
    """(id, context) of every node: its definition and its outgoing relationships as
    facts "src -type-> dst", ordered by type and target. A prompt has room for
    ``limit`` facts; how many more there are is said at the end. Only sources with more
    edges are ranked, before the shuffle as well (a group limit), so a hub sends ``limit``
    rows a task; the others' edges need no sort for it. ``parts``: ``by_source`` of the
    same graph and limit, where the caller has it."""
    from pyspark.sql import Window
    nodes, few, many, rows = parts or by_source(nodes, edges, limit)

    def told(rows, *keys):
        facts = rows.groupBy("src", *keys).agg(F.array_sort(F.collect_list(F.struct("type", "dst"))).alias("_f"))
        each = F.transform("_f", lambda e: F.concat(F.col("src"), F.lit(" -"), e["type"], F.lit("-> "), e["dst"]))
        return facts.select(F.col("src").alias("id"), F.array_join(each, "; ").alias("_text"), *keys)

    ranked = many.withColumn("_k", F.row_number().over(Window.partitionBy("src").orderBy("type", "dst")))
    long = told(ranked.where(F.col("_k") <= limit), "_n").select(
        "id", F.concat("_text", F.lit(" (and "), (F.col("_n") - limit).cast("string"), F.lit(" more)")).alias("_long"))
    return nodes.join(told(few), "id", "left").join(dealt(long, rows, "id"), "id", "left").select(
        "id", F.concat(F.coalesce("definition", F.lit("")), F.lit(". "), F.coalesce("_text", "_long", F.lit(""))).alias("context"))
