"""Registered knowledge-graph queries over the graph built from the
relational tables (node ids ``kind:key``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import graph as G
from docweave.operators import graphstore as store
from docweave.operators import reach
from docweave.plans import sqlgen as S
from docweave.plans.registry import register
from docweave.session import scratch_path

_REL = "array<struct<type:string,target:string>>"


def _key(kind, col):
    return F.concat(F.lit(kind + ":"), F.col(col).cast("string"))


def _rel(typ, target):
    return F.array(F.struct(F.lit(typ).alias("type"), target.alias("target")))


def _no_rel():
    return F.array().cast(_REL)


_SOURCES = ("region", "nation", "supplier", "customer", "orders", "part", "lineitem")


def graph_path(t):
    """Where the stand-in graph (``_inputs``) is stored: written by the first query of an
    application that needs it."""
    def inputs():
        return tuple(frame.withColumn("seq", F.lit(1)) for frame in _inputs(t))
    sources = [f"{t.sf_dir.rstrip('/')}/{name}.parquet" for name in _SOURCES]
    return store.stored_once(t.spark, sources, inputs)


def tpch_graph(t):
    """(nodes, edges) of the stored graph."""
    path = graph_path(t)
    return store.nodes(t.spark, path), store.edges(t.spark, path)


def _inputs(t):
    """(concepts, edges beyond theirs) of the stand-in graph: regions, nations, suppliers,
    customers, orders (no definition), parts; edges in_region, in_nation,
    placed, contains, supplied_by."""
    m = F.create_map
    L = F.lit
    concepts = (
        t.region.select(_key("region", "r_regionkey").alias("concept"), F.col("r_name").alias("definition"),
                        m(L("category"), L("region")).alias("properties"), _no_rel().alias("relationships"))
        .unionByName(t.nation.select(_key("nation", "n_nationkey").alias("concept"), F.col("n_name").alias("definition"),
                                     m(L("category"), L("nation")).alias("properties"),
                                     _rel("in_region", _key("region", "n_regionkey")).alias("relationships")))
        .unionByName(t.supplier.select(_key("supplier", "s_suppkey").alias("concept"), F.col("s_name").alias("definition"),
                                       m(L("category"), L("supplier")).alias("properties"),
                                       _rel("in_nation", _key("nation", "s_nationkey")).alias("relationships")))
        .unionByName(t.customer.select(_key("customer", "c_custkey").alias("concept"), F.col("c_name").alias("definition"),
                                       m(L("category"), L("customer"), L("segment"), F.col("c_mktsegment")).alias("properties"),
                                       _rel("in_nation", _key("nation", "c_nationkey")).alias("relationships")))
        .unionByName(t.orders.select(_key("order", "o_orderkey").alias("concept"), L(None).cast("string").alias("definition"),
                                     m(L("status"), F.col("o_orderstatus"), L("priority"), F.col("o_orderpriority")).alias("properties"),
                                     _no_rel().alias("relationships")))
        .unionByName(t.part.select(_key("part", "p_partkey").alias("concept"), F.col("p_name").alias("definition"),
                                   m(L("category"), L("part"), L("brand"), F.col("p_brand"), L("type"), F.col("p_type"))
                                   .alias("properties"), _no_rel().alias("relationships"))))
    # both lineitem edge kinds come from one scan of lineitem (explode of a
    # two-element array), not from two scans of the largest table
    li_edges = t.lineitem.select(F.explode(F.array(
        F.struct(_key("order", "l_orderkey").alias("src"), _key("part", "l_partkey").alias("dst"),
                 L("contains").alias("type")),
        F.struct(_key("part", "l_partkey").alias("src"), _key("supplier", "l_suppkey").alias("dst"),
                 L("supplied_by").alias("type")))).alias("e")).select("e.*")
    extra = (t.orders.select(_key("customer", "o_custkey").alias("src"), _key("order", "o_orderkey").alias("dst"),
                             L("placed").alias("type"))
             .unionByName(li_edges))
    return concepts, extra


KG = """
concepts AS (
  SELECT 'region:' || r_regionkey AS id, r_name AS definition, 'region' AS category, 1 AS n_props FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, n_name, 'nation', 1 FROM nation
  UNION ALL SELECT 'supplier:' || s_suppkey, s_name, 'supplier', 1 FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, c_name, 'customer', 2 FROM customer
  UNION ALL SELECT 'order:' || o_orderkey, NULL, NULL, 2 FROM orders
  UNION ALL SELECT 'part:' || p_partkey, p_name, 'part', 3 FROM part),
edges0 AS (
  SELECT 'nation:' || n_nationkey AS src, 'region:' || n_regionkey AS dst, 'in_region' AS type FROM nation
  UNION ALL SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey, 'in_nation' FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey, 'in_nation' FROM customer
  UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey, 'placed' FROM orders
  UNION ALL SELECT 'order:' || l_orderkey, 'part:' || l_partkey, 'contains' FROM lineitem
  UNION ALL SELECT 'part:' || l_partkey, 'supplier:' || l_suppkey, 'supplied_by' FROM lineitem),
edges AS (SELECT src, dst, max(type) AS type FROM edges0 GROUP BY src, dst),
nodes AS (
  SELECT id, definition, category, n_props FROM concepts
  UNION ALL
  SELECT x.id, NULL, NULL, 0 FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges) x
  WHERE x.id NOT IN (SELECT id FROM concepts))
"""


@register("kg_build_nodes", f"""
WITH {KG}
SELECT id, definition, coalesce(category, 'default') AS category, n_props::BIGINT AS n_props, false AS verified FROM nodes
""")
def kg_build_nodes(t):
    """Declared concepts plus undeclared edge endpoints."""
    nodes, _ = G.build_graph(*_inputs(t))
    return nodes.select("id", "definition", G.node_group().alias("category"),
                        F.size("properties").cast("bigint").alias("n_props"), "verified")


@register("kg_build_edges", f"WITH {KG} SELECT src, dst, type FROM edges")
def kg_build_edges(t):
    """One edge per (src, dst), last write wins on the type."""
    return G.build_graph(*_inputs(t))[1]


@register("kg_node_groups", f"""
WITH {KG}
SELECT coalesce(category, 'default') AS category, count(*)::BIGINT AS n_nodes FROM nodes GROUP BY 1
""")
def kg_node_groups(t):
    """group = properties['category'] with 'default' when absent."""
    nodes, _ = tpch_graph(t)
    return nodes.groupBy(G.node_group().alias("category")).agg(F.count("*").cast("bigint").alias("n_nodes"))


@register("kg_export", f"""
WITH {KG}
SELECT 'node' AS kind, id AS a, NULL::VARCHAR AS b, definition AS title, coalesce(category, 'default') AS grp,
       NULL::VARCHAR AS arrows FROM nodes
UNION ALL
SELECT 'edge', src, dst, type, NULL, 'to' FROM edges
""")
def kg_export(t):
    """visual payload as data: node title/group rows and edge title/arrow rows."""
    nodes, edges = tpch_graph(t)
    n = nodes.select(F.lit("node").alias("kind"), F.col("id").alias("a"), F.lit(None).cast("string").alias("b"),
                     F.col("definition").alias("title"), G.node_group().alias("grp"),
                     F.lit(None).cast("string").alias("arrows"))
    e = edges.select(F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"),
                     F.col("type").alias("title"), F.lit(None).cast("string").alias("grp"), F.lit("to").alias("arrows"))
    return n.unionByName(e)


_VALIDATE = f"""
{KG},
outs AS (SELECT DISTINCT src AS id FROM edges),
ins AS (SELECT DISTINCT dst AS id FROM edges),
issues AS (
  SELECT 'missing_definition' AS kind, id, 'Missing definition for ' || id AS message FROM nodes WHERE definition IS NULL
  UNION ALL
  SELECT 'no_successor', id, 'Isolated concept: ' || id FROM nodes WHERE id NOT IN (SELECT id FROM outs)
  UNION ALL
  SELECT 'isolated', id, 'No edge at all: ' || id FROM nodes
  WHERE id NOT IN (SELECT id FROM outs) AND id NOT IN (SELECT id FROM ins))
"""


@register("kg_validate", f"WITH {_VALIDATE} SELECT kind, id, message FROM issues")
def kg_validate(t):
    """Missing definitions, nodes without successor, isolated nodes."""
    return G.validate(*tpch_graph(t))


@register("kg_validate_counts", f"WITH {_VALIDATE} SELECT kind, count(*)::BIGINT AS n FROM issues GROUP BY kind")
def kg_validate_counts(t):
    """Issue counts by kind."""
    return G.validate(*tpch_graph(t)).groupBy("kind").agg(F.count("*").cast("bigint").alias("n"))


@register("kg_neighbors", f"""
WITH {KG}
SELECT e.src, e.type, e.dst, n.definition AS dst_definition FROM edges e LEFT JOIN nodes n ON n.id = e.dst
""")
def kg_neighbors(t):
    """Outgoing relationships with the target's attributes."""
    return G.neighbors(*tpch_graph(t))


@register("kg_context", f"""
WITH {KG}
SELECT n.id, n.definition, coalesce(n.category, 'default') AS category, e.type, e.dst AS target,
       CASE WHEN e.dst IS NULL THEN 0 ELSE 1 END::BIGINT AS depth
FROM nodes n LEFT JOIN edges e ON e.src = n.id
""")
def kg_context(t):
    """Each concept's definition, group and depth-1 relationships in
    long form (depth 0 and null type/target for a concept without any) (no per-concept list is materialised, so a hub cannot blow up
    one row)."""
    nodes, edges = tpch_graph(t)
    return G.context(nodes, edges).select("id", "definition", G.node_group().alias("category"), "type",
                                          "target", F.col("depth").cast("bigint"))


@register("kg_context_depth", f"""
WITH RECURSIVE {KG},
r(source, node, depth) AS (
  SELECT 'customer:' || c_custkey, 'customer:' || c_custkey, 0 FROM customer
  UNION
  SELECT r.source, e.dst, r.depth + 1 FROM r JOIN edges e ON e.src = r.node WHERE r.depth < 2),
first AS (SELECT source, node, min(depth) AS depth FROM r GROUP BY ALL),
typed AS (SELECT f.source, f.node, f.depth, min(e.type) AS type FROM first f
          JOIN r p ON p.source = f.source AND p.depth = f.depth - 1
          JOIN edges e ON e.src = p.node AND e.dst = f.node
          WHERE f.depth > 0 AND f.node <> f.source GROUP BY ALL)
SELECT source, node, type, depth::INTEGER AS depth FROM typed
WHERE (source, node) NOT IN (SELECT source, node FROM first WHERE depth = 0)
""")
def kg_context_depth(t):
    """Every customer's relationships hop by hop up to depth 2."""
    _, edges = tpch_graph(t)
    src = t.customer.select(_key("customer", "c_custkey").alias("source")).withColumn("node", F.col("source"))
    return G.expand(src, edges, 2)


@register("kg_reachable", f"""
WITH RECURSIVE {KG},
r(source, node, depth) AS (
  SELECT 'region:' || r_regionkey, 'region:' || r_regionkey, 0 FROM region
  UNION
  SELECT r.source, e.src, r.depth + 1 FROM r JOIN edges e ON e.dst = r.node WHERE r.depth < 3)
SELECT source, node, min(depth)::INTEGER AS depth FROM r GROUP BY source, node HAVING min(depth) > 0
""")
def kg_reachable(t):
    """For every region, the concepts that reach it within 3 hops, with depth."""
    _, edges = tpch_graph(t)
    src = t.region.select(_key("region", "r_regionkey").alias("source")).withColumn("node", F.col("source"))
    return G.expand(src, edges, 3, reverse=True).select("source", "node", "depth")


@register("kg_reach_counts", f"""
WITH RECURSIVE {KG},
r(source, node, depth) AS (
  SELECT 'customer:' || c_custkey, 'customer:' || c_custkey, 0 FROM customer
  UNION
  SELECT r.source, e.dst, r.depth + 1 FROM r JOIN edges e ON e.src = r.node WHERE r.depth < 3),
first AS (SELECT source, node, min(depth) AS depth FROM r GROUP BY ALL)
SELECT node, depth::INTEGER AS depth, count(*)::BIGINT AS n_sources FROM first WHERE depth > 0 GROUP BY ALL
""")
def kg_reach_counts(t):
    """How many customers first reach each concept after 1, 2 and 3 hops. The
    masks are counted as they are: no row per customer and concept is made, and of the
    last hop none per word either."""
    _, edges = tpch_graph(t)
    src = t.customer.select(_key("customer", "c_custkey").alias("source")).withColumn("node", F.col("source"))
    return reach.count_sources(src, edges, 3)


@register("kg_path_routes", f"""
WITH RECURSIVE {{KG}},
pair AS (SELECT DISTINCT 'customer:' || o_custkey AS start, 'nation:' || (o_custkey % 25) AS "end"
         FROM orders),
r(start, node, depth, path_text) AS (
  SELECT DISTINCT start, start, 0, start FROM pair
  UNION ALL
  SELECT r.start, e.dst, r.depth + 1, r.path_text || ' -' || e.type || '-> ' || e.dst
  FROM r JOIN edges e ON e.src = r.node WHERE r.depth < 4),
hit AS (SELECT p.start, p."end", r.depth, min(r.path_text) AS path_text
        FROM pair p JOIN r ON r.start = p.start AND r.node = p."end" GROUP BY ALL)
SELECT p.start, p."end", coalesce(min(h.depth), -1)::INTEGER AS depth, arg_min(h.path_text, h.depth) AS path_text
FROM pair p LEFT JOIN hit h USING (start, "end") GROUP BY ALL
""".replace("{KG}", KG))
def kg_path_routes(t):
    """The shortest path of every customer that ordered to one given nation, over
    its orders, their parts and suppliers where it is not its own (both ends search;
    depth -1 where no path of 4 hops leads there)."""
    _, edges = tpch_graph(t)
    pairs = t.orders.select(_key("customer", "o_custkey").alias("start"),
                            F.concat(F.lit("nation:"), (F.col("o_custkey") % 25).cast("string")).alias("end"))
    return G.paths_between(pairs, edges, 4).select(
        "start", "end", F.coalesce("depth", F.lit(-1)).alias("depth"), "path_text")


def _top_customer(t):
    """The customer with the most orders (smallest key on ties), as a 1-row frame."""
    c = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return c.orderBy(F.desc("n"), F.asc("o_custkey")).limit(1).select(_key("customer", "o_custkey").alias("source"))


def _nations(t):
    return t.nation.select(_key("nation", "n_nationkey").alias("node"))


_SP_SQL = f"""
WITH RECURSIVE {KG},
src AS (SELECT 'customer:' || o_custkey AS source FROM orders GROUP BY o_custkey
        ORDER BY count(*) DESC, o_custkey LIMIT 1),
r(node, depth, path_text, path) AS (
  SELECT source, 0, source, []::STRUCT(src VARCHAR, type VARCHAR, dst VARCHAR)[] FROM src
  UNION ALL
  SELECT e.dst, r.depth + 1, r.path_text || ' -' || e.type || '-> ' || e.dst,
         list_append(r.path, {{'src': r.node, 'type': e.type, 'dst': e.dst}})
  FROM r JOIN edges e ON e.src = r.node WHERE r.depth < 4),
md AS (SELECT node, min(depth) AS depth FROM r GROUP BY node),
best AS (SELECT r.node, r.depth, min(r.path_text) AS path_text FROM r JOIN md USING (node, depth) GROUP BY ALL),
bp AS (SELECT b.node, b.depth, b.path_text, any_value(r.path) AS path FROM best b
       JOIN r ON r.node = b.node AND r.path_text = b.path_text GROUP BY ALL)
"""


@register("kg_shortest_path", _SP_SQL + """
SELECT node, depth::INTEGER AS depth, path_text FROM bp WHERE node LIKE 'nation:%'
""")
def kg_shortest_path(t):
    """Shortest typed path from the most active customer to every
    nation within 4 hops (smallest path text among equals)."""
    _, edges = tpch_graph(t)
    return G.shortest_paths(_top_customer(t), edges, 4, _nations(t)).select("node", "depth", "path_text")


@register("kg_path_edges", _SP_SQL + """,
ex AS (SELECT node, unnest(generate_series(0, len(path) - 1)) AS hop, unnest(path) AS h FROM bp
       WHERE node LIKE 'nation:%')
SELECT node, hop::INTEGER AS hop, h.src AS src, h.type AS type, h.dst AS dst FROM ex
""")
def kg_path_edges(t):
    """K8: the hops of each shortest path in order."""
    _, edges = tpch_graph(t)
    p = G.shortest_paths(_top_customer(t), edges, 4, _nations(t))
    x = p.select("node", F.posexplode("path").alias("hop", "h"))
    return x.select("node", F.col("hop").cast("int").alias("hop"), "h.src", "h.type", "h.dst")


@register("kg_path_pairs", """
WITH s AS (SELECT 'supplier:' || s_suppkey AS start, s_nationkey, n_regionkey
           FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT start, 'region:' || n_regionkey AS "end", 2 AS depth,
       start || ' -in_nation-> nation:' || s_nationkey || ' -in_region-> region:' || n_regionkey AS path_text FROM s
UNION ALL SELECT start, 'region:' || ((n_regionkey + 1) % 5), -1, NULL FROM s
UNION ALL SELECT start, start, 0, start FROM s
""")
def kg_path_pairs(t):
    """The path between two given concepts: every supplier to its region, to
    another region (no path: null, depth shown as -1) and to itself (empty path)."""
    _, edges = tpch_graph(t)
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _key("supplier", "s_suppkey").alias("start"), "n_regionkey")
    ends = F.array(F.concat(F.lit("region:"), F.col("n_regionkey").cast("string")),
                   F.concat(F.lit("region:"), ((F.col("n_regionkey") + 1) % 5).cast("string")), F.col("start"))
    pairs = s.select("start", F.explode(ends).alias("end"))
    return G.paths_between(pairs, edges, 4).select(
        "start", "end", F.coalesce("depth", F.lit(-1)).alias("depth"), "path_text")


@register("kg_lookup", f"""
WITH {KG}, req AS (SELECT 'part:' || (p_partkey * 2) AS id FROM part)
SELECT r.id, n.definition, n.id IS NOT NULL AS known FROM req r LEFT JOIN nodes n USING (id)
""")
def kg_lookup(t):
    """Membership of requested ids; an unknown id gives a row of nulls."""
    nodes, _ = tpch_graph(t)
    asked = t.part.select(F.concat(F.lit("part:"), (F.col("p_partkey") * 2).cast("string")).alias("id"))
    return G.lookup(nodes, asked).select("id", "definition", "known")


@register("kg_pattern_lookup", f"""
WITH {KG}
SELECT c.id AS customer, n.definition AS nation, r.definition AS region
FROM nodes c JOIN edges e1 ON e1.src = c.id AND e1.type = 'in_nation'
JOIN nodes n ON n.id = e1.dst JOIN edges e2 ON e2.src = n.id AND e2.type = 'in_region'
JOIN nodes r ON r.id = e2.dst WHERE c.category = 'customer'
""")
def kg_pattern_lookup(t):
    """Pattern (customer)-[in_nation]->(nation)-[in_region]->(region) in the stored
    graph: the folders of two types and three categories are read, no other edge."""
    path = graph_path(t)
    found = store.match_pattern(t.spark, path, ["in_nation", "in_region"], ["customer", "nation", "region"])
    n, r = (store.nodes(t.spark, path, kind).select("id", F.col("definition").alias(kind)) for kind in ("nation", "region"))
    return (found.join(n, F.col("n1") == n["id"]).join(r, F.col("n2") == r["id"])
            .select(F.col("n0").alias("customer"), "nation", "region"))


def _stored(t):
    """The graph in a store, by three merges: everything; then customers without an
    order again as prospects, and the parts that were returned with the edge to their
    supplier told anew; last, late rows with a number that is too small to count."""
    path = scratch_path(t.spark, "graph")
    concepts, extra = _inputs(t)
    store.merge(t.spark, path, concepts.withColumn("seq", F.lit(1)), extra.withColumn("seq", F.lit(1)))
    idle = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    prospects = idle.select(_key("customer", "c_custkey").alias("concept"), F.col("c_name").alias("definition"),
                            F.create_map(F.lit("category"), F.lit("prospect")).alias("properties"),
                            _no_rel().alias("relationships"), F.lit(2).alias("seq"))
    back = t.lineitem.where(F.col("l_returnflag") == "R").select(
        _key("part", "l_partkey").alias("src"), _key("supplier", "l_suppkey").alias("dst"),
        F.lit("returned_to").alias("type"), F.lit(2).alias("seq"))
    store.merge(t.spark, path, prospects, back)
    late = t.nation.select(_key("nation", "n_nationkey").alias("src"), _key("region", "n_regionkey").alias("dst"),
                           F.lit("once_in").alias("type"), F.lit(0).alias("seq"))
    store.merge(t.spark, path, None, late)
    return path


_STORED = f"""
{KG},
idle AS (SELECT 'customer:' || c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)),
back AS (SELECT DISTINCT 'part:' || l_partkey AS src, 'supplier:' || l_suppkey AS dst FROM lineitem WHERE l_returnflag = 'R'),
snodes AS (SELECT n.id, n.definition, CASE WHEN i.id IS NOT NULL THEN 'prospect' ELSE coalesce(n.category, 'default') END AS category
           FROM nodes n LEFT JOIN idle i USING (id)),
sedges AS (SELECT e.src, e.dst, CASE WHEN b.src IS NOT NULL THEN 'returned_to' ELSE e.type END AS type
           FROM edges e LEFT JOIN back b USING (src, dst))
"""


@register("kg_store_merge", f"""
WITH {_STORED}
SELECT id, NULL::VARCHAR AS dst, category AS label, definition FROM snodes
UNION ALL SELECT src, dst, type, NULL FROM sedges
""")
def kg_store_merge(t):
    """The stored graph after merges that come again, change a type or a category,
    and come too late."""
    path = _stored(t)
    n = store.nodes(t.spark, path).select("id", F.lit(None).cast("string").alias("dst"), G.node_group().alias("label"), "definition")
    return n.unionByName(store.edges(t.spark, path).select(F.col("src").alias("id"), "dst", F.col("type").alias("label"),
                                                           F.lit(None).cast("string").alias("definition")))


@register("kg_pattern_chain", f"""
WITH {_STORED}
SELECT o.id AS "order", p.src AS part, p.dst AS supplier, e.dst AS nation
FROM snodes o JOIN edges c ON c.src = o.id AND c.type = 'contains'
JOIN sedges p ON p.src = c.dst AND p.type = 'returned_to'
JOIN sedges e ON e.src = p.dst AND e.type = 'in_nation' WHERE o.category = 'default'
UNION ALL
SELECT NULL, n.src, n.dst, r.dst FROM snodes s JOIN sedges n ON n.src = s.id AND n.type = 'in_nation'
JOIN sedges r ON r.src = n.dst AND r.type = 'in_region' WHERE s.category = 'prospect'
""")
def kg_pattern_chain(t):
    """Chains in the stored graph, (order)-[contains]->()-[returned_to]->()-[in_nation]->()
    and (prospect)-[in_nation]->(nation)-[in_region]->(): only those types' and categories'
    folders are read, and semi joins drop what has no match before anything is joined.
    The second kind is shown as part, supplier and nation of a null order."""
    path = _stored(t)
    long = store.match_pattern(t.spark, path, ["contains", "returned_to", "in_nation"], ["default", None, None, None])
    short = store.match_pattern(t.spark, path, ["in_nation", "in_region"], ["prospect", "nation", None])
    return long.toDF("order", "part", "supplier", "nation").unionByName(
        short.toDF("part", "supplier", "nation").select(F.lit(None).cast("string").alias("order"), "part", "supplier", "nation"))


@register("chunk_nodes", f"""
WITH {S.doc_tokens_cte()}, {S.token_chunks_cte(200)}, {S.hashed_vectors_ctes('chunks', 'doc_id, chunk_id', 'chunk_text')},
sig AS (SELECT doc_id, chunk_id, count_if(v <> 0)::BIGINT AS nnz FROM h_vec GROUP BY ALL)
SELECT 'chunk:' || c.doc_id || ':' || c.chunk_id AS id, 'Chunk' AS label, c.chunk_text AS text,
       64::BIGINT AS dim, coalesce(s.nnz, 0)::BIGINT AS nnz
FROM chunks c LEFT JOIN sig s USING (doc_id, chunk_id)
""")
def chunk_nodes(t):
    """Chunks as graph nodes with label, text and textEmbedding."""
    from docweave.plans.q_vectors import chunk_vectors
    v = chunk_vectors(t)
    return v.select(F.concat(F.lit("chunk:"), F.col("doc_id").cast("string"), F.lit(":"),
                             F.col("chunk_id").cast("string")).alias("id"),
                    F.lit("Chunk").alias("label"), F.col("chunk_text").alias("text"),
                    F.size("values").cast("bigint").alias("dim"),
                    F.size(F.filter("values", lambda x: x != 0)).cast("bigint").alias("nnz"))
