"""Registered prompt, chat, JSON-output and test-case queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import templates as TP
from docweave.functions import text as tx
from docweave.operators import graph as G
from docweave.plans import sqlgen as S
from docweave.plans.q_graph import KG, tpch_graph
from docweave.plans.registry import register


def _definition_question(id_col: str = "id"):
    return F.concat(F.lit("What is "), F.col(id_col), F.lit("?"))


def test_cases(t):
    """One definition case per node, one relationship case per edge."""
    nodes, edges = tpch_graph(t)
    d = nodes.select(F.lit("definition").alias("type"),
                     _definition_question().alias("question"),
                     F.col("id").alias("concepts"), F.col("definition").alias("ground_truth"),
                     F.col("id").alias("concept"), F.lit(None).cast("string").alias("concept2"),
                     F.coalesce(F.col("definition"), F.lit("")).alias("context"))
    r = edges.select(F.lit("relationship").alias("type"),
                     F.concat(F.lit("How are "), F.col("src"), F.lit(" and "), F.col("dst"), F.lit(" related?"))
                     .alias("question"),
                     F.concat_ws("|", "src", "dst").alias("concepts"), F.col("type").alias("ground_truth"),
                     F.col("src").alias("concept"), F.col("dst").alias("concept2"),
                     F.concat(F.col("src"), F.lit(" -"), F.col("type"), F.lit("-> "), F.col("dst")).alias("context"))
    return d.unionByName(r)


_CASES = f"""{KG},
cases AS (
  SELECT 'definition' AS type, 'What is ' || id || '?' AS question, id AS concepts, definition AS ground_truth,
         id AS concept, NULL::VARCHAR AS concept2, coalesce(definition, '') AS context FROM nodes
  UNION ALL
  SELECT 'relationship', 'How are ' || src || ' and ' || dst || ' related?', src || '|' || dst, type,
         src, dst, src || ' -' || type || '-> ' || dst FROM edges)"""


@register("gen_test_cases", f"WITH {_CASES} SELECT type, question, concepts, ground_truth FROM cases")
def gen_test_cases(t):
    """Generated evaluation cases with their ground truth."""
    return test_cases(t).select("type", "question", "concepts", "ground_truth")


def _sql_fill(tpl: str, values: dict[str, str]) -> str:
    out = tpl
    for slot, val in values.items():
        out = f"replace({out}, '{{{slot}}}', coalesce({val}, ''))"
    return out


_TEMPLATES_SQL = "tpl(name, template) AS (VALUES " + ", ".join(
    f"({S.q(k)}, {S.q(v)})" for k, v in sorted(TP.PROMPT_TEMPLATES.items())) + ")"


@register("render_prompts", f"""
WITH {_CASES}, {_TEMPLATES_SQL}
SELECT c.type, c.question,
       {_sql_fill('tp.template', {'context': 'c.context', 'concept': 'c.concept', 'concept1': 'c.concept',
                                   'concept2': 'c.concept2', 'question': 'c.question'})} AS prompt
FROM cases c LEFT JOIN tpl tp ON tp.name = c.type
""")
def render_prompts(t):
    """Template chosen by case type (fixed 3-row template table,
    broadcast), slots filled by column expressions."""
    cases = test_cases(t)
    tpl = F.broadcast(TP.templates_frame(t.spark).select("name", TP.pieces("template").alias("pieces")))  # 3 rows by construction
    j = cases.join(tpl, cases["type"] == tpl["name"], "left")
    prompt = TP.fill_pieces("pieces", {"context": F.col("context"), "concept": F.col("concept"),
                                       "concept1": F.col("concept"), "concept2": F.col("concept2"),
                                       "question": F.col("question")})
    return j.select("type", "question", prompt.alias("prompt"))


_CONTEXTS = """
ranked AS (SELECT src, type, dst, row_number() OVER (PARTITION BY src ORDER BY type, dst) AS k, count(*) OVER (PARTITION BY src) AS n FROM edges),
facts AS (SELECT src, string_agg(src || ' -' || type || '-> ' || dst, '; ' ORDER BY k)
                 || CASE WHEN any_value(n) > 50 THEN ' (and ' || (any_value(n) - 50) || ' more)' ELSE '' END AS facts FROM ranked WHERE k <= 50 GROUP BY src),
ctx AS (SELECT n.id, coalesce(n.definition, '') || '. ' || coalesce(f.facts, '') AS context FROM nodes n LEFT JOIN facts f ON f.src = n.id)"""


@register("kg_prompt", f"""
WITH {KG}, {_TEMPLATES_SQL}, {_CONTEXTS}
SELECT id, {_sql_fill('(SELECT template FROM tpl WHERE name = ' + S.q('definition') + ')',
                       {'context': 'context', 'concept': 'id'})} AS prompt FROM ctx
""")
def kg_prompt(t):
    """for every concept, its definition and its relationships as facts
    "src -type-> dst", rendered with the definition template."""
    ctx = G.fact_contexts(*tpch_graph(t))
    prompt = TP.fill(F.lit(TP.PROMPT_TEMPLATES["definition"]), {"context": F.col("context"), "concept": F.col("id")})
    return ctx.select("id", prompt.alias("prompt"))


@register("test_case_ground_truth", f"""
WITH {KG}, {_CONTEXTS}
SELECT 'definition' AS type, 'What is ' || id || '?' AS question, context AS ground_truth FROM ctx
UNION ALL
SELECT 'relationship', 'How are ' || e.src || ' and ' || e.dst || ' related?',
       e.src || ' -' || e.type || '-> ' || e.dst || '. ' || e.src || ': ' || coalesce(a.definition, '') || '. ' || e.dst || ': ' || coalesce(b.definition, '')
FROM edges e LEFT JOIN nodes a ON a.id = e.src LEFT JOIN nodes b ON b.id = e.dst
""")
def test_case_ground_truth(t):
    """Every generated case with its ground truth as context: a concept's
    definition and facts, a relationship's fact and both definitions."""
    nodes, edges = tpch_graph(t)
    parts = G.by_source(nodes, edges)
    nodes, few, many, _ = parts
    d = G.fact_contexts(nodes, edges, parts=parts).select(F.lit("definition").alias("type"), _definition_question().alias("question"), F.col("context").alias("ground_truth"))
    text = lambda c: nodes.select(F.col("id").alias(c), F.coalesce("definition", F.lit("")).alias(f"{c}_text"))
    # edges are dealt by source once, for contexts and sources' definitions; hubs' edges join apart
    r = few.join(text("src"), "src", "left").unionByName(many.drop("_n").join(text("src"), "src", "left")).join(text("dst"), "dst", "left")
    told = F.concat(G.fact(), *[x for c in ("src", "dst") for x in (F.lit(". "), F.col(c), F.lit(": "), F.coalesce(f"{c}_text", F.lit("")))])
    asked = F.concat(F.lit("How are "), F.col("src"), F.lit(" and "), F.col("dst"), F.lit(" related?"))
    return d.unionByName(r.select(F.lit("relationship").alias("type"), asked.alias("question"), told.alias("ground_truth")))


@register("render_chat", """
SELECT conv_id, count(*)::BIGINT AS n_messages,
       string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat FROM conversations GROUP BY conv_id
""")
def render_chat(t):
    """F16: ordered (role, text) messages of each conversation as one prompt."""
    c = t.conversations
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return c.groupBy("conv_id").agg(
        F.count("*").cast("bigint").alias("n_messages"),
        F.array_join(F.transform(ordered, lambda m: TP.render_messages(m["role"], m["text"])), "\n").alias("chat"))


@register("parse_json_output", """
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.k') AS k_text,
       try_cast(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL AS parsed_ok FROM events
""")
def parse_json_output(t):
    """permissive JSON parsing of a text column (malformed -> nulls)."""
    parsed = F.from_json("props", "k int", {"mode": "PERMISSIVE"})
    return t.events.select("event_id", parsed["k"].alias("k"),
                           F.get_json_object("props", "$.k").alias("k_text"),
                           parsed["k"].isNotNull().alias("parsed_ok"))


_NAMES = """
names AS (SELECT r_name AS name, 'region:' || r_regionkey AS concept FROM region
          UNION ALL SELECT n_name, 'nation:' || n_nationkey FROM nation
          UNION ALL SELECT p_name, 'part:' || p_partkey FROM part)"""


@register("concept_mentions", f"""
WITH {_NAMES},
texts AS (SELECT 'doc:' || doc_id AS text_id, text FROM documents
          UNION ALL SELECT DISTINCT 'name:' || name, 'How do ' || name || ' parts compare?' FROM names),
tk AS (SELECT text_id, {S.tokens(S.clean('text'))} AS tok FROM texts),
dict AS (SELECT DISTINCT {S.tokens(S.clean('name'))} AS words, concept FROM names),
hit AS (SELECT text_id, concept FROM tk JOIN dict
        ON contains(' ' || array_to_string(tok, ' ') || ' ', ' ' || array_to_string(words, ' ') || ' '))
SELECT DISTINCT text_id, concept FROM hit
""")
def concept_mentions(t):
    """Regions, nations and parts whose whole cleaned name, of any number of
    words, occurs in a document or in a question about a name. The phrases to cut
    are as long as the names are (a handful of lengths); names are made distinct
    before the join, and ids follow after it."""
    def named(table, kind, key, name):
        return table.select(F.concat(F.lit(kind + ":"), F.col(key).cast("string")).alias("concept"),
                            F.col(name).alias("name"))
    names = (named(t.region, "region", "r_regionkey", "r_name")
             .unionByName(named(t.nation, "nation", "n_nationkey", "n_name"))
             .unionByName(named(t.part, "part", "p_partkey", "p_name"))
             .filter(F.col("name").isNotNull())
             .withColumn("words", tx.tokenize(tx.clean_text("name"))).filter(F.size("words") > 0)
             .withColumn("key", F.array_join("words", " ")).checkpoint(eager=True))
    texts = (t.documents.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("text_id"), "text")
             .unionByName(names.select("name").distinct().select(
                 F.concat(F.lit("name:"), "name").alias("text_id"),
                 F.concat(F.lit("How do "), "name", F.lit(" parts compare?")).alias("text"))))
    lengths = sorted(r.n for r in names.select(F.size("words").alias("n")).distinct().collect())
    tok = texts.select("text_id", tx.tokenize(tx.clean_text("text")).alias("tok"))
    phrases = F.array_distinct(F.concat(*[_phrases("tok", n) for n in lengths]))
    grams = tok.select("text_id", F.explode(phrases).alias("key"))
    return (grams.join(names.select("key").distinct(), "key")
            .join(names.select("key", "concept"), "key").select("text_id", "concept").distinct())


def _phrases(tok: str, n: int):
    """All runs of ``n`` tokens, joined by spaces."""
    starts = F.when(F.size(tok) >= n, F.sequence(F.lit(1), F.size(tok) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(F.col(tok), i, n), " "))


_TYPED_NAMES = f"""{_NAMES},
dict AS (SELECT DISTINCT {S.tokens(S.clean('name'))} AS words
         FROM (SELECT name FROM names UNION ALL SELECT p_type FROM part UNION ALL SELECT p_brand FROM part))"""


@register("concept_spans", f"""
WITH RECURSIVE {_TYPED_NAMES},
lines AS (SELECT l_orderkey, string_agg(lower(p_brand) || ' ' || p_name, ', ' ORDER BY l_linenumber, l_partkey) AS parts
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
texts AS (SELECT 'doc:' || doc_id AS text_id, text FROM documents
          UNION ALL SELECT 'order:' || o_orderkey, 'Order of ' || parts || ' for a customer in ' || n_name || ' of ' || r_name || '.'
          FROM orders JOIN lines ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
          JOIN region ON r_regionkey = n_regionkey),
tk AS (SELECT text_id, {S.tokens(S.clean('text'))} AS tok FROM texts),
pos AS (SELECT text_id, i::INT AS start, tok FROM tk, range(len(tok)) r(i) WHERE tok[i + 1] IN (SELECT words[1] FROM dict)),
hit AS (SELECT a.text_id, a.start, max(len(d.words))::INT AS n, max_by(array_to_string(d.words, ' '), len(d.words)) AS name
        FROM pos a JOIN dict d ON d.words[1] = a.tok[a.start + 1] AND a.tok[a.start + 1 : a.start + len(d.words)] = d.words GROUP BY a.text_id, a.start),
nxt AS (SELECT a.text_id, a.start, min(b.start) AS next FROM hit a LEFT JOIN hit b ON b.text_id = a.text_id AND b.start >= a.start + a.n GROUP BY ALL),
walk AS (
  SELECT text_id, min(start) AS start FROM hit GROUP BY text_id
  UNION ALL SELECT w.text_id, x.next FROM walk w JOIN nxt x ON x.text_id = w.text_id AND x.start = w.start WHERE x.next IS NOT NULL)
SELECT h.text_id, h.start, h.name FROM walk w JOIN hit h ON h.text_id = w.text_id AND h.start = w.start
""")
def concept_spans(t):
    """Names of regions, nations, parts, their types and brands in documents and
    in descriptions of orders, leftmost and longest: the type "small" is not found
    inside the part name "small ring"."""
    from docweave.operators import concepts
    one = lambda table, c: table.select(F.col(c).alias("name"))
    names = one(t.region, "r_name").unionByName(one(t.nation, "n_name"))
    for c in ("p_name", "p_type", "p_brand"):
        names = names.unionByName(one(t.part, c))
    named = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(
        t.part.select("p_partkey", F.concat(F.lower("p_brand"), F.lit(" "), "p_name").alias("label")), F.col("l_partkey") == F.col("p_partkey"))
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "label")))  # an order has few lines
    lines = named.groupBy("l_orderkey").agg(F.array_join(F.transform(ordered, lambda s: s["label"]), ", ").alias("parts"))
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")
    orders = (t.orders.select("o_orderkey", "o_custkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
              .join(places, F.col("o_custkey") == F.col("c_custkey"))
              .select(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("text_id"),
                      F.concat(F.lit("Order of "), "parts", F.lit(" for a customer in "), "n_name", F.lit(" of "), "r_name", F.lit(".")).alias("text")))
    docs = t.documents.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("text_id"), "text")
    return concepts.name_spans(docs.unionByName(orders), names)
