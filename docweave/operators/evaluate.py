"""Evaluation: runs, accuracy, latency, breakdowns, response checks.

The plan only names these functions; the definitions here are ours:
* a run is (case_id, model, query_type, correct[, response_time]);
* accuracy = mean(correct) per model; weak areas = query types below the
  model's overall accuracy; latency = mean / p50 / p95 / max per model;
* response checks compare the distinct content tokens of a response with
  those of its question (token precision, recall, F1, exact match).
All are aggregations with map-side partial aggregation; the per-pair
checks are row-local array expressions (no token explode, no shuffle).
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.session import written

_ANSWER_TYPE = "struct<response:string,response_time:double>"


def answer_plugin(factory):
    """Answer-model plug-in: ``factory()`` returns ``answer(prompt) -> str``.
    The model is built once per Python worker (iterator pandas UDF fed Arrow
    batches); each answer is timed on its own, as a benchmark run times each
    response. Column -> struct<response, response_time (seconds)>."""
    from docweave.session import ship_package
    ship_package()

    @F.pandas_udf(_ANSWER_TYPE)
    def _answer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        answer = factory()
        for prompts in batches:
            out, took = [], []
            for p in prompts.fillna("").tolist():
                t0 = time.perf_counter()
                out.append(answer(p))
                took.append(time.perf_counter() - t0)
            yield pd.DataFrame({"response": out, "response_time": took})

    return _answer


def run_models(cases: DataFrame, models: dict, prompt_col: str = "prompt") -> DataFrame:
    """Every case answered by every model: one pass over the cases per model
    (a handful of models), rows (<case columns>, model, response,
    response_time), the input of the accuracy and latency reports."""
    if not models:
        raise ValueError("at least one model is needed")
    runs = None
    for name, factory in models.items():
        r = (cases.withColumn("_a", answer_plugin(factory)(F.col(prompt_col)))
             .select(*cases.columns, F.lit(name).alias("model"),
                     F.col("_a.response").alias("response"), F.col("_a.response_time").alias("response_time")))
        runs = r if runs is None else runs.unionByName(r)
    return runs


def accuracy_by_model(runs: DataFrame) -> DataFrame:
    return runs.groupBy("model").agg(F.count("*").cast("bigint").alias("n_cases"),
                                     F.round(F.avg(F.col("correct").cast("double")), 6).alias("accuracy"))


def accuracy_by_type(runs: DataFrame) -> DataFrame:
    g = runs.groupBy("model", "query_type").agg(F.count("*").alias("n"),
                                                F.count_if("correct").alias("k"))
    w = Window.partitionBy("model")  # over the small aggregate only
    return g.select("model", "query_type", F.col("n").cast("bigint").alias("n_cases"),
                    (F.col("k") / F.col("n")).alias("accuracy"),
                    (F.sum("k").over(w) / F.sum("n").over(w)).alias("overall"))


def weak_areas(runs: DataFrame) -> DataFrame:
    a = accuracy_by_type(runs)
    return a.filter(F.col("accuracy") < F.col("overall")).select(
        "model", "query_type", F.round("accuracy", 6).alias("accuracy"), F.round("overall", 6).alias("overall"))


def exact_percentiles(df: DataFrame, group_cols: list[str], value_col: str,
                      ps: dict[str, float]) -> DataFrame:
    """Exact linear-interpolated percentiles per group without gathering a
    group in one task: values are range-partitioned by (group, value) and
    numbered densely (store.with_positions), so the k-th value of a group
    is found by a filter on its position. Only 2 rows per (group, p) are
    fetched; the rest stays where it is."""
    from docweave.operators.store import with_positions
    # a per-row tie-break keeps a hot value (many equal rows) splittable by
    # the range partitioner; equal values are interchangeable for quantiles
    v = (df.select(*group_cols, F.col(value_col).alias("_v")).filter(F.col("_v").isNotNull())
         .withColumn("_tb", F.monotonically_increasing_id()))
    pos = with_positions(v, [*group_cols, "_v", "_tb"], out_col="_pos")
    g = pos.groupBy(*group_cols).agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    tgt = g.select(*group_cols, "_first", F.explode(F.array(*[
        F.struct(F.lit(name).alias("p"), (F.lit(p) * (F.col("_n") - 1)).alias("x"))
        for name, p in ps.items()])).alias("t"))
    tgt = tgt.select(*group_cols, "_first", "t.p", "t.x",
                     F.floor("t.x").cast("bigint").alias("lo"), F.ceil("t.x").cast("bigint").alias("hi"))
    ranks = tgt.select(*group_cols, "_first", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("r"))
    hit = (pos.join(ranks.select(*group_cols, (F.col("_first") + F.col("r")).alias("_pos"), "r").distinct(),
                    [*group_cols, "_pos"])
           .select(*group_cols, "r", "_v"))
    lo = hit.select(*group_cols, F.col("r").alias("lo"), F.col("_v").alias("v_lo"))
    hi = hit.select(*group_cols, F.col("r").alias("hi"), F.col("_v").alias("v_hi"))
    val = (tgt.join(lo, [*group_cols, "lo"]).join(hi, [*group_cols, "hi"])
           .select(*group_cols, "p", (F.col("v_lo") + (F.col("x") - F.col("lo")) * (F.col("v_hi") - F.col("v_lo")))
                   .alias("value")))
    return val.groupBy(*group_cols).pivot("p", list(ps)).agg(F.first("value"))


def latency_by_model(times: DataFrame) -> DataFrame:
    rt = F.col("response_time")
    basic = times.groupBy("model").agg(
        F.count("*").cast("bigint").alias("n"), F.round(F.avg(rt), 6).alias("mean_s"),
        F.round(F.max(rt), 6).alias("max_s"), (F.avg(rt) < 2.0).alias("under_2s"))
    pct = exact_percentiles(times, ["model"], "response_time", {"p50_s": 0.5, "p95_s": 0.95})
    return basic.join(pct, "model").select("model", "n", "mean_s", F.round("p50_s", 6).alias("p50_s"),
                                           F.round("p95_s", 6).alias("p95_s"), "max_s", "under_2s")


def latency_rollup(times: DataFrame) -> DataFrame:
    g = times.rollup("model", "query_type").agg(
        F.grouping_id().cast("bigint").alias("level"), F.count("*").cast("bigint").alias("n"),
        F.round(F.avg("response_time"), 6).alias("mean_s"))
    return g.select(F.coalesce("model", F.lit("ALL")).alias("model"),
                    F.coalesce("query_type", F.lit("ALL")).alias("query_type"), "level", "n", "mean_s")


def success_metrics(runs: DataFrame, custom: str, comparison: str,
                    tolerances=(0.15, 0.20)) -> DataFrame:
    """Per query type: accuracy of both models side by side (pivot with the
    model values listed, so no extra pass), the gap and tolerance checks."""
    p = (runs.groupBy("query_type").pivot("model", [custom, comparison])
         .agg(F.avg(F.col("correct").cast("double"))))
    gap = F.abs(F.col(custom) - F.col(comparison))
    out = p.select("query_type", F.round(custom, 6).alias("acc_custom"),
                   F.round(comparison, 6).alias("acc_comparison"), F.round(gap, 6).alias("gap"))
    for tol in tolerances:
        out = out.withColumn(f"within_{int(round(tol * 100))}pct", F.col("gap") <= F.lit(tol))
    return out


def pair_turns(conv: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it (equi join)."""
    q = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    r = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return q.join(r, ["conv_id", "turn"])


def _ratio(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def case_metrics(pairs: DataFrame) -> DataFrame:
    cq, cr = tx.clean_text("question"), tx.clean_text("response")
    q = F.array_distinct(tx.tokenize(cq))
    r = F.array_distinct(tx.tokenize(cr))
    inter = F.size(F.array_intersect(q, r))
    p, rc = _ratio(inter, F.size(r)), _ratio(inter, F.size(q))
    f1 = _ratio(2 * p * rc, p + rc)
    return pairs.select("conv_id", "turn", (cq == cr).alias("exact_match"),
                        F.round(p, 6).alias("precision"), F.round(rc, 6).alias("recall"),
                        F.round(f1, 6).alias("f1"))


def token_overlap(pairs: DataFrame, key: list[str], question: str = "question", response: str = "response") -> DataFrame:
    """(key, n_question, n_response, n_shared): token counts of both texts, a token that
    comes twice in both counting twice. One row per key and token after a partial
    aggregate in the task that read the text, so neither long texts nor frequent tokens
    meet in one place."""
    side = lambda col, n: pairs.select(*key, F.explode(tx.tokenize(tx.clean_text(col))).alias("_t"), F.lit(n).alias("_q"))
    each = side(question, 1).unionByName(side(response, 0)).groupBy(*key, "_t").agg(
        F.sum("_q").alias("q"), F.sum(1 - F.col("_q")).alias("r"))
    return each.groupBy(*key).agg(F.sum("q").alias("n_question"), F.sum("r").alias("n_response"),
                                  F.sum(F.least("q", "r")).alias("n_shared"))


def case_summary(pairs: DataFrame, case_type: F.Column) -> DataFrame:
    """Per case type: cases, share of exact matches, mean token precision, recall and F1
    (by counts; 0 where a text has no token), and the share of cases under F1 0.5. Pairs
    are told apart by (conv_id, turn)."""
    key = ["conv_id", "turn"]
    cases = pairs.select(*key, case_type.alias("case_type"),
                         F.coalesce(tx.clean_text("question") == tx.clean_text("response"), F.lit(False)).alias("exact"))
    j = cases.join(token_overlap(pairs, key), key, "left")
    n = F.coalesce("n_shared", F.lit(0))
    p, rc = _ratio(n, F.col("n_response")), _ratio(n, F.col("n_question"))
    j = j.select("case_type", "exact", p.alias("p"), rc.alias("rc"), _ratio(2 * n, F.col("n_question") + F.col("n_response")).alias("f1"))
    mean = lambda c: F.round(F.avg(c), 6)
    return j.groupBy("case_type").agg(
        F.count(F.lit(1)).alias("n_cases"), mean(F.col("exact").cast("double")).alias("exact_share"), mean("p").alias("precision"),
        mean("rc").alias("recall"), mean("f1").alias("f1"), mean((F.col("f1") < 0.5).cast("double")).alias("low_share"))


#: The plan's criteria: name, limit, whether the value has to reach it (or stay within it).
CRITERIA = (
    ("concept_coverage", 1.0, True), ("isolated_nodes", 0.0, False), ("verified_relationships", 1.0, True),
    ("definition_gap", 0.15, False), ("relationship_gap", 0.20, False), ("mean_response_s", 2.0, False), ("uptime", 0.95, True))


def success_criteria(nodes: DataFrame, edges: DataFrame, runs: DataFrame, times: DataFrame, calls: DataFrame, custom: str,
                     comparison: str, definition_types: list[str], relationship_types: list[str], timed_model: str) -> DataFrame:
    """(criterion, value, threshold, met), one row for each of ``CRITERIA``.

    Coverage: share of nodes with a definition. Isolated: nodes without any edge. A
    relationship is verified if both its ends are nodes with a definition. Gaps: absolute
    difference of both models' accuracy over the query types of that kind. Response time:
    mean of ``timed_model``; it has to be under its limit. Uptime: share of ``calls`` (ok
    boolean) that are ok. Without rows to judge by, the value is null and nothing is met."""
    share = lambda ok: F.avg(F.coalesce(ok, F.lit(False)).cast("double"))
    defined = nodes.where(F.col("definition").isNotNull()).select("id")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    known = lambda end: defined.select(F.col("id").alias(end), F.lit(True).alias(f"_{end}"))
    checked = edges.join(known("src"), "src", "left").join(known("dst"), "dst", "left")
    right = lambda model, types: F.avg(F.when((F.col("model") == model) & F.col("query_type").isin(types), F.col("correct").cast("double")))
    gap = lambda types: F.abs(right(custom, types) - right(comparison, types))
    found = [nodes.agg(share(F.col("definition").isNotNull()).alias("concept_coverage")),
             nodes.join(ends, "id", "left_anti").agg(F.count(F.lit(1)).cast("double").alias("isolated_nodes")),
             checked.agg(share(F.col("_src") & F.col("_dst")).alias("verified_relationships")),
             runs.agg(gap(definition_types).alias("definition_gap"), gap(relationship_types).alias("relationship_gap")),
             times.where(F.col("model") == timed_model).agg(F.avg("response_time").alias("mean_response_s")),
             calls.agg(share(F.col("ok")).alias("uptime"))]
    limits = {name: (limit, least) for name, limit, least in CRITERIA}
    out = None
    for one in found:   # one row each
        rows = F.array(*[F.struct(F.lit(c).alias("criterion"), F.col(c).alias("value"), F.lit(limits[c][0]).alias("threshold"),
                                  F.lit(limits[c][1]).alias("_least")) for c in one.columns])
        rows = one.select(F.explode(rows).alias("r")).select("r.*")
        out = rows if out is None else out.unionByName(rows)
    met = (F.when(F.col("_least"), F.col("value") >= F.col("threshold"))
           .when(F.col("criterion") == "mean_response_s", F.col("value") < F.col("threshold"))
           .otherwise(F.col("value") <= F.col("threshold")))
    return out.select("criterion", F.round("value", 6).alias("value"), "threshold", F.coalesce(met, F.lit(False)).alias("met"))


def response_checks(pairs: DataFrame) -> DataFrame:
    q = F.array_distinct(tx.remove_stopwords(tx.tokenize(tx.clean_text("question"))))
    r = F.array_distinct(tx.remove_stopwords(tx.tokenize(tx.clean_text("response"))))
    inter = F.size(F.array_intersect(q, r))
    return pairs.select("conv_id", "turn",
                        F.round(_ratio(inter, F.size(r)), 6).alias("factual"),
                        F.round(_ratio(inter, F.size(q)), 6).alias("completeness"))


def quality_gates(checks: DataFrame, threshold: float = 0.8) -> DataFrame:
    return checks.select("conv_id", "turn", (F.col("factual") < threshold).alias("needs_facts"),
                         (F.col("completeness") < threshold).alias("needs_context"))


#: A concept's id in a text: kind, colon, key.
MENTION = r"[A-Za-z_]+:[0-9]+"
SENTENCE_END = r"[.;!?]\s*|\n"


def _stated(relations: dict[str, str], text_col: str) -> F.Column:
    """array<struct<src, type, dst>> of the relations that a text states."""
    known = F.create_map(*[F.lit(x) for phrase, kind in relations.items() for x in (phrase.lower(), kind)])
    pair = lambda m, gap: F.transform(
        F.slice(m, 1, F.greatest(F.size(m) - 1, F.lit(0))),
        lambda a, i: F.struct(a.alias("src"), F.element_at(known, F.lower(F.trim(F.get(gap, i + 1)))).alias("type"), F.get(m, i + 1).alias("dst")))
    said = F.flatten(F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), SENTENCE_END),
                                 lambda s: pair(F.regexp_extract_all(s, F.lit(MENTION), F.lit(0)), F.split(s, MENTION))))
    return F.filter(said, lambda t: t["type"].isNotNull())


def _mentioned(text_col: str) -> F.Column:
    """array<string> of the concept ids in a text."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(MENTION), F.lit(0)))


def statements(texts: DataFrame, relations: dict[str, str], id_col: str, text_col: str) -> DataFrame:
    """Relations that texts state: distinct (id, src, type, dst). A sentence's mentions
    are taken in pairs of neighbours; what stands between two of them, without case
    and outer blanks, is looked up in ``relations`` (phrase -> edge type), and pairs
    with another phrase state nothing. Row-local until the distinct."""
    return texts.select(F.col(id_col).alias("id"), F.explode(_stated(relations, text_col)).alias("t")).select("id", "t.*").distinct()


def mentions(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (id, concept) of the concept ids in texts."""
    return texts.select(F.col(id_col).alias("id"), F.explode(_mentioned(text_col)).alias("concept"))


#: Edges that are held against responses at a time: more of them pass in rounds, each
#: with a share of the statements and targets, so that no step's shuffle is larger.
ROUND_EDGES = 200_000_000

_SUMS = ["n_statements", "n_supported", "n_conflicts", "n_targets", "n_covered"]


def graph_response_checks(responses: DataFrame, edges: DataFrame, relations: dict[str, str], id_col: str = "id",
                          question_col: str = "question", response_col: str = "response") -> DataFrame:
    """Responses held against a graph with one edge per (src, dst).

    * facts: how many of the stated relations the graph has (``n_supported``);
    * consistency: a stated pair that the graph joins by another type is a conflict;
    * completeness: how many targets of the question's concepts are mentioned.

    The texts are read once; what they state and mention is written. Statements meet the
    edges in one join that serves the first two, targets in another; each writes sums per
    response, with partial sums before its shuffle, so that one step's shuffles are on
    disk at a time. Many edges pass in rounds, by a hash of the statement's pair or of the
    target, whose sums add up."""
    rows = lambda kind, found, *fields: F.transform(found, lambda x: F.struct(
        F.lit(kind).alias("kind"), *(f(x).alias(n) for n, f in zip(("src", "type", "dst"), fields))))
    no = lambda x: F.lit(None).cast("string")
    own = lambda x: x
    told = F.concat(rows("response", F.array(F.lit("")), no, no, no),
                    rows("statement", _stated(relations, response_col), *(lambda x, n=n: x[n] for n in ("src", "type", "dst"))),
                    rows("asked", _mentioned(question_col), own, no, no), rows("given", _mentioned(response_col), own, no, no))
    told = written(responses.select(F.col(id_col).alias("id"), F.explode(told).alias("t")).select("id", "t.*").distinct(), "told")
    of = lambda kind, *cols: told.where(F.col("kind") == kind).select("id", *cols)
    rounds = -(-edges.count() // ROUND_EDGES) or 1
    zero = lambda *names: [F.lit(0).cast("long").alias(n) for n in names]
    one = lambda c, n: F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(n)
    sums = [of("response", *zero(*_SUMS))]
    for r in range(rounds):
        in_round = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(rounds)) == r
        said = of("statement", "src", "type", "dst").where(in_round("src", "dst"))
        known = edges.where(in_round("src", "dst")).select("src", "dst", F.col("type").alias("known"))
        facts = said.join(known, ["src", "dst"], "left").groupBy("id").agg(
            F.count(F.lit(1)).alias("n_statements"), one(F.col("known") == F.col("type"), "n_supported"), one(F.col("known") != F.col("type"), "n_conflicts"))
        sums.append(written(facts, "facts").select("id", *_SUMS[:3], *zero(*_SUMS[3:])))
        flags = lambda wanted, given: [F.lit(wanted).alias("wanted"), F.lit(given).alias("given")]
        wanted = of("asked", F.col("src").alias("concept")).join(
            edges.where(in_round("dst")).select(F.col("src").alias("concept"), "dst"), "concept").select("id", F.col("dst").alias("concept"), *flags(1, 0))
        given = of("given", F.col("src").alias("concept"), *flags(0, 1)).where(in_round("concept"))
        covered = wanted.unionByName(given).groupBy("id", "concept").agg(F.max("wanted").alias("wanted"), F.max("given").alias("given"))
        covered = covered.where("wanted = 1").groupBy("id").agg(F.count(F.lit(1)).alias("n_targets"), F.sum("given").alias("n_covered"))
        sums.append(written(covered, "covered").select("id", *zero(*_SUMS[:3]), *_SUMS[3:]))
    sums = reduce(DataFrame.unionByName, sums).groupBy("id").agg(*[F.sum(c).alias(c) for c in _SUMS])
    share = lambda a, b: F.round(_ratio(F.col(a), F.col(b)), 6)
    return sums.select("*", share("n_supported", "n_statements").alias("factual"), share("n_covered", "n_targets").alias("completeness"),
                       (F.col("n_conflicts") == 0).alias("consistent"))


def graph_quality_gates(checks: DataFrame, threshold: float = 0.8) -> DataFrame:
    """What a response needs before it is given: other facts, more context, a resolved conflict."""
    return checks.select("id", (F.col("factual") < threshold).alias("needs_facts"), (F.col("completeness") < threshold).alias("needs_context"),
                         (~F.col("consistent")).alias("needs_review"))


def check_summary(checks: DataFrame, type_col: str) -> DataFrame:
    """Averages of the checks per case type."""
    return checks.groupBy(F.col(type_col).alias("case_type")).agg(
        F.count(F.lit(1)).alias("n_cases"), F.round(F.avg("factual"), 6).alias("factual"), F.round(F.avg("completeness"), 6).alias("completeness"),
        F.round(F.avg(F.col("consistent").cast("double")), 6).alias("consistent"), F.sum("n_conflicts").alias("n_conflicts"))
