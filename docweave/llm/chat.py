"""Chat formatting of reply trees.

Messages point to the message they reply to. Pointers are doubled by iterative
self-joins (node -> its ancestor 1, 2, 4, ... replies up, with the score summed
over the part skipped), so a tree of depth d takes log2 d joins and every
node ends with its score from the root. Leaves are ranked per tree by that
score, and only the paths of the chosen ones are enumerated, again by
self-joins with the kept pointers: a path of length n is complete after
log2 n steps. Joins are on (tree, node), so a hot tree spreads over all tasks;
one conversation becomes one string, which is the feature.

Template: ``[INST] text [/INST]`` for user, ``<s>text</s>`` for assistant,
``[ROLE name] text [/ROLE]`` for any other role. A control string inside a text
gets a broken bar after its first character; one that already has bars there
gets one more, so taking one away restores every text. The loss mask lists the
byte ranges of the assistant texts in the formatted conversation.

Defined cases: null text is empty, null role is the empty role; messages of a
null tree id form one tree; a parent that does not occur makes its child a
root; messages on a cycle of replies are left out; of messages that repeat a
(tree, node) one is kept - `conversation_messages` numbers rows, so repeated
turns of a conversation are all kept, ordered by turn, role, text; equal
scores go to the smaller leaf; an empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.common import materialize, table

BAR = "¦"
_BODY = r"(/?INST\]|/?ROLE[ \]]|/?s>)"
TURN = r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>|\[ROLE [^\]]*\] .*? \[/ROLE\]"
#: Self-check of the escaping: a user and an assistant who say control strings.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def escape(text: F.Column) -> F.Column:
    return F.regexp_replace(text, rf"([\[<])({BAR}*){_BODY}", f"$1{BAR}$2$3")


def unescape(text: F.Column) -> F.Column:
    return F.regexp_replace(text, rf"([\[<]){BAR}({BAR}*){_BODY}", "$1$2$3")


def tree_key(col: str) -> F.Column:
    return F.when(F.col(col).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(col).cast("string")))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows as messages: every turn replies to the one
    before it; all turns score 0."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(tree_key("conv_id").alias("tree"), "conv_id", "node",
                       F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def chosen_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, node, up, branch_rank, branch_score): the nodes of each tree's
    ``top`` best root-to-leaf paths; ``up`` counts from the leaf."""
    nodes = messages.groupBy("tree", "node").agg(F.max(F.struct("parent", "score")).alias("m")).select("tree", "node", "m.*")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    step = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.coalesce("score", F.lit(0.0)).alias("score"))
    state = materialize(step, "chat-step")
    n = state.count()
    leaves = state.join(state.select("tree", F.col("up").alias("node")), ["tree", "node"], "left_anti").select("tree", "node")
    done, active = state.where("up IS NULL"), state.where("up IS NOT NULL")
    steps = []  # only nodes that are not at their root yet go on
    while active.limit(1).count() and len(steps) <= math.ceil(math.log2(max(2, n))) + 1:
        steps.append(active)
        far = active.unionByName(done).select("tree", F.col("node").alias("up"), F.col("up").alias("far"), F.col("score").alias("more"))
        state = materialize(active.join(far, ["tree", "up"]).select(
            "tree", "node", F.col("far").alias("up"), (F.col("score") + F.col("more")).alias("score")), "chat-step")
        done, active = done.unionByName(state.where("up IS NULL")), state.where("up IS NOT NULL")
    rank = Window.partitionBy("tree").orderBy(F.col("score").desc(), "node")
    whole = done.select("tree", "node", "score").join(leaves, ["tree", "node"])
    best = whole.withColumn("branch_rank", F.row_number().over(rank)).where(F.col("branch_rank") <= top)
    path = best.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"), "branch_rank",
                       F.col("score").alias("branch_score"))
    for k, jump in enumerate(steps):
        far = jump.select("tree", "node", F.col("up").alias("to"))
        path = path.unionByName(path.join(far, ["tree", "node"]).select(
            "tree", "leaf", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"), "branch_rank", "branch_score"))
        path = materialize(path, "chat-path")
    return path


def format_trees(messages: DataFrame, id_col: str = "conv_id", top: int = 1) -> DataFrame:
    """One row per chosen branch: ``id_col``, leaf, branch_rank, branch_score,
    formatted (string), loss_spans (array of byte start and length)."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    body = escape(text)
    segment = (F.when(role == "user", F.concat(F.lit("[INST] "), body, F.lit(" [/INST]")))
               .when(role == "assistant", F.concat(F.lit("<s>"), body, F.lit("</s>")))
               .otherwise(F.concat(F.lit("[ROLE "), F.url_encode(role), F.lit("] "), body, F.lit(" [/ROLE]"))))
    said = messages.select("tree", "node", id_col, segment.alias("segment"), (role == "assistant").alias("loss"))
    said = said.dropDuplicates(["tree", "node"])
    rows = chosen_paths(messages, top).join(said, ["tree", "node"])
    before = Window.partitionBy("tree", "leaf").orderBy(F.col("up").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.octet_length("segment")).over(before), F.lit(0)))
    marks = F.octet_length(F.lit("<s></s>"))
    turns = F.sort_array(F.collect_list(F.struct(
        (-F.col("up")).alias("o"), "segment", "loss", F.col("at").alias("at"), F.octet_length("segment").alias("n"))))
    made = rows.groupBy("tree", "leaf").agg(F.first(id_col).alias(id_col), F.first("branch_rank").alias("branch_rank"),
                                            F.first("branch_score").alias("branch_score"), turns.alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]),
                        lambda t: F.struct((t["at"] + 3).alias("start"), (t["n"] - marks).alias("length")))
    return made.select(id_col, "leaf", "branch_rank", "branch_score",
                       F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: F.Column) -> F.Column:
    """array<struct<role, text>> of a formatted conversation."""

    def turn(s):
        mark = F.regexp_extract(s, r"^(\[ROLE [^\]]*\] )", 1)
        skip = F.when(s.startswith("[INST] "), 7).when(s.startswith("<s>"), 3).otherwise(F.length(mark))
        drop = F.when(s.startswith("<s>"), 4).otherwise(8)
        role = F.when(s.startswith("[INST] "), "user").when(s.startswith("<s>"), "assistant").otherwise(
            F.url_decode(F.regexp_extract(s, r"^\[ROLE ([^\]]*)\] ", 1)))
        return F.struct(role.alias("role"), unescape(F.substr(s, skip + 1, F.length(s) - skip - drop)).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), turn)


def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    messages = materialize(conversation_messages(rows.unionByName(probe)), "chat-messages")
    out = materialize(format_trees(messages).select("conv_id", "formatted", "loss_spans"), "chat-formatted")
    back = out.withColumn("turns", read_turns(F.col("formatted"))).withColumn("bytes", F.encode("formatted", "UTF-8"))
    parts = F.transform("loss_spans", lambda s: unescape(F.decode(F.substr("bytes", s["start"].cast("int") + 1, s["length"].cast("int")), "UTF-8")))
    back = back.withColumn("loss", F.array_join(parts, ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
