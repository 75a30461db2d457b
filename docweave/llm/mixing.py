"""Mixing sources to target weights.

Tokens (words) are aggregated per source; a source's share of all tokens is
turned into a repetition rate target / size; every document is emitted
floor(rate) times plus one hash-seeded Bernoulli copy with probability equal
to the fraction of the rate.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating,
and share the total; no target exceeds ``max_repeats`` times its source's
size, what is cut off is shared again by weight until none exceeds. That
fixed point is a water level L: target = min(cap, L * weight). With sources
sorted by cap / weight and L_i = (total - caps before i) / (weights from i on),
L rises while sources are capped and falls after, so L = max(L_i).

Defined cases: null text has size 0; null source is a source of its own;
a source of size 0 has target 0 and its documents are not taken; an empty
table gives no rows. The draw depends on the document's id and the seed only,
so reruns agree and repeated rows are decided alike. The one-row-per-source
table is the only thing joined; it is broadcast when its counted rows are
under ``MAX_BROADCAST_SOURCES``, otherwise joined by a shuffle that AQE can
split, with the same result. Columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.common import materialize, table, without, word_count

MAX_BROADCAST_SOURCES = 100_000
MAX_REPEATS = 3
SEED = "mix-1"
OUT = ("size", "source_size", "target", "copies", "taken")


def source_targets(per_source: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> plus target (double). One row per source, so
    the windows over the whole frame sort as many rows as there are sources."""
    every = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    d = per_source.withColumn("weight", (F.row_number().over(every) - 1) % 3 + 1)
    d = d.withColumn("cap", (max_repeats * F.col("source_size")).cast("double"))
    fill = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    d = d.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
    d = d.withColumn("target", F.least("cap", F.max("level").over(whole) * F.col("weight")))
    return d.select("source", "source_size", "target")


def draw(id_col: str, seed: str = SEED) -> F.Column:
    """Uniform double in [0, 1) from 52 bits of a hash of the id and the seed."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, size: F.Column | None = None, source_col: str = "source", id_col: str = "doc_id",
                max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """``docs`` plus size (default: words of ``text``), source_size, target, copies, taken."""
    sized = docs.withColumn("__n", word_count("text") if size is None else size)
    sized = without(sized, *OUT).withColumnRenamed("__n", "size")
    per = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(per, max_repeats), "mix-targets").select(
        F.col("source").alias("__source"), F.col("source_size").alias("__size"), F.col("target").alias("__target"))
    if targets.count() <= MAX_BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.coalesce(F.col("__target") / F.nullif(F.col("__size"), F.lit(0)), F.lit(0.0))
    j = sized.join(targets, F.col(source_col).eqNullSafe(F.col("__source")), "inner")
    j = j.withColumn("__rate", rate)
    j = j.withColumn("copies", (F.floor("__rate") + (draw(id_col, seed) < F.col("__rate") - F.floor("__rate")).cast("long")))
    return j.select(*sized.columns, F.col("__size").alias("source_size"), F.col("__target").alias("target"),
                    "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row ``copies`` times."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*columns)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", word_count("text").alias("n")), "mix-sizes")
    return mix_sources(sized, F.col("n")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it."""
    return emit_copies(mix_sources(docs), docs.columns)


OP5_SQL = f"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, ({MAX_REPEATS} * source_size)::DOUBLE AS cap FROM g),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM w),
t AS (SELECT source, source_size, least(cap, max(lvl) OVER () * weight) AS target FROM l),
r AS (SELECT doc_id, size, source_size, target, coalesce(target / nullif(source_size, 0), 0.0) AS rate,
        ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(rate) + (u < rate - floor(rate))::INT) * size)::BIGINT AS taken FROM r"""
