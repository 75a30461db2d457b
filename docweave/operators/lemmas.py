"""Noun lemmatisation as a vocabulary job.

1. vocabulary = distinct tokens of the corpus (map-side partial distinct);
2. candidates = rule-based noun stems of each word (suffix rules below);
3. a candidate counts only if it is itself a word of the dictionary (the
   corpus vocabulary, or a supplied dictionary table) - an equi join;
4. lemma = shortest candidate, then alphabetical; words without a valid
   candidate keep their form.

Applying the (word -> lemma) table: the distinct words of each document are
joined with it (AQE broadcasts a small table, splits a hot word's partition
otherwise), and the few words that have a lemma go back to their document as
one map, looked up in the JVM. Tokens themselves are never shuffled one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.session import scratch_path

# Noun suffix substitutions of the WordNet morphology rules,
# in their usual order (suffix, replacement).
NOUN_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def vocabulary(docs: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    return docs.select(F.explode(F.array_distinct(tokens_col)).alias("word")).distinct()


def lemma_table(docs: DataFrame, tokens_col: str = "tokens", dictionary: DataFrame | None = None) -> DataFrame:
    """(word, lemma) for every corpus word whose lemma differs from it."""
    vocab = vocabulary(docs, tokens_col)
    dict_words = (dictionary.select(F.col("word").alias("cand")) if dictionary is not None
                  else vocab.select(F.col("word").alias("cand")))
    rules = F.array(*[F.struct(F.lit(s).alias("suf"), F.lit(r).alias("rep")) for s, r in NOUN_RULES])
    cand = (vocab.select("word", F.explode(rules).alias("r"))
            .filter(F.col("word").endswith(F.col("r.suf")) & (F.length("word") > F.length("r.suf")))
            .select("word", F.concat(F.expr("substring(word, 1, length(word) - length(r.suf))"),
                                     F.col("r.rep")).alias("cand")))
    ok = cand.join(dict_words.distinct(), "cand", "left_semi")
    best = ok.groupBy("word").agg(F.min(F.struct(F.length("cand").alias("l"), F.col("cand").alias("c")))
                                  .alias("b"))
    return best.select("word", F.col("b.c").alias("lemma")).filter(F.col("lemma") != F.col("word"))


def apply_lemmas(docs: DataFrame, lemmas: DataFrame, id_col: str = "doc_id",
                 tokens_col: str = "tokens") -> DataFrame:
    """docs with every token replaced by its lemma; null tokens stay null, and
    rows that share an id (or have none) stay separate rows."""
    hits = (docs.select(id_col, F.explode(F.array_distinct(tokens_col)).alias("word"))
            .join(lemmas.select("word", "lemma"), "word")
            .groupBy(F.col(id_col).alias("_id"))
            .agg(F.map_from_entries(F.collect_set(F.struct("word", "lemma"))).alias("_lemmas")))
    looked_up = F.transform(F.col(tokens_col), lambda w: F.coalesce(F.try_element_at(F.col("_lemmas"), w), w))
    return (docs.join(hits, docs[id_col].eqNullSafe(hits["_id"]), "left")
            .withColumn(tokens_col, F.when(F.col("_lemmas").isNull(), F.col(tokens_col)).otherwise(looked_up))
            .drop("_id", "_lemmas"))


def lemmatized_with_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """((id, tokens), (word, lemma)): clean tokens without stop words, as lemmas, and the
    table they were made with. Token arrays are made once and written, as are the lemmas:
    the vocabulary, the words of each document and the result read them, not the texts."""
    from docweave.operators.ingest import with_tokens
    spark = docs.sparkSession
    path, found = scratch_path(spark, "tokens"), scratch_path(spark, "lemmas")
    with_tokens(docs.select(id_col, text_col), text_col).select(id_col, "tokens").write.parquet(path)
    tokens = spark.read.parquet(path)
    lemma_table(tokens, dictionary=dictionary).write.parquet(found)
    lemmas = spark.read.parquet(found)
    return apply_lemmas(tokens, lemmas, id_col=id_col), lemmas


def lemmatized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dictionary: DataFrame | None = None) -> DataFrame:
    """(id, tokens) of ``lemmatized_with_table``."""
    return lemmatized_with_table(docs, id_col, text_col, dictionary)[0]
