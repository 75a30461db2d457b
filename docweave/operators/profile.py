"""Document corpus profile: one row per document, then a summary.

Two entry points:

* ``profile_documents`` works on whole-document rows whose pages are the
  lines of the text; every feature is a row-local expression, so profiling
  needs no shuffle at all.
* ``profile_pages`` works on page rows (e.g. from an extractor plug-in).
  Page features are computed first and only those small columns (not the
  page text) are shuffled to group pages by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.text import WS_CLASS

TABLE_MARK = " | "          # a cell separator inside a line of text
IMAGE_PATTERN = r"^!\[|<img"  # an embedded picture reference


def words(col) -> F.Column:
    """Number of whitespace-separated words (Python ``str.split()``)."""
    parts = F.split(F.regexp_replace(col, f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", ""), f"[{WS_CLASS}]+")
    return F.size(F.filter(parts, lambda w: w != F.lit("")))


def _is_text(col) -> F.Column:
    return F.regexp_replace(col, f"[{WS_CLASS}]+", "") != F.lit("")


def profile_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    pages = F.split(F.col(text_col), "\n")
    first = F.element_at(pages, 1)
    text_based = _is_text(first)
    return docs.select(
        id_col,
        F.concat(F.lit("doc_"), F.col(id_col).cast("string"), F.lit(".pdf")).alias("name"),
        F.octet_length(text_col).cast("bigint").alias("size"),
        F.lit(None).cast("double").alias("created_time"),
        F.lit(None).cast("double").alias("modified_time"),
        text_based.alias("is_text_based"),
        (~text_based).alias("is_scanned"),
        F.size(pages).cast("int").alias("page_count"),
        F.exists(pages, lambda p: p.rlike(IMAGE_PATTERN)).alias("has_images"),
        F.exists(pages, lambda p: F.instr(p, TABLE_MARK) > 0).alias("has_tables"),
        # first page only (the profile's "estimated" count); scanned -> 0
        F.when(text_based, words(first)).otherwise(F.lit(0)).cast("int").alias("estimated_word_count"),
    )


def profile_pages(pages: DataFrame, id_col: str = "doc_id") -> DataFrame:
    feats = pages.select(
        id_col, "page_no",
        (F.instr(F.col("text"), TABLE_MARK) > 0).alias("_tab"),
        F.col("text").rlike(IMAGE_PATTERN).alias("_img"),
        F.when(F.col("page_no") == 1, _is_text(F.col("text"))).alias("_first_text"),
        F.when(F.col("page_no") == 1, words(F.col("text"))).alias("_first_words"))
    g = feats.groupBy(id_col).agg(
        F.count("*").cast("int").alias("page_count"),
        F.bool_or("_tab").alias("has_tables"), F.bool_or("_img").alias("has_images"),
        F.coalesce(F.max("_first_text"), F.lit(False)).alias("is_text_based"),
        F.max("_first_words").alias("_w"))
    return g.select(id_col, "is_text_based", (~F.col("is_text_based")).alias("is_scanned"), "page_count",
                    "has_images", "has_tables",
                    F.when(F.col("is_text_based"), F.col("_w")).otherwise(0).cast("int").alias("estimated_word_count"))


def profile_summary(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.count("*").cast("bigint").alias("total_files"),
        F.count_if("is_text_based").cast("bigint").alias("text_based"),
        F.count_if("is_scanned").cast("bigint").alias("scanned"),
        F.count_if("has_images").cast("bigint").alias("with_images"),
        F.count_if("has_tables").cast("bigint").alias("with_tables"),
        F.round(F.avg("estimated_word_count"), 2).alias("mean_words"),
        F.sum("estimated_word_count").cast("bigint").alias("total_words"))
