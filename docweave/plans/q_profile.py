"""Registered profile and file-source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave import schemas
from docweave.functions.text import WS_CLASS
from docweave.operators import ingest, profile
from docweave.plans.registry import register
from docweave.session import scratch_path
from docweave.sources import files

_PROFILE_COLS = ["doc_id", "name", "size", "is_text_based", "is_scanned", "page_count",
                 "has_images", "has_tables", "estimated_word_count"]

_PROFILE_CTE = f"""
pp AS (SELECT doc_id, text, string_split(text, chr(10)) AS pages FROM documents),
pf AS (SELECT *, pages[1] AS first, regexp_replace(pages[1], '[{WS_CLASS}]+', '', 'g') <> '' AS tb FROM pp),
prof AS (SELECT doc_id, 'doc_' || doc_id::VARCHAR || '.pdf' AS name, strlen(text)::BIGINT AS size,
       tb AS is_text_based, NOT tb AS is_scanned, len(pages)::INTEGER AS page_count,
       len(list_filter(pages, lambda x: regexp_matches(x, '^!\\[|<img'))) > 0 AS has_images,
       len(list_filter(pages, lambda x: contains(x, ' | '))) > 0 AS has_tables,
       (CASE WHEN tb THEN len(list_filter(string_split_regex(regexp_replace(first,
            '^[{WS_CLASS}]+|[{WS_CLASS}]+$', '', 'g'), '[{WS_CLASS}]+'), lambda w: w <> '')) ELSE 0 END)::INTEGER
            AS estimated_word_count
FROM pf)
"""


@register("doc_profile", f"WITH {_PROFILE_CTE} SELECT * FROM prof")
def doc_profile(t):
    """One profile row per document, no shuffle."""
    return profile.profile_documents(t.documents).select(*_PROFILE_COLS)


@register("page_profile", f"""WITH {_PROFILE_CTE}
SELECT doc_id, is_text_based, is_scanned, page_count, has_images, has_tables, estimated_word_count FROM prof""")
def page_profile(t):
    """G2/G3/G4 from page rows: page features first, then a small-column group by."""
    pages = ingest.split_pages(t.documents)
    return profile.profile_pages(pages)


@register("profile_summary", f"""WITH {_PROFILE_CTE}
SELECT count(*)::BIGINT AS total_files, count_if(is_text_based)::BIGINT AS text_based,
       count_if(is_scanned)::BIGINT AS scanned, count_if(has_images)::BIGINT AS with_images,
       count_if(has_tables)::BIGINT AS with_tables, round(avg(estimated_word_count), 2) AS mean_words,
       sum(estimated_word_count)::BIGINT AS total_words FROM prof""")
def profile_summary(t):
    """G1: count, four flag counts, mean (2 decimals) and total first-page words."""
    return profile.profile_summary(profile.profile_documents(t.documents))


@register("csv_profile_roundtrip", f"WITH {_PROFILE_CTE} SELECT * FROM prof")
def csv_profile_roundtrip(t):
    """Profile written as CSV with a header, read back with the declared schema."""
    path = scratch_path(t.spark, "profile-csv")
    prof = profile.profile_documents(t.documents)
    prof.drop("doc_id").write.mode("overwrite").option("header", True).csv(path)
    back = t.spark.read.schema(schemas.DOC_PROFILE).option("header", True).option("mode", "FAILFAST").csv(path)
    back = back.withColumn("doc_id", F.regexp_extract("name", r"^doc_(\d+)\.pdf$", 1).cast("bigint"))
    return back.select(*_PROFILE_COLS)


def _list(t, recursive, case_sensitive):
    return files.list_files(t.spark, t.sf_dir, "parquet", recursive=recursive, case_sensitive=case_sensitive)


@register("src_list_recursive")
def src_list_recursive(t):
    """Recursive, case-insensitive suffix listing (content never read)."""
    return _list(t, True, False).select(F.regexp_extract("path", r"[^/]+$", 0).alias("filename"),
                                        F.col("length").cast("bigint").alias("file_size"))


@register("src_list_flat")
def src_list_flat(t):
    """Flat, case-sensitive listing."""
    return _list(t, False, True).select(F.regexp_extract("path", r"[^/]+$", 0).alias("filename"),
                                        F.col("length").cast("bigint").alias("file_size"))


@register("src_file_metadata")
def src_file_metadata(t):
    """Basename, size, modification time as ISO text and epoch seconds."""
    return files.file_metadata(_list(t, False, True)).drop("path")
