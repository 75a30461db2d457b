"""Document ingest: pages -> document -> clean tokens -> chunks -> vectors.

One narrow plan per document row; the only shuffles are assembling pages
into documents (when the input is per page) and the lemma lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions import vectors as vx


def split_pages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stand-in page source: one line of a document is one page (page_no 1..)."""
    return (docs.select(id_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "text"))
            .select(id_col, (F.col("pos") + 1).cast("int").alias("page_no"), "text"))


def assemble_documents(pages: DataFrame, id_col: str = "doc_id", sep: str = "") -> DataFrame:
    """Concatenate page texts in page order (by default pages are glued
    with no separator). Pages are sorted inside each group, not globally."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("page_no"), F.col("text"))))
    return (pages.groupBy(id_col)
            .agg(F.array_join(F.transform(ordered, lambda s: s["text"]), sep).alias("text"),
                 F.count("*").cast("bigint").alias("num_pages")))


def with_tokens(docs: DataFrame, text_col: str = "text", stop_words: bool = True) -> DataFrame:
    toks = tx.tokenize(tx.clean_text(F.col(text_col)))
    if stop_words:
        toks = tx.remove_stopwords(toks)
    return docs.withColumn("tokens", toks)


def chunk_tokens(docs: DataFrame, size: int = 200, id_col: str = "doc_id",
                 tokens_col: str = "tokens", keep: tuple = ()) -> DataFrame:
    """Token chunks with a 0-based chunk_id; documents without tokens yield
    no chunk (and so no vector)."""
    arr = tx.token_chunks(F.col(tokens_col), size)
    return docs.select(id_col, *keep, F.posexplode(arr).alias("chunk_id", "chunk_text"))


def chunk_chars(docs: DataFrame, size: int = 1000, overlap: int = 200, id_col: str = "doc_id",
                text_col: str = "text", keep: tuple = ()) -> DataFrame:
    arr = tx.char_chunks(F.col(text_col), size, overlap)
    return docs.select(id_col, *keep, F.posexplode(arr).alias("chunk_id", "chunk_text"))


def embed_texts(df: DataFrame, text_col: str = "chunk_text", out_col: str = "values",
                dim: int = vx.DEFAULT_DIM, max_tokens: int | None = None, encoder_col: str | None = None) -> DataFrame:
    """Built-in hashed encoder over already cleaned, space-joined text, whole
    unless ``max_tokens`` gives an input window. ``encoder_col``: a column with the
    encoder's name, for a store that holds vectors of several."""
    toks = F.filter(F.split(F.col(text_col), " "), lambda t: t != F.lit(""))
    out = df.withColumn(out_col, vx.embed_tokens(toks, dim, max_tokens))
    return out if encoder_col is None else out.withColumn(encoder_col, F.lit(vx.encoder_name(dim, max_tokens)))


def ingest_chunks(docs: DataFrame, size: int = 200, id_col: str = "doc_id", text_col: str = "text",
                  lemmas: DataFrame | None = None) -> DataFrame:
    """documents -> (doc_id, chunk_id, chunk_text) after clean, tokenize,
    stop-word removal and (optionally) lemma replacement."""
    d = with_tokens(docs.select(id_col, text_col), text_col)
    if lemmas is not None:
        from docweave.operators.lemmas import apply_lemmas
        d = apply_lemmas(d, lemmas, id_col=id_col)
    return chunk_tokens(d, size, id_col=id_col)


def vector_objects(chunks: DataFrame, meta: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Vector objects: id "<filename>_chunk_<i>", values, metadata struct =
    file metadata spread plus chunk_id and the first 1000 characters."""
    j = chunks.join(meta, id_col, "inner")
    md_fields = [c for c in meta.columns if c != id_col]
    return j.select(
        F.concat_ws("_chunk_", F.col("filename"), F.col("chunk_id").cast("string")).alias("id"),
        F.col("values"),
        F.struct(*[F.col(c) for c in md_fields],
                 F.col("chunk_id").cast("int").alias("chunk_id"),
                 tx.truncate_chars("chunk_text", 1000).alias("chunk_text")).alias("metadata"),
    )


def chunk_counts(chunks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Chunks per document plus a grand total row (rollup; the total row has
    is_total = 1 and id -1)."""
    return (chunks.rollup(id_col)
            .agg(F.grouping(id_col).cast("bigint").alias("is_total"),
                 F.count("*").cast("bigint").alias("n_chunks"))
            .select(F.coalesce(F.col(id_col), F.lit(-1)).alias(id_col), "is_total", "n_chunks"))


def quarantine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Status per document instead of dropping it: 'ok', or 'error' with the
    reason. A document whose text yields no token after cleaning and stop
    words produces no chunk; it is reported, not silently lost."""
    d = with_tokens(docs.select(id_col, text_col), text_col)
    reason = (F.when(F.col(text_col).isNull(), F.lit("no text"))
              .when(F.size("tokens") == 0, F.lit("no tokens after cleaning")))
    return d.select(id_col, F.when(reason.isNull(), F.lit("ok")).otherwise(F.lit("error")).alias("status"),
                    reason.alias("error"), F.size("tokens").cast("bigint").alias("n_tokens"))
