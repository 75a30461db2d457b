"""Registered text queries: cleaning, tokens, stop words, chunking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import ingest, pagechunks
from docweave.plans import sqlgen as S
from docweave.plans.registry import register


@register("clean_text", f"""
SELECT doc_id, {S.clean('text')} AS clean_text FROM documents
""")
def clean_text(t):
    """punctuation deleted, whitespace collapsed, trimmed, lower case."""
    return t.documents.select("doc_id", tx.clean_text("text").alias("clean_text"))


@register("tokenize", f"""
WITH tk AS (SELECT doc_id, {S.tokens(S.clean('text'))} AS toks FROM documents)
SELECT doc_id, len(toks)::BIGINT AS n_tokens, array_to_string(toks, '|') AS tokens FROM tk
""")
def tokenize(t):
    """whitespace tokens of the cleaned text, contractions split."""
    toks = tx.tokenize(tx.clean_text("text"))
    return t.documents.select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"),
                              F.array_join(toks, "|").alias("tokens"))


@register("remove_stopwords", f"""
WITH tk AS (SELECT doc_id, {S.tokens(S.clean('text'))} AS toks FROM documents),
kp AS (SELECT doc_id, toks, {S.drop_stop('toks')} AS kept FROM tk)
SELECT doc_id, len(toks)::BIGINT AS n_tokens, len(kept)::BIGINT AS n_kept,
       array_to_string(kept, ' ') AS kept_text FROM kp
""")
def remove_stopwords(t):
    """Stop-word filter after cleaning (so apostrophe forms never match)."""
    toks = tx.tokenize(tx.clean_text("text"))
    d = t.documents.select("doc_id", toks.alias("toks"))
    kept = tx.remove_stopwords("toks")
    return d.select("doc_id", F.size("toks").cast("bigint").alias("n_tokens"),
                    F.size(kept).cast("bigint").alias("n_kept"),
                    F.array_join(kept, " ").alias("kept_text"))


def _token_chunk_sql(size: int) -> str:
    return f"""
WITH {S.doc_tokens_cte()}, {S.token_chunks_cte(size)}
SELECT doc_id, chunk_id, (len(string_split(chunk_text, ' ')))::BIGINT AS n_tokens, chunk_text FROM chunks
"""


def _token_chunks(t, size):
    ch = ingest.ingest_chunks(t.documents, size=size)
    return ch.select("doc_id", F.col("chunk_id").cast("bigint").alias("chunk_id"),
                     F.size(F.split("chunk_text", " ")).cast("bigint").alias("n_tokens"), "chunk_text")


@register("token_chunks", _token_chunk_sql(200))
def token_chunks(t):
    """200-token chunks (stop words removed), 0-based chunk ids."""
    return _token_chunks(t, 200)


@register("token_chunks_512", _token_chunk_sql(512))
def token_chunks_512(t):
    """the 512-token variant."""
    return _token_chunks(t, 512)


@register("char_chunks", f"""
WITH c AS (SELECT doc_id, {S.clean('text')} AS ct FROM documents),
k AS (SELECT doc_id, ct, unnest(generate_series(0, CASE WHEN length(ct) <= 1000 THEN 0
        ELSE ceil((length(ct) - 1000) / 800)::BIGINT END)) AS chunk_id FROM c WHERE length(ct) > 0)
SELECT doc_id, chunk_id::BIGINT AS chunk_id, substring(ct, chunk_id * 800 + 1, 1000) AS chunk_text,
       length(substring(ct, chunk_id * 800 + 1, 1000))::BIGINT AS n_chars FROM k
""")
def char_chunks(t):
    """1000-character windows with 200 overlap over the cleaned text."""
    d = t.documents.select("doc_id", tx.clean_text("text").alias("ct"))
    ch = ingest.chunk_chars(d, 1000, 200, text_col="ct")
    return ch.select("doc_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "chunk_text",
                     F.length("chunk_text").cast("bigint").alias("n_chars"))


@register("chunk_overlap_check", f"""
WITH c AS (SELECT doc_id, {S.clean('text')} AS ct FROM documents),
k AS (SELECT doc_id, ct, unnest(generate_series(0, CASE WHEN length(ct) <= 1000 THEN 0
        ELSE ceil((length(ct) - 1000) / 800)::BIGINT END)) AS chunk_id FROM c WHERE length(ct) > 0),
ch AS (SELECT doc_id, chunk_id, substring(ct, chunk_id * 800 + 1, 1000) AS chunk_text FROM k),
l AS (SELECT doc_id, chunk_id, chunk_text,
             lag(chunk_text) OVER (PARTITION BY doc_id ORDER BY chunk_id) AS prev FROM ch)
SELECT doc_id, count(*)::BIGINT AS n_chunks,
       count_if(prev IS NOT NULL)::BIGINT AS n_pairs,
       count_if(prev IS NOT NULL AND substring(prev, 801, 200) = substring(chunk_text, 1, 200))::BIGINT AS n_overlap_ok
FROM l GROUP BY doc_id
""")
def chunk_overlap_check(t):
    """K9: neighbouring character chunks share exactly the overlap."""
    d = t.documents.select("doc_id", tx.clean_text("text").alias("ct"))
    ch = ingest.chunk_chars(d, 1000, 200, text_col="ct")
    w = Window.partitionBy("doc_id").orderBy("chunk_id")
    l = ch.withColumn("prev", F.lag("chunk_text").over(w))
    ok = F.col("prev").isNotNull() & (F.substring("prev", 801, 200) == F.substring("chunk_text", 1, 200))
    return l.groupBy("doc_id").agg(F.count("*").cast("bigint").alias("n_chunks"),
                                   F.count_if(F.col("prev").isNotNull()).cast("bigint").alias("n_pairs"),
                                   F.count_if(ok).cast("bigint").alias("n_overlap_ok"))


@register("chunk_counts", f"""
WITH {S.doc_tokens_cte()}, {S.token_chunks_cte(200)}
SELECT coalesce(doc_id, -1) AS doc_id, grouping(doc_id)::BIGINT AS is_total,
       count(*)::BIGINT AS n_chunks FROM chunks GROUP BY ROLLUP (doc_id)
""")
def chunk_counts(t):
    """Chunks per document and the grand total (is_total = 1, doc_id -1)."""
    ch = ingest.ingest_chunks(t.documents, size=200)
    return ingest.chunk_counts(ch)


@register("assemble_document", """
WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS pg,
                  unnest(generate_series(1, len(string_split(text, chr(10))))) AS page_no FROM documents)
SELECT doc_id, string_agg(pg, '' ORDER BY page_no) AS text, count(*)::BIGINT AS num_pages
FROM p GROUP BY doc_id
""")
def assemble_document(t):
    """Pages (one line = one page) concatenated in page order, no separator."""
    pages = ingest.split_pages(t.documents)
    return ingest.assemble_documents(pages)


@register("page_chunks", f"""
WITH {S.doc_tokens_cte(text_col="replace(text, chr(10), '')")}, {S.token_chunks_cte(200)}
SELECT doc_id, chunk_id, chunk_text FROM chunks
""")
def page_chunks(t):
    """S5 with F3: 200-token chunks over the pages of each document (one line = one page,
    glued with no separator) without ever gluing a document."""
    ch = pagechunks.chunk_pages(ingest.split_pages(t.documents), 200)
    return ch.select("doc_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "chunk_text")


@register("ingest_quarantine", f"""
WITH {S.doc_tokens_cte()}
SELECT doc_id, CASE WHEN len(toks) = 0 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN len(toks) = 0 THEN 'no tokens after cleaning' END AS error,
       len(toks)::BIGINT AS n_tokens FROM dtok
""")
def ingest_quarantine(t):
    """Per-document status instead of silently dropping failures."""
    return ingest.quarantine(t.documents)


@register("union_sources", f"""
SELECT 'documents' AS source, doc_id AS item_id, CAST(-1 AS BIGINT) AS turn, {S.clean('text')} AS clean_text FROM documents
UNION ALL
SELECT 'conversations' AS source, conv_id AS item_id, turn, {S.clean('text')} AS clean_text FROM conversations
""")
def union_sources(t):
    """Results of several sources concatenated by name."""
    d = t.documents.select(F.lit("documents").alias("source"), F.col("doc_id").alias("item_id"),
                           F.lit(-1).cast("bigint").alias("turn"), tx.clean_text("text").alias("clean_text"))
    c = t.conversations.select(F.lit("conversations").alias("source"), F.col("conv_id").alias("item_id"),
                               F.col("turn").cast("bigint").alias("turn"), tx.clean_text("text").alias("clean_text"))
    return d.unionByName(c)


@register("iso_times", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_iso,
       epoch_us(ts)::DOUBLE / 1000000.0 AS ts_epoch FROM events
""")
def iso_times(t):
    """Timestamps as ISO text (UTC) and as float epoch seconds."""
    return t.events.select("event_id", tx.iso_time("ts").alias("ts_iso"),
                           (F.unix_micros(F.col("ts").cast("timestamp")).cast("double") / 1e6).alias("ts_epoch"))


def _lemma_ctes() -> str:
    from docweave.operators.lemmas import NOUN_RULES
    rules = ", ".join(f"({S.q(s)}, {S.q(r)})" for s, r in NOUN_RULES)
    return f"""{S.doc_tokens_cte()},
vocab AS (SELECT DISTINCT unnest(toks) AS word FROM dtok),
rules(suf, rep) AS (VALUES {rules}),
cand AS (SELECT v.word, substring(v.word, 1, length(v.word) - length(r.suf)) || r.rep AS c
         FROM vocab v JOIN rules r ON suffix(v.word, r.suf) AND length(v.word) > length(r.suf)),
ok AS (SELECT cand.* FROM cand WHERE c IN (SELECT word FROM vocab)),
lem AS (SELECT word, first(c ORDER BY length(c), c) AS lemma FROM ok GROUP BY word),
lemd AS (SELECT * FROM lem WHERE lemma <> word)"""


@register("lemma_vocab", f"""
WITH {_lemma_ctes()}
SELECT word, lemma FROM lemd
""")
def lemma_vocab(t):
    """rule + vocabulary noun lemmas (only words whose lemma differs)."""
    from docweave.operators.lemmas import lemma_table
    return lemma_table(ingest.with_tokens(t.documents.select("doc_id", "text")))


@register("lemmatize", f"""
WITH {_lemma_ctes()},
ex AS (SELECT doc_id, unnest(toks) AS word, unnest(generate_series(1, len(toks))) AS p FROM dtok),
lx AS (SELECT ex.doc_id, ex.p, coalesce(lemd.lemma, ex.word) AS w FROM ex LEFT JOIN lemd USING (word))
SELECT d.doc_id, len(d.toks)::BIGINT AS n_tokens,
       coalesce((SELECT string_agg(w, ' ' ORDER BY p) FROM lx WHERE lx.doc_id = d.doc_id), '') AS lemma_text
FROM dtok d
""")
def lemmatize(t):
    """Every token replaced by its lemma (a map of its lemmas per document)."""
    from docweave.operators.lemmas import lemmatized
    out = lemmatized(t.documents)
    return out.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                      F.array_join("tokens", " ").alias("lemma_text"))


@register("lemma_chunks", f"""
WITH {_lemma_ctes()},
ex AS (SELECT doc_id, unnest(toks) AS word, unnest(generate_series(1, len(toks))) AS p FROM dtok),
lx AS (SELECT ex.doc_id, ex.p, coalesce(lemd.lemma, ex.word) AS w FROM ex LEFT JOIN lemd USING (word)),
ltok AS (SELECT doc_id, list(w ORDER BY p) AS toks FROM lx GROUP BY doc_id),
{S.token_chunks_cte(200, src="ltok")}
SELECT doc_id, chunk_id, chunk_text FROM chunks
""")
def lemma_chunks(t):
    """F5/J7 in the ingest path: clean, tokens, stop words, lemmas, 200-token chunks."""
    from docweave.operators.lemmas import lemmatized
    ch = ingest.chunk_tokens(lemmatized(t.documents), 200)
    return ch.select("doc_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "chunk_text")
