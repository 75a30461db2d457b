"""Registered vector-store queries: objects, ids, batches, upsert, verify."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions import vectors as vx
from docweave.operators import ingest, store
from docweave.operators.vectorops import signature
from docweave.plans import sqlgen as S
from docweave.plans.q_vectors import chunk_vectors
from docweave.plans.registry import register
from docweave.session import scratch_path, written
from docweave.sources import json_io

_CH = f"{S.doc_tokens_cte()}, {S.token_chunks_cte(200)}"
_HV = S.hashed_vectors_ctes("chunks", "doc_id, chunk_id", "chunk_text")


def _batches_sql(src: str, name: str) -> str:
    return (f"{name}_p AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos, count(*) OVER () AS n FROM {src}), "
            f"{name} AS (SELECT *, pos // 100 AS batch, 'namespace_' || (least((pos // 100 + 1) * 100 - 1, n - 1) // 1000)::VARCHAR "
            f"AS namespace, 'namespace_' || (n // 1000)::VARCHAR AS last_namespace FROM {name}_p)")


# --- vector objects ---------------------------------------------------------

def _doc_meta(t):
    d = t.documents
    return d.select("doc_id",
                    F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("filename"),
                    F.octet_length("text").cast("bigint").alias("file_size"),
                    F.lit(None).cast("string").alias("creation_date"),
                    F.lit(None).cast("string").alias("last_modified"),
                    F.size(F.split("text", "\n")).cast("int").alias("num_pages"),
                    F.coalesce(F.col("source"), F.lit("Unknown")).alias("author"),
                    F.coalesce(F.lit(None).cast("string"), F.lit("Unknown")).alias("creation_date_pdf"))


def vector_object_frame(t):
    return ingest.vector_objects(chunk_vectors(t), _doc_meta(t))


def _flat_objects(v):
    return v.select("id", F.size("values").cast("bigint").alias("dim"),
                    F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 6).alias("l1"),
                    "metadata.filename", "metadata.file_size", F.col("metadata.num_pages").cast("bigint").alias("num_pages"),
                    "metadata.author", "metadata.creation_date_pdf",
                    F.col("metadata.chunk_id").cast("bigint").alias("chunk_id"),
                    F.col("metadata.chunk_text").alias("chunk_text"))


_OBJECTS_SQL = f"""
WITH {_CH}, {_HV},
sig AS (SELECT doc_id, chunk_id, sum(abs(v)) AS l1 FROM h_vec GROUP BY ALL)
SELECT 'doc_' || c.doc_id::VARCHAR || '.pdf_chunk_' || c.chunk_id::VARCHAR AS id, 64::BIGINT AS dim,
       round(coalesce(s.l1, 0.0), 6) AS l1,
       'doc_' || c.doc_id::VARCHAR || '.pdf' AS filename, strlen(d.text)::BIGINT AS file_size,
       len(string_split(d.text, chr(10)))::BIGINT AS num_pages, coalesce(d.source, 'Unknown') AS author,
       'Unknown' AS creation_date_pdf, c.chunk_id, substring(c.chunk_text, 1, 1000) AS chunk_text
FROM chunks c JOIN documents d USING (doc_id) LEFT JOIN sig s USING (doc_id, chunk_id)
"""


@register("vector_objects", _OBJECTS_SQL)
def vector_objects(t):
    """Id "<file>_chunk_<i>", values, metadata spread + chunk fields."""
    return _flat_objects(vector_object_frame(t))


@register("json_vectors_roundtrip", _OBJECTS_SQL)
def json_vectors_roundtrip(t):
    """Vector objects written as JSON, read back strictly (FAILFAST, declared schema)."""
    path = scratch_path(t.spark, "vectors-json")
    json_io.write_vectors_json(vector_object_frame(t), path)
    return _flat_objects(json_io.read_vectors_json(t.spark, path))


@register("metadata_defaults", """
SELECT doc_id, 'doc_' || doc_id::VARCHAR || '.pdf' AS filename, coalesce(source, 'Unknown') AS author,
       'Unknown' AS creation_date_pdf FROM documents
""")
def metadata_defaults(t):
    """author / PDF creation date default to 'Unknown' when the info
    record lacks them (the stand-in info record carries the source as author
    and no creation date)."""
    m = _doc_meta(t)
    return m.select("doc_id", "filename", "author", "creation_date_pdf")


# --- ids, batches, namespaces -------------------------------------------------

def _emb_items(t):
    return t.embeddings.select(F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("id"),
                               F.col("embedding").alias("values"))


@register("assign_batches", f"""
WITH e AS (SELECT 'vec_' || vec_id::VARCHAR AS id FROM embeddings), {_batches_sql('e', 'b')}
SELECT id, pos::BIGINT AS pos, batch::BIGINT AS batch, namespace FROM b
""")
def assign_batches(t):
    """K2: batch of 100 by stable position (order by id), no single-task window."""
    b = store.assign_batches(_emb_items(t).select("id"), ["id"])
    return b.select("id", "pos", "batch", "namespace")


@register("assign_namespaces", f"""
WITH {_CH}, e AS (SELECT doc_id::VARCHAR || '_chunk_' || chunk_id::VARCHAR AS id FROM chunks),
{_batches_sql('e', 'b')}
SELECT id, pos::BIGINT AS pos, batch::BIGINT AS batch, namespace, last_namespace FROM b
""")
def assign_namespaces(t):
    """K3/Q12/Q13: namespace_{j div 1000} of the flush index; and the loader's
    'last namespace' (n div 1000)."""
    ch = ingest.ingest_chunks(t.documents, 200)
    ids = ch.select(F.concat_ws("_chunk_", F.col("doc_id").cast("string"),
                                F.col("chunk_id").cast("string")).alias("id"))
    b = store.assign_batches(ids, ["id"])
    return b.select("id", "pos", "batch", "namespace", "last_namespace")


@register("assign_ids", f"""
WITH {_CH},
e AS (SELECT CASE WHEN l.doc_id IS NOT NULL THEN c.doc_id::VARCHAR || '_chunk_' || c.chunk_id::VARCHAR END AS raw_id,
             c.doc_id, c.chunk_id FROM chunks c LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)),
p AS (SELECT *, row_number() OVER (ORDER BY doc_id, chunk_id) - 1 AS pos FROM e)
SELECT doc_id, chunk_id, pos::BIGINT AS pos, coalesce(raw_id, 'auto_id_' || pos::VARCHAR) AS id FROM p
""")
def assign_ids(t):
    """Chunks of documents without a label record carry no id and get
    auto_id_<position>; positions come from one distributed pass."""
    ch = ingest.ingest_chunks(t.documents, 200)
    lab = t.labels.select("doc_id").distinct().withColumn("_has", F.lit(True))
    e = ch.join(lab, "doc_id", "left").select(
        "doc_id", "chunk_id",
        F.when(F.col("_has"), F.concat_ws("_chunk_", F.col("doc_id").cast("string"),
                                          F.col("chunk_id").cast("string"))).alias("id"))
    p = store.with_positions(e, ["doc_id", "chunk_id"])
    p = store.assign_ids(p, "id")
    return p.select("doc_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), "pos", "id")


# --- upsert scenario ------------------------------------------------------------
# existing store: the embeddings (seq 1); incoming run: every document chunk
# vector plus every embedding re-sent cut to 48 values (seq 2). A re-sent id
# keeps its namespace, new ids are numbered among themselves, and all vectors
# are fitted to the store's dimension.

STORE_DIM = 64
_STORE_COLS = ["namespace", "id", "values", "seq"]


def _existing(t):
    return store.assign_batches(_emb_items(t), ["id"]).withColumn("seq", F.lit(1))


def _incoming(t, existing):
    ch = chunk_vectors(t).select("id", "values")
    emb = _emb_items(t).withColumn("values", vx.fit_dimension("values", 48))
    # the ids are read to place the run, the placed run several times to merge it: both
    # are written, so that texts are cut and embedded once
    run = written(ch.unionByName(emb), "incoming")
    placed = store.place_incoming(existing, run).withColumn("seq", F.lit(2))
    return written(store.fit_store_dimension(placed, STORE_DIM), "placed")


def _existing_and_incoming(t):
    """Both sides read the stored ids, so the existing store is materialised once."""
    existing = _existing(t).select(*_STORE_COLS).checkpoint(eager=True)
    return existing, _incoming(t, existing)


def _merged(t):
    existing, incoming = _existing_and_incoming(t)
    return store.upsert(existing, incoming.select(*_STORE_COLS))


_UPSERT_CTES = f"""
{_CH}, {_HV},
csig AS (SELECT doc_id, chunk_id, sum(abs(v)) AS l1 FROM h_vec GROUP BY ALL),
ex0 AS (SELECT 'vec_' || vec_id::VARCHAR AS id, len(embedding)::BIGINT AS dim,
               list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS l1 FROM embeddings),
{_batches_sql('ex0', 'ex')},
new0 AS (SELECT c.doc_id::VARCHAR || '_chunk_' || c.chunk_id::VARCHAR AS id, 64::BIGINT AS dim,
                coalesce(s.l1, 0.0) AS l1 FROM chunks c LEFT JOIN csig s USING (doc_id, chunk_id)),
{_batches_sql('new0', 'new1')},
inc AS (SELECT namespace, id, dim, l1, last_namespace FROM new1
        UNION ALL
        SELECT ex.namespace, ex.id, 64::BIGINT,
               list_sum(list_transform(e.embedding[1:48], lambda x: abs(x::DOUBLE))), NULL
        FROM embeddings e JOIN ex ON ex.id = 'vec_' || e.vec_id::VARCHAR),
allv AS (SELECT namespace, id, dim, l1, 1 AS seq FROM ex UNION ALL SELECT namespace, id, dim, l1, 2 AS seq FROM inc),
merged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY namespace, id ORDER BY seq DESC) AS rn FROM allv) WHERE rn = 1)
"""


@register("upsert_merge", f"""
WITH {_UPSERT_CTES}
SELECT namespace, id, seq::BIGINT AS seq, dim, round(l1, 6) AS l1 FROM merged
""")
def upsert_merge(t):
    """Last write wins per (namespace, id)."""
    m = _merged(t)
    return m.select("namespace", "id", F.col("seq").cast("bigint").alias("seq"),
                    F.size("values").cast("bigint").alias("dim"),
                    F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 6).alias("l1"))


@register("upsert_table", f"""
WITH {_UPSERT_CTES}
SELECT namespace, id, seq::BIGINT AS seq, dim, round(l1, 6) AS l1 FROM merged
""")
def upsert_table(t):
    """S10 write path: the existing vectors written as a namespace-partitioned
    table, then the incoming run upserted in place (only touched namespaces
    rewritten), read back."""
    path = scratch_path(t.spark, "vector-store")
    store.write_store(_existing(t).select(*_STORE_COLS), path)
    incoming = _incoming(t, t.spark.read.parquet(path))
    out = store.upsert_table(t.spark, path, incoming.select(*_STORE_COLS))
    return out.select("namespace", "id", F.col("seq").cast("bigint").alias("seq"),
                      F.size("values").cast("bigint").alias("dim"),
                      F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 6).alias("l1"))


@register("namespace_counts", f"""
WITH {_UPSERT_CTES}
SELECT namespace, count(*)::BIGINT AS vector_count FROM merged GROUP BY namespace
""")
def namespace_counts(t):
    """Vectors per namespace of the merged store."""
    return store.namespace_counts(_merged(t))


@register("index_stats", f"""
WITH {_UPSERT_CTES}
SELECT max(dim)::BIGINT AS dimension, count(*)::BIGINT AS total_vector_count,
       count(*) / 100000.0 AS index_fullness, printf('%.2f%%', count(*) / 100000.0 * 100) AS fullness_text
FROM merged
""")
def index_stats(t):
    """Dimension, count, fullness (capacity 100,000), printed as a percentage."""
    return store.index_stats(_merged(t), capacity=100_000)


@register("fetch_by_ids", f"""
WITH {_UPSERT_CTES}
SELECT m.namespace, m.id, m.seq::BIGINT AS seq FROM merged m
WHERE m.id IN (SELECT c.doc_id::VARCHAR || '_chunk_' || c.chunk_id::VARCHAR FROM chunks c
               JOIN labels l USING (doc_id))
""")
def fetch_by_ids(t):
    """Fetch the vectors of labelled documents' chunks by id (semi join)."""
    ch = ingest.ingest_chunks(t.documents, 200).join(t.labels.select("doc_id"), "doc_id", "left_semi")
    ids = ch.select(F.concat_ws("_chunk_", F.col("doc_id").cast("string"),
                                F.col("chunk_id").cast("string")).alias("id"))
    return store.fetch(_merged(t), ids).select("namespace", "id", F.col("seq").cast("bigint").alias("seq"))


@register("topk_namespace", f"""
WITH {S.doc_tokens_cte()}, {S.token_chunks_cte(200)},
e AS (SELECT doc_id::VARCHAR || '_chunk_' || chunk_id::VARCHAR AS id, chunk_text, doc_id, chunk_id FROM chunks),
{_batches_sql('e', 'b')},
{S.hashed_vectors_ctes("b WHERE namespace = 'namespace_1'", 'id', 'chunk_text', prefix='h')},
qt AS (SELECT item_id, array_to_string({S.drop_stop(S.tokens(S.clean('text')))}, ' ') AS qt FROM benchmark),
{S.hashed_vectors_ctes('qt', 'item_id', 'qt', prefix='g')},
cn AS (SELECT id, sqrt(sum(v * v)) AS n FROM h_vec GROUP BY id),
qn AS (SELECT item_id, sqrt(sum(v * v)) AS n FROM g_vec GROUP BY item_id),
dp AS (SELECT g.item_id, h.id, sum(h.v * g.v) AS d FROM h_vec h JOIN g_vec g USING (b) GROUP BY ALL),
sc AS (SELECT dp.item_id, dp.id, d / (cn.n * qn.n) AS score FROM dp JOIN cn USING (id) JOIN qn USING (item_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, id) AS rank FROM sc)
SELECT item_id, rank::BIGINT AS rank, id, round(score, 4) AS score FROM rk WHERE rank <= 5
""")
def topk_namespace(t):
    """Search restricted to one namespace of a written store: the
    filter is on the partition column, so only that folder is read."""
    from docweave.operators import search
    from docweave.plans.q_vectors import query_vectors
    path = scratch_path(t.spark, "chunk-store")
    store.write_store(store.place_incoming(None, chunk_vectors(t).select("id", "values")), path)
    res = search.search_store(t.spark.read.parquet(path), query_vectors(t).select("item_id", "values"), k=5,
                              namespace="namespace_1", qid_col="item_id")
    return res.select("item_id", F.col("rank").cast("bigint").alias("rank"), "id",
                      F.round("score", 4).alias("score"))


# --- verification -----------------------------------------------------------------
# The incoming run is verified against a store whose namespace_1 write was lost.

_VERIFY_CTES = _UPSERT_CTES + """,
damaged AS (SELECT * FROM merged WHERE namespace <> 'namespace_1')
"""


def _damaged_and_incoming(t):
    existing, incoming = _existing_and_incoming(t)
    merged = store.upsert(existing, incoming.select(*_STORE_COLS))
    return merged.filter(F.col("namespace") != "namespace_1"), incoming


@register("upsert_reconcile", f"""
WITH {_VERIFY_CTES}
SELECT (SELECT count(*) FROM inc)::BIGINT AS expected,
       (SELECT count(*) FROM damaged WHERE seq = 2)::BIGINT AS upserted,
       ((SELECT count(*) FROM inc) - (SELECT count(*) FROM damaged WHERE seq = 2))::BIGINT AS failed
""")
def upsert_reconcile(t):
    """Expected vs actually stored from the incoming run."""
    damaged, incoming = _damaged_and_incoming(t)
    inc = incoming.select(F.lit(1).alias("_exp"), F.lit(0).alias("_got"))
    got = damaged.filter(F.col("seq") == 2).select(F.lit(0).alias("_exp"), F.lit(1).alias("_got"))
    tot = inc.unionByName(got).agg(F.sum("_exp").cast("bigint").alias("expected"),
                                   F.sum("_got").cast("bigint").alias("upserted"))
    return tot.select("expected", "upserted", (F.col("expected") - F.col("upserted")).alias("failed"))


@register("verify_missing", f"""
WITH {_VERIFY_CTES}
SELECT i.namespace, i.id FROM inc i
WHERE NOT EXISTS (SELECT 1 FROM damaged d WHERE d.namespace = i.namespace AND d.id = i.id)
""")
def verify_missing(t):
    """Incoming ids not present in their own namespace (anti join)."""
    missing, _ = store.verify(*_damaged_and_incoming(t))
    return missing.select("namespace", "id")


@register("verify_summary", f"""
WITH {_VERIFY_CTES},
f AS (SELECT i.*, d.id IS NOT NULL AS hit FROM inc i LEFT JOIN damaged d USING (namespace, id))
SELECT count_if(hit)::BIGINT AS verified, count_if(NOT hit)::BIGINT AS failed, count(*)::BIGINT AS total,
       count_if(hit AND namespace = last_namespace)::BIGINT AS verified_in_last_namespace
FROM f
""")
def verify_summary(t):
    """Verified / failed / total, plus the last-namespace-only count."""
    _, summary = store.verify(*_damaged_and_incoming(t))
    return summary


def _versioned(t):
    """Path of a store with the existing vectors as version 1, the upsert as 2."""
    from docweave.operators import versions
    path = scratch_path(t.spark, "versioned-store")
    versions.commit(t.spark, path, _existing(t).select(*_STORE_COLS), 0)
    incoming = _incoming(t, versions.read(t.spark, path, 1))
    versions.upsert(t.spark, path, incoming.select(*_STORE_COLS))
    return path


@register("upsert_versioned", f"""
WITH {_UPSERT_CTES}
SELECT namespace, id, seq::BIGINT AS seq, dim, round(l1, 6) AS l1 FROM merged
""")
def upsert_versioned(t):
    """The upsert as a new version of immutable files, compacted, read back."""
    from docweave.operators import versions
    path = _versioned(t)
    versions.compact(t.spark, path)
    return versions.read(t.spark, path).select(
        "namespace", "id", F.col("seq").cast("bigint").alias("seq"), F.size("values").cast("bigint").alias("dim"),
        F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 6).alias("l1"))


@register("store_version_counts", f"""
WITH {_UPSERT_CTES}
SELECT 1::BIGINT AS version, count(*)::BIGINT AS n_vectors, count(DISTINCT namespace)::BIGINT AS n_namespaces FROM ex
UNION ALL SELECT 2, count(*), count(DISTINCT namespace) FROM merged
""")
def store_version_counts(t):
    """An earlier version stays readable after an upsert."""
    from docweave.operators import versions
    path = _versioned(t)
    count = lambda v: versions.read(t.spark, path, v).agg(
        F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("n_vectors"), F.count_distinct("namespace").alias("n_namespaces"))
    return count(1).unionByName(count(2))
