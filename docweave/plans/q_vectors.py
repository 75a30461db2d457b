"""Registered vector queries: encoder, centroids, similarity, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions import vectors as vx
from docweave.operators import ingest, lemmas, search, store, tiled
from docweave.operators.vectorops import mean_vectors, signature
from docweave.plans import sqlgen as S
from docweave.plans.registry import register

_CHUNK_CTES = f"{S.doc_tokens_cte()}, {S.token_chunks_cte(200)}"


def chunk_vectors(t, size: int = 200):
    """documents -> (id, doc_id, chunk_id, chunk_text, values) with the hashed encoder."""
    ch = ingest.ingest_chunks(t.documents, size=size)
    ch = ch.withColumn("id", F.concat_ws("_chunk_", F.col("doc_id").cast("string"),
                                         F.col("chunk_id").cast("string")))
    return ingest.embed_texts(ch)


def query_vectors(t):
    """benchmark texts through the same cleaning/stop words, then encoded."""
    toks = tx.remove_stopwords(tx.tokenize(tx.clean_text("text")))
    q = t.benchmark.select("item_id", F.array_join(toks, " ").alias("qt"))
    return ingest.embed_texts(q, text_col="qt")


@register("embed_hash", f"""
WITH {_CHUNK_CTES}, {S.hashed_vectors_ctes('chunks', 'doc_id, chunk_id', 'chunk_text')},
sig AS (SELECT doc_id, chunk_id, count_if(v <> 0)::BIGINT AS nnz, round(sum(abs(v)), 6) AS l1,
               round(sum((b + 1) * v), 6) AS wsum FROM h_vec GROUP BY ALL)
SELECT c.doc_id, c.chunk_id, coalesce(s.nnz, 0)::BIGINT AS nnz, coalesce(s.l1, 0.0) AS l1,
       coalesce(s.wsum, 0.0) AS wsum
FROM chunks c LEFT JOIN sig s USING (doc_id, chunk_id)
""")
def embed_hash(t):
    """built-in hashed encoder per 200-token chunk (signature columns)."""
    v = chunk_vectors(t)
    return v.select("doc_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), *signature("values"))


@register("embed_window", f"""
WITH {S.doc_tokens_cte()}, d AS (SELECT doc_id, len(toks) AS n, array_to_string(toks, ' ') AS txt FROM dtok),
{S.hashed_vectors_ctes('d', 'doc_id', 'txt', max_tokens=512)},
sig AS (SELECT doc_id, count_if(v <> 0)::BIGINT AS nnz, round(sum(abs(v)), 6) AS l1,
               round(sum((b + 1) * v), 6) AS wsum FROM h_vec GROUP BY ALL)
SELECT d.doc_id, n::BIGINT AS n_tokens, n > 512 AS cut, coalesce(s.nnz, 0)::BIGINT AS nnz, coalesce(s.l1, 0.0) AS l1,
       coalesce(s.wsum, 0.0) AS wsum
FROM d LEFT JOIN sig s USING (doc_id)
""")
def embed_window(t):
    """F8: whole documents through an encoder whose input window is 512 tokens
    (the window is the feature; every other query encodes whole texts)."""
    d = ingest.with_tokens(t.documents.select("doc_id", "text"))
    return d.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    (F.size("tokens") > 512).alias("cut"),
                    vx.embed_tokens("tokens", max_tokens=512).alias("values")) \
            .select("doc_id", "n_tokens", "cut", *signature("values"))


_SEARCH_SQL = f"""
WITH {_CHUNK_CTES},
cv AS (SELECT doc_id, doc_id::VARCHAR || '_chunk_' || chunk_id::VARCHAR AS id, chunk_text FROM chunks),
{S.hashed_vectors_ctes('cv', 'id', 'chunk_text', prefix='h')},
qt AS (SELECT item_id, array_to_string({S.drop_stop(S.tokens(S.clean('text')))}, ' ') AS qt FROM benchmark),
{S.hashed_vectors_ctes('qt', 'item_id', 'qt', prefix='g')},
cn AS (SELECT id, sqrt(sum(v * v)) AS n FROM h_vec GROUP BY id),
qn AS (SELECT item_id, sqrt(sum(v * v)) AS n FROM g_vec GROUP BY item_id),
dp AS (SELECT g.item_id, h.id, sum(h.v * g.v) AS d FROM h_vec h JOIN g_vec g USING (b) GROUP BY ALL),
sc AS (SELECT dp.item_id, dp.id, d / (cn.n * qn.n) AS score FROM dp JOIN cn USING (id) JOIN qn USING (item_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, id) AS rank FROM sc)
"""


@register("semantic_search", _SEARCH_SQL + """
SELECT item_id, rank::BIGINT AS rank, id, round(score, 4) AS score FROM rk WHERE rank <= 5
""")
def semantic_search(t):
    """Flagship: every benchmark text against every document chunk, top 5 by cosine."""
    vec = chunk_vectors(t).select("id", "values")
    qv = query_vectors(t).select("item_id", "values")
    res = search.top_k(vec, qv, k=5, metric="cosine", id_col="id", vec_col="values",
                       qid_col="item_id", qvec_col="values")
    return res.select("item_id", F.col("rank").cast("bigint").alias("rank"), "id",
                      F.round("score", 4).alias("score"))


def _lemma_search_sql() -> str:
    from docweave.plans.q_text import _lemma_ctes
    exploded = "SELECT {k}, unnest(toks) AS word, unnest(generate_series(1, len(toks))) AS p FROM {s}"
    return f"""
WITH {_lemma_ctes()},
ex AS ({exploded.format(k='doc_id', s='dtok')}),
ltok AS (SELECT doc_id, list(coalesce(lemd.lemma, ex.word) ORDER BY p) AS toks FROM ex LEFT JOIN lemd USING (word) GROUP BY doc_id),
{S.token_chunks_cte(200, src="ltok")},
cv AS (SELECT doc_id::VARCHAR || '_chunk_' || chunk_id::VARCHAR AS id, chunk_text FROM chunks),
{S.hashed_vectors_ctes('cv', 'id', 'chunk_text', prefix='h')},
qtok AS (SELECT item_id, {S.drop_stop(S.tokens(S.clean('text')))} AS toks FROM benchmark),
qx AS ({exploded.format(k='item_id', s='qtok')}),
qt AS (SELECT item_id, string_agg(coalesce(lemd.lemma, qx.word), ' ' ORDER BY p) AS qt FROM qx LEFT JOIN lemd USING (word) GROUP BY item_id),
{S.hashed_vectors_ctes('qt', 'item_id', 'qt', prefix='g')},
cn AS (SELECT id, sqrt(sum(v * v)) AS n FROM h_vec GROUP BY id),
qn AS (SELECT item_id, sqrt(sum(v * v)) AS n FROM g_vec GROUP BY item_id),
dp AS (SELECT g.item_id, h.id, sum(h.v * g.v) AS d FROM h_vec h JOIN g_vec g USING (b) GROUP BY ALL),
sc AS (SELECT dp.item_id, dp.id, d / (cn.n * qn.n) AS score FROM dp JOIN cn USING (id) JOIN qn USING (item_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, id) AS rank FROM sc)
SELECT item_id, rank::BIGINT AS rank, id, round(score, 4) AS score FROM rk WHERE rank <= 5
"""


@register("semantic_search_lemmas", _lemma_search_sql())
def semantic_search_lemmas(t):
    """Flagship: clean, tokens, stop words, noun lemmas, 200-token chunks, vectors; the
    benchmark texts go the same way with the documents' lemma table; top 5 by cosine."""
    docs, table = lemmas.lemmatized_with_table(t.documents)
    chunks = ingest.chunk_tokens(docs, 200)
    vec = ingest.embed_texts(chunks.select(F.concat_ws("_chunk_", "doc_id", "chunk_id").alias("id"), "chunk_text"))
    asked = ingest.with_tokens(t.benchmark.select("item_id", "text")).select("item_id", "tokens")
    asked = lemmas.apply_lemmas(asked, table, id_col="item_id")
    qv = ingest.embed_texts(asked.select("item_id", F.array_join("tokens", " ").alias("qt")), text_col="qt")
    res = search.top_k(vec.select("id", "values"), qv.select("item_id", "values"), k=5, id_col="id", qid_col="item_id")
    return res.select("item_id", F.col("rank").cast("bigint").alias("rank"), "id", F.round("score", 4).alias("score"))


@register("topk_by_encoder", _SEARCH_SQL + """,
e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings),
en AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY vec_id),
ed AS (SELECT a.vec_id AS q, b.vec_id AS v, sum(a.x * b.x) AS d FROM e a JOIN e b USING (pos) WHERE a.vec_id % 20 = 0 GROUP BY ALL),
es AS (SELECT q, 'vec:' || v AS id, d / (x.n * y.n) AS score FROM ed JOIN en x ON x.vec_id = q JOIN en y ON y.vec_id = v),
er AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 6) DESC, id) AS rank FROM es)
SELECT 'hashed-md5-64' AS encoder, 'item:' || item_id AS qid, rank::BIGINT AS rank, id, round(score, 4) AS score FROM rk WHERE rank <= 5
UNION ALL SELECT 'given-64', 'vec:' || q, rank, id, round(score, 4) FROM er WHERE rank <= 5
""")
def topk_by_encoder(t):
    """K5 in one store of two encoders, of one length: hashed document chunks and the given
    embeddings. Texts are searched among chunks, every 20th given vector among the given."""
    given = t.embeddings.select(F.concat(F.lit("vec:"), "vec_id").alias("id"), F.col("embedding").alias("values"),
                                F.lit("given-64").alias("encoder"))
    made = chunk_vectors(t).select("id", "values", F.lit(vx.encoder_name()).alias("encoder"))
    texts = query_vectors(t).select(F.concat(F.lit("item:"), "item_id").alias("qid"), "values", F.lit(vx.encoder_name()).alias("encoder"))
    asked = t.embeddings.where(F.col("vec_id") % 20 == 0).select(F.concat(F.lit("vec:"), "vec_id").alias("qid"),
                                                                 F.col("embedding").alias("values"), F.lit("given-64").alias("encoder"))
    res = search.top_k_by_encoder(made.unionByName(given), texts.unionByName(asked), k=5)
    return res.select("encoder", "qid", F.col("rank").cast("bigint").alias("rank"), "id", F.round("score", 4).alias("score"))


@register("retrieve_with_sources", _SEARCH_SQL + """,
hit AS (SELECT rk.item_id, rk.rank, cv.chunk_text, d.source FROM rk
        JOIN cv USING (id) JOIN documents d ON d.doc_id = cv.doc_id WHERE rk.rank <= 5)
SELECT item_id, string_agg(chunk_text, ' || ' ORDER BY rank) AS context,
       array_to_string(list_sort(list_distinct(list(source))), ',') AS sources,
       count(*)::BIGINT AS n_hits
FROM hit GROUP BY item_id
""")
def retrieve_with_sources(t):
    """the top-5 chunk texts joined in rank order, plus distinct sources."""
    cv = chunk_vectors(t)
    qv = query_vectors(t).select("item_id", "values")
    res, nq = search.top_k_counted(cv.select("id", "values"), qv, k=5, metric="cosine", id_col="id",
                                   vec_col="values", qid_col="item_id", qvec_col="values")
    # chunk rows of the <= 5 x queries hits only (broadcast semi join, size
    # bound checked); the hits feed two joins, so they are materialised once
    res = res.checkpoint(eager=True)
    hit_rows = search.rows_for_hits(cv.select("id", "doc_id", "chunk_text"), res, 5 * nq)
    hits = (res.join(hit_rows, "id")
            .join(t.documents.select("doc_id", "source"), "doc_id"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "chunk_text")))
    return hits.groupBy("item_id").agg(
        F.array_join(F.transform(ordered, lambda s: s["chunk_text"]), " || ").alias("context"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
        F.count("*").cast("bigint").alias("n_hits"))


_EMB_LONG = """
e AS (SELECT label, vec_id, unnest(embedding)::DOUBLE AS x,
             unnest(generate_series(0, len(embedding) - 1)) AS pos FROM embeddings),
c AS (SELECT label, pos, avg(x) AS m FROM e GROUP BY label, pos)
"""


@register("label_centroid", f"""
WITH {_EMB_LONG}
SELECT label, pos::BIGINT AS pos, round(m, 6) AS value FROM c
""")
def label_centroid(t):
    """Mean vector of each label (mean pooling), long form."""
    cent = mean_vectors(t.embeddings, ["label"], "embedding")
    return cent.select("label", F.posexplode("centroid").alias("pos", "value")).select(
        "label", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@register("topk_multi", f"""
WITH {_EMB_LONG},
cn AS (SELECT label, sqrt(sum(m * m)) AS n FROM c GROUP BY label),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY vec_id),
dp AS (SELECT c.label, e.vec_id, sum(c.m * e.x) AS d FROM e JOIN c USING (pos) GROUP BY ALL),
sc AS (SELECT dp.label, dp.vec_id, d / (cn.n * vn.n) AS score FROM dp JOIN cn USING (label) JOIN vn USING (vec_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(score, 6) DESC, vec_id) AS rank FROM sc)
SELECT label, rank::BIGINT AS rank, vec_id, round(score, 4) AS score FROM rk WHERE rank <= 5
""")
def topk_multi(t):
    """Many queries at once (one per label centroid), top 5 each."""
    emb = t.embeddings
    cent = mean_vectors(emb, ["label"], "embedding")
    res = search.top_k(emb, cent, k=5, metric="cosine", id_col="vec_id", vec_col="embedding",
                       qid_col="label", qvec_col="centroid")
    return res.select("label", F.col("rank").cast("bigint").alias("rank"), "vec_id",
                      F.round("score", 4).alias("score"))


@register("topk_tiled", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE embedding IS NOT NULL),
q AS (SELECT vec_id AS query_id, v AS qv FROM e WHERE vec_id % 20 = 0),
sc AS (SELECT query_id, vec_id, list_cosine_similarity(qv, v) AS score FROM q CROSS JOIN e),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY floor(score * 1e6 + 0.5) DESC, vec_id) AS rank FROM sc)
SELECT query_id, rank::BIGINT AS rank, vec_id, round(score, 4) AS score FROM rk WHERE rank <= 10
""")
def topk_tiled(t):
    """The ten nearest of all vectors for each whose id is divisible by 20,
    both sides tiled on the executors."""
    index = tiled.build(t.embeddings, "cosine", "vec_id", "embedding", pivots=64)
    if index is None:
        return t.spark.createDataFrame([], "query_id bigint, rank bigint, vec_id bigint, score double")
    queries = t.embeddings.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    res, _ = tiled.top_k(index, queries, 10, "query_id", "embedding")
    return res.select("query_id", F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("score", 4).alias("score"))


@register("topk_single", """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x,
                  unnest(generate_series(0, len(embedding) - 1)) AS pos FROM embeddings),
c AS (SELECT pos, avg(x) AS m FROM e GROUP BY pos),
cn AS (SELECT sqrt(sum(m * m)) AS n FROM c),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY vec_id),
dp AS (SELECT e.vec_id, sum(c.m * e.x) AS d FROM e JOIN c USING (pos) GROUP BY ALL),
sc AS (SELECT dp.vec_id, d / ((SELECT n FROM cn) * vn.n) AS score FROM dp JOIN vn USING (vec_id)),
rk AS (SELECT *, row_number() OVER (ORDER BY round(score, 6) DESC, vec_id) AS rank FROM sc)
SELECT rank::BIGINT AS rank, vec_id, round(score, 4) AS score, printf('%.4f', score) AS score_text
FROM rk WHERE rank <= 5
""")
def topk_single(t):
    """One query (the corpus centroid), top 5, score printed with 4 decimals."""
    emb = t.embeddings
    cent = mean_vectors(emb.withColumn("_all", F.lit(0)), ["_all"], "embedding")
    res = search.top_k_single(emb, cent, k=5, metric="cosine", id_col="vec_id",
                              vec_col="embedding", qvec_col="centroid")
    return search.format_matches(res).select(
        F.col("rank").cast("bigint").alias("rank"), "vec_id", F.round("score", 4).alias("score"),
        "score_text")


@register("similarity_metrics", f"""
WITH {_EMB_LONG},
p AS (SELECT e.vec_id, e.label, sum(e.x * c.m) AS dot, sqrt(sum(e.x * e.x)) AS na,
             sqrt(sum(c.m * c.m)) AS nb, sqrt(sum((e.x - c.m) * (e.x - c.m))) AS eu
      FROM e JOIN c ON e.label = c.label AND e.pos = c.pos GROUP BY ALL)
SELECT vec_id, label, round(dot, 6) AS dot, round(dot / (na * nb), 6) AS cosine,
       round(eu, 6) AS euclidean FROM p
""")
def similarity_metrics(t):
    """Dot, cosine and euclidean of each vector to its label centroid."""
    emb = t.embeddings
    cent = mean_vectors(emb, ["label"], "embedding")
    j = emb.join(cent, "label")
    return j.select("vec_id", "label",
                    F.round(vx.dot("embedding", "centroid"), 6).alias("dot"),
                    F.round(vx.cosine("embedding", "centroid"), 6).alias("cosine"),
                    F.round(vx.euclidean("embedding", "centroid"), 6).alias("euclidean"))


@register("fit_dimension", """
SELECT vec_id, len(embedding)::BIGINT AS dim_in,
       len(embedding[1:48])::BIGINT AS dim_cut,
       round(list_sum(list_transform(embedding[1:48], lambda x: x::DOUBLE)), 6) AS sum_cut,
       (len(embedding) + greatest(80 - len(embedding), 0))::BIGINT AS dim_pad,
       greatest(80 - len(embedding), 0)::BIGINT AS zeros_added,
       (len(embedding) <> 48)::BOOLEAN AS changed_cut
FROM embeddings
""")
def fit_dimension(t):
    """Cut to 48 and pad to 80, reporting what changed."""
    e = t.embeddings
    cut = vx.fit_dimension("embedding", 48)
    pad = vx.fit_dimension("embedding", 80)
    return e.select(
        "vec_id", F.size("embedding").cast("bigint").alias("dim_in"),
        F.size(cut).cast("bigint").alias("dim_cut"),
        F.round(F.aggregate(cut, F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("sum_cut"),
        F.size(pad).cast("bigint").alias("dim_pad"),
        (F.size(pad) - F.size("embedding")).cast("bigint").alias("zeros_added"),
        (F.size("embedding") != 48).alias("changed_cut"))


@register("mean_pool", f"""
WITH {_CHUNK_CTES}, {S.hashed_vectors_ctes('chunks', 'doc_id, chunk_id', 'chunk_text')},
nc AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id),
m AS (SELECT doc_id, b, sum(v) AS sv FROM h_vec GROUP BY doc_id, b),
mm AS (SELECT m.doc_id, b, sv / nc.n AS mv FROM m JOIN nc USING (doc_id))
SELECT nc.doc_id, nc.n::BIGINT AS n_chunks, coalesce(round(sum(abs(mv)), 6), 0.0) AS l1,
       coalesce(round(sum((b + 1) * mv), 6), 0.0) AS wsum
FROM nc LEFT JOIN mm USING (doc_id) GROUP BY nc.doc_id, nc.n
""")
def mean_pool(t):
    """Document vector = mean of its chunk vectors (signature columns)."""
    v = chunk_vectors(t)
    n = v.groupBy("doc_id").agg(F.count("*").cast("bigint").alias("n_chunks"))
    doc = mean_vectors(v, ["doc_id"], "values", "doc_vec")
    sig = doc.select("doc_id", *signature("doc_vec"))
    return n.join(sig, "doc_id").select("doc_id", "n_chunks", "l1", "wsum")


@register("topk_store_metadata", f"""
WITH {_EMB_LONG},
cn AS (SELECT label, sqrt(sum(m * m)) AS n FROM c GROUP BY label),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY vec_id),
dp AS (SELECT c.label, e.vec_id, sum(c.m * e.x) AS d FROM e JOIN c USING (pos) GROUP BY ALL),
sc AS (SELECT dp.label, 'vec_' || dp.vec_id::VARCHAR AS id, d / (cn.n * vn.n) AS score
       FROM dp JOIN cn USING (label) JOIN vn USING (vec_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(score, 6) DESC, id) AS rank FROM sc)
SELECT rk.label, rank::BIGINT AS rank, rk.id, round(score, 4) AS score, printf('%.4f', score) AS score_text,
       em.label AS meta_label, len(em.embedding)::BIGINT AS meta_dim
FROM rk JOIN embeddings em ON 'vec_' || em.vec_id::VARCHAR = rk.id WHERE rank <= 5
""")
def topk_store_metadata(t):
    """Search a vector store table (namespace, id, values, metadata)
    with include_metadata: ranking reads (id, values) only; the metadata of
    the k hits per query is fetched afterwards by a semi join."""
    emb = t.embeddings
    st = emb.select(F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("id"),
                    F.col("embedding").alias("values"),
                    F.struct(F.col("label").alias("label"),
                             F.size("embedding").cast("bigint").alias("dim")).alias("metadata"))
    st = store.assign_batches(st, ["id"]).select("namespace", "id", "values", "metadata")
    cent = mean_vectors(emb, ["label"], "embedding")
    res = search.search_store(st, cent, k=5, include_metadata=True, qid_col="label", qvec_col="centroid")
    return search.format_matches(res).select(
        "label", F.col("rank").cast("bigint").alias("rank"), "id", F.round("score", 4).alias("score"),
        "score_text", F.col("metadata.label").alias("meta_label"), F.col("metadata.dim").alias("meta_dim"))
