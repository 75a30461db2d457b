"""Exact top-k similarity search over a vector table.

Plan shape (many queries, ``top_k``):

    vectors scan (id, values only) --mapInPandas: per-partition block matmul
    against the broadcast query matrix, keep a k-candidate superset per
    query--> shuffle of <= k*Q rows per partition on qid --> window rank.

The query side is broadcast only after its row count and vector length, and
so its bytes, were counted; larger query sets stay on the executors
(``operators.tiled``). No vector is broadcast, no query x vector pair is
materialised as a row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.session import ensure_checkpoint_dir, ship_package

MAX_BROADCAST_QUERIES = 4096
MAX_BROADCAST_BYTES = 64 << 20
MAX_BROADCAST_HITS = 1_000_000  # hit ids (k x queries) shipped to a semi join
# Scores are ranked by an integer key, round-half-up of score * 1e6, that is
# computed once next to the score and used both for the per-partition
# selection and for the final window, so both steps agree exactly; ties on
# the key are broken by id.
KEY_SCALE = 1e6
_MAX_CELLS = 1_000_000  # score-matrix cells per block product (~8 MB)
_MOST_KEPT = 400_000  # candidates of a task before they are cut to the best
MAX_ENCODERS = 64
_RANK_SALTS = 32  # tasks that share the candidates of one query before its last rank


def rank_key(scores: np.ndarray) -> np.ndarray:
    key = scores * KEY_SCALE
    key += 0.5
    return np.floor(key, out=key).astype(np.int64)   # one copy of the block, not three


def _score_matrix(vecs: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    if metric == "dot":
        return vecs @ q.T
    if metric == "cosine":
        vn = np.linalg.norm(vecs, axis=1)
        vn = np.where(vn > 0, vn, 1.0)
        return (vecs @ q.T) / vn[:, None]  # q already normalised
    if metric == "euclidean":
        d2 = (vecs * vecs).sum(1)[:, None] - 2.0 * (vecs @ q.T) + (q * q).sum(1)[None, :]
        return -np.sqrt(np.maximum(d2, 0.0))
    raise ValueError(metric)


def _exact_topk(cand: pd.DataFrame, k: int, id_cols: list[str]) -> pd.DataFrame:
    """k best per query column by (key desc, ids asc) - exact, ties included
    only as far as the id order admits them."""
    cand = cand.assign(_nk=-cand["_key"])
    return cand.sort_values(["_c", "_nk", *id_cols], kind="stable").groupby("_c", sort=False).head(k) \
               .drop(columns="_nk")


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    """Stacked vectors; one of another length is refused, never cut or padded."""
    lens = vectors.map(len).to_numpy()
    if (lens != dim).any():
        raise ValueError(f"a vector has {lens[lens != dim][0]} values, the queries have {dim}: fit them first")
    return np.concatenate(vectors.to_numpy()).astype(np.float64).reshape(len(vectors), dim)


def _partial_topk_fn(bq, k, metric, id_cols, vec_col, dim):
    def run(batches):
        qids, qmat = bq.value  # broadcast variable, fetched once per task
        nq = len(qids)
        step = max(1, _MAX_CELLS // max(1, nq))
        kept, pending = [], 0
        for pdf in batches:
            if pdf.empty:
                continue
            vecs_all = _matrix(pdf[vec_col], dim)
            for lo in range(0, len(pdf), step):
                vecs, ids = vecs_all[lo:lo + step], pdf[id_cols].iloc[lo:lo + step]
                sc = _score_matrix(vecs, qmat, metric)
                key = rank_key(sc)
                m = len(ids)
                if m > k:  # per query: everything at or above its k-th key
                    kth = np.partition(key, m - k, axis=0)[m - k]
                    r, c = np.nonzero(key >= kth[None, :])
                else:
                    r, c = np.nonzero(np.ones_like(key, dtype=bool))
                kept.append(ids.iloc[r].reset_index(drop=True).assign(_c=c, _key=key[r, c], score=sc[r, c]))
                pending += len(r)
                if pending > max(_MOST_KEPT, 4 * k * nq):
                    kept = [_exact_topk(pd.concat(kept, ignore_index=True), k, id_cols)]
                    pending = len(kept[0])
        if not kept:
            return
        best = _exact_topk(pd.concat(kept, ignore_index=True), k, id_cols)
        best.insert(0, "qid", np.asarray(qids, dtype=object)[best["_c"].to_numpy()])
        yield best[["qid", *id_cols, "score", "_key"]]
    return run


def _query_matrix(vectors: pd.Series, dim: int, metric: str) -> np.ndarray:
    q = _matrix(vectors, dim)
    if metric == "cosine":
        n = np.linalg.norm(q, axis=1)
        q = q / np.where(n > 0, n, 1.0)[:, None]
    return q


def _comparable(vec_col: str) -> F.Column:
    """Not null, and no component null, NaN or infinite."""
    fine = F.forall(F.col(vec_col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine",
          id_col: str | list[str] = "id", vec_col: str = "values", qid_col: str = "qid",
          qvec_col: str = "values", max_broadcast_queries: int = MAX_BROADCAST_QUERIES) -> DataFrame:
    """For every query row, the ``k`` nearest vectors (see ``top_k_counted``)."""
    return top_k_counted(vectors, queries, k, metric, id_col, vec_col, qid_col, qvec_col,
                         max_broadcast_queries)[0]


def top_k_counted(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine",
                  id_col: str | list[str] = "id", vec_col: str = "values", qid_col: str = "qid",
                  qvec_col: str = "values",
                  max_broadcast_queries: int = MAX_BROADCAST_QUERIES) -> tuple[DataFrame, int]:
    """(matches, number of query rows): for every query row, the ``k``
    nearest vectors. The query count bounds the matches (k per query).

    Returns ``qid, rank, <id columns>, score`` with rank 1..k ordered by score
    (descending; ascending distance for euclidean) rounded half-up to 6
    places, then the id columns in the order given. Scores are doubles at full
    precision. Vectors and query vectors that are null or hold null or non-finite
    components match nothing. All vectors
    and queries must have one length: another one is an error (fit them with
    ``functions.vectors.fit_dimension`` first), so the answer does not depend
    on how the queries fall into blocks. Each partition ships min(k, rows)
    candidates per query, however many vectors tie (duplicates); they are
    ranked within salted groups before the ranks per query.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    id_cols = [id_col] if isinstance(id_col, str) else list(id_col)
    spark = vectors.sparkSession
    ship_package(spark)
    qsel = (queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv"))
            .filter(_comparable("qv")))
    qid_type = queries.schema[qid_col].dataType
    schema = T.StructType([T.StructField("qid", qid_type), *(vectors.schema[c] for c in id_cols),
                           T.StructField("score", T.DoubleType()), T.StructField("_key", T.LongType())])
    vsel = vectors.select(*id_cols, vec_col).filter(_comparable(vec_col))
    # the query set is read once: its length, count and byte size are known
    # before anything is broadcast
    ensure_checkpoint_dir(spark)
    qstable = qsel.checkpoint(eager=True)
    stats = qstable.agg(F.count("*").alias("n"), F.min(F.size("qv")).alias("lo"), F.max(F.size("qv")).alias("hi")).first()
    nq, d = stats.n, stats.hi
    if not nq:
        return _empty_result(spark, vectors, queries, id_cols, qid_col), 0
    if stats.lo != d:
        raise ValueError(f"query vectors of {stats.lo} and of {d} values: fit them first")
    block = max(1, min(max_broadcast_queries, MAX_BROADCAST_BYTES // (8 * d + 64)))
    if nq > block:   # too many queries for one broadcast: both sides in tiles
        from docweave.operators import tiled
        index = tiled.build(vsel, metric, id_cols, vec_col)
        if index is None:
            return _empty_result(spark, vectors, queries, id_cols, qid_col), nq
        return tiled.top_k(index, qstable, k, qvec_col="qv")[0].withColumnRenamed("qid", qid_col), nq
    qpdf = qstable.toPandas()
    bq = spark.sparkContext.broadcast((list(qpdf["qid"]), _query_matrix(qpdf["qv"], d, metric)))
    cand = vsel.mapInPandas(_partial_topk_fn(bq, k, metric, id_cols, vec_col, d), schema)
    best_first = [F.col("_key").desc(), *(F.col(c).asc() for c in id_cols)]
    salted = Window.partitionBy("qid", "_salt").orderBy(*best_first)
    w = Window.partitionBy("qid").orderBy(*best_first)
    ranked = (cand.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(_RANK_SALTS)))
              .withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k)
              .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
    if metric == "euclidean":
        ranked = ranked.withColumn("score", -F.col("score"))
    return ranked.select(F.col("qid").alias(qid_col), "rank", *id_cols, "score"), nq


def rows_for_hits(table: DataFrame, hits: DataFrame, n_hits_bound: int,
                  id_col: str | list[str] = "id") -> DataFrame:
    """The rows of a (large) table whose id is among the hits. The hit ids
    are at most ``n_hits_bound`` (k x queries): under MAX_BROADCAST_HITS they
    are broadcast into a semi join, so the table is filtered where it lies
    and never shuffled; above it, a shuffle semi join."""
    id_cols = [id_col] if isinstance(id_col, str) else list(id_col)
    ids = hits.select(*id_cols).distinct()
    if n_hits_bound <= MAX_BROADCAST_HITS:
        ids = F.broadcast(ids)
    return table.join(ids, id_cols, "left_semi")


def _empty_result(spark, vectors, queries, id_cols, qid_col):
    schema = T.StructType([T.StructField(qid_col, queries.schema[qid_col].dataType),
                           T.StructField("rank", T.IntegerType()),
                           *(vectors.schema[c] for c in id_cols),
                           T.StructField("score", T.DoubleType())])
    return spark.createDataFrame([], schema)


def top_k_single(vectors: DataFrame, query_vec: DataFrame, k: int = 5, metric: str = "cosine",
                 id_col: str = "id", vec_col: str = "values", qvec_col: str = "values") -> DataFrame:
    """One query vector (a one-row DataFrame): the multi-query plan with a
    single-row query matrix; the final step ranks at most k*partitions rows."""
    q = query_vec.select(F.lit(0).alias("_qid"), F.col(qvec_col).alias("_qv")).limit(1)
    res = top_k(vectors, q, k=k, metric=metric, id_col=id_col, vec_col=vec_col,
                qid_col="_qid", qvec_col="_qv")
    return res.select("rank", id_col, "score")


def top_k_by_encoder(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine",
                     id_col: str | list[str] = "id", vec_col: str = "values", qid_col: str = "qid",
                     qvec_col: str = "values", encoder_col: str = "encoder") -> DataFrame:
    """``top_k`` in a store of several encoders: every row names the encoder its vector
    comes from, and a query meets the vectors of its own encoder only, whatever their
    length. A query of no or of an unknown encoder is refused, as its scores would mean
    nothing; vectors without an encoder are met by nobody. Query ids are unique over
    all encoders. The names come to the driver, at most ``MAX_ENCODERS`` of them; each
    encoder's search is a filter on the store (a folder where it is partitioned by it)."""
    names = [r[0] for r in queries.select(encoder_col).distinct().limit(MAX_ENCODERS + 1).collect()]
    if len(names) > MAX_ENCODERS:
        raise ValueError(f"queries of more than {MAX_ENCODERS} encoders")
    there = {r[0] for r in vectors.where(F.col(encoder_col).isin([n for n in names if n is not None]))
             .select(encoder_col).distinct().collect()}
    if set(names) - there:
        raise ValueError(f"no vector comes from the queries' encoder: {sorted(map(str, set(names) - there))}")
    out = None
    for name in sorted(names):
        mine = F.col(encoder_col) == F.lit(name)
        hits = top_k(vectors.where(mine), queries.where(mine), k, metric, id_col, vec_col, qid_col, qvec_col)
        hits = hits.withColumn(encoder_col, F.lit(name))
        out = hits if out is None else out.unionByName(hits)
    if out is None:   # no query
        ids = [id_col] if isinstance(id_col, str) else list(id_col)
        out = _empty_result(queries.sparkSession, vectors, queries, ids, qid_col).withColumn(encoder_col, F.lit(""))
    return out


def format_matches(matches: DataFrame, score_col: str = "score") -> DataFrame:
    """Score as text with 4 decimals, as a match listing prints it."""
    return matches.withColumn("score_text", F.format_string("%.4f", F.col(score_col).cast("double")))


def search_store(store: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine",
                 namespace: str | None = None, include_metadata: bool = False,
                 qid_col: str = "qid", qvec_col: str = "values") -> DataFrame:
    """Query a vector store table (namespace, id, values[, metadata]).

    A vector is known by (namespace, id); matches carry both, ties go to the
    smaller id, then namespace. The namespace filter prunes partitions before
    the scan; ranking reads only (namespace, id, values) and the metadata of
    the k survivors per query is joined on both columns only when asked for."""
    s = store if namespace is None else store.filter(F.col("namespace") == namespace)
    key = ["id", "namespace"]
    res, nq = top_k_counted(s.select(*key, "values"), queries, k=k, metric=metric, id_col=key,
                            vec_col="values", qid_col=qid_col, qvec_col=qvec_col)
    if include_metadata:
        # the hits (<= k x queries rows) feed two joins: materialise them once
        # so the vector scan and scoring run once
        ensure_checkpoint_dir(s.sparkSession)
        res = res.checkpoint(eager=True)
        res = res.join(rows_for_hits(s.select(*key, "metadata"), res, k * nq, key), key, "left")
    return res
