"""Exact top-k search with both sides tiled on the executors.

Vectors are dealt to the nearest of a bounded number of pivots and written, one folder
per pivot, with the number of vectors and the radius of each. A query's score in a
folder is bounded by its score against the pivot and the radius (triangle inequality;
Cauchy-Schwarz for products). Each query first meets the folders with the best bounds
that together hold k vectors; its k-th score there rules out every folder whose bound
lies below. Folders that no query needs are not read.

    queries --bounds--> (folder, part of queries) -- cogroup --> k candidates per query

Neither side reaches the driver: it sees the pivots (``MAX_PIVOTS``,
``MAX_PIVOT_BYTES``) and their counts and radii. A crowded folder is split by a hash of
the id into pieces of about ``PIECE`` vectors, a large query set into parts of about
``QUERY_PART``; one task holds one piece and one part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators import search
from docweave.session import ensure_checkpoint_dir, scratch_path, ship_package

PIECE = 8192
QUERY_PART = 4096
MAX_PIVOTS = 4096
MAX_PIVOT_BYTES = 32 << 20
_SLACK = 1e-9   # of the size of the factors: bounds stay on the safe side of rounding


@dataclass
class Index:
    """Written vectors and what the driver knows of their folders."""
    path: str
    metric: str
    id_cols: list[str]
    vec_col: str
    dim: int
    pivots: np.ndarray   # one row per folder, unit length for cosine
    counts: np.ndarray
    radii: np.ndarray


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1)
    return m / np.where(n > 0, n, 1.0)[:, None]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] - 2.0 * (x @ pivots.T) + (pivots * pivots).sum(1)[None, :]
    return np.sqrt(np.maximum(d2, 0.0))


def build(vectors: DataFrame, metric: str = "cosine", id_col: str | list[str] = "id", vec_col: str = "values",
          pivots: int | None = None) -> Index | None:
    """Write the comparable vectors by pivots (None if there are none). They must have
    one length. Pivots are the vectors with the smallest hash of the id, by default one
    for ``PIECE`` vectors; any choice gives the same answers."""
    if metric not in ("cosine", "dot", "euclidean"):
        raise ValueError(metric)
    spark = vectors.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    v = vectors.select(*ids, vec_col).where(search._comparable(vec_col)).checkpoint(eager=True)
    size = v.agg(F.count("*").alias("n"), F.min(F.size(vec_col)).alias("lo"), F.max(F.size(vec_col)).alias("hi")).first()
    if not size.n:
        return None
    if size.lo != size.hi:
        raise ValueError(f"vectors of {size.lo} and of {size.hi} values: fit them first")
    dim = size.hi
    room = max(1, min(MAX_PIVOTS, MAX_PIVOT_BYTES // (8 * max(dim, 1))))
    wanted = max(1, min(room, pivots or -(-size.n // PIECE)))
    chosen = v.select(vec_col, F.xxhash64(*ids).alias("_h")).orderBy("_h").limit(wanted).toPandas()   # at most ``room`` rows
    p = search._matrix(chosen[vec_col], dim)
    p = np.unique(_unit(p) if metric == "cosine" else p, axis=0)
    shared = spark.sparkContext.broadcast(p)

    def deal(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = search._matrix(pdf[vec_col], dim)
            x = _unit(x) if metric == "cosine" else x
            folder, far = np.empty(len(x), dtype=np.int32), np.empty(len(x))
            step = max(1, search._MAX_CELLS // len(shared.value))
            for lo in range(0, len(x), step):
                block = x[lo:lo + step]
                f = _distances(block, shared.value).argmin(axis=1)
                folder[lo:lo + step] = f
                far[lo:lo + step] = np.linalg.norm(block - shared.value[f], axis=1)   # without cancellation
            yield pdf.assign(folder=folder, far=far)

    schema = T.StructType([*(v.schema[c] for c in [*ids, vec_col]), T.StructField("folder", T.IntegerType()),
                           T.StructField("far", T.DoubleType())])
    path = scratch_path(spark, "tiles")
    # rows are written where they are: a task adds one file to each folder that it meets
    v.mapInPandas(deal, schema).write.partitionBy("folder").parquet(path)
    stats = spark.read.parquet(path).groupBy("folder").agg(F.count("*").alias("n"), F.max("far").alias("r")).toPandas()   # MAX_PIVOTS rows
    shared.unpersist()
    counts, radii = np.zeros(len(p), dtype=np.int64), np.zeros(len(p))
    counts[stats.folder], radii[stats.folder] = stats.n, stats.r
    return Index(path, metric, ids, vec_col, dim, p, counts, radii)


def _bounds(index: Index, q: np.ndarray) -> np.ndarray:
    """Upper bound of the score of each query in each folder, rounding allowed for."""
    norm = np.linalg.norm(q, axis=1)[:, None]
    if index.metric == "euclidean":
        best = -np.maximum(_distances(q, index.pivots) - index.radii[None, :], 0.0)
        size = norm + np.linalg.norm(index.pivots, axis=1)[None, :] + index.radii[None, :]
        # the distance is a root of a difference: its error is that of the squares' root
        return best + np.sqrt(_SLACK * 1e-3) * size
    size = norm * (np.linalg.norm(index.pivots, axis=1)[None, :] + index.radii[None, :])
    return q @ index.pivots.T + norm * index.radii[None, :] + _SLACK * (size + 1.0)


def _folders(index: Index, k: int, first: bool):
    """Queries to rows per folder that they meet: first those with the best bounds that
    hold k vectors; then, knowing the k-th key, the others that may hold a better one."""
    def run(batches):
        live = index.counts > 0
        step = max(1, search._MAX_CELLS // (4 * len(index.counts)))
        most = max(1, search._MAX_CELLS // max(1, index.dim))   # rows of one frame: each has a query's vector
        for whole in batches:
            for lo in range(0, len(whole), step):
                pdf = whole.iloc[lo:lo + step].reset_index(drop=True)
                if pdf.empty:
                    continue
                u = _bounds(index, search._query_matrix(pdf["qv"], index.dim, index.metric))
                u[:, ~live] = -np.inf
                order = np.argsort(-u, axis=1, kind="stable")
                held = np.cumsum(index.counts[order], axis=1)
                opening = np.zeros_like(u, dtype=bool)
                np.put_along_axis(opening, order, held - index.counts[order] < k, axis=1)
                opening &= live[None, :]
                if first:
                    meets = opening
                else:
                    kth = pdf["kth"].to_numpy()[:, None]
                    meets = ~opening & live[None, :] & (np.floor(u * search.KEY_SCALE + 0.5) >= kth)
                r, c = np.nonzero(meets)
                for at in range(0, len(r), most):
                    i = r[at:at + most]
                    yield pd.DataFrame({"qid": pdf["qid"].to_numpy()[i], "qv": pdf["qv"].to_numpy()[i], "folder": c[at:at + most].astype(np.int32)})
    return run


def _compare(index: Index, k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["qid", *index.id_cols, "score", "_key"]
        if vectors.empty or queries.empty:
            return pd.DataFrame({c: [] for c in names})
        x = search._matrix(vectors[index.vec_col], index.dim)
        q = search._query_matrix(queries["qv"], index.dim, index.metric)
        ids, out = vectors[index.id_cols], []
        step = max(1, search._MAX_CELLS // len(x))
        for lo in range(0, len(q), step):
            score = search._score_matrix(x, q[lo:lo + step], index.metric)
            key = search.rank_key(score)
            least = np.partition(key, len(x) - k, axis=0)[len(x) - k] if len(x) > k else key.min(axis=0)
            r, c = np.nonzero(key >= least[None, :])
            best = search._exact_topk(ids.iloc[r].reset_index(drop=True).assign(_c=c, _key=key[r, c], score=score[r, c]), k, index.id_cols)
            best.insert(0, "qid", queries["qid"].to_numpy()[lo:lo + step][best["_c"].to_numpy()])
            out.append(best[names])
        return pd.concat(out, ignore_index=True)
    return run


def top_k(index: Index, queries: DataFrame, k: int = 5, qid_col: str = "qid", qvec_col: str = "values") -> tuple[DataFrame, DataFrame]:
    """(matches, met): for every query row with a comparable vector its ``k`` nearest
    vectors, ``qid, rank, <id columns>, score``, ranked as ``search.top_k`` does; and
    how many queries met each folder that was read, (folder, n_queries). Query ids must
    be distinct and not null."""
    if k <= 0:
        raise ValueError("k must be positive")
    spark = queries.sparkSession
    ensure_checkpoint_dir(spark)
    q = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv")).where(search._comparable("qv")).checkpoint(eager=True)
    size = q.agg(F.count("*").alias("n"), F.min(F.size("qv")).alias("lo"), F.max(F.size("qv")).alias("hi")).first()
    if size.n and (size.lo != index.dim or size.hi != index.dim):
        raise ValueError(f"query vectors of {size.lo} to {size.hi} values, the index has {index.dim}: fit them first")
    parts = max(1, -(-size.n // QUERY_PART))
    pair = T.StructType([*q.schema.fields, T.StructField("folder", T.IntegerType())])
    rows = spark.read.parquet(index.path)
    found = T.StructType([q.schema["qid"], *(rows.schema[c] for c in index.id_cols),
                          T.StructField("score", T.DoubleType()), T.StructField("_key", T.LongType())])
    pieces = np.maximum(1, -(-index.counts // PIECE))
    split = F.element_at(F.array(*[F.lit(int(n)) for n in pieces]), F.col("folder") + 1)
    best_first = [F.col("_key").desc(), *(F.col(c).asc() for c in index.id_cols)]

    def meet(met: DataFrame) -> DataFrame:
        met = met.withColumn("part", F.pmod(F.xxhash64("qid"), F.lit(parts)))
        wanted = met.select("folder", F.col("part").alias("vpart")).distinct()
        read = [r[0] for r in wanted.select("folder").distinct().collect()]   # at most MAX_PIVOTS numbers
        v = rows.where(F.col("folder").isin(read)).drop("far").withColumn("piece", F.pmod(F.xxhash64(*index.id_cols), split))
        v = v.join(wanted, "folder")
        qs = met.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), split.cast("long") - 1)))
        return (v.groupBy("folder", "piece", "vpart").cogroup(qs.groupBy("folder", "piece", "part")).applyInPandas(_compare(index, k), found))

    def ranked(cand: DataFrame) -> DataFrame:
        salted = Window.partitionBy("qid", "_salt").orderBy(*best_first)
        return (cand.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(search._RANK_SALTS)))
                .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k).drop("_salt")
                .withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(*best_first))).where(F.col("rank") <= k))

    met = q.mapInPandas(_folders(index, k, True), pair).checkpoint(eager=True)
    opened = ranked(meet(met)).checkpoint(eager=True)
    kth = opened.groupBy("qid").agg(F.when(F.count("*") >= k, F.min("_key")).otherwise(F.lit(-(1 << 63))).cast("double").alias("kth"))
    more = q.join(kth, "qid").mapInPandas(_folders(index, k, False), pair).checkpoint(eager=True)
    out = ranked(opened.drop("rank").unionByName(meet(more)))
    if index.metric == "euclidean":
        out = out.withColumn("score", -F.col("score"))
    counted = met.unionByName(more).groupBy("folder").agg(F.count("*").alias("n_queries"))
    return out.select(F.col("qid").alias(qid_col), "rank", *index.id_cols, "score"), counted
