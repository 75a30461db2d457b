"""Vector code compression: product codebooks fitted with LAESA pivots.

A vector's components become integers (``floor(256 x)``) and are cut into 16
equal parts; each part position has a codebook of 64 entries, moved for two
rounds to the floored means of the parts assigned to them. Assigning a part is
an exact nearest-neighbour search in integers, done by LAESA:

* The distances of every part to a few fixed pivots (spread entries of the
  first codebook) are computed once, when the integers are made, and written
  with them.
* A round computes the pivot-entry distances only. ``|d(x, p) - d(p, e)|`` is at
  most ``d(x, e)`` for every pivot p, so the largest such difference bounds an
  entry from below. Entries are evaluated in the order of their bounds, and a
  part is done when the next bound is beyond its best distance: the entries
  left cannot be nearer, nor as near with a lower index.

Bounds are in floating point, lowered by more than its rounding; distances and
means are exact integers. Rows stay where they are: a round sends one row per
task, entry and component (sums, counts), and only codebooks reach the driver.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped. A vector shorter than the longest one, and a length that parts
does not divide, is taken as ended by zeros (an empty vector is all zeros).
Integers stop at ``LIMIT`` either way, so that no sum of squares overflows.
Equal vec_ids of the first 64 are ordered by their vectors, a null vec_id comes
last; repeated rows are rows of their own. Fewer than 64 rows make so many
entries. A mean over no part leaves an entry as it was. An empty table gives no
rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import hold, materialize, prepare, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 4
SCALE = 256
LIMIT = 1 << 24
STEP = 4096    # parts searched at a time
MARGIN = 1e-6  # of the distances in a bound: over the rounding of single precision


def integers(values: np.ndarray, lengths: np.ndarray, dim: int) -> np.ndarray:
    """int64 rows of ``dim`` components, of vectors one after another; zeros at the end."""
    q = np.clip(np.floor(SCALE * values.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)
    if len(lengths) and (lengths == dim).all():
        return q.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(q)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = q
    return out


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of a to those of b."""
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(2)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Indexes of entries far apart: each has the largest sum of distances to those
    chosen before it, as LAESA takes its base prototypes."""
    chosen = [0]
    far = np.zeros(len(entries))
    while len(chosen) < min(count, len(entries)):
        far += np.sqrt(squares(entries, entries[chosen[-1:]])[:, 0])
        far[chosen] = -1
        chosen.append(int(np.argmax(far)))
    return np.array(chosen)


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry of each row of x (ties: the lowest), its squared
    distance, and how many distances were evaluated."""
    between = np.sqrt(squares(pivots, entries)).astype(np.float32)
    index, best, evaluated = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), 0
    for at in range(0, len(x), STEP):
        part, seen = x[at:at + STEP], to_pivots[at:at + STEP]
        bound = np.zeros((len(part), len(entries)), np.float32)
        for p in range(len(pivots)):
            np.maximum(bound, np.abs(seen[:, p, None] - between[p]), out=bound)
        bound -= np.float32(MARGIN) * (seen.max(1)[:, None] + between.max())
        np.maximum(bound, 0, out=bound)
        found, dist = np.full(len(part), len(entries)), np.full(len(part), np.iinfo(np.int64).max)
        live = np.arange(len(part))
        while len(live):
            e = np.argmin(bound[live], 1)
            least = bound[live, e].astype(np.float64)
            open_ = least * least <= dist[live]  # an evaluated entry's bound is infinite
            live, e = live[open_], e[open_]
            if not len(live):
                break
            evaluated += len(live)
            d = ((part[live] - entries[e]) ** 2).sum(1)
            better = (d < dist[live]) | ((d == dist[live]) & (e < found[live]))
            dist[live[better]], found[live[better]] = d[better], e[better]
            bound[live, e] = np.inf
        index[at:at + STEP], best[at:at + STEP] = found, dist
    return index, best, evaluated


def _parts(dim: int, parts: int) -> list[slice]:
    wide = dim // parts
    return [slice(p * wide, (p + 1) * wide) for p in range(parts)]


def _batch(b: pa.RecordBatch, dim: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Integers and pivot distances of a written batch."""
    rows = b.num_rows
    q = np.frombuffer(b"".join(b.column("q").to_pylist()), np.int32).reshape(rows, dim).astype(np.int64)
    return q, np.frombuffer(b"".join(b.column("near").to_pylist()), np.float32).reshape(rows, parts, -1)


def prepared(rows: DataFrame, dim: int, parts: int, pivots: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, q, near), written: integers and pivot distances as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("codebooks", lambda: None)  # lets go of what other operators kept
        for b in batches:
            v = b.column("v")
            q = integers(v.flatten().to_numpy(zero_copy_only=False), v.value_lengths().to_numpy(zero_copy_only=False), dim)
            near = np.stack([np.sqrt(squares(q[:, s], pivots[p])) for p, s in enumerate(_parts(dim, parts))], 1).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([x.tobytes() for x in q.astype(np.int32)], pa.binary()),
                 pa.array([x.tobytes() for x in near], pa.binary())], names=["vec_id", "label", "q", "near"])

    types = dict(rows.dtypes)
    return materialize(rows.mapInArrow(run, f"vec_id {types['vec_id']}, label {types['label']}, q binary, near binary"), "codebook-parts")


def moved(data: DataFrame, dim: int, books: list[np.ndarray], pivots: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""
    parts, wide = len(books), dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(books[0])
        count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, wide), np.int64)
        for b in batches:
            q, near = _batch(b, dim, parts)
            for p, s in enumerate(_parts(dim, parts)):
                index = nearest(q[:, s], near[:, p], books[p], pivots[p])[0]
                count[p] += np.bincount(index, minlength=size)
                np.add.at(total[p], index, q[:, s])
        p, e = np.nonzero(count)
        slot = np.repeat(p * size + e, wide)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(np.tile(np.arange(wide), len(p))), pa.array(np.repeat(count[p, e], wide)), pa.array(total[p, e].ravel())],
            names=["slot", "at", "n", "total"])

    got = data.select("q", "near").mapInArrow(run, "slot long, at long, n long, total long").groupBy("slot", "at").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    flat = np.stack(books)
    slot, at, n, total = (got[c].to_numpy() for c in ("slot", "at", "n", "total"))
    flat[slot // len(books[0]), slot % len(books[0]), at] = total // n  # floors, of negative sums too
    return list(flat)


def coded(data: DataFrame, dim: int, books: list[np.ndarray], pivots: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error)."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, near = _batch(b, dim, parts)
            code, error = np.zeros((b.num_rows, parts), np.uint8), np.zeros(b.num_rows, np.int64)
            for p, s in enumerate(_parts(dim, parts)):
                index, dist, _ = nearest(q[:, s], near[:, p], books[p], pivots[p])
                code[:, p] = index
                error += dist
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array([x.tobytes().hex() for x in code], pa.string()), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    types = dict(data.dtypes)
    return data.mapInArrow(run, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def fit_codebooks(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
                  entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error) of every row kept, codebooks by part). At most
    256 entries, so that two hex digits hold an index."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    prepare(vectors.sparkSession)
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    dim = max(1, -(-(longest or 0) // parts)) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return vectors.sparkSession.createDataFrame([], f"vec_id {dict(rows.dtypes)['vec_id']}, label {dict(rows.dtypes)['label']}, code string, error long"), []
    start = integers(np.array([x for r in first for x in r[0]], np.float64), np.array([len(r[0]) for r in first]), dim)
    books = [start[:, s].copy() for s in _parts(dim, parts)]
    fixed = [b[choose_pivots(b, pivots)] for b in books]
    data = prepared(rows, dim, parts, fixed)
    for _ in range(rounds):
        books = moved(data, dim, books, fixed)
    return coded(data, dim, books, fixed), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256). Label sums are written,
    so Spark broadcasts them if that file is small and else shuffles, splitting
    a label with many rows."""
    found, books = fit_codebooks(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    found = materialize(found, "codebook-codes")
    sums = materialize(found.groupBy("label").agg(F.sum("error").alias("label_error")), "codebook-labels")
    sums = sums.withColumnRenamed("label", "of")
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def _assigned(book: str) -> str:
    """SQL: (vec_id, p, v, e, d) of the nearest entry of every part."""
    return f"""SELECT a.vec_id, a.p, a.v, min({{'d': {_DIST}, 'e': c.e}}) AS m
  FROM parts a JOIN {book} c ON c.p = a.p GROUP BY a.vec_id, a.p, a.v"""


_DIST = "list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - c.v[i]) * (a.v[i] - c.v[i])))::BIGINT"


def _moved(book: str, assigned: str) -> str:
    """SQL: (p, e, v) with every used entry at the floored means of its parts."""
    return f"""SELECT c.p, c.e, coalesce(s.v, c.v) AS v FROM {book} c LEFT JOIN (
    SELECT p, e, list(f ORDER BY i) AS v FROM (
      SELECT p, m.e AS e, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS f
      FROM {assigned}, range(1, {{wide}} + 1) t(i) GROUP BY p, m.e, i) GROUP BY p, e) s ON s.p = c.p AND s.e = c.e"""


def sql_of(dim: int = 64) -> str:
    """DuckDB SQL of op11 for vectors of one length that ``PARTS`` divides, with
    distinct ids that are not null."""
    wide = dim // PARTS
    return f"""WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS (SELECT vec_id, p, q[p * {wide} + 1 : (p + 1) * {wide}] AS v FROM kept, range({PARTS}) t(p)),
c0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})),
a1 AS ({_assigned("c0")}),
c1 AS ({_moved("c0", "a1").format(wide=wide)}),
a2 AS ({_assigned("c1")}),
c2 AS ({_moved("c1", "a2").format(wide=wide)}),
a3 AS ({_assigned("c2")}),
codes AS (SELECT vec_id, string_agg(printf('%02x', m.e::INT), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a3 GROUP BY vec_id),
book AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, i, v[i] AS x FROM c2, range(1, {wide} + 1) t(i)))
SELECT k.vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept k USING (vec_id), book"""


OP11_SQL = sql_of()
