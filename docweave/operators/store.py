"""Vector store as a namespace-partitioned table.

* positions: a stable 0-based row index without a single-partition window
  (range partition by the order key, count per partition, offsets from the
  tiny per-partition count table, added back with a broadcast join whose
  size is the partition count).
* batches / namespaces: closed form over the position (batch B, namespace
  size S): flush index j = min((i div B + 1) * B - 1, n - 1), namespace
  ``namespace_{j div S}``.
* upsert: the incoming run wins per (namespace, id); only the namespaces it
  writes to are read back and rewritten (partition pruning + dynamic
  partition overwrite), duplicates inside the run resolved by ``max_by``.
* writes: dynamic partition overwrite per namespace into a fresh path; a
  task retry rewrites the same files, so the write is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import vectors as vx
from docweave.session import ensure_checkpoint_dir

BATCH_SIZE = 100
NAMESPACE_SIZE = 1000
_LOCAL_BITS = 33  # monotonically_increasing_id: partition id in the upper bits


def with_positions(df: DataFrame, order_cols: list[str], out_col: str = "pos",
                   num_partitions: int | None = None) -> DataFrame:
    """Add a dense 0-based position in ``order_cols`` order (order key must be
    unique for a reproducible result). The ranged data is checkpointed to the
    shared checkpoint directory so both passes see the same partitions."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
              .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
              .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_cnt"))
    # at most `n` rows: one per range partition
    offs = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("n_total"))
    offs = offs.fillna(0, ["_off"])
    return (ranged.join(F.broadcast(offs), "_pid")
            .withColumn(out_col, (F.col("_off") + F.col("_loc")).cast("bigint"))
            .drop("_mid", "_pid", "_loc", "_off"))


def assign_batches(df: DataFrame, order_cols: list[str], batch_size: int = BATCH_SIZE,
                   namespace_size: int = NAMESPACE_SIZE) -> DataFrame:
    """Batch number and namespace of each item as a sequential loader that
    flushes every ``batch_size`` items and switches namespace every
    ``namespace_size`` items would assign them."""
    p = with_positions(df, order_cols)
    flush = F.least((F.floor(F.col("pos") / batch_size) + 1) * batch_size - 1, F.col("n_total") - 1)
    return (p.withColumn("batch", F.floor(F.col("pos") / batch_size).cast("bigint"))
            .withColumn("namespace", F.concat(F.lit("namespace_"),
                                              F.floor(flush / namespace_size).cast("bigint").cast("string")))
            .withColumn("last_namespace", F.concat(F.lit("namespace_"), F.floor(
                F.col("n_total") / namespace_size).cast("bigint").cast("string"))))


def place_incoming(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """incoming (id, values) with its ``namespace``: an id that the store holds
    stays where it is (in every namespace that holds it), so the write replaces
    it; only new ids are numbered, without their vectors. ``last_namespace`` is
    that of the new ids, null for stored ones."""
    ids = incoming.select("id").distinct()
    if existing is not None:
        stored = existing.select("namespace", "id").join(ids, "id", "left_semi")
        ids = ids.join(existing.select("id"), "id", "left_anti")
    places = assign_batches(ids, ["id"]).select("id", "namespace", "last_namespace")
    if existing is not None:
        places = places.unionByName(stored.withColumn("last_namespace", F.lit(None).cast("string")))
    return incoming.join(places, "id")


def assign_ids(df: DataFrame, id_col: str, pos_col: str = "pos") -> DataFrame:
    """Missing id -> ``auto_id_{position}``."""
    return df.withColumn(id_col, F.coalesce(F.col(id_col).cast("string"),
                                            F.concat(F.lit("auto_id_"), F.col(pos_col).cast("string"))))


def latest(df: DataFrame, keys=("namespace", "id"), seq_col: str = "seq") -> DataFrame:
    """One row per key: the one with the highest ``seq``."""
    payload = [c for c in df.columns if c not in keys]
    win = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col(seq_col)).alias("_w"))
    return win.select(*keys, "_w.*")


def merge_touched(existing: DataFrame, incoming: DataFrame, keys=("namespace", "id"),
                  seq_col: str = "seq") -> DataFrame:
    """The new content of every namespace the incoming run writes to.

    Only those namespaces of the existing store are read (semi join on the
    partition column -> partition pruning); the incoming run is deduplicated
    on its own (latest seq per key) and replaces existing rows with the same
    key; the aggregation never sees the existing store."""
    inc = latest(incoming, keys, seq_col)
    touched = inc.select("namespace").distinct()
    ex = existing.join(touched, "namespace", "left_semi")
    keep = ex.join(inc.select(*keys), list(keys), "left_anti")
    return keep.unionByName(inc.select(*existing.columns))


def upsert(existing: DataFrame, incoming: DataFrame, keys=("namespace", "id"),
           seq_col: str = "seq") -> DataFrame:
    """Whole store after the upsert: untouched namespaces as they are plus
    the merged content of the touched ones (incoming wins per key). For a
    write, ``merge_touched`` + ``write_store`` (dynamic overwrite) rewrites
    only the touched namespaces."""
    touched = incoming.select("namespace").distinct()
    untouched = existing.join(touched, "namespace", "left_anti")
    return untouched.unionByName(merge_touched(existing, incoming, keys, seq_col))


def write_store(store: DataFrame, path: str, mode: str = "overwrite", files_per_namespace: int = 1) -> None:
    """Partitioned by namespace; dynamic overwrite replaces only the
    namespaces present in ``store``. Rows are clustered by namespace first, so
    a namespace gets ``files_per_namespace`` files, not one per writing task."""
    part = F.pmod(F.xxhash64("id"), F.lit(files_per_namespace))
    (store.repartition("namespace", part).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("namespace").parquet(path))


def upsert_table(spark, path: str, incoming: DataFrame, keys=("namespace", "id"),
                 seq_col: str = "seq") -> DataFrame:
    """Upsert into a namespace-partitioned parquet table in place.

    The merged content of the touched namespaces is materialised first (a
    reliable checkpoint), so the table is never overwritten while a job still
    reads it; then only those namespace directories are replaced (dynamic
    partition overwrite). Re-running the same upsert gives the same table."""
    existing = spark.read.parquet(path)
    cols = existing.columns
    merged = merge_touched(existing, incoming.select(*cols), keys, seq_col).checkpoint(eager=True)
    write_store(merged, path)
    return spark.read.parquet(path)


def fetch(store: DataFrame, ids: DataFrame, namespace: str | None = None) -> DataFrame:
    """Vectors by id (semi join); a namespace filter prunes partitions."""
    s = store if namespace is None else store.filter(F.col("namespace") == namespace)
    return s.join(ids.select("id").distinct(), "id", "left_semi")


def verify(store: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(missing rows, one-row summary). Each id is looked up in its own
    namespace; the summary also reports what a lookup confined to the
    loader's "last namespace" (``namespace_{n div S}``, as returned by a
    sequential loader) would find. ``expected`` comes from assign_batches."""
    missing = expected.join(store.select("namespace", "id"), ["namespace", "id"], "left_anti")
    found = expected.join(store.select("namespace", "id").withColumn("_hit", F.lit(True)),
                          ["namespace", "id"], "left")
    summary = (found
               .agg(F.count_if(F.col("_hit").isNotNull()).cast("bigint").alias("verified"),
                    F.count_if(F.col("_hit").isNull()).cast("bigint").alias("failed"),
                    F.count("*").cast("bigint").alias("total"),
                    F.count_if(F.col("_hit").isNotNull() & (F.col("namespace") == F.col("last_namespace")))
                    .cast("bigint").alias("verified_in_last_namespace")))
    return missing, summary


def index_stats(store: DataFrame, capacity: int = 1_000_000, vec_col: str = "values") -> DataFrame:
    n = F.count("*")
    return store.agg(F.max(F.size(vec_col)).cast("bigint").alias("dimension"),
                     n.cast("bigint").alias("total_vector_count"),
                     (n / F.lit(float(capacity))).alias("index_fullness"),
                     F.format_string("%.2f%%", n / F.lit(float(capacity)) * 100).alias("fullness_text"))


def namespace_counts(store: DataFrame) -> DataFrame:
    return store.groupBy("namespace").agg(F.count("*").cast("bigint").alias("vector_count"))


def fit_store_dimension(df: DataFrame, dim: int, vec_col: str = "values") -> DataFrame:
    """Every vector cut or zero-padded to the store's dimension before it is written."""
    return df.withColumn(vec_col, vx.fit_dimension(vec_col, dim))
