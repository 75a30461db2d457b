"""Structured Streaming entry points.

* ``stream_ingest``: newly arriving document files -> the same chunking
  functions as the batch path -> ``foreachBatch`` writes each micro-batch
  into ``<sink>/batch_id=<n>`` with overwrite, so a replayed batch (after a
  failure, the checkpoint makes Spark re-run it) replaces its own output; readers
  take each document's last batch, so a document delivered again is upserted. Old
  batches are folded into a versioned store (``streaming.folding``), so the sink holds
  a bounded number of folders.
* ``stream_windows``: one row per key and window of event time, however late; the
  state is the result itself, in a folder for each day.
* ``stream_dedup``: ids that arrive more than once, exactly or within a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators import ingest, versions
from docweave.streaming import folding


def _source(spark: SparkSession, source_dir: str, schema, file_glob: str | None, **opts) -> DataFrame:
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.parquet(source_dir)


def stream_ingest(spark: SparkSession, source_dir: str, schema, sink_path: str, checkpoint: str,
                  chunk_size: int = 200, max_files_per_trigger: int = 1000,
                  file_glob: str | None = None, fold_after: int = 64) -> DataFrame:
    """Chunks of every document delivered so far; ``fold_after`` batches that wait in
    folders of their own are folded into the sink's store before the next is written. A document delivered again,
    in the same or a later batch, replaces its chunks: by batch, within a batch
    by file time, then file name, then text. Rows without doc_id are documents of
    their own, which no later delivery replaces."""
    src = _source(spark, source_dir, schema, file_glob, maxFilesPerTrigger=max_files_per_trigger)
    src = src.select("doc_id", "text", F.struct("_metadata.file_modification_time", "_metadata.file_path",
                                                F.col("text").alias("t")).alias("_order"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folding.fold_if_many(spark, sink_path, batch_id, fold_after)
        last = (batch.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
                .agg(F.max_by("text", "_order").alias("text")))
        chunks = ingest.ingest_chunks(last, size=chunk_size)
        unnamed = ingest.ingest_chunks(batch.filter(F.col("doc_id").isNull()), size=chunk_size)
        # a document without chunks keeps one row, so that it replaces an earlier delivery
        rows = last.select("doc_id").join(chunks, "doc_id", "left").unionByName(unnamed)
        rows.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    q = (src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return folding.read(spark, sink_path)


def stream_windows(spark: SparkSession, source_dir: str, schema, keys: list[str], ts_col: str, window: str,
                   path: str, checkpoint: str, file_glob: str | None = None, max_files_per_trigger: int = 1000,
                   files_per_day: int = 1) -> DataFrame:
    """(keys, window_start, first_ts, last_ts): repeats of a key within a window of event
    time become one row. Nothing is kept in executors' memory and no row is too late:
    a batch merges into the folders of the days that it has rows of, as one commit of a
    versioned store. Minimum and maximum do not change when a batch is merged twice, so
    neither failures nor the cut into batches change the result. Rows without a time
    have the window null, a null key is a key."""
    src = timestamp_col(_source(spark, source_dir, schema, file_glob, maxFilesPerTrigger=max_files_per_trigger), ts_col)
    group = ["namespace", *keys, "window_start"]
    start = F.window(F.col(ts_col), window)["start"]
    # F.window drops rows without a time, so those get theirs by hand
    timed = src.where(F.col(ts_col).isNotNull()).select(*keys, start.alias("window_start"), ts_col)
    untimed = src.where(F.col(ts_col).isNull()).select(*keys, F.lit(None).cast("timestamp").alias("window_start"), ts_col)
    day = F.coalesce(F.date_format("window_start", "yyyy-MM-dd"), F.lit("none"))
    rows = timed.unionByName(untimed).select(
        day.alias("namespace"), *keys, "window_start", F.col(ts_col).alias("first_ts"), F.col(ts_col).alias("last_ts"))

    def merged(frame: DataFrame) -> DataFrame:
        return frame.groupBy(*group).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = merged(batch).checkpoint(eager=True)
        if fresh.isEmpty():
            return
        base = versions.current_version(spark, path)
        if base:
            days = fresh.select("namespace").distinct()
            kept = versions.read(spark, path, base).join(days, "namespace", "left_semi")
            fresh = merged(fresh.unionByName(kept.select(*fresh.columns)))
        versions.commit(spark, path, fresh.withColumn("id", F.xxhash64(*keys, "window_start").cast("string")), base,
                        files_per_namespace=files_per_day)

    q = (rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not versions.current_version(spark, path):
        return spark.createDataFrame([], rows.drop("namespace").schema)
    return versions.read(spark, path).select(*keys, "window_start", "first_ts", "last_ts")


def stream_dedup(spark: SparkSession, source_dir: str, schema, keys: list[str], ts_col: str,
                 delay: str | None, sink_path: str, checkpoint: str, file_glob: str | None = None,
                 max_files_per_trigger: int = 1000) -> DataFrame:
    """One row per key. Without ``delay`` every key seen is kept as state (in
    the state store, which grows with the distinct keys) and the result does not
    depend on how rows fall into batches; with it, state is bounded: repeats are
    suppressed, and later rows accepted, only within ``delay`` of event time."""
    src = timestamp_col(_source(spark, source_dir, schema, file_glob, maxFilesPerTrigger=max_files_per_trigger), ts_col)
    if delay is None:
        dedup = src.select(*keys).dropDuplicates(keys)
    else:
        dedup = src.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(keys)
    q = (dedup.writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink_path)


def timestamp_col(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (with zone); normalise a TIMESTAMP_NTZ column."""
    return df.withColumn(col, F.col(col).cast("timestamp"))
