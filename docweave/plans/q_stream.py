"""Registered streaming queries (run to completion with availableNow)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.plans.q_text import _token_chunk_sql
from docweave.plans.registry import register
from docweave.session import scratch_path
from docweave.streaming import ingest as SI


def _files_of(t, name: str) -> tuple[str, str | None]:
    """Folder to stream and file-name glob of a table: a table that is a folder of
    part files is streamed itself, one that is a file by its name."""
    path = f"{t.sf_dir.rstrip('/')}/{name}.parquet"
    where = t.spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(t.spark._jsc.hadoopConfiguration())
    return (path, None) if fs.getFileStatus(where).isDirectory() else (t.sf_dir, f"{name}.parquet")


@register("stream_ingest", _token_chunk_sql(200))
def stream_ingest(t):
    """The documents consumed as a stream, chunked per micro-batch by the
    batch functions and upserted by document; equals the batch token_chunks result."""
    schema = t.documents.schema
    source, glob = _files_of(t, "documents")
    out = SI.stream_ingest(t.spark, source, schema, scratch_path(t.spark, "stream-sink"),
                           scratch_path(t.spark, "stream-ckpt"), file_glob=glob)
    return out.select("doc_id", F.col("chunk_id").cast("bigint").alias("chunk_id"),
                      F.size(F.split("chunk_text", " ")).cast("bigint").alias("n_tokens"), "chunk_text")


@register("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t):
    """Repeats of (user_id, event_type) suppressed over the whole stream,
    whatever the batches."""
    schema = t.events.schema
    source, glob = _files_of(t, "events")
    out = SI.stream_dedup(t.spark, source, schema, ["user_id", "event_type"], "ts", None,
                          scratch_path(t.spark, "dedup-sink"), scratch_path(t.spark, "dedup-ckpt"),
                          file_glob=glob)
    return out.select("user_id", "event_type")


@register("stream_windows", """
SELECT user_id, event_type, epoch(date_trunc('hour', ts))::BIGINT AS hour_start,
       epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM events GROUP BY ALL
""")
def stream_windows(t):
    """X2 with bounded state: one row per user, event type and hour, whatever the batches
    and however late the rows."""
    source, glob = _files_of(t, "events")
    out = SI.stream_windows(t.spark, source, t.events.schema, ["user_id", "event_type"], "ts", "1 hour",
                            scratch_path(t.spark, "windows-store"), scratch_path(t.spark, "windows-ckpt"),
                            file_glob=glob, files_per_day=int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return out.select("user_id", "event_type", F.unix_timestamp("window_start").alias("hour_start"),
                      F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"))
