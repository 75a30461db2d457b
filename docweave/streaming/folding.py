"""The folders of a streamed sink, folded into a versioned store.

    <sink>/batch_id=<n>/...   the chunks of one micro-batch
    <sink>/_store/...         chunks of the folded batches (``operators.versions``)

A fold moves the batches up to one number into the store: documents are dealt to
namespaces by a hash of their id, a namespace that got a document is written anew
without the document's earlier chunks, the others stay. The last folded number is a
row of the same commit, so chunks and number become visible together: a fold that ends
half way changes nothing, a repeated one finds nothing to do. Batches that are folded
are read by nobody; their folders go with the next fold, so that a reader who planned
before this one ends in peace. A fold writes the touched namespaces again: fold more
batches at once where that is too much.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators import versions

_NUMBER = "folded"   # namespace of the row that holds the last folded batch


def _store(sink: str) -> str:
    return f"{sink}/_store"


def folded_up_to(spark: SparkSession, sink: str, version: int | None = None) -> int:
    """The last folded batch, -1 if none is."""
    version = versions.current_version(spark, _store(sink)) if version is None else version
    if not version:
        return -1
    return int(versions.read(spark, _store(sink), version, namespace=_NUMBER).first()["id"])


def _batches(spark: SparkSession, sink: str) -> dict[int, object]:
    """Batch number -> folder. Their number is bounded by folding."""
    where = spark._jvm.org.apache.hadoop.fs.Path(sink)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return {}
    found = [f.getPath() for f in fs.listStatus(where)]
    return {int(p.getName().split("=")[1]): p for p in found if p.getName().startswith("batch_id=")}


def last_deliveries(rows: DataFrame) -> DataFrame:
    """The rows of each document's last batch, and all rows without doc_id."""
    unnamed = rows.filter(F.col("doc_id").isNull())
    last = rows.groupBy("doc_id").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, ["doc_id", "batch_id"]).select(*rows.columns).unionByName(unnamed)


def fold(spark: SparkSession, sink: str, up_to: int, namespaces: int = 64) -> int:
    """Fold the batches numbered at most ``up_to`` that are not folded yet; how many they
    were. The number of namespaces must be the same in all folds of a sink."""
    path = _store(sink)
    base = versions.current_version(spark, path)
    done = folded_up_to(spark, sink, base)
    there = _batches(spark, sink)
    new = [n for n in there if done < n <= up_to]
    if not new:
        return 0
    rows = spark.read.parquet(sink).where((F.col("batch_id") > done) & (F.col("batch_id") <= up_to))
    home = F.concat(F.lit("part"), F.pmod(F.xxhash64("doc_id"), F.lit(namespaces)).cast("string"))
    # rows without doc_id replace nothing and are replaced by nothing: a namespace for each fold
    home = F.when(F.col("doc_id").isNull(), F.lit(f"unnamed{up_to}")).otherwise(home)
    last = last_deliveries(rows).drop("batch_id").withColumn("namespace", home)
    last = last.withColumn("id", F.col("doc_id").cast("string"))
    delivered = rows.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().withColumn("namespace", home)
    number = spark.range(1).select(F.lit(_NUMBER).alias("namespace"), F.lit(str(up_to)).alias("id"))
    out = last.where(F.col("chunk_id").isNotNull()).unionByName(number, allowMissingColumns=True)
    if base:
        kept = (versions.read(spark, path, base).join(delivered.select("namespace").distinct(), "namespace", "left_semi")
                .join(delivered.select("doc_id"), "doc_id", "left_anti"))
        out = out.unionByName(kept)
    versions.commit(spark, path, out, base, replaced=delivered.select("namespace").distinct())
    fs = next(iter(there.values())).getFileSystem(spark._jsc.hadoopConfiguration())
    for n, folder in there.items():
        if n <= done:
            fs.delete(folder, True)
    return len(new)


def fold_if_many(spark: SparkSession, sink: str, batch_id: int, most: int, namespaces: int = 64) -> None:
    """Before batch ``batch_id`` is written: fold what is older if ``most`` batches wait. A
    batch that is repeated after a failure is never among them."""
    done = folded_up_to(spark, sink)
    if batch_id <= done:
        raise ValueError(f"batch {batch_id} of this sink is folded already: a new checkpoint needs a new sink")
    if sum(done < n < batch_id for n in _batches(spark, sink)) >= most:
        fold(spark, sink, batch_id - 1, namespaces)


def read(spark: SparkSession, sink: str) -> DataFrame:
    """The chunks of every document's last delivery, folded or not."""
    path = _store(sink)
    version = versions.current_version(spark, path)
    done = folded_up_to(spark, sink, version)
    waiting = spark.read.parquet(sink).where(F.col("batch_id") > done)
    out = last_deliveries(waiting).where(F.col("chunk_id").isNotNull()).drop("batch_id")
    if version:
        stored = versions.read(spark, path, version).where(F.col("namespace") != _NUMBER)
        again = waiting.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
        out = out.unionByName(stored.join(again, "doc_id", "left_anti").select(*out.columns))
    return out
