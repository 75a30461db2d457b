"""A vector store with versions: immutable files, replaced in one step.

    data/commit=<id>/ns=n_<namespace>/...   rows of the namespaces a commit wrote
    manifests/<id>/...                      (ns, commit): which commit has a namespace
    versions/version=<n>/...                one row: the id of that version's manifest

An upsert writes the merged content of the namespaces it touches as a new commit,
then a manifest (the last version's with those namespaces replaced), and last the
version's one-row file, whose renaming into place is the only step that readers
can see. A write that ends half way leaves the last version as it was; its files
are named by nothing. Readers pin a version: what they read is never rewritten. Of
two writers of one version that with the smaller id has won, the other one is told.
Nothing but the version number, one manifest id and the ids of live commits (one
for each upsert since the last ``compact``) reaches the driver.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators import store
from docweave.session import shuffles_dropped


class Conflict(RuntimeError):
    """Another writer has made this version."""


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the last version, 0 if there is none."""
    try:
        return spark.read.schema("manifest string, version long").parquet(f"{path}/versions").agg(F.max("version")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def _manifest_id(spark: SparkSession, path: str, version: int) -> str | None:
    rows = spark.read.schema("manifest string, version long").parquet(f"{path}/versions").where(F.col("version") == version)
    return rows.agg(F.min("manifest")).first()[0]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(ns, commit) of a version, by default the last one."""
    version = current_version(spark, path) if version is None else version
    if version == 0:
        return spark.createDataFrame([], "ns string, commit string")
    name = _manifest_id(spark, path, version)
    if name is None:
        raise ValueError(f"the store has no version {version}")
    return spark.read.schema("ns string, commit string").parquet(f"{path}/manifests/{name}")


def read(spark: SparkSession, path: str, version: int | None = None, namespace: str | None = None,
         prefix: str | None = None) -> DataFrame:
    """The rows of a version; only files of its commits, and of one namespace or those
    with a prefix if given, are listed as input (filters on the folders)."""
    version = current_version(spark, path) if version is None else version
    m = manifest(spark, path, version)
    wanted = F.lit(True)
    if namespace is not None:
        wanted = F.col("ns") == _ns(F.lit(namespace))
    elif prefix is not None:
        wanted = F.col("ns").startswith(_ns(F.lit(prefix)))
    m = m.where(wanted)
    commits = [r[0] for r in m.select("commit").distinct().collect()]
    if not commits and not version:
        raise ValueError("the store has no version")
    rows = spark.read.parquet(f"{path}/data").where(F.col("commit").isin(commits)).where(wanted)
    return rows.join(m, ["commit", "ns"], "left_semi").drop("commit", "ns")


def _ns(namespace) -> F.Column:
    """A folder name that is read back as a string, whatever the namespace."""
    return F.concat(F.lit("n_"), F.coalesce(F.col(namespace) if isinstance(namespace, str) else namespace, F.lit("")))


def _publish(spark: SparkSession, path: str, version: int, name: str) -> None:
    """The step that readers see: one file with one row."""
    spark.createDataFrame([(name,)], "manifest string").coalesce(1).write.mode("append").parquet(f"{path}/versions/version={version}")
    if _manifest_id(spark, path, version) != name:
        raise Conflict(f"version {version} was made by another writer")


def commit(spark: SparkSession, path: str, rows: DataFrame | list[DataFrame], base: int, keep: bool = True, files_per_namespace: int | None = 1,
           replaced: DataFrame | None = None) -> int:
    """Make version ``base`` + 1: ``rows`` are the whole content of their namespaces,
    all other namespaces of ``base`` stay (or none, without ``keep``), but for those of
    ``replaced`` (namespace), which may have become empty. Without ``files_per_namespace``
    rows are written where they are, for few namespaces of any size: a task adds one
    file to each that it meets, and no task gets a whole namespace. Of several frames of
    ``rows`` one is written after the other, and only one has its shuffles on disk."""
    if base != current_version(spark, path):
        raise Conflict(f"version {base} is not the last one")
    name = "c" + uuid.uuid4().hex
    for part in rows if isinstance(rows, list) else [rows]:
        dealt = part.withColumn("ns", _ns("namespace"))
        if files_per_namespace is not None:
            dealt = dealt.repartition("ns", F.pmod(F.xxhash64("id"), F.lit(files_per_namespace)))
        with shuffles_dropped(spark):
            dealt.write.mode("append").partitionBy("ns").parquet(f"{path}/data/commit={name}")
    written = spark.read.parquet(f"{path}/data").where(F.col("commit") == name).select("ns", "commit").distinct()
    if keep and base:
        gone = written.select("ns") if replaced is None else written.select("ns").unionByName(replaced.select(_ns("namespace").alias("ns")))
        written = manifest(spark, path, base).join(gone, "ns", "left_anti").unionByName(written)
    written.select("ns", "commit").write.parquet(f"{path}/manifests/{name}")
    _publish(spark, path, base + 1, name)
    return base + 1


def upsert(spark: SparkSession, path: str, incoming: DataFrame, keys=("namespace", "id"), seq_col: str = "seq") -> int:
    """The latest row per key of ``incoming`` replaces or joins the last version's rows."""
    base = current_version(spark, path)
    if not base:
        return commit(spark, path, store.latest(incoming, keys, seq_col).select(*incoming.columns), 0)
    existing = read(spark, path, base)
    merged = store.merge_touched(existing, incoming.select(*existing.columns), keys, seq_col)
    return commit(spark, path, merged, base)


def compact(spark: SparkSession, path: str, files_per_namespace: int = 1) -> int:
    """A version with the same rows in one commit."""
    base = current_version(spark, path)
    return commit(spark, path, read(spark, path, base), base, keep=False, files_per_namespace=files_per_namespace)
