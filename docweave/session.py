"""Session helpers: one place for the engine-wide Spark settings."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings that matter for results or scale, applied to sessions we build.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "docweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when nothing is
    configured (local tests) fall back to a fresh scratch directory."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        configured = tempfile.mkdtemp(prefix="docweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is run inside leaves no shuffle files: they go as soon as it has ended, not
    when the driver happens to collect its garbage, so of several steps only one has its
    files on disk. Not for what is persisted inside."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint directory and read back: its plan is
    run once, the files are smaller than a checkpoint's, and its shuffles are dropped."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that one task of a dealt frame gets, about.
ROWS_PER_TASK = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt out by ``keys`` to so many tasks that none has
    much more than ROWS_PER_TASK. Where the cluster's parallelism is enough for that,
    Spark chooses how many; its target is one of compressed bytes, of which rows with much
    in common need few, so that on large tables a task would get millions."""
    n = -(-rows // ROWS_PER_TASK)
    return df.repartition(*keys) if n <= df.sparkSession.sparkContext.defaultParallelism else df.repartition(n, *keys)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table with its declared schema (no inference job). The plan is the
    scan alone, so filters and column choices reach it."""
    from docweave.schemas import TABLE_DDL
    reader = spark.read.schema(TABLE_DDL[name]) if name in TABLE_DDL else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``docweave`` importable in the Python workers (pandas UDFs and
    mapInPandas functions refer to its modules): zip the package once per
    application and register it with ``addPyFile``, the programmatic form of
    ``--py-files``. Skipped when the package was already shipped. The zip
    is staged on the driver only (like a ``--py-files`` argument); Spark's
    file server hands it to every executor, no executor reads a local path."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="docweave-pyfiles-"), "docweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
