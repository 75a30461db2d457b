"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import ensure_checkpoint_dir, scratch_path, ship_package

#: A word everywhere in this subpackage: a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Those six characters.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint directory and read it back: the
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch: whole texts, sets and vectors are kilobytes each.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Checkpoint directory set, the package importable in Python workers, and
    Arrow batches of at most BATCH_ROWS rows unless the session asks for fewer."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def words(text) -> F.Column:
    """array<string> of the words of a text; null text: no words."""
    c = F.col(text) if isinstance(text, str) else text
    spaced = F.translate(F.coalesce(c, F.lit("")), BLANKS[1:], " " * 5)
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def word_count(text) -> F.Column:
    """Number of words, long; null text: 0."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.size(F.regexp_extract_all(c, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns whose names (in any case) an operator is about to set."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


_HELD: dict[str, object] = {}


def hold(key: str, make):
    """What this Python worker keeps between tasks: one object at a time, made by
    ``make()`` unless the key is that of the one held. Workers are shared by all
    operators of an application, so what another one left is let go first."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]
