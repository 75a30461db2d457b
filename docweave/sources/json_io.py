"""JSON sources and sinks for vector objects and sectioned pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave import schemas


def write_vectors_json(vectors: DataFrame, path: str) -> None:
    """Distributed JSON Lines (one object per line, UTF-8, not escaped)."""
    vectors.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_vectors_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Strict read with the declared schema: malformed input fails the job
    instead of turning into null rows. ``multiline`` accepts one JSON object
    or one JSON array of objects per file."""
    r = spark.read.schema(schemas.VECTOR_OBJECT).option("mode", "FAILFAST")
    if multiline:
        r = r.option("multiLine", True)
    return r.json(path)


def read_json_permissive(spark: SparkSession, path: str, schema, multiline: bool = True) -> DataFrame:
    """Lenient read: unparsable records become nulls plus the raw text."""
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("multiLine", multiline).option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(path))


def to_json_text(df: DataFrame, cols: list[str], out_col: str = "json") -> DataFrame:
    return df.withColumn(out_col, F.to_json(F.struct(*cols)))
