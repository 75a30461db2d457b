"""File listing and file metadata through Spark's binaryFile source.

Only path/length/modificationTime are selected, so the byte content is
never read for a listing (column pruning on the binaryFile scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.text import basename


def list_files(spark: SparkSession, root: str, suffix: str = "pdf", recursive: bool = True,
               case_sensitive: bool = False) -> DataFrame:
    """Recursive + case-insensitive (profile mode) or flat + case-sensitive
    (ingest mode) listing of files with the given suffix."""
    if case_sensitive:
        glob = f"*.{suffix}"
    else:
        glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(root)
    return df.select("path", "length", "modificationTime")


def file_metadata(files: DataFrame) -> DataFrame:
    """filename, file_size, last_modified (ISO, UTC) and epoch seconds.
    Creation time is not exposed by the file source and stays null."""
    return files.select(
        "path",
        basename("path").alias("filename"),
        F.col("length").cast("bigint").alias("file_size"),
        F.lit(None).cast("string").alias("creation_date"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_modified"),
        (F.unix_micros("modificationTime").cast("double") / 1e6).alias("modified_time"))


def read_pages(spark: SparkSession, files: DataFrame, extractor, schema: str =
               "path string, page_no int, text string, status string, error string") -> DataFrame:
    """Extractor plug-in: ``extractor(path, content_bytes) -> list[str]`` pages.
    Runs in Arrow batches via mapInPandas; a failing file yields one row
    with status 'error' (quarantine) instead of failing the job."""
    import pandas as pd

    from docweave.session import ship_package
    ship_package(spark)

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    for i, page in enumerate(extractor(path, content), start=1):
                        rows.append((path, i, page, "ok", None))
                except Exception as e:  # noqa: BLE001 - quarantined per file
                    rows.append((path, None, None, "error", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "page_no", "text", "status", "error"])

    return files.select("path", "content").mapInPandas(run, schema)
