"""Chunks over pages equal the chunks of the glued document."""
import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from docweave.operators import ingest, pagechunks

SCHEMA = "doc_id long, page_no int, text string"


def both(spark, rows, size):
    pages = spark.createDataFrame(rows, SCHEMA)
    glued = ingest.assemble_documents(pages)
    want = sorted((r.doc_id or -1, r.chunk_id, r.chunk_text) for r in ingest.ingest_chunks(glued, size).collect())
    got = sorted((r.doc_id or -1, r.chunk_id, r.chunk_text) for r in pagechunks.chunk_pages(pages, size).collect())
    return got, want


def test_page_breaks(spark):
    rows = [(1, 1, "alpha be"), (1, 2, "ta"), (1, 3, "gam"), (1, 4, "ma delta "), (1, 5, " epsilon"), (1, 6, None), (1, 7, "zeta can"),
            (1, 8, "not!? the"), (1, 9, "ory\tend."),
            (2, 1, "!!!"), (2, 2, ""), (2, 3, " "), (3, 1, None),       # nothing to chunk
            (4, 9, "far apart"), (4, 3, "b "), (4, 1, "a"), (4, 4, ""), (4, 4, "!"),
            (None, 1, "no id ei"), (None, 2, "ther"), (5, 1, "oneword"), (6, 1, "ΑΣ ΟΔΟΣ"), (6, 2, "Α X")]
    for size in (1, 2, 200):
        got, want = both(spark, rows, size)
        assert got == want and want


def test_random_pages_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pagechunks, "_BLOCK", 4)
    rnd = random.Random(11)
    pieces = ["word", "the", " ", "  ", "\n", "x", "gonna", "-", ".", "Mixed", "9", "été", ""]
    rows = [(d, p, "".join(rnd.choice(pieces) for _ in range(rnd.randrange(9)))) for d in range(1, 6) for p in range(1, 60)]
    got, want = both(spark, rows, 7)
    assert got == want and len(want) > 20


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pagechunks.chunk_pages(empty).count() == 0
    with pytest.raises(ValueError):
        pagechunks.chunk_pages(empty, 0)
    with pytest.raises(SparkRuntimeException, match="two pages"):
        pagechunks.chunk_pages(spark.createDataFrame([(1, 2, "a b"), (1, 2, "c d")], SCHEMA)).count()


def test_pages_of_one_document_are_spread(spark):
    """A document of many pages is not one row or one group: its pages lie in many blocks."""
    pages = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), (F.col("id") + 1).cast("int").alias("page_no"),
                                     F.concat(F.lit(" w"), F.col("id").cast("string"), F.lit(" ")).alias("text"))
    ch = pagechunks.chunk_pages(pages, 200)
    assert ch.count() == 25 and ch.agg(F.max(F.size(F.split("chunk_text", " ")))).first()[0] == 200
    assert ch.where("chunk_id = 3").first().chunk_text.split(" ")[:2] == ["w600", "w601"]
