"""The corpus pipeline: documents -> quality -> language -> near duplicates ->
mix -> packed sequences. Each stage's result is written as Parquet under the
shared checkpoint folder and read again as the next one's documents.

Rows are those of the stages' operators (see docweave/llm): null or empty
texts fail the quality rules, an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm import jaccard, langid, mixing, packing, quality
from docweave.llm.common import materialize, table

STAGES = [
    ("quality rules", quality.kept_documents),
    ("language identification", langid.identified_documents),
    ("n-gram Jaccard join", jaccard.distinct_documents),
    ("mixing sources", mixing.mixed_documents),
    ("best-fit packing", packing.packed_documents),
]

#: Language identification fits a model, which SQL does not express: tests hold
#: the pipeline against plain Python versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
