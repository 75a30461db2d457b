"""Delta-maintained token counts by source, language and tokenizer version.

A batch holds signed events: an insert adds a document's tokens, a delete
takes them away, a revision replaces an old count by a new one. The batch is
summed by group (partial sums first, so a source with a third of all rows
costs nothing extra) and only its sums are written, to a folder of its own
named by the batch id; Spark's commit marker in that folder is the commit. A
batch that is delivered again finds the marker and changes nothing; one whose
writer died has none, is not read, and is written anew. Totals are the sum of
the committed batches, added to the newest complete snapshot; ``compact``
folds batches into a snapshot that lists them, so none counts twice.

Defined cases: null source or language is a group of its own; null tokens
count as 0; events of an unknown kind fail the batch; repeated rows in a batch
are separate events; an empty batch is committed and adds nothing; groups
without documents and tokens left are not reported; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import WORD, materialize, table
from docweave.llm.quality import SYMBOLS
from docweave.session import scratch_path

GROUP = ("source", "lang", "version")
SUMS = "source string, lang string, version string, docs long, tokens long"

#: Tokenizer versions that the query counts with: a pattern that matches one token.
TOKENIZERS = {
    "words-1": WORD,
    "pieces-1": r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]",
}


def signed(events: DataFrame) -> DataFrame:
    """(kind, source, lang, version, tokens, old_tokens) -> docs and tokens with signs."""
    kind, new, old = F.col("kind"), F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    unknown = F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce(kind, F.lit("null"))))
    return events.select(
        *GROUP, F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(unknown.cast("int")).alias("docs"),
        F.when(kind == "insert", new).when(kind == "delete", -old).otherwise(new - old).alias("tokens"))


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))


class TokenRollup:
    """Totals kept under ``path`` (any file system that Spark writes)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _committed(self, kind: str) -> list[str]:
        """Names of the complete folders of a kind (batches, snapshots), in order."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def commit(self, batch_id: str, events: DataFrame) -> bool:
        """Add a batch once; False if it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        if batch_id in self._committed("batches") or batch_id in self._folded():
            return False
        summed(signed(events)).write.mode("overwrite").parquet(f"{self.path}/batches/{batch_id}")
        return True

    def _snapshot(self) -> str | None:
        found = self._committed("snapshots")
        return f"{self.path}/snapshots/{found[-1]}" if found else None

    def _folded(self) -> set[str]:
        at = self._snapshot()
        if at is None:
            return set()
        return {r[0] for r in self.spark.read.schema("batch string").parquet(f"{at}/folded").collect()}

    def _parts(self) -> tuple[list[str], DataFrame]:
        at, folded = self._snapshot(), self._folded()
        fresh = [b for b in self._committed("batches") if b not in folded]
        paths = [f"{self.path}/batches/{b}" for b in fresh] + ([f"{at}/sums"] if at else [])
        rows = self.spark.read.schema(SUMS).parquet(*paths) if paths else self.spark.createDataFrame([], SUMS)
        return fresh, rows

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of all committed batches."""
        return summed(self._parts()[1]).where("docs <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Fold the committed batches into a new snapshot; its marker is written last."""
        folded = self._folded()
        fresh, rows = self._parts()
        at = f"{self.path}/snapshots/{len(self._committed('snapshots')):08d}"
        summed(rows).coalesce(1).write.mode("overwrite").parquet(f"{at}/sums")
        names = self.spark.createDataFrame([(b,) for b in sorted(folded | set(fresh))], "batch string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{at}/folded")
        jvm = self.spark._jvm
        mark = jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(mark).close()


def scrubbed(text: str) -> F.Column:
    """The revision that the query replays: the text without symbol noise."""
    return F.translate(text, SYMBOLS, "")


def token_ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, version, tokens, revised): counts of each text and of
    its scrubbed form by every tokenizer version; one pass over the texts."""
    count = lambda c, p: F.coalesce(F.size(F.regexp_extract_all(c, F.lit(p), F.lit(0))), F.lit(0)).cast("long")
    d = docs.select("doc_id", "source", "lang", F.col("text").alias("__t"), scrubbed("text").alias("__s"))
    counts = F.array(*[F.struct(F.lit(v).alias("version"), count(F.col("__t"), p).alias("tokens"), count(F.col("__s"), p).alias("revised"))
                       for v, p in TOKENIZERS.items()])
    return d.select("doc_id", "source", "lang", counts.alias("c")).select("doc_id", "source", "lang", F.inline("c"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are loaded; those labelled toxic are taken down; those labelled
    of low quality are scrubbed and counted anew. Load and takedown are delivered
    twice, and a snapshot is made in between."""
    ledger = materialize(token_ledger(table(spark, sf_dir, "documents")), "token-ledger")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(F.col("toxic") == 1).alias("toxic"), F.min(F.col("quality") == 1).alias("good"))
    judged = ledger.join(labels, "doc_id")
    event = lambda rows, kind, new, old: rows.select(F.lit(kind).alias("kind"), *GROUP, new.alias("tokens"), old.alias("old_tokens"))
    none = F.lit(None).cast("long")
    load = event(ledger, "insert", F.col("tokens"), none)
    takedown = event(judged.where("toxic"), "delete", none, F.col("tokens"))
    scrub = event(judged.where("NOT toxic AND NOT good"), "revise", F.col("revised"), F.col("tokens"))
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("0001-load", load)
    rollup.commit("0002-takedown", takedown)
    rollup.commit("0001-load", load)
    rollup.compact()
    rollup.commit("0003-scrub", scrub)
    rollup.commit("0002-takedown", takedown)
    return rollup.totals()


def _count_sql(text: str, pattern: str) -> str:
    return f"coalesce(len(regexp_extract_all({text}, '{pattern}')), 0)"


OP3_SQL = """
WITH t AS (SELECT doc_id, source, lang, text, regexp_replace(text, '[#*$%&|<>]', '', 'g') AS s FROM documents),
c AS (""" + " UNION ALL ".join(
    f"SELECT doc_id, source, lang, '{v}' AS version, {_count_sql('text', p)} AS tokens, {_count_sql('s', p)} AS revised FROM t"
    for v, p in TOKENIZERS.items()) + """),
l AS (SELECT doc_id, max(toxic) = 1 AS toxic, min(quality) = 1 AS good FROM labels GROUP BY doc_id)
SELECT source, lang, version, count(*)::BIGINT AS docs, sum(CASE WHEN good = false THEN revised ELSE tokens END)::BIGINT AS tokens
FROM c LEFT JOIN l USING (doc_id) WHERE toxic IS NOT TRUE GROUP BY ALL"""
