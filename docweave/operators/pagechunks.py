"""Token chunks of documents that arrive as pages, without gluing a document.

The chunks equal those of the glued text (``ingest.assemble_documents`` with no
separator, then ``ingest.ingest_chunks``), but no row holds more than a page, a word
over a page break or a chunk:

1. Each page is cleaned for itself and cut at its first and last blank: the words
   between lie wholly on it, the two rests belong to words that a page break cuts. A
   page without a blank is one rest. This is written once.
2. Numbering the pages with a blank tells which rests make one word; rests are glued
   per word. Only rests are shuffled for this.
3. The pages' own words and the glued ones are units of tokens in order; running sums of
   their lengths place every token, and each unit sends a slice to each chunk it reaches.

Running sums are taken in two levels (within blocks of pages, over the blocks of a
document), so a document with a third of all pages is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.session import scratch_path

_BLOCK = 1024


def _running(df: DataFrame, id_col: str, order: list[str], value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same id that come before in
    ``order``, which begins with the page number. Null ids are one id."""
    # a struct is never null and equals another with the same nulls, so one exchange
    # serves the window and the join
    d = df.withColumn("_k", F.struct(F.col(id_col).alias("id"), F.floor(F.col("page_no") / _BLOCK).alias("block")))
    over = Window.partitionBy("_k.id").orderBy("_k.block").rowsBetween(Window.unboundedPreceding, -1)
    base = d.groupBy("_k").agg(F.sum(value).alias("_sum")).select("_k", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = d.withColumn("_in", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inner.join(base, "_k").withColumn(out, F.col("_base") + F.col("_in")).drop("_k", "_base", "_in")


def _tokens(col, stop_words: bool):
    found = tx.tokenize(F.lower(col))
    return tx.remove_stopwords(found) if stop_words else found


def _cut_pages(pages: DataFrame, id_col: str, stop_words: bool) -> DataFrame:
    """Per page that is not empty: blank (1 if it has one), head and tail (the rests; the
    whole page is the head without a blank), words (those between) and n of them."""
    flat = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), f"[^{tx.KEEP_CLASS}]", ""), f"[{tx.WS_CLASS}]+", " ")
    p = pages.select(id_col, "page_no", flat.alias("t")).where(F.col("t") != "")
    p = p.withColumn("_first", F.instr("t", " ")).withColumn("blank", (F.col("_first") > 0).cast("long"))
    p = p.withColumn("head", F.substring_index("t", " ", 1)).withColumn(
        "tail", F.when(F.col("blank") == 1, F.substring_index("t", " ", -1)).otherwise(F.lit("")))
    between = F.expr("substring(t, _first + 1, length(t) - _first - length(tail))")
    own = F.when(F.col("blank") == 1, _tokens(between, stop_words)).otherwise(F.array().cast("array<string>"))
    return p.withColumn("_own", own).select(id_col, "page_no", "blank", "head", "tail", F.array_join("_own", " ").alias("words"),
                                            F.size("_own").cast("long").alias("n"))


def _broken_words(cut: DataFrame, id_col: str, stop_words: bool) -> DataFrame:
    """(id, page_no, part, words, n) of the words that rests make up, placed by their
    first rest: before a page's own words (part 0) or after them (part 2)."""
    p = _running(cut.select(id_col, "page_no", "blank", "head", "tail"), id_col, ["page_no"], "blank", "k")
    before = F.lag("page_no").over(Window.partitionBy(id_col, F.floor(F.col("page_no") / _BLOCK)).orderBy("page_no"))
    p = p.withColumn("page_no", F.when(before == F.col("page_no"), F.raise_error(F.lit("a document has two pages of one number")))
                     .otherwise(F.col("page_no")))

    def rest(word, order, part, text):
        return F.struct(word.cast("long").alias("word"), order.alias("order"), F.lit(part).alias("part"), text.alias("text"))

    # a word: the tail of a page, whole pages, the head of a page
    rests = F.array(rest(F.col("k"), F.col("blank") + 1, 0, F.col("head")), rest(F.col("k") + 1, F.lit(0).cast("long"), 2, F.col("tail")))
    rests = p.select(id_col, "page_no", F.explode(rests).alias("r")).where(F.col("r.text") != "")
    ordered = F.array_sort(F.collect_list(F.struct("r.order", "page_no", "r.text")))
    place = F.min(F.struct("page_no", "r.part"))
    words = (rests.groupBy(id_col, F.col("r.word").alias("word"))
             .agg(F.array_join(F.transform(ordered, lambda s: s["text"]), "").alias("w"), place.alias("place"))
             .withColumn("_own", _tokens(F.col("w"), stop_words)).where(F.size("_own") > 0))
    return words.select(id_col, "place.page_no", "place.part", F.array_join("_own", " ").alias("words"), F.size("_own").cast("long").alias("n"))


def chunk_pages(pages: DataFrame, size: int = 200, id_col: str = "doc_id", stop_words: bool = True) -> DataFrame:
    """pages(id, page_no, text) -> (id, chunk_id, chunk_text): chunks of ``size`` tokens of
    each document's glued pages; a document without tokens has none. Pages are ordered
    by number; two pages of one number in a document are an error (empty ones do not
    count). A null text is an empty page. Other columns of ``pages`` are not kept."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    spark = pages.sparkSession
    path = scratch_path(spark, "pages")
    cut = _cut_pages(pages, id_col, stop_words)
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    broken = _broken_words(cut, id_col, stop_words).checkpoint(eager=True)
    units = cut.where("n > 0").select(id_col, "page_no", F.lit(1).alias("part"), "words", "n").unionByName(broken)
    placed = _running(units, id_col, ["page_no", "part"], "n", "at")
    lo, hi = F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("n") - 1) / size)

    def part(chunk):   # a page's tokens stay in their row; only the slices leave it
        begin = F.greatest(chunk * size - F.col("at"), F.lit(0))
        end = F.least((chunk + 1) * size - F.col("at"), F.col("n"))
        return F.struct(chunk.cast("int").alias("chunk_id"),
                        F.array_join(F.slice("tokens", (begin + 1).cast("int"), (end - begin).cast("int")), " ").alias("part"))

    slices = (placed.withColumn("tokens", F.split("words", " ")).select(id_col, "at", F.explode(F.transform(F.sequence(lo, hi), part)).alias("s"))
              .select(id_col, "s.chunk_id", "at", "s.part"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "part")))
    return slices.groupBy(id_col, "chunk_id").agg(
        F.array_join(F.transform(ordered, lambda s: s["part"]), " ").alias("chunk_text"))
