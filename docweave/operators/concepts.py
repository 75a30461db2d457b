"""Names in texts: leftmost-longest matches of a dictionary of names of any
number of words.

Texts are dealt out first, as a table stored as one row group is read by one task.
Every text is cut into windows as long as the longest name, in its own row; only windows
whose first token begins some name go on (a join with the names' first tokens, written
first, so that Spark knows their size and broadcasts them when they are few). A bit set of
the first tokens' hashes (``FILTER_BITS``, whatever their number) keeps most others from
being cut at all. Windows and names are then dealt by first
token and a salt of the text - names are copied to every salt - and sorted, names
first. A task streams through that: it builds the trie of one first token's
names, walks it for each window that follows, and lets it go at the next token.
So it holds the names of one first token and one Arrow batch, however frequent
the token is, and the work per window is its longest match, however many names
begin alike. Overlaps are resolved per text from its few matches.

Null texts and names, and those without a token, match nothing; a name that is
there twice counts once; of matches that begin together the longest stays, of
overlapping ones the leftmost; rows that repeat a text_id are one text's matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.session import scratch_path, ship_package

SALTS = 16
FILTER_BITS = 1 << 16


def name_words(names: DataFrame, name_col: str = "name") -> DataFrame:
    """Distinct (words): the names' token arrays."""
    return names.select(tx.tokenize(tx.clean_text(name_col)).alias("words")).where(F.size("words") > 0).distinct()


def trie_of(names: list[list[str]]) -> dict:
    """Nested dicts by word; the key "" marks the end of a name."""
    root: dict = {}
    for words in names:
        node = root
        for w in words:
            node = node.setdefault(w, {})
        node[""] = True
    return root


def longest(trie: dict, window: list[str]) -> int:
    """Number of words of the longest name at the start of the window, 0 if none."""
    node, best = trie, 0
    for k, w in enumerate(window, 1):
        node = node.get(w)
        if node is None:
            break
        if "" in node:
            best = k
    return best


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (first, salt, kind): names (kind 0), then windows (kind 1)."""
    token, trie, building = None, {}, []
    for b in batches:
        ids, starts, sizes, names = [], [], [], []
        for first, salt, kind, text_id, start, words in zip(*(b.column(c).to_pylist() for c in ("first", "salt", "kind", "text_id", "start", "words")), strict=True):
            if (first, salt) != token:
                token, trie, building = (first, salt), {}, []
            if kind == 0:
                building.append(words)
                continue
            if building:
                trie, building = trie_of(building), []
            n = longest(trie, words)
            if n:
                ids.append(text_id)
                starts.append(start)
                sizes.append(n)
                names.append(" ".join(words[:n]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(names, pa.string())], names=["text_id", "start", "n_words", "name"])


def _maybe_first(firsts: DataFrame):
    """Column -> Column: false only for tokens that are none of ``firsts``. Of the tokens
    their hashes come to the driver, FILTER_BITS numbers at most."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    held = [0] * (FILTER_BITS // 64)
    for r in firsts.select(slot("first").alias("s")).distinct().collect():
        held[r.s // 64] |= 1 << (r.s % 64)
    bits = F.array(*[F.lit(w - (1 << 64) if w >> 63 else w).cast("long") for w in held])
    return lambda c: F.getbit(F.get(bits, (slot(c) / 64).cast("int")), (slot(c) % 64).cast("int")) == 1


def name_spans(texts: DataFrame, names: DataFrame, text_col: str = "text", name_col: str = "name") -> DataFrame:
    """(text_id, start, name): token position (from 0) and words of every match."""
    spark = texts.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "names")
    name_words(names, name_col).write.parquet(path)
    words = spark.read.parquet(path)
    most = words.agg(F.max(F.size("words"))).first()[0]
    if most is None:
        return spark.createDataFrame([], "text_id string, start int, name string")
    firsts = scratch_path(spark, "name-firsts")
    words.select(F.get("words", F.lit(0)).alias("first")).distinct().write.parquet(firsts)
    # through a generator of one row: tokens are made once, not once per window
    dealt_texts = texts.select(F.col("text_id").cast("string").alias("text_id"), F.col(text_col).alias("_text")).repartition("text_id", "_text")
    tok = dealt_texts.select("text_id", F.explode(F.array(tx.tokenize(tx.clean_text("_text")))).alias("tok"))
    # single elements are read in place; slice() would unpack the whole array for each window
    cut = (lambda i: F.array_compact(F.array(*[F.get("tok", i + k) for k in range(most)]))) if most <= 32 else (lambda i: F.slice("tok", i + 1, most))
    maybe = _maybe_first(spark.read.parquet(firsts))
    windows = F.filter(F.transform("tok", lambda w, i: F.when(maybe(w), F.struct(w.alias("first"), i.alias("start"), cut(i).alias("words")))), lambda w: w.isNotNull())
    found = (tok.select("text_id", F.explode(windows).alias("w")).select("text_id", "w.*")
             .join(spark.read.parquet(firsts), "first", "left_semi")
             .select("first", F.pmod(F.xxhash64("text_id", "start"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(1).alias("kind"), "text_id", "start", "words"))
    held = words.select(F.get("words", F.lit(0)).alias("first"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                        F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text_id"), F.lit(None).cast("int").alias("start"), "words")
    dealt = held.unionByName(found).repartition("first", "salt").sortWithinPartitions("first", "salt", "kind")
    hits = dealt.mapInArrow(_walk, "text_id string, start int, n_words int, name string")
    return _leftmost(hits).select("text_id", "m.start", "m.name")


def _leftmost(hits: DataFrame) -> DataFrame:
    """(text_id, m): a text's matches in order, each starting where the last one ended or later."""
    kind = "array<struct<start:int,n_words:int,name:string>>"
    step = lambda kept, m: F.when(
        (F.size(kept) == 0) | (m["start"] >= F.element_at(kept, -1)["start"] + F.element_at(kept, -1)["n_words"]), F.concat(kept, F.array(m))).otherwise(kept)
    ordered = F.array_sort(F.collect_set(F.struct("start", "n_words", "name")))
    return hits.groupBy("text_id").agg(ordered.alias("all")).select("text_id", F.explode(F.aggregate("all", F.array().cast(kind), step)).alias("m"))
