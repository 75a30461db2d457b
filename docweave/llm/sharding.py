"""Histogram sort: documents into shards of near equal bytes.

Every row gets a position on a 62-bit line: the upper bits are a hash of the
group (equal texts lie together), the lower bits a hash of the row (so a
group that holds a third of all bytes can still be cut). The line is counted
exactly, never sampled: bytes and rows per cell of a grid, then again only
inside the cells that hold a splitter or are too heavy, a thousandfold finer,
until every splitter is within ``tolerance`` of its target. The cells of the
finest level reached everywhere are the leaves; shards are runs of leaves, and
one exchange by leaf numbers the rows of each.

Driver: per round at most a thousand counts for each refined cell, and cells
are refined only if they hold a splitter (n_shards - 1 of them) or over
1 / 256 of everything (at most 2 * 256 of them), whatever the input's size.

Defined cases: null text has size 1 and checksum 0; repeated rows get
positions of their own (a materialized row number goes into the lower bits);
an empty table gives no rows. A single row heavier than a shard stays whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.common import materialize, table, without

SHIFTS = (52, 42, 32, 22, 12, 2)  # cells per level: the line's bits above the shift
HEAVY = 256
TOLERANCE = 0.001
OUT = ("shard", "slot")


def position(group: F.Column, *row: F.Column) -> F.Column:
    """62-bit position of a row: 31 bits of its group's hash, 31 bits of its own."""
    upper = F.shiftrightunsigned(F.xxhash64(group), 33)
    lower = F.shiftrightunsigned(F.xxhash64(*row, F.monotonically_increasing_id()), 33)
    return F.shiftleft(upper, 31).bitwiseOR(lower)


def leaves(rows: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> tuple[list[set[int]], list[tuple]]:
    """Refine the counts of ``rows`` (__pos, __size). Returns the refined cells of
    each level and the leaves (start, bytes, rows) in the line's order."""
    refined: list[set[int]] = []
    found: list[tuple[int, int, int]] = []
    total = count = 0
    parents: set[int] | None = None
    settled: list[tuple[int, int, int]] = []
    for level, shift in enumerate(SHIFTS):
        part = rows if parents is None else rows.where(F.shiftright("__pos", SHIFTS[level - 1]).isin(sorted(parents)))
        cells = [(r[0] << shift, r[1], r[2]) for r in part.groupBy(F.shiftright("__pos", shift).alias("cell"))
                 .agg(F.sum("__size"), F.count(F.lit(1))).collect()]
        if parents is None:
            total, count = sum(c[1] for c in cells), sum(c[2] for c in cells)
        found = sorted(settled + cells)
        if shift == SHIFTS[-1] or not cells:
            break
        new, below = {c[0] for c in cells}, 0
        parents = set()
        for start, size, n in found:
            first, last = -(-below * n_shards // total), (below + size) * n_shards // total
            holds = any(0 < k < n_shards and below < k * total / n_shards < below + size for k in range(first, last + 1))
            if start in new and n > 1 and (size * HEAVY > total or n * HEAVY > count
                                           or holds and size * n_shards > tolerance * total):
                parents.add(start >> shift)
            below += size
        if not parents:
            break
        refined.append(parents)
        settled = [c for c in found if (c[0] >> shift) not in parents or c[0] not in new]
    return refined, found


def assign(cells: list[tuple], n_shards: int) -> list[tuple]:
    """(start, shard, rows of the shard before the leaf): every splitter goes to the
    leaf boundary nearest to its target."""
    total = sum(c[1] for c in cells)
    out, below, slots = [], 0, [0] * n_shards
    for start, size, n in cells:
        shard = min(n_shards - 1, int((2 * below + size) * n_shards // (2 * total)))  # by the leaf's middle
        out.append((start, shard, slots[shard]))
        slots[shard] += n
        below += size
    return out


def shard_by_bytes(rows: DataFrame, group: F.Column, size: F.Column, id_col: str, n_shards: int = 16,
                   tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` plus shard (int) and slot (long, gapless from 0 in each shard,
    in the order of the line). ``rows`` is written once to the shared folder."""
    spark = rows.sparkSession
    keyed = materialize(without(rows.withColumn("__pos", position(group, F.col(id_col))).withColumn("__size", size), *OUT), "shard-rows")
    refined, cells = leaves(keyed, n_shards, tolerance)
    # a row's leaf: the finest level whose parents were all refined
    depth = len(refined)
    leaf = F.shiftleft(F.shiftright("__pos", SHIFTS[depth]), SHIFTS[depth])
    for level in range(depth - 1, -1, -1):
        cell = F.shiftright("__pos", SHIFTS[level])
        leaf = F.when(cell.isin(sorted(refined[level])), leaf).otherwise(F.shiftleft(cell, SHIFTS[level]))
    places = spark.createDataFrame(assign(cells, n_shards), "__leaf long, shard int, __before long")
    inside = Window.partitionBy("__leaf").orderBy("__pos", id_col)
    return (keyed.withColumn("__leaf", leaf).withColumn("__rank", F.row_number().over(inside))
            .join(F.broadcast(places), "__leaf")
            .withColumn("slot", F.col("__before") + F.col("__rank") - 1)
            .drop("__leaf", "__rank", "__before", "__pos", "__size"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows of each task in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("__group"))
    sharded = shard_by_bytes(docs, F.col("__group"), F.col("size"), "doc_id", 16)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
