"""Packing and sharding against plain versions of their rules."""
import random

import pytest
from pyspark.sql import functions as F

from docweave.llm import packing, sharding


def plain_best_fit(lengths, capacity, limit):
    """(sequence, offset) of each length: the open sequence with the least sufficient
    room, else a new one; beyond ``limit`` open ones the fullest closes. Of sequences
    with equal room that opened or filled last is taken."""
    room, out, made = [], [], 0   # [free, sequence], the one touched last at the end
    for n in lengths:
        fits = [b for b in room if b[0] >= n]
        if fits:
            least = min(b[0] for b in fits)
            b = [b for b in fits if b[0] == least][-1]
            room.remove(b)
        else:
            b, made = [capacity, made], made + 1
        out.append((b[1], capacity - b[0]))
        b[0] -= n
        if b[0]:
            if len(room) == limit:
                fullest = min(x[0] for x in room)
                room.remove([x for x in room if x[0] == fullest][-1])
            room.append(b)
    return out


@pytest.mark.parametrize("capacity, limit, seed", [(10, 2, 1), (10, 5, 2), (97, 8, 3), (4096, 64, 4), (7, 1, 5)])
def test_open_bins_equal_a_plain_best_fit(capacity, limit, seed):
    draw = random.Random(seed)
    lengths = [draw.choice([draw.randint(1, capacity), draw.randint(1, max(1, capacity // 8)), capacity]) for _ in range(3000)]
    bins = packing.OpenBins(capacity, limit, 0)
    assert [bins.place(n) for n in lengths] == plain_best_fit(lengths, capacity, limit)


def test_packed_groups_equal_a_plain_best_fit(spark):
    draw = random.Random(9)
    rows = [(i, 0, 0, draw.randint(1, 100), 0, draw.getrandbits(62)) for i in range(2000)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    got = {r.doc_id: (r.sequence_id, r.offset) for r in packing.pack(pieces, 3, 100, 4).collect()}
    want = {}
    for g in range(3):
        mine = sorted((r for r in rows if r[5] % 3 == g), key=lambda r: (r[5], r[0]))
        placed = plain_best_fit([r[3] for r in mine], 100, 4)
        want.update({r[0]: ((g << 40) + seq, at) for r, (seq, at) in zip(mine, placed, strict=True)})
    assert got == want


def _rows(draw, n, hot):
    """(position, size): a third lie in one narrow cell."""
    return [(draw.getrandbits(31) | (7 << 40) if draw.random() < hot else draw.getrandbits(62), draw.randint(1, 500)) for _ in range(n)]


@pytest.mark.parametrize("n, shards, hot", [(5000, 16, 0.0), (5000, 16, 0.35), (3000, 3, 0.9), (40, 16, 0.2), (1, 16, 0.0)])
def test_splitters_against_all_rows_sorted(spark, n, shards, hot):
    rows = _rows(random.Random(n + shards), n, hot)
    frame = spark.createDataFrame(rows, "__pos long, __size long")
    refined, cells = sharding.leaves(frame, shards)
    total = sum(s for _, s in rows)
    # leaves: a partition of the rows in the line's order, with exact counts
    starts = [c[0] for c in cells]
    assert starts == sorted(set(starts)) and sum(c[1] for c in cells) == total and sum(c[2] for c in cells) == n
    line, at = sorted(rows), 0
    for k, (start, size, count) in enumerate(cells):
        inside = line[at:at + count]
        assert sum(s for _, s in inside) == size and all(p >= start for p, _ in inside)
        assert k + 1 == len(cells) or all(p < starts[k + 1] for p, _ in inside)
        at += count
    # shards: runs of leaves; each cut is as near to its target as a leaf allows
    places = sharding.assign(cells, shards)
    assert [p[1] for p in places] == sorted(p[1] for p in places)
    slots = [0] * shards
    for (start, shard, before), cell in zip(places, cells, strict=True):
        assert before == slots[shard]
        slots[shard] += cell[2]
    below = 0
    for (start, size, _), (_, shard, _) in zip(cells, places, strict=True):
        assert shard * total <= (below + size / 2) * shards < (shard + 1) * total or shard == shards - 1
        below += size
    worst = max(s for _, s in rows) + sharding.TOLERANCE * total / shards
    below = [0] * (shards + 1)
    for (_, size, _), (_, shard, _) in zip(cells, places, strict=True):
        below[shard + 1] += size
    for k in range(1, shards):
        assert abs(sum(below[:k + 1]) - k * total / shards) <= worst


def test_slots_follow_the_line(spark):
    rows = [(i, f"text {i % 50}" * (1 + i % 7), i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, Slot long").withColumn("shard", F.lit("clash"))
    out = sharding.shard_by_bytes(frame, F.xxhash64("text"), F.octet_length("text").cast("long"), "doc_id", 4).toPandas()
    assert sorted(out.columns) == ["doc_id", "shard", "slot", "text"] and sorted(out["doc_id"]) == [r[0] for r in rows]
    for _, g in out.sort_values("slot").groupby("shard"):
        assert list(g["slot"]) == list(range(len(g)))
        # equal texts lie together: in the order of slots a text comes back only if it never left
        runs = [t for t, before in zip(g["text"], [None, *g["text"][:-1]]) if t != before]
        assert len(runs) == len(set(runs))
