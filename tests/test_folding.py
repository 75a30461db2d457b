"""Streamed sinks: old batches folded into a store, windows of event time."""
import os
import random
from datetime import datetime, timedelta

import pytest

from docweave.operators import versions
from docweave.streaming import folding
from docweave.streaming import ingest as SI

SCHEMA = "doc_id long, text string"


def _shown(out):
    return sorted(((r.doc_id, r.chunk_id, r.chunk_text) for r in out.collect()), key=str)


def _deliver(spark, where, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(where)


def test_folded_batches_give_the_same_documents(spark, tmp_path):
    src, sink, ck = (str(tmp_path / n) for n in ("in", "sink", "ck"))
    draw, want, unnamed = random.Random(5), {}, []
    for n in range(7):
        rows = [(draw.randrange(6), draw.choice(["", "alpha", "beta gamma", "delta"])) for _ in range(1)] + [(None, f"loose{n}")]
        _deliver(spark, src, rows)
        want.update(rows[:1])
        unnamed.append((None, 0, f"loose{n}"))
        out = SI.stream_ingest(spark, src, SCHEMA, sink, ck, fold_after=2)
        expected = sorted([(d, 0, t) for d, t in want.items() if t] + unnamed, key=str)
        assert _shown(out) == expected
        assert sum(f.startswith("batch_id=") for f in os.listdir(sink)) <= 5   # two generations and the new one
    assert folding.folded_up_to(spark, sink) == 5
    # folding all that waits, and folding again, change nothing
    assert folding.fold(spark, sink, 6) == 1 and folding.fold(spark, sink, 6) == 0
    assert _shown(folding.read(spark, sink)) == expected


def test_a_fold_that_ends_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    src, sink, ck = (str(tmp_path / n) for n in ("in", "sink", "ck"))
    for rows in ([(1, "alpha"), (2, "beta")], [(1, "gamma")], [(3, "delta"), (2, "")]):
        _deliver(spark, src, rows)
        out = SI.stream_ingest(spark, src, SCHEMA, sink, ck)
    before = _shown(out)
    assert before == [(1, 0, "gamma"), (3, 0, "delta")]

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(versions, "_publish", killed)
    with pytest.raises(RuntimeError, match="killed"):
        folding.fold(spark, sink, 1)
    monkeypatch.undo()
    assert folding.folded_up_to(spark, sink) == -1 and _shown(folding.read(spark, sink)) == before
    assert folding.fold(spark, sink, 1) == 2 and folding.fold(spark, sink, 2) == 1
    assert _shown(folding.read(spark, sink)) == before


def test_an_old_sink_refuses_a_new_checkpoint(spark, tmp_path):
    src, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    _deliver(spark, src, [(1, "alpha")])
    SI.stream_ingest(spark, src, SCHEMA, sink, str(tmp_path / "ck1"))
    folding.fold(spark, sink, 0)
    with pytest.raises(Exception, match="a new checkpoint needs a new sink"):
        SI.stream_ingest(spark, src, SCHEMA, sink, str(tmp_path / "ck2"))


def test_windows_do_not_depend_on_batches_or_lateness(spark, tmp_path):
    draw, start = random.Random(3), datetime(2024, 1, 1)
    rows = [(draw.choice([None, "a", "b"]), start + timedelta(minutes=draw.randrange(6000))) for _ in range(120)]
    rows += [("a", None), (None, None), ("a", None)] + rows[:10]
    draw.shuffle(rows)   # hours and days come in any order
    src = str(tmp_path / "in")
    for lo in range(0, len(rows), 45):
        spark.createDataFrame(rows[lo:lo + 45], "k string, ts timestamp").coalesce(1).write.mode("append").parquet(src)
    want = {}
    for k, ts in rows:
        hour = ts and ts.replace(minute=0)
        lo, hi = want.get((k, hour), (ts, ts))
        want[k, hour] = (min(lo, ts), max(hi, ts)) if ts else (None, None)
    for n in (1, 100):
        out = SI.stream_windows(spark, src, "k string, ts timestamp", ["k"], "ts", "1 hour", str(tmp_path / f"w{n}"),
                                str(tmp_path / f"ck{n}"), max_files_per_trigger=n)
        got = {(r.k, r.window_start): (r.first_ts, r.last_ts) for r in out.collect()}
        assert got == want and out.count() == len(want)


def test_windows_of_an_empty_stream(spark, tmp_path):
    spark.createDataFrame([], "k string, ts timestamp").write.parquet(str(tmp_path / "in"))
    out = SI.stream_windows(spark, str(tmp_path / "in"), "k string, ts timestamp", ["k"], "ts", "1 hour",
                            str(tmp_path / "w"), str(tmp_path / "ck"))
    assert out.columns == ["k", "window_start", "first_ts", "last_ts"] and out.count() == 0
