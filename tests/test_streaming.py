import pytest

from docweave.operators import ingest
from docweave.plans.registry import queries
from docweave.session import load_table
from docweave.streaming import ingest as SI
from tests.conftest import SF_SMALL


def test_stream_ingest_equals_batch(spark, tmp_path):
    docs = load_table(spark, SF_SMALL, "documents")
    out = SI.stream_ingest(spark, SF_SMALL, docs.schema, str(tmp_path / "sink"), str(tmp_path / "ckpt"),
                           file_glob="documents.parquet")
    batch = ingest.ingest_chunks(docs, 200)
    key = ["doc_id", "chunk_id", "chunk_text"]
    assert sorted(out.select(*key).collect()) == sorted(batch.select(*key).collect())
    # a second run over the same checkpoint finds nothing new: output unchanged
    again = SI.stream_ingest(spark, SF_SMALL, docs.schema, str(tmp_path / "sink"), str(tmp_path / "ckpt"),
                             file_glob="documents.parquet")
    assert again.count() == out.count()


def test_stream_ingest_replaces_a_document_delivered_again(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "doc_id long, text string"

    def deliver(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)
        return SI.stream_ingest(spark, src, schema, str(tmp_path / "sink"), str(tmp_path / "ckpt"))

    deliver((1, "alpha beta"), (2, "gamma"), (3, "delta"), (None, "unnamed"))
    out = deliver((1, "omega"), (2, ""), (1, "omega"))
    assert sorted(((r.doc_id, r.chunk_id, r.chunk_text) for r in out.collect()), key=str) == [(1, 0, "omega"), (3, 0, "delta"), (None, 0, "unnamed")]


def test_stream_dedup_does_not_depend_on_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    ev = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-03-01"), (2, "2019-01-01"), (2, "2020-02-01")],
                               "k int, ts string").selectExpr("k", "timestamp(ts) AS ts")
    ev.repartition(4).write.parquet(src)
    for n in (1, 100):
        out = SI.stream_dedup(spark, src, ev.schema, ["k"], "ts", None, str(tmp_path / f"sink{n}"),
                              str(tmp_path / f"ckpt{n}"), max_files_per_trigger=n)
        assert sorted(r.k for r in out.collect()) == [1, 2]


def test_stream_dedup_one_row_per_key(spark, tmp_path):
    ev = load_table(spark, SF_SMALL, "events")
    out = SI.stream_dedup(spark, SF_SMALL, ev.schema, ["user_id", "event_type"], "ts", "10 minutes",
                          str(tmp_path / "sink"), str(tmp_path / "ckpt"), file_glob="events.parquet")
    assert out.count() == ev.select("user_id", "event_type").distinct().count()


@pytest.mark.parametrize("query, table", [("stream_ingest", "documents"), ("stream_dedup", "events")])
def test_registered_streams_read_tables_of_part_files(spark, tmp_path, query, table):
    whole = load_table(spark, SF_SMALL, table)
    whole.repartition(4).write.parquet(str(tmp_path / f"{table}.parquet"))
    run = queries()[query]
    want = sorted(map(str, run(spark, SF_SMALL).collect()))
    assert want and sorted(map(str, run(spark, str(tmp_path)).collect())) == want


def test_documents_without_an_id_are_kept(spark, tmp_path):
    from docweave.streaming import ingest as SI
    rows = [(1, "alpha beta"), (None, "gamma"), (None, "delta"), (1, "alpha beta"), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    run = lambda: sorted((r.doc_id or 0, r.chunk_text) for r in SI.stream_ingest(
        spark, str(tmp_path / "in"), df.schema, str(tmp_path / "sink"), str(tmp_path / "ck")).collect())
    assert run() == [(0, "delta"), (0, "gamma"), (1, "alpha beta")]
    df.filter("doc_id IS NULL").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == [(0, "delta"), (0, "delta"), (0, "gamma"), (0, "gamma"), (1, "alpha beta")]
