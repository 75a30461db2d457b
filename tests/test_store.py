from pyspark.sql import functions as F

from docweave.operators import store


def _items(spark, n):
    return spark.createDataFrame([(f"id{i:05d}",) for i in range(n)], "id string").repartition(7)


def test_positions_dense_and_ordered(spark):
    p = store.with_positions(_items(spark, 1234), ["id"]).collect()
    pos = sorted((r.id, r.pos) for r in p)
    assert [x[1] for x in pos] == list(range(1234))
    assert all(r.n_total == 1234 for r in p)


def test_namespaces_golden_2000(spark):
    b = {r.id: r for r in store.assign_batches(_items(spark, 2000), ["id"]).collect()}
    assert b["id00000"].namespace == "namespace_0" and b["id00999"].namespace == "namespace_0"
    assert b["id01000"].namespace == "namespace_1" and b["id01999"].namespace == "namespace_1"
    assert b["id01999"].batch == 19
    # the loader's "last namespace" is the never-written namespace_2
    assert {r.last_namespace for r in b.values()} == {"namespace_2"}


def test_namespaces_when_sizes_do_not_divide(spark):
    b = {r.pos: r for r in store.assign_batches(_items(spark, 25), ["id"], batch_size=10,
                                                   namespace_size=15).collect()}
    # flushes at 9, 19, 24 -> namespaces 0, 1, 1
    assert [b[i].namespace for i in (0, 9, 10, 19, 20, 24)] == [
        "namespace_0", "namespace_0", "namespace_1", "namespace_1", "namespace_1", "namespace_1"]


def test_assign_ids(spark):
    df = spark.createDataFrame([("a", 0), (None, 1)], "id string, pos long")
    assert [r.id for r in store.assign_ids(df, "id").orderBy("pos").collect()] == ["a", "auto_id_1"]


def test_upsert_last_write_wins_and_idempotent(spark):
    old = spark.createDataFrame([("ns0", "a", [1.0], 1), ("ns0", "b", [2.0], 1)],
                                "namespace string, id string, values array<double>, seq int")
    new = spark.createDataFrame([("ns0", "a", [9.0], 2), ("ns1", "a", [7.0], 2)],
                                "namespace string, id string, values array<double>, seq int")
    once = store.upsert(old, new)
    twice = store.upsert(once, new)
    rows = {(r.namespace, r.id): r["values"] for r in once.collect()}
    assert rows == {("ns0", "a"): [9.0], ("ns0", "b"): [2.0], ("ns1", "a"): [7.0]}
    assert sorted(once.collect()) == sorted(twice.collect())


def test_verify_each_id_in_its_namespace(spark):
    exp = store.assign_batches(_items(spark, 30), ["id"], batch_size=5, namespace_size=10)
    stored = exp.filter(F.col("namespace") != "namespace_1").select("namespace", "id")
    missing, summary = store.verify(stored, exp)
    assert missing.count() == 10
    s = summary.first()
    assert (s.verified, s.failed, s.total) == (20, 10, 30)
    assert s.verified_in_last_namespace == 0   # namespace_3 was never written


def test_write_store_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "store")
    a = spark.createDataFrame([("namespace_0", "a", 1), ("namespace_1", "b", 1)], "namespace string, id string, seq int")
    store.write_store(a, path)
    b = spark.createDataFrame([("namespace_1", "c", 2)], "namespace string, id string, seq int")
    store.write_store(b, path)
    got = sorted((r.namespace, r.id) for r in spark.read.parquet(path).collect())
    assert got == [("namespace_0", "a"), ("namespace_1", "c")]
    idx = store.index_stats(spark.read.parquet(path).withColumn("values", F.array(F.lit(1.0))), capacity=100).first()
    assert idx.total_vector_count == 2 and idx.fullness_text == "2.00%"


def test_merge_touched_rewrites_only_touched_namespaces(spark, tmp_path):
    path = str(tmp_path / "s")
    old = spark.createDataFrame([("ns0", "a", 1, 1), ("ns1", "b", 1, 1), ("ns1", "c", 1, 1)],
                                "namespace string, id string, v int, seq int")
    store.write_store(old, path)
    inc = spark.createDataFrame([("ns1", "b", 5, 2), ("ns1", "b", 6, 3), ("ns1", "d", 7, 2)],
                                "namespace string, id string, v int, seq int")
    existing = spark.read.parquet(path).select("namespace", "id", "v", "seq")
    merged = store.merge_touched(existing, inc)
    out_path = str(tmp_path / "s2")
    store.write_store(store.upsert(existing, inc), out_path)
    got = sorted((r.namespace, r.id, r.v) for r in spark.read.parquet(out_path).collect())
    assert got == [("ns0", "a", 1), ("ns1", "b", 6), ("ns1", "c", 1), ("ns1", "d", 7)]
    assert sorted(r.namespace for r in merged.select("namespace").distinct().collect()) == ["ns1"]


def test_resent_ids_keep_their_namespace(spark, tmp_path):
    old = spark.createDataFrame([("namespace_7", "b", [1.0, 1.0], 1)],
                                "namespace string, id string, values array<float>, seq int")
    run = spark.createDataFrame([("a", [3.0]), ("b", [2.0])], "id string, values array<float>")
    placed = store.fit_store_dimension(store.place_incoming(old, run), 2).withColumn("seq", F.lit(2))
    path = str(tmp_path / "s")
    store.write_store(old, path)
    got = store.upsert_table(spark, path, placed.select("namespace", "id", "values", "seq"))
    assert {(r.namespace, r.id): (r["values"], r.seq) for r in got.collect()} == {
        ("namespace_7", "b"): ([2.0, 0.0], 2), ("namespace_0", "a"): ([3.0, 0.0], 2)}


def test_one_file_per_namespace_and_a_pruned_read(spark, tmp_path):
    path = str(tmp_path / "s")
    store.write_store(store.assign_batches(_items(spark, 2500), ["id"]).select("namespace", "id"), path)
    for n in ("namespace_0", "namespace_1", "namespace_2"):
        assert len(list((tmp_path / "s" / f"namespace={n}").glob("*.parquet"))) == 1
    one = spark.read.parquet(path).filter(F.col("namespace") == "namespace_1")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(namespace" in plan


def test_a_run_is_embedded_once(spark, tmp_path):
    """What is merged comes from written vectors, not from the texts again for each reading."""
    from docweave.plans import q_store
    from docweave.plans.registry import Tables
    docs = [(i, f"word{i} and some other words of a text", "en", "s", 10) for i in range(30)] + [(3, "again", "en", None, 5), (40, None, None, None, 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, [float(i)] * 64, 0) for i in range(20)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    t = Tables(spark, str(tmp_path))
    existing, incoming = q_store._existing_and_incoming(t)
    assert not [f for df in (incoming, q_store._merged(t)) for f in df.inputFiles() if "documents.parquet" in f]
    assert incoming.count() == existing.count() + q_store.chunk_vectors(t).count()
