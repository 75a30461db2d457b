"""The versioned store: what readers see, whatever happens to a write."""

import pytest

from docweave.operators import versions as V

SCHEMA = "namespace string, id string, values array<float>, seq long"


def rows(spark, *items):
    return spark.createDataFrame([(n, i, [float(s)], s) for n, i, s in items], SCHEMA)


def seen(spark, path, version=None, namespace=None):
    return sorted((r.namespace, r.id, r.seq) for r in V.read(spark, path, version, namespace).collect())


def test_versions_stay_and_namespaces_are_replaced(spark, tmp_path):
    path = str(tmp_path / "store")
    assert V.current_version(spark, path) == 0
    with pytest.raises(ValueError):
        V.read(spark, path)
    assert V.upsert(spark, path, rows(spark, ("5", "a", 1), ("5", "b", 1), ("05", "a", 1), ("5", "a", 3))) == 1
    assert V.upsert(spark, path, rows(spark, ("5", "b", 2), ("5", "b", 4), ("new", "z", 1))) == 2
    first = [("05", "a", 1), ("5", "a", 3), ("5", "b", 1)]
    second = [("05", "a", 1), ("5", "a", 3), ("5", "b", 4), ("new", "z", 1)]
    assert seen(spark, path, 1) == first and seen(spark, path) == second
    assert seen(spark, path, namespace="5") == second[1:3] and seen(spark, path, namespace="none") == []
    assert len({r.commit for r in V.manifest(spark, path).collect()}) == 2
    assert V.compact(spark, path) == 3 and seen(spark, path) == second and seen(spark, path, 1) == first
    assert len({r.commit for r in V.manifest(spark, path).collect()}) == 1
    with pytest.raises(ValueError):
        V.read(spark, path, 9)


@pytest.mark.parametrize("step", ["_publish", "manifest"])
def test_a_write_that_ends_half_way_changes_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "store")
    V.upsert(spark, path, rows(spark, ("n", "a", 1), ("m", "b", 1)))
    before = seen(spark, path)
    merged = rows(spark, ("n", "a", 2), ("n", "c", 2))
    with monkeypatch.context() as m:
        def killed(*a, **k):
            raise OSError("killed")
        m.setattr(V, step, killed)
        with pytest.raises(OSError):
            V.commit(spark, path, merged, 1)
    assert V.current_version(spark, path) == 1 and seen(spark, path) == before
    assert V.upsert(spark, path, merged) == 2
    assert seen(spark, path) == [("m", "b", 1), ("n", "a", 2), ("n", "c", 2)] and seen(spark, path, 1) == before


def test_the_second_writer_of_a_version_is_told(spark, tmp_path):
    path = str(tmp_path / "store")
    V.upsert(spark, path, rows(spark, ("n", "a", 1)))
    V.commit(spark, path, rows(spark, ("n", "a", 2)), 1)
    with pytest.raises(V.Conflict):
        V.commit(spark, path, rows(spark, ("n", "a", 3)), 1)
    with pytest.raises(V.Conflict):  # it looked before the other one had published
        V._publish(spark, path, 2, "d")
    assert seen(spark, path) == [("n", "a", 2)]
