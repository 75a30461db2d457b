"""Vector codes against exhaustive search in plain integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import codebooks


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) rows and the digest, by trying every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    dim = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts)) * parts
    wide = dim // parts
    whole = [[max(-codebooks.LIMIT, min(codebooks.LIMIT, math.floor(256 * float(np.float32(x))))) for x in r[1]] + [0] * (dim - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, [float(np.float32(x)) for x in kept[i][1]]))
    books = [[whole[i][p * wide:(p + 1) * wide] for i in order[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in whole:
            mine = []
            for p in range(parts):
                x = v[p * wide:(p + 1) * wide]
                mine.append(min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])))
            out.append(mine)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [v[p * wide:(p + 1) * wide] for v, f in zip(whole, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    label = {}
    for r, e in zip(kept, errors):
        label[r[2]] = label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), e, label[r[2]]) for r, f, e in zip(kept, found, errors)), key=str), digest


def run(spark, tmp_path, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    if extra:
        df = df.withColumn("code", F.lit("x")).withColumn("Error", F.lit(1)).withColumn("q", F.lit(2)).withColumn("v", F.lit(3))
    df.write.mode("overwrite").parquet(str(tmp_path / "embeddings.parquet"))
    got = codebooks.op11_vector_codes(spark, str(tmp_path)).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str), {r.codebooks_sha256 for r in got}


@pytest.mark.parametrize("case", ["plain", "ties", "few", "odd"])
def test_codes_equal_exhaustive_search(spark, tmp_path, case):
    rng = np.random.default_rng(5)
    if case == "plain":
        rows = [(int(i), rng.normal(0, 0.3, 64).tolist(), int(i % 3)) for i in rng.permutation(150)]
    elif case == "ties":  # few values, many equal parts, a third of the rows one vector and one label
        rows = [(i, rng.integers(-2, 3, 32).astype(float).tolist(), i % 4 or None) for i in range(90)] + [(200 + i, [0.5] * 32, None) for i in range(45)]
        rows += [rows[3], rows[3], (7, [1.0] * 32, 9)]
    elif case == "few":
        rows = [(i, rng.normal(0, 1, 16).tolist(), None) for i in range(5)]
    else:  # dropped rows, other lengths, no id, huge components
        rows = [(1, None, 1), (2, [1.0, None] * 8, 1), (3, [float("nan")] * 16, 1), (4, [float("inf")] * 16, 2), (5, [], 2), (6, [1.0, -2.0, 0.001], None),
                (None, [3.0] * 20, 4), (8, [1e30, -1e30] + [0.25] * 18, 4), (9, [-0.0] * 16, None)]
    want, digest = plain_codes(rows)
    got, digests = run(spark, tmp_path, rows, extra=case == "odd")
    assert got == want and digests == {digest}


def test_no_rows(spark, tmp_path):
    assert run(spark, tmp_path, []) == ([], set())
    assert run(spark, tmp_path, [(1, None, 1), (2, [float("nan")], 1)]) == ([], set())


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(2)
    x, entries = rng.integers(-300, 300, (5000, 4)), rng.integers(-300, 300, (64, 4))
    entries[40] = entries[3]  # a tie goes to the lower index
    pivots = entries[codebooks.choose_pivots(entries, 4)]
    near = np.sqrt(codebooks.squares(x, pivots)).astype(np.float32)
    index, dist, evaluated = codebooks.nearest(x, near, entries, pivots)
    want = codebooks.squares(x, entries)
    assert (index == want.argmin(1)).all() and (dist == want.min(1)).all()
    assert evaluated < 0.3 * want.size
    with pytest.raises(ValueError):
        codebooks.fit_codebooks(None, entries=300)
