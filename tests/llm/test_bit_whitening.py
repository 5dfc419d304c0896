import math

import numpy as np
import pytest

from fieldlake.llm import bit_whitening
from helpers import read

SCHEMA = "vec_id long, embedding array<double>, label int, x string, key string, dims int, fact string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "k", 0, "f") for i, v in vectors], SCHEMA)


def floors(vectors):
    return [[math.floor(256 * c) for c in v] for v in vectors]


def brute(fit):
    """n, sums and covariance of distinct integer vectors, in exact integers until the division."""
    fit = [list(v) for v in {tuple(v) for v in fit}]
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    centred = [[n * c - s for c, s in zip(v, sums)] for v in fit]
    return n, sums, np.array([[sum(v[i] * v[j] for v in centred) / n**3 for j in range(d)] for i in range(d)])


@pytest.mark.parametrize("low, high, rows, dims", [(-5, 5, 1, 3), (0, 1, 70, 2), (-200, 200, 20_000, 7), (-(2**62), 2**62, 130, 4), (-(2**63), 2**63 - 1, 65, 3)])
def test_scatter_is_exact(low, high, rows, dims):
    x = np.random.default_rng(rows).integers(low, high, (rows, dims), dtype=np.int64, endpoint=True)
    if rows > 1:
        x[:, 1] = 9  # a dimension without planes
    whole = np.hstack([x.astype(object), np.ones((rows, 1), dtype=object)])
    assert (bit_whitening.scatter(x) == np.triu(whole.T @ whole)).all()


def check(rows, vectors):
    """Every row of `vectors` ((id, vector), sound) against the plain computation."""
    n, sums, covariance = brute(floors([v for _, v in vectors]))
    values, axes = np.linalg.eigh(covariance)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, []).append(r)
    for key, vector in vectors:
        own = sorted(by_id[key], key=lambda r: r.component)
        x = floors([vector])[0]
        assert [r.component for r in own] == list(range(1, min(4, len(x)) + 1))
        for r in own:
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums))
            e = values[-r.component]
            assert r.explained == pytest.approx(e / np.trace(covariance), rel=1e-9)
            expected = sum((c - s / n) * a for c, s, a in zip(x, sums, axes[:, -r.component])) / math.sqrt(e)
            assert abs(r.whitened) == pytest.approx(abs(expected), rel=1e-6, abs=1e-7)
            assert r.identity_error < 1e-9


def test_like_the_plain_computation(spark, small_dir):
    table = read(spark, small_dir, "embeddings")
    vectors = [(r.vec_id, r.embedding) for r in table.collect()]
    found = bit_whitening.whiten(table.union(table.where("vec_id < 40").selectExpr("vec_id + 100000", "embedding", "label")))
    rows = found.collect()
    assert len(rows) == 4 * (len(vectors) + 40)
    copies = {(r.vec_id - 100_000, r.component): r for r in rows if r.vec_id >= 100_000}
    assert all(copies[r.vec_id, r.component][2:] == r[2:] for r in rows if r.vec_id < 40)
    check([r for r in rows if r.vec_id < 100_000], vectors)
    again = bit_whitening.whiten(table.repartition(7)).collect()
    assert {(r.vec_id, r.component, r.deviation, round(abs(r.whitened), 9)) for r in again} <= {
        (r.vec_id, r.component, r.deviation, round(abs(r.whitened), 9)) for r in bit_whitening.whiten(table).collect()
    }


def test_signs_agree_between_rows(spark):
    vectors = [(k, [float(k), 0.5 * k + (k % 3)]) for k in range(20)]
    rows = [r for r in bit_whitening.whiten(frame(spark, vectors).repartition(6)).collect() if r.component == 1]
    order = [r.whitened for r in sorted(rows, key=lambda r: r.vec_id)]
    assert order == sorted(order) or order == sorted(order, reverse=True)


def test_odd_rows(spark):
    sound = [(k, [math.sin(k * 1.7), math.cos(k * k), -0.0, k / 7]) for k in range(30)]
    other = [(100 + k, [float(k % 4), float(k * k)]) for k in range(12)]
    odd = [
        (200, None), (201, [None, 1.0, 1.0, 1.0]), (202, [math.nan, 0.0, 0.0, 0.0]), (203, [math.inf, 0.0, 0.0, 0.0]),
        (204, []), (205, [1.0]), (205, [1.0]), (None, [0.0, 0.0]),
    ]
    rows = bit_whitening.whiten(frame(spark, sound + other + odd)).collect()
    assert {r.vec_id for r in rows} == {*range(30), *range(100, 112), 205, None}
    own = [r for r in rows if r.vec_id is not None and r.vec_id < 30]
    # One dimension is constant: three components have variance.
    assert all((r.whitened is None) == (r.component == 4) for r in own)
    assert all(r.explained == 0 for r in own if r.component == 4) and max(r.identity_error for r in own) < 1e-9
    check([r for r in rows if r.vec_id is None or 100 <= r.vec_id < 200], [*other, (None, [0.0, 0.0])])
    single = [r for r in rows if r.vec_id == 205]
    assert [tuple(r)[1:] for r in single] == [(1, 1, 0, None, 0.0, None)] * 2


def test_entries_beyond_a_long(spark):
    rows = bit_whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(rows) == 6 and max(r.identity_error for r in rows) < 1e-9
    ends = {1: 2**63 - 1, 2: -(2**63), 3: 0}
    for r in rows:
        assert r.deviation == (d if (d := (3 * ends[r.vec_id] + 1) ** 2 + (3 * 256 * (r.vec_id - 1) - 768) ** 2) < 10**38 else None)


def test_no_rows(spark):
    assert bit_whitening.whiten(frame(spark, [])).collect() == []
    assert bit_whitening.whiten(frame(spark, [(1, None)])).collect() == []
