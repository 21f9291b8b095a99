"""Whitening against numpy over all vectors, one by one."""

import math

import numpy as np
import pytest

from inkveil.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, weight int, size int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA).repartition(3)


def whole(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


@pytest.mark.parametrize("width", [5, 40])
def test_equals_numpy(spark, width):
    rng = np.random.default_rng(6)
    some = (rng.normal(size=(300, width)) @ rng.normal(size=(width, width))).tolist()
    rows = list(enumerate([*some, *[some[0]] * 200]))  # copies weigh as many times
    odd = [(900, None), (901, [None, *some[1][1:]]), (902, [float("nan"), *some[1][1:]])]
    odd += [(903, [float("-inf"), *some[1][1:]]), (904, [])]
    got = whitening.whitened(table(spark, [*rows, (None, some[2]), (7, some[7]), *odd])).collect()
    rows += [(None, some[2]), (7, some[7])]
    x = np.array([whole(v) for _, v in rows])
    n, k = len(x), min(width, 32)
    d = x - x.sum(axis=0) / n
    e, u = np.linalg.eigh(d.T @ d / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == n * k
    assert {(r.n, type(r.deviation)) for r in got} == {(n, int)}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    dev = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, x.sum(axis=0), strict=True)) for v in x]
    z = d @ u[:, :k] / np.sqrt(e[:k])
    own = {i: (dev[at], z[at]) for at, (i, _) in enumerate(rows)}
    signs = {}
    for r in got:
        assert r.deviation == own[r.vec_id][0]
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
        want = own[r.vec_id][1][r.component - 1]
        sign = signs.setdefault(r.component, math.copysign(1, want * r.whitened))
        assert r.whitened == pytest.approx(sign * want, abs=1e-7)


def test_without_spread(spark):
    got = whitening.whitened(table(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()
    assert {(r.vec_id, r.component) for r in got} == {(i, c) for i in (1, 2) for c in (1, 2)}
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {
        (2, 0, None, None, None)
    }


def test_fewer_vectors_than_components(spark):
    got = whitening.whitened(table(spark, [(1, [0.5, 1.0, 3.0]), (2, [0.25, 1.5, 1.0])])).collect()
    first = [r.whitened for r in got if r.component == 1]
    assert sorted(map(round, first)) == [-1, 1] and got[0].identity_error < 1e-9
    assert all(r.whitened is None for r in got if r.component > 1)
    assert sum(r.explained for r in got if r.vec_id == 1) == pytest.approx(1)


def test_lengths_on_their_own(spark):
    rows = [(1, [0.0]), (2, [1.0]), (3, [0.0, 0.0]), (4, [2.0, 0.0]), (5, [0.0, 4.0]), (6, [9.0, 1.0])]
    got = whitening.whitened(table(spark, rows)).collect()
    assert {(r.vec_id, r.n) for r in got} == {(1, 2), (2, 2), (3, 4), (4, 4), (5, 4), (6, 4)}


def test_large_numbers(spark):
    big = 3.0e15
    got = whitening.whitened(table(spark, [(1, [big]), (2, [-big]), (3, [0.0])])).collect()
    assert {r.vec_id: r.deviation is None for r in got} == {1: True, 2: True, 3: False}
    assert {r.vec_id: round(r.whitened, 3) for r in got if r.vec_id == 3} == {3: 0.0}
    small = whitening.whitened(table(spark, [(1, [1.0e6]), (2, [-1.0e6])])).collect()
    assert {r.deviation for r in small} == {(128_000_000) ** 2}


def test_no_rows(spark):
    assert whitening.whitened(table(spark, [])).collect() == []
    assert whitening.whitened(table(spark, [(1, None), (2, [])])).collect() == []
