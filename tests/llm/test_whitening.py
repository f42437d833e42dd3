"""Whitening against numpy's own eigenvectors, sums in whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from loantape.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int, component string"


def plain(rows, most=16):
    grid = {}
    for i, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not v:
            continue
        grid.setdefault(len(v), []).append((i, tuple(math.floor(64 * x) + 1_000_000 for x in v)))
    out = {}
    for dims, held in grid.items():
        fit = sorted({x for _, x in held})
        n = len(fit)
        sums = [sum(c) for c in zip(*fit)]
        y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
        values, vectors = np.linalg.eigh(y.T @ y / n)
        order = np.argsort(-values)[:most]
        trace = float(values.sum())
        for i, x in held:
            d = [n * c - s for c, s in zip(x, sums)]
            made = (np.array(d) / n) @ vectors[:, order]
            ok = values[order] > 1e-12 * max(trace, 1e-300)
            out[i] = n, sum(c * c for c in d), made[ok] / np.sqrt(values[order][ok]), values[order][ok] / trace if trace else values[order][ok]
    return out


def check(spark, rows, most=16, near=1e-7):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = {}
    errors = set()
    for x in whitening.whiten(table, components=most).collect():
        got.setdefault(x.vec_id, {})[x.component] = x
        errors.add(x.identity_error)
    want = plain(rows, most)
    assert set(got) == {i for i, w in want.items() if len(w[2])}
    signs = {}
    for i, parts in got.items():
        n, far, made, share = want[i]
        assert sorted(parts) == list(range(1, len(made) + 1))
        for c, x in parts.items():
            assert (x.n, x.deviation) == (n, far)
            assert abs(x.explained - share[c - 1]) <= 1e-9 * share[c - 1]
            assert abs(abs(x.whitened) - abs(made[c - 1])) <= near
            if abs(made[c - 1]) > 1e-3:
                signs.setdefault((n, c), set()).add(x.whitened * made[c - 1] > 0)
    assert all(len(s) == 1 for s in signs.values())
    assert len(errors) <= 1 and all(e <= 1e-7 for e in errors)
    return want


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(6)
    turn = r.normal(size=(24, 24)) * (0.8 ** np.arange(24))[:, None]
    return [(i, (r.normal(size=24) @ turn).tolist()) for i in range(400)]


def test_components(spark, rows):
    check(spark, rows)
    check(spark, rows, most=3)
    check(spark, rows, most=100)


def test_repeats_count_once(spark, rows):
    check(spark, rows + [(1000 + i, rows[7][1]) for i in range(300)] + [(2000, [x + 1e-9 for x in rows[8][1]])])


def test_rows_that_go_and_other_lengths(spark, rows):
    nan, inf = float("nan"), float("inf")
    odd = [(500, None), (501, [nan] * 24), (502, [None] + [1.0] * 23), (503, [inf] * 24), (504, []), (505, [1.0, 2.0]), (506, [3.0, 1.0]), (507, [2.0, -4.0]), (508, [0.5])]
    want = check(spark, rows + odd)
    assert {505, 506, 507, 508} < set(want) and 500 not in want
    beyond = spark.createDataFrame([(1, [1e30, 1.0], 1, "x"), (2, [1.0, 2.0], 1, "x"), (3, [5.0, 1.0], 1, "x"), (None, [1e6, -7.0], 1, "x")], SCHEMA)
    got = whitening.whiten(beyond).collect()
    assert {x.vec_id for x in got} == {2, 3, None} and len(got) == 6


def test_wide_numbers_are_exact(spark):
    r = np.random.default_rng(9)
    rows = [(i, (r.integers(-(2**40), 2**40, 3) / 64.0).tolist()) for i in range(40)]
    table = spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA)
    got = whitening.whiten(table).collect()
    fit = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*fit)]
    for x in got:
        d = sum((40 * c - s) ** 2 for c, s in zip(fit[x.vec_id], sums))
        assert x.deviation == (d if d < 2**63 else None)


def test_few_and_equal(spark, rows):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1, "") for i in range(9)], SCHEMA)).count() == 0
    check(spark, rows[:5])
    axes = [[float(i == j) * s for j in range(4)] for i in range(4) for s in (1, -1)]
    table = spark.createDataFrame([(i, v, 1, "") for i, v in enumerate(axes)], SCHEMA)
    got = whitening.whiten(table).collect()
    assert len(got) == 32 and {x.identity_error < 1e-9 for x in got} == {True} and {round(x.explained, 9) for x in got} == {0.25}


@pytest.mark.parametrize("values", [[5.0, 3, 2, 1, 0.5], [1.0] * 6, [4.0, 4, 1, 1, 1, 0, 0], [1e8, 1, 1e-6], [2.0, 2 - 1e-9, 1], list(np.geomspace(1, 1e-4, 60))])
def test_divide_and_conquer(values):
    r = np.random.default_rng(len(values))
    turn, _ = np.linalg.qr(r.normal(size=(len(values), len(values))))
    a = (turn * values) @ turn.T
    a = (a + a.T) / 2
    got, vectors = whitening.eigen(a, len(values))
    size = max(values)
    assert np.abs(got - np.sort(values)[::-1]).max() <= 1e-13 * size * len(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13 * len(values)
    assert np.linalg.norm(a @ vectors - vectors * got) <= 1e-13 * size * len(values)
    few, _ = whitening.eigen(a, 2)
    assert np.abs(few - got[:2]).max() <= 1e-13 * size * len(values)
