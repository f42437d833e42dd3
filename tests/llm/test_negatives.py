"""Hard negatives against a comparison of every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loantape.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank int, ids string"


def plain(rows, every=5, positives=5, few=3):
    good = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, la, va in good:
        if a % every:
            continue
        score = [(sum(x * y for x, y in zip(va, v)), i, lb) for i, lb, v in good if len(v) == len(va)]
        first = sorted(((-s, i) for s, i, lb in score if lb == la and i != a))[:positives]
        for p, pid in first:
            p = -p
            hard = sorted((-s, i) for s, i, lb in score if lb != la and 50 * p <= 100 * s <= 95 * p)[:few]
            out += [(a, pid, k + 1, i, p, -s) for k, (s, i) in enumerate(hard)]
    return sorted(out)


def check(spark, rows, every=5, parts=4):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    got = negatives.hard_negatives(table, F.col("vec_id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain(rows, every)
    assert sorted(map(tuple, got.collect())) == want
    return want


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    centres = [[r.gauss(0, 1) for _ in range(20)] for _ in range(4)]
    rows = [(i, [0.6 * c + r.gauss(0, 0.6) for c in centres[i % 4]], (i // 3) % 4) for i in range(400)]
    return rows


def test_every_anchor(spark, rows, monkeypatch):
    assert len(check(spark, rows)) > 300
    # Many blocks, many parts, results given out at once.
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 2048)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 7)
    monkeypatch.setattr(negatives, "PART_ROWS", 9)
    monkeypatch.setattr(negatives, "KEPT_ROWS", 20)
    assert len(check(spark, rows, parts=3)) > 300


def test_ties_and_small_numbers(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-1, 0, 0.5, 1]) / 64 for _ in range(3)], i % 3) for i in range(150)]
    assert check(spark, rows)


def test_rows_that_take_no_part(spark, rows):
    nan, inf = float("nan"), float("inf")
    some = rows[:120] + [
        (1000, None, 1), (1005, [nan] * 20, 1), (1010, [inf] * 20, 0), (1015, [None] + [0.1] * 19, 2), (1020, rows[5][1], None),
        (None, rows[5][1], 1), (1025, [], 1), (1030, [], 2), (1035, [], 1), (1040, [1.0, 0.5], 1), (1045, [1.0, 0.4], 1), (1050, [0.7, 0.2], 2),
        (1055, [0.0] * 20, 1), (-5, rows[7][1], 2),
    ]
    got = check(spark, some)
    assert any(x[0] == 1040 and x[3] == 1050 for x in got)
    huge = some + [(2000, [1e200] * 20, 1), (2005, [-1e18] * 20, 2)]
    table = spark.createDataFrame([(*x, 1, "x") for x in huge], SCHEMA)
    assert sorted(map(tuple, negatives.hard_negatives(table, F.col("vec_id") % 5 == 0).collect())) == got


def test_repeated_ids_and_skew(spark, rows):
    base = rows[:40]
    check(spark, base + [base[3]] * 30 + [(base[4][0], base[9][1], 1)] * 2 + [(i + 500, base[2][1], base[2][2]) for i in range(90)], parts=5)


def test_empty_and_one_label(spark, rows):
    assert check(spark, []) == []
    assert check(spark, [(i, v, 1) for i, v, _ in rows[:30]]) == []
    assert check(spark, [(5, rows[0][1], 1)]) == []


def test_scan_is_exact_and_prunes():
    r = np.random.default_rng(4)
    columns = r.integers(-300, 300, (32, 500))
    for shift in (0, 1 << 26):
        wide = columns + shift
        block = negatives.Block(32, 500, np.arange(500).tobytes(), ["a"], np.zeros(500, np.int32).tobytes(), wide.astype(np.int64).tobytes(), True)
        anchor = r.integers(-300, 300, 32) * (10 ** r.integers(0, 3, 32)) * (1 + shift // 64)
        want = np.array([sum(int(a) * int(x) for a, x in zip(anchor, wide[:, i])) for i in range(500)], dtype=object)
        bar = sorted(want)[-5]
        at, scores = negatives.vertical_scan(block, anchor, np.ones(500, bool), [(int(bar), negatives.FAR)])
        assert sorted(at) == [i for i in range(500) if want[i] >= bar]
        some, within = negatives.vertical_scan(block, anchor, np.arange(500) % 2 == 0, [(int(bar), negatives.FAR)], slice(100, 400))
        assert sorted(some) == [i for i in range(100, 400, 2) if want[i] >= bar] and [int(s) for s in within] == [want[i] for i in some]
        assert [int(s) for s in scores] == [want[i] for i in at]
        # A magnitude that falls off lets bounds rule out most rows before the last columns.
        steep = (anchor * 0.8 ** np.arange(32)).astype(np.int64)
        scores = np.array([sum(int(a) * int(x) for a, x in zip(steep, wide[:, i])) for i in range(500)], dtype=object)
        reads = []
        plain_take = np.take
        np.take = lambda a, b, axis: reads.append(len(b)) or plain_take(a, b, axis=axis)
        try:
            negatives.vertical_scan(block, steep, np.ones(500, bool), [(int(sorted(scores)[-5]), negatives.FAR)])
        finally:
            np.take = plain_take
        assert shift or reads[-1] < 250


def test_work_of_parts_grows_with_the_root():
    # Blocks of anchors are copied once per part; rows are not copied at all.
    for n in (10**4, 10**6, 10**8):
        assert math.ceil(math.sqrt(n / negatives.PART_ROWS)) <= 0.0625 * math.sqrt(n) + 1
