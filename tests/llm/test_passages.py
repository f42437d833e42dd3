"""Repeated passages whose anchors very many documents have."""

import random

import brute

from loantape.llm import suffixes


def checked(spark, rows, block_bytes=3000):
    some = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = suffixes.remove_repeats(some, block_bytes=block_bytes).collect()
    want = brute.repeats(rows)
    assert sorted([(x.row.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got], key=repr) == sorted(want, key=repr)


def line_in_all(n):
    r = random.Random(31)
    line = "".join(r.choice("abcdefgh ") for _ in range(120))
    text = lambda: "".join(r.choice("ijklmnop ") for _ in range(60))
    return [(r.choice([None, i, i, i, i // 2]), text() + r.choice([line, line[5:], line[:-7]]) + text()) for i in range(n)]


def test_strings_of_hot_anchors_meet(spark, monkeypatch):
    rows = line_in_all(90)
    for hot in (2, 20):
        monkeypatch.setattr(suffixes, "HOT", hot)
        checked(spark, rows)


def test_no_bucket_holds_all_runs_of_an_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 20, raising=False)
    plain = suffixes.sort_suffixes

    def bounded(data, starts, groups, width):
        assert len(data) < 55_000
        return plain(data, starts, groups, width)

    monkeypatch.setattr(suffixes, "sort_suffixes", bounded)
    checked(spark, [(i, t) for i, (_, t) in enumerate(line_in_all(1000))], block_bytes=1500)


def test_blocks_grow_slowly_with_the_text():
    assert suffixes.n_blocks(0) == 1 and suffixes.n_blocks(1) == 1
    assert suffixes.n_blocks(1 << 30) == 256
    sizes = [total / suffixes.n_blocks(total) for total in (1 << 30, 1 << 34, 1 << 38, 100 * 10**12)]
    assert sizes == sorted(sizes) and sizes[-1] < 80 << 20


def test_larger_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "EVEN_BYTES", 64)
    assert suffixes.n_blocks(20_000, 3000) == 2
    checked(spark, line_in_all(90))
