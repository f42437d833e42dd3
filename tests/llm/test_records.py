"""Archives, vectors and components."""

import base64
import gzip
import hashlib
import io
import random

import brute
import pytest

from loantape.llm import pq, warc
from loantape.llm.components import components


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(500, r.randrange(600, 900)) for _ in range(80)]
    links += [(r.randrange(1000, 1300), r.randrange(1000, 1300)) for _ in range(200)] + [(7, 7), (9, 8), (8, 9)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    top = brute.roots({n for e in links for n in e}, links)
    assert got == {n: t for n, t in top.items() if n != t}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_vectors(spark):
    r = random.Random(4)
    rows = []
    for i in range(260):
        v = [r.gauss(0, 1) for _ in range(12)]
        if rows and i % 3 == 0 and rows[-1][1]:
            v = [x * 2 + r.gauss(0, 0.02) for x in rows[-1][1]]
        rows.append((i * 13 % 1009, v, r.choice([0, 0, 1, 2, None])))
    same = [1.0] * 12
    rows += [(2000 + i, same, 5) for i in range(30)] + [(3000, [2.0] * 12, 5), (3001, [-1.0] * 12, 5)]
    odd = [None, [], [0.0] * 12, [1.0, None, *[0.0] * 10], [float("nan"), *[1.0] * 11], [float("inf"), *[1.0] * 11], [1.0, 2.0], [1e-300] * 12]
    rows += [(4000 + i, v, 5) for i, v in enumerate(odd)]
    schema = "vec_id bigint, embedding array<double>, label int, list string, codes string, unit string"
    table = spark.createDataFrame([(*x, "l", "c", "u") for x in rows], schema).repartition(3)
    got = {x.vec_id: x for x in pq.near_duplicates(table).collect()}
    want = brute.vector_links(rows)
    assert {i: (x.n_links, x.component_id) for i, x in got.items()} == want
    assert all(x.kept == (x.vec_id == x.component_id) for x in got.values())
    assert pq.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_vector_lists_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(pq, "LIST_ROWS", 8)
    monkeypatch.setattr(pq, "CHUNK_ROWS", 16)
    monkeypatch.setattr(pq, "QUERY_ROWS", 5)
    r = random.Random(6)
    rows = []
    centres = [[r.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    for i in range(400):
        rows.append((i, [x + r.gauss(0, 0.12) for x in r.choice(centres)], i % 2))
    got = {x.vec_id: (x.n_links, x.component_id) for x in pq.near_duplicates(spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int")).collect()}
    want = brute.vector_links(rows)
    assert sum(n for n, _ in want.values()) > 500
    assert got == want


def test_vectors_of_several_lengths(spark):
    r = random.Random(16)
    rows = []
    for n in (3, 2, 5, 1):
        for i in range(60 if n == 3 else 25):
            v = [r.gauss(0, 1) for _ in range(n)]
            rows += [(len(rows), v, i % 2), (len(rows) + 1, [x * 3 + r.gauss(0, 0.05) for x in v], i % 2)]
    rows += [(900, [1.0, 2.0, 3.0, 4.0, 5.0], 0), (901, [2.0, 4.0, 6.0, 8.0, 10.0], 0), (902, [1.0, 2.0, 3.0], 0), (903, [1.0, 2.0, 3.0, 0.0], 0)]
    got = {x.vec_id: (x.n_links, x.component_id) for x in pq.near_duplicates(spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int")).collect()}
    want = brute.vector_links(rows)
    assert got == want and want[901] == (1, 900) and want[903][1] == 903


PAGES = [
    (1, "http://a/1?x=ü y", "<p>ä</p>"), (2, None, None), (3, "u\r\nX: y", ""), (4, "http://a", "<p>ä</p>"),
    (9, "http://a", "\r\n\r\nWARC/1.1\r\n\r\n"), (5, "u", "z" * 3_000_000), (6, "u", "z" * 3_000_000), (7, "u", "q"), (7, "u", "q"),
]


@pytest.mark.parametrize("archive_bytes", [1 << 24, 10])
def test_round_trip(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    table = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id bigint, url string, html string, path string, last string").repartition(2)
    got = sorted(warc.round_trip(spark, table).collect(), key=lambda x: x.page_id)
    assert len(got) == len(PAGES)
    last = {}
    for page_id, _, page in PAGES:
        last[page or ""] = max(last.get(page or "", 0), page_id)
    for x, (page_id, _, page) in zip(got, sorted(PAGES, key=lambda p: p[0])):
        data = (page or "").encode()
        response = last[page or ""] == page_id
        assert (x.page_id, x.payload_bytes) == (page_id, len(data))
        assert x.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (x.record_type, x.refers_to) == (("response", None) if response else ("revisit", last[page or ""]))
        assert (bytes(x.payload) if x.payload is not None else None) == (data if response else None)
    assert warc.round_trip(spark, table.limit(0)).count() == 0


def test_members_can_be_reached_by_offset(spark, tmp_path):
    table = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").coalesce(1)
    whole = warc.write(table, f"{tmp_path}/whole")
    new = warc.normalise(whole, f"{tmp_path}/whole", f"{tmp_path}/members")
    name = new.first()["path"]
    data = (tmp_path / "members" / name).read_bytes()
    lines = (tmp_path / "members" / name.replace(".warc.gz", ".index")).read_text().splitlines()
    assert len(lines) == len(PAGES)
    parts = []
    for line in lines:
        offset, length, kind, _ = line.split("\t")
        member = gzip.decompress(data[int(offset) : int(offset) + int(length)])
        assert f"WARC-Type: {kind}".encode() in member and member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
        parts.append(member)
    old = gzip.decompress((tmp_path / "whole" / whole.first()["path"]).read_bytes())
    assert b"".join(parts) == old


def test_streams_that_end_too_early():
    raw = b"".join(warc.record(i, "u", b"x" * 50_000) for i in range(5))
    assert len(list(warc.records(warc.Stream(io.BytesIO(gzip.compress(raw)))))) == 5
    many = b"".join(gzip.compress(raw[i : i + 7000]) for i in range(0, len(raw), 7000))
    assert b"".join(r for _, r in warc.records(warc.Stream(io.BytesIO(many)))) == raw
    for broken in (gzip.compress(raw)[:-50], gzip.compress(raw[:-9])):
        with pytest.raises(EOFError):
            list(warc.records(warc.Stream(io.BytesIO(broken))))


def test_one_id_with_several_payloads(spark):
    rows = [(5, "AAAA"), (5, "BBBB"), (5, "CCCC"), (9, "AAAA"), (10, "BBBB"), (5, "CCCC"), (None, "AAAA"), (None, "ZZ")]
    table = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id bigint, url string, html string")
    got = sorted([(x.page_id, x.payload_bytes, x.record_type, x.refers_to) for x in warc.round_trip(spark, table).collect()], key=repr)
    assert got == sorted([
        (5, 4, "revisit", 9), (5, 4, "revisit", 10), (5, 4, "response", None), (5, 4, "response", None),
        (9, 4, "response", None), (10, 4, "response", None), (None, 4, "response", None), (None, 2, "response", None),
    ], key=repr)


def test_folder_without_a_scheme_is_qualified_on_the_driver(spark, tmp_path):
    table = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    seen = []
    plain = warc._open
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    warc._open = lambda folder: seen.append(folder) or plain(folder)
    try:
        made = warc.write(table, f"{tmp_path}/whole")
    finally:
        warc._open = plain
    assert made.count() >= 1 and all(f.startswith("file:") for f in seen)
