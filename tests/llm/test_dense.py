"""Many near but unequal vectors under one label."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from loantape.llm import pq


def test_both_sides_are_cut_and_pairs_are_folded(spark, monkeypatch):
    monkeypatch.setattr(pq, "CHUNK_ROWS", 32)
    monkeypatch.setattr(pq, "QUERY_ROWS", 20)
    monkeypatch.setattr(pq, "ASK_ROWS", 50, raising=False)
    plain, most = pq.Index.table, 120

    def few(self, queries, number):
        assert len(queries) <= 20
        return plain(self, queries, number)

    monkeypatch.setattr(pq.Index, "table", few)
    r = random.Random(41)
    centre = [r.gauss(0, 1) for _ in range(8)]
    rows = [(i, [x + r.gauss(0, 0.05) for x in centre], 1) for i in range(300)] + [(300 + i, [r.gauss(0, 1) for _ in range(8)], 1) for i in range(20)]
    sides = []
    plain_sides = pq._sides

    def noted(members):
        sides.extend(plain_sides(members))
        return sides

    monkeypatch.setattr(pq, "_sides", noted)
    table = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int")
    got = {x.vec_id: (x.n_links, x.component_id) for x in pq.near_duplicates(table).collect()}
    assert got == brute.vector_links(rows)
    for side in sides:
        assert side.groupBy("label", "list", "chunk", "part").count().agg(F.max("count")).first()[0] <= most


def test_forest_keeps_a_link_per_row():
    n = 200
    forest = pq.Forest(np.arange(n))
    for low in range(0, n, 50):
        a, b = np.nonzero(np.arange(low, low + 50)[:, None] < np.arange(n)[None, :])
        forest.add(np.arange(low, low + 50), a, b)
    assert len(forest.links) < 2 * n
    assert set(brute.roots(range(n), forest.links).values()) == {0}


def test_cells_of_lists(spark, monkeypatch):
    monkeypatch.setattr(pq, "LIST_ROWS", 2)
    r = random.Random(43)
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(40)]
    rows = [(i, [x + r.gauss(0, 0.08) for x in r.choice(centres)], r.choice([1, 1, 2])) for i in range(400)]
    rows += [(400 + i, [r.gauss(0, 1) for _ in range(n)], 1) for i in range(30) for n in [r.choice([3, 20])]]
    rows += [(430 + i, rows[i][1], rows[i][2]) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label int")
    want = brute.vector_links(rows)
    made = []
    plain = pq.fit
    monkeypatch.setattr(pq, "fit", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    for max_lists, depth in ((1024, 0), (8, 1), (1, 2)):
        got = {x.vec_id: (x.n_links, x.component_id) for x in pq.near_duplicates(table, max_lists=max_lists).collect()}
        assert got == want
        assert made[-1].depth == depth
    assert any(n for n, _ in want.values())


def test_cells_keep_what_is_near_and_leave_the_rest():
    r = np.random.default_rng(44)
    points = r.normal(size=(3000, 16))
    points /= np.sqrt((points * points).sum(1))[:, None]
    points[1:1500:2] = points[0:1500:2] + r.normal(size=(750, 16)) * 0.01
    points /= np.sqrt((points * points).sum(1))[:, None]
    index = pq.Index(points, 4, depth=2)
    own, far = index.assign(points)
    codes, _ = index.encode(points, own)
    probes = index.probes(points, own, far, codes, 0.2)
    cell = index.cell(own, codes)
    assert [p[0] for p in probes] == cell.tolist()
    assert all(len(set(p.tolist())) == len(p) for p in probes)
    a, b = np.nonzero(pq.squared(points, points) <= 0.2**2)
    assert len(a) > 4000 and all(cell[y] in probes[x] for x, y in zip(a.tolist(), b.tolist()))
    # Of 4,096 cells, a point looks into some.
    assert np.mean([len(p) for p in probes]) < 0.25 * 4 * index.cells
