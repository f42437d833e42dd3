"""Exact duplicates against plain groups."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from loantape.llm import tries

DOCS = "doc_id bigint, text string, n bigint, Text_sha256 string, `class` string"


def plain(rows, largest=True):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        owner = (max(known) if largest else min(known)) if known else None
        out += [(i, owner, len(ids), hashlib.sha256(text).hexdigest()) for i in ids]
    return sorted(out, key=repr), len(groups)


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], DOCS).repartition(parts)


def check(spark, rows, parts=4, largest=True, **bounds):
    got = tries.exact_duplicates(table(spark, rows, parts), largest=largest, **bounds).collect()
    want, groups = plain(rows, largest)
    assert sorted([(x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in got], key=repr) == want
    kept = [x for x in got if x.kept]
    assert len(kept) == groups == len({x.text_sha256 for x in kept})
    assert all(x.doc_id == x.keep_id for x in kept)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    texts = ["".join(r.choice("abAB \n") for _ in range(r.randint(0, 7))) for _ in range(200)]
    texts += ["Ä" * n for n in (1, 2, 2, 3)] + ["ä", "ä" * 2, "x" * 300_000, "X" * 300_000, "x" * 299_999 + "y"]
    texts += [None, "", None, "İ", "i̇"] + ["copy"] * 150 + ["COPY" * 9] * 3
    return list(enumerate(texts))


def test_groups(spark, rows):
    check(spark, rows)
    check(spark, rows, largest=False)


def test_spilled_and_salted(spark, rows):
    check(spark, rows, parts=9, trie_bytes=3000, fan=2)
    check(spark, rows, parts=3, trie_bytes=0, fan=3)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "A"), (None, "b"), (4, "b"), (4, "B"), (2, "b"), (7, None), (7, None), (None, ""), (None, "c")]
    for parts, fan in ((1, 256), (5, 2)):
        check(spark, rows, parts, fan=fan)


def test_hash_collisions_are_told_apart(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["ab", "cd", "ab", "ef", "cd", "gh"])]
    plain_groups, _ = plain(rows)
    found = tries.exact_duplicates(table(spark, rows, 1)).collect()
    # One bucket for all texts of a length: what the merged trie sees if 64 bits collide.
    terminals = [(i, i, 2, 0, i, 1, t.encode(), 6, 0) for i, t in rows]
    schema = "class bigint, winner bigint, n_bytes bigint, hash bigint, owner bigint, n bigint, text binary, members bigint, salt int"
    merged = spark.createDataFrame(terminals, schema).coalesce(1).mapInArrow(tries._merge(True, 256), tries.MERGED_SQL).collect()
    owners = {x.doc_id: x.keep_id for x in found}
    assert {x["class"]: x.owner for x in merged} == owners == {0: 2, 1: 4, 2: 2, 3: 3, 4: 4, 5: 5}
    assert len(plain_groups) == 6


def test_empty(spark):
    made = tries.exact_duplicates(spark.createDataFrame([], DOCS))
    assert made.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and made.count() == 0


def test_trie_splits_edges_and_spills_by_subtree():
    r = random.Random(5)
    trie, want = tries.Trie(), defaultdict(list)
    for i in range(3000):
        data = bytes(r.choice(b"ab") for _ in range(r.randint(0, 12)))
        trie.add(data, i)
        want[data].append(i)
    held = trie.held
    first = dict(trie.spill(held // 2))
    assert 0 < trie.held <= held // 2 and len(first) > 1
    rest = dict(trie.spill())
    assert not set(first) & set(rest) and trie.held == 0
    assert first | rest == want


def test_memory_of_a_task_is_bounded():
    trie, most = tries.Trie(), 0
    for i in range(4000):
        trie.add(f"{i % 50}-{i}".encode() * 20, i)
        if trie.held > 50_000:
            assert sum(len(items) for _, items in trie.spill(25_000))
            assert trie.held <= 25_000
        most = max(most, trie.held)
    assert most < 52_000
