"""Operators against plain versions, with rows that have no id, share one, or come twice."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from loantape.llm import language, mixing, quality, sharding

WORDS = {
    "en": "the of and to in is that it was for on are as with his they at be this have from or one had by word but not what all".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass".split(),
    "fr": "le la les de des et un une du que est pas pour dans ce il sur au qui par ne se plus avec son été même où à ça".split(),
}


def text_of(r, lang, n):
    return " ".join(r.choice(WORDS[lang]) + r.choice(["", "", ",", "!", " 12"]) for _ in range(n))


def plain_grams(text):
    parts = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = f" {' '.join(parts)} " if parts else text and " "
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            mixed = 0
            for c in line[i : i + n]:
                mixed = (mixed + ord(c) + 1) * 0x9E3779B97F4A7C15 % 2**64
                mixed ^= mixed >> 29
            yield (mixed >> 40) % language.BUCKETS


def plain_bayes(rows):
    counts = defaultdict(Counter)
    for text, lang in rows:
        if text is not None and lang is not None:
            counts[lang].update(plain_grams(text))

    def tell(text):
        if not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        scores = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + 0.5 * language.BUCKETS
            scores[lang] = sum(math.log((counts[lang][g] + 0.5) / total) for g in plain_grams(text))
        best = max(sorted(scores), key=scores.get)
        return best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())

    return tell


def test_language_is_naive_bayes(spark):
    r = random.Random(1)
    rows = [(i, text_of(r, lang, r.randint(1, 40)), r.choice([lang, lang, None])) for i, lang in enumerate(list(WORDS) * 25)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "12 !", "fr"), (None, text_of(r, "de", 9), "de"), (3, text_of(r, "fr", 9), "fr")]
    table = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(3)
    tell = plain_bayes([(t, lang) for _, t, lang in rows])
    asked = [(i, t) for i, t, _ in rows] + [(600, "der the le"), (601, "ÄÖ ß"), (602, "la " * 3000), (603, "İ")]
    got = language.identify(spark.createDataFrame(asked, "doc_id int, text string"), language.train(table)).collect()
    assert len(got) == len(asked)
    for x in got:
        lang, score = tell(x.text)
        assert x.lang_pred == lang and abs(x.score - score) < 1e-6


@pytest.fixture(scope="module")
def odd_rows():
    """Rows without id, of one id, and the same row over and over, a third of the table each."""
    r = random.Random(2)
    texts = [text_of(r, "en", r.randint(0, 60)) for _ in range(300)]
    rows = [(None, t, "a", "en") for t in texts] + [(7, t, None, None) for t in texts[:200]] + [(9, texts[0], "b", "de")] * 250
    return rows + [(i + 100, t, "b", "fr") for i, t in enumerate(texts[:50])] + [(1, None, "a", None), (2, "", None, "en")]


SCHEMA = "doc_id bigint, text string, source string, lang string"


@pytest.mark.parametrize("parts", [1, 4])
def test_shards_number_every_row(spark, odd_rows, parts, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 20)
    got = sharding.shards(spark.createDataFrame(odd_rows, SCHEMA).repartition(parts), 6).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    assert Counter((x.doc_id, x.size, x.text_crc32) for x in got) == want
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for x in got:
        by_shard[x.shard].append(x.slot)
        by_text[x.text_crc32].add(x.shard)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values())
    # The text of 250 rows is the largest group, and what the others hold is shared out evenly.
    sizes = Counter()
    for x in got:
        sizes[x.shard] += x.size
    alone = by_text[zlib.crc32(odd_rows[0][1].encode())].pop()
    rest = sorted(n for s, n in sizes.items() if s != alone)
    assert rest[-1] - rest[0] <= 0.25 * rest[-1] + 400


def test_mix_deals_rows_without_id_to_all_cells(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 20)
    table = spark.createDataFrame(odd_rows, SCHEMA)
    rows = mixing.stored(mixing._sized(table, "doc_id", "text", "source"), "sizes")
    placed = mixing._placed(rows, mixing.WEIGHTS, mixing.SHARE, mixing.MOST, mixing.BLOCK, mixing.SEED)
    cells = placed.where("doc_id is null").groupBy("__cell").count().agg(F.count(F.lit(1)), F.max("count")).first()
    assert cells[0] >= 10 and cells[1] <= 60
    got = [tuple(x) for x in mixing.mix(table).collect()]
    again = [tuple(x) for x in mixing.mix(table.repartition(5)).collect()]
    assert sorted(got, key=repr) == sorted(again, key=repr) and len(got) == len(odd_rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s, _ in odd_rows:
        sizes[s] += len(brute.WORD.findall(t or ""))
    for x in mixing.mix(table).collect():
        taken[x.source] += x.taken
        assert x.taken <= 2 * x.size
    want = brute.mix_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 3 * mixing.BLOCK for s in sizes), (taken, want)


def js(p, q):
    half = [(a + b) / 2 for a, b in zip(p, q)]
    part = lambda x: sum(a * math.log2(a / m) for a, m in zip(x, half) if a > 0)
    return (part(p) + part(q)) / 2


def test_quality_of_odd_rows(spark, odd_rows):
    got = quality.judge(spark.createDataFrame(odd_rows, SCHEMA).select("doc_id", "text", "lang").repartition(3)).collect()
    want = Counter()
    for i, t, *_ in odd_rows:
        n_words, chars, symbols, lines, repeated = brute.measures(t)
        want[(i, n_words, chars, symbols, lines, repeated, n_words < 10 or 100 * repeated > 20 * n_words)] += 1
    assert Counter((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in got) == want
    assert not any(x.kept for x in got if x.base_failed)


def test_distance_is_jensen_shannon(spark):
    r = random.Random(3)
    pairs = []
    for _ in range(30):
        p, q = ([r.choice([0, 1, 2, 5]) + 0.0 for _ in range(6)] for _ in range(2))
        if sum(p) and sum(q):
            pairs.append(([x / sum(p) for x in p], [x / sum(q) for x in q]))
    table = spark.createDataFrame(pairs, "p array<double>, q array<double>")
    got = table.select("p", "q", quality.distance(F.col("p"), F.col("q")).alias("d")).collect()
    scale = {round(x.d / v, 6) if v > 1e-9 else None for x in got for v in [js(x.p, x.q)]}
    root = {round(x.d / math.sqrt(v), 6) if v > 1e-9 else None for x in got for v in [js(x.p, x.q)]}
    assert len(scale - {None}) == 1 or len(root - {None}) == 1
    assert re.match(r"0|1", str(min(x.d for x in got)))
