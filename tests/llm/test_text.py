"""Operators on texts against plain versions, with nulls, empty and long texts, ties and repeats."""

import random
from collections import defaultdict

import brute
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from loantape.llm import bpe, html, language, mixing, quality, sharding, simhash, suffixes

# Names that the operators use themselves.
CLASH = "row string, fp bigint, block bigint, bucket bigint, size string, made string, score string, ids string, taken string, shard string"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASH}"
EXTRA = ("x", 1, 2, 3, "s", "m", "q", "i", "t", "h")


def word(r):
    return "".join(r.choice(["ta", "ri", "so", "len", "ö", "qu", "mi"]) for _ in range(r.randint(1, 4)))


def sentence(r, n):
    return " ".join(word(r) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    shared = sentence(r, 30)
    texts = [
        None, "", " \t\n", "...!? 123", "word", "Word", "two words", sentence(r, 4000), sentence(r, 4000) + "\n" + shared,
        shared, shared, shared + " " + sentence(r, 5), sentence(r, 9) + "\n" + shared + "\n" + shared,
        "a" * 300, "a" * 301, "ab" * 200, "\x0b\x0c words \r\n apart \x1c\x85 not", "日本語 のテキスト 😀 " * 20,
        "one line\none line\nother\n\n\none line", "x y z w v " * 40, "%$# | <a> & *b* " * 9,
    ]
    texts += [sentence(r, r.randint(1, 60)) for _ in range(40)]
    texts += texts[-5:]
    # Near copies: one word changed in a long text.
    base = sentence(r, 300).split()
    texts += [" ".join(base), " ".join([*base[:150], "changed", *base[151:]]), " ".join(base).upper()]
    out = []
    for i, text in enumerate(texts):
        lang = [None, "en", "de", "fr"][i % 4]
        out.append((i * 7 % 101, text, lang, ["b", "a", None, "é", "c", "hot", "hot"][i % 7], len(text or ""), *EXTRA))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_simhash_links(docs, rows):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = {r[0]: brute.fingerprint(r[1]) for r in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    top = brute.roots(prints, links)
    assert len(links) > 5
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {
        i: (f"{p:016x}", top[i]) for i, p in prints.items()
    }


def test_simhash_repeats_and_null_ids(spark, empty):
    schema = "doc_id bigint, text string"
    some = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "other text here"), (2, None)], schema)
    got = sorted(simhash.near_duplicates(some).collect(), key=repr)
    assert [(r.doc_id, r.component_id) for r in got if r.doc_id] == [(2, 2), (3, 3), (3, 3)]
    assert sorted([r.component_id for r in got if r.doc_id is None], key=repr) == [3, None]
    assert simhash.near_duplicates(empty).count() == 0


def test_ball_finds_every_pair_within_radius(spark):
    r = random.Random(1)
    centre = r.getrandbits(64)
    prints = {centre}
    while len(prints) < 60:
        flipped = r.choice(sorted(prints))
        for _ in range(r.randint(1, 3)):
            flipped ^= 1 << r.randrange(64)
        prints.add(flipped)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)]
    pairs = [(x.a, x.b) for x in simhash.close_pairs(spark.createDataFrame(signed, "fp bigint")).collect()]
    want = [(a[0], b[0]) for a in signed for b in signed if a < b and ((a[0] ^ b[0]) & (2**64 - 1)).bit_count() <= 2]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in pairs)
    assert brute.roots([s[0] for s in signed], pairs) == brute.roots([s[0] for s in signed], want)


def test_suffixes(docs, rows, empty):
    for block_bytes in (1 << 22, 3000):
        done = suffixes.remove_repeats(docs, block_bytes=block_bytes)
        got = [(r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in done.collect()]
        want = brute.repeats([r[:2] for r in rows])
        assert sorted(got) == sorted(want)
        assert sum(w[2] for w in want) > 1000
    assert suffixes.remove_repeats(empty).count() == 0


def test_suffixes_many_blocks_ties_and_null_ids(spark):
    r = random.Random(9)
    passages = [sentence(r, 20) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [r.choice(passages)[r.randint(0, 30) :] if r.random() < 0.6 else sentence(r, 12) for _ in range(4)]
        rows.append((r.choice([None, i, i, i, i // 2]), "".join(parts)))
    some = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = suffixes.remove_repeats(some, block_bytes=4000).collect()
    want = brute.repeats(rows)
    key = repr
    assert sorted([(x.row.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got], key=key) == sorted(want, key=key)


def test_suffix_sort_survives_collisions():
    import numpy as np

    r = random.Random(3)
    data = np.frombuffer(("".join(r.choice("ab") for _ in range(4000)) * 2).encode(), np.uint8)
    starts = np.arange(len(data) - 50)
    groups = np.sort(np.array([r.randrange(3) for _ in starts]))
    order, same = suffixes.sort_suffixes(data, starts, groups, 50)
    strings = [bytes(data[s : s + 50]) for s in starts[order]]
    assert all(groups[order][i] == groups[i] for i in range(len(starts)))
    for g in range(3):
        mine = [s for s, x in zip(strings, groups) if x == g]
        assert mine == sorted(mine)
    assert [bool(s) for s in same] == [
        i > 0 and groups[i] == groups[i - 1] and strings[i] == strings[i - 1] for i in range(len(strings))
    ]


def test_suffix_kept_text_cuts_no_character(spark):
    text = "é" * 40
    some = spark.createDataFrame([(1, text), (2, "x" + text[:30] + "yé")], "doc_id int, text string")
    rows = {r.row.doc_id: r for r in suffixes.remove_repeats(some, kept="text").collect()}
    assert rows[1].kept == text and rows[2].kept == "xyé"


def test_language(docs, rows, empty):
    model = language.train(docs.where(~language.held_out()))
    assert model[0] == ["de", "en", "fr"]
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    for r in rows:
        told = got[r[0]]
        assert (told.lang_pred == "und") == (not any(c.isalpha() for c in r[1] or ""))
        assert 0 <= told.score <= 1 and told.row == "x"
    assert language.train(empty) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def test_language_tells_languages(spark):
    r = random.Random(2)
    words = {"en": ["the", "and", "house", "with"], "de": ["der", "und", "haus", "mit"], "xx": ["zzq", "qqz", "zqz"]}
    rows = [(i, " ".join(r.choice(words[k]) for _ in range(30)), k) for i, k in enumerate(list(words) * 30)]
    some = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    told = language.identify(some, language.train(some.where(~language.held_out())))
    assert told.where(language.held_out()).count() > 10
    assert told.where("lang_pred != lang or score < 0.9").count() == 0


def test_language_slices_count_like_the_whole(monkeypatch):
    text = sentence(random.Random(4), 200) + " ,,, \n\n 12 ends"
    whole = sorted(x for part in language.grams(text) for x in part.tolist())
    for n in (1, 2, 7, 64):
        monkeypatch.setattr(language, "SLICE", n)
        assert sorted(x for part in language.grams(text) for x in part.tolist()) == whole


def test_bpe(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = bpe.read_ranks(file.read())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    made = bpe.tokenise(docs, path, public_tokenizers.PATTERN, list(bpe.COLUMNS))
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1] or "")
    for r in made.collect():
        text = texts[r.doc_id][0]
        assert r.ids == plain.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert r.decoded == text and r.made == "m"
    assert bpe.tokenise(empty, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_states_and_pieces_may_be_forgotten(monkeypatch):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for name, n in (("MAX_STATES", 20), ("MAX_PIECES", 3), ("MAX_PAIRS", 5), ("LONG_TEXT", 10), ("CHUNK", 4)):
        monkeypatch.setattr(bpe, name, n)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    r = random.Random(6)
    for _ in range(300):
        text = "".join(r.choice([word(r), " ", "\n", "é", "😀", "12", "'s", "====", "​", "aaaa"]) for _ in range(r.randint(0, 25)))
        ids = encoder.encode(text)
        assert ids == plain.encode_ordinary(text)
        assert "".join(encoder.decode(ids)) == text


def test_quality_counts(docs, rows, empty):
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1])
    for r in quality.judge(docs).collect():
        want = brute.measures(texts[r.doc_id][0])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality.judge(empty).count() == 0


def test_quality_turns_down_marked_text(spark):
    r = random.Random(8)
    common = "the of and to in is that for it as".split()
    prose = [" ".join(r.choice(common) if r.random() < 0.4 else word(r) for _ in range(150)) for _ in range(60)]
    marked = [" ".join(w + r.choice(["###", "%%%", "&&&"]) for w in p.split()) for p in prose[:3]]
    rows = [(i, t, "en") for i, t in enumerate(prose + marked)] + [(900, prose[0], None), (901, marked[0][:60], "en")]
    got = {x.doc_id: x for x in quality.judge(spark.createDataFrame(rows, "doc_id int, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(60))
    assert not any(got[i].kept for i in range(60, 63))
    assert got[900].kept and got[900].char_distance is None


def test_mixing(docs, rows, empty):
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(brute.WORD.findall(r[1] or ""))
    want = brute.mix_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 3 * mixing.BLOCK for s in sizes)
    assert sorted(got, key=repr) == sorted(mixing.mix(docs.repartition(2)).collect(), key=repr)
    assert mixing.mix(empty).count() == 0


def test_mixed_documents_hold_the_words_that_are_counted(docs):
    counted = {(r.doc_id, r.size): r.taken for r in mixing.mix(docs, block=3).groupBy("doc_id", "size").agg(F.sum("taken").alias("taken")).collect()}
    by_id = defaultdict(int)
    for (doc_id, _), n in counted.items():
        by_id[doc_id] += n
    made = defaultdict(int)
    for r in mixing.mixed(docs, block=3).collect():
        made[r.doc_id] += len(brute.WORD.findall(r.text))
        assert r.row == "x" and len(brute.WORD.findall(r.text)) > 0
    assert made == {k: v for k, v in by_id.items() if v}


def test_sainte_lague(spark):
    r = random.Random(11)
    weights = [r.choice([0, 1, 5, 5, 40, 333, 7]) for _ in range(30)]
    for seats in (0, 1, 7, 100, 999):
        table = spark.createDataFrame([(0, i, w, seats) for i, w in enumerate(weights)], "g int, k int, w bigint, s bigint")
        got = {x.k: x.quota for x in mixing.apportion(table, ["g"], ["k"], "w", "s").collect()}
        quota = [0] * 30
        for _ in range(seats):
            best = max(range(30), key=lambda i: (weights[i] / (2 * quota[i] + 1), weights[i], -i))
            quota[best] += 1
        assert [got[i] for i in range(30)] == quota


def test_shards(docs, rows, empty):
    got = sharding.shards(docs, 4).collect()
    texts = {r[0]: r[1] for r in rows}
    sizes, slots, of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").encode()) + 16
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of[texts[r.doc_id] or ""].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())
    assert len(got) == len(rows) and set(sizes) <= set(range(4))
    assert sharding.shards(empty, 4).count() == 0


def test_packing_is_even_and_spares_large_items():
    r = random.Random(12)
    sizes = sorted([r.randint(1, 900) for _ in range(800)], reverse=True)
    bins = defaultdict(int)
    for size, b in zip(sizes, sharding.pack(sizes, 10)):
        bins[b] += size
    assert len(bins) == 10 and max(bins.values()) - min(bins.values()) <= 0.002 * max(bins.values())
    bins = defaultdict(int)
    for size, b in zip([10**6, *sizes], sharding.pack([10**6, *sizes], 10)):
        bins[b] += size
    rest = sorted(bins.values())[:-1]
    assert max(bins.values()) == 10**6 and max(rest) - min(rest) <= 0.002 * max(rest)


def test_best_fit_takes_the_tightest_room():
    assert sharding.best_fit([7, 6, 3, 3, 1], 10) == [0, 1, 0, 1, 1]
    assert sharding.best_fit([7, 6, 5], 10, 2) is None


PAGE = """<html><head><title>No</title><style>p{x}</style></head><body><header><a href=/>Home</a> Site</header>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div class="cookie-notice">We use cookies on this site.</div>
<article><h1>A &amp; B</h1><p>It was the  best\n of the times and it was <b>the</b> worst<br>of them, as all of us said to one
another.<p>Short.<script>var a="</p>";</script><p>And so the days of the year went on, as they had done for all of the
others that were before.</article><form><p>Your name</p></form><div id=comments><p>I was the first of all of you to say
it.</p></div><footer>&copy; all of the rights</footer></body></html>"""


def test_main_text(spark):
    want = "\n".join([
        "A & B", "It was the best of the times and it was the worst of them, as all of us said to one another.", "Short.",
        "And so the days of the year went on, as they had done for all of the others that were before.",
    ])
    bare = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    pages = [(1, PAGE, "x"), (2, None, "x"), (3, "", None), (4, bare, "x"), (5, "plain text", "x"), (6, PAGE, "x"), (7, "<p>" * 5000, "y"), (8, "<p>&#x;&#0;&bad;<![CDATA[x]]><", "y")]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(pages, "page_id int, html string, text string")).collect()}
    assert got[1].text == got[6].text == got[4].text == want and got[1].n_chars == len(want)
    assert got[2].text == got[3].text == got[7].text == "" and got[2].n_chars == 0
    assert html.extract(spark.createDataFrame([], "page_id int, html string")).count() == 0


def test_neighbours_decide():
    g, b, o = html.GOOD, html.BAD, html.OPEN
    assert html.settle([g, o, o, b, o], [b] * 5) == [g, g, b, b, b]
    assert html.settle([g, o, b], [g, g, g]) == [g, g, b]
    assert html.settle([o, o], [g, b]) == [g, b]
