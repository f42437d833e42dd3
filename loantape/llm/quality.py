"""Quality rules: counts over whole texts, and divergence from a reference of the language.

Everything is built-in functions on arrays within a row; only histograms per language are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loantape.llm.store import stored
from loantape.operators.skew import small_or_none

BLANKS = " \t\n\x0b\f\r"
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEATED_PERCENT = 20
# The commonest function words of some languages.
COMMON = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to a in is that for it as was with be by on not are this from".split(),
    "es": "de la que el en y a los se del las un por con no una para es al lo".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par au sur pas plus".split(),
    "it": "di e il la che in a per un del con non una le da si è i dei della".split(),
    "nl": "de van een het en in is dat op te zijn met voor die niet aan er om ook als".split(),
    "pt": "de a o que e do da em um para com não uma os no se na por mais as".split(),
}
# A text joins the test of characters from so many on, that of words from so many words on.
GUARD_CHARS = 200
GUARD_WORDS = 100
# Jensen-Shannon distances, in square roots of bits, above which a text is turned down. Ordinary
# prose lies below 0.2; texts in which every word carries a mark, or lists of rare words, lie beyond.
FAR_CHARS = 0.30
FAR_WORDS = 0.28
CLASSES = ["lower", "blank", "other", "upper", "digit", "point", "symbol"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though the body uses it in loops."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words covered by windows that the text holds twice or more.

    Windows are compared by a 64-bit hash of their words. Where all hashes differ, as in most texts,
    nothing more is done; else their sorted places give the windows that have an equal neighbour.
    """

    def covered(keys: Column) -> Column:
        places = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def doubled(s: Column) -> Column:
            last = F.size(s) - 1
            return F.filter(
                s,
                lambda x, i: (F.get(s, F.greatest(i - 1, F.lit(0)))["k"].eqNullSafe(x["k"]) & (i > 0))
                | (F.get(s, F.least(i + 1, last))["k"].eqNullSafe(x["k"]) & (i < last)),
            )

        found = F.sort_array(F.transform(_let(places, doubled), lambda x: x["i"]))

        def union(at: Column) -> Column:
            last = F.size(at) - 1
            steps = F.transform(
                at,
                lambda p, i: F.when(i < last, F.least(F.get(at, F.least(i + 1, last)) - p, F.lit(WINDOW))).otherwise(WINDOW),
            )
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, b: a + b)

        several = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.when(several, _let(found, union)).otherwise(F.lit(0).cast("bigint"))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    enough = F.size(words) > WINDOW
    return F.when(enough, _let(_let(words, windows), covered)).otherwise(F.lit(0).cast("bigint"))


def _histogram(words: Column, lang: Column) -> Column:
    """How often each common word of the language stands among the words, and all others."""
    lists = F.create_map(*[x for k, v in COMMON.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    every = sorted({w for v in COMMON.values() for w in v})
    lower = F.transform(words, lambda w: F.lower(w))
    common = F.filter(lower, lambda w: w.isin(every))

    def counted(found: Column) -> Column:
        each = F.transform(F.element_at(lists, lang), lambda w: F.size(found) - F.size(F.array_remove(found, w)))
        return each

    return F.when(lang.isin(sorted(COMMON)), _let(common, counted))


def measures(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """Per row: the counts, and the histograms of character classes and common words."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    trimmed = F.btrim("t", F.lit(BLANKS))
    # What is left after each class has gone; the first pass leaves a fraction of the text.
    rows = rows.withColumn("r1", F.regexp_replace("t", "[a-z]+", ""))
    rows = rows.withColumn("r2", F.regexp_replace("r1", BLANK, ""))
    rows = rows.withColumn("r3", F.regexp_replace("r2", r"\P{ASCII}+", ""))
    rows = rows.withColumn("r4", F.regexp_replace("r3", "[A-Z]+", ""))
    rows = rows.withColumn("r5", F.regexp_replace("r4", "[0-9]+", ""))
    rows = rows.withColumn("r6", F.regexp_replace("r5", r"""[.,;:!?'"()-]+""", ""))
    rows = rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK)))
    sizes = [F.length(c) for c in ("t", "r1", "r2", "r3", "r4", "r5", "r6")] + [F.lit(0)]
    classes = F.array(*[a - b for a, b in zip(sizes, sizes[1:])])
    symbols = F.length("r6") - F.length(F.translate("r6", SYMBOLS, ""))
    with_word = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    repeats = _let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("bigint").alias("n_words"),
        (F.length("t") - F.length("r1") + F.length("r2")).cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        repeats.cast("bigint").alias("n_dup_lines"),
        _repeated(F.col("words")).alias("n_repeat_words"),
        classes.alias("classes"),
        _histogram(F.col("words"), F.col("lang")).alias("common"),
    )


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda n: n / total)


def _mean(column: str, n: int) -> Column:
    return F.array(*[F.avg(F.get(column, F.lit(i))) for i in range(n)])


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two histograms of shares; null if either is null."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)
    return F.when(total.isNotNull(), F.sqrt(F.greatest(total / 2, F.lit(0.0))))


def judge(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``char_distance``, ``word_distance`` and ``kept``.

    The reference of a language is the mean histogram over all its texts that pass the base rules
    and the guards. A text shorter than a guard, one of a language without list or reference, or
    with none given, has a null distance there and is not turned down for it. A null text has no
    words. Rows without an id and repeated rows each get their answer; an empty table stays empty.
    """
    common = max(map(len, COMMON.values()))
    found = stored(measures(docs, id_col, text_col, lang_col), "measures")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    chars = F.aggregate("classes", F.lit(0), lambda a, b: a + b)
    long_chars = (chars >= GUARD_CHARS) & F.col("lang").isNotNull()
    long_words = (F.col("n_words") >= GUARD_WORDS) & F.col("common").isNotNull()
    listed = F.aggregate("common", F.lit(0), lambda a, b: a + b)
    rest = F.array((F.col("n_words") - listed).cast("int"))
    shared = found.select(
        "*",
        base.alias("base_failed"),
        F.when(long_chars, _shares(F.col("classes"), chars)).alias("p_chars"),
        F.when(long_words, _shares(F.concat("common", rest), F.col("n_words"))).alias("p_words"),
    )
    means = stored(
        shared.where("not base_failed and lang is not null")
        .groupBy(F.col("lang").alias("of"))
        .agg(_mean("p_chars", len(CLASSES)).alias("q_chars"), _mean("p_words", common + 1).alias("q_words")),
        "references",
    )
    side = small_or_none(means)
    judged = shared.join(means if side is None else side, F.col("lang") == F.col("of"), "left").select(
        "*",
        F.when(F.get("q_chars", F.lit(0)).isNotNull(), distance(F.col("p_chars"), F.col("q_chars"))).alias("char_distance"),
        F.when(F.get("q_words", F.lit(0)).isNotNull(), distance(F.col("p_words"), F.col("q_words"))).alias("word_distance"),
    )
    near = F.coalesce(F.col("char_distance") <= FAR_CHARS, F.lit(True)) & F.coalesce(
        F.col("word_distance") <= FAR_WORDS, F.lit(True)
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "char_distance", "word_distance", (~F.col("base_failed") & near).alias("kept"),
    )
