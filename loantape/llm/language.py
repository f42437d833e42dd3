"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language on Spark and sums them by bucket; the matrix of log
probabilities, languages x buckets, is bounded by its shape and is broadcast. Scoring keeps a
batch's n-grams as one sparse matrix in rows (bucket numbers and row starts) and multiplies it with
the dense one in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loantape.llm.store import drop_caches, other_columns, prepare

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
# Labelled training documents per language, in expectation; all of them where there are fewer.
SAMPLE = 4000
SAMPLE_PARTS = 16
SLICE = 1 << 20
UNKNOWN = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(40)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _codes(text: str) -> np.ndarray:
    """Lower-case code points, every run of anything but letters as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    if len(codes):
        kept[0] = True
    return np.where(letter, codes, 32)[kept].astype(np.uint64)


def grams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a text between two blanks, some slices for a long one."""
    carry = np.zeros(0, np.uint64)
    for low in range(0, len(text), SLICE):
        fresh = _codes(text[low : low + SLICE])
        ends = [np.full(1, 32, np.uint64)]
        head = ends if low == 0 else []
        tail = ends if low + SLICE >= len(text) else []
        codes = np.concatenate([*head, carry, fresh, *tail])
        codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]
        found, mixed = [], np.zeros(len(codes), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            mixed = (mixed[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(1)) * _STEP
            mixed ^= mixed >> np.uint64(29)
            if n in ORDERS:
                # What lies wholly in the carried characters was counted with the slice before.
                skip = max(0, len(carry) - n + 1) if low else 0
                found.append((mixed[skip:] >> _SHIFT).astype(np.int64) % BUCKETS)
        carry = codes[-(max(ORDERS) - 1) :]
        yield np.concatenate(found)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            into = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for ids in grams(text.as_py()):
                into += np.bincount(ids, minlength=BUCKETS)
    for lang, counts in totals.items():
        there = np.nonzero(counts)[0]
        yield pa.record_batch(
            [pa.array([lang] * len(there), pa.string()), pa.array(there), pa.array(counts[there])],
            ["lang", "bucket", "n"],
        )


def _hash01(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << 30)) / F.lit(float(1 << 30))


def train(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", sample: int = SAMPLE):
    """Languages in order and their log probabilities, (buckets, languages); ``None`` without any.

    ``docs`` holds the training rows. Rows without language or text are left out. Of each language,
    rows enter whose hashed id falls below ``sample`` over the number of its rows, so about
    ``sample`` of them, the same ones each time. All languages get the same prior.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample / n)).otherwise(share)
    chosen = rows.where(_hash01(F.col("doc_id")) < share).select("lang", "text")
    counted = chosen.repartition(SAMPLE_PARTS).mapInArrow(_count, "lang string, bucket bigint, n bigint")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sizes)
    counts = np.full((BUCKETS, len(langs)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(langs)}
    np.add.at(counts, (table["bucket"].to_numpy(np.int64), table["lang"].map(place).to_numpy(np.int64)), table["n"].to_numpy(np.float64))
    return langs, np.log(counts / counts.sum(0))


def score(texts: list[str | None], langs: list[str], logp: np.ndarray) -> tuple[list[str], list[float]]:
    """Best language and its posterior probability per text; ties go to the first in order."""
    totals = np.zeros((len(texts), len(langs)))
    rows: list[int] = []
    parts: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if parts:
            starts = np.cumsum([0, *map(len, parts[:-1])])
            np.add.at(totals, rows, np.add.reduceat(logp[np.concatenate(parts)], starts, axis=0))
        rows.clear()
        parts.clear()
        held = 0

    known = [has_letter(t) for t in texts]
    for row, text in enumerate(texts):
        if known[row]:
            for ids in grams(text):
                rows.append(row)
                parts.append(ids)
                held += len(ids)
                if held * len(langs) > SLICE:
                    flush()
    flush()
    best = totals.argmax(1)
    top = totals.max(1, keepdims=True)
    sure = 1 / np.exp(totals - top).sum(1)
    return (
        [langs[b] if k else UNKNOWN for b, k in zip(best, known)],
        [float(s) if k else 0.0 for s, k in zip(sure, known)],
    )


def identify(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), replacing columns of these names.

    A text that is null or has no letter gets ``und`` and 0; without a model (no labelled rows) every
    text does. Reads the text alone. Repeated rows each get their answer; an empty table stays empty.
    """
    spark = prepare(docs.sparkSession)
    found = "struct<lang_pred:string,score:double>"
    if model is None:
        answer = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        langs = list(model[0])
        logp = spark.sparkContext.broadcast(np.asarray(model[1], np.float64))

        @F.arrow_udf(found)
        def best(texts: pa.Array) -> pa.Array:
            drop_caches()
            pred, sure = score(texts.to_pylist(), langs, logp.value)
            return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(sure)], ["lang_pred", "score"])

        # Else a filter on the answer is pushed below it and every text is scored twice.
        answer = best.asNondeterministic()(F.col(f"`{text_col}`"))
    kept = other_columns(docs, ["lang_pred", "score"])
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), answer.alias("made"))
    return held.select(*[F.col(f"row.`{c}`") for c in kept], "made.lang_pred", "made.score")


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that training never sees: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
