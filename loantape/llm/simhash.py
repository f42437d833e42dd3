"""SimHash near-duplicates, found by meet-in-the-middle ball hashing.

Two fingerprints that differ in ``radius`` bits or fewer both lie within half of that of some third
one. Every distinct fingerprint emits all variants within half the radius; the shuffle on variants
brings near ones together, and a link is kept once its bits have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loantape.llm.components import components
from loantape.llm.store import give_back, prepare, stored

SEED = 42
# Shingles hashed at a time, so that a very long text does not need its whole bit matrix at once.
SLICE = 1 << 15


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits, each the majority of that bit among the hashes of the shingles; zero without words."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return 0
    last = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, np.int64)
    for low in range(0, last, SLICE):
        shingles = (b" ".join(tokens[i : i + words]) for i in range(low, min(last, low + SLICE)))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit integer, per row of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def fingerprint_column(text_col: str, words: int = 3) -> Column:
    """The fingerprint of a text as 16 hex digits, as an expression."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: f"{fingerprint(t, words):016x}")

    return run(F.coalesce(F.col(text_col), F.lit("")))


def ball(radius: int, bits: int = 64) -> list[int]:
    """The masks of ``radius`` bits or fewer, as signed integers; the first is zero."""
    masks = [
        sum(1 << b for b in chosen) for n in range(radius + 1) for chosen in combinations(range(bits), n)
    ]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def close_pairs(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs ``a``, ``b`` of different fingerprints that connect everything within ``radius`` bits,
    an even number.

    ``prints`` has one column ``fp`` of distinct fingerprints. Two members of one variant's group
    are never further apart than the radius, so neighbours in sorted order connect the whole group,
    which has no more members than the ball.
    """
    if radius % 2:
        raise ValueError("radius must be even")
    masks = F.array(*map(F.lit, ball(radius // 2)))
    variant = F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m)))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = prints.select("fp", variant.alias("variant")).select(
        before.alias("a"), F.col("fp").alias("b")
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return pairs.where("a is not null").distinct().where(near)


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that links
    reach, itself included, per row of ``docs``; no other column is read.

    Documents with equal fingerprints form one class before anything is linked. A text that is null
    or has no words has fingerprint zero and is linked like any other. Repeated rows and repeated
    ids each give their row. A row with a null id takes part in its class and gets the component of
    that class, null if nobody there has an id. An empty table gives an empty table.
    """
    rows = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    links = close_pairs(classes.select("fp"), radius)
    named = components(links)
    # Roots are the smallest fingerprint of a component; the answer is its smallest id.
    placed = classes.join(named, classes["fp"] == named["node"], "left").select(
        "fp", "lowest", F.coalesce("root", "fp").alias("root")
    )
    placed = stored(placed, "classes")
    lowest = placed.groupBy(F.col("root").alias("top")).agg(F.min("lowest").alias("component_id"))
    by_print = stored(
        placed.join(lowest, placed["root"] == lowest["top"]).select(F.col("fp").alias("key"), "component_id"),
        "components",
    )
    return rows.join(by_print, rows["fp"] == by_print["key"]).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
