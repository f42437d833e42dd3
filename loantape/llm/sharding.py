"""Shards of nearly equal size by best-fit-decreasing packing of indivisible groups.

Rows of equal text form a group, which is never divided. Groups above a fraction of a shard are
items of their own; all smaller ones are gathered by hash into bundles of about that fraction. So
there are never more than a bounded number of items however many rows there are, and the items, not
the rows, are packed: in falling order, each into the bin with the tightest room that still fits,
found in a balanced tree of the rooms. Rows learn their shard from two joins with bounded tables.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loantape.llm.store import prepare, stored

# A shard has at most so many grains: at most 40 * 2 * GRAINS items are packed for 40 shards.
GRAINS = 500
OVERHEAD = 16
SLOT_ROWS = 4096


class Rooms:
    """Bins by remaining room in a treap: smallest room of at least a size, insertion, removal."""

    def __init__(self, seed: int = 1) -> None:
        self.random = np.random.default_rng(seed)
        self.root: list | None = None  # [key, priority, left, right]

    def add(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        node = [key, self.random.random(), None, None]
        self.root = self._join(self._join(left, node), right)

    def remove(self, key: tuple[int, int]) -> None:
        left, rest = self._split(self.root, key)
        _, right = self._split(rest, (key[0], key[1] + 1))
        self.root = self._join(left, right)

    def tightest(self, size: int) -> tuple[int, int] | None:
        node, best = self.root, None
        while node is not None:
            if node[0] >= (size, -1):
                best, node = node[0], node[2]
            else:
                node = node[3]
        return best

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, left, right):
        if left is None or right is None:
            return left or right
        if left[1] > right[1]:
            left[3] = self._join(left[3], right)
            return left
        right[2] = self._join(left, right[2])
        return right


def best_fit(sizes: list[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """Bin of each of the ``sizes``, which fall; ``None`` if they need more than ``bins`` bins."""
    rooms, out, opened = Rooms(), [], 0
    for size in sizes:
        found = rooms.tightest(size)
        if found is None:
            if opened == bins:
                return None
            found = (capacity, opened)
            opened += 1
        else:
            rooms.remove(found)
        out.append(found[1])
        rooms.add((found[0] - size, found[1]))
    return out


def pack(sizes: list[int], bins: int) -> list[int]:
    """Bin of each of the ``sizes``, which fall, into ``bins`` bins of nearly equal content.

    An item as large as an equal share of what is left gets a bin to itself. The rest is packed at
    the smallest capacity, to a ten-thousandth, at which best fit needs no more bins than there are.
    """
    out, total, first = [], sum(sizes), 0
    while first < len(sizes) and bins - first > 1 and sizes[first] * (bins - first) >= total:
        out.append(first)
        total -= sizes[first]
        first += 1
    rest, left = sizes[first:], bins - first
    if not rest:
        return out
    low = max(rest[0], ceil(total / left))
    step = max(1, low // 10_000)
    high, width = low, step
    placed = best_fit(rest, high, left)
    while placed is None:
        low, high, width = high + 1, high + width, width * 2
        placed = best_fit(rest, high, left)
    while high - low >= step:
        middle = (low + high) // 2
        tried = best_fit(rest, middle, left)
        if tried is None:
            low = middle + 1
        else:
            high, placed = middle, tried
    return out + [first + bin_ for bin_ in placed]


def shards(
    docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and 16), ``text_crc32``, ``shard`` and ``slot``, counted
    from 0 without gaps in each shard, per row of ``docs``; no other column is read.

    A null text has no bytes and is in the group of the empty text. Rows without an id and repeated
    rows are rows like any other. A group as large as a shard or larger stays whole and has a shard
    to itself; the others are then equal among themselves. An empty table gives an empty table.
    """
    spark = prepare(docs.sparkSession)
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.length(text) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("text_key"),
        ),
        "sizes",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    grain = max(1, total // (n_shards * GRAINS))
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("group_size"))
    groups = stored(groups, "groups")
    small = groups.where(F.col("group_size") <= grain)
    bundles = max(1, (small.agg(F.sum("group_size")).first()[0] or 0) // grain)
    bundle = F.pmod(F.xxhash64("text_key"), F.lit(bundles))
    # Bounded: no more than n_shards * GRAINS groups exceed a grain, nor are there more bundles.
    items = (
        groups.where(F.col("group_size") > grain)
        .select("text_key", F.lit(-1).cast("bigint").alias("bundle"), "group_size")
        .unionByName(
            small.groupBy(bundle.alias("bundle"))
            .agg(F.sum("group_size").alias("group_size"))
            .select(F.lit(None).cast("binary").alias("text_key"), "bundle", "group_size")
        )
        .toPandas()
    )
    order = sorted(
        range(len(items)),
        key=lambda i: (-int(items.group_size[i]), int(items.bundle[i]), bytes(items.text_key[i] or b"")),
    )
    placed = pack([int(items.group_size[i]) for i in order], n_shards)
    keys = [(bytes(items.text_key[i]) if items.text_key[i] is not None else None, int(items.bundle[i]), s) for i, s in zip(order, placed)]
    alone = spark.createDataFrame([(k, s) for k, b, s in keys if k is not None], "group_key binary, own int")
    together = spark.createDataFrame([(b, s) for k, b, s in keys if k is None], "bundle_no bigint, joint int")
    dealt = (
        rows.join(F.broadcast(alone), F.col("text_key") == F.col("group_key"), "left")
        .join(F.broadcast(together), bundle == F.col("bundle_no"), "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own", "joint").alias("shard"))
    )
    return numbered(dealt, max(1, ceil(rows.count() / SLOT_ROWS / n_shards)))


def numbered(dealt: DataFrame, parts: int) -> DataFrame:
    """``dealt`` with ``slot``, gapless from 0 in each ``shard``. Each shard's rows are split by a
    hash of the id over ``parts`` runs, and runs begin where the ones before them end."""
    run = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(parts))
    rows = dealt.withColumn("__run", run)
    before = Window.partitionBy("shard").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "__run")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("shard", "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    within = Window.partitionBy("shard", "__run").orderBy("doc_id", "size", "text_crc32")
    local = rows.withColumn("__place", F.row_number().over(within) - 1)
    return local.join(starts, ["shard", "__run"]).select(
        *dealt.columns, (F.col("__start") + F.col("__place")).cast("bigint").alias("slot")
    )
