"""Hard negatives by a vertical scan of the dimensions (branch and bound on decomposed vectors).

Rows are packed where they are read into blocks that hold one column per dimension, with the least
and largest value of each. For an anchor, a block's columns are read in the order of the anchor's
magnitudes, the largest first. After every few columns the least and the most that the columns still
unread can add are known, so each candidate's score lies between two bounds; whoever cannot reach a
window of scores any more leaves the candidate bitmap. What is left after the last column has its
exact score. Windows shrink as rows are met: once enough are known, their last score is the bar.

The anchors are a stated query set, compared with all rows in blocks: blocks of anchors go to parts
of the row blocks, and their number grows with the square root of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loantape.llm.store import prepare, stored

# Bytes of a block's columns, and anchors that look through it together.
BLOCK_BYTES = 1 << 20
ANCHOR_ROWS = 64
# Share of the columns read before the first look at the bounds, which can rule out little so far, and
# columns read between later ones.
FIRST = 5 / 8
STEP = 8
# There are as many parts as the square root of so many rows each.
PART_ROWS = 256
# Rows kept by a task for its anchors before it gives them out and starts anew.
KEPT_ROWS = 1 << 18
FAR = 1 << 62

BLOCK = pa.schema([
    ("block", pa.int64()), ("dims", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("names", pa.list_(pa.string())),
    ("codes", pa.binary()), ("columns", pa.binary()), ("wide", pa.bool_()),
])
BLOCK_SQL = "block bigint, dims int, n int, ids binary, names array<string>, codes binary, columns binary, wide boolean"
MET = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("positive_score", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
MET_SQL = "block bigint, i int, positive_score bigint, id bigint, score bigint"


def grid(vector: list | None, scale: int) -> np.ndarray | None:
    """The integer components, ``None`` where there are none: of a null vector, one with null or
    non-finite components, or one so large that an inner product may not fit in 63 bits."""
    if vector is None or any(x is None for x in vector):
        return None
    row = np.floor(scale * np.asarray(vector, np.float64))
    if not np.isfinite(row).all() or np.abs(row).max(initial=0.0) > math.isqrt(FAR // max(1, len(row))):
        return None
    return row.astype(np.int64)


def _pack(scale: int, block_rows: int | None):
    """Rows of (id, label, vector) to blocks; rows that take no part are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        open_: dict[int, list] = {}

        def close(dims: int) -> pa.RecordBatch:
            nonlocal number
            ids, labels, rows = zip(*open_.pop(dims))
            matrix = np.array(rows, np.int64).reshape(len(ids), dims).T
            wide = bool(np.abs(matrix).max(initial=0) >= 1 << 31)
            names, codes = np.unique(np.array(labels, object).astype(str), return_inverse=True)
            by_label = np.argsort(codes, kind="stable")
            codes, ids, matrix = codes[by_label], np.array(ids, np.int64)[by_label], matrix[:, by_label]
            columns = np.ascontiguousarray(matrix, np.int64 if wide else np.int32).tobytes()
            made = (number, dims, len(ids), ids.tobytes(), names.tolist(), codes.astype(np.int32).tobytes(), columns, wide)
            number += 1
            return pa.record_batch([pa.array([x], f.type) for x, f in zip(made, BLOCK)], schema=BLOCK)

        for batch in batches:
            for row_id, label, vector in zip(*(c.to_pylist() for c in batch.columns)):
                row = grid(vector, scale)
                if row is None:
                    continue
                held = open_.setdefault(len(row), [])
                held.append((row_id, label, row))
                if len(held) >= (block_rows or max(16, BLOCK_BYTES // (4 * max(1, len(row))))):
                    yield close(len(row))
                elif sum(map(len, open_.values())) > 1 << 16:
                    # Very many different lengths: the fullest block goes out early.
                    yield close(max(open_, key=lambda d: len(open_[d])))
        for dims in list(open_):
            yield close(dims)

    return run


class Block:
    """A block read again: ids, labels in order, and one row of ``columns`` per dimension."""

    def __init__(self, dims: int, n: int, ids: bytes, names: list[str], codes: bytes, columns: bytes, wide: bool) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.names = names
        self.codes = np.frombuffer(codes, np.int32)
        # Rows come by label, so those of one label are a range.
        self.starts = np.searchsorted(self.codes, np.arange(len(names) + 1))
        self.columns = np.frombuffer(columns, np.int64 if wide else np.int32).reshape(dims, n)
        self.least = self.columns.min(1, initial=FAR if wide else (1 << 31) - 1).astype(np.int64)
        self.most = self.columns.max(1, initial=-FAR if wide else -(1 << 31)).astype(np.int64)
        self.reach = max(int(np.abs(self.least).max(initial=0)), int(np.abs(self.most).max(initial=0)))
        self._as: dict[type, np.ndarray] = {}

    def exact(self, anchor: np.ndarray) -> np.ndarray:
        """The columns in the smallest type that holds all partial scores exactly: whole numbers are
        exact in floating point below 2**24 and 2**53, and their products are much faster."""
        bound = len(anchor) * int(np.abs(anchor).max(initial=0)) * self.reach
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        if kind not in self._as:
            self._as[kind] = self.columns.astype(kind)
        return self._as[kind]

    def labelled(self, name: str) -> slice:
        if name not in self.names:
            return slice(0, 0)
        code = self.names.index(name)
        return slice(int(self.starts[code]), int(self.starts[code + 1]))


def vertical_scan(block: Block, anchor: np.ndarray, bitmap: np.ndarray, windows: list[tuple[int, int]], span: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows of ``span`` that are set in ``bitmap`` and whose score lies
    between the lowest and the highest of the windows' ends."""
    dims, first = len(anchor), span.start or 0
    columns = block.exact(anchor)[:, span]
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order].astype(columns.dtype)
    one, two = anchor * block.least, anchor * block.most
    # What the columns from each place on can add at most and at least.
    above = [*np.cumsum(np.maximum(one, two)[order][::-1])[::-1].tolist(), 0]
    below = [*np.cumsum(np.minimum(one, two)[order][::-1])[::-1].tolist(), 0]
    lowest, highest = min(w[0] for w in windows), max(w[1] for w in windows)
    read = min(dims, max(STEP, int(FIRST * dims)))
    scores = a[:read] @ columns[order[:read]]
    at, rest = None, None
    while True:
        left = (scores >= lowest - above[read]) & (scores <= highest - below[read])
        if at is None:
            at = np.flatnonzero(left & bitmap[span])
            scores = scores[at]
            # What is left of the columns, in the order they are read.
            rest, begun = np.take(columns[order[read:]], at, axis=1), read
        elif not left.all():
            at, scores, rest = at[left], scores[left], rest[:, left]
        if read == dims or not len(at):
            return at + first, scores.astype(np.int64)
        scores = scores + a[read : read + STEP] @ rest[read - begun : read - begun + STEP]
        read = min(read + STEP, dims)


class Best:
    """The first few rows of each window, larger scores and then smaller ids first."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def bar(self, key: tuple) -> int:
        """The least score that can still enter."""
        held = self.held.get(key)
        return -FAR if held is None or len(held[0]) < self.most else int(held[0][-1])

    def add(self, key: tuple, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(ids):
            return
        if key in self.held:
            scores, ids = np.r_[self.held[key][0], scores], np.r_[self.held[key][1], ids]
        if len(ids) > 4 * self.most:
            enough = scores >= np.partition(scores, len(scores) - self.most)[len(scores) - self.most]
            scores, ids = scores[enough], ids[enough]
        first = np.lexsort((ids, -scores))[: self.most]
        self.held[key] = scores[first], ids[first]

    def __len__(self) -> int:
        return len(self.held) * self.most

    def give(self) -> pa.RecordBatch:
        rows = [(*key, int(x), int(s)) for key, (scores, ids) in self.held.items() for s, x in zip(scores, ids)]
        self.held = {}
        columns = list(zip(*rows)) if rows else [()] * len(MET)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, MET)], schema=MET)


def _look(most: int, low: int | None, high: int | None):
    """Pairs of an anchor block and a row block to the first rows of each window. Without ``low`` and
    ``high`` the window is all other rows of the anchor's label; with them, per score of a positive,
    the rows of other labels whose score is so many percent of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(most)
        kept: dict[str, tuple] = {}

        def block(side: str, row: dict) -> Block:
            if side not in kept or kept[side][0] != row[f"{side}_block"]:
                kept[side] = row[f"{side}_block"], Block(*(row[f"{side}_{f.name}"] for f in BLOCK if f.name != "block"))
            return kept[side][1]

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                anchors, rows = block("a", row), block("r", row)
                name = row["a_block"]
                if low is None:
                    wanted = [(j, [0]) for j in range(len(anchors.ids))]
                else:
                    wanted = [(w["i"], w["scores"]) for w in row["a_windows"]]
                for j, scores in wanted:
                    same = rows.labelled(anchors.names[anchors.codes[j]])
                    if low is None:
                        windows, span = [(best.bar((name, j, 0)), FAR)], same
                        bitmap = rows.ids != anchors.ids[j]
                    else:
                        windows, span = [(max(-(-low * s // 100), best.bar((name, j, s))), high * s // 100) for s in scores], slice(None)
                        bitmap = np.ones(len(rows.ids), bool)
                        bitmap[same] = False
                    if not bitmap[span].any():
                        continue
                    at, found = vertical_scan(rows, anchors.columns[:, j].astype(np.int64), bitmap, windows, span)
                    for s, (lowest, highest) in zip(scores, windows) if len(at) else ():
                        inside = (found >= lowest) & (found <= highest)
                        best.add((name, j, s), found[inside], rows.ids[at[inside]])
            if len(best) > KEPT_ROWS:
                yield best.give()
        yield best.give()

    return run


def _first(met: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``: for each anchor and each of its first ``positives`` other rows of its label,
    the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the
    positive's. ``anchors`` is a condition on ``vectors``.

    A score is the inner product of components floored at ``scale`` to whole numbers, exact; larger
    scores come first, then smaller ids. Rows without id, label or vector, or with a null or
    non-finite component, take no part, nor do those with components so large that a product could
    leave 63 bits. Only vectors of one length are compared. Rows that repeat an id are rows of their
    own, so each takes its rank, but none is the positive of an anchor of its id. An anchor with
    nothing to return has no row; an empty table gives an empty table.
    """
    spark = prepare(vectors.sparkSession)
    col = lambda name: F.col(f"`{name}`")
    rows = vectors.withColumn("__anchor", anchors).select(
        col(id_col).cast("bigint").alias("id"), col(label_col).cast("string").alias("label"), col(vector_col).alias("vector"), "__anchor"
    ).where("id is not null and label is not null and vector is not null")
    blocks = stored(rows.drop("__anchor").mapInArrow(_pack(scale, None), BLOCK_SQL), "blocks")
    asking = stored(rows.where("__anchor").drop("__anchor").mapInArrow(_pack(scale, ANCHOR_ROWS), BLOCK_SQL), "anchors")
    n_blocks, n_rows = blocks.agg(F.count(F.lit(1)), F.sum("n")).first()
    parts = max(1, min(n_blocks, math.ceil(math.sqrt((n_rows or 0) / PART_ROWS))))
    held = blocks.select(*[F.col(c).alias(f"r_{c}") for c in blocks.columns], F.pmod(F.xxhash64("block"), F.lit(parts)).alias("r_part"))

    def look(asking: DataFrame, *how) -> DataFrame:
        sides = asking.select(*[F.col(c).alias(f"a_{c}") for c in asking.columns])
        sides = sides.withColumn("a_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
        met = sides.join(held, (F.col("a_part") == F.col("r_part")) & (F.col("a_dims") == F.col("r_dims")))
        return met.mapInArrow(_look(*how), MET_SQL)

    near = _first(look(asking, positives, None, None), ["block", "i"], positives)
    near = stored(near.select("block", "i", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = near.groupBy("block", "i").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    windows = scores.groupBy(F.col("block").alias("b")).agg(F.sort_array(F.collect_list(F.struct("i", "scores"))).alias("windows"))
    bounded = asking.join(windows, F.col("block") == F.col("b")).drop("b")
    far = _first(look(bounded, negatives, low, high), ["block", "i", "positive_score"], negatives)
    far = far.select(F.col("block").alias("b"), F.col("i").alias("j"), F.col("positive_score").alias("s"), "id", "score", "rank")
    names = asking.select(F.col("block").alias("nb"), "ids").mapInArrow(_ids, "nb bigint, ni int, anchor_id bigint")
    return (
        near.join(far, (F.col("block") == F.col("b")) & (F.col("i") == F.col("j")) & (F.col("positive_score") == F.col("s")))
        .join(names, (F.col("block") == F.col("nb")) & (F.col("i") == F.col("ni")))
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids in zip(*(c.to_pylist() for c in batch.columns)):
            found = np.frombuffer(ids, np.int64)
            made = [pa.array(np.full(len(found), block)), pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)]
            yield pa.record_batch(made, ["nb", "ni", "anchor_id"])
