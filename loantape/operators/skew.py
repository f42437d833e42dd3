"""Measuring and splitting groups that are too large for one task."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# About 100 bytes per row of ids once hashed, so some 100 MB per executor at most.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
COPIES = "__copies"
COPIES_PER_ROW = 1_000_000
# Rows of large groups that one task ranks.
RANGE_ROWS = 1_000_000
# Groups of at most so many pieces, and of at most so many rows, are gathered whole and cut then.
WHOLE_PIECES = 8
WHOLE_ROWS = 4096


@lru_cache(maxsize=None)
def _local_dir(app: str) -> str:
    return tempfile.mkdtemp(prefix="loantape-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Raises where it is not set, except in one process (``local[n]``), which has a folder of its own.
    """
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_dir(context.applicationId)


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, stored in the shared folder, so that recomputing cannot change them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As ``checkpointed``, as Parquet, which takes a fraction of the disk."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_none(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """A hint to broadcast if the table is counted within both bounds, the plain table beyond them,
    ``None`` if it is empty. Counts no further than one row past the bound."""
    n_rows, fits = _measured(df, max_rows, max_bytes)
    if n_rows == 0:
        return None
    return F.broadcast(df) if fits else df


def is_small(df: DataFrame) -> bool:
    """Is the table counted within the bounds of a broadcast? For stored tables, as it reads them."""
    return _measured(df, BROADCAST_ROWS, BROADCAST_BYTES)[1]


def _measured(df: DataFrame, max_rows: int, max_bytes: int) -> tuple[int, bool]:
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
        for f in df.schema.fields
    ]
    size = widths[0].cast("bigint")
    for width in widths[1:]:
        size = size + width
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return found[0], found[0] <= max_rows and (found[1] or 0) <= max_bytes


def group_sizes(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def hot_groups(df: DataFrame, keys: Iterable[str], limit: int) -> DataFrame | None:
    """Keys and ``n_rows`` of the groups with more than ``limit`` rows, ``None`` if there are none.

    Runs one count that combines before its shuffle. The answer is stored, as it decides how the
    rest of a plan treats each group and must not change under it.
    """
    keys = list(keys)
    return small_or_none(checkpointed(group_sizes(df, keys).where(F.col("n_rows") > limit)))


def whole_rows(limit: int) -> int:
    """Rows of the largest groups that need no ranking across tasks to be cut into pieces of
    ``limit`` rows: some pieces, as long as that is no more than any task holds."""
    return max(limit, min(WHOLE_PIECES * limit, WHOLE_ROWS))


def cut_whole(df: DataFrame, keys: Iterable[str], name: str, limit: int) -> DataFrame:
    """Each group's array ``name`` in pieces of ``limit`` elements: ``part`` 0, 1, …"""
    starts = F.sequence(F.lit(0), F.size(name) - 1, F.lit(limit))
    pieces = F.transform(starts, lambda i: F.slice(name, i + 1, F.lit(limit)))
    # Not explode, for which the optimizer filters by the array's size before it is made.
    return df.select(*keys, F.posexplode_outer(pieces).alias("part", name))


def null_safe(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & left[k].eqNullSafe(right[k])
    return test


def collapse_copies(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct rows with their number of copies; equal rows meet before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))


def expand_copies(df: DataFrame, piece: int | None = None) -> DataFrame:
    """Undo ``collapse_copies``. With ``piece``, rows come out in pieces of at most that many copies
    instead, still collapsed, so that one row's copies can be spread over tasks."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != COPIES]
    if piece is None:
        numbers = F.sequence(F.lit(1), F.col(COPIES).cast("int"))
        return df.select(*rest, F.explode(numbers).alias("__i")).drop("__i")
    last = F.floor((F.col(COPIES) - 1) / piece)
    cut = df.select(*rest, COPIES, F.explode(F.sequence(F.lit(0), last)).alias("__piece"))
    left = F.col(COPIES) - F.col("__piece") * piece
    return cut.withColumn(COPIES, F.least(left, F.lit(piece).cast("bigint")))


def sort_rows(df: DataFrame, by: Iterable[str], copies: bool = False) -> DataFrame:
    """Global sort; ties are broken by all other columns, so rows of one key spread over ranges.

    Only exact copies of a row cannot be told apart. Where one row may make up a good part of the
    table, ``copies`` lets them travel collapsed, for one more shuffle; the order is the same.
    """
    by = list(by)
    rest = [c for c in df.columns if c not in by]
    if not copies:
        return df.orderBy(*by, *rest)
    pieces = expand_copies(collapse_copies(df, df.columns), COPIES_PER_ROW)
    return expand_copies(pieces.orderBy(*by, *rest, "__piece").drop("__piece"))


def rank_pieces(
    df: DataFrame,
    keys: Iterable[str],
    order: Column,
    item: Column,
    limit: int,
    n_rows: int = 0,
) -> DataFrame:
    """Rank the rows of large groups and cut each group into pieces of ``limit`` rows.

    Gives keys, ``part`` (from 0), ``order``, ``item`` and the number of copies of that item in
    that piece. No task sees a whole group: copies collapse before the shuffle, rows are spread by
    ranges of (keys, order, item), and ranks follow from the sizes of the ranges before. There are
    as many ranges as ``n_rows``, the rows to expect, ask for.
    """
    keys = list(keys)
    packed = df.select(*keys, order.alias("__order"), item.alias("__item"))
    rows = collapse_copies(packed, [*keys, "__order", "__item"])
    by = [*keys, "__order", "__item"]
    # Stored, because range bounds are drawn anew whenever a plan runs.
    n_ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_rows // RANGE_ROWS)
    ranged = rows.repartitionByRange(n_ranges, *by)
    ranged = stored(ranged.withColumn("__range", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys, "__range")
        .agg(F.sum(COPIES).alias("__size"))
        .select(
            *keys, "__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
        )
    )
    within = Window.partitionBy(*keys, "__range").orderBy("__order", "__item")
    local = ranged.withColumn(
        "__seen", F.sum(COPIES).over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    # Groups lie in ranges side by side, so there are about as many offsets as groups and ranges.
    known = small_or_none(offsets)
    near, far = local.alias("near"), (offsets if known is None else known).alias("far")
    match = F.col("near.__range") == F.col("far.__range")
    for k in keys:
        match = match & F.col(f"near.{k}").eqNullSafe(F.col(f"far.{k}"))
    ranked = near.join(far, match).select(
        "near.*", (F.col("__offset") + F.col("__seen") - F.col(COPIES)).alias("__start")
    )
    end = F.col("__start") + F.col(COPIES)
    first = F.floor(F.col("__start") / limit)
    last = F.floor((end - 1) / limit)
    cut = ranked.select("*", F.explode(F.sequence(first, last)).alias("__part"))
    low, high = F.col("__part") * limit, (F.col("__part") + 1) * limit
    return cut.select(
        *keys,
        F.col("__part").cast("int").alias("part"),
        F.col("__order").alias("order"),
        F.col("__item").alias("item"),
        (F.least(end, high) - F.greatest(F.col("__start"), low)).cast("int").alias(COPIES),
    )


def gather_pieces(pieces: DataFrame, keys: Iterable[str], name: str) -> DataFrame:
    """The ranked items of each piece as an array in order; at most one piece's rows per group."""
    keys = list(keys)
    packed = F.sort_array(F.collect_list(F.struct("order", "item", COPIES)))
    runs = F.transform(packed, lambda x: F.array_repeat(x["item"], x[COPIES]))
    return pieces.groupBy(*keys, "part").agg(F.flatten(runs).alias(name))
