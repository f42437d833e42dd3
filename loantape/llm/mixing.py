"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Sources get integer quotas of blocks by highest quotients of their targets; each source's quota is
dealt on the same way to its shards, cells of documents drawn by a seeded hash. Within a cell the
documents stand in seeded order as one run of words, cut into blocks. A quota takes all blocks as
often as it covers them and, of the rest, every block where a seeded count with the quota as its
step passes an integer, which is exactly as many blocks as are due.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loantape.llm.store import stored
from loantape.operators.skew import small_or_none

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BLANKS = " \t\n\x0b\f\r"
SHARE = 1.5
MOST = 2
BLOCK = 8
SEED = 20_240_101
# Documents per cell; more where there would otherwise be more than so many cells.
CELL_ROWS = 256
CELLS = 100_000


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST, weights=WEIGHTS) -> DataFrame:
    """``sources`` (``source``, ``source_size``, ...) with ``source_no`` and ``target``.

    The weights repeat over the sources in order of code points, null last. A target stops at
    ``most`` times its source's size; the excess is shared again by weight until none is above. That
    ends where every source has the lesser of its cap and one level times its weight. With the
    sources in order of cap per weight, the level is the largest of: what is left once the sources
    before are full, over the weights from there on.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1)
    named = sources.withColumn("source_no", number).withColumn("weight", weight)
    named = named.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    full = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) * F.lit(share) - full) / open_
    levelled = named.withColumn("level", level)
    filled = F.least("cap", F.max("level").over(everything) * F.col("weight"))
    return levelled.withColumn("target", filled).drop("weight", "cap", "level")


def apportion(table: DataFrame, group: list[str], key: list[str], weight: str, seats: str) -> DataFrame:
    """``group``, ``key`` and ``quota``: ``seats`` (one number per group) dealt by Sainte-Laguë.

    A seat is worth the weight over 1, 3, 5, ...; the most valuable ones are dealt, equal ones by
    weight and then key. With k keys and n seats, the last seat dealt is worth between half the
    weights over n + k/2 and half the weights over n - k/2. What is worth more is dealt at once, and
    only the seats in between, two per key on average, are ranked.
    """
    within = Window.partitionBy(*group)
    total = F.sum(weight).over(within)
    half = F.sum(F.when(F.col(weight) > 0, 0.5).otherwise(0.0)).over(within)
    sized = table.select(
        *group, *key, F.col(weight).cast("double").alias("__w"), F.col(seats).alias("__seats"),
        total.cast("double").alias("__total"), half.alias("__half"),
    )
    share = F.col("__w") / F.greatest("__total", F.lit(1e-300))
    sure = F.floor(share * F.greatest(F.col("__seats") - F.col("__half"), F.lit(0.0)) + 0.5 - 1e-9)
    most = F.floor(share * (F.col("__seats") + F.col("__half")) + 0.5 + 1e-9)
    sized = sized.withColumn("__sure", F.when(F.col("__w") > 0, F.greatest(sure, F.lit(0))).otherwise(0).cast("bigint"))
    sized = sized.withColumn("__most", F.when(F.col("__w") > 0, F.greatest(most, "__sure")).otherwise(0).cast("bigint"))
    sized = sized.withColumn("__left", F.col("__seats") - F.sum("__sure").over(within))
    seat = F.when(F.col("__most") > F.col("__sure"), F.sequence(F.col("__sure"), F.col("__most") - 1))
    doubtful = sized.select(*group, *key, "__w", "__left", F.explode(seat).alias("__seat"))
    value = F.col("__w") / (2 * F.col("__seat") + 1)
    rank = F.row_number().over(within.orderBy(value.desc(), F.col("__w").desc(), *key))
    won = (
        doubtful.withColumn("__rank", rank)
        .where("__rank <= __left")
        .groupBy(*group, *key)
        .agg(F.count(F.lit(1)).alias("__won"))
    )
    return sized.join(won, [*group, *key], "left").select(
        *group, *key, (F.col("__sure") + F.coalesce("__won", F.lit(0))).alias("quota")
    )


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of integers, exact."""
    return F.call_function("div", a, b)


def _words_before(position: Column, block: int) -> Column:
    """Words taken among the first ``position`` of a cell, in the pass that takes some blocks."""
    at = _div(position, F.lit(block))

    def taken(blocks: Column) -> Column:
        return _div(blocks * F.col("__rest") + F.col("__phase"), F.col("__blocks"))

    here = taken(at + 1) - taken(at)
    return taken(at) * block + here * (position - at * block)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``size`` in words, ``source``, ``source_size``, ``target`` (the source's) and
    ``taken``, the words the mix takes, repeats counted, per row of ``docs``.

    A null text has size 0; a null source is a source of its own, the last. A document is taken
    twice at most, in whole or in part. Rows that agree in id, source and text are interchangeable:
    which of them gets which share is open, the shares are not. Rows without an id are dealt by their
    texts. An empty table stays empty, and a table without words takes none.
    """
    rows = stored(_sized(docs, id_col, text_col, source_col), "sizes")
    placed = _placed(rows, weights, share, most, block, seed)
    part = _words_before(F.col("__end"), block) - _words_before(F.col("__end") - F.col("size"), block)
    taken = F.col("__passes") * F.col("size") + part
    return placed.select(
        "doc_id", "size", "source", "source_size", "target", taken.cast("bigint").alias("taken")
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken whole, and once more with the
    words of the blocks that are taken of it, each with the blanks after it. Rows that nothing is
    taken of are gone, so the words of the result are what ``mix`` counts."""
    sized = _sized(docs, id_col, text_col, source_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    placed = _placed(sized, weights, share, most, block, seed)
    start = F.col("__end") - F.col("size")
    part = _words_before(F.col("__end"), block) - _words_before(start, block)
    held = placed.select("row", "size", "__passes", "__end", "__rest", "__phase", "__blocks", part.alias("__part"))
    # A part that is the whole counts as one more pass.
    whole = F.col("__passes") + F.when(F.col("__part") == F.col("size"), 1).otherwise(0)
    some = (F.col("__part") > 0) & (F.col("__part") < F.col("size"))
    times = F.concat(
        F.array_repeat(F.lit(True), whole.cast("int")), F.when(some, F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>"))
    )
    copies = held.where(F.col("size") > 0).select("*", F.explode(times).alias("__whole"))
    text = F.col(f"row.`{text_col}`")
    words = F.split(F.ltrim(text, F.lit(BLANKS)), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")

    def chosen(word: Column, i: Column) -> Column:
        at = _div(start + i, F.lit(block))
        before = _div(at * F.col("__rest") + F.col("__phase"), F.col("__blocks"))
        return _div((at + 1) * F.col("__rest") + F.col("__phase"), F.col("__blocks")) > before

    cut = F.rtrim(F.array_join(F.filter(words, chosen), ""), F.lit(BLANKS))
    made = copies.select("row", F.when(F.col("__whole"), text).otherwise(cut).alias("taken"))
    return made.select(
        *[F.col("taken").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    )


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, row: Column | None = None) -> DataFrame:
    words = F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(words, F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("__print"),
        *([] if row is None else [row.alias("row")]),
    )


def _placed(rows: DataFrame, weights, share: float, most: int, block: int, seed: int) -> DataFrame:
    """``rows`` with where they end in their cell's run of words, the cell's number of blocks, the
    passes that take all of them, and the rest and phase of the one that takes some."""
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__n")
    )
    with_target = stored(targets(sources, share, most, weights), "targets")
    words, n = with_target.agg(F.sum("source_size"), F.sum("__n")).first()
    blocks = int((words or 0) * share / block + 0.5)
    per_cell = max(CELL_ROWS, -(-(n or 0) // CELLS))
    dealt = apportion(
        with_target.withColumn("__all", F.lit(0)).withColumn("__seats", F.lit(blocks).cast("bigint")),
        ["__all"], ["source_no"], "target", "__seats",
    )
    known = stored(
        with_target.join(dealt, "source_no").select(
            F.col("source").alias("__name"), "source_no", "source_size", "target", F.col("quota").alias("__quota"),
            F.ceil(F.col("__n") / per_cell).cast("bigint").alias("__cells"),
        ),
        "sources",
    )
    side = small_or_none(known)
    named = rows.join(known if side is None else side, F.col("source").eqNullSafe(F.col("__name")))
    # By the text as well, so that rows without id, or of one id, are dealt to all cells.
    named = named.withColumn("__cell", F.pmod(F.xxhash64("doc_id", "__print", F.lit(seed)), F.col("__cells")))
    sizes = named.groupBy("source_no", "__cell").agg(
        F.sum("size").alias("__cell_size"), F.first("__quota").alias("__quota")
    )
    sizes = stored(sizes, "cells")
    quotas = sizes.join(
        apportion(sizes, ["source_no"], ["__cell"], "__cell_size", "__quota"), ["source_no", "__cell"]
    ).select("source_no", "__cell", "__cell_size", F.col("quota").alias("__due"))
    order = Window.partitionBy("source_no", "__cell").orderBy(
        F.xxhash64("doc_id", "__print", F.lit(seed + 1)), "doc_id", "__print", "size"
    )
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = named.withColumn("__end", end).join(quotas, ["source_no", "__cell"])
    blocks_here = F.greatest(F.ceil(F.col("__cell_size") / block).cast("bigint"), F.lit(1))
    placed = placed.withColumn("__blocks", blocks_here)
    due = F.least(F.col("__due"), F.col("__blocks") * int(most))
    phase = F.pmod(F.xxhash64("source_no", "__cell", F.lit(seed)), F.col("__blocks"))
    return placed.select(
        "*", _div(due, F.col("__blocks")).alias("__passes"), F.pmod(due, F.col("__blocks")).alias("__rest"), phase.alias("__phase")
    )
