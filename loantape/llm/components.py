"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loantape.llm.store import drop, stored

MAX_ROUNDS = 100


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("hub"), F.least("u", "low").alias("low")
    )
    hung = both.where("v > u").join(lowest, F.col("u") == F.col("hub"))
    return hung.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours, and itself, on the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    hung = edges.join(lowest.select(F.col("u").alias("hub"), "low"), F.col("u") == F.col("hub"))
    return hung.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").union(
        lowest.select("u", F.col("low").alias("v"))
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node of an edge that is not
    its own root. ``edges`` has two columns of integers, without nulls, in any direction.

    Alternates the two star steps until nothing changes, which takes a number of rounds that grows
    with the logarithm of the longest path. Minima combine before their shuffle and the joins are
    plain equi-joins, so a node with very many neighbours can be split. Each round is a stored table.
    """
    a, b = edges.columns[:2]
    start = edges.select(
        F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v")
    )
    now = stored(start.where("u != v").distinct(), "edges")
    seen = _signature(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        after = stored(_small_star(_large_star(now)), "edges")
        drop(now)
        now, last, seen = after, seen, _signature(after)
        if seen == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
