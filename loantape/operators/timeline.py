"""Rows of a group as one array in order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loantape.operators import skew

# Months in one piece of a timeline. No loan lives as long; longer groups are repeated deliveries or
# blank ids.
PIECE = 4096


def order_key(month: Column, *tie: Column) -> Column:
    """Ordering of rows in a group: by date, then by the tie-breaker."""
    return F.struct(month.alias("month"), *[t.alias(f"tie{i}") for i, t in enumerate(tie)])


# Low bits of a packed order: what is left of a row's hash beside its day.
TIE_BITS = 47


def packed_order(month: Column, hashed: Column) -> Column:
    """``order_key`` of a date and a hash as one number: the day, counted from 1970, above the leading
    bits of the hash. Aggregates compare and copy it as such, where a struct is an object.

    For dates from 1970 on, up to the year 2149. Rows of one date come in the order of their hashes,
    as by ``order_key``, as long as their leading bits differ; the chance that two rows of a group
    share date and bits is one in 2**47.
    """
    signless = hashed.bitwiseXOR(F.lit(-(1 << 63)))
    return F.shiftleft(F.unix_date(month).cast("bigint"), TIE_BITS).bitwiseOR(F.shiftrightunsigned(signless, 64 - TIE_BITS))


def row_hash(df: DataFrame) -> Column:
    """A tie-breaker that depends on nothing but the row's own values."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def nest(fields: Mapping[str, Column]) -> Column:
    """Columns gathered as one struct, the element of a nested table."""
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def gathered(order: Column, item: Column) -> Column:
    """Aggregate: the items of a group as an array in order.

    Sorted inside the group: a sort before the shuffle would be lost. For bounded groups only.
    """
    ordered = F.sort_array(F.collect_list(F.struct(order.alias("o"), item.alias("i"))))
    return F.transform(ordered, lambda x: x["i"])


def timeline(
    df: DataFrame,
    keys: Iterable[str],
    order: Column,
    fields: Mapping[str, Column],
    name: str = "monthly",
    piece: int | None = PIECE,
) -> DataFrame:
    """Each group's rows in order as ``array<struct>``, in pieces of ``piece`` elements: ``part`` 0,
    1, … is a row's rank in its group divided by ``piece``.

    Groups of one piece or a few (``skew.whole_rows``) are gathered in one aggregation and cut; longer
    ones are found by a count of the keys and ranked without bringing them together. ``piece=None``
    skips the count and puts all of a group in ``part`` 0, where groups are known to be small.
    """
    keys = list(keys)
    item = nest(fields)
    hot = None if piece is None else skew.hot_groups(df, keys, skew.whole_rows(piece))

    def whole(rows: DataFrame) -> DataFrame:
        out = rows.groupBy(*keys).agg(gathered(order, item).alias(name))
        if piece is None or skew.whole_rows(piece) == piece:
            return out.select(*keys, F.lit(0).alias("part"), name)
        return skew.cut_whole(out, keys, name, piece)

    if hot is None:
        return whole(df)
    match = skew.null_safe(df, hot, keys)
    n_rows = hot.agg(F.sum("n_rows")).first()[0]
    pieces = skew.rank_pieces(df.join(hot, match, "left_semi"), keys, order, item, piece, n_rows)
    return whole(df.join(hot, match, "left_anti")).unionByName(
        skew.gather_pieces(pieces, keys, name).select(*keys, "part", name)
    )
