"""Array expressions that behave like their namesakes in column stores: never NULL for no match."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_first(a: Column, test: Callable[[Column], Column], default: Any) -> Column:
    """First element that passes the test, else ``default``."""
    return F.coalesce(F.get(F.filter(a, test), F.lit(0)), F.lit(default))


def array_filter(a: Column, test: Callable[[Column], Column]) -> Column:
    return F.filter(a, test)


def array_filter2(a: Column, b: Column, test: Callable[[Column, Column], Column]) -> Column:
    """Elements of ``a`` for which the test on the pair (element of a, element of b) holds."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    kept = F.filter(pairs, lambda p: test(p["x"], p["y"]))
    return F.transform(kept, lambda p: p["x"])


def array_sum(a: Column, zero: Any = 0) -> Column:
    """Sum; ``zero`` fixes the result type (0 for bigint, 0.0 for double)."""
    start = F.lit(zero).cast("double" if isinstance(zero, float) else "bigint")
    return F.aggregate(a, start, lambda total, x: total + x)


def array_avg(a: Column) -> Column:
    """Mean in double arithmetic, NULL if the array is empty."""
    return F.try_divide(array_sum(a, 0.0), F.size(a))


def array_max(a: Column) -> Column:
    return F.array_max(a)


def index_of(a: Column, value: Any) -> Column:
    """Position from 1 of the first element equal to ``value``, 0 if there is none."""
    return F.array_position(a, value)


def element_at(a: Column, position: int) -> Column:
    """Element at a position from 1, NULL beyond the end."""
    return F.try_element_at(a, F.lit(position))


def array_length(a: Column) -> Column:
    return F.size(a)
