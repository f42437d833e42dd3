"""Aggregates that know a field's sentinel for "missing".

Each builder returns an aggregate ``Column`` for ``groupBy(...).agg(...)``. All of them combine
partially before the shuffle, so a group of any size costs one row per task. ``order`` is a column
(often a struct of date and tie-breaker) that ranks the rows of a group; smallest comes first.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from loantape.catalogue import EPOCH


def _first_where(value: Column, test: Column, order: Column) -> Column:
    # min_by skips rows whose ordering value is NULL.
    return F.min_by(value, F.when(test, order))


def first_non_missing(
    value: Column, missing: str, order: Column, probe: Column | None = None
) -> Column:
    """First text that is not the sentinel; the sentinel if there is none or it is empty.

    ``probe`` is the text tested for emptiness, where that differs from the text returned.
    """
    found = _first_where(value, value != missing, order)
    tested = found if probe is None else _first_where(probe, probe != missing, order)
    return F.when(F.coalesce(tested, F.lit("")) == "", missing).otherwise(
        F.coalesce(found, F.lit(missing))
    )


def first_non_missing_except(
    value: Column, missing: str, order: Column, skip: Iterable[str]
) -> Column:
    """As ``first_non_missing``, passing over some further values."""
    found = _first_where(value, ~value.isin(missing, *skip), order)
    return F.when(F.coalesce(found, F.lit("")) == "", missing).otherwise(found)


def first_valid_date(value: Column, order: Column, missing=EPOCH) -> Column:
    """First date after 1970, else the sentinel."""
    return F.coalesce(_first_where(value, F.year(value) > 1970, order), F.lit(missing))


def _mean_or(mean: Column, missing: Any, compat: bool) -> Column:
    sentinel = F.lit(missing).cast("double")
    if compat:
        return F.when(mean > 0, mean).otherwise(sentinel)
    return F.coalesce(mean, sentinel)


def avg_non_missing(value: Column, missing: Any, compat: bool = True) -> Column:
    """Mean in double precision of the values that are not the sentinel.

    With ``compat`` a mean that is not positive counts as missing, too.
    """
    return _mean_or(F.avg(F.when(value != missing, value)), missing, compat)


def avg_non_missing_int(value: Column, missing: int, compat: bool = True) -> Column:
    """As ``avg_non_missing``, without the fraction."""
    return avg_non_missing(value, missing, compat).cast("int")


def avg_positive(value: Column, missing: Any = -1) -> Column:
    return _mean_or(F.avg(F.when(value > 0, value)), missing, compat=True)


def avg_nonnegative(value: Column, missing: Any = -1, compat: bool = True) -> Column:
    return _mean_or(F.avg(F.when(value >= 0, value)), missing, compat)


def max_value(value: Column) -> Column:
    """Maximum over all rows, sentinels and defaults among them."""
    return F.max(value)


def max_given(value: Column, missing: Any, default: Any) -> Column:
    """Maximum of the values that were really given; the default, else the sentinel, if none was."""
    given = F.max(F.when(~value.isin(missing, default), value))
    return F.coalesce(given, F.max(F.when(value == default, value)), F.lit(missing)).cast("float")


def any_flag(value: Column, flag: str = "Y") -> Column:
    """Y if any row has the flag, else N."""
    return F.when(F.bool_or(value == flag), "Y").otherwise("N")


def no_flag(value: Column, flag: str = "Y") -> Column:
    """Y if no row has the flag, else N."""
    return F.when(F.bool_or(value == flag), "N").otherwise("Y")


def first_row(value: Column, order: Column) -> Column:
    """Value of the first row."""
    return F.min_by(value, order)
