"""Scalar expressions on one row."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number in digits that a 32-bit fraction can hold, with or without exponent.
NUMBER = (
    r"^\s*[+-]?(?:(?:[0-9]{1,37}(?:\.[0-9]*)?|\.[0-9]+)|(?:[0-9]{1,8}(?:\.[0-9]*)?|\.[0-9]+)[eE][+-]?[0-2]?[0-9])\s*$"
)
# What no whole number holds: texts with it are set apart before a cast that would throw.
NOT_WHOLE = r"[A-Za-z.]"


def parse(text: Column, kind: str) -> Column:
    """Text as a value of the given kind, NULL where it does not convert.

    Dates are written MMyyyy. A failing ``try_cast`` to a number or ``try_to_date`` throws and
    catches an exception inside, at some 100 times the price of a good value. So empty texts, which
    are common, and those with letters or a point where whole numbers stand are set apart first, and
    dates go through a cast from ISO form, which throws nothing.
    A fraction must look like one: Java would also read a type suffix (1d, 2.5f), NaN and Infinity.
    """
    if kind == "string":
        return text
    if kind == "date":
        iso = F.concat(F.substring(text, 3, 4), F.lit("-"), F.substring(text, 1, 2), F.lit("-01"))
        return F.when(F.length(text) == 6, iso.try_cast("date"))
    if kind == "float":
        return F.when((text != "") & text.rlike(NUMBER), text.try_cast("float"))
    return F.when((text != "") & ~text.rlike(NOT_WHOLE), text.try_cast({"int": "int", "long": "bigint"}[kind]))


def conditional(test: Column, yes: Any, no: Any) -> Column:
    return F.when(test, yes).otherwise(no)


def cast_f32(c: Column) -> Column:
    return c.cast("float")


def cast_i32(c: Column) -> Column:
    """To a 32-bit integer, dropping the fraction (-2.7 becomes -2)."""
    return c.cast("int")


def dq_number(status: Column) -> Column:
    """Months delinquent from a status code, -1 where the code is not a number."""
    return F.coalesce(status.try_cast("int"), F.lit(-1))


def vintage(first_payment: Column, missing: str = "XXXXQX") -> Column:
    """Year and quarter of a date, such as 2010Q2; ``missing`` for NULL and for 1970."""
    label = F.concat(
        F.year(first_payment).cast("string"), F.lit("Q"), F.quarter(first_payment).cast("string")
    )
    return F.when(F.year(first_payment) != 1970, label).otherwise(F.lit(missing))


def prop_val(balance: Column, ltv: Column) -> Column:
    """Property value implied by a balance and a loan-to-value percentage, in 32-bit arithmetic.

    NULL if either is NULL.
    """
    ratio = (ltv.cast("float") / F.lit(100.0)).cast("float")
    return F.try_divide(balance, ratio).cast("float")


def months_between_dates(first: Column, last: Column) -> Column:
    """Number of month boundaries from ``first`` to ``last``."""
    years = F.year(last).cast("bigint") - F.year(first)
    return years * 12 + F.month(last) - F.month(first)


def age_fp(first_payment: Column, month: Column, missing: int = -1000) -> Column:
    """Loan age in months counted from the first payment; ``missing`` if that date is not known."""
    return F.when(
        F.year(first_payment) > 1990, months_between_dates(first_payment, month)
    ).otherwise(F.lit(missing).cast("bigint"))


def month_end(d: Column) -> Column:
    return F.last_day(d)


def split_tokens(text: Column, separator: str = ":") -> Column:
    """The pieces of a text between separators; empty pieces are kept."""
    return F.split(text, re.escape(separator), -1)


def harp_flag(file: Column) -> Column:
    return F.when(F.contains(F.lower(file), F.lit("harp")), "Y").otherwise("N")


def decoded_uri(uri: Column) -> Column:
    """A file's URI as Spark's metadata column shows it, with its percent escapes undone."""
    plain = F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri, F.lit("%")), F.coalesce(plain, uri)).otherwise(uri)


def bare_path(uri: Column) -> Column:
    """A file's path without URI scheme and percent escapes.

    Runs for every row of a scan, hence searches for fixed texts instead of a pattern.
    """
    path = decoded_uri(uri)
    colon = F.instr(path, ":")
    has_scheme = (colon > 1) & (F.instr(path, "/") == colon + 1)
    after = F.when(F.instr(path, "://") == colon, colon + 3).otherwise(colon + 1)
    return F.when(has_scheme, F.substr(path, after)).otherwise(path)
