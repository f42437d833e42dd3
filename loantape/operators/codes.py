"""Membership of texts in tables of legal codes, which may be of any size.

A code table has a row per ``field`` and legal ``code``. Fields it names are held to it instead of the
rule in their spec; all others keep theirs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loantape.operators import skew
from loantape.spec import FieldSpec

FIELD, CODE = "field", "code"
# Blank texts are spread over so many keys, as they need no partner in a join by shuffle.
BLANK_KEYS = 4096


def legal_name(field: str) -> str:
    """The column that says whether a row's value of the field is in its code table."""
    return f"__legal_{field}"


def code_table(codes: DataFrame, always: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """``codes`` without blanks, repeats and rows without a code or field; for the fields it names,
    also the codes that are legal ``always``."""
    rows = codes.select(F.trim(F.col(FIELD)).alias(FIELD), F.trim(F.col(CODE)).alias(CODE))
    rows = rows.where((F.col(FIELD) != "") & (F.col(CODE) != ""))
    more = [(f, c) for f, found in (always or {}).items() for c in found]
    if more:
        extra = codes.sparkSession.createDataFrame(more, f"{FIELD} string, {CODE} string")
        rows = rows.unionByName(extra.join(rows.select(FIELD).distinct(), FIELD, "left_semi"))
    return rows.distinct()


def coded_specs(specs: Iterable[FieldSpec], codes: DataFrame) -> list[FieldSpec]:
    """The specs, those named in the code table marked as held to it. Raises for typed fields."""
    specs = list(specs)
    names = [f.name for f in specs]
    found = {r[0] for r in codes.where(F.col(FIELD).isin(names)).select(FIELD).distinct().collect()}
    typed = sorted(f.name for f in specs if f.name in found and f.kind != "string")
    if typed:
        raise ValueError(f"only text fields have codes: {typed}")
    return [replace(f, levels=None, pattern=None, coded=True) if f.name in found else f for f in specs]


def _key(df: DataFrame, value: Column) -> Column:
    """The join key of a value: blanks, which match nothing, get one of many keys."""
    blank = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(BLANK_KEYS)).cast("string"))
    return F.when(F.coalesce(value, F.lit("")) == "", blank).otherwise(value)


def mark_codes(
    df: DataFrame,
    codes: DataFrame,
    fields: Iterable[str],
    max_rows: int = skew.BROADCAST_ROWS,
    max_bytes: int = skew.BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with a boolean ``legal_name(field)`` per field: is the value one of the field's codes?

    A field's codes are joined on the map side if they are counted within the bounds. If there are
    more, those that occur in ``df`` at all are looked for first, whose values combine before their
    shuffle; they mostly fit. Where they do not either, rows and codes meet by a shuffle, in which
    blanks are spread and AQE splits the rows of a frequent code, as each code has one row. Codes
    should be distinct, as ``code_table`` leaves them. A null value is no code; a field without
    codes has no legal value. Rows are neither lost nor repeated.
    """
    out = df
    for name in fields:
        own = codes.where(F.col(FIELD) == name).select(F.col(CODE).alias("__code"))
        value = F.col(f"`{name}`")
        near, key = skew.small_or_none(own, max_rows, max_bytes), value
        if near is own:
            present = df.select(value.alias("__code")).where("__code != ''").distinct()
            found = skew.checkpointed(present.join(own, "__code", "left_semi"))
            near = skew.small_or_none(found, max_rows, max_bytes)
            key = _key(df, value) if near is found else value
        if near is None:
            out = out.withColumn(legal_name(name), F.lit(False))
            continue
        marked = out.join(near, key == F.col("__code"), "left")
        out = marked.withColumn(legal_name(name), F.col("__code").isNotNull()).drop("__code")
    return out
