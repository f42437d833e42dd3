"""Typing and checking of raw text, one narrow projection after another.

1. *typed*: text → value, NULL where it does not convert;
2. *checked*: legal value or default, NULL where the field failed;
3. *filled*: failures replaced by the field's sentinel, their names listed in the ``qa`` column.

A NULL between step 2 and 3 is the whole status of a field, so no status columns are carried. Step 2 can list
the names of failed fields in one text, so that a plan that needs no values carries none of them further.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loantape.functions.scalars import parse
from loantape.operators.codes import legal_name, mark_codes
from loantape.spec import FieldSpec

QA = "qa"
# The column of names of failed fields between step 2 and 3.
FAILED = "__failed"


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def literal(spec: FieldSpec, value) -> Column:
    return F.lit(value).cast(spec.data_type)


def type_check(text: Column, spec: FieldSpec) -> Column:
    """True where a text is given but does not convert to the field's type."""
    return ~is_empty(text) & parse(text, spec.kind).isNull()


def valid_levels(value: Column, levels: Iterable[str]) -> Column:
    return value.isin(list(levels))


def valid_range(value: Column, low, high) -> Column:
    """Closed range."""
    return value.between(low, high)


def valid_dates(value: Column, low: date, as_of: date, horizon_months: int = 0) -> Column:
    """From ``low`` to ``horizon_months`` after ``as_of``, both included."""
    return value.between(F.lit(low), F.add_months(F.lit(as_of), horizon_months))


def is_legal(value: Column, spec: FieldSpec, as_of: date) -> Column:
    """Does a typed value meet the field's rule? NULL values do not. The mark of ``mark_codes`` stands
    for the value of a coded field."""
    if spec.coded:
        ok = F.col(legal_name(spec.name))
    elif spec.levels is not None:
        ok = valid_levels(value, spec.levels)
    elif spec.pattern is not None:
        ok = value.rlike(spec.pattern)
    elif spec.horizon is not None:
        ok = valid_dates(value, spec.low, as_of, spec.horizon)
    elif spec.low is not None:
        ok = valid_range(value, literal(spec, spec.low), literal(spec, spec.high))
    else:
        return value.isNotNull()
    return F.coalesce(ok, F.lit(False))


def missing_value(checked: Column, spec: FieldSpec) -> Column:
    """The field's sentinel where it failed."""
    return F.coalesce(checked, literal(spec, spec.missing))


def default_value(text: Column, spec: FieldSpec) -> Column:
    """The field's default where no text is given, NULL elsewhere."""
    return F.when(is_empty(text), literal(spec, spec.default))


def cast_fields(df: DataFrame, specs: Iterable[FieldSpec], keep: Iterable[str] = ()) -> DataFrame:
    """Step 1 alone: texts as typed columns, NULL where empty or not convertible."""
    return df.select(
        *[_col(k) for k in keep],
        *[_typed(_col(f.name), f).alias(f.name) for f in specs],
    )


def _typed(text: Column, spec: FieldSpec) -> Column:
    return F.coalesce(text, F.lit("")) if spec.kind == "string" else parse(text, spec.kind)


def _empty_name(name: str) -> str:
    return f"__empty_{name}"


def check_fields(
    df: DataFrame,
    specs: Iterable[FieldSpec],
    as_of: date,
    keep: Iterable[str] = (),
    codes: DataFrame | None = None,
    failed: str | None = None,
) -> DataFrame:
    """Steps 1 and 2: legal values and defaults, NULL where a field failed. ``codes`` is the table
    that coded specs are held to. ``failed`` names a further column for the failed fields, as ``a:b``."""
    specs, keep = list(specs), list(keep)
    # Typed fields with a default need to tell "no text" from "bad text".
    with_default = [f for f in specs if f.kind != "string" and f.default is not None]
    typed = df.select(
        *[_col(k) for k in keep],
        *[_typed(_col(f.name), f).alias(f.name) for f in specs],
        *[is_empty(_col(f.name)).alias(_empty_name(f.name)) for f in with_default],
    )
    coded = [f.name for f in specs if f.coded]
    if coded and codes is None:
        raise ValueError(f"no table of codes for {coded}")
    if coded:
        typed = mark_codes(typed, codes, coded)
    checked = {f.name: _checked(f, as_of) for f in specs}
    out = [*[_col(k) for k in keep], *[c.alias(n) for n, c in checked.items()]]
    if failed is not None:
        out.append(_names_of_nulls(checked).alias(failed))
    return typed.select(*out)


def _checked(spec: FieldSpec, as_of: date) -> Column:
    value = _col(spec.name)
    if not spec.has_rule and spec.default is None:
        return value
    legal = F.when(is_legal(value, spec, as_of), value)
    if spec.default is None:
        return legal
    empty = is_empty(value) if spec.kind == "string" else _col(_empty_name(spec.name))
    return F.when(empty, literal(spec, spec.default)).otherwise(legal)


def fill_missing(
    df: DataFrame,
    specs: Iterable[FieldSpec],
    keep: Iterable[str] = (),
    qa: str | None = QA,
    unreported: Iterable[str] = (),
    recode: Mapping[str, Mapping[str, str]] | None = None,
    masks: Callable[[Mapping[str, Column]], Mapping[str, Column]] | None = None,
    failed: str | None = None,
    listed: Iterable[str] = (),
) -> DataFrame:
    """Step 3: sentinels for failures, and the names of the failed fields as ``:a:b:``.

    ``recode`` maps old to new codes per text field; it applies to values that passed. ``masks`` makes
    further columns from the fields' conditions of having failed. ``failed`` is the column of ``check_fields``
    with the failures among the fields ``listed``; they are named first, before those found by their NULL.
    """
    specs, recode, silent = list(specs), recode or {}, set(unreported)
    out = [_col(k) for k in keep]
    for f in specs:
        value = missing_value(_col(f.name), f)
        if f.name in recode:
            value = recode_values(value, recode[f.name])
        out.append(value.alias(f.name, metadata=f.metadata))
    if qa is not None:
        told = set(listed) if failed is not None else set()
        out.append(qa_fields([f.name for f in specs if f.name not in silent | told], failed).alias(qa))
    if masks is not None:
        made = masks({f.name: _col(f.name).isNull() for f in specs if f.name not in silent})
        out += [c.alias(n) for n, c in made.items()]
    return df.select(*out)


def _names_of_nulls(columns: Mapping[str, Column]) -> Column:
    """The names of those columns that are NULL, as ``a:b``."""
    return F.concat_ws(":", *[F.when(c.isNull(), F.lit(n)) for n, c in columns.items()])


def qa_fields(names: Iterable[str], failed: str | None = None) -> Column:
    """The names of those columns that are NULL, as ``:a:b:``, or the empty text for none. Names that the
    column ``failed`` holds as ``a:b`` come before them."""
    found = _names_of_nulls({n: _col(n) for n in names})
    if failed is not None:
        found = F.concat_ws(":", *[F.when(c != "", c) for c in (_col(failed), found)])
    return F.when(found == "", "").otherwise(F.concat(F.lit(":"), found, F.lit(":")))


def validate(
    df: DataFrame,
    specs: Iterable[FieldSpec],
    as_of: date,
    keep: Iterable[str] = (),
    qa: str | None = QA,
    recode: Mapping[str, Mapping[str, str]] | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """All three steps on a table of texts."""
    specs, keep = list(specs), list(keep)
    checked = check_fields(df, specs, as_of, keep, codes, FAILED)
    return fill_missing(checked, specs, keep, qa, recode=recode, failed=FAILED, listed=[f.name for f in specs])


def recode_values(code: Column, mapping: Mapping[str, str]) -> Column:
    """Old codes replaced by new ones, other values kept."""
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, code), code)
