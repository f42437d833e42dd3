"""Columns computed from a checked row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loantape.functions.scalars import dq_number, prop_val, vintage
from loantape.operators.validate import is_legal
from loantape.spec import FieldSpec

Calc = Callable[[Callable[[str], Column]], Column]


def derive(df: DataFrame, calcs: Mapping[str, Calc]) -> DataFrame:
    """Further columns, each from a function of the row's columns: ``lambda col: col("a") + 1``."""
    return df.withColumns({name: calc(F.col) for name, calc in calcs.items()})


def extra_specs(
    df: DataFrame, specs: Iterable[FieldSpec], as_of: date, columns: Iterable[str] | None = None
) -> DataFrame:
    """Derived columns held to their specs like raw ones: NULL where not legal."""
    checks = {
        f.name: F.when(is_legal(F.col(f.name), f, as_of), F.col(f.name).cast(f.data_type))
        for f in specs
        if columns is None or f.name in set(columns)
    }
    return df.withColumns(checks)


def constant_fields(
    df: DataFrame, values: Mapping[str, str], flag: str = "standard", when: str = "Y"
) -> DataFrame:
    """Fixed values for columns that rows of the flagged kind do not hold."""
    return df.withColumns(
        {n: F.when(F.col(flag) == when, F.lit(v)).otherwise(F.col(n)) for n, v in values.items()}
    )


# From checked columns: NULL stands for a field that failed.
LOAN_CALCS: dict[str, Calc] = {
    "dq": lambda col: F.when(col("dqStat").isNotNull(), dq_number(col("dqStat"))),
    "vintage": lambda col: vintage(col("fpDt")),
    "propVal": lambda col: prop_val(col("opb"), col("ltv")),
}
