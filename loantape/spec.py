"""Field definitions: what a column of a loan tape may hold and what stands in for it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date
from typing import Any

from pyspark.sql import types as T

_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class FieldSpec:
    """One field: type, legal values, sentinel for bad values, default for empty text.

    ``levels`` lists the allowed texts, ``low``/``high`` close a range, ``pattern`` is a regular
    expression for text that follows a rule; with none of them every value is legal. ``horizon``
    marks a date range that ends at the load date plus that many months. ``coded`` fields are held to a
    table of codes (``operators.codes``).
    """

    name: str
    kind: str
    missing: Any
    default: Any = None
    levels: tuple[str, ...] | None = None
    pattern: str | None = None
    low: Any = None
    high: Any = None
    horizon: int | None = None
    width: int | None = None
    comment: str = ""
    position: int | None = None
    coded: bool = False

    @property
    def data_type(self) -> T.DataType:
        return _SPARK_TYPES[self.kind]

    @property
    def has_rule(self) -> bool:
        return self.coded or self.levels is not None or self.pattern is not None or self.low is not None

    @property
    def metadata(self) -> dict[str, Any]:
        out: dict[str, Any] = {"comment": self.comment}
        if self.width is not None:
            out["width"] = self.width
        return out

    @property
    def struct_field(self) -> T.StructField:
        return T.StructField(self.name, self.data_type, True, self.metadata)

    def with_levels(self, levels: Iterable[str]) -> FieldSpec:
        """The same field, held to an explicit list of codes instead of its rule."""
        return replace(self, levels=tuple(levels), pattern=None)


def quoted_name(name: str) -> str:
    """A column's name for use in SQL."""
    return "`" + name.replace("`", "``") + "`"


def check_specs(specs: Iterable[FieldSpec]) -> list[FieldSpec]:
    """Raise ``ValueError`` unless names are unique and sentinels and defaults fit their type."""
    specs = list(specs)
    seen: set[str] = set()
    python_types = {"string": str, "int": int, "long": int, "float": (int, float), "date": date}
    for spec in specs:
        if spec.name.lower() in seen:
            raise ValueError(f"field {spec.name} is defined twice")
        seen.add(spec.name.lower())
        if spec.kind not in _SPARK_TYPES:
            raise ValueError(f"field {spec.name} has unknown type {spec.kind}")
        for role in ("missing", "default"):
            value = getattr(spec, role)
            if value is not None and not isinstance(value, python_types[spec.kind]):
                raise ValueError(f"{role} value {value!r} of {spec.name} is not of type {spec.kind}")
        if spec.levels is not None and spec.kind != "string":
            raise ValueError(f"field {spec.name} has levels but is not text")
        if spec.low is not None and spec.horizon is None and spec.high < spec.low:
            raise ValueError(f"field {spec.name} has an empty range")
    return specs


def schema_of(specs: Iterable[FieldSpec]) -> T.StructType:
    return T.StructType([spec.struct_field for spec in specs])
