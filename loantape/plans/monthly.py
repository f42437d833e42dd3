"""Texts of a loan tape → typed, checked monthly table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loantape.catalogue import ALWAYS_LEGAL, DERIVED_FIELDS, EXTENDED_FIELDS, MSA_RECODE, QA_ORDER
from loantape.catalogue import fields as tape_fields
from loantape.operators.codes import code_table, coded_specs
from loantape.operators.derive import LOAN_CALCS, constant_fields, derive, extra_specs
from loantape.operators.quality import failure_masks
from loantape.operators.skew import checkpointed
from loantape.operators.validate import FAILED, check_fields, fill_missing
from loantape.spec import FieldSpec

STANDARD_VALUES = {f.name: f.default for f in EXTENDED_FIELDS}
_LOADED = [f for f in DERIVED_FIELDS if f.name != "qa"]


def monthly_table(
    raw: DataFrame,
    as_of: date | None = None,
    specs: Iterable[FieldSpec] | None = None,
    qa_derived: bool = True,
    codes: DataFrame | None = None,
    keep: Iterable[str] = (),
    masks: bool = False,
) -> DataFrame:
    """Type, check and complete the rows of a scanned tape.

    ``raw`` holds the tape's fields as text plus ``file`` and ``standard``. ``as_of`` is the load
    date, today if not given. Derived fields with a legal range appear in ``qa`` unless
    ``qa_derived`` is off. ``codes`` (``field``, ``code``) are the legal codes of the fields it names,
    in place of their rules; retired area codes and the code for no area are always legal. ``keep``
    names further columns of ``raw`` to carry along. ``masks`` adds the failures as bits
    (``quality.MASKS``, fields as in ``QA_ORDER``), which the rollup counts without reading ``qa``.
    """
    as_of = as_of or date.today()
    specs = list(specs) if specs is not None else tape_fields()
    if codes is not None:
        codes = checkpointed(code_table(codes, ALWAYS_LEGAL))
        specs = coded_specs(specs, codes)
    keep = list(keep)
    constants = {n: v for n, v in STANDARD_VALUES.items() if any(f.name == n for f in specs)}
    checked = check_fields(
        constant_fields(raw, constants), specs, as_of, keep=["file", "standard", *keep], codes=codes, failed=FAILED
    )
    derived = extra_specs(derive(checked, LOAN_CALCS), _LOADED, as_of, ["dq", "propVal"])
    # vintage is never illegal; without a first payment date it is the sentinel.
    silent = [] if qa_derived else [f.name for f in _LOADED]
    out = fill_missing(
        derived, [*specs, *_LOADED], keep, unreported=silent, recode={"msa": MSA_RECODE},
        masks=(lambda failed: failure_masks(failed, QA_ORDER)) if masks else None,
        failed=FAILED, listed=[f.name for f in specs],
    )
    qa = next(f for f in DERIVED_FIELDS if f.name == "qa")
    return out.withMetadata("qa", qa.metadata)


def describe_fields(df: DataFrame, specs: Iterable[FieldSpec]) -> DataFrame:
    """Descriptions and widths carried to the columns of the same name."""
    by_name = {f.name: f for f in specs}
    return df.select(
        *[
            F.col(c).alias(c, metadata=by_name[c].metadata) if c in by_name else F.col(c)
            for c in df.columns
        ]
    )
