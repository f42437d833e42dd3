"""Registered queries against DuckDB at the smallest scale (``check.py`` runs all of them)."""

import os

import pytest

import check
import oracles
import queries

SF = "/root/testdata/sf0.001"
SOME = [
    "scan_loans", "detect_layout", "describe_loans", "append_runs", "valid_dates", "qa_fields",
    "recode_msa", "derived_valid", "qa_profile", "timeline", "timeline_copies", "first_non_missing",
    "avg_non_missing", "max_given", "loan_rollup", "loan_rollup_parts", "loan_rollup_strict",
    "loan_rollup_blank", "loan_rollup_blank_parts", "loan_timelines", "sort_loan_month",
    "link_many", "sort_copies", "loan_rollup_buckets", "monthly_buckets", "extra_specs", "join_qa", "cast_fields",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(oracles.SQL)


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", SOME)
def test_matches_sql(spark, con, name):
    error, rows, _ = check.compare(spark, con, SF, name)
    assert error is None
    assert rows > 0
