"""Timelines longer than a piece are given whole, and plans where many loans are longer than one."""

import pytest
from pyspark.sql import functions as F

import queries as Q
from loantape.operators import quality, skew
from loantape.plans import loans as L
from loantape.sinks import runs
from loantape.sinks.tables import write_monthly
from test_skew import joined_pieces, monthly_rows

KEYS = ["file", "lnId"]


@pytest.fixture
def panel(spark, tmp_path, monkeypatch):
    """A stored monthly table with a blank and a NULL id in place of the driver's, and a map of ids."""
    lnid = F.when(F.col("lnId") == "100000000003", F.lit(None)).otherwise(F.col("lnId"))
    rows = write_monthly(monthly_rows(spark).withColumn("lnId", lnid), str(tmp_path / "m"))
    id_map = spark.createDataFrame([("100000000001", "100000000002"), ("100000000001", "100000000004")], "oldLnId string, harpLnId string")
    monkeypatch.setattr(Q, "raw", lambda *_: rows)
    monkeypatch.setattr(Q, "monthly", lambda *_: rows)
    monkeypatch.setattr(Q, "monthly_table", lambda raw, *_, **__: raw)
    monkeypatch.setattr(Q.fixtures, "raw_panel", lambda *_: rows)
    monkeypatch.setattr(Q.fixtures, "id_map", lambda *_: id_map)
    return rows


def cut_at(monkeypatch, piece):
    plain = L.rolled
    monkeypatch.setattr(L, "rolled", lambda *a, **k: plain(*a, **({"piece": piece} | k)))


def told(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_flat_loans_have_all_months(spark, panel, monkeypatch):
    want = told(Q.flat_loans(L.loan_rollup(panel, Q.fixtures.id_map(), tie=["payHist"], piece=None)))
    cut_at(monkeypatch, 7)
    assert told(Q.loan_rollup(spark, "")) == want
    monkeypatch.setattr(skew, "is_small", lambda df: False)
    assert told(Q.flat_loans(*L.rolled(panel, Q.fixtures.id_map(), tie=["payHist"], piece=7, cut=False))) == want


def test_default_rollup_has_all_months(spark, panel, monkeypatch):
    cut_at(monkeypatch, 7)
    got = {(r.file, r.lnId): (r.nMonths, len(r.monthly_month.split(";"))) for r in Q.loan_rollup_default(spark, "").collect()}
    assert got == {(r.file, r.lnId): (r.n, r.n) for r in panel.groupBy(*KEYS).agg(F.count("*").alias("n")).collect()}


def test_stored_loans_have_all_months(spark, panel, monkeypatch):
    cut_at(monkeypatch, 7)
    want = {(r.file, r.lnId): r.n for r in panel.groupBy(*KEYS).agg(F.count("*").alias("n")).collect()}
    assert {(r.file, r.lnId): r.n for r in Q.write_loans(spark, "").collect()} == want
    other = F.col("lnId") > "100000000004"
    halves = panel.withColumns({"standard": F.when(other, "N").otherwise("Y"), "file": F.when(other, "b").otherwise(F.col("file"))})
    monkeypatch.setattr(Q, "stored_monthly", lambda *_: halves)
    both = Q.append_runs(spark, "").where("lnId is not null and lnId != ''").collect()
    assert sorted((r.how, r.lnId, r.n) for r in both) == sorted((how, k[1], n) for how in ("one job", "two runs") for k, n in want.items() if k[1])


def test_further_months_are_committed_with_the_loans(spark, panel, tmp_path):
    loans, rest = L.rolled(panel, tie=["payHist"], piece=7)
    runs.write_loans(loans, "whole_loans", path=str(tmp_path / "loans"), keys=panel, months=rest)
    stored = joined_pieces(spark.table("whole_loans"), spark.table("whole_loans_months"))
    assert sum(len(m) for _, m in stored.values()) == panel.count()


def test_bucketed_loans_have_all_months(spark, panel, monkeypatch):
    want = told(Q.flat_loans(L.loan_rollup(panel, Q.fixtures.id_map(), tie=["payHist"], piece=None)))
    assert told(Q.loan_rollup_buckets(spark, "")) == want


@pytest.mark.parametrize("small", [True, False])
def test_blank_loans_have_all_months_in_pieces(spark, panel, monkeypatch, small):
    monkeypatch.setattr(Q, "_blank", lambda *_: panel)
    monkeypatch.setattr(Q, "BLANK_PIECE", 7)
    monkeypatch.setattr(skew, "is_small", lambda df: small)
    whole = Q.flat_loans(L.loan_rollup(panel, Q.fixtures.id_map(), tie=["payHist"], piece=None)).collect()
    want = {}
    for r in map(lambda r: r.asDict(), whole):
        for part in range(-(-r["nMonths"] // 7)):
            cut = {c: ";".join(v.split(";")[part * 7 : part * 7 + 7]) for c, v in r.items() if c.startswith("monthly_")}
            want[r["file"], r["lnId"], r["harpLnId"], part] = r | cut | {"part": part}
    got = {(r["file"], r["lnId"], r["harpLnId"], r["part"]): r for r in map(lambda r: r.asDict(), Q.loan_rollup_blank(spark, "").collect())}
    assert got == want and max(k[3] for k in got if k[1] == "") == 11


def test_many_long_loans_are_cut_behind_one_aggregation(spark, tmp_path, monkeypatch):
    rows = write_monthly(monthly_rows(spark), str(tmp_path / "m"))
    whole = joined_pieces(L.loan_rollup(rows, tie=["payHist"], piece=None))
    monkeypatch.setattr(skew, "is_small", lambda df: False)
    loans, rest = L.loan_tables(rows, tie=["payHist"], piece=3)
    assert joined_pieces(loans, rest) == whole
    # No row is joined or moved to learn how long its loan is, where a task holds all loans.
    loans = L.loan_rollup(rows.where("lnId != ''"), tie=["payHist"], piece=3)
    plan = loans._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_profiles_travel_packed(spark):
    rows = [("a", [("fico", 2), ("dti", 1)]), ("b", []), ("c", None), ("d", [("dti", 3)])]
    df = spark.createDataFrame(rows, f"lnId string, qa {quality.PROFILE_TYPE}")
    moved = runs.ranged_loans(df.withColumn("file", F.lit("x")), ["file", "lnId"], [("x", "b")])
    assert sorted((r.lnId, r.qa and [tuple(x) for x in r.qa]) for r in moved.collect()) == rows
    assert moved.schema["qa"] == df.schema["qa"]
    assert "__qa_names" in moved._jdf.queryExecution().optimizedPlan().toString()


def test_staged_rows_are_packed(spark, tmp_path):
    write_monthly(spark.range(3), str(tmp_path / "m"))
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "m").glob("part-*"))
