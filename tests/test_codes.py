"""Fields held to tables of codes, by each of the three plans."""

import random

import pytest
from pyspark.sql import functions as F

from loantape.catalogue import ALWAYS_LEGAL, fields
from loantape.operators import codes as C

SCHEMA = "id bigint, msa string, zip3 string"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    # A third of all rows share one code, another third are blank.
    return [(i, [f"{r.randrange(99)}", "7", "", None][i % 3 if i % 7 else 3], f"{r.randrange(40):03d}") for i in range(600)]


def table(spark, pairs):
    return spark.createDataFrame(pairs, "field string, code string")


def wanted(rows, msa, zip3):
    return sorted((i, m in msa, z in zip3) for i, m, z in rows)


@pytest.mark.parametrize("bounds, joins", [((1000, 10**6), "BroadcastHashJoin"), ((30, 10**6), "BroadcastHashJoin"), ((3, 10**6), "SortMergeJoin")])
def test_map_side_by_those_that_occur_and_by_shuffle(spark, rows, bounds, joins):
    msa = {str(n) for n in range(0, 200, 3)} | {"7"}
    zip3 = {f"{n:03d}" for n in range(0, 900, 2)}
    given = C.code_table(table(spark, [("msa", c) for c in msa] + [("zip3", c) for c in zip3] * 2 + [("msa", ""), (None, "7"), ("zip3", None)]))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = C.mark_codes(df, given, ["msa", "zip3"], *bounds)
    assert got.columns == ["id", "msa", "zip3", "__legal_msa", "__legal_zip3"]
    assert sorted((r.id, r["__legal_msa"], r["__legal_zip3"]) for r in got.collect()) == wanted(rows, msa, zip3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = C.mark_codes(df, given, ["msa", "zip3"], *bounds)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joins in plan and (joins == "SortMergeJoin" or "SortMergeJoin" not in plan)


def test_no_codes_and_empty_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = C.mark_codes(df, table(spark, [("zip3", "001")]), ["msa"])
    assert {r["__legal_msa"] for r in got.collect()} == {False}
    assert C.mark_codes(df.limit(0), table(spark, [("zip3", "001")]), ["zip3"]).count() == 0


def test_specs_follow_the_table(spark):
    given = C.code_table(table(spark, [(" msa ", " 10180 "), ("other", "x")]), ALWAYS_LEGAL)
    assert {r.code for r in given.where("field = 'msa'").collect()} == {"10180", *ALWAYS_LEGAL["msa"]}
    assert given.where("field = 'zip3'").isEmpty()
    specs = {f.name: f for f in C.coded_specs(fields(), given)}
    assert specs["msa"].coded and specs["msa"].pattern is None and not specs["zip3"].coded
    with pytest.raises(ValueError, match="fico"):
        C.coded_specs(fields(), table(spark, [("fico", "700")]))


def test_many_codes_are_not_collected(spark):
    many = spark.range(150_000).select(F.lit("msa").alias("field"), F.col("id").cast("string").alias("code"))
    df = spark.createDataFrame([(1, "149999", ""), (2, "150000", "")], SCHEMA)
    got = C.mark_codes(df, many, ["msa"], max_rows=1000)
    assert sorted((r.id, r["__legal_msa"]) for r in got.collect()) == [(1, True), (2, False)]
