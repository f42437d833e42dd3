"""Scalar, array and bit expressions, and aggregates on their edge cases."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from loantape import functions as fn
from loantape.catalogue import STATES, TAPE_FIELDS, column_names, fields
from loantape.operators import aggregate as A
from loantape.operators import validate as V
from loantape.operators.skew import small_or_none
from loantape.sinks.tables import check_schema, describe
from loantape.spec import FieldSpec, check_specs, schema_of

BUCKETS = {
    "100000000001": 16, "100000000002": 17, "200000000001": 16, "123456789012": 11, "98A": 0,
    "F20Q10000001": 16, "999999999999": 12, "100101001001": 16,
}


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_bucket(spark):
    df = spark.createDataFrame([(k,) for k in BUCKETS], "id string")
    tail = F.substring("id", 5, 8)
    rows = df.select(
        "id", fn.bucket(F.col("id")).alias("b"),
        fn.array_sum(fn.bit_positions(fn.reinterpret_uint64(tail))).alias("by_array"),
        fn.bit_position_sum(fn.reinterpret_uint64(tail)).alias("by_count"),
    ).collect()
    assert {r.id: r.b for r in rows} == BUCKETS
    assert all(r.by_array == r.by_count and r.by_array % 20 == r.b for r in rows)


def test_reinterpret_is_little_endian(spark):
    df = spark.createDataFrame([("A",), ("AB",), ("\x00\x01",), ("",), ("ABCDEFGHI",)], "s string")
    got = [r[0] for r in df.select(fn.reinterpret_uint64(F.col("s"))).collect()]
    want = [int.from_bytes(s.encode()[:8], "little") for s in ("A", "AB", "\x00\x01", "", "ABCDEFGH")]
    assert got == want


def test_bit_positions_of_negative_numbers(spark):
    assert one(spark, fn.bit_positions(F.lit(-(2**63)).cast("bigint"))) == ([63],)
    assert one(spark, fn.bit_position_sum(F.lit(-1).cast("bigint"))) == (2016,)


def test_arrays_without_match(spark):
    a, none = F.array(F.lit(1), F.lit(2)), F.array().cast("array<int>")
    assert one(spark, fn.array_first(a, lambda x: x > 5, -1)) == (-1,)
    assert one(spark, fn.array_avg(none), fn.array_avg(a)) == (None, 1.5)
    assert one(spark, fn.index_of(a, 2), fn.index_of(a, 9)) == (2, 0)
    assert one(spark, fn.element_at(a, 2), fn.element_at(a, 3)) == (2, None)
    assert one(spark, fn.array_filter2(a, F.array(F.lit(0), F.lit(1)), lambda _, y: y > 0)) == ([2],)


def test_scalars(spark):
    d = lambda y, m, day=1: F.lit(date(y, m, day))
    assert one(spark, fn.vintage(d(2010, 4)), fn.vintage(d(1970, 1))) == ("2010Q2", "XXXXQX")
    assert one(spark, fn.age_fp(d(2010, 4, 30), d(2011, 2))) == (10,)
    assert one(spark, fn.age_fp(d(1990, 12), d(2011, 2))) == (-1000,)
    assert one(spark, fn.age_fp(d(2010, 4), d(2010, 3))) == (-1,)
    assert one(spark, fn.cast_i32(F.lit(-2.7)), fn.cast_i32(F.lit(2.7))) == (-2, 2)
    assert one(spark, fn.dq_number(F.lit("07")), fn.dq_number(F.lit("!"))) == (7, -1)
    assert one(spark, fn.split_tokens(F.lit(":a:"))) == (["", "a", ""],)
    assert one(spark, fn.split_tokens(F.lit("a|b"), "|")) == (["a", "b"],)


@pytest.mark.parametrize(
    ("uri", "path"),
    [
        ("file:///d/a%20b.csv", "/d/a b.csv"),
        ("file:/d/a+b.csv", "/d/a+b.csv"),
        ("s3a://bucket/a.csv", "bucket/a.csv"),
        ("/d/50%.csv", "/d/50%.csv"),
    ],
)
def test_paths(spark, uri, path):
    assert one(spark, fn.bare_path(F.lit(uri))) == (path,)


def aggregate(spark, values, kind, build):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"o int, v {kind}").repartition(3)
    return df.agg(build(F.col("v"), F.col("o")).alias("x")).first().x


def test_first_aggregates(spark):
    first = lambda v, o: A.first_non_missing(v, "X", o)
    assert aggregate(spark, ["X", "B", "C"], "string", first) == "B"
    assert aggregate(spark, ["X", "X"], "string", first) == "X"
    assert aggregate(spark, ["X", "", "C"], "string", first) == "X"
    probed = lambda v, o: A.first_non_missing(v, "unknown", o, probe=F.lower(v))
    assert aggregate(spark, ["Unknown", "Bank"], "string", probed) == "Unknown"
    assert aggregate(spark, ["UNKNOWN"], "string", probed) == "unknown"
    but = lambda v, o: A.first_non_missing_except(v, "X", o, ["7", "9"])
    assert aggregate(spark, ["7", "X", "9", "P"], "string", but) == "P"
    assert aggregate(spark, ["7", "X"], "string", but) == "X"
    dates = [date(1970, 1, 1), date(1970, 6, 1), date(2001, 1, 1), date(2000, 1, 1)]
    assert aggregate(spark, dates, "date", A.first_valid_date) == date(2001, 1, 1)
    assert aggregate(spark, dates[:2], "date", A.first_valid_date) == date(1970, 1, 1)


def test_means(spark):
    mean = lambda compat: lambda v, _: A.avg_non_missing(v, -1, compat)
    assert aggregate(spark, [-1, 10, 11], "int", mean(True)) == 10.5
    assert aggregate(spark, [0, 0, -1], "int", mean(True)) == -1
    assert aggregate(spark, [0, 0, -1], "int", mean(False)) == 0
    assert aggregate(spark, [-1, -1], "int", mean(True)) == -1
    assert aggregate(spark, [-1, -1], "int", mean(False)) == -1
    assert aggregate(spark, [1, 2, -1], "int", lambda v, _: A.avg_non_missing_int(v, -1)) == 1
    assert aggregate(spark, [0, 4, -5], "int", lambda v, _: A.avg_positive(v)) == 4
    assert aggregate(spark, [0, 4, -5], "int", lambda v, _: A.avg_nonnegative(v)) == 2
    assert aggregate(spark, [0, -5], "int", lambda v, _: A.avg_nonnegative(v)) == -1


def test_maxima_and_flags(spark):
    assert aggregate(spark, [0.0, -5.0, -1.0], "float", lambda v, _: A.max_value(v)) == 0
    given = lambda v, _: A.max_given(v, -1.0, 0.0)
    assert aggregate(spark, [0.0, -5.0, -1.0], "float", given) == -5
    assert aggregate(spark, [0.0, -1.0], "float", given) == 0
    assert aggregate(spark, [-1.0], "float", given) == -1
    for values, any_y, no_y in ((["N", "Y"], "Y", "N"), (["N", "X"], "N", "Y")):
        assert aggregate(spark, values, "string", lambda v, _: A.any_flag(v)) == any_y
        assert aggregate(spark, values, "string", lambda v, _: A.no_flag(v)) == no_y


def test_catalogue():
    assert (len(TAPE_FIELDS), len(STATES)) == (70, 54)
    assert [f.levels for f in fields(["zip3"], zip3_codes=["010", "005"])] == [("005", "010")]
    assert len(column_names(108)) == 108
    assert sum(c.startswith("unused") for c in column_names(108)) == 38
    assert [f.name for f in fields(["fico", "month"])] == ["month", "fico"]
    with pytest.raises(ValueError, match="nosuch"):
        fields(["nosuch"])


def test_specs_are_checked():
    good = FieldSpec("a", "int", -1)
    with pytest.raises(ValueError, match="twice"):
        check_specs([good, FieldSpec("A", "int", -1)])
    with pytest.raises(ValueError, match="missing"):
        check_specs([FieldSpec("a", "int", "x")])
    with pytest.raises(ValueError, match="empty range"):
        check_specs([FieldSpec("a", "int", -1, low=2, high=1)])


def test_other_panels(spark):
    """Own fields on an own table: the operators do not know the loan tape."""
    specs = [
        FieldSpec("score", "int", -9, default=5, low=0, high=10, comment="score"),
        FieldSpec("grade", "string", "?", pattern="^[A-C]$", comment="grade"),
    ]
    rows = [(1, "7", "A"), (2, "", "D"), (3, "11", ""), (4, "x", "B"), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, score string, grade string")
    out = V.validate(df, specs, date(2024, 1, 1), keep=["id"])
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        (1, 7, "A", ""), (2, 5, "?", ":grade:"), (3, -9, "?", ":score:grade:"),
        (4, -9, "B", ":score:"), (5, 5, "?", ":grade:"),
    ]
    assert [r.comment for r in describe(out).collect()] == ["", "score", "grade", ""]
    with pytest.raises(ValueError, match="missing"):
        check_schema(df, schema_of([FieldSpec("other", "int", -1)]))


def test_broadcast_only_within_bounds(spark):
    df = spark.range(50)
    assert small_or_none(df.where("id < 0")) is None
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(small_or_none(df, 50))
    assert not hinted(small_or_none(df, 49))
    assert not hinted(small_or_none(df, 50, max_bytes=10))
