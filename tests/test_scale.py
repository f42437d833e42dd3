"""Queries that build their input: what they write must not grow tasks or run plans twice."""

import glob
import gzip

import pytest
from pyspark.sql import functions as F

import queries as Q
from loantape.functions.scalars import parse
from loantape.sinks import runs


def panel(spark, n):
    """A panel of so many rows with the columns that the tapes are made of."""
    names = [f.name for f in Q.catalogue.TAPE_FIELDS]
    texts = {name: F.lit("1") for name in names}
    texts |= {"lnId": F.col("id").cast("string"), "zip3": F.lpad((F.col("id") % 1000).cast("string"), 3, "0")}
    return spark.range(n).select(*[c.alias(x) for x, c in texts.items()], F.lit("1999Q1.csv").alias("file"))


@pytest.mark.parametrize("kind", ["int", "long"])
def test_whole_numbers_are_set_apart_without_a_change(spark, kind):
    texts = ["7", " 8 ", "+9", "-1", "007", "1.0", "1.", ".5", "abc", "1d", "1e3", "", "\t5\n", "99999999999", "-", "1 2", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.col("t").try_cast({"int": "int", "long": "bigint"}[kind])
    assert [tuple(r) for r in rows.select("t", parse(F.col("t"), kind)).collect()] == [tuple(r) for r in rows.select("t", plain).collect()]
    assert "RLIKE" in rows.select(parse(F.col("t"), kind))._jdf.queryExecution().optimizedPlan().toString()


def test_tapes_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q.fixtures, "raw_panel", lambda *_: panel(spark, 50))
    monkeypatch.setattr(Q, "TAPE_PARTS", ("1999Q1.csv",))
    monkeypatch.setattr(Q, "new_folder", lambda *_: str(tmp_path / "tape"))
    base = Q.write_tape(spark, "", by_loan=True)
    found = glob.glob(f"{base}/1999Q1.csv/part-*")
    assert found and all(f.endswith(".csv.gz") for f in found)
    assert sum(len(gzip.open(f).read().splitlines()) for f in found) == 50
    assert Q.tape.scan_loans(spark, f"{base}/*").count() == 50


def test_misfits_are_written_to_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q.fixtures, "raw_panel", lambda *_: panel(spark, 2000))
    monkeypatch.setattr(Q, "TAPE_PARTS", ("1999Q1.csv",))
    monkeypatch.setattr(Q, "FILE_ROWS", 400, raising=False)
    monkeypatch.setattr(Q, "new_folder", lambda *_: str(tmp_path / "tape"))
    assert Q.scan_misfits(spark, "").count() == 2000
    assert len(glob.glob(f"{tmp_path}/tape/1999Q1.csv/part-*")) == 5


def test_stored_loans_draw_ranges_from_stored_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(runs, "write_loans", lambda loans, table, create, path, keys: seen.append((loans, keys, create)))
    Q._store_loans(spark, ["a", "b"], ["x", "y"])
    assert seen == [("a", "x", True), ("b", "y", False)]


def test_a_bucket_is_sorted_in_memory():
    """Some 1 KB a row in memory, and a task has some hundreds of MB."""
    assert Q.tables.BUCKET_ROWS * 1024 <= 512 << 20


def failures(spark):
    """A table of failures with a blank and a NULL id and rows without any."""
    rows = [("a", "1", ":x:y:"), ("a", "1", ":y:"), ("a", "2", ""), ("a", "", ":x:"), ("a", "", ":x:z:"), ("b", None, ":x:"), ("b", None, ":x:")]
    return spark.createDataFrame(rows * 3, "file string, lnId string, qa string")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


COUNTED = [("a", "", "x", 6), ("a", "", "z", 3), ("a", "1", "x", 3), ("a", "1", "y", 6), ("b", None, "x", 6)]


@pytest.mark.parametrize(("limit", "shuffles"), [(6, (1, 1)), (5, (1, 2))])
def test_failures_are_counted_behind_one_shuffle(spark, monkeypatch, limit, shuffles):
    monkeypatch.setattr(Q, "monthly", lambda *_: failures(spark))
    monkeypatch.setattr(Q.quality.near_keys, "__defaults__", (limit,))
    counts, grouped = Q.count_by_key(spark, ""), Q.group_to_arrays(spark, "")
    assert (exchanges(counts), exchanges(grouped)) == shuffles
    assert sorted(map(tuple, counts.collect()), key=repr) == sorted(COUNTED, key=repr)
    wanted = [("a", "", "x;z", "6;3"), ("a", "1", "x;y", "3;6"), ("b", None, "x", "6")]
    assert sorted(map(tuple, grouped.collect()), key=repr) == sorted(wanted, key=repr)


def test_profiles_are_made_behind_one_shuffle(spark):
    rows = Q.quality.near_keys(failures(spark), Q.KEYS)
    profile = Q.quality.qa_profile(rows, Q.KEYS)
    assert exchanges(profile) == 1
    joined = Q.quality.join_qa(rows.select(*Q.KEYS).distinct(), profile, Q.KEYS)
    made = {(r.file, r.lnId): [tuple(p) for p in r.qa] for r in joined.collect()}
    assert made == {("a", "1"): [("x", 3), ("y", 6)], ("a", "2"): [], ("a", ""): [("x", 6), ("z", 3)], ("b", None): [("x", 6)]}
    assert Q.quality.near_keys(failures(spark).limit(0), Q.KEYS).count() == 0


def test_join_qa_deals_its_rows_out_first(spark, monkeypatch):
    rows = failures(spark).withColumn("qa", F.replace("qa", F.lit("x"), F.lit("fico")))
    asked = []
    near = Q.quality.near_keys
    monkeypatch.setattr(Q, "monthly", lambda *_: rows)
    monkeypatch.setattr(Q.quality, "near_keys", lambda df, keys: asked.append(keys) or near(df, keys))
    made = sorted(((r.file, r.lnId, r.qa) for r in Q.join_qa(spark, "").collect()), key=repr)
    assert made == sorted([("a", "", "fico=6;z=3"), ("a", "1", "fico=3;y=3"), ("a", "2", ""), ("b", None, "fico=6")], key=repr)
    assert asked == [Q.KEYS]


def test_panel_rows_of_an_order_lie_together(spark, tmp_path):
    """Joined as grouped, and the same rows as by the SQL as written."""
    for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey")):
        more = {
            "orders": {"o_custkey": F.col("id") % 7 + 1, "o_totalprice": F.lit(1000.5), "o_orderdate": F.lit("2001-02-03").cast("date")},
            "customer": {"c_mktsegment": F.lit("BUILDING")},
            "part": {"p_size": F.lit(5)},
        }[name]
        made = spark.range(1, 41).withColumns({key: F.col("id"), **more}).drop("id")
        made.unionByName(made.where(F.col(key) == 3)).write.parquet(f"{tmp_path}/{name}.parquet")
    line = {
        "l_orderkey": F.when(F.col("id") % 11 > 0, F.col("id") % 37 + 1), "l_partkey": F.col("id") % 41 + 1, "l_suppkey": F.col("id") % 5,
        "l_linenumber": (F.col("id") % 7 + 1).cast("int"), "l_quantity": F.lit(12.0), "l_extendedprice": F.lit(1234.5), "l_discount": F.lit(0.04),
        "l_tax": F.lit(0.02), "l_returnflag": F.lit("R"), "l_linestatus": F.lit("F"), "l_shipdate": F.lit("2002-03-04").cast("date"),
    }
    spark.range(400).withColumns(line).drop("id").write.parquet(f"{tmp_path}/lineitem.parquet")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        panel = Q.fixtures.raw_panel(spark, str(tmp_path))
        places = panel.select("lnId", F.spark_partition_id().alias("at")).groupBy("lnId").agg(F.count_distinct("at").alias("n"))
        assert places.where("n > 1").count() == 0
        written = spark.sql(Q.fixtures.WIDE_SQL)
        assert panel.columns == written.columns
        assert panel.exceptAll(written).count() == written.exceptAll(panel).count() == 0 < panel.count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_failed_fields_are_listed_without_carrying_values(spark, tmp_path):
    """a query on failures alone copies the texts into the typed row and no further."""
    texts = ["", "1", "052003", "Y", "25.5", "x", "-7", "700", "10180", "05"]
    made = panel(spark, 40).drop("file")
    made = made.withColumns({
        name: F.element_at(F.array(*[F.lit(t) for t in texts], F.lit(None)), ((F.col("lnId").cast("int") * (i % 7 + 1) + i) % 11 + 1).cast("int"))
        for i, name in enumerate(made.columns) if name != "lnId"
    })
    extended = {f.name: F.when(F.col("lnId").cast("int") % 3 == 0, "Q").otherwise("Y") for f in Q.catalogue.EXTENDED_FIELDS}
    flag = F.when(F.col("lnId").cast("int") % 2 == 0, "N").otherwise("Y")
    made.withColumns(extended | {"file": F.lit("1999Q1.csv"), "standard": flag}).write.parquet(f"{tmp_path}/raw")
    rows = Q.monthly_table(spark.read.parquet(f"{tmp_path}/raw"), Q.AS_OF, masks=True)

    # The same failures as the bits, which are made from the values, in the order of the fields.
    names, masks = Q.catalogue.QA_ORDER, list(Q.quality.MASKS)
    stored = rows.select("lnId", "qa", *masks).collect()
    for r in stored:
        found = [n for i, n in enumerate(names) if (r[masks[i // 63]] >> (i % 63)) & 1]
        assert [x for x in r.qa.split(":") if x] == sorted(found, key=rows.columns.index)
    assert len({r.qa for r in stored}) > 5

    exploded = Q.quality.explode_qa(rows, Q.ID)
    told = sorted((r.lnId, r.field) for r in exploded.collect())
    assert told == sorted((r.lnId, x) for r in stored for x in r.qa.split(":"))
    plan = exploded._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Generate"
    wide, node = 0, plan
    while node.nodeName() in ("Generate", "Project"):
        wide += node.nodeName() == "Project" and node.output().size() > 20
        node = node.children().apply(0)
    assert wide == 1


def test_the_flag_of_the_panel_takes_no_projection_of_its_own(spark, tmp_path):
    """the flag is made beside the texts, and says what it said when made from the file."""
    key = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey"}
    more = {
        "customer": {"c_mktsegment": F.lit("M")},
        "orders": {"o_custkey": F.col("id"), "o_totalprice": F.lit(2000.0), "o_orderdate": F.lit("2001-02-03").cast("date")},
        "part": {"p_size": F.lit(9)},
    }
    for name, column in key.items():
        spark.range(-5, 9).withColumns({column: F.col("id"), **more[name]}).drop("id").write.parquet(f"{tmp_path}/{name}.parquet")
    line = {
        "l_orderkey": F.when(F.col("id") != 3, F.col("id")), "l_partkey": F.col("id"), "l_suppkey": F.col("id"), "l_linenumber": F.lit(2),
        "l_quantity": F.lit(12.0), "l_extendedprice": F.lit(1234.5), "l_discount": F.lit(0.04), "l_tax": F.lit(0.02),
        "l_returnflag": F.lit("R"), "l_linestatus": F.lit("F"), "l_shipdate": F.lit("2002-03-04").cast("date"),
    }
    spark.range(-5, 9).withColumns(line).drop("id").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = Q.raw(spark, str(tmp_path))
    assert rows.columns == [*Q.fixtures.raw_panel(spark, str(tmp_path)).columns, "standard"]
    found = {(r.file, r.standard) for r in rows.select("file", "standard").collect()}
    assert found == {("1999Q1.csv", "Y"), ("2000Q1_HARP.csv", "Y"), ("exclusions.csv", "N")}
    plan = rows._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Project" and plan.children().apply(0).nodeName() == "Join"
