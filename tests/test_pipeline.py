"""Hand-written tapes through the whole pipeline, one for each way a field can go."""

from datetime import date
from pathlib import Path

import pytest
import tapes
from pyspark.sql import functions as F

from loantape.catalogue import QA_ORDER, fields
from loantape.plans.build import build_loans
from loantape.operators import quality, ranges
from loantape.plans.loans import loan_rollup, loan_schema
from loantape.plans.monthly import monthly_table
from loantape.sinks import runs
from loantape.sinks.tables import describe_table
from loantape.sources import tape

AS_OF = date(2024, 1, 1)
EPOCH = date(1970, 1, 1)


def monthly(spark, tmp_path, lines, name="2010Q1.csv"):
    path = tapes.write(tmp_path, name, lines)
    return monthly_table(tape.scan_loans(spark, path), AS_OF)


def one(spark, tmp_path, **values):
    return monthly(spark, tmp_path, [tapes.line(**values)]).collect()[0]


def test_good_row(spark, tmp_path):
    row = one(spark, tmp_path)
    assert row.qa == ""
    assert (row.month, row.channel, row.rate, row.fico) == (date(2010, 1, 1), "R", 4.5, 740)
    assert (row.dq, row.vintage, row.propVal, row.standard) == (0, "2010Q1", 250000.0, "Y")
    assert row.file == str(tmp_path / "2010Q1.csv")
    assert (row.nsDoc, row.negAm) == ("N", "N")


def test_empty_with_default_passes(spark, tmp_path):
    row = one(spark, tmp_path, seller="", mi="", zb="", altRes="", coFico="", msa="", miType="")
    assert row.qa == ""
    assert (row.seller, row.mi, row.zb, row.altRes) == ("unknown", 0.0, "00", "7")
    assert (row.coFico, row.msa, row.miType) == (0, "00000", "0")


def test_text_that_equals_an_illegal_default_fails(spark, tmp_path):
    row = one(spark, tmp_path, coFico="0", cltv="-1", zb="00", miType="0", zbDt="011970")
    assert row.qa == ":cltv:coFico:zb:zbDt:miType:"
    assert (row.coFico, row.cltv, row.zb, row.miType, row.zbDt) == (-1, -1, "X", "X", EPOCH)


def test_empty_without_default_fails(spark, tmp_path):
    row = one(spark, tmp_path, fico="", channel="", origDt="", rate="")
    assert row.qa == ":channel:rate:origDt:fico:"
    assert (row.fico, row.channel, row.origDt, row.rate) == (-1, "X", EPOCH, -1.0)


def test_empty_free_text_passes(spark, tmp_path):
    row = one(spark, tmp_path, lnId="", payHist="")
    assert (row.lnId, row.payHist, row.qa) == ("", "", "")


@pytest.mark.parametrize(
    "text", ["132020", "002020", "2020", "1 2020", "ab2020", "0120200", "01/202", "x"]
)
def test_bad_months(spark, tmp_path, text):
    row = one(spark, tmp_path, month=text)
    assert (row.month, row.qa) == (EPOCH, ":month:")


def test_bad_numbers(spark, tmp_path):
    row = one(spark, tmp_path, ltv="abc", opb="1.2.3", numBorr="2.0")
    # A property value needs both the balance and the ltv.
    assert row.qa == ":opb:ltv:numBorr:propVal:"
    assert (row.ltv, row.opb, row.propVal, row.numBorr) == (-1, -1.0, -1.0, -1)


def test_out_of_range(spark, tmp_path):
    row = one(spark, tmp_path, fico="900", fpDt="121998", curRate="15.01", matDt="022064")
    assert row.qa == ":curRate:fpDt:matDt:fico:"
    assert (row.fico, row.fpDt, row.vintage) == (-1, EPOCH, "XXXXQX")


def test_range_limits_belong_to_it(spark, tmp_path):
    row = one(
        spark, tmp_path, fico="850", fpDt="011999", curRate="15", matDt="012064", ltv="998",
        opb="2000000", month="012024",
    )
    assert row.qa == ""


def test_levels(spark, tmp_path):
    row = one(spark, tmp_path, channel="T", state="ZZ", zip3="000", dqStat="XX", program="Z")
    assert row.qa == ":channel:state:zip3:dqStat:program:dq:"
    assert (row.channel, row.state, row.zip3, row.dqStat, row.dq) == ("X", "XX", "XXX", "!", -1)


def test_retired_area_code_is_replaced_and_passes(spark, tmp_path):
    row = one(spark, tmp_path, msa="31100")
    assert (row.msa, row.qa) == ("31080", "")
    assert one(spark, tmp_path, msa="99999").qa == ":msa:"


def test_explicit_area_codes(spark, tmp_path):
    path = tapes.write(tmp_path / "codes", "msa.txt", ["31080", "", " 10180 ", "31080\r"])
    codes = tape.read_codes(spark, path, "msa")
    assert sorted(map(tuple, codes.collect())) == [("msa", "10180"), ("msa", "31080")]
    path = tapes.write(
        tmp_path / "in", "a.csv", [tapes.line(msa=m) for m in ("10180", "12345", "31100", "")]
    )
    rows = monthly_table(tape.scan_loans(spark, path), AS_OF, codes=codes).collect()
    listed = fields(msa_codes=["31080", "10180"])
    again = monthly_table(tape.scan_loans(spark, path, listed), AS_OF, listed).collect()
    assert sorted((r.msa, r.qa) for r in rows) == sorted((r.msa, r.qa) for r in again) == [
        ("00000", ""), ("10180", ""), ("31080", ""), ("XXXXX", ":msa:"),
    ]


def misfits(spark, tmp_path, lines, name="a.csv"):
    path = tapes.write(tmp_path, name, lines)
    return tape.split_misfits(tape.scan_loans(spark, path, line="__line"), "__line")


def test_rows_that_do_not_fit(spark, tmp_path):
    short, long, quote = "|".join(tapes.line().split("|")[:20]), tapes.line() + "||", tapes.line(seller='"Bank')
    good = [tapes.line(lnId="1"), tapes.line(lnId="2", seller='"Bank | ""B"""'), tapes.line(lnId="3", seller='5" pipe')]
    fit, odd = misfits(spark, tmp_path, [good[0], short, *good[1:], long, quote, "", "x"])
    assert [r.lnId for r in fit.collect()] == ["1", "2", "3"]
    assert "__line" not in fit.columns
    got = {r.line: (r.file, r.reason, r.n_columns, r.layout) for r in odd.collect()}
    at = str(tmp_path / "a.csv")
    assert {k: v for k, v in got.items() if k != quote} == {
        short: (at, "short", 20, 108), long: (at, "long", 110, 108), "x": (at, "short", 1, 108),
    }
    assert got[quote][1] == "open quote"


def test_files_that_all_fit_have_no_misfits(spark, tmp_path):
    tapes.write(tmp_path, "a.csv", [tapes.line()] * 3)
    tapes.write(tmp_path, "b.csv", [tapes.line(112)] * 2 + [tapes.line()])
    rows = tape.scan_directory(spark, str(tmp_path), line="__line")
    fit, odd = tape.split_misfits(rows, "__line")
    assert fit.count() == 5
    assert [(r.file[-5:], r.reason, r.n_columns, r.layout) for r in odd.collect()] == [("b.csv", "short", 108, 112)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan.split("ReadSchema:")[-1]


def test_derived_fields_can_stay_out_of_qa(spark, tmp_path):
    path = tapes.write(tmp_path, "a.csv", [tapes.line(dqStat="XX", ltv="")])
    raw = tape.scan_loans(spark, path)
    assert monthly_table(raw, AS_OF).collect()[0].qa == ":ltv:dqStat:dq:propVal:"
    assert monthly_table(raw, AS_OF, qa_derived=False).collect()[0].qa == ":ltv:dqStat:"


def test_property_value_range(spark, tmp_path):
    row = one(spark, tmp_path, opb="2000000", ltv="1")
    assert (row.propVal, row.qa) == (-1.0, ":propVal:")


def test_quoted_separator(spark, tmp_path):
    row = one(spark, tmp_path, seller='"Bank | ""B"""')
    assert (row.seller, row.qa) == ('Bank | "B"', "")


def test_wide_file(spark, tmp_path):
    lines = [tapes.line(112, nsDoc="Y", nsUw="", gGuar="Q", negAm="N")]
    row = monthly(spark, tmp_path, lines, "ns.csv").collect()[0]
    assert (row.standard, row.nsDoc, row.nsUw, row.gGuar) == ("N", "Y", "N", "X")
    assert row.qa == ":gGuar:"


def test_odd_width_raises(spark, tmp_path):
    path = tapes.write(tmp_path, "odd.csv", [tapes.line() + "||"])
    with pytest.raises(ValueError, match="110"):
        tape.scan_loans(spark, path)


def test_discovery(spark, tmp_path):
    for name in ("b.csv", "a.csv", "My_Loan.csv", "notes.txt", "Loan_Mapping.txt"):
        tapes.write(tmp_path, name, ["x"])
    tapes.write(tmp_path / "sub", "c.csv", ["x"])
    found = tape.discover_files(spark, str(tmp_path)).collect()
    assert [r.file_name for r in found] == ["a.csv", "b.csv"]
    assert found[0].file == str(tmp_path / "a.csv")
    assert tape.has_id_map(spark, str(tmp_path))
    assert not tape.has_id_map(spark, str(tmp_path / "sub"))
    empty = tmp_path / "none"
    tapes.write(empty, "notes.txt", ["x"])
    with pytest.raises(FileNotFoundError):
        tape.scan_directory(spark, str(empty))


def test_two_runs_into_one_table(spark, tmp_path):
    std, ns = tmp_path / "std", tmp_path / "ns"
    months = ["012010", "022010", "032010"]
    tapes.write(std, "2010Q1.csv", [tapes.line(month=m, dti="99") for m in reversed(months)])
    tapes.write(
        std, "2012_HARP.csv",
        [tapes.line(lnId="200000000001", month=m, upb=str(1000 * i), fico="" if i == 1 else "700")
         for i, m in enumerate(months)],
    )
    tapes.write(std, "other_Loan.csv", ["skipped"])
    tapes.write(std, "Loan_Mapping.txt", ["100000000001,200000000001"])
    tapes.write(ns, "excl.csv", [tapes.line(112, month=m, nsDoc="Y") for m in months])
    options = {
        "table": "two_runs", "id_map_path": str(tmp_path / "map"), "as_of": AS_OF,
        "path": str(tmp_path / "loans"),
    }
    build_loans(spark, str(std), **options)
    loans = build_loans(spark, str(ns), create=False, **options)
    rows = {r.file.rsplit("/", 1)[-1]: r for r in loans.collect()}
    assert set(rows) == {"2010Q1.csv", "2012_HARP.csv", "excl.csv"}
    old, new, excl = rows["2010Q1.csv"], rows["2012_HARP.csv"], rows["excl.csv"]
    assert [m.month for m in old.monthly] == [
        date(2010, 1, 31), date(2010, 2, 28), date(2010, 3, 31),
    ]
    assert [m.ageFpDt for m in old.monthly] == [0, 1, 2]
    assert {m.servicer for m in old.monthly} == {"servicer one"}
    assert old.seller == "Bank A"
    assert (old.harpLnId, old.preHarpId) == ("200000000001", "")
    assert (new.harpLnId, new.preHarpId) == ("", "100000000001")
    assert (excl.harpLnId, excl.standard, excl.nsDoc) == ("200000000001", "N", "Y")
    assert (old.harp, new.harp, old.bucket, new.bucket) == ("N", "Y", 16, 16)
    assert [tuple(q) for q in old.qa] == [("dti", 3)] and old.allFail == ["dti"]
    assert [tuple(q) for q in new.qa] == [("fico", 1)] and new.allFail == []
    assert (old.dti, new.fico, new.nMonths) == (-1.0, 700, 3)
    assert [m.upb for m in new.monthly] == [0.0, 1000.0, 2000.0]
    assert excl.qa == [] and excl.allFail == []
    described = describe_table(spark, "two_runs").collect()
    assert len(described) == 87
    assert described[1][1:] == ("monthly.month", "array<date>", "month of data, missing=1970/1/1")
    names = [f.name for f in loan_schema().fields]
    assert loans.columns == names
    assert spark.table("two_runs_months").count() == 0
    # Staged rows are gone.
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(shared.glob("monthly-*"))
    drop_views(spark, "two_runs")


def drop_views(spark, table):
    for view in (table, f"{table}_months", f"{table}_misfits"):
        spark.sql(f"DROP VIEW IF EXISTS {view}")


def contents(spark, table):
    kept = [sorted(spark.table(t).select(F.to_json(F.struct("*")).alias("j")).collect()) for t in (table, f"{table}_months", f"{table}_misfits")]
    return [[r.j for r in rows] for rows in kept]


def tape_folders(tmp_path):
    std, ns = tmp_path / "std", tmp_path / "ns"
    months = ["012010", "022010", "032010"]
    tapes.write(std, "2010Q1.csv", [tapes.line(lnId=str(i), month=m) for i in range(40) for m in months] + ["short|row"])
    tapes.write(std, "2010Q2.csv", [tapes.line(lnId=str(i), month=m) for i in range(40, 50) for m in months])
    tapes.write(std, "Loan_Mapping.txt", ["3,45"])
    tapes.write(ns, "excl.csv", [tapes.line(112, lnId="3", month=m, nsDoc="Y") for m in months] + [tapes.line(112, lnId="3")] * 9)
    return str(std), str(ns)


def run_options(tmp_path, name, **more):
    return {"table": name, "id_map_path": str(tmp_path / f"map_{name}"), "as_of": AS_OF, "path": str(tmp_path / name), "piece": 6, **more}


def test_run_that_dies_between_its_tables_and_is_repeated(spark, tmp_path, monkeypatch):
    std, ns = tape_folders(tmp_path)
    clean, again = run_options(tmp_path, "clean"), run_options(tmp_path, "again")
    for options in (clean, again):
        build_loans(spark, std, **options)
    first = contents(spark, "again")
    assert [len(rows) for rows in first] == [50, 0, 1]
    write = runs.write_table

    def dies(df, path, run, name, *args, **how):
        if name == "months":
            raise KeyboardInterrupt
        write(df, path, run, name, *args, **how)

    monkeypatch.setattr(runs, "write_table", dies)
    with pytest.raises(KeyboardInterrupt):
        build_loans(spark, ns, create=False, **again)
    # As after a kill, nothing tidies up.
    monkeypatch.setattr(runs, "abandon", lambda *args: None)
    with pytest.raises(KeyboardInterrupt):
        build_loans(spark, ns, create=False, **again)
    monkeypatch.undo()
    assert contents(spark, "again") == first
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("monthly-*"))
    # Each file once, however often it is loaded.
    build_loans(spark, ns, create=False, **clean)
    for _ in range(2):
        build_loans(spark, ns, create=False, **again)
    build_loans(spark, std, create=False, **again)
    assert contents(spark, "again") == contents(spark, "clean")
    assert [len(rows) for rows in contents(spark, "again")] == [51, 1, 1]
    path = str(tmp_path / "again")
    assert len(runs.vacuum(spark, path, 0.0)) == 3 and runs.vacuum(spark, path, 0.0) == []
    assert contents(spark, "again") == contents(spark, "clean")
    build_loans(spark, ns, **again)
    assert {r.file for r in spark.table("again").select("file").collect()} == {f"{ns}/excl.csv"}
    for name in ("clean", "again"):
        drop_views(spark, name)


def test_two_runs_that_commit_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    rows = {f: spark.createDataFrame([(f, "1", n)], "file string, lnId string, n int") for n, f in enumerate("abc")}
    for f in "ab":
        runs.write_table(rows[f], path, f"run-{f}", "loans", ["lnId"])
    schema = {"loans": rows["a"].schema}
    current, calls = runs.current, []

    def slow(*args):
        found = current(*args)
        if not calls:
            calls.append(1)
            runs.commit(spark, path, "run-b", ["b"], schema)
        return found

    monkeypatch.setattr(runs, "current", slow)
    runs.commit(spark, path, "run-a", ["a"], schema)
    monkeypatch.undo()
    assert runs.current(spark, path).version == 2
    assert sorted((r.file, r.n) for r in runs.read_table(spark, path, "loans").collect()) == [("a", 0), ("b", 1)]
    with pytest.raises(ValueError, match="columns"):
        runs.commit(spark, path, "run-c", ["c"], {"loans": rows["c"].drop("n").schema})
    # A file of which nothing is left, and only its own partitions are read.
    runs.commit(spark, path, "run-d", ["a"], schema)
    with pytest.raises(FileNotFoundError):
        runs.read_table(spark, path, "other")
    plan = runs.read_table(spark, path, "loans", runs.Manifest(1, {"b": "run-b"}, runs.current(spark, path).schemas))
    assert "PartitionFilters: [isnotnull(file" in plan._jdf.queryExecution().executedPlan().toString()


def test_ranges_from_the_keys(spark, tmp_path):
    keys = spark.range(6000).select(
        F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("f"), (F.col("id") % 3).cast("string"))).alias("file"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 2 == 0, "same").otherwise(F.hash("id").cast("string")).alias("lnId"),
    )
    some = keys.where("file is null or file != 'f1'")
    bounds = [b for b in ranges.key_bounds(some, 1)]
    assert bounds == []
    for n in (2, 5, 40):
        import loantape.operators.ranges as R

        few, R.LEAST_ROWS = R.LEAST_ROWS, 6000 // n
        try:
            bounds = R.key_bounds(some, n)
        finally:
            R.LEAST_ROWS = few
        assert 0 < len(bounds) < n + 1
        placed = ranges.by_ranges(keys, ["file", "lnId"], bounds).withColumn("p", F.spark_partition_id()).collect()
        order = lambda k: tuple((x is not None, x or "") for x in k)
        assert len(placed) == 6000
        for r in placed:
            assert r.p == sum(order(b) < order((r.file, r.lnId)) for b in bounds)
    assert ranges.by_ranges(keys, ["file", "lnId"], []).rdd.getNumPartitions() == 1


def test_plan_of_the_loans_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def noted(i):
        seen.add(1)
        return i

    keys = spark.range(300_000).select(F.concat(F.lit("f"), (F.col("id") % 4).cast("string")).alias("file"), F.hash("id").cast("string").alias("lnId"), F.col("id").cast("int").alias("n"))
    keys.write.parquet(str(tmp_path / "keys"))
    stored = spark.read.parquet(str(tmp_path / "keys"))
    runs.write_loans(stored.where("n < 3000").withColumn("n", noted("n")), "once", path=str(tmp_path / "once"), keys=stored)
    assert seen.value == 3000
    files = runs.read_table(spark, str(tmp_path / "once"), "loans").groupBy("file", F.input_file_name().alias("f"))
    ends = sorted(tuple(r) for r in files.agg(F.min("lnId"), F.max("lnId")).drop("f").collect())
    assert len(ends) > 4 and all(a[0] != b[0] or a[2] < b[1] for a, b in zip(ends, ends[1:]))
    spark.sql("DROP VIEW once")


def test_finished_rollup_runs_once(spark, tmp_path):
    std, _ = tape_folders(tmp_path)
    m = monthly_table(tape.scan_directory(spark, std), AS_OF)
    rows = ranges.by_ranges(loan_rollup(m), ["file", "lnId"], [("a", "1"), ("b", None)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_written_files_hold_ranges_of_the_key(spark, tmp_path):
    rows = spark.range(4000).select(F.lit("a").alias("file"), F.lpad(F.hash("id").cast("string"), 12, "0").alias("lnId"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    runs.write_loans(rows.repartition(5), "ranged", path=str(tmp_path / "ranged"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = runs.read_table(spark, str(tmp_path / "ranged"), "loans").groupBy(F.input_file_name().alias("f"))
    ends = sorted(tuple(r) for r in stored.agg(F.min("lnId"), F.max("lnId")).drop("f").collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    spark.sql("DROP VIEW ranged")


@pytest.mark.parametrize("piece", [1, 3, 4096, None])
def test_failures_counted_from_bits(spark, tmp_path, piece):
    bad = {"fico": "x", "channel": "", "rate": "99", "state": "ZZ", "dqStat": "??", "opb": "1", "negAm": "Q", "totDefrl": "-1", "lnId": None}
    names = list(bad)[:-1]
    lines = []
    for i in range(60):
        broken = {n: bad[n] for k, n in enumerate(names) if i >> k % 5 & 1 and (i + k) % 3}
        lines.append(tapes.line(112, lnId=str(i % 7), month=f"{1 + i % 12:02d}2010", **broken))
    path = tapes.write(tmp_path, "a.csv", lines)
    raw = tape.scan_loans(spark, path)
    texts, bits = monthly_table(raw, AS_OF), monthly_table(raw, AS_OF, masks=True)
    assert [c for c in bits.columns if c not in texts.columns] == list(quality.MASKS)
    for r in bits.collect():
        value = r["__failed0"] | r["__failed1"] << quality.MASK_BITS
        assert {n for i, n in enumerate(QA_ORDER) if value >> i & 1} == set(filter(None, r.qa.split(":")))
    want = {r.lnId: r for r in loan_rollup(texts, tie=["month"], piece=piece).collect()}
    got = {r.lnId: r for r in loan_rollup(bits, tie=["month"], piece=piece).collect()}
    assert {k: (r.qa, r.allFail, r.nMonths) for k, r in got.items()} == {k: (r.qa, r.allFail, r.nMonths) for k, r in want.items()}
    assert sum(len(r.qa) for r in got.values()) > 20


def test_texts_of_failures_stay_out_of_the_shuffle(spark, tmp_path):
    path = tapes.write(tmp_path, "a.csv", [tapes.line(fico="x")] * 3)
    monthly_table(tape.scan_loans(spark, path), AS_OF, masks=True).write.parquet(str(tmp_path / "m"))
    loans = loan_rollup(spark.read.parquet(str(tmp_path / "m")), tie=["payHist"], piece=None)
    plan = loans._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "qa:string" not in plan.split("ReadSchema:")[-1]
    assert [(q.field, q.cntFail) for q in loans.collect()[0].qa] == [("fico", 3)]


def test_numbers_look_like_numbers(spark):
    from loantape.functions.scalars import parse

    texts = ["1", " -2.50 ", "1e3", ".5", "7.", "1d", "2.5f", "3F", "4D", "NaN", "Infinity", "-inf", "0x1p3", "1e99", "", "-", "."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse(F.col("t"), "float")).collect()]
    assert got == [1.0, -2.5, 1000.0, 0.5, 7.0] + [None] * 12


def test_harp_in_the_directory_counts(spark, tmp_path):
    from loantape.plans.loans import loan_rollup

    m = monthly(spark, tmp_path / "HARP 1+1%", [tapes.line()], "a.csv")
    row = loan_rollup(m).collect()[0]
    assert row.file == str(tmp_path / "HARP 1+1%" / "a.csv")
    assert row.harp == "Y"


def test_scan_prunes_columns(spark, tmp_path):
    path = tapes.write(tmp_path, "a.csv", [tapes.line()])
    plan = tape.scan_loans(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan.split("ReadSchema:")[-1]
    assert monthly_table(tape.scan_loans(spark, path), AS_OF).select(
        F.col("qa")
    ).columns == ["qa"]
