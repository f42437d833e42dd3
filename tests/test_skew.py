"""Groups too large for one task: same results as brute force, nothing lost, nothing doubled."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loantape.catalogue import MONTHLY_FIELDS
from loantape.operators import links, quality, skew
from loantape.operators import timeline as tl
from loantape.plans import loans as L
from loantape.sinks.tables import bucket_monthly, write_monthly


def hot_rows(n=600):
    """A third of all rows in one group, a third of that group exact copies."""
    rows = [("hot", i % 40 if i % 3 else 7, "same" if i % 3 == 0 else f"v{i}") for i in range(n // 3)]
    return rows + [(f"k{i % 50}", i, f"w{i}") for i in range(2 * n // 3)]


@pytest.mark.parametrize("limit", [1, 7, 60, 1000])
def test_timeline_pieces(spark, limit):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(5)
    out = tl.timeline(df, ["k"], F.struct("t", "v"), {"t": F.col("t"), "v": F.col("v")}, "a", limit)
    got = {}
    for r in out.collect():
        assert (r.k, r.part) not in got
        got[r.k, r.part] = [tuple(x) for x in r.a]
    want = {}
    for k in {r[0] for r in rows}:
        ordered = sorted((t, v) for kk, t, v in rows if kk == k)
        for i in range(0, len(ordered), limit):
            want[k, i // limit] = ordered[i : i + limit]
    assert got == want


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (None, 3), ("a", 1)], "k string, t int")
    out = tl.timeline(df, ["k"], F.struct("t"), {"t": F.col("t")}, "a", 2).collect()
    assert {(r.k, r.part): [x.t for x in r.a] for r in out} == {
        (None, 0): [1, 2], (None, 1): [3], ("a", 0): [1],
    }


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_links_spread_over_salts(spark, limit):
    left = [("a", 1), ("b", 2), ("c", 3), ("a", 4), (None, 5)]
    entries = [("a", f"x{i % 4}") for i in range(30)] + [("a", "copy")] * 20 + [("b", "y")]
    df = spark.createDataFrame(left, "id string, n int")
    m = spark.createDataFrame([*entries, (None, "z")], "old string, new string").repartition(3)
    out = links.link(df, "id", m, "old", "new", "new", max_matches=limit).collect()
    want = Counter()
    for i, n in left:
        found = [v for k, v in entries if k == i] if i is not None else []
        want.update((i, n, v) for v in (found or [""]))
    assert Counter(tuple(r) for r in out) == want


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 3}, {"max_matches": 4}])
def test_both_ways_at_once(spark, bounds):
    pairs = [(f"{i % 13}", f"{i % 7}") for i in range(40)] + [(None, "1"), ("2", None), ("3", ""), ("", "4"), ("5", "5")]
    id_map = spark.createDataFrame(pairs, "oldLnId string, harpLnId string").repartition(3)
    loans = spark.createDataFrame([(f"{i}", i) for i in range(16)] + [(None, 99), ("", 98), ("3", 97)], "lnId string, n int")
    got = links.link_both(loans, id_map, **bounds)
    assert got.columns == ["lnId", "n", "harpLnId", "preHarpId"]
    want = links.link_predecessor(links.link_successor(loans, id_map), id_map)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    none = links.link_both(loans, id_map.limit(0)).collect()
    assert len(none) == 19 and {(r.harpLnId, r.preHarpId) for r in none} == {("", "")}


def test_large_map_shuffles_loans_once(spark):
    id_map = spark.range(5000).select(F.col("id").cast("string").alias("oldLnId"), (F.col("id") + 1).cast("string").alias("harpLnId"))
    loans = spark.range(9000).select(F.col("id").cast("string").alias("lnId"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = links.link_both(loans, id_map, max_rows=100)
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The loans' exchange and the index's.
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert one.where("harpLnId != ''").count() == 5000


def test_empty_map(spark):
    df = spark.createDataFrame([("a",)], "id string")
    m = spark.createDataFrame([], "old string, new string")
    assert [tuple(r) for r in links.link(df, "id", m, "old", "new", "new").collect()] == [("a", "")]


def test_sort_with_many_copies(spark):
    rows = [(i % 3, 0 if i % 2 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(4)
    for copies in (False, True):
        assert [tuple(r) for r in skew.sort_rows(df, ["a"], copies).collect()] == sorted(rows)


def test_qa_profile_against_brute_force(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 5}", ":a:b:" if i % 2 else "" if i % 7 else ":b:")
            for i in range(200)]
    df = spark.createDataFrame(rows, "k string, qa string")
    got = {r.k: {x.field: x.cntFail for x in r.qa} for r in quality.qa_profile(df, ["k"]).collect()}
    want = {}
    for k, qa in rows:
        for f in filter(None, qa.split(":")):
            want.setdefault(k, Counter())[f] += 1
    assert got == {k: dict(c) for k, c in want.items()}
    counts = quality.failure_counts(F.col("qa"), ["a", "b", "c"])
    grouped = df.groupBy("k").agg(*[c.alias(n) for n, c in counts.items()])
    fused = grouped.select("k", quality.profile_of_counts({n: F.col(n) for n in "abc"}).alias("qa"))
    assert {r.k: {x.field: x.cntFail for x in r.qa} for r in fused.collect() if r.qa} == got


def monthly_rows(spark, n=240):
    """Monthly rows with blank-id copies making up a third."""
    specs = [*MONTHLY_FIELDS]
    base = {f.name: f.missing for f in specs}
    rows = []
    for i in range(n):
        row = dict(base)
        row["file"], row["lnId"] = "f.csv", "" if i % 3 == 0 else f"{100000000000 + i % 11}"
        row["month"] = date(2000, 1, 1) + timedelta(days=31 * (i % 17))
        row["month"] = row["month"].replace(day=1)
        row["payHist"] = f"{i % 60:03d}" if i % 2 else "dup"
        same = i % 2 == 0
        row["upb"] = 1000.0 if same else float(i)
        row["fico"] = -1 if same else 600 + i
        row["channel"] = "X" if same else "RBC"[i % 3]
        row["fpDt"] = date(2001, 2, 1) if i % 4 == 1 else date(1970, 1, 1)
        row["qa"] = ":fico:channel:" if same else (":dti:" if i % 5 == 0 else "")
        row["standard"] = "Y"
        rows.append(tuple(row[f.name] for f in specs))
    return spark.createDataFrame(rows, ", ".join(f"`{f.name}` {f.data_type.simpleString()}" for f in specs))


def joined_pieces(loans, rest=None):
    """Per loan its columns and all its months in order, those in further pieces too."""
    whole = {}
    for r in loans.collect():
        d = r.asDict(recursive=True)
        assert r.lnId not in whole
        whole[r.lnId] = [d, [tuple(m.values()) for m in d.pop("monthly")]]
    for r in sorted(rest.collect(), key=lambda r: r.part) if rest else []:
        whole[r.lnId][1] += [tuple(m.asDict().values()) for m in r.monthly]
    assert all(d["nMonths"] == len(months) for d, months in whole.values())
    return whole


def test_rollup_is_the_same_cut_or_whole(spark):
    # Besides the blank id, one loan without any.
    lnid = F.when(F.col("lnId") == "100000000003", F.lit(None)).otherwise(F.col("lnId"))
    rows = monthly_rows(spark).withColumn("lnId", lnid)
    whole = joined_pieces(L.loan_rollup(rows, tie=["payHist"], piece=None))
    # 16 months per named loan at most, 80 rows of the blank id.
    for piece in (1, 7, 30, 4096):
        loans = L.loan_rollup(rows, tie=["payHist"], piece=piece)
        rest = L.loan_timelines(rows, tie=["payHist"], piece=piece, first=1)
        assert joined_pieces(loans, rest) == whole
        all_ = L.loan_timelines(rows, tie=["payHist"], piece=piece).collect()
        assert sum(len(r.monthly) for r in all_) == 240
        assert {r.part for r in all_ if r.lnId == ""} == set(range(-(-80 // piece)))
    assert len(whole[""][1]) == 80 and None in whole
    names = {q["field"]: q["cntFail"] for q in whole[""][0]["qa"]}
    assert sum(len(m) for _, m in whole.values()) == 240 and names["fico"] == 40


def test_one_count_and_one_ranking_for_both_tables(spark, monkeypatch):
    lnid = F.when(F.col("lnId") == "100000000003", F.lit(None)).otherwise(F.col("lnId"))
    rows = monthly_rows(spark).withColumn("lnId", lnid)
    calls = []
    for name in ("hot_groups", "rank_pieces"):
        plain = getattr(skew, name)
        monkeypatch.setattr(skew, name, lambda *a, f=plain, n=name, **k: calls.append(n) or f(*a, **k))
    kind = type(rows)
    plain_range = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, *a: calls.append("range") or plain_range(self, *a))
    loans, rest = L.loan_tables(rows, piece=7)
    got = joined_pieces(loans, rest)
    assert calls == ["hot_groups", "rank_pieces", "range"]
    monkeypatch.undo()
    assert got == joined_pieces(L.loan_rollup(rows, piece=7), L.loan_timelines(rows, piece=7, first=1))
    none = L.loan_tables(rows, piece=None)[1]
    assert rest.schema.simpleString() == none.schema.simpleString() and none.count() == 0


def test_packed_order_is_the_order_of_date_and_hash(spark):
    dates = F.date_add(F.lit("1970-01-01").cast("date"), (F.pmod(F.xxhash64("id"), F.lit(65536))).cast("int"))
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit("2003-02-01").cast("date")).otherwise(dates).alias("month"))
    rows = rows.withColumn("h", F.xxhash64("id", "month"))
    held = rows.select("id", tl.packed_order(F.col("month"), F.col("h")).alias("p"), "month", "h").collect()
    assert [r.id for r in sorted(held, key=lambda r: r.p)] == [r.id for r in sorted(held, key=lambda r: (r.month, r.h))]
    assert len({r.p for r in held}) == 3000 and min(r.p for r in held) >= 0


def test_result_does_not_depend_on_partitioning(spark):
    rows = monthly_rows(spark)
    seen = []
    for parts, shuffles in ((1, 1), (16, 64)):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffles))
        seen.append(joined_pieces(L.loan_rollup(rows.repartition(parts), piece=None)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_invariants(spark):
    rows = monthly_rows(spark)
    loans = L.loan_rollup(rows, tie=["payHist"]).collect()
    assert len(loans) == rows.select("file", "lnId").distinct().count()
    for r in loans:
        months = [m.month for m in r.monthly]
        assert months == sorted(months)
        counts = {q.field: q.cntFail for q in r.qa}
        assert set(r.allFail) == {f for f, n in counts.items() if n == len(months)}
        assert all(n <= len(months) for n in counts.values())


def test_one_shuffle_before_the_links(spark, tmp_path):
    path = str(tmp_path / "m")
    monthly_rows(spark).write.parquet(path)
    loans = L.loan_rollup(spark.read.parquet(path), tie=["payHist"], piece=None)
    plan = loans._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Python" not in plan and "Window" not in plan


def test_whole_rollup_holds_no_texts_of_known_fields(spark, tmp_path):
    rows = monthly_rows(spark)
    rows = rows.withColumn("qa", F.when(F.col("upb") > 100, F.concat(F.lit(":zz"), F.when(F.col("qa") == "", ":").otherwise(F.col("qa")))).otherwise(F.col("qa")))
    rows = write_monthly(rows, str(tmp_path / "m"))
    loans = L.loan_rollup(rows, tie=["payHist"], piece=None)
    assert "collect_list(qa#" not in loans._jdf.queryExecution().optimizedPlan().toString()
    want = {r.lnId: [tuple(x) for x in r.qa] for r in quality.qa_profile(rows, ["file", "lnId"]).collect()}
    assert {r.lnId: [tuple(x) for x in r.qa] for r in loans.collect()} == want
    assert {"zz", "fico", "dti"} <= {f for f, _ in want[""]}


def test_loans_of_a_few_pieces_are_not_ranked(spark, monkeypatch):
    rows = monthly_rows(spark).where("lnId != ''")
    whole = joined_pieces(L.loan_rollup(rows, tie=["payHist"], piece=None))
    monkeypatch.setattr(skew, "rank_pieces", lambda *a, **k: pytest.fail("ranked"))
    loans, rest = L.loan_tables(rows, tie=["payHist"], piece=3)
    assert max(len(r.monthly) for r in loans.collect()) == 3
    assert max(len(r.monthly) for r in rest.collect()) == 3 and min(r.part for r in rest.collect()) == 1
    assert joined_pieces(loans, rest) == whole
    all_ = L.loan_timelines(rows, tie=["payHist"], piece=3)
    assert joined_pieces(loans, all_.where("part > 0")) == whole
    assert "Window" not in loans._jdf.queryExecution().executedPlan().toString()


def test_ranked_rows_are_stored_packed_and_offsets_broadcast(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") % 700).alias("o"), F.col("id").alias("i"))
    pieces = skew.rank_pieces(rows, ["k"], F.col("o"), F.struct("i"), 100, 3000)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "SortMergeJoin" not in plan
    got = {(r.k, r.part): [x.i for x in r.items] for r in skew.gather_pieces(pieces, ["k"], "items").collect()}
    for k in (0, 1):
        ordered = sorted(range(k, 3000, 2), key=lambda i: (i % 700, i))
        assert [got[k, p] for p in range(15)] == [ordered[p * 100 : p * 100 + 100] for p in range(15)]


def in_buckets(spark, tmp_path, rows, limit):
    staged = write_monthly(rows, str(tmp_path / f"staged{limit}"))
    return bucket_monthly(staged, "monthly_in_buckets", str(tmp_path / f"kept{limit}"), ["file", "lnId"], limit, 3)


def test_buckets_hold_all_but_the_long_loans(spark, tmp_path):
    lnid = F.when(F.col("lnId") == "100000000003", F.lit(None)).otherwise(F.col("lnId"))
    rows = monthly_rows(spark).withColumn("lnId", lnid)
    whole = joined_pieces(L.loan_rollup(rows, tie=["payHist"], piece=None))
    # Longer than 1: all loans; than 30: the blank id; than 4096: none.
    for limit, kept_rows in ((1, 0), (30, 160), (4096, 240)):
        kept, rest = in_buckets(spark, tmp_path, rows, limit)
        assert kept.count() == kept_rows and (rest is None) == (kept_rows == 240)
        loans = L.bucketed_rollup(kept, rest, tie=["payHist"], piece=limit)
        pieces = None if rest is None else L.loan_timelines(rest, tie=["payHist"], piece=limit, first=1)
        assert joined_pieces(loans, pieces) == whole


def test_no_exchange_above_buckets(spark, tmp_path):
    kept, _ = in_buckets(spark, tmp_path, monthly_rows(spark), 4096)
    other = spark.table("monthly_in_buckets").select("file", "lnId", F.col("month").alias("m"))
    for df in (
        L.bucketed_rollup(kept, None, tie=["payHist"]),
        skew.group_sizes(kept, ["file", "lnId"]),
        quality.qa_profile(kept, ["file", "lnId"]),
        kept.hint("merge").join(other, ["file", "lnId"]),
    ):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_empty_table_in_buckets(spark, tmp_path):
    kept, rest = in_buckets(spark, tmp_path, monthly_rows(spark).limit(0), 5)
    assert rest is None and kept.count() == 0
    assert L.bucketed_rollup(kept, rest).count() == 0
