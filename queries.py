"""One query per operator, on a loan panel derived from the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import fixtures
from loantape import catalogue
from loantape import functions as fn
from loantape.operators import aggregate as A
from loantape.operators import derive, links, quality, skew
from loantape.operators import timeline as tl
from loantape.operators import validate as V
from loantape.plans import loans as L
from loantape.plans.build import build_loans
from loantape.plans.monthly import STANDARD_VALUES, describe_fields, monthly_table
from loantape.session import configure
from loantape.sinks import runs, tables
from loantape.sources import tape
from loantape.spec import FieldSpec, schema_of

AS_OF = date(2024, 1, 1)
KEYS = ["file", "lnId"]
ID = ["file", "lnId", "payHist"]
TAPE_PARTS = ("1999Q1.csv", "2000Q1_HARP.csv", "exclusions.csv")
# Tapes are mostly separators; packed they take less than a third of the disk.
PACKED = "gzip"
# Rows of a tape file that cannot be divided for reading.
FILE_ROWS = 500_000
# Months in a row of ``loan_rollup_blank``.
BLANK_PIECE = tl.PIECE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---- inputs ----------------------------------------------------------------------------------


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """All fields as text, one row per loan and month."""
    configure(spark)
    return fixtures.raw_panel(spark, sf, True)


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_table(raw(spark, sf), AS_OF)


def stored_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly table with its failures as bits, stored, for plans that read it more than once."""
    rows = monthly_table(raw(spark, sf), AS_OF, masks=True)
    return tables.write_monthly(rows, new_folder(spark, "monthly"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf}/events.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{skew.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_tape(spark: SparkSession, sf: str, by_loan: bool = False) -> str:
    """The panel as tape files: one folder per source file, 112 columns for the non-standard one.
    ``by_loan`` keeps a loan's months in one file."""
    base = new_folder(spark, "tape")
    panel = fixtures.raw_panel(spark, sf)
    for part in TAPE_PARTS:
        extended = part == "exclusions.csv"
        width = catalogue.EXTENDED_WIDTH if extended else catalogue.STANDARD_WIDTH
        columns = [
            F.col(c) if c in panel.columns else F.lit("").alias(c)
            for c in catalogue.column_names(width)
        ]
        rows = panel.where(F.col("file") == part)
        # Dealt out before the columns that are empty are added.
        rows = (rows.repartition("lnId") if by_loan else rows).select(*columns)
        rows.write.option("sep", "|").option("emptyValue", "").option("compression", PACKED).csv(f"{base}/{part}")
    return base


def scanned(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return tape.scan_loans(spark, f"{write_tape(spark, sf)}/*")


def folder(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def flat(c: Column) -> Column:
    """Floating-point results on the four decimals both engines agree on."""
    return F.round(c.cast("double"), 4)


def order() -> Column:
    return tl.order_key(F.col("month"), F.col("payHist"))


def text_of(items: Column) -> Column:
    return F.array_join(items, ";")


def per_loan(df: DataFrame, **aggregates: Column) -> DataFrame:
    return df.groupBy(*KEYS).agg(*[c.alias(n) for n, c in aggregates.items()])


def arrays(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """Per loan the named monthly fields as parallel arrays in month order."""
    fields = {n: F.col(n) for n in names}
    rows = tl.timeline(monthly(spark, sf), KEYS, order(), fields, "monthly")
    return rows.select(*KEYS, *[F.col(f"monthly.{n}").alias(n) for n in names])


def profile_text(profile: Column) -> Column:
    pair = lambda p: F.concat(p["field"], F.lit("="), p["cntFail"].cast("string"))
    return text_of(F.transform(profile, pair))


# ---- sources and sinks -----------------------------------------------------------------------


@query
def scan_loans(spark, sf):
    rows = scanned(spark, sf).withColumn("file", folder(F.col("file")))
    names = [f.name for f in [*catalogue.TAPE_FIELDS, *catalogue.EXTENDED_FIELDS]]
    filled = [F.coalesce(F.col(n), F.lit("")).alias(n) for n in names]
    return rows.select("file", "standard", *filled)


@query
def scan_misfits(spark, sf):
    """Tapes with short and long rows and quotes left open: what fits, and the others by reason."""
    configure(spark)
    base, panel = new_folder(spark, "misfits"), fixtures.raw_panel(spark, sf)
    kind = F.col("zip3").cast("int") % 17
    for part in TAPE_PARTS:
        width = catalogue.EXTENDED_WIDTH if part == "exclusions.csv" else catalogue.STANDARD_WIDTH
        given = [F.col(c) if c in panel.columns else F.lit("") for c in catalogue.column_names(width)]
        seller = catalogue.column_names(width).index("seller")
        opened = [F.concat(F.lit('"'), c) if i == seller else c for i, c in enumerate(given)]
        line = F.when(kind == 3, F.concat_ws("|", *given[:20])).when(kind == 5, F.concat_ws("|", *given, F.lit("x"), F.lit("y")))
        line = line.when(kind == 7, F.concat_ws("|", *opened)).otherwise(F.concat_ws("|", *given))
        rows = panel.where(F.col("file") == part).select(line.alias("value"), kind.isin(3, 5, 7).alias("odd"))
        # The first line of a file tells its layout, so it has to be a good one.
        files = max(2, -(-panel.where(F.col("file") == part).count() // FILE_ROWS))
        rows = rows.repartition(files).sortWithinPartitions("odd").select("value")
        rows.write.option("compression", PACKED).text(f"{base}/{part}")
    fit, misfits = tape.split_misfits(tape.scan_loans(spark, f"{base}/*", line="__line"), "__line")
    layout = F.when(F.col("standard") == "Y", catalogue.STANDARD_WIDTH).otherwise(catalogue.EXTENDED_WIDTH)
    ours = [folder(F.col("file")).alias("file")]
    return fit.select(*ours, F.lit("fits").alias("reason"), layout.alias("n_columns"), layout.alias("layout"), "lnId", "payHist", "seller").unionByName(
        misfits.select(*ours, "reason", "n_columns", "layout", F.split("line", r"\|")[1].alias("lnId"), F.lit("").alias("payHist"), F.lit("").alias("seller"))
    ).withColumn("seller", F.coalesce("seller", F.lit("")))


@query
def discover_files(spark, sf):
    configure(spark)
    base = write_tape(spark, sf)
    # Files that are no tapes lie beside them.
    spark.read.parquet(f"{sf}/region.parquet").select("r_name").write.text(f"{base}/notes")
    found = tape.discover_files(spark, f"{base}/*")
    return found.select(folder(F.col("file")).alias("folder")).distinct()


@query
def detect_layout(spark, sf):
    configure(spark)
    layouts = tape.detect_layout(spark, f"{write_tape(spark, sf)}/*")
    return layouts.select(folder(F.col("uri")).alias("folder"), "width", "standard").distinct()


def _id_map_file(spark, sf):
    path = new_folder(spark, "map")
    fixtures.id_map(spark, sf).write.csv(path)
    return path


@query
def scan_id_map(spark, sf):
    return tape.scan_id_map(spark, _id_map_file(spark, sf))


@query
def write_monthly(spark, sf):
    stored = tables.write_monthly(monthly(spark, sf), new_folder(spark, "monthly"))
    amounts = [flat(F.col(c)).alias(c) for c in ("upb", "propVal")]
    return stored.select(*ID, F.col("month").cast("string"), "dq", "vintage", "qa", *amounts)


def _store_loans(spark, loans_list, keys_list, rests=()):
    """The loans as one table, a run for each; ranges come from the stored rows they are made of. What
    timelines have beyond their first pieces, if any has, is stored beside them by the same commits."""
    table, path = f"loans_{uuid.uuid4().hex}", new_folder(spark, "loans")
    further = {}
    if any(rest is not None for rest in rests):
        none = next(rest for rest in rests if rest is not None).limit(0)
        further = {i: {"months": none if rest is None else rest} for i, rest in enumerate(rests)}
    for i, (loans, keys) in enumerate(zip(loans_list, keys_list, strict=True)):
        runs.write_loans(loans, table, create=i == 0, path=path, keys=keys, **further.get(i, {}))
    return table


def _n_months(spark, table, rests):
    """The stored loans with ``n``, their months in all stored pieces."""
    stored = spark.table(table).withColumn("n", F.size("monthly"))
    if all(rest is None for rest in rests):
        return stored
    more = spark.table(f"{table}_months").groupBy(*KEYS).agg(F.sum(F.size("monthly")).cast("int").alias("__more"))
    return _joined(stored, more).withColumn("n", F.col("n") + F.coalesce("__more", F.lit(0))).drop("__more")


def _joined(df, more):
    """Columns attached by the loan's key, NULL where it has none; NULL keys match."""
    known = more.withColumnsRenamed({k: f"__{k}" for k in KEYS})
    match = F.lit(True)
    for k in KEYS:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(known, match, "left").drop(*[f"__{k}" for k in KEYS])


def _rolled(spark, sf, rows=None, **options):
    options = {"tie": ["payHist"], **options}
    rows = monthly(spark, sf) if rows is None else rows
    return L.rolled(rows, fixtures.id_map(spark, sf), **options)


def _masked(spark, sf):
    return monthly_table(raw(spark, sf), AS_OF, masks=True)


def _rollup(spark, sf, rows=None, **options):
    return _rolled(spark, sf, rows, **options)[0]


@query
def write_loans(spark, sf):
    loans, rest = _rolled(spark, sf, _masked(spark, sf))
    table = _store_loans(spark, [loans], [fixtures.raw_panel(spark, sf)], [rest])
    return _n_months(spark, table, [rest]).select(
        "file", "lnId", "fico", "vintage", "harpLnId", "preHarpId", "n"
    )


@query
def write_id_map(spark, sf):
    configure(spark)
    return tables.write_id_map(fixtures.id_map(spark, sf), new_folder(spark, "map"))


@query
def query_source(spark, sf):
    monthly(spark, sf).createOrReplaceTempView("source")
    return spark.sql(
        "select file, channel, count(*) as n_rows, count(distinct lnId) as n_loans, "
        "sum(cast(dq as bigint)) as sum_dq from source where dq >= 0 group by file, channel"
    )


@query
def describe_loans(spark, sf):
    rows = stored_monthly(spark, sf)
    loans, rest = _rolled(spark, sf, rows)
    return tables.describe_table(spark, _store_loans(spark, [loans], [rows], [rest]))


@query
def append_runs(spark, sf):
    rows = stored_monthly(spark, sf)
    halves = [rows.where(F.col("standard") == flag) for flag in ("Y", "N")]
    runs, rests = zip(*[L.rolled(half, tie=["payHist"]) for half in halves])
    together = tables.append_runs(*runs).withColumn("n", F.size("monthly"))
    found = [rest for rest in rests if rest is not None]
    if found:
        more = found[0] if len(found) == 1 else tables.append_runs(*found)
        more = more.groupBy(*KEYS).agg(F.sum(F.size("monthly")).cast("int").alias("__more"))
        together = _joined(together, more).withColumn("n", F.col("n") + F.coalesce("__more", F.lit(0)))
    stored = _n_months(spark, _store_loans(spark, runs, halves, rests), rests)
    columns = ["file", "lnId", "standard", "fico", "n"]
    one = together.select(F.lit("one job").alias("how"), *columns)
    return one.unionByName(stored.select(F.lit("two runs").alias("how"), *columns))


@query
def repeat_run(spark, sf):
    """All tapes loaded, then those of one folder a second time, after a run that died between its
    tables: as if each had been loaded once."""
    configure(spark)
    base, path = write_tape(spark, sf, by_loan=True), new_folder(spark, "repeated")
    maps = new_folder(spark, "map")
    tables.write_id_map(fixtures.id_map(spark, sf), maps)
    options = {"id_map_path": maps, "path": path, "as_of": AS_OF, "tie": ["payHist"]}
    table = f"loans_{uuid.uuid4().hex}"
    stored = build_loans(spark, f"{base}/*", table, **options)
    half = runs.new_run(spark, path)
    runs.write_table(stored.where(F.contains("file", F.lit("HARP"))), path, half, "loans", ["lnId"])
    build_loans(spark, f"{base}/{TAPE_PARTS[2]}", table, create=False, **options)
    return spark.table(table).select(
        folder(F.col("file")).alias("file"), "lnId", "fico", "vintage", "harpLnId", "preHarpId", F.size("monthly").alias("n")
    )


# ---- projection, filter, schema --------------------------------------------------------------


@query
def cast_fields(spark, sf):
    specs = catalogue.fields(["month", "ltv", "term", "rate", "totPrin", "fpDt", "lpDt", "seller"])
    typed = V.cast_fields(raw(spark, sf), specs, keep=ID)
    return typed.select(
        *ID,
        *[F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in ("month", "fpDt", "lpDt")],
        *[F.coalesce(F.col(c), F.lit(-99)).alias(c) for c in ("ltv", "term")],
        *[flat(F.coalesce(F.col(c), F.lit(-99.0))).alias(c) for c in ("rate", "totPrin")],
        "seller",
    )


@query
def drop_fields(spark, sf):
    rows = scanned(spark, sf)
    kept = [c for c in rows.columns if c not in ("file", "standard")]
    unused = [c for c in kept if c.startswith("unused")]
    return rows.groupBy(folder(F.col("file")).alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(kept)).alias("n_kept"),
        F.lit(len(unused)).alias("n_unused"),
    )


@query
def constant_fields(spark, sf):
    rows = derive.constant_fields(raw(spark, sf), STANDARD_VALUES)
    return rows.select(*ID, "standard", *STANDARD_VALUES)


@query
def file_field(spark, sf):
    rows = scanned(spark, sf).select(folder(F.col("file")).alias("file"))
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def standard_flag(spark, sf):
    rows = scanned(spark, sf).select(folder(F.col("file")).alias("file"), "standard")
    return rows.groupBy("file", "standard").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def star_plus(spark, sf):
    rows = L.star_plus(monthly(spark, sf))
    return rows.select(*ID, "ageFpDt", F.lit(len(rows.columns)).alias("n_columns"))


@query
def nest(spark, sf):
    fields = {"month": fn.month_end(F.col("month")), "dq": F.col("dq"), "zb": F.col("zb")}
    rows = tl.timeline(monthly(spark, sf), KEYS, order(), fields)
    # The nested table flat again: one row per month.
    months = rows.select(*KEYS, F.posexplode("monthly").alias("pos", "m"))
    return months.select(
        *KEYS, "pos", F.col("m.month").cast("string").alias("month"), "m.dq", "m.zb"
    )


@query
def filter_nonempty(spark, sf):
    tokens = quality.explode_qa(monthly(spark, sf), ID)
    return quality.filter_nonempty(tokens)


@query
def field_docs(spark, sf):
    means = per_loan(monthly(spark, sf), fico=F.max("fico"), state=F.min("state"))
    documented = describe_fields(means, catalogue.MONTHLY_FIELDS)
    texts = {f.name: f.metadata for f in documented.schema.fields}
    return documented.select(
        *KEYS, "fico", "state",
        F.lit(texts["fico"]["comment"]).alias("fico_doc"),
        F.lit(texts["state"]["width"]).alias("state_width"),
    )


@query
def check_schema(spark, sf):
    rows = monthly(spark, sf)
    checked = tables.check_schema(rows, schema_of(catalogue.MONTHLY_FIELDS))
    return checked.groupBy("file", F.lit(len(checked.columns)).alias("n_columns")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# ---- validation and quality ------------------------------------------------------------------


def _flags(df: DataFrame, **tests: Column) -> DataFrame:
    return df.select(*ID, *[F.when(t, "Y").otherwise("N").alias(n) for n, t in tests.items()])


@query
def valid_levels(spark, sf):
    names = ["channel", "purpose", "state", "zip3", "dqStat", "program", "msa"]
    tests = {f.name: V.is_legal(F.col(f.name), f, AS_OF) for f in catalogue.fields(names)}
    return _flags(raw(spark, sf), **tests)


@query
def valid_codes(spark, sf):
    """Areas and postal prefixes held to a table of codes instead of their form."""
    rows = monthly_table(raw(spark, sf), AS_OF, codes=fixtures.codes(spark, sf))
    return rows.select(*ID, "msa", "zip3", "qa")


@query
def qa_profile_codes(spark, sf):
    """Months that failed per field and loan, with areas and postal prefixes held to the table."""
    rows = monthly_table(raw(spark, sf), AS_OF, codes=fixtures.codes(spark, sf))
    return quality.qa_profile(rows, KEYS).select(*KEYS, F.inline("qa"))


@query
def valid_range(spark, sf):
    specs = catalogue.fields(["ltv", "dti", "fico", "opb", "fclProNet", "numBorr", "frgvUpb"])
    typed = V.cast_fields(raw(spark, sf), specs, keep=ID)
    return _flags(typed, **{f.name: V.is_legal(F.col(f.name), f, AS_OF) for f in specs})


@query
def valid_dates(spark, sf):
    specs = catalogue.fields(["month", "fpDt", "origDt", "matDt", "fclDt", "ioDt"])
    typed = V.cast_fields(raw(spark, sf), specs, keep=ID)
    return _flags(typed, **{f.name: V.is_legal(F.col(f.name), f, AS_OF) for f in specs})


@query
def type_check(spark, sf):
    specs = catalogue.fields(["term", "totPrin", "fclMExp", "lpDt", "totDefrl", "ltv"])
    return _flags(raw(spark, sf), **{f.name: V.type_check(F.col(f.name), f) for f in specs})


@query
def missing_value(spark, sf):
    specs = catalogue.fields(["channel", "fico", "fpDt", "opb", "zip3", "dqStat", "term"])
    checked = V.check_fields(raw(spark, sf), specs, AS_OF, keep=ID)
    filled = V.fill_missing(checked, specs, keep=ID, qa=None)
    return filled.withColumns({"fpDt": F.col("fpDt").cast("string"), "opb": flat(F.col("opb"))})


@query
def default_value(spark, sf):
    specs = catalogue.fields(["seller", "mi", "zb", "altRes", "coFico", "cltv", "miType", "zbDt"])
    filled = V.validate(raw(spark, sf), specs, AS_OF, keep=ID)
    return filled.withColumns({"zbDt": F.col("zbDt").cast("string"), "mi": flat(F.col("mi"))})


@query
def qa_fields(spark, sf):
    return monthly(spark, sf).select(*ID, "qa")


@query
def recode_msa(spark, sf):
    return monthly(spark, sf).select(*ID, "msa")


@query
def derived_valid(spark, sf):
    qa = F.col("qa")
    return monthly(spark, sf).select(
        *ID, "dq", flat(F.col("propVal")).alias("propVal"),
        F.when(F.contains(qa, F.lit(":dq:")), "Y").otherwise("N").alias("dq_failed"),
        F.when(F.contains(qa, F.lit(":propVal:")), "Y").otherwise("N").alias("propVal_failed"),
    )


@query
def qa_profile(spark, sf):
    profiles = quality.qa_profile(monthly(spark, sf), KEYS)
    return profiles.select(*KEYS, F.inline("qa"))


@query
def qa_all_fail(spark, sf):
    rows = monthly(spark, sf)
    sizes = skew.group_sizes(rows, KEYS)
    profiled = quality.join_qa(sizes, quality.qa_profile(rows, KEYS), KEYS)
    failed = quality.qa_all_fail(F.col("qa"), F.col("n_rows"))
    return profiled.select(*KEYS, "n_rows", text_of(failed).alias("allFail"))


@query
def qa_counts(spark, sf):
    """The profile as one conditional count per field."""
    names = ["channel", "dti", "fico", "propVal"]
    counts = quality.failure_counts(F.col("qa"), names)
    grouped = monthly(spark, sf).groupBy(*KEYS).agg(*[c.alias(n) for n, c in counts.items()])
    profile = quality.profile_of_counts({n: F.col(n) for n in names})
    return grouped.select(*KEYS, profile_text(profile).alias("qa"))


# ---- derived columns and scalar functions ----------------------------------------------------


@query
def dq(spark, sf):
    return monthly(spark, sf).select(*ID, "dqStat", fn.dq_number(F.col("dqStat")).alias("dq"))


@query
def vintage(spark, sf):
    rows = monthly(spark, sf)
    return rows.select(*ID, F.col("fpDt").cast("string"), fn.vintage(F.col("fpDt")).alias("vintage"))


@query
def prop_val(spark, sf):
    specs = catalogue.fields(["opb", "ltv"])
    rows = V.check_fields(raw(spark, sf), specs, AS_OF, keep=ID)
    value = F.coalesce(fn.prop_val(F.col("opb"), F.col("ltv")), F.lit(-1.0))
    return rows.select(*ID, flat(value).alias("propVal"))


@query
def age_fp(spark, sf):
    rows = monthly(spark, sf)
    return rows.select(*ID, fn.age_fp(F.col("fpDt"), F.col("month")).alias("ageFpDt"))


@query
def month_end(spark, sf):
    return monthly(spark, sf).select(*ID, fn.month_end(F.col("month")).cast("string").alias("month"))


@query
def lower(spark, sf):
    rows = monthly(spark, sf)
    return rows.select(
        *ID, *[F.lower(c).alias(f"{c}_lower") for c in ("servicer", "seller", "file")]
    )


@query
def year_filter(spark, sf):
    rows = monthly(spark, sf).where(F.year("fpDt") > 1970)
    return rows.select(*ID, F.year("fpDt").alias("year"))


@query
def split_tokens(spark, sf):
    rows = monthly(spark, sf)
    return rows.select(*ID, F.size(fn.split_tokens(F.col("qa"))).alias("n_tokens"))


@query
def harp_flag(spark, sf):
    return monthly(spark, sf).select(*ID, fn.harp_flag(F.col("file")).alias("harp"))


@query
def bucket(spark, sf):
    ids = monthly(spark, sf).select("lnId").distinct()
    return ids.select("lnId", fn.bucket(F.col("lnId")).alias("bucket"))


@query
def conditional(spark, sf):
    rows = monthly(spark, sf)
    test = fn.conditional(F.col("dti") > 43, F.lit("high"), F.lit("normal"))
    return rows.select(*ID, "dti", test.alias("band"))


def _lineitem(spark, sf):
    fixtures.register(configure(spark), sf)
    return spark.table("lineitem")


@query
def cast_f32(spark, sf):
    tenth = F.col("l_extendedprice") / 7
    return _lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", flat(fn.cast_f32(tenth)).alias("price")
    )


@query
def cast_i32(spark, sf):
    value = (F.col("l_quantity") - 25) * 1.37
    return _lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.cast_i32(value).alias("units")
    )


@query
def array_first(spark, sf):
    loans = arrays(spark, sf, "dti", "channel")
    return loans.select(
        *KEYS,
        fn.array_first(F.col("dti"), lambda x: x > 50, -1).alias("dti"),
        fn.array_first(F.col("channel"), lambda x: x != "X", "").alias("channel"),
    )


@query
def array_filter(spark, sf):
    loans = arrays(spark, sf, "dq", "zb")
    return loans.select(
        *KEYS,
        text_of(fn.array_filter(F.col("dq"), lambda x: x > 1).cast("array<string>")).alias("dq"),
        text_of(fn.array_filter2(F.col("zb"), F.col("dq"), lambda _, y: y > 1)).alias("zb"),
    )


@query
def array_avg(spark, sf):
    loans = arrays(spark, sf, "dti")
    known = fn.array_filter(F.col("dti"), lambda x: x != -1)
    mean = F.coalesce(fn.array_avg(known), F.lit(-1.0))
    return loans.select(*KEYS, flat(mean).alias("dti"))


@query
def array_max(spark, sf):
    loans = arrays(spark, sf, "fclProNet")
    return loans.select(*KEYS, flat(fn.array_max(F.col("fclProNet"))).alias("fclProNet"))


@query
def array_sum(spark, sf):
    loans = arrays(spark, sf, "dq", "upb")
    return loans.select(
        *KEYS,
        fn.array_sum(F.col("dq")).alias("dq"),
        flat(fn.array_sum(F.col("upb"), 0.0)).alias("upb"),
    )


@query
def index_of(spark, sf):
    loans = arrays(spark, sf, "pPen", "reprchMw")
    return loans.select(*KEYS, *[fn.index_of(F.col(c), "Y").alias(c) for c in ("pPen", "reprchMw")])


@query
def element_at(spark, sf):
    loans = arrays(spark, sf, "payHist")
    second = F.coalesce(fn.element_at(F.col("payHist"), 2), F.lit(""))
    return loans.select(
        *KEYS, fn.element_at(F.col("payHist"), 1).alias("first"), second.alias("second")
    )


@query
def array_length(spark, sf):
    loans = arrays(spark, sf, "month")
    return loans.select(*KEYS, fn.array_length(F.col("month")).alias("n"))


@query
def substr(spark, sf):
    return monthly(spark, sf).select(*ID, F.substring("lnId", 5, 8).alias("tail"))


@query
def bit_positions(spark, sf):
    rows = _lineitem(spark, sf).select("l_orderkey", "l_partkey").distinct()
    value = F.col("l_orderkey") * 4096 + F.col("l_partkey")
    return rows.select(
        "l_orderkey", "l_partkey",
        text_of(fn.bit_positions(value).cast("array<string>")).alias("positions"),
        fn.bit_position_sum(value).cast("bigint").alias("total"),
    )


# ---- aggregations ----------------------------------------------------------------------------


@query
def timeline(spark, sf):
    fields = {"month": fn.month_end(F.col("month")), "dq": F.col("dq"), "mod": F.col("mod")}
    loans = tl.timeline(monthly(spark, sf), KEYS, order(), fields)
    return loans.select(
        *KEYS,
        *[text_of(F.col(f"monthly.{c}").cast("array<string>")).alias(c) for c in fields],
    )


@query
def timeline_events(spark, sf):
    """Another panel: few groups of many rows each, so every timeline is cut into pieces."""
    rows = events(spark, sf)
    item = {"event_id": F.col("event_id"), "user_id": F.col("user_id")}
    parts = tl.timeline(rows, ["event_type"], F.struct("ts", "event_id"), item, "items", 500)
    ids = text_of(F.col("items.event_id").cast("array<string>"))
    return parts.select("event_type", "part", F.size("items").alias("n"), ids.alias("ids"))


@query
def timeline_copies(spark, sf):
    """Rows that are alike in groups that are large: all copies are kept."""
    rows = events(spark, sf).select("event_type", (F.col("user_id") % 3).alias("kind"))
    item = {"kind": F.col("kind")}
    parts = tl.timeline(rows, ["event_type"], F.struct("kind"), item, "items", 300)
    return parts.select("event_type", "part", F.inline("items")).groupBy(
        "event_type", "part", "kind"
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def first_non_missing(spark, sf):
    texts = {n: "X" for n in ("channel", "purpose", "occ", "miType")}
    texts |= {"state": "XX", "msa": "XXXXX", "zip3": "XXX", "vintage": "XXXXQX"}
    return per_loan(
        monthly(spark, sf),
        seller=A.first_non_missing(
            F.col("seller"), "unknown", order(), probe=F.lower("seller")
        ),
        **{n: A.first_non_missing(F.col(n), m, order()) for n, m in texts.items()},
    )


@query
def first_non_missing_except(spark, sf):
    value = A.first_non_missing_except(F.col("altRes"), "X", order(), ["7", "9"])
    return per_loan(monthly(spark, sf), altRes=value)


@query
def first_valid_date(spark, sf):
    names = ["origDt", "fpDt", "ioDt", "zbDt", "lpDt", "fclDt", "dispDt"]
    dates = {n: A.first_valid_date(F.col(n), order()).cast("string") for n in names}
    return per_loan(monthly(spark, sf), **dates)


@query
def avg_non_missing(spark, sf):
    names = ["dti", "rate", "opb", "term", "ltv", "mi", "fclWriteOff", "propVal"]
    means = {n: flat(A.avg_non_missing(F.col(n), -1).cast("float")) for n in names}
    return per_loan(monthly(spark, sf), **means)


@query
def avg_non_missing_strict(spark, sf):
    """Means of zero or less stand."""
    means = {
        n: flat(A.avg_non_missing(F.col(n), -1, compat=False)) for n in ("mi", "fclWriteOff")
    }
    return per_loan(monthly(spark, sf), **means)


@query
def avg_non_missing_int(spark, sf):
    names = ["numBorr", "fico", "coFico"]
    return per_loan(
        monthly(spark, sf), **{n: A.avg_non_missing_int(F.col(n), -1) for n in names}
    )


@query
def avg_positive(spark, sf):
    return per_loan(monthly(spark, sf), altResCnt=A.avg_positive(F.col("altResCnt")).cast("int"))


@query
def avg_nonnegative(spark, sf):
    return per_loan(monthly(spark, sf), totDefrl=flat(A.avg_nonnegative(F.col("totDefrl"))))


@query
def max_value(spark, sf):
    return per_loan(monthly(spark, sf), **{n: flat(A.max_value(F.col(n))) for n in L.MAXIMA})


@query
def max_given(spark, sf):
    """Maximum of the amounts given, so that a default zero does not beat a negative one."""
    rows = monthly(spark, sf)
    names = ["fclPExp", "fclLExp", "fclProNet", "zbUpb"]
    return per_loan(rows, **{n: flat(A.max_given(F.col(n), -1.0, 0.0)) for n in names})


@query
def any_flag(spark, sf):
    return per_loan(monthly(spark, sf), reprchMw=A.any_flag(F.col("reprchMw")))


@query
def no_flag(spark, sf):
    return per_loan(monthly(spark, sf), pPen=A.no_flag(F.col("pPen")))


@query
def first_row(spark, sf):
    names = ["standard", "nsDoc", "nsUw", "gGuar", "negAm"]
    return per_loan(monthly(spark, sf), **{n: A.first_row(F.col(n), order()) for n in names})


@query
def count_by_key(spark, sf):
    rows = quality.near_keys(monthly(spark, sf).select(*KEYS, "qa"), KEYS)
    tokens = quality.filter_nonempty(quality.explode_qa(rows, KEYS))
    return quality.count_by_key(tokens, [*KEYS, "field"])


@query
def group_to_arrays(spark, sf):
    rows = quality.near_keys(monthly(spark, sf).select(*KEYS, "qa"), KEYS)
    tokens = quality.filter_nonempty(quality.explode_qa(rows, KEYS))
    counts = quality.count_by_key(tokens, [*KEYS, "field"])
    grouped = quality.group_to_arrays(counts, KEYS, ["field", "cntFail"])
    return grouped.select(
        *KEYS, text_of(F.col("qa.field")).alias("field"),
        text_of(F.col("qa.cntFail").cast("array<string>")).alias("cntFail"),
    )


FLOATS = [f.name for f in catalogue.MONTHLY_FIELDS if f.kind == "float"]


def flat_loans(loans: DataFrame, rest: DataFrame | None = None) -> DataFrame:
    """The loan table without nested columns: timelines and profiles as text. Timelines are as long as
    ``monthly`` and what ``rest`` has of them beyond it."""

    def timeline_text(name):
        items = F.col(f"monthly.{name}")
        if name in FLOATS:  # in hundredths, as both engines write whole numbers alike
            items = F.transform(items, lambda x: F.round(x.cast("double") * 100).cast("bigint"))
        return text_of(items.cast("array<string>")).alias(f"monthly_{name}")

    def static(name):
        if name in L.DATES:
            return F.col(name).cast("string").alias(name)
        if name in L.MEANS or name in L.MAXIMA or name == "totDefrl":
            return flat(F.col(name)).alias(name)
        return F.col(name)

    texts = [timeline_text(n) for n in L.TIMELINE]
    out = loans.select(
        "lnId", "nMonths", *texts, *[static(n) for n in L.STATICS],
        "bucket", "harpLnId", "preHarpId", profile_text(F.col("qa")).alias("qa"),
        text_of(F.col("allFail")).alias("allFail"), *[c for c in loans.columns if c == "part"],
    )
    if rest is None:
        return out
    # Pieces become texts where they lie, and only those meet their loan.
    pieces = rest.select(*KEYS, "part", *texts)
    names = [f"monthly_{n}" for n in L.TIMELINE]
    whole = pieces.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("part", *names))).alias("__pieces"))
    further = {n: F.when(F.col("__pieces").isNotNull(), F.concat(n, F.lit(";"), text_of(F.col(f"__pieces.{n}")))).otherwise(F.col(n)) for n in names}
    return _joined(out, whole).select(*[further.get(c, F.col(c)).alias(c) for c in out.columns])


@query
def loan_rollup(spark, sf):
    return flat_loans(*_rolled(spark, sf))


@query
def loan_rollup_default(spark, sf):
    """With rows of one month in the order of their hashes: what does not depend on that order."""
    loans = flat_loans(*_rolled(spark, sf, _masked(spark, sf), tie=None))
    return loans.select("file", "lnId", "nMonths", "monthly_month", "harpLnId", "qa", *L.MEANS, *L.MAXIMA)


@query
def loan_rollup_parts(spark, sf):
    """As ``loan_rollup``, by the plan for loans too long for one row: first pieces of three months."""
    return flat_loans(_rollup(spark, sf, piece=3))


def _buckets(spark, rows, limit):
    staged = tables.write_monthly(rows, new_folder(spark, "monthly"))
    return tables.bucket_monthly(staged, f"monthly_{uuid.uuid4().hex}", new_folder(spark, "buckets"), KEYS, limit)


@query
def loan_rollup_buckets(spark, sf):
    """As ``loan_rollup``, from buckets; loans of more than three months lie beside them."""
    rolled = L.bucketed(*_buckets(spark, _masked(spark, sf), 3), fixtures.id_map(spark, sf), tie=["payHist"], piece=3, cut=False)
    return flat_loans(*rolled)


@query
def monthly_buckets(spark, sf):
    """The quality profile of a panel with blank and NULL ids, from buckets and what lies beside them."""
    kept, rest = _buckets(spark, _blank(spark, sf), 40)
    parts = [kept] if rest is None else [kept, rest]
    profiles = [quality.qa_profile(p, KEYS).select(*KEYS, F.inline("qa")) for p in parts]
    return profiles[0] if rest is None else profiles[0].unionByName(profiles[1])


def _blank(spark, sf):
    """The panel with a third of all rows under a blank loan id and some under none."""
    lnid = F.when(F.col("dti") % 3 == 0, "").when(F.col("dti") % 17 == 1, F.lit(None)).otherwise(F.col("lnId"))
    rows = monthly(spark, sf).withColumn("lnId", lnid)
    return tables.write_monthly(rows, new_folder(spark, "blank"))


@query
def loan_rollup_blank(spark, sf):
    """One row per loan, blank and NULL ids too, and piece of its timeline: loans that are real have one."""
    pieces = L.rolled(_blank(spark, sf), fixtures.id_map(spark, sf), tie=["payHist"], piece=BLANK_PIECE, parts=True)[0]
    return flat_loans(pieces)


@query
def loan_rollup_blank_parts(spark, sf):
    """One row per loan where most do not fit one; without their timelines, which ``loan_timelines`` has."""
    rolled = L.loan_rollup(_blank(spark, sf), fixtures.id_map(spark, sf), tie=["payHist"], piece=2)
    return flat_loans(rolled).drop(*[f"monthly_{n}" for n in L.TIMELINE])


@query
def loan_timelines(spark, sf):
    """All timelines, of blank and NULL ids too, in pieces of five months."""
    pieces = L.loan_timelines(_blank(spark, sf), tie=["payHist"], piece=5)
    return pieces.select(
        *KEYS, "part", text_of(F.transform("monthly", lambda m: m["dq"].cast("string"))).alias("dq"),
        text_of(F.transform("monthly", lambda m: F.round(m["upb"].cast("double") * 100).cast("bigint").cast("string"))).alias("upb"),
    )


@query
def loan_rollup_strict(spark, sf):
    """As ``loan_rollup`` without its four compatible habits."""
    columns = ["lnId", "file", "pPen", "coFico", *L.MEANS, *L.MAXIMA]
    loans = L.loan_rollup(monthly(spark, sf), tie=["payHist"], compat=False)
    return flat_loans(loans).select(*columns)


# ---- joins, rows, sorts, composition ---------------------------------------------------------


def _loan_ids(spark, sf):
    return monthly(spark, sf).select(*KEYS).distinct()


@query
def link_successor(spark, sf):
    return links.link_successor(_loan_ids(spark, sf), fixtures.id_map(spark, sf))


@query
def link_predecessor(spark, sf):
    return links.link_predecessor(_loan_ids(spark, sf), fixtures.id_map(spark, sf))


@query
def link_many(spark, sf):
    """A map with many entries per id, spread over salts."""
    fixtures.register(configure(spark), sf)
    customers = spark.table("customer").select("c_custkey", "c_mktsegment")
    owned = spark.table("orders").select("o_custkey", F.col("o_orderstatus").alias("status"))
    return links.link(
        customers, "c_custkey", owned, "o_custkey", "status", "status", max_matches=4
    )


@query
def join_qa(spark, sf):
    rows = tables.write_monthly(monthly(spark, sf).select(*KEYS, "qa"), new_folder(spark, "qa"))
    rows = quality.near_keys(rows, KEYS)
    some = rows.where(F.contains("qa", F.lit(":fico:")))
    joined = quality.join_qa(rows.select(*KEYS).distinct(), quality.qa_profile(some, KEYS), KEYS)
    return joined.select(*KEYS, profile_text(F.col("qa")).alias("qa"))


@query
def explode_qa(spark, sf):
    return quality.explode_qa(monthly(spark, sf), ID)


def _numbered(ordered: DataFrame) -> DataFrame:
    """Rows with their place in the order they come in: partition by partition."""
    held = ordered.withColumn("__id", F.monotonically_increasing_id())
    held = held.withColumn("__part", F.shiftright("__id", 33).cast("int"))
    held = skew.checkpointed(held)
    sizes = held.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__start") + F.col("__id") - F.shiftleft(F.col("__part").cast("bigint"), 33)
    return held.join(F.broadcast(starts), "__part").select(*ordered.columns, place.alias("place"))


@query
def sort_loan_month(spark, sf):
    rows = monthly(spark, sf).select("lnId", "month", "payHist", "dq")
    ordered = _numbered(skew.sort_rows(rows, ["lnId", "month"]))
    return ordered.withColumn("month", F.col("month").cast("string"))


@query
def sort_copies(spark, sf):
    """A sort on few values, whose copies travel collapsed."""
    rows = monthly(spark, sf).select("channel", "dq")
    return _numbered(skew.sort_rows(rows, ["channel"], copies=True))


@query
def sample_limit(spark, sf):
    rows = monthly(spark, sf).select("lnId", "month", "payHist", "dq")
    first = rows.orderBy("lnId", "month", "payHist").limit(10)
    return first.withColumn("month", F.col("month").cast("string"))


@query
def cte(spark, sf):
    monthly(spark, sf).createOrReplaceTempView("source")
    return spark.sql(
        "with q as (select file, lnId, max(dq) as worst from source group by file, lnId), "
        "r as (select file, lnId, count(*) as n from source group by file, lnId) "
        "select r.file, r.lnId, r.n, q.worst from r left join q on q.file = r.file and q.lnId = r.lnId"
    )


@query
def subquery(spark, sf):
    monthly(spark, sf).createOrReplaceTempView("source")
    return spark.sql(
        "select file, lnId, max(late) as late from "
        "(select *, case when dq > 2 then 1 else 0 end as late from source) group by file, lnId"
    )


@query
def primary_order(spark, sf):
    rows = monthly(spark, sf).select("lnId", "month", "payHist", "upb")
    ordered = tables.primary_order(rows, ["lnId", "month"])
    stored = tables.write_monthly(ordered, new_folder(spark, "ordered"))
    return stored.select(
        "lnId", F.col("month").cast("string"), "payHist", flat(F.col("upb")).alias("upb")
    )


# ---- user-defined derivations ----------------------------------------------------------------

USER_CALCS = {
    "spread": lambda col: col("curRate") - col("rate"),
    "band": lambda col: F.when(col("fico") >= 700, "A").when(col("fico") >= 600, "B").otherwise("C"),
}


@query
def derive_fields(spark, sf):
    rows = derive.derive(monthly(spark, sf), USER_CALCS)
    return rows.select(*ID, flat(F.col("spread")).alias("spread"), "band")


QUERIES["derive"] = QUERIES.pop("derive_fields")


@query
def extra_specs(spark, sf):
    rows = derive.derive(monthly(spark, sf), USER_CALCS)
    specs = [
        FieldSpec("spread", "float", -99.0, low=-2.0, high=6.0, comment="current less note rate"),
        FieldSpec("band", "string", "X", levels=("A", "B"), comment="score band"),
    ]
    checked = derive.extra_specs(rows, specs, AS_OF).drop("qa")
    filled = V.fill_missing(checked, specs, keep=ID)
    return filled.withColumn("spread", flat(F.col("spread")))
