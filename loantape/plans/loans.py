"""Monthly table → one row per loan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loantape.catalogue import FIELDS, MONTHLY_FIELDS, QA_ORDER
from loantape.functions.bits import bucket
from loantape.functions.scalars import age_fp, harp_flag, month_end
from loantape.operators import aggregate as A
from loantape.operators import quality, skew
from loantape.operators.links import link_both
from loantape.operators.timeline import PIECE, gathered, nest, order_key, packed_order, row_hash, timeline

KEYS = ["file", "lnId"]
# Bits that count a field's failures in a group of any size that one task could hold.
LANE_BITS = 31

# Order and names of the output columns.
TIMELINE = (
    "month upb dq servicer curRate age ageFpDt rTermLgl rTermAct dqStat mod zb ioRem bap program "
    "nonIntUpb frgvUpb totPrin servAct matDt"
).split()
STATICS = (
    "channel seller dti rate opb term origDt fpDt ltv cltv numBorr fico coFico firstTime purpose "
    "propType units occ state msa zip3 mi amType pPen io ioDt zbDt zbUpb lpDt fclDt dispDt fclExp "
    "fclPExp fclLExp fclMExp fclTaxes fclProNet fclProMi fclProMw fclProOth fclWriteOff miType relo "
    "valMthd sConform hltv reprchMw altRes altResCnt totDefrl file vintage propVal harp standard "
    "nsDoc nsUw gGuar negAm"
).split()

# How each static field is reduced to one value per loan.
MEANS = "dti rate opb term ltv cltv units mi fclWriteOff propVal".split()
INT_MEANS = "numBorr fico coFico".split()
DATES = "origDt fpDt ioDt zbDt lpDt fclDt dispDt".split()
MAXIMA = (
    "zbUpb fclExp fclPExp fclLExp fclMExp fclTaxes fclProNet fclProMi fclProMw fclProOth"
).split()
FIRST_TEXTS = (
    "channel firstTime purpose propType occ state msa zip3 amType io miType relo valMthd sConform "
    "hltv vintage"
).split()
FIRST_ROW = "standard nsDoc nsUw gGuar negAm".split()


def static_aggregates(order: Column, compat: bool = True) -> dict[str, Column]:
    """The aggregate for each static field; ``compat`` as in ``loan_rollup``."""
    col, missing = F.col, {f.name: f.missing for f in MONTHLY_FIELDS}
    out: dict[str, Column] = {}
    for name in FIRST_TEXTS:
        out[name] = A.first_non_missing(col(name), missing[name], order)
    out["seller"] = A.first_non_missing(
        col("seller"), missing["seller"], order, probe=F.lower("seller")
    )
    out["altRes"] = A.first_non_missing_except(
        col("altRes"), missing["altRes"], order, skip=["7", "9"]
    )
    for name in DATES:
        out[name] = A.first_valid_date(col(name), order)
    for name in MEANS:
        out[name] = A.avg_non_missing(col(name), missing[name], compat).cast("float")
    for name in INT_MEANS:
        out[name] = A.avg_non_missing_int(col(name), missing[name], compat)
    if not compat:
        given = F.when(col("coFico") != FIELDS["coFico"].default, col("coFico"))
        out["coFico"] = A.avg_non_missing_int(given, missing["coFico"], compat)
    out["altResCnt"] = A.avg_positive(col("altResCnt")).cast("int")
    out["totDefrl"] = A.avg_nonnegative(col("totDefrl")).cast("float")
    for name in MAXIMA:
        spec = FIELDS[name]
        out[name] = (
            A.max_value(col(name))
            if compat
            else A.max_given(col(name), spec.missing, spec.default)
        )
    out["pPen"] = A.no_flag(col("pPen")) if compat else A.any_flag(col("pPen"))
    out["reprchMw"] = A.any_flag(col("reprchMw"))
    # One minimum finds the first row for all fields taken from it.
    out["__first"] = A.first_row(F.struct(*FIRST_ROW), order)
    return out


def timeline_item() -> Column:
    computed = {"month": month_end(F.col("month")), "servicer": F.lower("servicer")}
    return nest({n: computed.get(n, F.col(n)) for n in TIMELINE})


def star_plus(monthly: DataFrame) -> DataFrame:
    """All monthly columns and the loan's age counted from its first payment."""
    return monthly.withColumn("ageFpDt", age_fp(F.col("fpDt"), F.col("month")))


def loan_rollup(
    monthly: DataFrame,
    id_map: DataFrame | None = None,
    tie: Iterable[str] | None = None,
    compat: bool = True,
    piece: int | None = PIECE,
) -> DataFrame:
    """One row per file and loan: timeline, static values, quality profile and links.

    ``tie`` names the columns that order rows of one loan and month, by default a hash of the row.
    ``compat=False`` corrects four habits of the data model: ``pPen`` is not inverted, means of zero
    stand, default zeros do not enter ``coFico``, and a default zero does not beat a negative amount.

    ``nMonths`` is the number of months, ``monthly`` holds the first ``piece`` of them: all, for any
    real loan. What a longer group has beyond (a blank id, say) is in ``loan_timelines`` as ``part``
    1, 2, …, cut by the same rule; there is one row per loan here whatever its size. Long groups are
    found by one count of the key columns and take another plan; ``piece=None`` skips the count and
    keeps every timeline whole. ``monthly`` should be a stored table, as the count reads it, too.
    """
    return loan_tables(monthly, id_map, tie, compat, piece)[0]


def loan_tables(
    monthly: DataFrame,
    id_map: DataFrame | None = None,
    tie: Iterable[str] | None = None,
    compat: bool = True,
    piece: int | None = PIECE,
) -> tuple[DataFrame, DataFrame]:
    """What ``loan_rollup`` gives, and what ``loan_timelines`` gives from part 1 on, from one count of
    the keys and one ranking of the long groups, whose ranges are stored for both."""
    loans, rest = rolled(monthly, id_map, tie, compat, piece)
    return loans, monthly.sparkSession.createDataFrame([], _timelines_schema()) if rest is None else rest


def rolled(
    monthly: DataFrame,
    id_map: DataFrame | None = None,
    tie: Iterable[str] | None = None,
    compat: bool = True,
    piece: int | None = PIECE,
    cut: bool = True,
    parts: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """As ``loan_tables``, with ``None`` for further pieces where no loan is longer than one.

    Without ``cut``, timelines that a task holds whole may be left whole; what ``monthly`` lacks is in
    the second table all the same. With ``parts`` there is one table: the loans have a row for each
    piece of their timeline, numbered by ``part`` from 0, so no row is longer than a piece.
    """
    rows = _ordered(monthly, tie)
    hot = None if piece is None else skew.hot_groups(monthly, KEYS, piece)
    lane_bits = LANE_BITS if piece is None else min(LANE_BITS, piece.bit_length())
    if hot is None:
        loans, rest = _whole_loans(rows, compat, lane_bits, piece is not None), None
        loans = loans.withColumn("part", F.lit(0)) if parts else loans
    elif skew.whole_rows(piece) > piece and not skew.is_small(hot):
        loans, rest = _many_long_loans(rows, hot, compat, piece, cut, parts)
    else:
        match = skew.null_safe(rows, hot, KEYS)
        far = rows.join(hot, match, "left_semi")
        pieces = _pieces(far, hot, piece)
        near = _whole_loans(rows.join(hot, match, "left_anti"), compat, lane_bits)
        near = near.withColumn("part", F.lit(0)) if parts else near
        loans = near.unionByName(_long_loans(far, pieces, compat, parts))
        rest = None if parts else pieces.where(F.col("part") >= 1).to(_timelines_schema())
    names = loan_schema().names
    typed = loan_schema()
    if parts:
        names, typed = [*names, "part"], loan_schema().add("part", T.IntegerType())
    return _linked(loans, id_map).select(*names).to(typed), rest


def _linked(loans: DataFrame, id_map: DataFrame | None) -> DataFrame:
    if id_map is None:
        return loans.withColumns({"harpLnId": F.lit(""), "preHarpId": F.lit("")})
    return link_both(loans, id_map)


def loan_timelines(
    monthly: DataFrame, tie: Iterable[str] | None = None, piece: int = PIECE, first: int = 0
) -> DataFrame:
    """``file``, ``lnId``, ``part`` and ``monthly``: all timelines in pieces, from ``part`` ``first``.

    Parts 0 are what ``loan_rollup`` shows; with ``first=1`` only loans longer than that have rows.
    """
    rows = _ordered(monthly, tie)
    if first:
        hot = skew.hot_groups(monthly, KEYS, piece)
        rows = rows.limit(0) if hot is None else rows.join(hot, skew.null_safe(rows, hot, KEYS), "left_semi")
    items = {f.name: F.col(f"__item.{f.name}") for f in rows.select(timeline_item().alias("i")).schema["i"].dataType}
    packed = rows.select(*KEYS, "__order", timeline_item().alias("__item"))
    pieces = timeline(packed, KEYS, F.col("__order"), items, "monthly", piece)
    return pieces.where(F.col("part") >= first).select(*KEYS, "part", "monthly")


def bucketed_rollup(
    buckets: DataFrame,
    rest: DataFrame | None,
    id_map: DataFrame | None = None,
    tie: Iterable[str] | None = None,
    compat: bool = True,
    piece: int = PIECE,
) -> DataFrame:
    """``loan_rollup`` of what ``bucket_monthly`` has split by ``piece`` months: loans in buckets are
    rolled up where they lie, without a shuffle; only the long ones are counted and ranked."""
    return bucketed(buckets, rest, id_map, tie, compat, piece)[0]


def bucketed(
    buckets: DataFrame,
    rest: DataFrame | None,
    id_map: DataFrame | None = None,
    tie: Iterable[str] | None = None,
    compat: bool = True,
    piece: int = PIECE,
    cut: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """``bucketed_rollup`` and what timelines have beyond its first pieces, as ``rolled`` gives them."""
    loans, further = rolled(buckets, None, tie, compat, None)[0], None
    if rest is not None:
        long, further = rolled(rest, None, tie, compat, piece, cut)
        loans = loans.unionByName(long)
    if id_map is not None:
        loans = link_both(loans.drop("harpLnId", "preHarpId"), id_map)
    return loans.select(*loan_schema().names).to(loan_schema()), further


def _ordered(monthly: DataFrame, tie: Iterable[str] | None) -> DataFrame:
    if tie is None:
        order = packed_order(F.col("month"), row_hash(monthly.drop(*quality.MASKS)))
    else:
        order = order_key(F.col("month"), *[F.col(t) for t in tie])
    return star_plus(monthly).withColumn("__order", order)


def _finished(grouped: DataFrame) -> DataFrame:
    """Columns that follow from a loan's aggregates."""
    first = [F.col(f"__first.{n}").alias(n) for n in FIRST_ROW]
    plain = [c for c in grouped.columns if c not in ("__first", "__n")]
    return grouped.select(
        *plain,
        *first,
        F.col("__n").alias("nMonths"),
        harp_flag(F.col("file")).alias("harp"),
        bucket(F.coalesce("lnId", F.lit(""))).alias("bucket"),
        quality.qa_all_fail(F.col("qa"), F.col("__n")).alias("allFail"),
    )


def _whole_loans(rows: DataFrame, compat: bool, lane_bits: int, bounded: bool = True) -> DataFrame:
    """Everything in one aggregation: one scan, one shuffle. Failures are counted from their bits
    where the table has them, and else from the texts of ``qa``, which then go through the shuffle.
    Where groups are not ``bounded``, the texts are counted by field instead, and only those of names
    that ``QA_ORDER`` lacks are held."""
    order = F.col("__order")
    masked = set(quality.MASKS) <= set(rows.columns)
    if masked:
        sums = quality.lane_sums(len(QA_ORDER), lane_bits)
        failures = {f"__lane{i}": c for i, c in enumerate(sums)}
    elif not bounded:
        sums = quality.lane_sums_of_texts(F.col("qa"), QA_ORDER, lane_bits)
        failures = {f"__lane{i}": c for i, c in enumerate(sums)}
        failures["__tokens"] = quality.tokens_of_texts(F.collect_list(quality.unlisted(F.col("qa"), QA_ORDER)))
    else:
        failures = {"__tokens": quality.tokens_of_texts(F.collect_list("qa"))}
    grouped = rows.groupBy(*KEYS).agg(
        gathered(order, timeline_item()).alias("monthly"),
        F.count(F.lit(1)).alias("__n"),
        *[c.alias(name) for name, c in failures.items()],
        *[agg.alias(name) for name, agg in static_aggregates(order, compat).items()],
    )
    if masked:
        counts = quality.counts_of_lanes([F.col(n) for n in failures], QA_ORDER, lane_bits)
        profile = quality.profile_of_counts(counts)
    elif not bounded:
        counts = quality.counts_of_lanes([F.col(n) for n in failures if n != "__tokens"], QA_ORDER, lane_bits)
        listed, others = quality.profile_of_counts(counts), quality.profile_of_tokens(F.col("__tokens"))
        profile = F.sort_array(F.concat(listed, others.cast(quality.PROFILE_TYPE)))
    else:
        profile = quality.profile_of_tokens(F.col("__tokens"))
    return _finished(grouped.withColumn("qa", profile).drop(*failures))


def _pieces(rows: DataFrame, hot: DataFrame, piece: int) -> DataFrame:
    """All timelines of the ``hot`` groups in pieces: gathered and cut where a task holds a few pieces,
    ranked without bringing them together where not."""
    order, held = F.col("__order"), skew.whole_rows(piece)
    longest = hot if held == piece else skew.small_or_none(hot.where(F.col("n_rows") > held))
    near = rows if longest is None else rows.join(longest, skew.null_safe(rows, longest, KEYS), "left_anti")
    whole = near.groupBy(*KEYS).agg(gathered(order, timeline_item()).alias("monthly"))
    cut = skew.cut_whole(whole, KEYS, "monthly", piece).select(*KEYS, "part", "monthly")
    if longest is None:
        return cut
    far = rows.join(longest, skew.null_safe(rows, longest, KEYS), "left_semi")
    ranked = _ranked_pieces(far, longest, piece)
    return ranked if held == piece else cut.unionByName(ranked)


def _ranked_pieces(rows: DataFrame, hot: DataFrame, piece: int) -> DataFrame:
    n_rows = hot.agg(F.sum("n_rows")).first()[0]
    ranked = skew.rank_pieces(rows, KEYS, F.col("__order"), timeline_item(), piece, n_rows)
    return skew.gather_pieces(ranked, KEYS, "monthly").select(*KEYS, "part", "monthly")


def _many_long_loans(
    rows: DataFrame, hot: DataFrame, compat: bool, piece: int, cut: bool, parts: bool
) -> tuple[DataFrame, DataFrame | None]:
    """The loans and their further pieces where too many are longer than a ``piece`` to be set apart by a
    broadcast: what a task holds whole is rolled up in the one aggregation, whose timelines are cut
    behind it, so that no row travels to learn how long its loan is. Only longer ones are set apart."""
    held = skew.whole_rows(piece)
    longest = skew.small_or_none(hot.where(F.col("n_rows") > held))
    near = rows if longest is None else rows.join(longest, skew.null_safe(rows, longest, KEYS), "left_anti")
    whole = _whole_loans(near, compat, min(LANE_BITS, held.bit_length()))
    rest = None
    if parts:
        whole = skew.cut_whole(whole, [c for c in whole.columns if c != "monthly"], "monthly", piece)
    elif cut:
        timelines = near.groupBy(*KEYS).agg(gathered(F.col("__order"), timeline_item()).alias("monthly"))
        pieces = skew.cut_whole(timelines, KEYS, "monthly", piece)
        rest = pieces.where(F.col("part") >= 1).to(_timelines_schema())
        whole = whole.withColumn("monthly", F.slice("monthly", 1, piece))
    if longest is None:
        return whole, rest
    far = rows.join(longest, skew.null_safe(rows, longest, KEYS), "left_semi")
    pieces = _ranked_pieces(far, longest, piece)
    loans = whole.unionByName(_long_loans(far, pieces, compat, parts))
    further = None if parts else pieces.where(F.col("part") >= 1).to(_timelines_schema())
    return loans, further if rest is None else rest.unionByName(further)


def _long_loans(rows: DataFrame, pieces: DataFrame, compat: bool, parts: bool = False) -> DataFrame:
    """Loans too long for one task: aggregates combine before the shuffle, and of the timelines only
    first pieces, one per loan, meet them; with ``parts`` all pieces, a row for each."""
    order = F.col("__order")
    statics = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("__n"),
        *[agg.alias(name) for name, agg in static_aggregates(order, compat).items()],
    )
    profiled = quality.join_qa(statics, quality.qa_profile(rows, KEYS), KEYS)
    met = pieces if parts else pieces.where(F.col("part") == 0)
    named = met.select(*[F.col(k).alias(f"__{k}") for k in KEYS], "monthly", *(["part"] if parts else []))
    match = F.lit(True)
    for k in KEYS:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return _finished(profiled.join(named, match).drop(*[f"__{k}" for k in KEYS]))


def _field(name: str) -> T.StructField:
    field = FIELDS[name].struct_field
    if name in MEANS:  # a mean of whole numbers need not be one
        return T.StructField(name, T.FloatType(), True, field.metadata)
    return field


def _timelines_schema() -> T.StructType:
    fields = {f.name: f for f in loan_schema().fields}
    return T.StructType([_field("file"), _field("lnId"), T.StructField("part", T.IntegerType()), fields["monthly"]])


def loan_schema() -> T.StructType:
    """Columns, types and descriptions of the loan table."""
    monthly = T.StructType([_field(n) for n in TIMELINE])
    profile = T.StructType([_field("field"), _field("cntFail")])
    all_fail = FIELDS["allFail"]
    return T.StructType(
        [
            _field("lnId"),
            T.StructField("monthly", T.ArrayType(monthly), True, {"comment": "monthly values"}),
            *[_field(n) for n in STATICS],
            *[_field(n) for n in ("bucket", "harpLnId", "preHarpId")],
            T.StructField("qa", T.ArrayType(profile), True, {"comment": "validation results"}),
            T.StructField(
                "allFail", T.ArrayType(T.StringType()), True, {"comment": all_fail.comment}
            ),
            _field("nMonths"),
        ]
    )
