"""The queries of ``queries.py`` as SQL for DuckDB, on the same tables.

Field values (levels, ranges, sentinels) come from the catalogue; the logic is written anew.
"""

from __future__ import annotations

from loantape.catalogue import (
    EXTENDED_FIELDS,
    FIELDS,
    MSA_RECODE,
    TAPE_FIELDS,
)
from oracle_listing import LISTING

import fixtures

AS_OF = "DATE '2024-01-01'"
RAW = [*TAPE_FIELDS, *EXTENDED_FIELDS]
ID = "file, lnId, payHist"
ORD = "month, payHist"


def quoted(text) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def constant(spec, value) -> str:
    if spec.kind == "string":
        return quoted(value)
    if spec.kind == "date":
        return f"DATE '{value}'"
    return f"cast({value} as {'float' if spec.kind == 'float' else 'int'})"


def typed(spec, text=None) -> str:
    t = text or spec.name
    if spec.kind == "string":
        return t
    if spec.kind == "date":
        iso = f"substr({t},3,4) || '-' || substr({t},1,2) || '-01'"
        return f"case when regexp_matches({t}, '^[0-9]{{6}}$') then try_cast({iso} as date) end"
    if spec.kind == "float":
        number = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
        return f"case when regexp_matches({t}, '{number}') then try_cast({t} as float) end"
    return f"try_cast(nullif({t}, '') as int)"


def legal(spec, value) -> str:
    if spec.name == "zip3":
        return f"regexp_matches({value}, '^[0-9]{{3}}$') and {value} >= '005'"
    if spec.name == "msa":
        return (
            f"({value} = '00000' or (regexp_matches({value}, '^[0-9]{{5}}$') "
            f"and {value} between '10000' and '49999'))"
        )
    if spec.levels is not None:
        return f"{value} in ({','.join(quoted(x) for x in spec.levels)})"
    if spec.pattern is not None:
        raise NotImplementedError(spec.name)
    if spec.kind == "date":
        high = f"cast({AS_OF} + interval {spec.horizon} month as date)"
        return f"{value} >= DATE '1999-01-01' and {value} <= {high}"
    if spec.low is not None:
        return f"{value} >= {spec.low} and {value} <= {spec.high}"
    return f"{value} is not null"


def checked(spec) -> str:
    """Value or default, NULL for a failure."""
    t = spec.name
    given = f"case when {legal(spec, '(' + typed(spec) + ')')} then {typed(spec)} end"
    if spec.default is None:
        return given
    return f"case when {t} = '' then {constant(spec, spec.default)} else {given} end"


def flag(test) -> str:
    return f"case when {test} then 'Y' else 'N' end"


RECODE = "case msa " + " ".join(f"when '{a}' then '{b}'" for a, b in MSA_RECODE.items()) + " else msa end"
QA_NAMES = [*[f.name for f in RAW], "dq", "propVal"]


def _checked_column(spec) -> str:
    if spec in EXTENDED_FIELDS:
        return f"case when standard = 'Y' then 'N' else {checked(spec)} end as {spec.name}"
    return f"{checked(spec)} as {spec.name}"


PANEL = f"""panel as (select *, case when file = 'exclusions.csv' then 'N' else 'Y' end as standard
 from ({fixtures.WIDE_SQL}))"""
CHECKED = f"""{PANEL}, fields as (select file, standard,
 {", ".join(_checked_column(f) for f in RAW)} from panel),
checked as (select *, try_cast(dqStat as int) as dq,
 case when year(coalesce(fpDt, DATE '1970-01-01')) = 1970 then 'XXXXQX'
  else year(fpDt) || 'Q' || quarter(fpDt) end as vintage,
 cast(cast(opb as double) / cast(cast(cast(ltv as double) / 100.0 as float) as double) as float) as pv
 from fields),
legal as (select * exclude (pv), case when pv >= 1000 and pv <= 5000000 then pv end as propVal
 from checked)"""
_FILLED = ", ".join(
    f"coalesce({f.name}, {constant(f, f.missing)}) as {f.name}" for f in RAW if f.name != "msa"
)
MONTHLY = f"""{CHECKED}, failed as (select *,
 concat_ws(':', {", ".join(f"case when {n} is null then '{n}' end" for n in QA_NAMES)}) as names
 from legal),
monthly as (select file, standard, {_FILLED},
 coalesce({RECODE}, 'XXXXX') as msa, coalesce(dq, -1) as dq, vintage,
 coalesce(propVal, cast(-1 as float)) as propVal,
 case when names = '' then '' else ':' || names || ':' end as qa
 from failed),
aged as (select *, case when year(fpDt) > 1990
 then cast((year(month) - year(fpDt)) * 12 + month(month) - month(fpDt) as bigint) else -1000 end
 as ageFpDt from monthly)"""
TOKENS = f"""{MONTHLY}, tokens as (select file, lnId, payHist, unnest(string_split(qa, ':')) as field
 from monthly)"""


def _listed(field) -> str:
    always = f" or {field} in ({', '.join(map(quoted, [*MSA_RECODE, '00000']))})" if field == "msa" else ""
    return f"(({field}) in (select trim(code) from codes where field = '{field}'){always})"


# The same with areas and postal prefixes held to the table of codes.
CODED = f"codes as ({fixtures.CODES_SQL}), {MONTHLY}"
for _name in ("msa", "zip3"):
    _rule = legal(FIELDS[_name], f"({_name})")
    assert CODED.count(_rule) == 1, _name
    CODED = CODED.replace(_rule, _listed(_name))
MAP = f"id_map as ({fixtures.ID_MAP_SQL})"


def on_panel(select) -> str:
    return f"with {PANEL} {select}"


def on_monthly(select) -> str:
    return f"with {MONTHLY} {select}"


def on_tokens(select) -> str:
    return f"with {TOKENS} {select}"


def per_loan(**columns) -> str:
    items = ", ".join(f"{sql} as {name}" for name, sql in columns.items())
    return on_monthly(f"select file, lnId, {items} from monthly group by file, lnId")


def flat(sql) -> str:
    return f"round(cast({sql} as double), 4)"


def joined(sql, order=ORD) -> str:
    return f"coalesce(string_agg(cast({sql} as varchar), ';' order by {order}), '')"


# ---- aggregates of one loan -------------------------------------------------------------------


def first(column, test) -> str:
    return f"first({column} order by {ORD}) filter (where {test})"


def first_text(column, missing, *skip) -> str:
    bad = ", ".join(quoted(x) for x in (missing, *skip))
    found = first(column, f"{column} not in ({bad})")
    return f"coalesce(nullif({found}, ''), {quoted(missing)})"


def seller() -> str:
    probe = first("lower(seller)", "lower(seller) <> 'unknown'")
    found = first("seller", "seller <> 'unknown'")
    return f"case when coalesce({probe}, '') = '' then 'unknown' else {found} end"


def first_date(column) -> str:
    return f"coalesce({first(column, f'year({column}) > 1970')}, DATE '1970-01-01')"


def mean(column, test=None, missing=-1) -> str:
    test = test or f"{column} <> {missing}"
    average = f"avg(cast({column} as double)) filter (where {test})"
    return f"case when coalesce({average}, -1) > 0 then {average} else {missing} end"


def mean_f32(column, **options) -> str:
    return flat(f"cast({mean(column, **options)} as float)")


def mean_i32(column, **options) -> str:
    return f"cast(trunc({mean(column, **options)}) as int)"


def strict_mean(column, test=None) -> str:
    test = test or f"{column} <> -1"
    return f"coalesce(avg(cast({column} as double)) filter (where {test}), -1)"


def given_max(column, missing, default=0) -> str:
    return (
        f"coalesce(max({column}) filter (where {column} not in ({missing}, {default})), "
        f"max({column}) filter (where {column} = {default}), {missing})"
    )


def any_y(column, yes="Y", no="N") -> str:
    return f"case when bool_or({column} = 'Y') then '{yes}' else '{no}' end"


MEANS = "dti rate opb term ltv cltv units mi fclWriteOff propVal".split()
MAXIMA = (
    "zbUpb fclExp fclPExp fclLExp fclMExp fclTaxes fclProNet fclProMi fclProMw fclProOth"
).split()
DATES = "origDt fpDt ioDt zbDt lpDt fclDt dispDt".split()
FIRST_TEXTS = {
    "channel": "X", "firstTime": "X", "purpose": "X", "propType": "XX", "occ": "X", "state": "XX",
    "msa": "XXXXX", "zip3": "XXX", "amType": "XXX", "io": "X", "miType": "X", "relo": "X",
    "valMthd": "X", "sConform": "X", "hltv": "X", "vintage": "XXXXQX",
}
FIRST_ROW = ["standard", "nsDoc", "nsUw", "gGuar", "negAm"]
TIMELINE = {
    "month": "last_day(month)", "upb": "cast(round(cast(upb as double) * 100) as bigint)", "dq": "dq",
    "servicer": "lower(servicer)", "curRate": "cast(round(cast(curRate as double) * 100) as bigint)", "age": "age",
    "ageFpDt": "ageFpDt", "rTermLgl": "rTermLgl", "rTermAct": "rTermAct", "dqStat": "dqStat",
    "mod": "mod", "zb": "zb", "ioRem": "ioRem", "bap": "bap", "program": "program",
    "nonIntUpb": "cast(round(cast(nonIntUpb as double) * 100) as bigint)", "frgvUpb": "cast(round(cast(frgvUpb as double) * 100) as bigint)",
    "totPrin": "cast(round(cast(totPrin as double) * 100) as bigint)", "servAct": "servAct", "matDt": "matDt",
}

STATICS = {
    **{n: first_text(n, m) for n, m in FIRST_TEXTS.items()},
    "seller": seller(),
    "altRes": first_text("altRes", "X", "7", "9"),
    **{n: f"cast({first_date(n)} as varchar)" for n in DATES},
    **{n: mean_f32(n) for n in MEANS},
    **{n: mean_i32(n) for n in ("numBorr", "fico", "coFico")},
    "altResCnt": mean_i32("altResCnt", test="altResCnt > 0"),
    "totDefrl": mean_f32("totDefrl", test="totDefrl >= 0"),
    **{n: flat(f"max({n})") for n in MAXIMA},
    "pPen": any_y("pPen", "N", "Y"),
    "reprchMw": any_y("reprchMw"),
    **{n: f"first({n} order by {ORD})" for n in FIRST_ROW},
}

BUCKET = " + ".join(
    f"case when length(lnId) >= {5 + i} and (ascii(substr(lnId, {5 + i}, 1)) >> {k}) & 1 = 1 "
    f"then {8 * i + k} else 0 end"
    for i in range(8)
    for k in range(8)
)

PROFILE = """counts as (select file, lnId, field, cast(count(*) as int) as cntFail from tokens
 where field <> '' group by file, lnId, field),
profile as (select file, lnId,
 string_agg(field || '=' || cntFail, ';' order by field) as qa from counts group by file, lnId),
allfail as (select c.file, c.lnId, string_agg(field, ';' order by field) as allFail
 from counts c join (select file, lnId, count(*) as n from monthly group by file, lnId) m
 on m.file = c.file and m.lnId is not distinct from c.lnId and c.cntFail = m.n
 group by c.file, c.lnId)"""


# A third of all rows under a blank id and some under none.
BLANK_ID = "case when dti % 3 = 0 then '' when dti % 17 = 1 then null else lnId end"


def blanked(sql) -> str:
    """The same SQL on the panel with blank and NULL ids."""
    plain = sql.replace("monthly as (select file, standard,", "plain as (select file, standard,")
    named = f"\nmonthly as (select * replace ({BLANK_ID} as lnId) from plain),\naged as (select *,"
    return plain.replace("\naged as (select *,", named)


def rollup(piece=None, lines=True, parts=None) -> str:
    """One row per loan; ``lines``: with the first ``piece`` months of the timeline as texts. ``parts``: with
    all months, in a row for each so many of them."""
    statics = ", ".join(f"{sql} as {n}" for n, sql in STATICS.items())
    texts = "".join(f", {joined(sql)} as monthly_{n}" for n, sql in TIMELINE.items()) if lines else ""
    rank = "" if piece is None else f"where rank <= {piece}"
    part = "" if parts is None else f", cast((rank - 1) // {parts} as int) as part"
    same = lambda x: f"{x}.file is not distinct from s.file and {x}.lnId is not distinct from s.lnId"
    return f"""with {TOKENS}, {PROFILE}, {MAP},
statics as (select file, lnId, count(*) as nMonths,
 {flag("contains(lower(file), 'harp')")} as harp, {statics} from aged group by file, lnId),
ranked as (select *, row_number() over (partition by file, lnId order by {ORD}) as rank from aged),
lines as (select file, lnId{part}{texts} from ranked {rank} group by file, lnId{", part" if part else ""})
select l.*, s.* exclude (file, lnId), cast(({BUCKET.replace("lnId", "coalesce(s.lnId, '')")}) % 20 as int) as bucket,
 coalesce(a.harpLnId, '') as harpLnId, coalesce(b.oldLnId, '') as preHarpId,
 coalesce(p.qa, '') as qa, coalesce(f.allFail, '') as allFail
from lines l join statics s on {same("l")}
 left join id_map a on a.oldLnId = s.lnId left join id_map b on b.harpLnId = s.lnId
 left join profile p on {same("p")} left join allfail f on {same("f")}"""


def timelines(piece) -> str:
    return f"""with {MONTHLY}, ranked as (select *,
 (row_number() over (partition by file, lnId order by {ORD}) - 1) // {piece} as part from aged)
select file, lnId, cast(part as int) as part, {joined(TIMELINE["dq"])} as dq, {joined(TIMELINE["upb"])} as upb
from ranked group by file, lnId, part"""


def fields(*names) -> list:
    return [f for f in RAW if f.name in names]


def legal_flags(*names) -> str:
    # A text that does not convert is not legal.
    tests = ", ".join(
        f"{flag(f'coalesce({legal(f, chr(40) + typed(f) + chr(41))}, false)')} as {f.name}"
        for f in fields(*names)
    )
    return on_panel(f"select {ID}, {tests} from panel")


def filled(f) -> str:
    sql = f"coalesce({checked(f)}, {constant(f, f.missing)})"
    if f.kind == "date":
        sql = f"cast({sql} as varchar)"
    return f"{flat(sql) if f.kind == 'float' else sql} as {f.name}"


def qa_text(names) -> str:
    failed = ", ".join(
        f"case when {checked(f)} is null then '{f.name}' end" for f in fields(*names)
    )
    return f"concat_ws(':', {failed})"


DEFAULTED = ["seller", "mi", "zb", "altRes", "coFico", "cltv", "miType", "zbDt"]
COPIES = "select file, lnId, count(*) as n from monthly group by file, lnId"


def arr(column) -> str:
    return f"list({column} order by {ORD})"


SQL: dict[str, str] = {
    "scan_loans": on_panel(
        f"select file, standard, {', '.join(f.name for f in TAPE_FIELDS)}, "
        + ", ".join(
            f"case when standard = 'Y' then '' else {f.name} end as {f.name}"
            for f in EXTENDED_FIELDS
        )
        + " from panel"
    ),
    "discover_files": on_panel("select distinct file as folder from panel"),
    "detect_layout": on_panel(
        "select distinct file as folder, cast(case when standard = 'Y' then 108 else 112 end as int)"
        " as width, standard from panel"
    ),
    "scan_id_map": fixtures.ID_MAP_SQL,
    "write_monthly": on_monthly(
        f"select {ID}, cast(month as varchar) as month, dq, vintage, qa, {flat('upb')} as upb, "
        f"{flat('propVal')} as propVal from monthly"
    ),
    "write_loans": f"""with {MONTHLY}, {MAP}, loans as (select file, lnId,
 {STATICS["fico"]} as fico, {STATICS["vintage"]} as vintage, cast(count(*) as int) as n
 from monthly group by file, lnId)
select l.*, coalesce(a.harpLnId, '') as harpLnId, coalesce(b.oldLnId, '') as preHarpId from loans l
 left join id_map a on a.oldLnId = l.lnId left join id_map b on b.harpLnId = l.lnId""",
    "repeat_run": f"""with {MONTHLY}, {MAP}, loans as (select file, lnId,
 {STATICS["fico"]} as fico, {STATICS["vintage"]} as vintage, cast(count(*) as int) as n
 from monthly group by file, lnId)
select l.*, coalesce(a.harpLnId, '') as harpLnId, coalesce(b.oldLnId, '') as preHarpId from loans l
 left join id_map a on a.oldLnId = l.lnId left join id_map b on b.harpLnId = l.lnId""",
    "scan_misfits": on_panel(
        """, kinds as (select *, cast(zip3 as int) % 17 as kind,
 cast(case when standard = 'Y' then 108 else 112 end as int) as layout from panel)
select file, case kind when 3 then 'short' when 5 then 'long' when 7 then 'open quote' else 'fits' end as reason,
 case kind when 3 then 20 when 5 then layout + 2 else layout end as n_columns, layout, lnId,
 case when kind in (3, 5, 7) then '' else payHist end as payHist,
 case when kind in (3, 5, 7) then '' else seller end as seller from kinds"""
    ),
    "valid_codes": f"with {CODED} select {ID}, msa, zip3, qa from monthly",
    "qa_profile_codes": f"""with {CODED}, tokens as (select file, lnId, unnest(string_split(qa, ':')) as field from monthly)
select file, lnId, field, cast(count(*) as int) as cntFail from tokens where field <> '' group by file, lnId, field""",
    "write_id_map": fixtures.ID_MAP_SQL,
    "query_source": on_monthly(
        "select file, channel, count(*) as n_rows, count(distinct lnId) as n_loans, "
        "cast(sum(dq) as bigint) as sum_dq from monthly where dq >= 0 group by file, channel"
    ),
    "describe_loans": "select * from (values "
    + ", ".join(f"({i}, {', '.join(map(quoted, row))})" for i, row in enumerate(LISTING))
    + ") as t(position, name, type, comment)",
    "append_runs": on_monthly(
        f"select h.how, l.* from (select file, lnId, first(standard) as standard, "
        f"{STATICS['fico']} as fico, cast(count(*) as int) as n from monthly group by file, lnId) l "
        "cross join (values ('one job'), ('two runs')) as h(how)"
    ),
    "cast_fields": on_panel(
        f"select {ID}, "
        + ", ".join(
            f"coalesce(cast({typed(FIELDS[n])} as varchar), 'none') as {n}"
            for n in ("month", "fpDt", "lpDt")
        )
        + ", "
        + ", ".join(f"coalesce({typed(FIELDS[n])}, -99) as {n}" for n in ("ltv", "term"))
        + ", "
        + ", ".join(
            f"{flat(f'coalesce({typed(FIELDS[n])}, -99)')} as {n}" for n in ("rate", "totPrin")
        )
        + ", seller from panel"
    ),
    "drop_fields": on_panel(
        "select file, count(*) as n_rows, 74 as n_kept, 0 as n_unused from panel group by file"
    ),
    "constant_fields": on_panel(
        f"select {ID}, standard, "
        + ", ".join(
            f"case when standard = 'Y' then 'N' else {f.name} end as {f.name}"
            for f in EXTENDED_FIELDS
        )
        + " from panel"
    ),
    "file_field": on_panel("select file, count(*) as n_rows from panel group by file"),
    "standard_flag": on_panel(
        "select file, standard, count(*) as n_rows from panel group by file, standard"
    ),
    "star_plus": on_monthly(f"select {ID}, ageFpDt, 81 as n_columns from aged"),
    "nest": on_monthly(
        "select file, lnId, cast(row_number() over (partition by file, lnId "
        f"order by {ORD}, dq, zb) - 1 as int) as pos, cast(last_day(month) as varchar) as month, dq, zb "
        "from monthly"
    ),
    "filter_nonempty": on_tokens(f"select {ID}, field from tokens where field <> ''"),
    "field_docs": per_loan(
        fico="max(fico)", state="min(state)",
        fico_doc="'fico at origination, 301-850, missing=-1'", state_width="2",
    ),
    "check_schema": on_monthly(
        "select file, 80 as n_columns, count(*) as n_rows from monthly group by file"
    ),
    "valid_levels": legal_flags("channel", "purpose", "state", "zip3", "dqStat", "program", "msa"),
    "valid_range": legal_flags("ltv", "dti", "fico", "opb", "fclProNet", "numBorr", "frgvUpb"),
    "valid_dates": legal_flags("month", "fpDt", "origDt", "matDt", "fclDt", "ioDt"),
    "type_check": on_panel(
        f"select {ID}, "
        + ", ".join(
            f"{flag(f'{f.name} <> {quoted(str())} and ({typed(f)}) is null')} as {f.name}"
            for f in fields("term", "totPrin", "fclMExp", "lpDt", "totDefrl", "ltv")
        )
        + " from panel"
    ),
    "missing_value": on_panel(
        f"select {ID}, "
        + ", ".join(
            filled(f)
            for f in fields("channel", "fico", "fpDt", "opb", "zip3", "dqStat", "term")
        )
        + " from panel"
    ),
    "default_value": on_panel(
        f"select {ID}, {', '.join(filled(f) for f in fields(*DEFAULTED))}, "
        f"case when {qa_text(DEFAULTED)} = '' then '' else ':' || {qa_text(DEFAULTED)} || ':' end "
        "as qa from panel"
    ),
    "qa_fields": on_monthly(f"select {ID}, qa from monthly"),
    "recode_msa": on_monthly(f"select {ID}, msa from monthly"),
    "derived_valid": on_monthly(
        f"select {ID}, dq, {flat('propVal')} as propVal, {flag('dq < 0')} as dq_failed, "
        f"{flag('propVal < 0')} as propVal_failed from monthly"
    ),
    "qa_profile": on_tokens(
        "select file, lnId, field, cast(count(*) as int) as cntFail from tokens where field <> '' "
        "group by file, lnId, field"
    ),
    "qa_all_fail": f"with {TOKENS}, {PROFILE} select m.file, m.lnId, m.n as n_rows, "
    f"coalesce(a.allFail, '') as allFail from ({COPIES}) m left join allfail a "
    "on a.file = m.file and a.lnId = m.lnId",
    "qa_counts": f"""with {TOKENS}, counts as (select file, lnId, field, count(*) as n from tokens
 where field in ('channel', 'dti', 'fico', 'propVal') group by file, lnId, field)
select m.file, m.lnId, coalesce(string_agg(field || '=' || c.n, ';' order by field), '') as qa
from ({COPIES}) m left join counts c on c.file = m.file and c.lnId = m.lnId
group by m.file, m.lnId""",
    "dq": on_monthly(f"select {ID}, dqStat, coalesce(try_cast(dqStat as int), -1) as dq from monthly"),
    "vintage": on_monthly(f"select {ID}, cast(fpDt as varchar) as fpDt, vintage from monthly"),
    "prop_val": f"with {CHECKED} select {ID}, {flat('coalesce(pv, -1)')} as propVal from checked",
    "age_fp": on_monthly(f"select {ID}, ageFpDt from aged"),
    "month_end": on_monthly(f"select {ID}, cast(last_day(month) as varchar) as month from monthly"),
    "lower": on_monthly(
        f"select {ID}, lower(servicer) as servicer_lower, lower(seller) as seller_lower, "
        "lower(file) as file_lower from monthly"
    ),
    "year_filter": on_monthly(
        f"select {ID}, cast(year(fpDt) as int) as year from monthly where year(fpDt) > 1970"
    ),
    "split_tokens": on_monthly(
        f"select {ID}, cast(len(string_split(qa, ':')) as int) as n_tokens from monthly"
    ),
    "harp_flag": on_monthly(
        f"select {ID}, {flag(chr(99) + 'ontains(lower(file), ' + quoted('harp') + ')')} as harp "
        "from monthly"
    ),
    "bucket": on_monthly(
        f"select lnId, cast(({BUCKET}) % 20 as int) as bucket from (select distinct lnId from monthly)"
    ),
    "conditional": on_monthly(
        f"select {ID}, dti, case when dti > 43 then 'high' else 'normal' end as band from monthly"
    ),
    "cast_f32": "select l_orderkey, l_linenumber, l_partkey, "
    f"{flat('cast(l_extendedprice / 7 as float)')} as price from lineitem",
    "cast_i32": "select l_orderkey, l_linenumber, l_partkey, "
    "cast(trunc((l_quantity - 25) * cast(1.37 as double)) as int) as units from lineitem",
    "array_first": per_loan(
        dti=f"coalesce({first('dti', 'dti > 50')}, -1)",
        channel=f"coalesce({first('channel', 'channel <> ' + quoted('X'))}, '')",
    ),
    "array_filter": per_loan(
        dq=f"coalesce(string_agg(cast(dq as varchar), ';' order by {ORD}) filter (where dq > 1), '')",
        zb=f"coalesce(string_agg(zb, ';' order by {ORD}) filter (where dq > 1), '')",
    ),
    "array_avg": per_loan(dti=flat("coalesce(avg(dti) filter (where dti <> -1), -1)")),
    "array_max": per_loan(fclProNet=flat("max(fclProNet)")),
    "array_sum": per_loan(
        dq="cast(sum(dq) as bigint)", upb=flat("sum(cast(upb as double))")
    ),
    "index_of": per_loan(
        **{
            c: f"cast(coalesce(list_position({arr(c)}, 'Y'), 0) as bigint)"
            for c in ("pPen", "reprchMw")
        }
    ),
    "element_at": per_loan(
        first=f"{arr('payHist')}[1]", second=f"coalesce({arr('payHist')}[2], '')"
    ),
    "array_length": per_loan(n="cast(count(*) as int)"),
    "substr": on_monthly(f"select {ID}, substr(lnId, 5, 8) as tail from monthly"),
    "bit_positions": """with v as (select distinct l_orderkey, l_partkey,
 l_orderkey * 4096 + l_partkey as v from lineitem),
p as (select v.*, k from v cross join range(0, 63) as r(k) where (v >> cast(k as int)) & 1 = 1)
select v.l_orderkey, v.l_partkey, coalesce(string_agg(cast(k as varchar), ';' order by k), '') as positions,
 cast(coalesce(sum(k), 0) as bigint) as total
from v left join p on p.l_orderkey = v.l_orderkey and p.l_partkey = v.l_partkey
group by v.l_orderkey, v.l_partkey""",
    "timeline": per_loan(
        month=joined("last_day(month)"), dq=joined("dq"), mod=joined("mod")
    ),
    "timeline_events": """with ranked as (select *,
 cast((row_number() over (partition by event_type order by ts, event_id) - 1) // 500 as int) as part
 from events)
select event_type, part, cast(count(*) as int) as n,
 string_agg(cast(event_id as varchar), ';' order by ts, event_id) as ids
from ranked group by event_type, part""",
    "timeline_copies": """with ranked as (select event_type, user_id % 3 as kind,
 cast((row_number() over (partition by event_type order by user_id % 3) - 1) // 300 as int) as part
 from events)
select event_type, part, kind, count(*) as n from ranked group by event_type, part, kind""",
    "first_non_missing": per_loan(
        **{n: STATICS[n] for n in ("seller", "channel", "purpose", "occ", "miType", "state")},
        **{n: STATICS[n] for n in ("msa", "zip3", "vintage")},
    ),
    "first_non_missing_except": per_loan(altRes=STATICS["altRes"]),
    "first_valid_date": per_loan(**{n: STATICS[n] for n in DATES}),
    "avg_non_missing": per_loan(
        **{n: STATICS[n] for n in "dti rate opb term ltv mi fclWriteOff propVal".split()}
    ),
    "avg_non_missing_strict": per_loan(
        **{n: flat(strict_mean(n)) for n in ("mi", "fclWriteOff")}
    ),
    "avg_non_missing_int": per_loan(**{n: STATICS[n] for n in ("numBorr", "fico", "coFico")}),
    "avg_positive": per_loan(altResCnt=STATICS["altResCnt"]),
    "avg_nonnegative": per_loan(totDefrl=flat(mean("totDefrl", test="totDefrl >= 0"))),
    "max_value": per_loan(**{n: STATICS[n] for n in MAXIMA}),
    "max_given": per_loan(
        **{n: flat(given_max(n, -1)) for n in ("fclPExp", "fclLExp", "fclProNet", "zbUpb")}
    ),
    "any_flag": per_loan(reprchMw=STATICS["reprchMw"]),
    "no_flag": per_loan(pPen=STATICS["pPen"]),
    "first_row": per_loan(**{n: STATICS[n] for n in FIRST_ROW}),
    "count_by_key": on_tokens(
        "select file, lnId, field, cast(count(*) as int) as cntFail from tokens where field <> '' "
        "group by file, lnId, field"
    ),
    "group_to_arrays": f"with {TOKENS}, {PROFILE} select file, lnId, "
    "string_agg(field, ';' order by field) as field, "
    "string_agg(cast(cntFail as varchar), ';' order by field) as cntFail from counts "
    "group by file, lnId",
    "loan_rollup": rollup(),
    "loan_rollup_default": "select file, lnId, nMonths, monthly_month, harpLnId, qa, "
    f"{', '.join([*MEANS, *MAXIMA])} from ({rollup()})",
    "loan_rollup_parts": rollup(3),
    "loan_rollup_buckets": rollup(),
    "monthly_buckets": blanked(on_tokens(
        "select file, lnId, field, cast(count(*) as int) as cntFail from tokens where field <> '' "
        "group by file, lnId, field"
    )),
    "loan_rollup_blank": blanked(rollup(parts=4096)),
    "loan_rollup_blank_parts": blanked(rollup(lines=False)),
    "loan_timelines": blanked(timelines(5)),
    "loan_rollup_strict": per_loan(
        pPen=any_y("pPen"),
        coFico=f"cast(trunc({strict_mean('coFico', 'coFico not in (-1, 0)')}) as int)",
        **{n: flat(f"cast({strict_mean(n)} as float)") for n in MEANS},
        **{n: flat(given_max(n, FIELDS[n].missing)) for n in MAXIMA},
    ),
    "link_successor": f"with {MONTHLY}, {MAP} select l.*, coalesce(m.harpLnId, '') as harpLnId "
    "from (select distinct file, lnId from monthly) l left join id_map m on m.oldLnId = l.lnId",
    "link_predecessor": f"with {MONTHLY}, {MAP} select l.*, coalesce(m.oldLnId, '') as preHarpId "
    "from (select distinct file, lnId from monthly) l left join id_map m on m.harpLnId = l.lnId",
    "link_many": "select c_custkey, c_mktsegment, coalesce(o_orderstatus, '') as status "
    "from customer left join orders on o_custkey = c_custkey",
    "join_qa": f"""with {MONTHLY}, tokens as (select file, lnId, unnest(string_split(qa, ':')) as field
 from monthly where contains(qa, ':fico:')),
counts as (select file, lnId, field, count(*) as n from tokens where field <> ''
 group by file, lnId, field)
select m.file, m.lnId, coalesce(string_agg(field || '=' || c.n, ';' order by field), '') as qa
from ({COPIES}) m left join counts c on c.file = m.file and c.lnId = m.lnId
group by m.file, m.lnId""",
    "explode_qa": on_tokens(f"select {ID}, field from tokens"),
    "sort_loan_month": on_monthly(
        "select lnId, cast(month as varchar) as month, payHist, dq, "
        "row_number() over (order by lnId, month, payHist, dq) - 1 as place from monthly"
    ),
    "sort_copies": on_monthly(
        "select channel, dq, row_number() over (order by channel, dq) - 1 as place from monthly"
    ),
    "sample_limit": on_monthly(
        "select lnId, cast(month as varchar) as month, payHist, dq from "
        "(select * from monthly order by lnId, month, payHist limit 10)"
    ),
    "cte": per_loan(n="count(*)", worst="max(dq)"),
    "subquery": per_loan(late="max(case when dq > 2 then 1 else 0 end)"),
    "primary_order": on_monthly(
        f"select lnId, cast(month as varchar) as month, payHist, {flat('upb')} as upb from monthly"
    ),
    "derive": on_monthly(
        f"select {ID}, {flat('curRate - rate')} as spread, case when fico >= 700 then 'A' "
        "when fico >= 600 then 'B' else 'C' end as band from monthly"
    ),
    "extra_specs": on_monthly(
        f"select {ID}, case when curRate - rate between -2 and 6 then {flat('curRate - rate')} "
        "else -99 end as spread, case when fico >= 700 then 'A' when fico >= 600 then 'B' else 'X' "
        "end as band, case when bad = '' then '' else ':' || bad || ':' end as qa from (select *, "
        "concat_ws(':', case when curRate - rate not between -2 and 6 then 'spread' end, "
        "case when fico < 600 then 'band' end) as bad from monthly)"
    ),
}
