"""The loan tape's fields.

Fixed values: positions, names, types, legal values, sentinels, defaults and descriptions below are
the data model of the tape and must stay as they are for results to be right.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from loantape.spec import FieldSpec, check_specs

EPOCH = date(1970, 1, 1)
FIRST_DATE = date(1999, 1, 1)

STANDARD_WIDTH = 108
EXTENDED_WIDTH = 112

STATES = (
    "AK AL AR AZ CA CO CT DC DE FL GA GU HI IA ID IL IN KS KY LA MA MD ME MI MN MO MS MT NC ND "
    "NE NH NJ NM NV NY OH OK OR PA PR RI SC SD TN TX UT VA VI VT WA WI WV WY"
).split()

# Three-digit postal prefixes run from 005 to 999. Which of them are assigned changes, so the list is
# a table of codes (``operators.codes``); without one, every code of that form is legal.
ZIP3_PATTERN = "^(00[5-9]|0[1-9][0-9]|[1-9][0-9]{2})$"

# Retired area codes and the codes that replaced them.
MSA_RECODE = {
    "31100": "31080",
    "29140": "29200",
    "26100": "24340",
    "37380": "19660",
    "37700": "25060",
    "44600": "48540",
    "14060": "14010",
    "42060": "42020",
    "21940": "41980",
    "11340": "24860",
    "26180": "25900",
    "19380": "19430",
    "11300": "26900",
    "39140": "39150",
}
NO_MSA = "00000"
# Statistical areas are numbered 10000 to 49999. The official list changes every few years, so it is
# a table of codes (``operators.codes``); without one, every code of that form is legal.
MSA_PATTERN = "^(00000|[1-4][0-9]{4})$"
# Retired area codes stay legal whatever the list, because they are replaced after the check.
ALWAYS_LEGAL = {"msa": [*MSA_RECODE, NO_MSA]}

DQ_LEVELS = [f"{n:02d}" for n in range(100)]


def _text(pos, name, comment, missing, default=None, levels=None, pattern=None, width=None):
    return FieldSpec(
        name, "string", missing, default, tuple(levels) if levels is not None else None, pattern,
        width=width, comment=comment, position=pos,
    )


def _code(pos, name, comment, levels, default=None, missing="X", width=1):
    return _text(pos, name, comment, missing, default, levels, width=width)


def _int(pos, name, comment, low, high, default=None):
    return FieldSpec(name, "int", -1, default, low=low, high=high, comment=comment, position=pos)


def _float(pos, name, comment, low=None, high=None, default=None, missing=-1.0):
    return FieldSpec(
        name, "float", missing, default, low=low, high=high, comment=comment, position=pos
    )


def _date(pos, name, comment, horizon=0, default=None):
    return FieldSpec(
        name, "date", EPOCH, default, low=FIRST_DATE, horizon=horizon, comment=comment, position=pos
    )


FORTY_YEARS = 480
_YN = ("Y", "N")

TAPE_FIELDS = check_specs([
    _text(1, "lnId", "Loan ID, missing=error", "error"),
    _date(2, "month", "month of data, missing=1970/1/1"),
    _code(3, "channel", "acquisition channel: B, R, C, missing=X", ("B", "R", "C")),
    _text(4, "seller", "name of seller, missing=unknown", "unknown", "unknown"),
    _text(5, "servicer", "name of servicer, missing=unknown", "unknown", "unknown"),
    _float(7, "rate", "note rate at origination, 0-15, missing=-1", 0.0, 15.0),
    _float(8, "curRate", "current note rate, missing=-1", 0.0, 15.0),
    _float(9, "opb", "balance at origination, missing=-1", 1000.0, 2000000.0),
    _float(11, "upb", "unpaid balance, missing=-1", 0.0, 2000000.0),
    _int(12, "term", "loan term at origination, missing=-1", 1, 700),
    _date(13, "origDt", "origination date, missing=1970/1/1"),
    _date(14, "fpDt", "first payment date, missing=1970/1/1"),
    _int(15, "age", "loan age based on origination date, missing=-1", 0, 600),
    _int(16, "rTermLgl", "remaining legal term, missing=-1", 0, 600),
    _int(17, "rTermAct", "remaining actual term, missing=-1", 0, 600),
    _date(18, "matDt", "loan maturity date (initial), missing=1970/1/1", FORTY_YEARS),
    _int(19, "ltv", "ltv at origination, 1-998, missing=-1", 1, 998),
    _int(20, "cltv", "combined cltv at origination, 1-998, missing=-1", 1, 998, -1),
    _int(21, "numBorr", "number of borrowers, 1-10, missing=-1", 1, 10),
    _int(22, "dti", "dti at origination, 1-65, missing=-1", 1, 65),
    _int(23, "fico", "fico at origination, 301-850, missing=-1", 301, 850),
    _int(24, "coFico", "coborrower fico at origination, 301-850, missing=-1", 301, 850, 0),
    _code(25, "firstTime", "first time homebuyer: Y, N, missing=X", _YN),
    _code(
        26, "purpose",
        "loan purpose: P (purch), C (cash out refi), U (rate/term refi) R (refi), missing=X",
        ("P", "C", "U", "R"),
    ),
    _code(
        27, "propType",
        "property type: SF (single family), CO (condo), PU (PUD), CP (coop), MH (manufactured), "
        "missing=XX",
        ("SF", "CO", "CP", "MH", "PU"), missing="XX", width=2,
    ),
    _int(28, "units", "# of units in the property, 1-4, missing=-1", 1, 4),
    _code(
        29, "occ", "property occupancy: P (primary), S (secondary), I (investor) missing=X",
        ("P", "S", "I"),
    ),
    _code(
        30, "state", "property state postal abbreviation, missing=XX", STATES,
        missing="XX", width=2,
    ),
    _text(
        31, "msa", "msa/division code, missing/not in MSA=XXXXX", "XXXXX", NO_MSA,
        pattern=MSA_PATTERN, width=5,
    ),
    _text(32, "zip3", "3-digit zip , missing=XXX", "XXX", pattern=ZIP3_PATTERN, width=3),
    _float(33, "mi", "mi percentage, 0-55, missing=-1", 0.0, 55.0, 0.0),
    _code(34, "amType", "amortization type: FRM, ARM, missing=XXX", ("FRM", "ARM"),
          missing="XXX", width=3),
    _code(35, "pPen", "prepay penalty flag: Y, N, missing=X", _YN),
    _code(36, "io", "io Flag: Y, N, missing=X", _YN, "N"),
    _date(37, "ioDt", "month IO loan starts amortizing, missing=1970/1/1", FORTY_YEARS, EPOCH),
    _int(38, "ioRem", "number of IO months remaining, missing=-1", 0, 700, -1),
    _code(39, "dqStat", "DQ status code: 0-99 months, missing=!", DQ_LEVELS,
          missing="!", width=3),
    _text(40, "payHist", "24 month pay history (oldest on left), missing=X", "X"),
    _code(41, "mod", "modification flag: Y, N , missing=X", ("Y", "P", "N")),
    _code(
        43, "zb",
        "zero balance:00(noop), 01(pp), 03(short), 06(repurch), 09(REO), 96/97/98(removal), "
        "02/15/16(sale), missing=X",
        ("01", "02", "03", "06", "09", "15", "16", "96", "97", "98", ""), "00", width=2,
    ),
    _date(44, "zbDt", "zero balance date, missing=1970/1/1", 0, EPOCH),
    _float(45, "zbUpb", "UPB just prior to zero balance, missing=-1", 0.0, 2000000.0, 0.0),
    _float(48, "totPrin", "delta upb", default=0.0),
    _date(50, "lpDt", "last pay date, missing=1970/1/1", 0, EPOCH),
    _date(51, "fclDt", "foreclosure date, missing=1970/1/1", 0, EPOCH),
    _date(52, "dispDt", "date the agency is done with loan, missing=1970/1/1", 0, EPOCH),
    _float(53, "fclExp", "total foreclosure expenses", 0.0, 200000.0, 0.0, missing=0.0),
    _float(54, "fclPExp", "foreclosure property preservation expenses", -2000000.0, 2000000.0, 0.0),
    _float(55, "fclLExp", "foreclosure recovery legal expenses", -2000000.0, 2000000.0, 0.0),
    _float(
        56, "fclMExp", "foreclosure misc expenses, missing=-1", -2000000.0, 2000000.0, 0.0,
        missing=0.0,
    ),
    _float(57, "fclTaxes", "foreclosure property taxes and insurance", -2000000.0, 2000000.0, 0.0),
    _float(58, "fclProNet", "foreclosure net proceeds", -2000000.0, 2000000.0, 0.0),
    _float(59, "fclProMi", "foreclosure credit enhancement proceeds", -2000000.0, 2000000.0, 0.0),
    _float(60, "fclProMw", "foreclosure make whole proceeds", -2000000.0, 2000000.0, 0.0),
    _float(61, "fclProOth", "foreclosure other proceeds", -2000000.0, 2000000.0, 0.0),
    _float(62, "nonIntUpb", "interest bearing UPB, missing=-1", 0.0, 2000000.0, 0.0),
    _float(63, "frgvUpb", "forgiven UPB, missing=-1", 0.0, 200000.0, 0.0),
    _code(
        72, "miType", "mi type: 1=borrower, 2=lender, 3=enterprise, 0=No MI, missing=X",
        ("1", "2", "3", ""), "0",
    ),
    _code(73, "servAct", "servicing activity: Y, N, missing=X", _YN),
    _code(
        78, "program", "special eligibility program: F,H,R,O,7,9, missing=X",
        ("F", "H", "R", "O", "7", "9"), "X",
    ),
    _float(
        79, "fclWriteOff", "foreclosure principal writeoff, missing=-1", -2000000.0, 2000000.0, 0.0
    ),
    _code(80, "relo", "relocation mortgage: Y, N, missing=X", _YN),
    _code(
        85, "valMthd",
        "property value method A(apprsl), P(onsite), R(GSE target), W(waived), O(other), missing=X",
        ("A", "P", "R", "W", "O"), "X",
    ),
    _code(86, "sConform", "super conforming flag: Y, N, missing=X", _YN),
    _code(
        101, "bap",
        "borrower assistant plan: F(forebearance), R(repayment), T(trial), O(Other), N(none), "
        "7,9(NA) missing=X",
        ("F", "R", "T", "O", "N", "7", "9"), "7",
    ),
    _code(102, "hltv", "high LTV refi missing=X", _YN),
    _code(104, "reprchMw", "repurchase make whole: Y, N missing=X", _YN, "N"),
    _code(
        105, "altRes",
        "DQ payment deferral: P(payment), C(Covid), D(disaster), 7/9 :NA missing=X",
        ("P", "C", "D", "7", "9"), "7",
    ),
    _int(106, "altResCnt", "# of alternate resolutions (deferrals), missing=-1", 0, 100, 0),
    _float(107, "totDefrl", "total amount deferred, missing=-1", 0.0, 200000.0, 0.0),
])

# Only the wider files of non-standard loans hold these; standard loans get the default.
EXTENDED_FIELDS = check_specs([
    _code(108, "nsDoc", "non-standard documentation: Y, N, missing=X", _YN, "N"),
    _code(109, "nsUw", "non-standard underwriting: Y, N, missing=X", _YN, "N"),
    _code(110, "gGuar", "government issued/guaranteed: Y, N, missing=X", _YN, "N"),
    _code(111, "negAm", "loan can neg am: Y, N, missing=X", _YN, "N"),
])

# Computed while loading.
DERIVED_FIELDS = check_specs([
    _text(None, "file", "source file", "!"),
    FieldSpec("dq", "int", -1, low=0, high=999, comment="months delinquent"),
    _text(None, "vintage", "vintage (from fpDt)", "XXXXQX", width=6),
    FieldSpec(
        "propVal", "float", -1.0, low=1000.0, high=5000000.0,
        comment="property value at origination",
    ),
    _text(None, "standard", "standard u/w process loan: Y, N", "X", width=1),
    _text(None, "qa", "validation results for each field: ", "!"),
])

# Computed by the rollup.
ROLLUP_FIELDS = check_specs([
    FieldSpec("ageFpDt", "long", -1000, comment="age based on fdDt, missing=-1000"),
    _text(None, "harp", "loan is HARP: Y, N", "N", width=1),
    FieldSpec("bucket", "int", 0, comment="loan bucket"),
    _text(None, "harpLnId", "loan refinanced to this HARP loan", ""),
    _text(None, "preHarpId", "HARP loan refinanced from this loan", ""),
    _text(None, "field", "field name", ""),
    FieldSpec("cntFail", "int", 0, comment="# of months field failed qa"),
    _text(None, "allFail", "fields that failed QA all months", ""),
    FieldSpec("nMonths", "long", 0, comment="number of months"),
])

MONTHLY_FIELDS = check_specs([*TAPE_FIELDS, *EXTENDED_FIELDS, *DERIVED_FIELDS])
# Fields that can fail, in the order of their bits.
QA_ORDER = [spec.name for spec in MONTHLY_FIELDS if spec.name != "qa"]
FIELDS = {spec.name: spec for spec in [*MONTHLY_FIELDS, *ROLLUP_FIELDS]}


def column_names(width: int) -> list[str]:
    """Names of all columns of a tape by position; columns the model drops are ``unused<pos>``."""
    named = {f.position: f.name for f in [*TAPE_FIELDS, *EXTENDED_FIELDS]}
    return [named.get(pos, f"unused{pos}") for pos in range(width)]


def fields(
    names: Iterable[str] | None = None,
    msa_codes: Iterable[str] | None = None,
    zip3_codes: Iterable[str] | None = None,
) -> list[FieldSpec]:
    """Tape fields, optionally some of them only and with short lists of legal codes for areas and
    postal prefixes; lists of any length go to ``monthly_table`` as a table of codes."""
    specs = [*TAPE_FIELDS, *EXTENDED_FIELDS]
    if msa_codes is not None:
        legal = sorted({*msa_codes, *ALWAYS_LEGAL["msa"]})
        specs = [f.with_levels(legal) if f.name == "msa" else f for f in specs]
    if zip3_codes is not None:
        legal = sorted(set(zip3_codes))
        specs = [f.with_levels(legal) if f.name == "zip3" else f for f in specs]
    if names is not None:
        wanted = set(names)
        unknown = wanted - {f.name for f in specs}
        if unknown:
            raise ValueError(f"unknown fields: {sorted(unknown)}")
        specs = [f for f in specs if f.name in wanted]
    return specs
