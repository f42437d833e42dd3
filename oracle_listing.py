"""Expected listing of the loan table: name, type, description of each column, in order.

Fixed values: the descriptions are part of the data model.
"""

LISTING = [
    ("lnId", "string", "Loan ID, missing=error"),
    ("monthly.month", "array<date>", "month of data, missing=1970/1/1"),
    ("monthly.upb", "array<float>", "unpaid balance, missing=-1"),
    ("monthly.dq", "array<int>", "months delinquent"),
    ("monthly.servicer", "array<string>", "name of servicer, missing=unknown"),
    ("monthly.curRate", "array<float>", "current note rate, missing=-1"),
    ("monthly.age", "array<int>", "loan age based on origination date, missing=-1"),
    ("monthly.ageFpDt", "array<bigint>", "age based on fdDt, missing=-1000"),
    ("monthly.rTermLgl", "array<int>", "remaining legal term, missing=-1"),
    ("monthly.rTermAct", "array<int>", "remaining actual term, missing=-1"),
    ("monthly.dqStat", "array<string>", "DQ status code: 0-99 months, missing=!"),
    ("monthly.mod", "array<string>", "modification flag: Y, N , missing=X"),
    ("monthly.zb", "array<string>", "zero balance:00(noop), 01(pp), 03(short), 06(repurch), 09(REO), 96/97/98(removal), 02/15/16(sale), missing=X"),
    ("monthly.ioRem", "array<int>", "number of IO months remaining, missing=-1"),
    ("monthly.bap", "array<string>", "borrower assistant plan: F(forebearance), R(repayment), T(trial), O(Other), N(none), 7,9(NA) missing=X"),
    ("monthly.program", "array<string>", "special eligibility program: F,H,R,O,7,9, missing=X"),
    ("monthly.nonIntUpb", "array<float>", "interest bearing UPB, missing=-1"),
    ("monthly.frgvUpb", "array<float>", "forgiven UPB, missing=-1"),
    ("monthly.totPrin", "array<float>", "delta upb"),
    ("monthly.servAct", "array<string>", "servicing activity: Y, N, missing=X"),
    ("monthly.matDt", "array<date>", "loan maturity date (initial), missing=1970/1/1"),
    ("channel", "string", "acquisition channel: B, R, C, missing=X"),
    ("seller", "string", "name of seller, missing=unknown"),
    ("dti", "float", "dti at origination, 1-65, missing=-1"),
    ("rate", "float", "note rate at origination, 0-15, missing=-1"),
    ("opb", "float", "balance at origination, missing=-1"),
    ("term", "float", "loan term at origination, missing=-1"),
    ("origDt", "date", "origination date, missing=1970/1/1"),
    ("fpDt", "date", "first payment date, missing=1970/1/1"),
    ("ltv", "float", "ltv at origination, 1-998, missing=-1"),
    ("cltv", "float", "combined cltv at origination, 1-998, missing=-1"),
    ("numBorr", "int", "number of borrowers, 1-10, missing=-1"),
    ("fico", "int", "fico at origination, 301-850, missing=-1"),
    ("coFico", "int", "coborrower fico at origination, 301-850, missing=-1"),
    ("firstTime", "string", "first time homebuyer: Y, N, missing=X"),
    ("purpose", "string", "loan purpose: P (purch), C (cash out refi), U (rate/term refi) R (refi), missing=X"),
    ("propType", "string", "property type: SF (single family), CO (condo), PU (PUD), CP (coop), MH (manufactured), missing=XX"),
    ("units", "float", "# of units in the property, 1-4, missing=-1"),
    ("occ", "string", "property occupancy: P (primary), S (secondary), I (investor) missing=X"),
    ("state", "string", "property state postal abbreviation, missing=XX"),
    ("msa", "string", "msa/division code, missing/not in MSA=XXXXX"),
    ("zip3", "string", "3-digit zip , missing=XXX"),
    ("mi", "float", "mi percentage, 0-55, missing=-1"),
    ("amType", "string", "amortization type: FRM, ARM, missing=XXX"),
    ("pPen", "string", "prepay penalty flag: Y, N, missing=X"),
    ("io", "string", "io Flag: Y, N, missing=X"),
    ("ioDt", "date", "month IO loan starts amortizing, missing=1970/1/1"),
    ("zbDt", "date", "zero balance date, missing=1970/1/1"),
    ("zbUpb", "float", "UPB just prior to zero balance, missing=-1"),
    ("lpDt", "date", "last pay date, missing=1970/1/1"),
    ("fclDt", "date", "foreclosure date, missing=1970/1/1"),
    ("dispDt", "date", "date the agency is done with loan, missing=1970/1/1"),
    ("fclExp", "float", "total foreclosure expenses"),
    ("fclPExp", "float", "foreclosure property preservation expenses"),
    ("fclLExp", "float", "foreclosure recovery legal expenses"),
    ("fclMExp", "float", "foreclosure misc expenses, missing=-1"),
    ("fclTaxes", "float", "foreclosure property taxes and insurance"),
    ("fclProNet", "float", "foreclosure net proceeds"),
    ("fclProMi", "float", "foreclosure credit enhancement proceeds"),
    ("fclProMw", "float", "foreclosure make whole proceeds"),
    ("fclProOth", "float", "foreclosure other proceeds"),
    ("fclWriteOff", "float", "foreclosure principal writeoff, missing=-1"),
    ("miType", "string", "mi type: 1=borrower, 2=lender, 3=enterprise, 0=No MI, missing=X"),
    ("relo", "string", "relocation mortgage: Y, N, missing=X"),
    ("valMthd", "string", "property value method A(apprsl), P(onsite), R(GSE target), W(waived), O(other), missing=X"),
    ("sConform", "string", "super conforming flag: Y, N, missing=X"),
    ("hltv", "string", "high LTV refi missing=X"),
    ("reprchMw", "string", "repurchase make whole: Y, N missing=X"),
    ("altRes", "string", "DQ payment deferral: P(payment), C(Covid), D(disaster), 7/9 :NA missing=X"),
    ("altResCnt", "int", "# of alternate resolutions (deferrals), missing=-1"),
    ("totDefrl", "float", "total amount deferred, missing=-1"),
    ("file", "string", "source file"),
    ("vintage", "string", "vintage (from fpDt)"),
    ("propVal", "float", "property value at origination"),
    ("harp", "string", "loan is HARP: Y, N"),
    ("standard", "string", "standard u/w process loan: Y, N"),
    ("nsDoc", "string", "non-standard documentation: Y, N, missing=X"),
    ("nsUw", "string", "non-standard underwriting: Y, N, missing=X"),
    ("gGuar", "string", "government issued/guaranteed: Y, N, missing=X"),
    ("negAm", "string", "loan can neg am: Y, N, missing=X"),
    ("bucket", "int", "loan bucket"),
    ("harpLnId", "string", "loan refinanced to this HARP loan"),
    ("preHarpId", "string", "HARP loan refinanced from this loan"),
    ("qa.field", "array<string>", "field name"),
    ("qa.cntFail", "array<int>", "# of months field failed qa"),
    ("allFail", "array<string>", "fields that failed QA all months"),
    ("nMonths", "bigint", "number of months"),
]
