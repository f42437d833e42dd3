"""A loan panel of raw texts made from the driver's tables; the SQL runs on Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "customer", "part")

_FIELDS = """
 lpad(cast(l.l_orderkey as string),12,'0') as lnId,
 concat(lpad(cast(month(l.l_shipdate) as string),2,'0'),cast(year(l.l_shipdate) as string)) as month,
 case l.l_returnflag when 'R' then 'R' when 'N' then 'B' else 'Z' end as channel,
 case when l.l_suppkey % 7 = 0 then '' else concat('Seller ',cast(l.l_suppkey as string)) end as seller,
 c.c_mktsegment as servicer,
 cast(round(l.l_discount*100) as string) as rate,
 concat(cast(cast(round(l.l_tax*250) as int) as string),'.25') as curRate,
 cast(cast(floor(o.o_totalprice) as int) as string) as opb,
 concat(cast(cast(floor(l.l_extendedprice) as int) as string),'.',
  lpad(cast(cast(round(l.l_extendedprice*100) as bigint) % 100 as string),2,'0')) as upb,
 concat(lpad(cast(month(o.o_orderdate) as string),2,'0'),cast(year(o.o_orderdate) as string)) as fpDt,
 case when l.l_linenumber = 5 then '' else cast(p.p_size * 2 as string) end as ltv,
 case when l.l_linenumber % 2 = 0 then '' else cast(280 + l.l_partkey % 600 as string) end as coFico,
 cast(280 + l.l_partkey % 600 as string) as fico,
 cast(cast(l.l_quantity as int) + 20 as string) as dti,
 case when l.l_quantity < 10 then '' else cast(cast(l.l_quantity as int) as string) end as mi,
 case l.l_orderkey % 5 when 0 then '31100' when 1 then '31080' when 2 then '' when 3 then '99999' else '10180' end as msa,
 case when l.l_linenumber = 7 then 'XX' else lpad(cast(l.l_linenumber - 1 as string),2,'0') end as dqStat,
 case l.l_linestatus when 'F' then 'Y' else 'N' end as pPen,
 case when l.l_linestatus = 'F' and l.l_linenumber = 1 then 'Y' when l.l_linenumber = 3 then '' else 'N' end as reprchMw,
 case l.l_linenumber % 4 when 0 then 'P' when 1 then '7' when 2 then '' else '9' end as altRes,
 cast(cast(floor(l.l_extendedprice/100) as int) - 300 as string) as fclProNet,
 case l.l_orderkey % 3 when 0 then '1999Q1.csv' when 1 then '2000Q1_HARP.csv' else 'exclusions.csv' end as file
"""

_FROM = """
from lineitem l join orders o on o.o_orderkey=l.l_orderkey
 join customer c on c.c_custkey=o.o_custkey join part p on p.p_partkey=l.l_partkey
"""

# A total order of the rows, except for rows alike in everything: rides in payHist, which is free text.
_ROW_KEY = """
 concat(cast(l.l_linenumber as string),'-',cast(l.l_partkey as string),'-',cast(l.l_suppkey as string),
  '-',cast(cast(round(l.l_extendedprice*100) as bigint) as string),
  '-',cast(cast(l.l_quantity as int) as string),'-',cast(cast(round(l.l_discount*100) as int) as string),
  '-',cast(cast(round(l.l_tax*100) as int) as string),'-',l.l_returnflag,l.l_linestatus) as payHist
"""

# The other fields of the tape, each with good, empty and bad texts among its values.
_MORE = """
 case l.l_partkey % 6 when 0 then '' when 1 then '800' when 2 then 'abc' else cast(l.l_partkey % 360 as string) end as term,
 concat('0',cast(1 + l.l_suppkey % 10 as string),cast(1997 + l.l_partkey % 6 as string)) as origDt,
 cast(l.l_partkey % 700 - 20 as string) as age,
 case when l.l_linenumber = 2 then '' else cast(l.l_suppkey % 650 as string) end as rTermLgl,
 cast(l.l_partkey % 650 as string) as rTermAct,
 concat('12',cast(2020 + l.l_partkey % 50 as string)) as matDt,
 case l.l_suppkey % 4 when 0 then '' when 1 then '-1' else cast(l.l_partkey % 1100 as string) end as cltv,
 cast(l.l_suppkey % 12 as string) as numBorr,
 case l.l_suppkey % 3 when 0 then 'Y' when 1 then 'N' else 'U' end as firstTime,
 substr('PCURX', 1 + cast(l.l_partkey % 5 as int), 1) as purpose,
 substr('SFCOCPMHPUZZ', 1 + 2 * cast(l.l_partkey % 6 as int), 2) as propType,
 cast(l.l_partkey % 6 as string) as units,
 substr('PSIQ', 1 + cast(l.l_suppkey % 4 as int), 1) as occ,
 substr('CATXNYZZFLGU', 1 + 2 * cast(l.l_suppkey % 6 as int), 2) as state,
 lpad(cast(l.l_partkey % 1000 as string),3,'0') as zip3,
 case l.l_suppkey % 5 when 0 then 'ARM' when 1 then '' else 'FRM' end as amType,
 case l.l_partkey % 4 when 0 then 'Y' when 1 then '' when 2 then 'N' else '?' end as io,
 case when l.l_partkey % 4 = 0 then concat('0',cast(1 + l.l_suppkey % 9 as string),'2010') when l.l_partkey % 4 = 1 then '011970' else '' end as ioDt,
 case l.l_partkey % 4 when 0 then cast(l.l_suppkey % 800 as string) when 1 then '-1' else '' end as ioRem,
 substr('YPNYPN', l.l_linenumber, 1) as mod,
 case l.l_linenumber when 1 then '' when 2 then '01' when 3 then '09' when 4 then '00' else '97' end as zb,
 case when l.l_linenumber > 4 then concat('0',cast(l.l_linenumber as string),'2005') else '' end as zbDt,
 case when l.l_linenumber > 3 then cast(cast(floor(l.l_extendedprice) as int) as string) else '' end as zbUpb,
 case l.l_linenumber % 3 when 0 then '' when 1 then case l.l_partkey % 5 when 0 then '1d' when 1 then 'NaN' when 2 then '2.5f' when 3 then '1e3' else 'n/a' end else cast(cast(floor(l.l_extendedprice) as int) - 20000 as string) end as totPrin,
 case when l.l_linenumber = 6 then '072004' when l.l_linenumber = 2 then '132004' else '' end as lpDt,
 case when l.l_linenumber = 4 then '031998' else '' end as fclDt,
 case when l.l_linenumber = 3 then '112006' else '' end as dispDt,
 case when l.l_linenumber = 3 then cast(cast(floor(l.l_extendedprice) as int) * 5 as string) else '' end as fclExp,
 case when l.l_linenumber < 4 then cast(-1 * cast(l.l_quantity as int) as string) else '' end as fclPExp,
 cast(-1 * cast(l.l_quantity as int) as string) as fclLExp,
 case when l.l_linenumber = 1 then 'x' else '-25.5' end as fclMExp,
 case when l.l_linenumber = 2 then '1250.75' else '' end as fclTaxes,
 case when l.l_linenumber = 4 then '-3000000' else '' end as fclProMi,
 cast(cast(l.l_quantity as int) - 25 as string) as fclProMw,
 '' as fclProOth,
 case when l.l_linenumber = 2 then cast(cast(l.l_quantity as int) * 100 as string) else '' end as nonIntUpb,
 case when l.l_linenumber = 5 then '250000' when l.l_linenumber = 6 then '1500' else '' end as frgvUpb,
 case l.l_suppkey % 6 when 0 then '1' when 1 then '2' when 2 then '' when 3 then '0' when 4 then '3' else '4' end as miType,
 case l.l_linenumber when 1 then 'Y' when 2 then '' else 'N' end as servAct,
 substr('FHRO79X', l.l_linenumber, 1) as program,
 case when l.l_linenumber % 2 = 0 then cast(cast(l.l_quantity as int) * 10 - 200 as string) else '' end as fclWriteOff,
 case l.l_suppkey % 3 when 0 then 'Y' else '' end as relo,
 substr('APRWOX', 1 + cast(l.l_partkey % 6 as int), 1) as valMthd,
 case when l.l_partkey % 2 = 0 then 'N' else '' end as sConform,
 substr('FRTON79', l.l_linenumber, 1) as bap,
 case when l.l_partkey % 3 = 0 then 'Y' else 'N' end as hltv,
 case when l.l_linenumber % 3 = 0 then cast(l.l_linenumber as string) when l.l_linenumber % 3 = 1 then '0' else '-5' end as altResCnt,
 case when l.l_linenumber = 2 then cast(cast(l.l_quantity as int) * 50 as string) when l.l_linenumber = 3 then 'none' else '' end as totDefrl,
 case when l.l_linenumber = 1 then 'Y' when l.l_linenumber = 2 then '' else 'N' end as nsDoc,
 case when l.l_suppkey % 2 = 0 then 'Y' else 'Q' end as nsUw,
 case when l.l_partkey % 9 = 0 then 'Y' else 'N' end as gGuar,
 '' as negAm
"""

PANEL_SQL = f"select {_FIELDS} {_FROM}"
WIDE_SQL = f"select {_FIELDS}, {_ROW_KEY}, {_MORE} {_FROM}"

ID_MAP_SQL = """
select lpad(cast(o_orderkey as string),12,'0') as oldLnId, lpad(cast(o_orderkey+1 as string),12,'0') as harpLnId
from orders where o_orderkey % 10 = 0
union all
select lpad(cast(o_orderkey as string),12,'0'), lpad(cast(o_orderkey+2 as string),12,'0')
from orders where o_orderkey % 50 = 0
"""


# Legal codes, in place of the rules for areas and postal prefixes: some codes of the right form that
# loans hold are absent, and one of another form is legal.
CODES_SQL = """
select 'msa' as field,
 case o_orderkey % 5 when 0 then '44444' when 1 then '31080' when 3 then '99999' else '20202' end as code
from orders
union all
select 'zip3', lpad(cast(p_partkey % 1000 as string),3,'0') from part where p_partkey % 1000 % 7 <> 3
"""


# The same joins, for Spark, which takes them as written: orders meet customers and lines meet parts first, so
# the long rows are shuffled twice instead of three times.
_GROUPED = """
from (lineitem l join part p on p.p_partkey=l.l_partkey)
 join (orders o join customer c on c.c_custkey=o.o_custkey) on o.o_orderkey=l.l_orderkey
"""


# Beside the other columns: added to them by a further projection, it would copy their texts once more.
_STANDARD = """
 case when case l.l_orderkey % 3 when 0 then '1999Q1.csv' when 1 then '2000Q1_HARP.csv' else 'exclusions.csv' end
  = 'exclusions.csv' then 'N' else 'Y' end as standard
"""


def register(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def raw_panel(spark: SparkSession, sf_dir: str, standard: bool = False) -> DataFrame:
    """All tape fields as text, with the file name; 'exclusions.csv' holds non-standard loans. ``standard`` adds
    that as a flag."""
    register(spark, sf_dir)
    more = f"{_MORE}, {_STANDARD}" if standard else _MORE
    return spark.sql(f"select {_FIELDS}, {_ROW_KEY}, {more} {_GROUPED}")


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(CODES_SQL)


def id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(ID_MAP_SQL)
