"""

``entry(spark)`` runs the flagship query (KPI 2: latest listing per key ->
mean price per zone -> name reconciliation -> zone income) on sf0.001.
``queries()`` maps every implemented query to a callable (spark, sf_dir);
``oracle_sql()`` gives the equivalent DuckDB SQL for each of them (the
specification of SURVEY §7.4).  Column names match on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# importable however this file is loaded (by path, from another directory)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from zonekit.plans import roles  # noqa: E402

try:
    import corpus_pipeline
    from zonekit.llm.oracle import ORACLE_SQL as _LLM_ORACLE
    from zonekit.llm.queries import QUERIES as _LLM_QUERIES

    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
    _LLM_ORACLE = {**_LLM_ORACLE, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
except ModuleNotFoundError as missing:
    # the training-data operators are optional: without them the rest still works
    if not (missing.name or "").startswith(("corpus_pipeline", "zonekit.llm")):
        raise
    _LLM_QUERIES, _LLM_ORACLE = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return roles.kpi_price_income(spark, SMOKE_DIR)


def _importable(query: Callable) -> Callable:
    """``query`` with this folder on the import path of the Python workers too."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if _HERE not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_HERE, *paths]))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _importable(query) for name, query in {**roles.QUERIES, **_LLM_QUERIES}.items()}


# Listings with zone and district (the "Z" relation of the specification).
_Z = (
    "select o.*, n.n_name zone, r.r_name district from orders o "
    "join customer c on o.o_custkey=c.c_custkey join nation n on c.c_nationkey=n.n_nationkey "
    "join region r on n.n_regionkey=r.r_regionkey"
)

# Nations that the lookups hold: those with at least the mean number of suppliers.
_BUSY = (
    "(select s_nationkey from supplier group by 1 having count(*) >= "
    "(select count(*) * 1.0 / count(distinct s_nationkey) from supplier))"
)

# KPI1 on the deduplicated listings (latest per key), our addition to §7.4.
_LATEST = (
    "select * from (select *, row_number() over (partition by o_custkey "
    "order by o_orderdate desc, o_orderkey desc) rn from orders) where rn=1"
)

# KPI2 and KPI3 on the listing model, with the value columns left open.
_KPI2 = (
        "with latest as (select o_custkey, o_totalprice from (select *, row_number() over (partition by o_custkey "
        "order by cast(o_orderdate as date) desc, o_totalprice desc, o_orderkey desc) rn from orders) where rn=1), "
        "p as (select n_name nb, (sum(cast(o_totalprice as decimal(18,2)))::double / count(o_totalprice)) mean_price from latest join customer on o_custkey=c_custkey "
        "join nation on c_nationkey=n_nationkey group by 1), "
        "rent as (select n_name ne, lower(n_name) ne_re from nation where n_nationkey in BUSY_NATIONS), "
        "y as (select n_name, year(o_orderdate) yr, max(o_totalprice) v from orders join customer on o_custkey=c_custkey "
        "join nation on c_nationkey=n_nationkey group by 1, 2), "
        "inc as (select n_name, arg_max(v, yr) rfd from y group by 1), "
        "inc_lk as (select n_name, lower(n_name) re from nation where n_nationkey in BUSY_NATIONS) "
        "select r.ne_re neighborhood, {price} mean_price, {rfd} rfd "
        "from p join rent r on p.nb = r.ne "
        "join (select il.re, inc.rfd from inc join inc_lk il using (n_name)) i on i.re = r.ne_re"
    )

_KPI3 = (
        "with occ as (select n_name, (sum(cast(s_acctbal as decimal(18,2)))::double / count(s_acctbal)) o from supplier join nation on s_nationkey=n_nationkey group by 1), "
        "y as (select n_name, year(o_orderdate) yr, max(o_totalprice) v from orders join customer on o_custkey=c_custkey "
        "join nation on c_nationkey=n_nationkey group by 1, 2), "
        "inc as (select n_name, arg_max(v, yr) rfd from y group by 1), "
        "inc_lk as (select n_name, lower(n_name) re from nation where n_nationkey in BUSY_NATIONS) "
        "select il.re neighborhood, {occ} inhabitants_family, {rfd} rfd "
        "from occ join inc_lk il using (n_name) "
        "join (select il2.re, inc.rfd from inc join inc_lk il2 using (n_name)) i on i.re = il.re"
    )

# Mean price of the latest listings over the income of the zone and year.
_KPI2B = (
    f"with z as ({_Z}), "
    "latest as (select district, zone, o_totalprice from (select *, row_number() over (partition by o_custkey "
    "order by cast(o_orderdate as date) desc, o_totalprice desc, o_orderkey desc) rn from z) where rn=1), "
    "s as (select district, zone, (sum(cast(o_totalprice as decimal(18,2)))::double / count(o_totalprice)) m from latest group by all), "
    "i as (select zone, year(o_orderdate) yr, max(o_totalprice) v from z where year(o_orderdate) between 1996 and 1998 group by all) "
    "select yr as year, replace(district,'-',' ') district, replace(zone,'-',' ') neighborhood, round(m / v, 6) ratio "
    "from s join i using (zone) join nation on n_name=zone where n_nationkey in BUSY_NATIONS"
)

# The numeric columns of lineitem.
_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]

ORACLE_SQL: dict[str, str] = {
    'snapshot_union': "select event_id, event_type, value from events where event_type='purchase' union all select event_id, event_type, null from events where event_type is distinct from 'purchase'",
    'required_filter': "select event_id, user_id from events where event_type='purchase' and json_extract_string(props,'$.k') is not null and user_id is not null",
    'snapshot_date': "select o_orderkey, cast(strptime(regexp_extract(strftime(o_orderdate,'%Y_%m_%d')||'_orders.json','^(\\d{4}_\\d{2}_\\d{2})',1),'%Y_%m_%d') as date) snap_date from orders",
    'numeric_cast': 'select o_orderkey, try_cast(cast(o_totalprice as varchar) as double) price, try_cast(o_orderpriority as int) bad from orders',
    'latest_by_key': 'select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn from orders) where rn=1',
    'upsert_by_key': 'select o_custkey, yr, o_totalprice from (select o_custkey, year(o_orderdate) yr, o_totalprice, row_number() over (partition by o_custkey, year(o_orderdate) order by o_orderkey desc) rn from orders) where rn=1',
    'lookup_link': 'with a as (select r_name d, n_name z, n_regionkey di, n_nationkey zi from nation join region on n_regionkey=r_regionkey), b as (select lower(d) d, lower(z) z, di, zi from a where zi in BUSY_NATIONS) select a.d, a.z, b.d d2, b.z z2 from a join b using (di, zi)',
    'lookup_missing': 'with a as (select n_name z, n_regionkey di, n_nationkey zi from nation), b as (select di, zi from a where zi in BUSY_NATIONS) select a.z from a anti join b using (di, zi)',
    'composite_key': "select distinct replace(d,'-',' ')||'-'||replace(z,'-',' ')||'-'||yr k from (select district d, zone z, year(o_orderdate) yr from ({Z}))".format(Z=_Z),
    'count_by': 'select r_name, count(*) n from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey group by r_name',
    'daily_counts': 'select cast(ts as date) d, count(*) n from events group by 1 order by 1',
    'avg_per_sampled_day': 'select round(avg(n),4) a from (select cast(o_orderdate as date) d, count(*) n from orders group by 1)',
    'avg_per_calendar_day': "select round(count(*)/nullif(date_diff('day',min(cast(o_orderdate as date)),max(cast(o_orderdate as date))),0),4) a from orders",
    'peak_day': 'select cast(ts as date) d, count(*) n from events group by 1 order by n desc, d limit 1',
    'log_daily': 'select cast(ts as date) d, round(ln(count(*)),6) l from events group by 1',
    'mean_by': 'select zone, round(sum(cast(o_totalprice as decimal(18,2)))::double / count(*),4) m from ({Z}) group by zone'.format(Z=_Z),
    'latest_from_array': 'select zone, round(arg_max(v, yr),4) v from (select zone, year(o_orderdate) yr, (sum(cast(o_totalprice as decimal(18,2)))::double / count(o_totalprice)) v from ({Z}) group by all) group by zone'.format(Z=_Z),
    'reconcile': 'with l as (select n_name, lower(n_name) re from nation where n_nationkey in BUSY_NATIONS), m as (select n_name, (sum(cast(c_acctbal as decimal(18,2)))::double / count(c_acctbal)) m from customer join nation on c_nationkey=n_nationkey group by n_name) select re, round(m,4) m from m join l using (n_name)',
    'zone_ratio_by_year': 'select zone, yr, round((sum(cast(p as decimal(18,2)))::double / count(p))/any_value(b),6) ratio from (select z.zone, z.o_totalprice p, i.yr, i.b from ({Z}) z join (select n_name, yr, (sum(cast(o_totalprice as decimal(18,2)))::double / count(o_totalprice)) b from (select o.o_totalprice, year(o_orderdate) yr, n_name from orders o join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey) where yr between 1996 and 1998 group by all) i on z.zone=i.n_name) group by all'.format(Z=_Z),
    'kpi_price_income': 'with p as (select zone, (sum(cast(o_totalprice as decimal(18,2)))::double / count(o_totalprice)) mean_price from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn from ({Z})) where rn=1 group by zone), i as (select n_name zone, (sum(cast(c_acctbal as decimal(18,2)))::double / count(c_acctbal)) inc from customer join nation on c_nationkey=n_nationkey group by 1), l as (select n_name zone, lower(n_name) re from nation where n_nationkey in BUSY_NATIONS) select re zone, round(mean_price,4) mean_price, round(inc,4) income from p join l using (zone) join i using (zone)'.format(Z=_Z),
    'kpi_occupancy_income': 'with s as (select n_name zone, (sum(cast(s_acctbal as decimal(18,2)))::double / count(s_acctbal)) occ from supplier join nation on s_nationkey=n_nationkey group by 1), i as (select n_name zone, (sum(cast(c_acctbal as decimal(18,2)))::double / count(c_acctbal)) inc from customer join nation on c_nationkey=n_nationkey group by 1) select lower(zone) zone, round(occ,4) occ, round(inc,4) income from s join i using (zone)',
    'corr_pair': 'select round(corr(l_quantity, l_extendedprice),6) r from lineitem',
    'corr_matrix': "select 'l_quantity' a, 'l_extendedprice' b, round(corr(l_quantity,l_extendedprice),6) r from lineitem union all select 'l_quantity','l_discount', round(corr(l_quantity,l_discount),6) from lineitem union all select 'l_extendedprice','l_discount', round(corr(l_extendedprice,l_discount),6) from lineitem",
    "audited_lookup": "select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey where n_nationkey in BUSY_NATIONS",
    "corr_matrix_lineitem": " union all ".join(
        f"select '{a}' a, '{b}' b, round(corr({a}, {b}), 6) r from lineitem" for i, a in enumerate(_LINEITEM) for b in _LINEITEM[i + 1 :]
    ),
    'map_unwind_avg': "select event_type, user_id, round(avg(cast(json_extract_string(props,'$.'||k) as double)),4) v from (select *, unnest(json_keys(props)) k from events) group by all",
    'avg_nested': "select event_type, round(avg(cast(json_extract_string(props,'$.k') as double)),4) v from events group by all",
    'get_rows': 'select c_custkey, c_name from customer where c_custkey in (1, 7, 999999)',
    'prefix_scan': "select c_custkey, c_name from customer where starts_with(c_name,'Customer#0000000')",
    'delete_keys': 'select n_nationkey, n_name from nation where n_nationkey not in (1, 7)',
    'zone_equals': "select c_custkey from customer where c_mktsegment='MACHINERY'",
    'table_counts': "select 'orders' t, count(*) n from orders union all select 'customer', count(*) from customer union all select 'events', count(*) from events",
    'head_rows': 'select c_custkey, c_name from customer order by c_custkey limit 5',
    'family_table': "select o_orderkey as key, o_orderpriority, cast(floor(o_totalprice)*100 as varchar) price, strftime(o_orderdate,'%Y-%m-%d') d from orders",
    'measure_table': "select r_name||'-'||n_name||'-'||n_nationkey as key, r_name district, n_name zone, n_nationkey, cast(n_nationkey*2 as varchar) measure from nation join region on n_regionkey=r_regionkey",
    'lookup_table': "select r_name||'-'||n_name as key, lower(r_name) district, lower(n_name) neighborhood from nation join region on n_regionkey=r_regionkey where n_nationkey in BUSY_NATIONS",
    'split_key': "select n_nationkey, replace(r_name,'-',' ') p1, replace(n_name,'-',' ') p2, cast(n_nationkey as varchar) p3, cast(null as varchar) p4 from nation join region on n_regionkey=r_regionkey",
    'parse_date': 'select o_orderkey, cast(o_orderdate as date) as day from orders',
    'constant_column': "select c_custkey, date '2020-01-02' snapshot from customer",
    'snapshot_drift': "select event_id, user_id from events where event_type='purchase' and user_id is not null",
    'ratio_by': 'select n_name, round((sum(cast(c_acctbal as decimal(18,2)))::double / count(c_acctbal)) / any_value(n_regionkey + 1), 4) ratio from customer join nation on c_nationkey=n_nationkey group by n_name',
    'delete_keys_with_null': "select c_custkey, nullif(c_mktsegment, 'BUILDING') seg from customer where nullif(c_mktsegment, 'BUILDING') is distinct from 'MACHINERY'",
    "lookup_link_customers": (
        "with a as (select c_name z, c_nationkey di, c_custkey zi from customer), "
        "b as (select lower(z) z, di, zi from a where zi in (select o_custkey from orders)) select a.z, b.z z2 from a join b using (di, zi)"
    ),
    "lookup_missing_customers": (
        "with a as (select c_name z, c_nationkey di, c_custkey zi from customer), "
        "b as (select di, zi from a where zi in (select o_custkey from orders)) select a.z from a anti join b using (di, zi)"
    ),
    "get_rows_by_table": (
        "select c_custkey, c_name from customer semi join "
        "(select o_custkey from orders where o_orderpriority='1-URGENT') k on c_custkey = k.o_custkey"
    ),
    "delete_keys_by_table": (
        "select c_custkey, c_name from customer anti join "
        "(select o_custkey from orders where o_orderpriority='1-URGENT') k on c_custkey = k.o_custkey"
    ),
    "kpi2_listing_model": _KPI2.format(price="round(p.mean_price, 4)", rfd="round(i.rfd, 4)"),
    "kpi2_correlation": "select round(corr(mean_price, rfd), 6) r from (" + _KPI2.format(price="p.mean_price", rfd="i.rfd") + ")",
    "kpi3_listing_model": _KPI3.format(occ="round(occ.o, 4)", rfd="round(i.rfd, 4)"),
    "kpi3_correlation": "select round(corr(inhabitants_family, rfd), 6) r from (" + _KPI3.format(occ="occ.o", rfd="i.rfd") + ")",
    "kpi2b_listing_model": _KPI2B,
    "kpi1_daily": f"select cast(o_orderdate as date) date, count(*) listings_count from ({_LATEST}) group by 1 order by 1",
    "kpi1_summary": (
        f"with l as ({_LATEST}), c as (select cast(o_orderdate as date) date, count(*) n from l group by 1) "
        "select round(avg(n),4) avg_per_sampled_day, "
        "round(sum(n)/nullif(date_diff('day', min(date), max(date)),0),4) avg_per_calendar_day from c"
    ),
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each key of ``queries()`` (tables pre-registered as views)."""
    return {k: v.replace("BUSY_NATIONS", _BUSY) for k, v in ORACLE_SQL.items() if k in roles.QUERIES} | _LLM_ORACLE
