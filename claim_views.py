"""Claim-event tables and dimensions as views over the given tables.

Every query below is valid in Spark SQL and in DuckDB, so the engine and its
oracle see the same rows.  The views keep every row of the event tables; the
``case`` expressions and the filters of the dimensions plant the violations
(NULL keys, entities without demographics, missing providers, deaths) that the
checks are there to find.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refreshguard import MEDICAL, PHARMACY, Context, TableProfile
from refreshguard.context import OWN
from refreshguard.functions import months
from refreshguard.sources.shared import stored

MONTH = "1998-03"
PREVIOUS = "1998-02"
FIRST_MONTH = "1995-01"
LAST_MONTH = "2001-08"
AS_OF = date(2001, 6, 30)
AGE_AS_OF = date(2002, 1, 1)
OLD_YEAR = 1996

_NDC = """case when l_partkey % 3 = 0 then null
    when l_partkey % 3 = 1 then concat('00000-', lpad(cast(l_partkey % 60 as string), 4, '0'), '-00')
    else lpad(cast(l_partkey % 60 as string), 10, '0') end"""
_UNITS = "case when l_quantity = 50 then 10000.0D when l_quantity = 1 then 0.0D else l_quantity end"
_RENDERING = """case when l_discount = 0.0 then null
    else lpad(cast(l_suppkey + 20 as string), 10, '0') end"""

MX_EVENTS = f"""
select l_orderkey * 10 + l_linenumber as medical_event_id,
  case when l_orderkey % 997 = 0 then null else o_custkey end as patient_id,
  cast(o_orderdate as date) as kh_refresh_date,
  cast(l_shipdate as date) as service_date,
  case when l_linenumber = 7 then null else cast(o_orderdate as date) end as service_to_date,
  case when l_partkey % 50 = 0 then null
    else concat('P', cast(l_partkey % 50 as string)) end as procedure_code,
  case l_returnflag when 'A' then 'cpt' when 'N' then 'HCPCS'
    else case when l_tax = 0.08 then 'LOCAL' else null end end as procedure_code_type,
  case when l_suppkey % 10 = 9 then concat('X', lpad(cast(l_suppkey as string), 9, '0'))
    else lpad(cast(l_suppkey as string), 10, '0') end as billing_npi,
  {_RENDERING} as rendering_npi,
  case when l_linenumber > 4 then lpad(cast(l_partkey as string), 9, '0') else null end
    as referring_npi,
  {_UNITS} as units,
  case l_linestatus when 'F' then 'un' else 'Other' end as unit_type,
  {_NDC} as ndc11,
  concat('C', cast(o_custkey % 90 as string)) as cohort_id,
  o_orderpriority as mx_cohort,
  cast(o_custkey % 25 as int) as kh_plan_id
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey"""

RX_EVENTS = f"""
select l_orderkey * 10 + l_linenumber as pharmacy_event_id,
  o_custkey as patient_id,
  cast(o_orderdate as date) as kh_refresh_date,
  cast(l_shipdate as date) as fill_date,
  case when l_tax = 0.0 then null else cast(o_orderdate as date) end as date_prescription_written,
  p_type as diagnosis_code, p_brand as brand_name, p_name as generic_name,
  {_NDC} as ndc11,
  lpad(cast(l_suppkey as string), 10, '0') as pharmacy_npi,
  {_RENDERING} as prescriber_npi,
  {_UNITS} as quantity,
  (l_linenumber - 1) * 10 as days_supply,
  o_orderpriority as rx_cohort
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{part}} on l_partkey = p_partkey"""

PATIENT_DEMO = """
select c_custkey as patient_id, cast(o_orderdate as date) as kh_refresh_date,
  case (c_nationkey + case when c_custkey % 7 = 3 then month(o_orderdate) else 0 end) % 3
    when 0 then 'f' when 1 then 'M' else null end as patient_gender,
  case when c_custkey % 40 = 0 then null else cast(1920 + c_custkey % 100
    + case when c_custkey % 9 = 2 then month(o_orderdate) % 2 else 0 end as int) end as patient_yob
from {customer} join {orders} on c_custkey = o_custkey
where c_custkey % 20 <> 19"""

PATIENT_ENROLL = """
select c_custkey as patient_id, date '1998-03-10' as kh_refresh_date,
  date '1995-01-01' as start_date,
  case when c_custkey % 30 = 0 then null else date '1997-12-31' end as end_date
from {customer}
union all
select c_custkey, date '1998-03-10', date '1997-06-01', date '2000-06-30'
from {customer} where c_custkey % 4 <> 0"""

PATIENT_GEO = """
select c_custkey as patient_id, date '1995-01-01' as valid_from_date,
  date '1998-06-30' as valid_to_date, n_name as patient_state,
  date '1998-01-10' as kh_refresh_date
from {customer} join {nation} on n_nationkey = c_nationkey
union all
select c_custkey, date '1998-01-01', date '2001-12-31', n_name, date '1998-03-10'
from {customer} join {nation} on n_nationkey = (c_nationkey + 1) % 25
where c_custkey % 3 = 0"""

PATIENT_MORTALITY = """
select c_custkey as patient_id, date '1998-03-10' as kh_refresh_date,
  case when c_custkey % 50 = 1 then date '1998-02-15' else null end as patient_death_date
from {customer} where c_custkey % 25 = 1"""

PROVIDERS = """
select lpad(cast(s_suppkey as string), 10, '0') as npi, date '1998-03-10' as kh_refresh_date
from {supplier} where s_acctbal > 0"""

VIEWS = {"mx_events": MX_EVENTS, "rx_events": RX_EVENTS, "patient_demo": PATIENT_DEMO,
         "patient_enroll": PATIENT_ENROLL, "patient_geo": PATIENT_GEO,
         "patient_mortality": PATIENT_MORTALITY, "providers": PROVIDERS}
SOURCES = ("lineitem", "orders", "customer", "supplier", "part", "nation")


def oracle_view(name: str) -> str:
    """The view's query for DuckDB, where the tables are registered by name."""
    text = VIEWS[name].replace("10000.0D", "10000.0::double").replace("0.0D", "0.0::double")
    return text.format(**{s: s for s in SOURCES})


@lru_cache(maxsize=64)
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A view over the tables, some of which may be ``given``."""
    text = VIEWS[name]
    used = {s: given[s] if s in given else _table(spark, sf_dir, s)
            for s in SOURCES if f"{{{s}}}" in text}
    return spark.sql(text, **used)


class Dimensions(Mapping):
    """The dimension views, each planned only if a check asks for it."""

    views = {"demo": "patient_demo", "enroll": "patient_enroll", "geo": "patient_geo",
             "mortality": "patient_mortality", "providers": "providers"}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._frames = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = view(self._spark, self._sf_dir, self.views[name])
        return self._frames[name]

    def __iter__(self):
        return iter(self.views)

    def __len__(self):
        return len(self.views)


def context(spark: SparkSession, sf_dir: str, profile: TableProfile = MEDICAL,
            **changes) -> Context:
    """The context most queries start from: all refreshes, reference month 1998-03."""
    settings = {"scope": "all", "month": MONTH, "previous": PREVIOUS, "as_of": AS_OF}
    settings.update(changes)
    return Context(profile=profile, events_table=view(spark, sf_dir, profile.name),
                   dimensions=Dimensions(spark, sf_dir), **settings)


def month_context(spark: SparkSession, sf_dir: str, profile: TableProfile = MEDICAL,
                  **changes) -> Context:
    """The context of one refresh, over the events of its month and of the month before.

    The orders of these months are written first.  Spark then knows their size and sends them to
    the line items; by the size of all orders it would shuffle all line items for one month.
    """
    ctx = context(spark, sf_dir, profile, scope="month", **changes)
    refresh = F.col("o_orderdate").cast("date")
    wanted = months.in_months(refresh, ctx.month)
    if ctx.previous:
        wanted = wanted | months.in_months(refresh, ctx.previous)
    text = VIEWS[profile.name]
    orders = _table(spark, sf_dir, "orders")
    orders = orders.filter(wanted).select(*[c for c in orders.columns if c in text])
    return ctx.with_(events_table=view(spark, sf_dir, profile.name,
                                       orders=stored(orders, "orders")))


def kept(ctx: Context, *columns: str) -> Context:
    """The context over its events written once, for runs of many passes; some columns or all.

    The view joins two or three tables, which Spark would shuffle again for every pass.  Of a
    context of months only the compared ones are written.
    """
    sampled = {}
    rows = ctx.events_table
    if ctx.scope != "all":
        rows, sampled = ctx.compared().drop(OWN), {"sample_rows": 0}
    rows = rows.select(*columns) if columns else rows
    return ctx.with_(events_table=stored(rows, "events"), **sampled)


__all__ = ["MEDICAL", "PHARMACY", "context", "kept", "month_context", "oracle_view", "view"]
