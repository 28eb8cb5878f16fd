"""Inputs derived from the given tables by one SQL text for both engines.

``{q}`` is the identifier quote: a backtick for Spark, a double quote for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from maskwright.sources.files import spread_path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_FIRST_NAME = """case c_custkey % 5 when 0 then 'Ana' when 1 then 'Bruno' when 2 then 'Chloé'
    when 3 then 'Dmitri' else 'Eve' end"""

# Personal data for every customer: nulls, the text 'null', odd addresses included.
PII_CUSTOMER = f"""
select c_custkey,
  {_FIRST_NAME} as first_name,
  case when c_custkey % 50 = 0 then null else concat({_FIRST_NAME}, ' ',
    case c_custkey % 3 when 0 then 'O''Neil' when 1 then 'Smith-Ray' else 'Lopez' end)
    end as full_name,
  concat('user', cast(c_custkey as varchar(20))) as username,
  case when c_custkey % 50 = 1 then null when c_custkey % 97 = 2 then 'null'
    when c_custkey % 97 = 3 then 'no-at-sign' when c_custkey % 97 = 4 then 'a@b@c.example.com'
    else concat('user', cast(c_custkey as varchar(20)), '@', lower(c_mktsegment), '.example.com')
    end as email,
  case when c_custkey % 50 = 2 then null else concat(
    case when c_custkey % 4 = 0 then '10' else cast(11 + c_custkey % 180 as varchar(20)) end, '.',
    cast(c_custkey % 256 as varchar(20)), '.', cast((c_custkey * 7) % 256 as varchar(20)), '.',
    cast((c_custkey * 13) % 256 as varchar(20))) end as {{q}}IP Address v4{{q}},
  cast(18 + c_custkey % 70 as int) as age,
  concat('4', lpad(cast(c_custkey * 7919 as varchar(20)), 15, '0')) as card_no,
  concat(cast(100 + c_custkey % 900 as varchar(20)), ' Test Street, Town ',
    cast(c_nationkey as varchar(20))) as address,
  c_acctbal
from customer
"""

# A large and faulty rulebook: one rule per event.
EVENT_RULES = """
select
  case event_type when 'click' then 'customer' when 'view' then 'orders'
    when 'purchase' then 'line-item' when 'signup' then 'documents' else 'error log' end as {q}table{q},
  case event_type
    when 'click' then case user_id % 6 when 0 then 'c_custkey' when 1 then 'c_name'
      when 2 then 'c_acctbal' when 3 then 'c_mktsegment' when 4 then 'c_phone'
      else concat('c_', cast(user_id as varchar(20))) end
    when 'view' then case user_id % 5 when 0 then 'o_custkey' when 1 then 'o_orderdate'
      when 2 then 'o_totalprice' when 3 then 'o_orderpriority'
      else concat('o_', cast(user_id as varchar(20))) end
    when 'signup' then case user_id % 3 when 0 then 'text' when 1 then 'n_chars' else 'source' end
    else concat('a_', cast(user_id as varchar(20))) end as attribute,
  case when value < 1 then 'Age' when value < 2 then 'Email'
    when value < 3 then 'Email - Retain Domain' when value < 4 then 'Full Name'
    when value < 5 then 'Physical Address' when value < 6 then 'IP Address'
    when value < 7 then 'IP Address - Ignore 10.' when value < 8 then 'Credit Card'
    when value < 9 then 'Custom Rule #1' when value < 12 then 'Shuffle'
    else 'Standard' end as {q}rule{q},
  case when event_id % 29 = 0 then 'X' when event_id % 29 = 1 then null
    when value < 10 then 'N' else 'Y' end as ref_integrity,
  cast(event_id as int) as ordinal
from events
"""

# The same with conditions: whole, unreadable, on columns that are there and on others.
EVENT_CONDITIONS = f"""
select r.*, case ordinal % 7 when 0 then 'c_acctbal > 0' when 1 then 'o_totalprice > 1 and nowhere = 2'
  when 2 then 'c_acctbal >' when 3 then 'length(text) > 3' when 4 then 'exists (select 1)'
  when 5 then 'rand() < 0.5' end as condition from ({EVENT_RULES}) r
"""

# Masks handed over from an earlier system: one per customer who ever ordered.
LEGACY_DICTIONARY = """
select 'project:checks' as scope, concat('user', cast(o_custkey as varchar(20))) as original,
  concat('legacy-', cast(min(o_orderkey) as varchar(20))) as masked
from orders group by o_custkey
"""


# The same, and masks of mail domains, of some words of names, and of some whole addresses.
LEGACY_PIECES = f"""
select 'project:checks' as scope, concat('user', cast(o_custkey as varchar(20))) as original,
  concat('legacy-', cast(min(o_orderkey) as varchar(20))) as masked
from orders group by o_custkey
union all
select 'project:checks', concat(lower(c_mktsegment), '.example.com'),
  concat('segment', cast(min(c_custkey) as varchar(20)), '.example.net') from customer
where c_mktsegment < 'F' group by c_mktsegment
union all
select 'project:checks', {_FIRST_NAME}, concat('Name', cast(min(c_custkey) as varchar(20))) from customer
where c_custkey % 5 in (0, 2) group by {_FIRST_NAME}
union all
select 'project:checks', concat('user', cast(c_custkey as varchar(20)), '@', lower(c_mktsegment), '.example.com'),
  concat('whole-', cast(c_custkey as varchar(20))) from customer where c_custkey % 11 = 0
union all
select 'project:checks', 'Lopez', concat('de la ', max(c_mktsegment)) from customer having count(*) > 0
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table that is about to be masked, on all cores."""
    path = f"{sf_dir}/{name}.parquet"
    return spread_path(spark.read.parquet(path).select(*columns), path)


def spark_view(spark: SparkSession, sf_dir: str, sql: str, **names: str) -> DataFrame:
    """A view over the tables named in ``names`` (placeholder -> table)."""
    frames = {placeholder: table(spark, sf_dir, name) for placeholder, name in names.items()}
    for placeholder in names:
        sql = sql.replace(f"from {placeholder}", f"from {{{placeholder}}}")
    return spark.sql(sql.replace("{q}", "`"), **frames)


def duck_view(sql: str) -> str:
    return sql.replace("{q}", '"')


def pii_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, PII_CUSTOMER, customer="customer")


def event_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, EVENT_RULES, events="events")


def event_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, EVENT_CONDITIONS, events="events")


def legacy_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, LEGACY_PIECES, orders="orders", customer="customer")


def legacy_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, LEGACY_DICTIONARY, orders="orders")
