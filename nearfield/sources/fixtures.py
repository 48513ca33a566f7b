"""Service-shaped tables derived from the given Parquet tables.

Each derivation is one SELECT that runs unchanged in Spark SQL and in DuckDB; Spark receives
the source DataFrames through ``spark.sql(..., customer=df)`` so no global views are needed.
The DuckDB oracle reads the very same text with plain table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nearfield.sources.tables import read_table


def coord(key: str, axis: str) -> str:
    # Fixed cluster layout of the fixtures: 70 % hotspot, 25 % city, 5 % rural, coordinates in
    # millionths of a degree so both engines see bit-equal doubles.
    if axis == "lat":
        return (
            f"case when {key} % 20 < 14 then 37497940 + ({key} * 7919) % 20000 - 10000\n"
            f"     when {key} % 20 < 19 then 35157680 + ({key} * 7919) % 90000 - 45000\n"
            f"     else 37822800 + ({key} * 7919) % 500000 - 250000 end / 1e6"
        )
    return (
        f"case when {key} % 20 < 14 then 127027580 + ({key} * 104729) % 24000 - 12000\n"
        f"     when {key} % 20 < 19 then 129059380 + ({key} * 104729) % 110000 - 55000\n"
        f"     else 128155500 + ({key} * 104729) % 600000 - 300000 end / 1e6"
    )


FIXTURE_SQL = {
    "business": f"""
select c_custkey + 1 as id, cast(c_nationkey + 1 as bigint) as owner_id, c_name as name, c_mktsegment as category,
  case when c_custkey % 10 = 0 then null else concat('010-0000-', lpad(cast(c_custkey % 10000 as string), 4, '0')) end as phone,
  concat('block-', cast(c_custkey % 999 + 1 as string)) as address,
  {coord('c_custkey', 'lat')} as latitude,
  {coord('c_custkey', 'lon')} as longitude,
  case when c_acctbal < 0 then 'DELETED' else 'ACTIVE' end as status,
  cast(date '2023-01-01' + cast(c_custkey % 365 as int) as timestamp) as created_at,
  cast(date '2023-01-01' + cast(c_custkey % 365 + c_custkey % 7 as int) as timestamp) as updated_at
from {{customer}}
""",
    "search_query": f"""
select event_id as query_id, user_id, ts as requested_at,
  case when event_id % 20 < 14 then 'hotspot' when event_id % 20 < 19 then 'city' else 'rural' end as tier,
  {coord('event_id', 'lat')} as latitude,
  {coord('event_id', 'lon')} as longitude,
  case when event_id % 101 % 20 < 10 then 500 when event_id % 101 % 20 < 16 then 2000 when event_id % 101 % 20 < 19 then 5000 else 10000 end as radius_m
from {{events}}
""",
    "change_log": """
select o_orderkey + 1 as id, o_custkey + 1 as business_id,
  case o_orderstatus when 'O' then 'CREATED' when 'P' then 'UPDATED' else 'DELETED' end as change_type,
  o_orderkey % 3 = 0 as processed, o_orderdate as created_at from {orders}
""",
    "mutation": f"""
select o_orderkey + 1 as mutation_id,
  case o_orderstatus when 'O' then 'UPDATE' when 'P' then 'CREATE' else 'DELETE' end as op,
  case when o_orderstatus = 'P' then 1000000 + o_orderkey else o_custkey + 1 end as business_id,
  cast(o_custkey % 25 + 1 as bigint) as owner_id, concat('Renamed ', cast(o_orderkey as string)) as name, o_orderpriority as category,
  case when o_orderkey % 3 = 0 then null when o_orderkey % 23 = 0 then repeat('0', 40) else concat('02-', cast(o_orderkey % 1000 as string)) end as phone,
  case when o_orderkey % 17 = 0 then chr(9) else concat('road-', cast(o_orderkey % 99 as string)) end as address,
  case when o_orderkey % 19 = 0 then 95.0 else {coord('o_orderkey', 'lat')} end as latitude,
  {coord('o_orderkey', 'lon')} as longitude, o_orderdate as requested_at from {{orders}}
""",
    "request_log": """
select event_id as request_id, ts, case when event_type in ('signup') then '/v1/business/{{id}}' else '/v1/search/nearby' end as endpoint,
  value as latency_ms, case when event_type = 'error' and event_id % 4 = 0 then 500 when event_type = 'error' then 400 else 200 end as status_code,
  case event_id % 3 when 0 then 'low' when 1 then 'mid' else 'high' end as stage, event_id % 50 <> 0 as check_passed from {events}
""",
    "hot_zone_config": """
select * from (values ('wydm', 'Gangnam hot zone', 500, true), ('wy7b', 'Busan trial zone', 1000, false)) as t(geohash_prefix, description, radius_limit, is_active)
""",
    "raw_business": """
select cast(c_custkey + 1 as string) as id, cast(c_nationkey + 1 as string) as owner_id, concat('  ', c_name, ' ') as name, c_mktsegment as category,
  case when c_custkey % 5 = 0 then '' else '010-1234-5678' end as phone, case when c_custkey % 97 = 0 then ' ' else 'Seoul' end as address,
  case when c_custkey % 89 = 0 then '95.0' when c_custkey % 83 = 0 then 'n/a' else '37.499100' end as latitude, '127.031300' as longitude,
  case when c_custkey % 11 = 0 then 'UNKNOWN' when c_custkey % 13 = 0 then concat('DELETED', chr(13)) else 'ACTIVE' end as status,
  concat('2024-01-0', cast(c_custkey % 9 + 1 as string), 'T10:20:30+00:00') as created_at_raw from {customer}
""",
}

SOURCES = {
    "business": ("customer",),
    "search_query": ("events",),
    "change_log": ("orders",),
    "mutation": ("orders",),
    "request_log": ("events",),
    "hot_zone_config": (),
    "raw_business": ("customer",),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a lazy DataFrame over the given Parquet files."""
    frames = {src: read_table(spark, sf_dir, src) for src in SOURCES[name]}
    return spark.sql(FIXTURE_SQL[name], **frames)


def fixture_sql_duckdb(name: str) -> str:
    """The same derivation for DuckDB, reading the pre-registered views."""
    return FIXTURE_SQL[name].format(**{src: src for src in SOURCES[name]})


class Fixtures:
    """Lazy accessor: ``Fixtures(spark, sf_dir).business`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in FIXTURE_SQL:
            raise AttributeError(name)
        return fixture(self.spark, self.sf_dir, name)
