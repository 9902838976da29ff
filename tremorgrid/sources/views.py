"""Event catalogs seen through the driver's tables.

``catalog_events`` is dirty and short (revised duplicates, missing values,
out-of-bounds rows); ``catalog_orders`` is clean and spans several years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_EVENTS_SQL = """
select event_id - (case when event_id % 50 = 49 then 1 else 0 end) id,
       ts time,
       ts + make_dt_interval(0, 0, 0, cast(event_id % 1000 as int)) updated,
       case when event_id % 211 = 0 then 95.0D
            else cast(user_id % 10 - 5 as double) + 0.25D end latitude,
       cast((user_id div 10) % 10 - 5 as double) + 0.75D longitude,
       cast(event_id % 300 as double) depth,
       case when event_id % 97 = 0 then null else (20 + floor(value / 11.5D)) / 10.0D end mag,
       case when event_id % 89 = 0 then null else 'ml' end magType,
       case when event_type = 'error' and event_id % 10 = 0
            then 'quarry blast' else 'earthquake' end type
from {events}
"""

_ORDERS_SQL = """
select o_orderkey id,
       o_orderdate + make_dt_interval(0, 0, 0, cast(o_orderkey % 86400 as int)) time,
       o_orderdate + make_dt_interval(0, 0, 0, cast(o_orderkey % 86400 as int)) updated,
       cast(n_nationkey div 5 - 2 as double) + 0.5D latitude,
       cast(n_nationkey % 5 - 2 as double) + 0.5D longitude,
       10.0D depth,
       (20 + o_orderkey % 7
           + (case when o_orderkey % 13 = 0 then 2 * (o_orderkey % 11) else 0 end)) / 10.0D mag,
       'ml' magType, 'earthquake' type
from {orders}
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_catalog(read_table(spark, sf_dir, "events"))


def events_as_catalog(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(_EVENTS_SQL, events=events)


def catalog_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: read_table(spark, sf_dir, t) for t in ("orders", "customer", "nation")}
    return spark.sql(_ORDERS_SQL, **tables)


def as_raw_text(catalog: DataFrame) -> DataFrame:
    """The catalog as an untyped feed delivers it: every column a string."""
    return catalog.select([F.col(c).cast("string").alias(c) for c in catalog.columns])
