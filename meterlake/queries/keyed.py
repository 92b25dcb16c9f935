"""Duplicates, numbering and surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.functions.scalars import padded_id
from meterlake.operators import dedup, grid, keys
from meterlake.plans import mapping
from meterlake.queries.registry import CUSTOMER_REGIONS, query, sql_padded

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("dedup_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_keys(spark, sf_dir):
    return dedup.distinct_keys(mapping.table(spark, sf_dir, "lineitem"), LINE_KEY)


@query(
    "dedup_latest",
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
      l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)
def dedup_latest(spark, sf_dir):
    return dedup.dedup_latest(mapping.table(spark, sf_dir, "lineitem"), LINE_KEY, [F.col("l_shipdate").desc()])


@query("distinct_slots", "SELECT DISTINCT date_trunc('hour', ts) AS slot FROM events WHERE ts IS NOT NULL")
def distinct_slots(spark, sf_dir):
    hours = mapping.table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot")
    )
    return grid.distinct_slots(hours, "slot")


@query("max_key", "SELECT coalesce(max(c_custkey), 0) AS max_key FROM customer")
def max_key(spark, sf_dir):
    return keys.max_key(mapping.table(spark, sf_dir, "customer"), "c_custkey")


NEW_MEMBERS = f"""WITH {CUSTOMER_REGIONS} SELECT "LCLid", "stdorToU" FROM customer_regions
  WHERE "LCLid" NOT IN (SELECT {sql_padded('MAC', 'user_id')} FROM events)"""


@query("new_members", NEW_MEMBERS)
def new_members(spark, sf_dir):
    members = mapping.customer_regions(spark, sf_dir).select("LCLid", "stdorToU")
    meters = mapping.table(spark, sf_dir, "events").select(mapping.meter_id().alias("LCLid")).distinct()
    return keys.new_members(members, meters, "LCLid")


@query(
    "assign_keys",
    f"""WITH {CUSTOMER_REGIONS}, held AS (
      SELECT "LCLid", row_number() OVER (ORDER BY "LCLid") AS customer_key
      FROM (SELECT DISTINCT {sql_padded('MAC', 'user_id')} AS "LCLid" FROM events) t),
    fresh AS (SELECT "LCLid" FROM customer_regions WHERE "LCLid" NOT IN (SELECT "LCLid" FROM held)),
    keyed AS (SELECT "LCLid", customer_key FROM held
      UNION ALL SELECT "LCLid", (SELECT coalesce(max(customer_key), 0) FROM held) + row_number() OVER (ORDER BY "LCLid")
      FROM fresh)
    SELECT "LCLid", customer_key, {sql_padded('CUST', 'customer_key')} AS customer_id FROM keyed""",
)
def assign_keys(spark, sf_dir):
    """First run: the meters with events get keys.  Second run: these and all customers; the first keys stay."""
    seen = mapping.table(spark, sf_dir, "events").select(mapping.meter_id().alias("LCLid")).distinct()
    first = keys.assign_keys(seen, None, "LCLid", "customer_key")
    members = mapping.customer_regions(spark, sf_dir).select("LCLid").union(seen).distinct()
    keyed = keys.assign_keys(members, first, "LCLid", "customer_key")
    return keyed.withColumn("customer_id", padded_id("CUST", "customer_key"))


@query(
    "page_by_period",
    """WITH n AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders)
      SELECT CAST(i // 5000 AS BIGINT) AS page_no, count(*) AS page_rows, min(o_orderdate) AS first_period,
        max(o_orderdate) AS last_period FROM n GROUP BY 1""",
)
def page_by_period(spark, sf_dir):
    """The sorted pages of 5,000 records a remote source serves, all of them."""
    orders = mapping.table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    pages = keys.paged(orders, ["o_orderdate", "o_orderkey"], 5000)
    return pages.groupBy("page_no").agg(
        F.count(F.lit(1)).alias("page_rows"),
        F.min("o_orderdate").alias("first_period"),
        F.max("o_orderdate").alias("last_period"),
    )
