"""The TPC-H-style sample tables seen as inputs of the meter domain.

Each function reads whole tables; the rules use attributes only, never row subsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.scalars import padded_id
from meterlake.operators.lookups import lookup_join

# Declared columns of the sample tables: no footer is read to infer them.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

STD_SEGMENTS = ("BUILDING", "MACHINERY", "FURNITURE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def meter_id(c: str = "user_id") -> Column:
    return padded_id("MAC", c)


def stamp(c: str) -> Column:
    """Wall-clock timestamp as fixed-width text with microseconds."""
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer attributes: LCLid, stdorToU, region.

    Nation and region hold 25 and 5 rows at every scale factor, hence the unprobed broadcasts.
    """
    regions = F.broadcast(table(spark, sf_dir, "region"))
    nations = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    places = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    customers = table(spark, sf_dir, "customer").join(F.broadcast(places), "c_nationkey", "left")
    segment = F.col("c_mktsegment")
    return customers.select(
        F.col("c_custkey").alias("user_id"),
        meter_id("c_custkey").alias("LCLid"),
        F.when(segment.isin(*STD_SEGMENTS), F.lit("Std")).when(segment.isNotNull(), F.lit("ToU")).alias("stdorToU"),
        "region",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings as text: LCLid, stdorToU, DateTime, kwh_hh; error events deliver 'Null' instead of a number."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "value", "event_type")
    members = customer_regions(spark, sf_dir).select("user_id", "stdorToU", "region")
    value = F.when(F.col("event_type") == "error", F.lit("Null")).otherwise(F.col("value").cast("string"))
    customers = table(spark, sf_dir, "customer")
    return lookup_join(events, members, "user_id", sized_by=customers).select(
        meter_id().alias("LCLid"), "stdorToU", stamp("ts").alias("DateTime"), value.alias("kwh_hh"), "region"
    )


def tariff_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tariff name for every half hour of every day with events: Low at night, High in the evening, Normal else;
    Sunday evenings carry a name outside the known three."""
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day")).distinct()
    start = F.col("day").cast("timestamp_ntz")
    halves = F.sequence(start, start + F.expr("interval '23:30' hour to minute"), F.expr("interval 30 minutes"))
    ts = F.col("TariffDateTime")
    evening = F.hour(ts).between(17, 20)
    name = (
        F.when(F.hour(ts) < 7, F.lit("Low"))
        .when(evening & (F.dayofweek(ts) == 1), F.lit("Critical"))
        .when(evening, F.lit("High"))
        .otherwise(F.lit("Normal"))
    )
    return days.select(F.explode(halves).alias("TariffDateTime")).withColumn("Tariff", name)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly observations for the hours that have events, with measures from those events."""
    events = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    return (
        events.groupBy(hour.alias("hour"))
        .agg(F.max("value").alias("top"), F.count(F.lit(1)).alias("n"))
        .select(
            F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            (F.col("top") / 10 - 10).alias("temperature"),
            F.pmod(F.col("n") * 7, F.lit(101)).alias("humidity"),
            (F.col("top") / 4).alias("wind_speed"),
            (F.col("n") / 8).alias("precipitation"),
        )
    )


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as hourly demand records with the hyphenated field names of the source."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH").alias("period"),
        F.col("o_orderpriority").alias("respondent"),
        F.concat(F.lit("Priority "), F.col("o_orderpriority")).alias("respondent-name"),
        F.col("o_orderstatus").alias("type"),
        F.concat(F.lit("Status "), F.col("o_orderstatus")).alias("type-name"),
        F.col("o_totalprice").cast("string").alias("value"),
        F.lit("megawatthours").alias("value-units"),
    )
