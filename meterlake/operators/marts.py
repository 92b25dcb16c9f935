"""Gold aggregates: revenue, hourly load, peer outliers, weather impact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.scalars import month_period, month_start
from meterlake.operators.dedup import dedup_latest
from meterlake.operators.lookups import lookup_join
from meterlake.sources.staging import stage

# Texts of the outlier verdict.
BELOW_PEERS = "Consumption is materially below tariff peer usage"
WITHIN_PEERS = "Within expected tariff peer range"


def revenue_summary(billing: DataFrame) -> DataFrame:
    """Customers, meters, consumption and revenue per billing period."""
    return billing.groupBy("billing_period").agg(
        F.countDistinct("customer_key").alias("customer_count"),
        F.countDistinct("meter_key").alias("meter_count"),
        F.sum("consumption_kwh").alias("total_consumption_kwh"),
        F.sum("bill_amount").alias("total_revenue"),
        F.avg("consumption_kwh").alias("avg_consumption_kwh"),
        F.avg("bill_amount").alias("avg_bill_amount"),
    )


def peak_load(consumption: DataFrame) -> DataFrame:
    """Reading count, total, mean and maximum consumption per day and hour."""
    ts = F.col("reading_timestamp")
    hourly = consumption.groupBy("date_key", F.to_date(ts).alias("reading_date"), F.hour(ts).alias("hour_of_day")).agg(
        F.count("consumption_business_key").alias("reading_count"),
        F.sum("consumption_kwh").alias("total_consumption_kwh"),
        F.avg("consumption_kwh").alias("avg_consumption_kwh"),
        F.max("consumption_kwh").alias("max_meter_consumption_kwh"),
    )
    return hourly.withColumn("reading_date", F.col("reading_date").cast("string"))


def monthly_by_customer(consumption: DataFrame, customers: DataFrame) -> DataFrame:
    """Monthly consumption per customer; the customer attributes join the monthly sums."""
    monthly = consumption.groupBy("customer_key", month_start("reading_timestamp")).agg(
        F.sum("consumption_kwh").alias("consumption_kwh")
    )
    monthly = monthly.withColumn("billing_period", month_period("month_start")).drop("month_start")
    return lookup_join(monthly, customers.select("customer_key", "LCLid", "tariff_id"), "customer_key")


def peer_outliers(
    members: DataFrame, peer_keys: list[str], measure: str, sigmas: float = 2, floor: float = 0.5
) -> DataFrame:
    """Compare each member with the mean and population deviation of its peer group.

    Peer statistics are staged, counted and joined back, broadcast if they are few: a peer group may hold most members, so it is
    never one task's window.
    Members with a NULL peer key have no peers and are not flagged.
    """
    mean, spread = f"peer_avg_{measure}", f"peer_stddev_{measure}"
    stats = members.groupBy(*peer_keys).agg(F.avg(measure).alias(mean), F.stddev_pop(measure).alias(spread))
    compared = lookup_join(members, stage(stats, "peers"), peer_keys)
    below = (F.col(measure) < F.col(mean) - sigmas * F.col(spread)) & (F.col(measure) < F.col(mean) * floor)
    flag = F.coalesce(below, F.lit(False))
    return compared.withColumns(
        {
            "variance_from_peer_kwh": F.round(F.col(measure) - F.col(mean), 6),
            "theft_flag": flag,
            "detection_reason": F.when(flag, F.lit(BELOW_PEERS)).otherwise(F.lit(WITHIN_PEERS)),
        }
    )


def theft_detection(consumption: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers whose monthly consumption lies far below their tariff peers."""
    monthly = monthly_by_customer(consumption, customers)
    return peer_outliers(monthly, ["billing_period", "tariff_id"], "consumption_kwh").select(
        "billing_period",
        "tariff_id",
        "customer_key",
        "LCLid",
        "consumption_kwh",
        "peer_avg_consumption_kwh",
        "peer_stddev_consumption_kwh",
        "variance_from_peer_kwh",
        "theft_flag",
        "detection_reason",
    )


def weather_impact(consumption: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of each hour next to that hour's consumption; hours without readings keep NULL measures."""
    slot = ["date_key", "hour_of_day"]
    hourly = consumption.groupBy("date_key", F.hour("reading_timestamp").alias("hour_of_day")).agg(
        F.sum("consumption_kwh").alias("total_consumption_kwh"),
        F.avg("consumption_kwh").alias("avg_meter_consumption_kwh"),
    )
    measures = ["temperature_c", "humidity_pct", "wind_speed_kmh", "precipitation_mm"]
    order = [F.col("weather_timestamp").desc()]
    latest = dedup_latest(weather.select(*slot, "weather_timestamp", *measures), slot, order)
    return latest.drop("weather_timestamp").join(hourly, slot, "left")
