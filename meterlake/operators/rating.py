"""Tariff schedules, rating of readings and billing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.classify import FLAT_CLASS, FLAT_RATE, tariff_attribute
from meterlake.functions.scalars import business_key, floor_minutes, month_period, month_start
from meterlake.operators.asof import asof_join
from meterlake.operators.dedup import dedup_latest
from meterlake.operators.lookups import lookup_join

# Fixed values of the flat-rate variant: tariff id -> rate, and the rate of any other tariff.
FLAT_TARIFF_RATES = {"TAR002": 0.18}
FLAT_TARIFF_DEFAULT = 0.15
SLOT_MINUTES = 30


def tariff_schedule(bronze_tariff: DataFrame) -> DataFrame:
    """One row per half hour with the rate in force.

    Of several names in one half hour the one loaded last stays (a correction replaces what it corrects), then the first by name.
    """
    loaded = [F.col("load_ts").alias("__loaded")] if "load_ts" in bronze_tariff.columns else []
    rows = bronze_tariff.filter(F.col("Tariff").isNotNull() & F.col("TariffDateTime").isNotNull()).select(
        F.col("TariffDateTime").cast("timestamp_ntz").alias("tariff_half_hour"), F.col("Tariff").alias("tariff_name"), *loaded
    )
    name = F.col("tariff_name")
    order = [F.col("__loaded").desc_nulls_last()] if loaded else None
    return dedup_latest(rows, ["tariff_half_hour"], order).drop("__loaded").withColumns(
        {"tariff_id": tariff_attribute(name, 1), "rate_per_kwh": tariff_attribute(name, 3)}
    )


def dim_tariff(bronze_tariff: DataFrame) -> DataFrame:
    """One row per tariff name with the first half hour it applies to."""
    name = F.col("tariff_name")
    return (
        bronze_tariff.filter(F.col("Tariff").isNotNull())
        .groupBy(F.col("Tariff").alias("tariff_name"))
        .agg(F.min(F.col("TariffDateTime").cast("timestamp_ntz")).alias("tariff_half_hour"))
        .select(
            tariff_attribute(name, 0).alias("tariff_key"),
            tariff_attribute(name, 1).alias("tariff_id"),
            "tariff_name",
            tariff_attribute(name, 2).alias("tariff_description"),
            tariff_attribute(name, 3).alias("rate_per_kwh"),
            F.lit("ACTIVE").alias("status"),
            F.lit("LONDON").alias("region"),
            "tariff_half_hour",
        )
    )


def attach_schedule(readings: DataFrame, schedule: DataFrame, ts_col: str = "reading_timestamp") -> DataFrame:
    """Add ``schedule_rate`` of the half hour a reading falls into; NULL where the schedule has a gap."""
    rates = schedule.select(
        F.col("tariff_half_hour").alias("reading_half_hour"), F.col("rate_per_kwh").alias("schedule_rate")
    )
    slotted = readings.withColumn("reading_half_hour", floor_minutes(ts_col, SLOT_MINUTES))
    return lookup_join(slotted, rates, "reading_half_hour")


def attach_changes(readings: DataFrame, changes: DataFrame, ts_col: str = "reading_timestamp") -> DataFrame:
    """Add ``schedule_rate`` of the last change point at or before the reading, wherever the points lie; NULL before the first."""
    points = changes.select(F.col("tariff_half_hour").alias("__since"), F.col("rate_per_kwh").alias("schedule_rate"))
    return asof_join(readings, points, ts_col, "__since").drop("__since")


def rate_readings(
    readings: DataFrame,
    schedule: DataFrame,
    flat_class: str = FLAT_CLASS,
    flat_rate: float = FLAT_RATE,
    class_col: str = "customer_type",
    asof: bool = False,
) -> DataFrame:
    """Rate and cost per reading: the flat rate for the flat class, else the schedule's.

    ``asof=True`` takes a schedule that lists only its change points, at any times.
    """
    rated = attach_changes(readings, schedule) if asof else attach_schedule(readings, schedule)
    rate = F.when(F.col(class_col) == flat_class, F.lit(flat_rate)).otherwise(F.col("schedule_rate"))
    return rated.withColumn("applied_rate_per_kwh", rate).withColumn(
        "half_hour_cost", F.col("consumption_kwh") * F.col("applied_rate_per_kwh")
    )


def bill(consumption: DataFrame, customers: DataFrame, meters: DataFrame, schedule: DataFrame) -> DataFrame:
    """Monthly bill per customer and meter.

    The rate of a reading depends on its half hour and on its customer's class, which is constant per group, so readings
    are summed both plainly and at the schedule rate first; customers and meters join the monthly sums, not the readings.
    The region is the customer's, so that a customer who moved has one bill a month.
    """
    scheduled = attach_schedule(consumption, schedule)
    monthly = scheduled.groupBy("customer_key", "meter_key", month_start("reading_timestamp")).agg(
        F.sum("consumption_kwh").alias("consumption_kwh"),
        F.sum(F.col("consumption_kwh") * F.col("schedule_rate")).alias("__schedule_cost"),
    )
    monthly = monthly.withColumn("billing_period", month_period("month_start"))
    named = lookup_join(
        monthly, customers.select("customer_key", "customer_id", "tariff_id", "customer_type", "region"), "customer_key"
    )
    named = lookup_join(named, meters.select("meter_key", "meter_id"), "meter_key")
    amount = F.when(F.col("customer_type") == FLAT_CLASS, F.col("consumption_kwh") * FLAT_RATE).otherwise(
        F.col("__schedule_cost")
    )
    return named.select(
        business_key("customer_id", "meter_id", "billing_period").alias("billing_business_key"),
        F.concat(F.lit("BILL"), business_key("customer_id", "billing_period")).alias("bill_id"),
        "customer_key",
        "meter_key",
        "tariff_id",
        "customer_id",
        "meter_id",
        "billing_period",
        "consumption_kwh",
        amount.alias("bill_amount"),
        F.lit("CALCULATED").alias("billing_status"),
        "region",
        F.lit("BILLING_ENGINE").alias("source_system"),
    )


def bill_flat(consumption: DataFrame, customers: DataFrame, meters: DataFrame) -> DataFrame:
    """The older rule: monthly consumption times one rate per tariff class."""
    monthly = consumption.groupBy("customer_key", "meter_key", month_start("reading_timestamp")).agg(
        F.sum("consumption_kwh").alias("consumption_kwh")
    )
    monthly = monthly.withColumn("billing_period", month_period("month_start")).drop("month_start")
    named = lookup_join(monthly, customers.select("customer_key", "customer_id", "LCLid", "tariff_id"), "customer_key")
    named = lookup_join(named, meters.select("meter_key", "meter_id"), "meter_key")
    rate = F
    for tariff, value in FLAT_TARIFF_RATES.items():
        rate = rate.when(F.col("tariff_id") == tariff, F.lit(value))
    rated = named.withColumn("rate_per_kwh", rate.otherwise(F.lit(FLAT_TARIFF_DEFAULT)))
    return rated.withColumn("bill_amount", F.col("consumption_kwh") * F.col("rate_per_kwh"))
