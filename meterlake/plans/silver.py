"""Silver: dimensions with stable keys and typed, keyed facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.classify import known_or, tariff_class
from meterlake.functions.scalars import (
    HOUR_PERIOD_PATTERN,
    business_key,
    date_key,
    padded_id,
    safe_number,
    safe_timestamp,
)
from meterlake.operators.dedup import dedup_latest
from meterlake.operators.keys import assign_keys
from meterlake.operators.lookups import lookup_join
from meterlake.operators.quality import passed_only, row_flags
from meterlake.plans.layout import LAYOUTS
from meterlake.sources.staging import stage

# Fixed values of the generated dimension attributes.
REGION = "LONDON"
ACTIVE = "ACTIVE"
METER_TYPE = "SMART"
MANUFACTURER = "LANDIS_GYR"
INSTALL_DATE = "2012-01-01"


def latest_per_meter(readings: DataFrame, columns: list[str]) -> DataFrame:
    """One row per meter with the attributes of its last reading: by time, in whatever format it is written, then by its text."""
    known = readings.filter(F.col("LCLid").isNotNull()).select("LCLid", "DateTime", *columns)
    return dedup_latest(known, ["LCLid"], [safe_timestamp("DateTime").desc_nulls_last(), F.col("DateTime").desc_nulls_last()])


def last_readings(readings: DataFrame) -> DataFrame:
    """The last reading of each meter, staged: both dimensions are built from it, so that the readings are gone through once."""
    region = ["region"] if "region" in readings.columns else []
    return stage(latest_per_meter(readings, ["stdorToU", *region, "kwh_hh"]), "last-readings")


def dim_customer(readings: DataFrame, existing: DataFrame | None = None, region: Column | None = None) -> DataFrame:
    """Customers, one per meter id, with keys kept from ``existing``.  ``readings``: all of them, or `last_readings`."""
    extra = ["region"] if region is None and "region" in readings.columns else []
    members = latest_per_meter(readings, ["stdorToU", *extra]).drop("DateTime")
    keyed = assign_keys(members, existing, "LCLid", "customer_key")
    return keyed.select(
        "customer_key",
        padded_id("CUST", "customer_key").alias("customer_id"),
        "LCLid",
        F.col("stdorToU").alias("customer_type"),
        tariff_class(F.col("stdorToU")).alias("tariff_id"),
        F.lit(ACTIVE).alias("status"),
        (F.col("region") if extra else F.lit(REGION) if region is None else region).alias("region"),
    )


def dim_meter(readings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Meters with the last reading as a sample; keys kept from ``existing``.  ``readings``: all of them, or `last_readings`."""
    members = latest_per_meter(readings, ["stdorToU", "kwh_hh"])
    keyed = assign_keys(members, existing, "LCLid", "meter_key")
    return keyed.select(
        "meter_key",
        padded_id("MTR", "meter_key").alias("meter_id"),
        "LCLid",
        "stdorToU",
        "DateTime",
        "kwh_hh",
        F.lit(METER_TYPE).alias("meter_type"),
        F.lit(MANUFACTURER).alias("manufacturer"),
        F.lit(ACTIVE).alias("status"),
        F.lit(INSTALL_DATE).alias("install_date"),
        F.lit(REGION).alias("region"),
    )


def clean_readings(readings: DataFrame) -> DataFrame:
    """Readings with a meter id and a numeric consumption."""
    typed = readings.withColumn("consumption_kwh", safe_number("kwh_hh"))
    return typed.filter(F.col("consumption_kwh").isNotNull() & F.col("LCLid").isNotNull())


def fact_consumption(
    readings: DataFrame, customers: DataFrame, meters: DataFrame, single: bool = True
) -> DataFrame:
    """One row per meter and reading time with surrogate keys; both dimensions are looked up in one go.

    ``single=False`` leaves repeated keys in, for checks that must see them.
    """
    cleaned = clean_readings(readings)
    if single:
        # Everything else follows from meter and time, so one hash aggregation removes repeats, without a sort.
        cleaned = cleaned.groupBy("LCLid", "DateTime").agg(F.min("consumption_kwh").alias("consumption_kwh"))
    typed = cleaned.select(
        business_key("LCLid", F.col("DateTime").cast("string")).alias("consumption_business_key"),
        "LCLid",
        safe_timestamp("DateTime").alias("reading_timestamp"),
        "consumption_kwh",
    )
    sides = [customers.select("LCLid", "customer_key", "region"), meters.select("LCLid", "meter_key")]
    return lookup_join(typed, sides, "LCLid").select(
        "consumption_business_key",
        "customer_key",
        "meter_key",
        date_key("reading_timestamp").alias("date_key"),
        "reading_timestamp",
        "consumption_kwh",
        "region",
    )


def fact_weather(weather: DataFrame, single: bool = True) -> DataFrame:
    """One row per weather hour with unit-named measures: the last observation of the hour."""
    ts = F.col("weather_timestamp")
    typed = weather.filter(F.col("timestamp").isNotNull()).withColumn("weather_timestamp", safe_timestamp("timestamp"))
    hourly = typed.select(
        business_key(F.date_format(F.to_date(ts), "yyyyMMdd"), F.lpad(F.hour(ts).cast("string"), 2, "0")).alias(
            "weather_business_key"
        ),
        date_key(ts).alias("date_key"),
        "weather_timestamp",
        F.hour(ts).alias("hour_of_day"),
        safe_number("temperature").alias("temperature_c"),
        safe_number("humidity").alias("humidity_pct"),
        safe_number("wind_speed").alias("wind_speed_kmh"),
        safe_number("precipitation").alias("precipitation_mm"),
    )
    return dedup_latest(hourly, ["weather_business_key"], [ts.desc_nulls_last()]) if single else hourly


def fact_demand(demand: DataFrame, single: bool = True) -> DataFrame:
    """One row per respondent, period and type."""
    present = F.col("period").isNotNull() & F.col("respondent").isNotNull() & F.col("type").isNotNull()
    ts = F.col("demand_timestamp")
    typed = demand.filter(present).withColumn("demand_timestamp", safe_timestamp("period", HOUR_PERIOD_PATTERN))
    facts = typed.select(
        business_key("respondent", "period", "type").alias("demand_business_key"),
        date_key(ts).alias("date_key"),
        "respondent",
        F.col("`respondent-name`").alias("respondent_name"),
        "type",
        F.col("`type-name`").alias("type_name"),
        F.col("`value-units`").alias("value_units"),
        "demand_timestamp",
        F.hour(ts).alias("hour_of_day"),
        safe_number("value").alias("demand_mwh"),
    )
    return dedup_latest(facts, ["demand_business_key"]) if single else facts


def sound_rows(batch: DataFrame, table: str) -> DataFrame:
    """Rows of a checked batch that break no row-wise check of the table, whatever the verdict of the batch.

    Repeated keys are no fault here: the facts keep one row of each.  Frames without a verdict pass unchanged.
    """
    if "dq_passed" not in batch.columns:
        return batch
    checks = [check for check in LAYOUTS[table].checks if check["check_type"] != "unique"]
    return passed_only(row_flags(batch, checks), "dq_row_passed").select(*batch.columns)


def fact_feeder_readings(feeders: DataFrame) -> DataFrame:
    """Typed feeder telemetry, one row per feeder and time."""
    typed = sound_rows(feeders, "bronze.bronze_feeder_readings").select(
        F.upper(F.trim("feeder_id")).alias("feeder_id"),
        F.upper(F.trim("substation_id")).alias("substation_id"),
        safe_timestamp("DateTime").alias("reading_timestamp"),
        F.round(safe_number("voltage_v"), 2).alias("voltage_v"),
        F.round(safe_number("current_a"), 2).alias("current_a"),
        F.round(safe_number("active_power_kw"), 3).alias("active_power_kw"),
        F.trim("source_system").alias("source_system"),
    )
    ts = F.col("reading_timestamp")
    present = F.col("feeder_id").isNotNull() & F.col("substation_id").isNotNull() & ts.isNotNull()
    dated = typed.filter(present).withColumns({"reading_date": F.to_date(ts), "reading_hour": F.hour(ts)})
    return dedup_latest(dated, ["feeder_id", "reading_timestamp"])


def fact_meter_events(events: DataFrame) -> DataFrame:
    """Typed events, one row per event id: the most recently loaded one."""
    loaded = [F.col("load_ts").alias("load_ts")] if "load_ts" in events.columns else []
    typed = sound_rows(events, "bronze.bronze_meter_events").select(
        F.trim("event_id").alias("event_id"),
        F.trim("LCLid").alias("LCLid"),
        F.upper(F.trim("event_type")).alias("event_type"),
        known_or(F.upper(F.trim("severity"))).alias("severity"),
        safe_timestamp("event_timestamp").alias("event_timestamp"),
        F.trim("source_system").alias("source_system"),
        *loaded,
    )
    ts = F.col("event_timestamp")
    present = F.col("event_id").isNotNull() & F.col("LCLid").isNotNull() & ts.isNotNull()
    dated = typed.filter(present).withColumns({"event_date": F.to_date(ts), "event_hour": F.hour(ts)})
    order = [F.col("load_ts").desc_nulls_last()] if loaded else None
    return dedup_latest(dated, ["event_id"], order).drop("load_ts")
