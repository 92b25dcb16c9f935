"""Bronze: landed records with load metadata, one row per natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.classify import severity
from meterlake.functions.scalars import active_power, safe_number, safe_timestamp
from meterlake.operators.dedup import dedup_latest

# Header of the consumption column in raw files (with its trailing blank) and source names.
RAW_CONSUMPTION_HEADER = "KWH/hh (per half hour) "
RAW_READING_COLUMNS = ["LCLid", "stdorToU", "DateTime", RAW_CONSUMPTION_HEADER]
READING_RENAMES = {RAW_CONSUMPTION_HEADER: "kwh_hh"}
READING_SOURCE = "LONDON_SMART_METER"
WEATHER_SOURCE = "WEATHER_API"
DEMAND_SOURCE = "EIA_API"
TARIFF_SOURCE = "TARIFF_FILE"
FEEDER_SOURCE = "SCADA_GRID_MONITOR"
EVENT_SOURCE = "AMI_HEADEND"
FEEDER_COLUMNS = ["feeder_id", "substation_id", "DateTime", "voltage_v", "current_a"]
EVENT_COLUMNS = ["event_id", "LCLid", "event_type", "event_timestamp"]


def bronze_readings(raw: DataFrame) -> DataFrame:
    """Meter readings, one row per meter and timestamp; where ``_file_time`` is given, that of the newest file."""
    order = [F.col("_file_time").desc_nulls_last()] if "_file_time" in raw.columns else None
    single = dedup_latest(raw, ["LCLid", "DateTime"], order).drop("_file_time")
    return single.withColumn("source_system", F.lit(READING_SOURCE))


def bronze_weather(raw: DataFrame) -> DataFrame:
    """Weather observations, one row per timestamp; the most recently landed one wins."""
    order = [F.col(c).desc_nulls_last() for c in ("_ingestion_ts", "_load_id") if c in raw.columns]
    return dedup_latest(raw, ["timestamp"], order).withColumn("source_system", F.lit(WEATHER_SOURCE))


def bronze_demand(raw: DataFrame) -> DataFrame:
    """Hourly demand, one row per period, respondent and type; the most recently landed one wins."""
    order = [F.col(c).desc_nulls_last() for c in ("_ingestion_ts", "_load_id") if c in raw.columns]
    keyed = dedup_latest(raw, ["period", "respondent", "type"], order)
    return keyed.withColumn("source_system", F.lit(DEMAND_SOURCE))


def bronze_tariff(raw: DataFrame) -> DataFrame:
    """Tariff entries as delivered."""
    return raw.withColumn("source_system", F.lit(TARIFF_SOURCE))


def bronze_feeder_readings(raw: DataFrame) -> DataFrame:
    """Feeder telemetry as landed, typed, with its active power; one row per feeder and time."""
    typed = raw.withColumns({c: safe_number(c) for c in ("voltage_v", "current_a")})
    powered = typed.withColumn("active_power_kw", active_power("voltage_v", "current_a"))
    columns = ["feeder_id", "substation_id", "DateTime", "voltage_v", "current_a", "active_power_kw"]
    return dedup_latest(powered.select(*columns), ["feeder_id", "DateTime"]).withColumn("source_system", F.lit(FEEDER_SOURCE))


def bronze_meter_events(raw: DataFrame) -> DataFrame:
    """Meter events as landed, with the severity of their type; one row per event id."""
    typed = raw.select(
        "event_id",
        "LCLid",
        "event_type",
        severity(F.col("event_type")).alias("severity"),
        safe_timestamp("event_timestamp").alias("event_timestamp"),
    )
    return dedup_latest(typed, ["event_id"]).withColumn("source_system", F.lit(EVENT_SOURCE))
