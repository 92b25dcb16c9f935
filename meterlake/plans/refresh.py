"""One refresh of all tables from landed raw data.

Every table costs one evaluation of its transformation: the result is staged, the quality suite reads the staged copy,
and the merge writes it with the batch verdict.  Facts are built from the bronze batches that no refresh has carried to the
facts yet, whoever wrote them: this refresh, the streaming ingestion, or a run that died.  Facts and marts are rebuilt only
for the dates and months this refresh touched; whole groups are recomputed, so the outcome equals a full rebuild.  Months
that changed dimensions reach are noted before these are merged, and settled after the marts, so they outlive a run that dies.
One writer at a time works on a lake.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.scalars import safe_timestamp
from meterlake.operators import audit, marts, rating
from meterlake.operators.drift import annotate_drift
from meterlake.operators.lookups import lookup_join
from meterlake.operators.quality import annotate_checks
from meterlake.operators.tables import Lake
from meterlake.plans import bronze, silver
from meterlake.plans.contracts import CONTRACTS
from meterlake.plans.layout import LAYOUTS
from meterlake.sources import calendar, landing, readers
from meterlake.sources.staging import released, side_by_side, stage

FAILURE_LOG = "silver.dq_failures"
LINEAGE = "audit.pipeline_lineage"
LOADS = "audit.landed_loads"
QUARANTINE = "audit.quarantined_lines"
BATCHES, BATCHES_DONE = "audit.bronze_batches", "audit.bronze_batches_done"
REACHED, REACHED_DONE = "audit.reached_months", "audit.reached_months_done"
REACHED_ID = "month int, noted bigint"
BATCH_ID = "table_name string, loaded bigint"  # load time in microseconds: what load_ts holds
FACT_SOURCES = [
    "bronze.bronze_meter_readings",
    "bronze.bronze_weather",
    "bronze.bronze_eia",
    "bronze.bronze_feeder_readings",
    "bronze.bronze_meter_events",
]
UNDATED = date(1900, 1, 1)
TABLES_AT_ONCE = 4


@dataclass(frozen=True)
class RawInputs:
    """Where raw data lands: a CSV glob of readings and the roots of landed Parquet loads.

    Of weather and demand the loads that no run has recorded are read, whatever their time.  Give the glob of the new reading files, or use the
    streaming ingestion, which remembers the files it has seen; repeated files do no harm.  Without a glob of readings,
    feeder telemetry or meter events nothing is landed there, and rows that came by streaming still reach the facts.
    """

    readings_csv: str | None
    weather: str
    demand: str
    tariff_csv: str
    feeders_csv: str | None = None
    events_csv: str | None = None


def load(lake: Lake, table: str, df: DataFrame, fail_on_error: bool = False) -> DataFrame:
    """Stamp, annotate, check and merge one table; returns the staged batch."""
    layout = LAYOUTS[table]
    loaded = time.time_ns() // 1000
    if layout.load_column:
        df = df.withColumn(layout.load_column, F.timestamp_micros(F.lit(loaded)))
    if layout.drift:
        df = annotate_drift(df, lake.read_or_none(table))
    batch = stage(df, table)
    checked = annotate_checks(
        batch, table, layout.checks, log=lambda rows: lake.append(FAILURE_LOG, rows), fail_on_error=fail_on_error
    )
    if table.startswith("bronze."):  # noted before it is written: a run that dies afterwards leaves it to the next one
        parts = [str(m) for m in _members(layout.partition_by[0], batch)] if layout.partition_by else None
        lake.append(BATCHES, lake.spark.createDataFrame([(table, loaded, parts)], f"{BATCH_ID}, parts array<string>"))
    if layout.insert_only:
        lake.insert_missing(table, checked, layout.keys, prune_by=layout.prune_by)
    else:
        order = [F.col(layout.latest_by).desc_nulls_last()] if layout.latest_by else None
        lake.upsert(table, checked, layout.keys, layout.partition_by, order, unique=not layout.repeats, staged=True)
    return checked


def load_all(lake: Lake, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Load independent tables side by side, so small ones use the cores a large one leaves idle."""
    batches = side_by_side([partial(load, lake, table, df) for table, df in frames.items()], TABLES_AT_ONCE)
    return dict(zip(frames, batches))


def _members(column: str, batch: DataFrame) -> list:
    """Distinct dates or months of a batch: bounded by the calendar, so they may become a literal filter."""
    return [row[0] for row in batch.select(column).filter(F.col(column).isNotNull()).distinct().collect()]


def _month_of(date_key: str) -> Column:
    return F.floor(F.col(date_key) / 100)


def dated_readings(raw: DataFrame) -> DataFrame:
    """Bronze readings with their partition date; those without a usable time share one early partition."""
    day = F.coalesce(F.to_date(safe_timestamp("DateTime")), F.lit(UNDATED))
    return bronze.bronze_readings(raw).withColumn("reading_date", day)


def checked_csv(lake: Lake, table: str, paths: str | list[str], columns: list[str] | T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """The rows of CSV files that fit, with provenance; lines that do not fit are kept in the quarantine, once each."""
    scan = readers.scan_csv_checked(lake.spark, paths, columns, renames)
    bad = scan.quarantine.withColumn("table_name", F.lit(table)).withColumn("load_ts", F.current_timestamp())
    if not bad.isEmpty():
        lake.insert_missing(QUARANTINE, bad, ["table_name", "source_file", "line"])
    return scan.rows


def scan_readings(lake: Lake, paths: str | list[str]) -> DataFrame:
    """Reading files by header name, each row with the time of its file."""
    table = "bronze.bronze_meter_readings"
    rows = checked_csv(lake, table, paths, bronze.RAW_READING_COLUMNS, bronze.READING_RENAMES)
    return rows.withColumn("_file_time", F.col("source_file_modification_time")).drop(*readers.PROVENANCE)


def land_tables(lake: Lake, raw: RawInputs) -> list[tuple[str, str]]:
    """The bronze layer; returns the (root, id) of the loads it read."""
    spark, frames = lake.spark, {}
    if raw.readings_csv:
        frames["bronze.bronze_meter_readings"] = dated_readings(scan_readings(lake, raw.readings_csv))
    if raw.feeders_csv:
        feeders = checked_csv(lake, "bronze.bronze_feeder_readings", raw.feeders_csv, bronze.FEEDER_COLUMNS)
        frames["bronze.bronze_feeder_readings"] = bronze.bronze_feeder_readings(feeders)
    if raw.events_csv:
        events = checked_csv(lake, "bronze.bronze_meter_events", raw.events_csv, bronze.EVENT_COLUMNS)
        frames["bronze.bronze_meter_events"] = bronze.bronze_meter_events(events)
    recorded = lake.read_or_none(LOADS)
    (weather, weather_loads), (demand, demand_loads) = (
        landing.new_loads(spark, root, recorded, provenance=True)
        for root in (raw.weather, raw.demand)
    )
    tariff_schema = T.StructType.fromDDL("TariffDateTime TIMESTAMP_NTZ, Tariff STRING")
    tariff = checked_csv(lake, "bronze.bronze_tariff", raw.tariff_csv, tariff_schema)
    weather = bronze.bronze_weather(weather).withColumn("load_timestamp", F.current_timestamp())
    frames |= {
        "bronze.bronze_weather": weather,
        "bronze.bronze_eia": bronze.bronze_demand(demand),
        "bronze.bronze_tariff": bronze.bronze_tariff(tariff),
    }
    load_all(lake, frames)
    for table in FACT_SOURCES:
        lake.create_from_contract(table, CONTRACTS[table], LAYOUTS[table].partition_by)
    return [(raw.weather, i) for i in weather_loads] + [(raw.demand, i) for i in demand_loads]


def unbuilt_batches(lake: Lake) -> tuple[dict[str, DataFrame], list[tuple[str, int]]]:
    """Per bronze table its rows that no refresh has carried to the facts, and the batches they came in.

    One row per batch comes back.  Of a partitioned table only the partitions those batches have rows in are read; the
    load times reach the scan as a pushed filter.
    """
    pending = lake.read(BATCHES)
    if lake.exists(BATCHES_DONE):
        pending = pending.join(lake.read(BATCHES_DONE), ["table_name", "loaded"], "left_anti")
    pending = pending.where(F.col("table_name").isin(*FACT_SOURCES)).collect()
    fresh = {}
    for table in FACT_SOURCES:
        found, layout = [b for b in pending if b.table_name == table], LAYOUTS[table]
        rows = lake.read(table)
        if not found:
            fresh[table] = rows.limit(0)
            continue
        if layout.partition_by:
            day = layout.partition_by[0]
            touched = sorted({p for b in found for p in b.parts})
            rows = rows.filter(F.col(day).isin(*(F.lit(p).cast(rows.schema[day].dataType) for p in touched)))
        fresh[table] = rows.filter(F.col(layout.load_column).isin(*(F.timestamp_micros(F.lit(b.loaded)) for b in found)))
    return fresh, [(b.table_name, b.loaded) for b in pending]


def not_older(readings: DataFrame, meters: DataFrame | None) -> DataFrame:
    """Readings at or after the one the meter dimension holds: a late delivery must not bring old attributes back."""
    if meters is None:
        return readings
    held = meters.select("LCLid", F.col("DateTime").alias("__held"))
    dated = lookup_join(readings, held, "LCLid")
    current = F.col("__held").isNull() | (safe_timestamp("DateTime") >= safe_timestamp("__held"))
    return dated.filter(current).select(*readings.columns)


def changed_months(lake: Lake, schedule: DataFrame, customers: DataFrame) -> set[int]:
    """Months whose bills and marts a changed schedule or changed customers reach; to be asked before these are merged.

    One number per calendar month comes back, whatever the number of half hours and customers.
    """
    if not lake.exists("silver.fact_consumption"):
        return set()
    facts, months = lake.read("silver.fact_consumption"), set()
    held = lake.read_or_none("silver.tariff_schedule")
    if held is not None:
        same = schedule["tariff_half_hour"].eqNullSafe(held["tariff_half_hour"]) & schedule["rate_per_kwh"].eqNullSafe(held["rate_per_kwh"])
        moved = schedule.join(held, same, "left_anti")
        month = F.year("tariff_half_hour") * 100 + F.month("tariff_half_hour")
        months |= {row[0] for row in moved.select(month).distinct().collect()}
    held = lake.read_or_none("silver.dim_customer")
    if held is not None:
        attributes = ["customer_key", "customer_type", "tariff_id", "region"]
        before, now = held.select(*attributes), customers.select(*attributes)
        known = now.join(before.select("customer_key"), "customer_key", "left_semi")
        moved = known.exceptAll(before).select("customer_key").distinct()
        months |= {row[0] for row in facts.join(moved, "customer_key", "left_semi").select(_month_of("date_key")).distinct().collect()}
    return {int(m) for m in months if m is not None}


def unsettled_months(lake: Lake) -> list[tuple[int, int]]:
    """Months reached by changed dimensions whose bills and marts no refresh has rebuilt, and when each was noted."""
    if not lake.exists(REACHED):
        return []
    pending = lake.read(REACHED)
    if lake.exists(REACHED_DONE):
        pending = pending.join(lake.read(REACHED_DONE), ["month", "noted"], "left_anti")
    return [(m.month, m.noted) for m in pending.collect()]


def build_dimensions(lake: Lake, fresh_readings: DataFrame) -> set[int]:
    """Dimensions: members seen in this refresh are merged, all others keep their rows and keys.

    Returns the months of earlier facts that the changes reach, those of runs that died included.
    """
    fresh_readings = not_older(fresh_readings, lake.read_or_none("silver.dim_meter"))
    tariff = lake.read("bronze.bronze_tariff")
    last = silver.last_readings(fresh_readings)
    customers, meters = side_by_side(
        [
            partial(silver.dim_customer, last, lake.read_or_none("silver.dim_customer")),
            partial(silver.dim_meter, last, lake.read_or_none("silver.dim_meter")),
        ]
    )
    frames = {
        "silver.dim_customer": customers,
        "silver.dim_meter": meters,
        "silver.dim_tariff": rating.dim_tariff(tariff),
        "silver.tariff_schedule": rating.tariff_schedule(tariff),
    }
    if not lake.exists("silver.dim_date"):
        frames["silver.dim_date"] = calendar.date_dimension(lake.spark)
    reached = changed_months(lake, frames["silver.tariff_schedule"], customers)
    if reached:  # noted first: once the dimensions are merged, nothing else tells which months are stale
        noted = time.time_ns() // 1000
        lake.append(REACHED, lake.spark.createDataFrame([(month, noted) for month in sorted(reached)], REACHED_ID))
    load_all(lake, frames)
    return {month for month, _ in unsettled_months(lake)}


def build_facts(lake: Lake, fresh: dict[str, DataFrame], reached: set[int] = frozenset()) -> dict[str, DataFrame]:
    """Facts from the bronze rows that have not reached them, then the bills of every month that they or changed dimensions touch."""
    customers, meters = lake.read("silver.dim_customer"), lake.read("silver.dim_meter")
    built = {
        "silver.fact_consumption": silver.fact_consumption(
            fresh["bronze.bronze_meter_readings"], customers, meters, single=False
        ),
        "silver.fact_weather": silver.fact_weather(fresh["bronze.bronze_weather"], single=False),
        "silver.fact_eia_demand": silver.fact_demand(fresh["bronze.bronze_eia"], single=False),
        "silver.fact_feeder_readings": silver.fact_feeder_readings(fresh["bronze.bronze_feeder_readings"]),
        "silver.fact_meter_events": silver.fact_meter_events(fresh["bronze.bronze_meter_events"]),
    }
    batches = load_all(lake, built)
    consumption = lake.read("silver.fact_consumption")
    touched = {d // 100 for d in _members("date_key", batches["silver.fact_consumption"])} | reached
    months = consumption.filter(_month_of("date_key").isin(*touched)) if touched else consumption.limit(0)
    schedule = lake.read("silver.tariff_schedule")
    half_hour = F.col("tariff_half_hour")
    schedule = schedule.filter((F.year(half_hour) * 100 + F.month(half_hour)).isin(*touched)) if touched else schedule
    bills = rating.bill(months, customers, meters, schedule)
    batches["silver.fact_billing"] = load(lake, "silver.fact_billing", bills)
    return batches


def build_marts(lake: Lake, fresh: dict[str, DataFrame], reached: set[int] = frozenset()) -> None:
    """Gold marts of the touched days and months; changed dimensions reach revenue and theft of earlier months."""
    days = _members("date_key", fresh["silver.fact_consumption"])
    weather_days = _members("date_key", fresh["silver.fact_weather"])
    consumption, weather = lake.read("silver.fact_consumption"), lake.read("silver.fact_weather")
    bills, periods = lake.read("silver.fact_billing"), _members("billing_period", fresh["silver.fact_billing"])
    frames = {}
    if days:
        frames["gold.gold_peak_load"] = marts.peak_load(consumption.filter(F.col("date_key").isin(*days)))
    if touched_months := {d // 100 for d in days} | reached:
        months = consumption.filter(_month_of("date_key").isin(*touched_months))
        frames["gold.gold_theft_detection"] = marts.theft_detection(months, lake.read("silver.dim_customer"))
    if periods:
        touched = bills.filter(F.col("billing_period").isin(*periods))
        frames["gold.gold_revenue_summary"] = marts.revenue_summary(touched)
    if {*days, *weather_days}:
        touched = F.col("date_key").isin(*{*days, *weather_days})
        frames["gold.gold_weather_impact"] = marts.weather_impact(consumption.filter(touched), weather.filter(touched))
    load_all(lake, frames)


def refresh(lake: Lake, raw: RawInputs, run_id: str = "manual", started: datetime | None = None) -> None:
    """Land, build and audit everything once; safe to repeat with the same or overlapping input.

    What it stages on the way is dropped when the tables hold it.
    """
    with released(lake.spark):
        _refresh(lake, raw, run_id, started or datetime.now())


def _refresh(lake: Lake, raw: RawInputs, run_id: str, started: datetime) -> None:
    loads = land_tables(lake, raw)
    fresh, batches = unbuilt_batches(lake)
    reached = build_dimensions(lake, fresh["bronze.bronze_meter_readings"])
    build_marts(lake, build_facts(lake, fresh, reached), reached)
    if months := unsettled_months(lake):
        lake.append(REACHED_DONE, lake.spark.createDataFrame(months, REACHED_ID))
    if batches:
        lake.append(BATCHES_DONE, lake.spark.createDataFrame(batches, BATCH_ID))
    if loads:  # recorded when all tables hold them: a run that dies earlier leaves its loads to the next one
        lake.append(LOADS, lake.spark.createDataFrame(loads, "root string, _load_id string"))
    lake.append(LINEAGE, audit.lineage_snapshot(lake.spark, lake.schemas, run_id, started))
