"""Bronze and silver tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from meterlake.functions import classify
from meterlake.operators import grid, rating
from meterlake.operators.lookups import lookup_join
from meterlake.plans import bronze, mapping, silver
from meterlake.queries.registry import (
    BILLING,
    CONSUMPTION,
    DEMAND,
    DIMENSIONS,
    FACT_WEATHER,
    READINGS,
    TARIFF_ENTRIES,
    WEATHER,
    query,
    r6,
)
from meterlake.sources.staging import side_by_side, stage


def consumption(spark, sf_dir):
    """The consumption fact and its dimensions.  The readings are staged: three consumers follow."""
    readings = stage(mapping.readings(spark, sf_dir), "readings")
    last = silver.last_readings(readings)
    customers, meters = side_by_side([partial(silver.dim_customer, last), partial(silver.dim_meter, last)])
    return silver.fact_consumption(readings, customers, meters), customers, meters


def stored_schedule(spark, sf_dir):
    """The schedule as a stored table: it is counted and then joined."""
    return stage(rating.tariff_schedule(mapping.tariff_entries(spark, sf_dir)), "schedule")


def consumption_and_schedule(spark, sf_dir):
    """The fact with its dimensions, and the schedule, built side by side."""
    return side_by_side([partial(consumption, spark, sf_dir), partial(stored_schedule, spark, sf_dir)])


@query("bronze_readings", f"WITH {READINGS} SELECT *, 'LONDON_SMART_METER' AS source_system FROM readings")
def bronze_readings(spark, sf_dir):
    """Every reading delivered twice, landed once."""
    twice = grid.multiply_rows(mapping.readings(spark, sf_dir), 2).drop("copy_no")
    return bronze.bronze_readings(twice)


@query("bronze_weather", f"WITH {WEATHER} SELECT *, 'WEATHER_API' AS source_system FROM weather")
def bronze_weather(spark, sf_dir):
    """Hours delivered by two loads: the later load wins."""
    loads = grid.multiply_rows(mapping.weather(spark, sf_dir), 2, "_load_id")
    stale = F.when(F.col("_load_id") == 1, F.col("temperature") - 50).otherwise(F.col("temperature"))
    return bronze.bronze_weather(loads.withColumn("temperature", stale)).drop("_load_id")


@query(
    "bronze_demand",
    f"""WITH {DEMAND} SELECT *, 'EIA_API' AS source_system FROM demand
      QUALIFY row_number() OVER (PARTITION BY period, respondent, type ORDER BY value) = 1""",
)
def bronze_demand(spark, sf_dir):
    return bronze.bronze_demand(mapping.demand(spark, sf_dir))


@query("tariff_schedule", f"WITH {TARIFF_ENTRIES} SELECT * FROM schedule")
def tariff_schedule(spark, sf_dir):
    return rating.tariff_schedule(bronze.bronze_tariff(mapping.tariff_entries(spark, sf_dir)))


@query(
    "dim_tariff",
    f"""WITH {TARIFF_ENTRIES} SELECT CAST(CASE tariff_id WHEN 'TAR001' THEN 1 WHEN 'TAR002' THEN 2 WHEN 'TAR003' THEN 3
        ELSE 0 END AS INTEGER) AS tariff_key, tariff_id, tariff_name,
      CASE tariff_id WHEN 'TAR001' THEN 'Standard rate tariff' WHEN 'TAR002' THEN 'Off-peak low rate tariff'
        WHEN 'TAR003' THEN 'Peak high rate tariff' ELSE 'Unknown tariff type' END AS tariff_description,
      rate_per_kwh, 'ACTIVE' AS status, 'LONDON' AS region, min(tariff_half_hour) AS tariff_half_hour
    FROM schedule GROUP BY tariff_id, tariff_name, rate_per_kwh""",
)
def dim_tariff(spark, sf_dir):
    return rating.dim_tariff(mapping.tariff_entries(spark, sf_dir))


@query(
    "fact_meter_events",
    """WITH raw AS (SELECT 'EVT_' || CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS "LCLid",
        upper(event_type) AS event_type, CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH'
          WHEN 'signup' THEN 'LOW' ELSE 'UNKNOWN' END AS severity, ts AS event_timestamp FROM events)
      SELECT *, 'HEADEND_3' AS source_system, CAST(event_timestamp AS DATE) AS event_date,
        CAST(hour(event_timestamp) AS INTEGER) AS event_hour FROM raw""",
)
def fact_meter_events(spark, sf_dir):
    """Each event delivered three times; the last load is kept."""
    kind = F.col("event_type")
    raw = grid.multiply_rows(mapping.table(spark, sf_dir, "events"), 3).select(
        F.concat(F.lit(" EVT_"), F.col("event_id").cast("string")).alias("event_id"),
        F.col("user_id").cast("string").alias("LCLid"),
        F.concat(kind, F.lit(" ")).alias("event_type"),
        classify.classify(
            kind, [(("error",), "critical"), (("purchase",), "High"), (("signup",), "low")], "odd"
        ).alias("severity"),
        F.col("ts").alias("event_timestamp"),
        F.concat(F.lit("HEADEND_"), F.col("copy_no").cast("string")).alias("source_system"),
        F.col("copy_no").alias("load_ts"),
    )
    return silver.fact_meter_events(raw)


@query("dim_customer", f"WITH {DIMENSIONS} SELECT * FROM dim_customer_ids")
def dim_customer(spark, sf_dir):
    return silver.dim_customer(stage(mapping.readings(spark, sf_dir), "readings"))


@query(
    "dim_meter",
    f"""WITH {DIMENSIONS} SELECT *, 'SMART' AS meter_type, 'LANDIS_GYR' AS manufacturer, 'ACTIVE' AS status,
      '2012-01-01' AS install_date, 'LONDON' AS region FROM dim_meter_ids""",
)
def dim_meter(spark, sf_dir):
    return silver.dim_meter(stage(mapping.readings(spark, sf_dir), "readings"))


@query("fact_consumption", f"WITH {CONSUMPTION} SELECT * FROM consumption")
def fact_consumption(spark, sf_dir):
    return consumption(spark, sf_dir)[0]


@query("fact_weather", f"WITH {FACT_WEATHER} SELECT * FROM fact_weather")
def fact_weather(spark, sf_dir):
    return silver.fact_weather(mapping.weather(spark, sf_dir))


@query(
    "fact_demand",
    f"""WITH {DEMAND} SELECT respondent || '_' || period || '_' || type AS demand_business_key,
      CAST(strftime(strptime(period, '%Y-%m-%dT%H'), '%Y%m%d') AS INTEGER) AS date_key, respondent,
      "respondent-name" AS respondent_name, type, "type-name" AS type_name, "value-units" AS value_units,
      strptime(period, '%Y-%m-%dT%H') AS demand_timestamp,
      CAST(hour(strptime(period, '%Y-%m-%dT%H')) AS INTEGER) AS hour_of_day, min(CAST(value AS DOUBLE)) AS demand_mwh
    FROM demand GROUP BY ALL""",
)
def fact_demand(spark, sf_dir):
    return silver.fact_demand(mapping.demand(spark, sf_dir))


def typed_readings(fact, customers):
    return lookup_join(fact, customers.select("customer_key", "customer_type"), "customer_key")


RATED_COLUMNS = ["consumption_business_key", "customer_type", "applied_rate_per_kwh"]
RATED_SQL = f"""WITH {BILLING} SELECT consumption_business_key, customer_type, applied_rate_per_kwh,
  round(consumption_kwh * applied_rate_per_kwh + 1e-9, 6) AS half_hour_cost FROM rated"""


@query("rate_readings", RATED_SQL)
def rate_readings(spark, sf_dir):
    (fact, customers, _), schedule = consumption_and_schedule(spark, sf_dir)
    rated = rating.rate_readings(typed_readings(fact, customers), schedule)
    return rated.select(*RATED_COLUMNS, r6("half_hour_cost").alias("half_hour_cost"))


@query(
    "rate_readings_asof",
    f"""WITH {BILLING}, changes AS (
        SELECT tariff_half_hour, rate_per_kwh FROM schedule
        WHERE minute(tariff_half_hour) = 0 AND hour(tariff_half_hour) IN (0, 7, 17, 21)),
      f AS (SELECT k.*, c.customer_type FROM consumption k LEFT JOIN dim_customer c ON k.customer_key = c.customer_key)
      SELECT consumption_business_key, customer_type,
        CASE WHEN customer_type = 'Std' THEN 0.15::DOUBLE ELSE s.rate_per_kwh END AS applied_rate_per_kwh,
        round(consumption_kwh * CASE WHEN customer_type = 'Std' THEN 0.15::DOUBLE ELSE s.rate_per_kwh END + 1e-9, 6)
          AS half_hour_cost
      FROM f ASOF LEFT JOIN changes s ON f.reading_timestamp >= s.tariff_half_hour""",
)
def rate_readings_asof(spark, sf_dir):
    """The schedule lists only the times the rate changes."""
    at = F.col("tariff_half_hour")
    (fact, customers, _), schedule = consumption_and_schedule(spark, sf_dir)
    changes = schedule.filter((F.minute(at) == 0) & F.hour(at).isin(0, 7, 17, 21))
    readings = stage(typed_readings(fact, customers), "typed")
    rated = rating.rate_readings(readings, changes.select("tariff_half_hour", "rate_per_kwh"), asof=True)
    return rated.select(*RATED_COLUMNS, r6("half_hour_cost").alias("half_hour_cost"))
