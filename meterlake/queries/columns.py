"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.functions import classify, scalars
from meterlake.operators import dedup, grid
from meterlake.plans import mapping, silver
from meterlake.queries.registry import CUSTOMER_REGIONS, DEMAND, READINGS, query, sql_hash

SEVERITY_SQL = """CASE WHEN kind IN ('MAGNETIC_INTERFERENCE', 'COVER_REMOVAL') THEN 'CRITICAL'
  WHEN kind = 'REVERSE_ENERGY_FLOW' THEN 'HIGH' ELSE 'MEDIUM' END"""
KIND_SQL = """(['MAGNETIC_INTERFERENCE', 'COVER_REMOVAL', 'REVERSE_ENERGY_FLOW', 'SEAL_BROKEN',
  'POWER_OUTAGE'])[CAST(user_id % 5 AS INTEGER) + 1]"""


@query(
    "standardize_names",
    f"""WITH {DEMAND} SELECT period, respondent, "respondent-name" AS respondent_name, type,
      "type-name" AS type_name, "value-units" AS value_units, value FROM demand""",
)
def standardize_names(spark, sf_dir):
    demand = mapping.demand(spark, sf_dir)
    return demand.select([F.col(f"`{c}`").alias(c.replace("-", "_")) for c in demand.columns])


@query(
    "clean_readings",
    f"""WITH {READINGS} SELECT "LCLid", "DateTime", TRY_CAST(kwh_hh AS DOUBLE) AS consumption_kwh FROM readings
      WHERE "LCLid" IS NOT NULL AND TRY_CAST(kwh_hh AS DOUBLE) IS NOT NULL""",
)
def clean_readings(spark, sf_dir):
    return silver.clean_readings(mapping.readings(spark, sf_dir)).select("LCLid", "DateTime", "consumption_kwh")


@query(
    "hash_sample",
    f"""WITH {READINGS} SELECT DISTINCT "LCLid", "DateTime" FROM readings
      WHERE {sql_hash('''"LCLid" || '|' || "DateTime"''')} % 100 < 5""",
)
def hash_sample(spark, sf_dir):
    pairs = mapping.readings(spark, sf_dir).select("LCLid", "DateTime").distinct()
    return dedup.hash_sample(pairs, ["LCLid", "DateTime"], 5, 100)


@query(
    "classify_severity",
    f"""WITH k AS (SELECT {KIND_SQL} AS kind FROM events)
      SELECT kind AS event_type, {SEVERITY_SQL} AS severity, count(*) AS n FROM k GROUP BY ALL""",
)
def classify_severity(spark, sf_dir):
    kind = scalars.pick(classify.EVENT_TYPES, F.pmod("user_id", F.lit(5)) + 1)
    typed = mapping.table(spark, sf_dir, "events").select(kind.alias("event_type"))
    rated = typed.withColumn("severity", classify.severity(F.col("event_type")))
    return rated.groupBy("event_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("categorical_pick", f"SELECT event_id, {KIND_SQL} AS picked FROM events")
def categorical_pick(spark, sf_dir):
    picked = scalars.pick(classify.EVENT_TYPES, F.pmod("user_id", F.lit(5)) + 1)
    return mapping.table(spark, sf_dir, "events").select("event_id", picked.alias("picked"))


@query("row_multiplier", "SELECT event_id, CAST(i AS INTEGER) AS copy_no FROM events, range(1, 4) AS t(i)")
def row_multiplier(spark, sf_dir):
    return grid.multiply_rows(mapping.table(spark, sf_dir, "events").select("event_id"), 3)


@query(
    "business_keys",
    f"""WITH {CUSTOMER_REGIONS} SELECT user_id,
      "LCLid" || '_' || CASE WHEN region = 'ASIA' THEN NULL ELSE region END AS business_key FROM customer_regions""",
)
def business_keys(spark, sf_dir):
    place = F.when(F.col("region") != "ASIA", F.col("region"))
    customers = mapping.customer_regions(spark, sf_dir)
    return customers.select("user_id", scalars.business_key("LCLid", place).alias("business_key"))


@query(
    "standardize_strings",
    "SELECT event_id, upper(trim('  ' || event_type || ' ')) AS event_type FROM events",
)
def standardize_strings(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))
    return mapping.table(spark, sf_dir, "events").select("event_id", F.upper(F.trim(padded)).alias("event_type"))


@query(
    "typed_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS as_text, CAST(o_orderkey AS INTEGER) AS as_int,
      CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS as_double, CAST(o_orderdate AS DATE) AS as_date,
      CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS as_timestamp,
      CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS as_long, TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number
    FROM orders""",
)
def typed_cast(spark, sf_dir):
    return mapping.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.col("o_orderkey").cast("int").alias("as_int"),
        F.col("o_totalprice").cast("string").cast("double").alias("as_double"),
        F.col("o_orderdate").cast("date").alias("as_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("as_timestamp"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("as_long"),
        scalars.safe_number("o_orderpriority", "int").alias("not_a_number"),
    )


@query(
    "parse_timestamps",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS parsed,
      date_trunc('hour', ts) AS parsed_hour FROM events""",
)
def parse_timestamps(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(mapping.stamp("ts"))
    hour = F.date_format("ts", scalars.HOUR_PERIOD_PATTERN)
    return mapping.table(spark, sf_dir, "events").select(
        "event_id",
        scalars.safe_timestamp(text).alias("parsed"),
        scalars.safe_timestamp(hour, scalars.HOUR_PERIOD_PATTERN).alias("parsed_hour"),
    )


@query(
    "date_keys",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
      strftime(o_orderdate, '%Y-%m') AS period, CAST(hour(o_orderdate) AS INTEGER) AS hour_of_day,
      CAST(o_orderdate AS DATE) AS full_date FROM orders""",
)
def date_keys(spark, sf_dir):
    return mapping.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalars.date_key("o_orderdate").alias("date_key"),
        scalars.month_period("o_orderdate").alias("period"),
        F.hour("o_orderdate").alias("hour_of_day"),
        F.to_date("o_orderdate").alias("full_date"),
    )


@query(
    "interval_shift",
    "SELECT event_id, ts - to_days(CAST(user_id % 30 AS INTEGER)) AS event_timestamp FROM events",
)
def interval_shift(spark, sf_dir):
    shifted = scalars.shift_days_back("ts", F.pmod("user_id", F.lit(30)))
    return mapping.table(spark, sf_dir, "events").select("event_id", shifted.alias("event_timestamp"))


@query(
    "epoch_normalize",
    """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN date_trunc('millisecond', ts)
      ELSE date_trunc('second', ts) END AS started FROM events""",
)
def epoch_normalize(spark, sf_dir):
    instant = F.col("ts").cast("timestamp")
    epoch = F.when(F.col("event_type").isin("view", "click"), F.unix_millis(instant)).otherwise(F.unix_seconds(instant))
    started = scalars.epoch_to_timestamp(epoch).cast("timestamp_ntz")
    return mapping.table(spark, sf_dir, "events").select("event_id", started.alias("started"))


@query(
    "tariff_class_nullsafe",
    f"""WITH {CUSTOMER_REGIONS}, c AS (
        SELECT "LCLid", CASE WHEN region = 'ASIA' THEN NULL ELSE "stdorToU" END AS customer_type FROM customer_regions)
      SELECT "LCLid", CASE WHEN customer_type = 'Std' THEN 'TAR001' ELSE 'TAR002' END AS tariff_id,
        CASE WHEN customer_type IS NULL OR customer_type = 'Std' THEN 'TAR001' ELSE 'TAR002' END AS nullsafe_tariff_id
      FROM c""",
)
def tariff_class_nullsafe(spark, sf_dir):
    kind = F.when(F.col("region") != "ASIA", F.col("stdorToU"))
    return mapping.customer_regions(spark, sf_dir).select(
        "LCLid",
        classify.tariff_class(kind).alias("tariff_id"),
        classify.tariff_class(kind, null_safe=True).alias("nullsafe_tariff_id"),
    )
