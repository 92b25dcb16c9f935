"""Declared columns of every table.

Event times are zone-free wall-clock timestamps; load times are instants.  Surrogate keys are BIGINT throughout.
Every bronze and silver data table ends with the drift pair and the quality pair.
"""

from __future__ import annotations

DRIFT_PAIR = "schema_drift_detected BOOLEAN, schema_drift_columns STRING"
QUALITY_PAIR = "dq_passed BOOLEAN, dq_failed_checks STRING"
BOTH = f"{DRIFT_PAIR}, {QUALITY_PAIR}"
FILE_COLUMNS = (
    "source_file STRING, source_file_name STRING, source_file_size BIGINT, source_file_modification_time TIMESTAMP"
)

# The declared tables, their columns and types.
CONTRACTS = {
    "bronze.bronze_eia": "period STRING, respondent STRING, `respondent-name` STRING, type STRING, `type-name` STRING, "
    "value STRING, `value-units` STRING, _source_system STRING, _load_id STRING, _ingestion_ts TIMESTAMP, "
    f"load_ts TIMESTAMP, source_system STRING, {FILE_COLUMNS}, {BOTH}",
    "bronze.bronze_meter_readings": "LCLid STRING, stdorToU STRING, DateTime STRING, kwh_hh STRING, load_ts TIMESTAMP, "
    f"source_system STRING, {BOTH}, reading_date DATE",
    "bronze.bronze_tariff": "TariffDateTime TIMESTAMP_NTZ, Tariff STRING, load_ts TIMESTAMP, source_system STRING, "
    f"{FILE_COLUMNS}, {BOTH}",
    "bronze.bronze_weather": "humidity BIGINT, precipitation DOUBLE, temperature DOUBLE, wind_speed DOUBLE, "
    "timestamp STRING, _source_system STRING, _load_id STRING, _ingestion_ts TIMESTAMP, load_timestamp TIMESTAMP, "
    f"load_ts TIMESTAMP, source_system STRING, {FILE_COLUMNS}, {BOTH}",
    "bronze.bronze_feeder_readings": "feeder_id STRING, substation_id STRING, DateTime STRING, voltage_v DOUBLE, "
    f"current_a DOUBLE, active_power_kw DOUBLE, load_ts TIMESTAMP, source_system STRING, {BOTH}",
    "bronze.bronze_meter_events": "event_id STRING, LCLid STRING, event_type STRING, severity STRING, "
    f"event_timestamp TIMESTAMP_NTZ, load_ts TIMESTAMP, source_system STRING, {BOTH}",
    "silver.dim_customer": "customer_key BIGINT, customer_id STRING, LCLid STRING, customer_type STRING, "
    f"tariff_id STRING, status STRING, region STRING, load_ts TIMESTAMP, {BOTH}",
    "silver.dim_date": "full_date DATE, date_key INT, year INT, quarter INT, month INT, month_name STRING, day INT, "
    f"week_of_year INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN, {BOTH}",
    "silver.dim_meter": "meter_key BIGINT, meter_id STRING, LCLid STRING, stdorToU STRING, DateTime STRING, "
    "kwh_hh STRING, meter_type STRING, manufacturer STRING, status STRING, install_date STRING, region STRING, "
    f"load_ts TIMESTAMP, {BOTH}",
    "silver.dim_tariff": "tariff_key INT, tariff_id STRING, tariff_name STRING, tariff_description STRING, "
    f"rate_per_kwh DOUBLE, status STRING, region STRING, load_ts TIMESTAMP, tariff_half_hour TIMESTAMP_NTZ, {BOTH}",
    "silver.tariff_schedule": "tariff_half_hour TIMESTAMP_NTZ, tariff_name STRING, tariff_id STRING, "
    f"rate_per_kwh DOUBLE, load_ts TIMESTAMP, {BOTH}",
    "silver.fact_consumption": "consumption_business_key STRING, customer_key BIGINT, meter_key BIGINT, date_key INT, "
    f"reading_timestamp TIMESTAMP_NTZ, consumption_kwh DOUBLE, region STRING, load_ts TIMESTAMP, {BOTH}",
    "silver.fact_weather": "weather_business_key STRING, date_key INT, weather_timestamp TIMESTAMP_NTZ, "
    "hour_of_day INT, temperature_c DOUBLE, humidity_pct DOUBLE, wind_speed_kmh DOUBLE, precipitation_mm DOUBLE, "
    f"load_ts TIMESTAMP, {BOTH}",
    "silver.fact_eia_demand": "demand_business_key STRING, date_key INT, respondent STRING, respondent_name STRING, "
    "type STRING, type_name STRING, value_units STRING, demand_timestamp TIMESTAMP_NTZ, hour_of_day INT, "
    f"demand_mwh DOUBLE, load_ts TIMESTAMP, {BOTH}",
    "silver.fact_billing": "billing_business_key STRING, bill_id STRING, customer_key BIGINT, meter_key BIGINT, "
    "tariff_id STRING, customer_id STRING, meter_id STRING, billing_period STRING, consumption_kwh DOUBLE, "
    f"bill_amount DOUBLE, billing_status STRING, region STRING, load_ts TIMESTAMP, source_system STRING, {BOTH}",
    "silver.fact_feeder_readings": "feeder_id STRING, substation_id STRING, reading_timestamp TIMESTAMP_NTZ, "
    "reading_date DATE, reading_hour INT, voltage_v DOUBLE, current_a DOUBLE, active_power_kw DOUBLE, "
    f"source_system STRING, processed_ts TIMESTAMP, {BOTH}",
    "silver.fact_meter_events": "event_id STRING, LCLid STRING, event_type STRING, severity STRING, "
    "event_timestamp TIMESTAMP_NTZ, event_date DATE, event_hour INT, source_system STRING, processed_ts TIMESTAMP, "
    f"{BOTH}",
    "silver.dq_failures": "dq_table STRING, check_name STRING, check_type STRING, column_name STRING, "
    "failure_reason STRING, failed_value BIGINT, check_ts TIMESTAMP",
    "gold.gold_revenue_summary": "billing_period STRING, customer_count BIGINT, meter_count BIGINT, "
    "total_consumption_kwh DOUBLE, total_revenue DOUBLE, avg_consumption_kwh DOUBLE, avg_bill_amount DOUBLE, "
    f"load_ts TIMESTAMP, {QUALITY_PAIR}",
    "gold.gold_peak_load": "date_key INT, reading_date STRING, hour_of_day INT, reading_count BIGINT, "
    "total_consumption_kwh DOUBLE, avg_consumption_kwh DOUBLE, max_meter_consumption_kwh DOUBLE, load_ts TIMESTAMP, "
    f"{QUALITY_PAIR}",
    "gold.gold_theft_detection": "billing_period STRING, tariff_id STRING, customer_key BIGINT, LCLid STRING, "
    "consumption_kwh DOUBLE, peer_avg_consumption_kwh DOUBLE, peer_stddev_consumption_kwh DOUBLE, "
    f"variance_from_peer_kwh DOUBLE, theft_flag BOOLEAN, detection_reason STRING, load_ts TIMESTAMP, {QUALITY_PAIR}",
    "gold.gold_weather_impact": "date_key INT, hour_of_day INT, temperature_c DOUBLE, humidity_pct DOUBLE, "
    "wind_speed_kmh DOUBLE, precipitation_mm DOUBLE, total_consumption_kwh DOUBLE, avg_meter_consumption_kwh DOUBLE, "
    f"load_ts TIMESTAMP, {QUALITY_PAIR}",
    "audit.pipeline_lineage": "run_id STRING, run_ts TIMESTAMP, pipeline_start_ts TIMESTAMP, "
    "pipeline_end_ts TIMESTAMP, audit_task_start_ts TIMESTAMP, audit_ts TIMESTAMP, table_catalog STRING, "
    "table_schema STRING, table_name STRING, table_type STRING",
}
