"""Query registry and the SQL building blocks the checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its check SQL unless it is not expressible in SQL."""

    def register(fn: Query) -> Query:
        _queries[name] = fn
        if sql is not None:
            _oracles[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


def r6(c: Column | str) -> Column:
    """Six decimals: sums of doubles differ in the last bits with the order of addition.

    The nudge moves means off exact decimal ties, which engines round differently.
    """
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6)




# --- SQL fragments ---------------------------------------------------------------------------------------------------


def sql_padded(prefix: str, key: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"('{prefix}' || CASE WHEN length({text}) >= 6 THEN {text} ELSE lpad({text}, 6, '0') END)"


def sql_hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def sql_date_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


CUSTOMER_REGIONS = f"""customer_regions AS (
  SELECT c_custkey AS user_id, {sql_padded('MAC', 'c_custkey')} AS "LCLid",
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'Std'
              WHEN c_mktsegment IS NOT NULL THEN 'ToU' END AS "stdorToU",
         r_name AS region
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

READINGS = f"""{CUSTOMER_REGIONS}, readings AS (
  SELECT {sql_padded('MAC', 'e.user_id')} AS "LCLid", c."stdorToU",
         strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') AS "DateTime",
         CASE WHEN e.event_type = 'error' THEN 'Null' ELSE CAST(e.value AS VARCHAR) END AS kwh_hh, c.region
  FROM events e LEFT JOIN customer_regions c ON e.user_id = c.user_id)"""

DIMENSIONS = f"""{READINGS}, latest AS (
  SELECT * FROM readings WHERE "LCLid" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY "LCLid" ORDER BY "DateTime" DESC, "stdorToU", region, kwh_hh) = 1),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY "LCLid") AS customer_key, "LCLid", "stdorToU" AS customer_type,
         CASE WHEN "stdorToU" = 'Std' THEN 'TAR001' ELSE 'TAR002' END AS tariff_id, 'ACTIVE' AS status, region
  FROM latest),
dim_customer_ids AS (
  SELECT customer_key, {sql_padded('CUST', 'customer_key')} AS customer_id, "LCLid", customer_type, tariff_id, status,
         region FROM dim_customer),
dim_meter AS (
  SELECT row_number() OVER (ORDER BY "LCLid") AS meter_key, "LCLid", "stdorToU", "DateTime", kwh_hh FROM latest),
dim_meter_ids AS (SELECT *, {sql_padded('MTR', 'meter_key')} AS meter_id FROM dim_meter)"""

CONSUMPTION = f"""{DIMENSIONS}, typed AS (
  SELECT "LCLid" || '_' || "DateTime" AS consumption_business_key, "LCLid",
         CAST("DateTime" AS TIMESTAMP) AS reading_timestamp, TRY_CAST(kwh_hh AS DOUBLE) AS consumption_kwh
  FROM readings WHERE "LCLid" IS NOT NULL AND TRY_CAST(kwh_hh AS DOUBLE) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY "LCLid", "DateTime" ORDER BY TRY_CAST(kwh_hh AS DOUBLE)) = 1),
consumption AS (
  SELECT t.consumption_business_key, c.customer_key, m.meter_key,
         {sql_date_key('t.reading_timestamp')} AS date_key,
         t.reading_timestamp, t.consumption_kwh, c.region
  FROM typed t LEFT JOIN dim_customer c ON t."LCLid" = c."LCLid" LEFT JOIN dim_meter m ON t."LCLid" = m."LCLid")"""

TARIFF_ENTRIES = """days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
halves AS (SELECT CAST(day AS TIMESTAMP) + to_minutes(CAST(30 * i AS INTEGER)) AS "TariffDateTime"
           FROM days, range(48) AS t(i)),
tariff_entries AS (
  SELECT "TariffDateTime", CASE WHEN hour("TariffDateTime") < 7 THEN 'Low'
    WHEN hour("TariffDateTime") BETWEEN 17 AND 20 AND dayofweek("TariffDateTime") = 0 THEN 'Critical'
    WHEN hour("TariffDateTime") BETWEEN 17 AND 20 THEN 'High' ELSE 'Normal' END AS "Tariff" FROM halves),
schedule AS (
  SELECT "TariffDateTime" AS tariff_half_hour, "Tariff" AS tariff_name,
    CASE "Tariff" WHEN 'Normal' THEN 'TAR001' WHEN 'Low' THEN 'TAR002' WHEN 'High' THEN 'TAR003' ELSE 'TAR000' END
      AS tariff_id,
    CASE "Tariff" WHEN 'Normal' THEN 0.15::DOUBLE WHEN 'Low' THEN 0.08::DOUBLE WHEN 'High' THEN 0.25::DOUBLE
      ELSE 0.0::DOUBLE END AS rate_per_kwh FROM tariff_entries)"""

BILLING = f"""{CONSUMPTION}, {TARIFF_ENTRIES}, rated AS (
  SELECT f.*, c.customer_id, c.customer_type, c.tariff_id, m.meter_id, s.rate_per_kwh AS schedule_rate,
         CASE WHEN c.customer_type = 'Std' THEN 0.15::DOUBLE ELSE s.rate_per_kwh END AS applied_rate_per_kwh
  FROM consumption f LEFT JOIN dim_customer_ids c ON f.customer_key = c.customer_key
  LEFT JOIN dim_meter_ids m ON f.meter_key = m.meter_key
  LEFT JOIN schedule s ON time_bucket(INTERVAL 30 MINUTE, f.reading_timestamp) = s.tariff_half_hour),
billing AS (
  SELECT customer_id || '_' || meter_id || '_' || strftime(reading_timestamp, '%Y-%m') AS billing_business_key,
         'BILL' || customer_id || '_' || strftime(reading_timestamp, '%Y-%m') AS bill_id,
         customer_key, meter_key, tariff_id, customer_id, meter_id,
         strftime(reading_timestamp, '%Y-%m') AS billing_period,
         sum(consumption_kwh) AS consumption_kwh, sum(consumption_kwh * applied_rate_per_kwh) AS bill_amount,
         'CALCULATED' AS billing_status, region, 'BILLING_ENGINE' AS source_system
  FROM rated GROUP BY customer_key, meter_key, customer_id, meter_id, strftime(reading_timestamp, '%Y-%m'), tariff_id,
         region)"""

WEATHER = """weather AS (
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS "timestamp", max(value) / 10 - 10 AS temperature,
         (count(*) * 7) % 101 AS humidity, max(value) / 4 AS wind_speed, count(*) / 8 AS precipitation
  FROM events GROUP BY date_trunc('hour', ts))"""

FACT_WEATHER = f"""{WEATHER}, fact_weather AS (
  SELECT strftime(CAST("timestamp" AS TIMESTAMP), '%Y%m%d_%H') AS weather_business_key,
         {sql_date_key('CAST("timestamp" AS TIMESTAMP)')} AS date_key,
         CAST("timestamp" AS TIMESTAMP) AS weather_timestamp,
         CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour_of_day,
         CAST(temperature AS DOUBLE) AS temperature_c, CAST(humidity AS DOUBLE) AS humidity_pct,
         CAST(wind_speed AS DOUBLE) AS wind_speed_kmh, CAST(precipitation AS DOUBLE) AS precipitation_mm FROM weather)"""

DEMAND = """demand AS (
  SELECT strftime(o_orderdate, '%Y-%m-%dT%H') AS period, o_orderpriority AS respondent,
         'Priority ' || o_orderpriority AS "respondent-name", o_orderstatus AS type,
         'Status ' || o_orderstatus AS "type-name", CAST(o_totalprice AS VARCHAR) AS value,
         'megawatthours' AS "value-units" FROM orders)"""
