"""Billing and the gold marts."""

from __future__ import annotations


from meterlake.operators import marts, rating, security
from meterlake.plans import mapping, silver
from meterlake.queries.facts import consumption, consumption_and_schedule
from meterlake.queries.guards import READERS, READERS_SQL, per_reader
from meterlake.queries.registry import BILLING, CONSUMPTION, FACT_WEATHER, query, r6
from meterlake.sources.staging import stage


def rounded(df, *columns):
    return df.withColumns({c: r6(c) for c in columns})


def billing(spark, sf_dir):
    (fact, customers, meters), schedule = consumption_and_schedule(spark, sf_dir)
    return rating.bill(fact, customers, meters, schedule)


@query(
    "fact_billing",
    f"""WITH {BILLING} SELECT * REPLACE (round(consumption_kwh + 1e-9, 6) AS consumption_kwh,
      round(bill_amount + 1e-9, 6) AS bill_amount) FROM billing""",
)
def fact_billing(spark, sf_dir):
    return rounded(billing(spark, sf_dir), "consumption_kwh", "bill_amount")


@query(
    "billing_flat_rate",
    f"""WITH {CONSUMPTION}, m AS (SELECT customer_key, meter_key, strftime(reading_timestamp, '%Y-%m') AS billing_period,
        sum(consumption_kwh) AS kwh FROM consumption GROUP BY ALL)
      SELECT m.billing_period, c."LCLid", c.customer_id, d.meter_id, c.tariff_id, round(m.kwh + 1e-9, 6) AS consumption_kwh,
        CASE WHEN c.tariff_id = 'TAR002' THEN 0.18::DOUBLE ELSE 0.15::DOUBLE END AS rate_per_kwh,
        round(m.kwh * CASE WHEN c.tariff_id = 'TAR002' THEN 0.18::DOUBLE ELSE 0.15::DOUBLE END + 1e-9, 6) AS bill_amount
      FROM m LEFT JOIN dim_customer_ids c ON m.customer_key = c.customer_key
      LEFT JOIN dim_meter_ids d ON m.meter_key = d.meter_key""",
)
def billing_flat_rate(spark, sf_dir):
    bills = rounded(rating.bill_flat(*consumption(spark, sf_dir)), "consumption_kwh", "bill_amount")
    return bills.select(
        "billing_period",
        "LCLid",
        "customer_id",
        "meter_id",
        "tariff_id",
        "consumption_kwh",
        "rate_per_kwh",
        "bill_amount",
    )


REVENUE_SQL = f"""{BILLING}, revenue AS (SELECT billing_period, count(DISTINCT customer_key) AS customer_count,
  count(DISTINCT meter_key) AS meter_count, round(sum(consumption_kwh) + 1e-9, 6) AS total_consumption_kwh,
  round(sum(bill_amount) + 1e-9, 6) AS total_revenue, round(avg(consumption_kwh) + 1e-9, 6) AS avg_consumption_kwh,
  round(avg(bill_amount) + 1e-9, 6) AS avg_bill_amount FROM billing GROUP BY billing_period)"""
REVENUE_MEASURES = ["total_consumption_kwh", "total_revenue", "avg_consumption_kwh", "avg_bill_amount"]


@query("revenue_summary", f"WITH {REVENUE_SQL} SELECT * FROM revenue")
def revenue_summary(spark, sf_dir):
    return rounded(marts.revenue_summary(billing(spark, sf_dir)), *REVENUE_MEASURES)


@query(
    "secure_revenue",
    f"""WITH {REVENUE_SQL}, {READERS_SQL} SELECT * REPLACE (CASE WHEN reader <> 'guest' THEN total_revenue END AS
      total_revenue, CASE WHEN reader <> 'guest' THEN avg_bill_amount END AS avg_bill_amount) FROM revenue, readers""",
)
def secure_revenue(spark, sf_dir):
    revenue = stage(rounded(marts.revenue_summary(billing(spark, sf_dir)), *REVENUE_MEASURES), "revenue")
    return per_reader(READERS, lambda groups: security.secure_revenue(revenue, groups))


@query(
    "peak_load",
    f"""WITH {CONSUMPTION} SELECT date_key, strftime(reading_timestamp, '%Y-%m-%d') AS reading_date,
      CAST(hour(reading_timestamp) AS INTEGER) AS hour_of_day, count(consumption_business_key) AS reading_count,
      round(sum(consumption_kwh) + 1e-9, 6) AS total_consumption_kwh, round(avg(consumption_kwh) + 1e-9, 6) AS avg_consumption_kwh,
      max(consumption_kwh) AS max_meter_consumption_kwh FROM consumption GROUP BY 1, 2, 3""",
)
def peak_load(spark, sf_dir):
    load = marts.peak_load(consumption(spark, sf_dir)[0])
    return rounded(load, "total_consumption_kwh", "avg_consumption_kwh")


@query(
    "theft_detection",
    f"""WITH {CONSUMPTION}, monthly AS (
        SELECT strftime(k.reading_timestamp, '%Y-%m') AS billing_period, k.customer_key, c."LCLid", c.tariff_id,
          sum(k.consumption_kwh) AS kwh
        FROM consumption k LEFT JOIN dim_customer c ON k.customer_key = c.customer_key GROUP BY ALL),
      peers AS (SELECT billing_period, tariff_id, avg(kwh) AS mean, stddev_pop(kwh) AS sd FROM monthly GROUP BY ALL),
      j AS (SELECT m.*, mean, sd, coalesce(kwh < mean - 2 * sd AND kwh < mean * 0.5::DOUBLE, false) AS flag FROM monthly m
        LEFT JOIN peers p ON m.billing_period = p.billing_period AND m.tariff_id = p.tariff_id)
      SELECT billing_period, tariff_id, customer_key, "LCLid", round(kwh + 1e-9, 6) AS consumption_kwh,
        round(mean + 1e-9, 6) AS peer_avg_consumption_kwh, round(sd + 1e-9, 6) AS peer_stddev_consumption_kwh,
        round(kwh - mean, 6) AS variance_from_peer_kwh, flag AS theft_flag,
        CASE WHEN flag THEN 'Consumption is materially below tariff peer usage'
          ELSE 'Within expected tariff peer range' END AS detection_reason FROM j""",
)
def theft_detection(spark, sf_dir):
    fact, customers, _ = consumption(spark, sf_dir)
    return rounded(
        marts.theft_detection(fact, customers),
        "consumption_kwh",
        "peer_avg_consumption_kwh",
        "peer_stddev_consumption_kwh",
    )


@query(
    "weather_impact",
    f"""WITH {CONSUMPTION}, {FACT_WEATHER}, hourly AS (SELECT date_key,
        CAST(hour(reading_timestamp) AS INTEGER) AS hour_of_day, sum(consumption_kwh) AS total,
        avg(consumption_kwh) AS mean FROM consumption GROUP BY 1, 2)
      SELECT w.date_key, w.hour_of_day, temperature_c, humidity_pct, wind_speed_kmh, precipitation_mm,
        round(total + 1e-9, 6) AS total_consumption_kwh, round(mean + 1e-9, 6) AS avg_meter_consumption_kwh
      FROM fact_weather w LEFT JOIN hourly h ON w.date_key = h.date_key AND w.hour_of_day = h.hour_of_day""",
)
def weather_impact(spark, sf_dir):
    weather = silver.fact_weather(mapping.weather(spark, sf_dir))
    impact = marts.weather_impact(consumption(spark, sf_dir)[0], weather)
    return rounded(impact, "total_consumption_kwh", "avg_meter_consumption_kwh")
