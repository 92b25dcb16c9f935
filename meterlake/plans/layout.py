"""How each table is keyed, partitioned and checked.

Partition columns follow from the key (date of the timestamp, period of the bill), so the key alone identifies a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from meterlake.operators.quality import not_empty, not_null, unique, within


@dataclass(frozen=True)
class Layout:
    """Merge key, partition columns, quality checks and the name of the load-time column of one table.

    ``repeats`` marks batches that may hold a key more than once when they are checked; the merge then keeps the row
    with the highest ``latest_by``.  ``prune_by`` bounds the part of the target an insert-only merge reads.
    """

    keys: list[str]
    checks: list[dict]
    partition_by: list[str] = field(default_factory=list)
    load_column: str | None = "load_ts"
    drift: bool = True
    insert_only: bool = False
    repeats: bool = False
    latest_by: str | None = None
    prune_by: str | None = None


def _non_negative(column: str, name: str) -> dict:
    return within(column, min_val=0, name=f"{name}_non_negative")


# Check names, bounds and merge keys appear in the failure log and decide which rows replace which.
LAYOUTS = {
    "bronze.bronze_meter_readings": Layout(
        ["LCLid", "DateTime"],
        [not_null("LCLid"), not_null("DateTime"), not_null("kwh_hh"), unique("LCLid", "DateTime", name="reading_unique")],
        ["reading_date"],
    ),
    "bronze.bronze_weather": Layout(
        ["timestamp"],
        [
            not_null("timestamp"),
            within("humidity", 0, 100),
            within("temperature", -50, 60),
            _non_negative("wind_speed", "wind_speed"),
            _non_negative("precipitation", "precipitation"),
        ],
    ),
    "bronze.bronze_eia": Layout(
        ["period", "respondent", "type"],
        [not_null("period"), not_null("respondent"), not_null("type"), not_null("value")],
    ),
    "bronze.bronze_tariff": Layout(
        ["TariffDateTime", "Tariff"],
        [
            not_null("TariffDateTime", name="tariff_datetime_not_null"),
            not_null("Tariff"),
            unique("TariffDateTime", "Tariff", name="tariff_unique"),
        ],
        repeats=True,
    ),
    "bronze.bronze_feeder_readings": Layout(
        ["feeder_id", "DateTime"],
        [
            not_null("feeder_id"),
            not_null("DateTime"),
            not_null("active_power_kw", name="active_power_not_null"),
            unique("feeder_id", "DateTime", name="feeder_reading_unique"),
        ],
    ),
    "bronze.bronze_meter_events": Layout(
        ["LCLid", "event_timestamp", "event_id"],  # two events of a meter may fall on one moment
        [not_null("event_id"), not_null("LCLid"), not_null("event_timestamp"), unique("event_id")],
        insert_only=True,
        prune_by="event_timestamp",
    ),
    "silver.dim_customer": Layout(
        ["LCLid"],
        [
            not_null("customer_key"),
            not_null("customer_id"),
            not_null("LCLid"),
            unique("customer_key"),
            unique("LCLid"),
        ],
    ),
    "silver.dim_meter": Layout(
        ["LCLid"],
        [not_null("meter_key"), not_null("meter_id"), not_null("LCLid"), unique("meter_key"), unique("LCLid")],
    ),
    "silver.dim_tariff": Layout(
        ["tariff_name"],
        [
            not_null("tariff_key"),
            not_null("tariff_id"),
            not_null("tariff_name"),
            unique("tariff_key"),
            unique("tariff_id"),
        ],
    ),
    "silver.tariff_schedule": Layout(
        ["tariff_half_hour"], [not_null("tariff_half_hour"), not_null("rate_per_kwh"), unique("tariff_half_hour")]
    ),
    "silver.dim_date": Layout(
        ["date_key"], [not_null("date_key"), not_null("full_date"), unique("date_key")], load_column=None
    ),
    "silver.fact_consumption": Layout(
        ["consumption_business_key"],
        [
            not_null("consumption_business_key"),
            _non_negative("consumption_kwh", "consumption_kwh"),
            unique("consumption_business_key"),
        ],
        ["date_key"],
        repeats=True,
    ),
    "silver.fact_weather": Layout(
        ["weather_business_key"],
        [
            not_null("weather_business_key"),
            within("temperature_c", -50, 60, name="temperature_range"),
            within("humidity_pct", 0, 100, name="humidity_range"),
            _non_negative("wind_speed_kmh", "wind_speed"),
            unique("weather_business_key"),
        ],
        repeats=True,
        latest_by="weather_timestamp",
    ),
    "silver.fact_eia_demand": Layout(
        ["demand_business_key"],
        [
            not_null("demand_business_key"),
            not_null("respondent"),
            _non_negative("demand_mwh", "demand_mwh"),
            unique("demand_business_key"),
        ],
        ["date_key"],
        repeats=True,
    ),
    "silver.fact_billing": Layout(
        ["billing_business_key"],
        [
            not_null("billing_business_key"),
            not_null("bill_id"),
            _non_negative("consumption_kwh", "consumption"),
            _non_negative("bill_amount", "bill_amount"),
            unique("billing_business_key"),
        ],
        ["billing_period"],
    ),
    "silver.fact_feeder_readings": Layout(
        ["feeder_id", "reading_timestamp"],
        [
            not_null("feeder_id"),
            not_null("substation_id"),
            not_null("reading_timestamp"),
            not_null("active_power_kw", name="active_power_not_null"),
            unique("feeder_id", "reading_timestamp", name="feeder_reading_unique"),
        ],
        ["reading_date"],
        load_column="processed_ts",
    ),
    "silver.fact_meter_events": Layout(
        ["event_id"],
        [not_null("event_id"), not_null("LCLid"), not_null("event_timestamp"), unique("event_id")],
        ["event_date"],
        load_column="processed_ts",
    ),
    "gold.gold_revenue_summary": Layout(
        ["billing_period"],
        [
            not_empty("revenue_summary_not_empty"),
            not_null("billing_period"),
            unique("billing_period"),
            _non_negative("total_consumption_kwh", "total_consumption"),
            _non_negative("total_revenue", "total_revenue"),
        ],
        drift=False,
    ),
    "gold.gold_peak_load": Layout(
        ["date_key", "hour_of_day"],
        [
            not_empty("peak_load_not_empty"),
            not_null("date_key"),
            not_null("hour_of_day"),
            unique("date_key", "hour_of_day", name="peak_load_key_unique"),
            _non_negative("total_consumption_kwh", "total_consumption"),
        ],
        drift=False,
    ),
    "gold.gold_theft_detection": Layout(
        ["billing_period", "LCLid"],
        [
            not_empty("theft_detection_not_empty"),
            not_null("billing_period"),
            not_null("LCLid"),
            unique("billing_period", "LCLid", name="theft_detection_key_unique"),
            _non_negative("consumption_kwh", "consumption"),
        ],
        ["billing_period"],
        drift=False,
    ),
    "gold.gold_weather_impact": Layout(
        ["date_key", "hour_of_day"],
        [
            not_empty("weather_impact_not_empty"),
            not_null("date_key"),
            not_null("hour_of_day"),
            unique("date_key", "hour_of_day", name="weather_impact_key_unique"),
            within("temperature_c", -50, 60, name="temperature_range"),
            within("humidity_pct", 0, 100, name="humidity_range"),
            _non_negative("precipitation_mm", "precipitation"),
        ],
        drift=False,
    ),
}
