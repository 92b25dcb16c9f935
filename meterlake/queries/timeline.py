"""As-of lookups, gap filling, histories and aggregates that follow from deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.functions.scalars import date_key, month_period
from meterlake.operators import asof, grid, rating, scd, states
from meterlake.operators.lookups import lookup_join
from meterlake.plans import bronze, mapping, silver
from meterlake.queries.facts import RATED_COLUMNS, consumption, typed_readings
from meterlake.queries.registry import BILLING, CUSTOMER_REGIONS, query, r6
from meterlake.sources.staging import stage

# --- as-of ------------------------------------------------------------------------------------------------------------

ORDER_CHANGES_SQL = """changes AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(
      date_diff('day', TIMESTAMP '1995-01-01 00:00:00', o_orderdate) * 1080 + o_orderkey % 1080 AS BIGINT)) AS since,
    min(o_totalprice / 1000000) AS rate_per_kwh FROM orders GROUP BY 1)"""


def order_changes(spark, sf_dir):
    """Every order sets the rate from some second of the month on: the years of orders, pressed into the days of events."""
    seconds = F.expr("datediff(o_orderdate, DATE '1995-01-01') * 1080 + o_orderkey % 1080")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return mapping.table(spark, sf_dir, "orders").select(
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("tariff_half_hour"),
        (F.col("o_totalprice") / 1_000_000).alias("rate_per_kwh"),
    )


@query(
    "rate_asof_any",
    f"""WITH {BILLING}, {ORDER_CHANGES_SQL},
      f AS (SELECT k.*, c.customer_type FROM consumption k LEFT JOIN dim_customer c ON k.customer_key = c.customer_key)
      SELECT consumption_business_key, customer_type,
        CASE WHEN customer_type = 'Std' THEN 0.15::DOUBLE ELSE s.rate_per_kwh END AS applied_rate_per_kwh,
        round(consumption_kwh * CASE WHEN customer_type = 'Std' THEN 0.15::DOUBLE ELSE s.rate_per_kwh END + 1e-9, 6)
          AS half_hour_cost
      FROM f ASOF LEFT JOIN changes s ON f.reading_timestamp >= s.since""",
)
def rate_asof_any(spark, sf_dir):
    """Readings rated by change points at arbitrary seconds."""
    fact, customers, _ = consumption(spark, sf_dir)
    readings = stage(typed_readings(fact, customers), "typed")
    rated = rating.rate_readings(readings, order_changes(spark, sf_dir), asof=True)
    return rated.select(*RATED_COLUMNS, r6("half_hour_cost").alias("half_hour_cost"))


# --- gap filling ------------------------------------------------------------------------------------------------------

UNPLACED = "UNPLACED"  # events of users that are no customers
HOURLY_SQL = f"""{CUSTOMER_REGIONS}, placed AS (
    SELECT date_trunc('hour', ts) AS slot, coalesce(region, '{UNPLACED}') AS region, value
    FROM events LEFT JOIN customer_regions USING (user_id)),
  hourly AS (SELECT slot, region, round(sum(value), 2) AS total, max(value) AS top FROM placed GROUP BY 1, 2),
  members AS (SELECT r_name AS region FROM region UNION ALL SELECT '{UNPLACED}'),
  slots AS (SELECT DISTINCT date_trunc('hour', ts) AS slot FROM events),
  filled AS (
    SELECT slot, region,
      last_value(total IGNORE NULLS) OVER w AS total, last_value(top IGNORE NULLS) OVER w AS top,
      last_value(CASE WHEN total IS NOT NULL THEN slot END IGNORE NULLS) OVER w AS measured_slot
    FROM slots CROSS JOIN members LEFT JOIN hourly USING (slot, region)
    WINDOW w AS (PARTITION BY region ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def hourly_by_region(spark, sf_dir):
    """slot, region, total, top of the hours and regions that have events."""
    places = mapping.customer_regions(spark, sf_dir).select("user_id", "region")
    events = mapping.table(spark, sf_dir, "events").select("user_id", "ts", "value")
    placed = lookup_join(events, places, "user_id", sized_by=mapping.table(spark, sf_dir, "customer"))
    slot = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot")
    placed = placed.groupBy(slot, F.coalesce("region", F.lit(UNPLACED)).alias("region"))
    return placed.agg(F.round(F.sum("value"), 2).alias("total"), F.max("value").alias("top"))


def filled_hours(spark, sf_dir):
    """Every hour with events for every region (of which there are five at any scale factor), carried over empty hours."""
    regions = [(row.r_name,) for row in mapping.table(spark, sf_dir, "region").select("r_name").collect()]
    hourly = stage(hourly_by_region(spark, sf_dir), "hourly")
    return asof.densify_carry(hourly, hourly.select("slot").distinct(), [*regions, (UNPLACED,)], ["region"], "slot")


@query("densify_carry", f"WITH {HOURLY_SQL} SELECT slot, region, total, top, measured_slot FROM filled")
def densify_carry(spark, sf_dir):
    return filled_hours(spark, sf_dir)


FEEDER_SQL = f"""{HOURLY_SQL}, feeders AS (
  SELECT 'FDR_' || region AS feeder_id, 'SUB_' || region AS substation_id, strftime(slot, '%Y-%m-%d %H:%M:%S') AS "DateTime",
    top AS voltage_v, total AS current_a, round(top * total * 0.95::DOUBLE / 1000.0::DOUBLE, 3) AS active_power_kw FROM filled)"""


def feeder_telemetry(spark, sf_dir):
    """Feeder records of every hour: the regions as feeders, their largest and summed event values as volts and amps."""
    return filled_hours(spark, sf_dir).select(
        F.concat(F.lit("FDR_"), "region").alias("feeder_id"),
        F.concat(F.lit("SUB_"), "region").alias("substation_id"),
        F.date_format("slot", "yyyy-MM-dd HH:mm:ss").alias("DateTime"),
        F.col("top").cast("string").alias("voltage_v"),
        F.col("total").cast("string").alias("current_a"),
    )


@query("feeder_grid", f"WITH {FEEDER_SQL} SELECT *, 'SCADA_GRID_MONITOR' AS source_system FROM feeders")
def feeder_grid(spark, sf_dir):
    return bronze.bronze_feeder_readings(feeder_telemetry(spark, sf_dir))


@query(
    "fact_feeder",
    f"""WITH {FEEDER_SQL}, typed AS (SELECT *, CAST("DateTime" AS TIMESTAMP) AS reading_timestamp FROM feeders)
      SELECT feeder_id, substation_id, reading_timestamp, voltage_v, current_a, active_power_kw,
        'SCADA_GRID_MONITOR' AS source_system, CAST(reading_timestamp AS DATE) AS reading_date,
        CAST(hour(reading_timestamp) AS INTEGER) AS reading_hour FROM typed""",
)
def fact_feeder(spark, sf_dir):
    """Telemetry with untidy ids, delivered twice."""
    untidy = feeder_grid(spark, sf_dir).withColumn("feeder_id", F.concat(F.lit(" "), F.lower("feeder_id")))
    return silver.fact_feeder_readings(grid.multiply_rows(untidy, 2).drop("copy_no"))


# --- history ----------------------------------------------------------------------------------------------------------

TIER = "CASE WHEN {0} >= 500000 THEN 'GOLD' WHEN {0} >= 200000 THEN 'SILVER' WHEN {0} IS NOT NULL THEN 'BASIC' ELSE 'NONE' END"


@query(
    "scd2_sequence",
    f"""WITH {CUSTOMER_REGIONS}, years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
      calendar AS (SELECT y, make_timestamp(y + 1, 1, 1, 0, 0, 0) AS dated, row_number() OVER (ORDER BY y) AS n,
        lead(make_timestamp(y + 1, 1, 1, 0, 0, 0)) OVER (ORDER BY y) AS next FROM years),
      sums AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2),
      snapshots AS (
        SELECT "LCLid", region, {TIER.format('total')} AS tier, n, dated, next
        FROM customer_regions JOIN sums ON o_custkey = user_id JOIN calendar USING (y)
        UNION ALL SELECT "LCLid", region, 'NONE', n, dated, next FROM customer_regions, calendar
        WHERE user_id NOT IN (SELECT o_custkey FROM orders)),
      marked AS (SELECT *, CASE WHEN lag(n) OVER k = n - 1 AND lag(tier) OVER k = tier AND lag(region) OVER k IS NOT DISTINCT FROM region
          THEN 0 ELSE 1 END AS fresh FROM snapshots WINDOW k AS (PARTITION BY "LCLid" ORDER BY n)),
      islands AS (SELECT *, sum(fresh) OVER (PARTITION BY "LCLid" ORDER BY n) AS island FROM marked),
      ends AS (SELECT "LCLid", region, tier, min(dated) AS valid_from, max(n) AS n FROM islands GROUP BY "LCLid", region, tier, island)
      SELECT "LCLid", region, tier, valid_from, next AS valid_to, next IS NULL AS is_current FROM ends JOIN calendar USING (n)""",
)
def scd2_sequence(spark, sf_dir):
    return yearly_history(spark, sf_dir)


def yearly_snapshots(spark, sf_dir):
    """All customers at the end of every year of orders, with the tier of that year's orders.

    Who orders nothing in a year is missing from its snapshot and may return; who never orders is in all of them.
    """
    orders = mapping.table(spark, sf_dir, "orders")
    members = mapping.customer_regions(spark, sf_dir).select(F.col("user_id").alias("o_custkey"), "LCLid", "region")
    sums = orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("total"))
    years = orders.select(F.year("o_orderdate").alias("y")).distinct().agg(F.collect_list("y").alias("years"))
    never = members.join(orders.select("o_custkey"), "o_custkey", "left_anti").withColumn("total", F.lit(None).cast("double"))
    calendar = years.first().years  # one number per calendar year
    never = never.withColumn("y", F.explode(F.lit(calendar).cast("array<int>")))
    rows = members.join(sums, "o_custkey").unionByName(never)
    at = F.make_timestamp_ntz(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return rows.select("LCLid", "region", F.expr(TIER.format("total")).alias("tier"), at.alias("at"))


def yearly_history(spark, sf_dir):
    return scd.scd2_sequence(stage(yearly_snapshots(spark, sf_dir), "snapshots"), ["LCLid"], "at")


# --- aggregates kept by deliveries ------------------------------------------------------------------------------------


def deliveries(spark, sf_dir):
    """Two deliveries of readings: all but sign-ups; then the late sign-ups, errors at half their value, purchases again."""
    event = F.col("event_type")
    all_events = mapping.table(spark, sf_dir, "events").select(
        "event_id", event, date_key("ts").alias("date_key"), F.hour("ts").alias("hour_of_day"), F.col("value").alias("kwh")
    )
    first = all_events.where(event != "signup")
    halved = F.when(event == "error", F.col("kwh") / 2).otherwise(F.col("kwh"))
    second = all_events.where(event.isin("signup", "error", "purchase")).withColumn("kwh", halved)
    return stage(first.drop("event_type"), "first"), stage(second.drop("event_type"), "second")


@query(
    "peak_load_delta",
    """WITH final AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour(ts) AS INTEGER) AS hour_of_day,
        CASE WHEN event_type = 'error' THEN value / 2 ELSE value END AS kwh FROM events)
      SELECT date_key, hour_of_day, count(kwh) AS reading_count, round(sum(kwh) + 1e-9, 6) AS total_consumption_kwh,
        round(avg(kwh) + 1e-9, 6) AS avg_consumption_kwh, max(kwh) AS max_meter_consumption_kwh FROM final GROUP BY 1, 2""",
)
def peak_load_delta(spark, sf_dir):
    """The hourly load of the first delivery, carried on to the second by what changed."""
    slot = ["date_key", "hour_of_day"]
    first, second = deliveries(spark, sf_dir)
    gone, come = states.changes_of(first, second, ["event_id"])
    now = first.join(second.select("event_id"), "event_id", "left_anti").unionByName(second)
    state = stage(states.load_state(first, slot, "kwh"), "load-state")
    state = states.apply_load(state, gone, come, now, slot, "kwh")
    return state.select(
        *slot,
        F.col("n").alias("reading_count"),
        r6("total").alias("total_consumption_kwh"),
        r6(F.col("total") / F.col("n")).alias("avg_consumption_kwh"),
        F.col("top").alias("max_meter_consumption_kwh"),
    )


@query(
    "peer_moments",
    """WITH final AS (SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, c_mktsegment AS peers, o_custkey,
        sum(o_totalprice) / 1000000 AS kwh FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3)
      SELECT billing_period, peers, count(*) AS n, round(avg(kwh) + 1e-9, 6) AS peer_avg, round(stddev_pop(kwh) + 1e-9, 6) AS peer_stddev
      FROM final GROUP BY 1, 2""",
)
def peer_moments(spark, sf_dir):
    """Peer statistics over monthly totals: first without the pending orders, then with the totals that these replace."""
    group, member = ["billing_period", "peers"], ["billing_period", "peers", "o_custkey"]
    peers = mapping.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("peers"))
    orders = mapping.table(spark, sf_dir, "orders").withColumn("billing_period", month_period("o_orderdate"))
    orders = stage(lookup_join(orders, peers, "o_custkey").select(*member, "o_orderstatus", "o_totalprice"), "orders")

    def totals(df):
        return df.groupBy(*member).agg((F.sum("o_totalprice") / 1_000_000).alias("kwh"))

    pending = F.col("o_orderstatus") == "P"
    held = stage(totals(orders.where(~pending)), "held")
    touched = orders.where(pending).select("billing_period", "o_custkey").distinct()
    delivered = stage(totals(orders.join(touched.hint("merge"), ["billing_period", "o_custkey"], "left_semi")), "delivered")
    gone, come = states.changes_of(held, delivered, ["billing_period", "o_custkey"])
    state = stage(states.moments(held, group, "kwh"), "moments")
    state = states.apply_moments(state, gone, come, group, "kwh")
    return state.select(*group, "n", r6("mean").alias("peer_avg"), r6(states.spread(state)).alias("peer_stddev"))


@query(
    "revenue_sketch",
    """SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, count(DISTINCT o_custkey) AS customer_count, true AS estimate_fits
      FROM orders GROUP BY 1""",
)
def revenue_sketch(spark, sf_dir):
    """Distinct customers of each month from sketches stored per day, next to the exact count they stand for."""
    orders = mapping.table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    daily = stage(states.distinct_sketches(orders, ["day"], ["o_custkey"]), "sketches")
    period = month_period("day").alias("billing_period")
    monthly = states.united(daily.withColumn("billing_period", period), ["billing_period"], ["o_custkey"])
    exact = orders.groupBy(period).agg(F.countDistinct("o_custkey").alias("customer_count"))
    fits = F.abs(F.col("o_custkey_count") - F.col("customer_count")) <= 0.05 * F.col("customer_count")
    return exact.join(monthly, "billing_period").select("billing_period", "customer_count", fits.alias("estimate_fits"))
