"""Stored tables, the whole refresh, landed loads and the security views, each through a lake of its own.

A lake here has catalog names that nothing else has, and is taken out of the catalog when its query has staged its result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators import security
from meterlake.operators.tables import Lake
from meterlake.plans import bronze, mapping
from meterlake.plans.refresh import LOADS, RawInputs, refresh
from meterlake.queries.guards import READERS
from meterlake.queries.merges import DELIVERED_SQL, GAPPY_SQL, STORED_SQL, delivered_orders, gappy_facts, stored_orders
from meterlake.queries.registry import BILLING, CUSTOMER_REGIONS, query, r6
from meterlake.sources import landing, readers
from meterlake.sources.staging import stage, stage_path
from meterlake.streaming.ingest import ingest_readings


@contextmanager
def scratch_lake(spark) -> Iterator[Lake]:
    lake = Lake(spark, stage_path(spark, "lake"), prefix=f"q{uuid.uuid4().hex[:10]}_")
    try:
        yield lake
    finally:
        lake.forget()


# --- tables -----------------------------------------------------------------------------------------------------------


@query(
    "table_upsert",
    f"""WITH {STORED_SQL}, {DELIVERED_SQL}, merged AS (
        SELECT * FROM stored WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delivered)
        UNION ALL SELECT o_orderkey, o_totalprice, 'R' FROM delivered)
      SELECT m.*, CAST(year(o_orderdate) AS INTEGER) AS order_year, kind FROM merged m JOIN orders USING (o_orderkey),
        (VALUES ('flat'), ('by year')) AS t(kind)""",
)
def table_upsert(spark, sf_dir):
    """Two loads into a flat and a partitioned table: created by the first, merged into by the second."""
    years = mapping.table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("order_year"))
    first = stage(stored_orders(spark, sf_dir).join(years, "o_orderkey"), "first")
    second = delivered_orders(spark, sf_dir).drop("line_count").withColumn("o_orderstatus", F.lit("R"))
    second = stage(second.join(years, "o_orderkey"), "second")
    with scratch_lake(spark) as lake:
        for table, by in (("silver.flat", None), ("silver.by_year", ["order_year"])):
            for load in (first, second):
                lake.upsert(table, load, ["o_orderkey"], by, unique=True)
        kinds = [lake.read(t).withColumn("kind", F.lit(k)) for t, k in (("silver.flat", "flat"), ("silver.by_year", "by year"))]
        return stage(kinds[0].unionByName(kinds[1]), "table")


@query(
    "table_insert_only",
    f"""WITH {STORED_SQL}, {DELIVERED_SQL} SELECT * FROM stored
      UNION ALL SELECT o_orderkey, o_totalprice, 'R' FROM delivered WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stored)""",
)
def table_insert_only(spark, sf_dir):
    """The second load, delivered twice, adds what the table does not hold."""
    second = delivered_orders(spark, sf_dir).drop("line_count").withColumn("o_orderstatus", F.lit("R"))
    with scratch_lake(spark) as lake:
        for load in (stored_orders(spark, sf_dir), second, second):
            lake.insert_missing("silver.orders", load, ["o_orderkey"], unique=True, prune_by="o_orderkey")
        return stage(lake.read("silver.orders"), "table")


@query(
    "table_evolve",
    f"""WITH {STORED_SQL}, {DELIVERED_SQL}
      SELECT *, CAST(NULL AS BIGINT) AS line_count FROM stored WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delivered)
      UNION ALL SELECT o_orderkey, o_totalprice, NULL, line_count FROM delivered""",
)
def table_evolve(spark, sf_dir):
    """The second load lacks a column and brings a new one: the table is widened, old rows hold NULL."""
    with scratch_lake(spark) as lake:
        for load in (stored_orders(spark, sf_dir), delivered_orders(spark, sf_dir)):
            lake.upsert("silver.orders", load, ["o_orderkey"], unique=True)
        return stage(lake.read("silver.orders"), "table")


@query(
    "table_backfill",
    f"""WITH {GAPPY_SQL} SELECT f.o_orderkey, f.o_custkey, f.o_totalprice, coalesce(f.region, c.region) AS region,
        c."stdorToU", true AS was_needed, false AS again_needed
      FROM facts f LEFT JOIN customer_regions c ON f.o_custkey = c.user_id""",
)
def table_backfill(spark, sf_dir):
    """A column with gaps and one the table never had are filled from a lookup; a second run finds nothing to do."""
    customers = mapping.customer_regions(spark, sf_dir).withColumnRenamed("user_id", "o_custkey")
    with scratch_lake(spark) as lake:
        lake.create("silver.facts", gappy_facts(spark, sf_dir))
        needed = [lake.backfill("silver.facts", customers.select("o_custkey", c), "o_custkey", c) for c in ("region", "stdorToU")]
        again = [lake.backfill("silver.facts", customers.select("o_custkey", c), "o_custkey", c) for c in ("region", "stdorToU")]
        filled = lake.read("silver.facts").withColumns({"was_needed": F.lit(all(needed)), "again_needed": F.lit(any(again))})
        return stage(filled, "table")


# --- refresh ----------------------------------------------------------------------------------------------------------


def raw_inputs(spark, sf_dir, root: str) -> RawInputs:
    """Tariff, weather and demand of the sample, as files land; the readings are for the caller to deliver."""
    mapping.tariff_entries(spark, sf_dir).write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{root}/tariff")
    landing.land_raw(mapping.weather(spark, sf_dir), f"{root}/weather", "SAMPLE", "20240201_060000")
    landing.land_raw(mapping.demand(spark, sf_dir), f"{root}/demand", "SAMPLE", "20240201_060000")
    return RawInputs(f"{root}/readings/*.csv", f"{root}/weather", f"{root}/demand", f"{root}/tariff/*.csv")


def deliver_readings(readings: DataFrame, folder: str) -> None:
    named = readings.select("LCLid", "stdorToU", "DateTime", F.col("kwh_hh").alias(bronze.RAW_CONSUMPTION_HEADER))
    named.write.mode("append").option("header", True).option("ignoreTrailingWhiteSpace", False).csv(folder)


REFRESHED_SQL = f"""WITH {BILLING}, bills AS (SELECT billing_period, count(*) AS n, sum(consumption_kwh) AS kwh, sum(bill_amount) AS amount
    FROM billing GROUP BY 1),
  hours AS (SELECT strftime(reading_timestamp, '%Y-%m-%d %H') AS billing_period, count(*) AS n, sum(consumption_kwh) AS kwh
    FROM consumption GROUP BY 1)
  SELECT 'bills' AS kind, billing_period AS period, n, round(kwh + 1e-9, 6) AS kwh, round(amount + 1e-9, 6) AS amount FROM bills
  UNION ALL SELECT 'hours', billing_period, n, round(kwh + 1e-9, 6), NULL FROM hours"""


def refreshed(lake: Lake) -> DataFrame:
    """Bills per month and load per hour, from the tables a refresh has left."""
    bills = lake.read("silver.fact_billing").groupBy(F.col("billing_period").alias("period"))
    bills = bills.agg(F.count(F.lit(1)).alias("n"), F.sum("consumption_kwh").alias("kwh"), F.sum("bill_amount").alias("amount"))
    hours = lake.read("gold.gold_peak_load").select(
        F.concat("reading_date", F.lit(" "), F.lpad(F.col("hour_of_day").cast("string"), 2, "0")).alias("period"),
        F.col("reading_count").alias("n"),
        F.col("total_consumption_kwh").alias("kwh"),
        F.lit(None).cast("double").alias("amount"),
    )
    both = bills.withColumn("kind", F.lit("bills")).unionByName(hours.withColumn("kind", F.lit("hours")))
    return stage(both.select("kind", "period", "n", r6("kwh").alias("kwh"), r6("amount").alias("amount")), "refreshed")


@query("refresh_incremental", REFRESHED_SQL)
def refresh_incremental(spark, sf_dir):
    """Readings of the middle of the month first, then all of them: late, repeated and new ones in one delivery."""
    root, readings = stage_path(spark, "raw"), stage(mapping.readings(spark, sf_dir), "readings")
    inputs = raw_inputs(spark, sf_dir, root)
    day = F.substring("DateTime", 9, 2).cast("int")
    with scratch_lake(spark) as lake:
        deliver_readings(readings.where(day.between(10, 20)), f"{root}/readings")
        refresh(lake, inputs, "run-1", datetime(2024, 2, 1, 6))
        deliver_readings(readings, f"{root}/readings")
        refresh(lake, inputs, "run-2", datetime(2024, 2, 2, 6))
        return refreshed(lake)


@query("stream_to_facts", REFRESHED_SQL)
def stream_to_facts(spark, sf_dir):
    """Readings that only the stream delivers reach facts and marts."""
    root, readings = stage_path(spark, "raw"), stage(mapping.readings(spark, sf_dir), "readings")
    inputs = raw_inputs(spark, sf_dir, root)
    day = F.substring("DateTime", 9, 2).cast("int")
    with scratch_lake(spark) as lake:
        for part in (day <= 15, day > 12):  # two days come twice
            deliver_readings(readings.where(part), f"{root}/stream")
            ingest_readings(lake, f"{root}/stream", f"{root}/progress")
        refresh(lake, RawInputs(None, inputs.weather, inputs.demand, inputs.tariff_csv), "run-1", datetime(2024, 2, 1, 6))
        return refreshed(lake)


@query(
    "late_loads",
    """SELECT strftime(o_orderdate, '%Y') AS _load_id, o_orderkey, o_totalprice FROM orders
      WHERE strftime(o_orderdate, '%Y') NOT IN (SELECT strftime(max(o_orderdate), '%Y') FROM orders)""",
)
def late_loads(spark, sf_dir):
    """Every year of orders is a load.  The newest is recorded first; all others come late, in no order, and are still new."""
    root = stage_path(spark, "landed")
    orders = mapping.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("string").alias("_load_id"))
    orders.write.partitionBy("_load_id").parquet(root)
    with scratch_lake(spark) as lake:
        newest = max(landing.load_ids(spark, root))
        lake.append(LOADS, spark.createDataFrame([(root, newest)], "root string, _load_id string"))
        fresh, _ = landing.new_loads(spark, root, lake.read(LOADS))
        return stage(fresh.select("_load_id", "o_orderkey", "o_totalprice"), "late")


# --- input that does not fit ------------------------------------------------------------------------------------------

LAYOUTS = {
    "plain": ["event_id", "ts", "user_id", "value"],
    "turned": ["value", "note", "user_id", "event_id", "ts"],
}
SCANNED = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE"


def _line(columns: list[str], kind: str):
    """The text of an event in a layout: a signup lacks its last field, an error has one too many, a click has no proper time."""
    text = {
        "event_id": F.col("event_id").cast("string"),
        "ts": F.when(F.col("event_type") == "click", F.lit("soon")).otherwise(mapping.stamp("ts")),
        "user_id": F.col("user_id").cast("string"),
        "value": F.col("value").cast("string"),
        "note": F.lit(f"{kind} note"),
    }
    whole, short = (F.concat_ws(",", *(text[c] for c in some)) for some in (columns, columns[:-1]))
    event = F.col("event_type")
    return F.when(event == "signup", short).when(event == "error", F.concat(whole, F.lit(",more"))).otherwise(whole)


def _line_sql(columns: list[str], kind: str) -> str:
    text = {
        "event_id": "CAST(event_id AS VARCHAR)",
        "ts": "CASE WHEN event_type = 'click' THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END",
        "user_id": "CAST(user_id AS VARCHAR)",
        "value": "CAST(value AS VARCHAR)",
        "note": f"'{kind} note'",
    }
    whole, short = ("concat_ws(',', " + ", ".join(text[c] for c in some) + ")" for some in (columns, columns[:-1]))
    return f"CASE event_type WHEN 'signup' THEN {short} WHEN 'error' THEN {whole} || ',more' ELSE {whole} END"


@query(
    "scan_quarantine",
    " UNION ALL ".join(
        f"""SELECT '{kind}' AS layout, CASE WHEN bad IS NULL THEN event_id END AS event_id, CASE WHEN bad IS NULL THEN ts END AS ts,
          CASE WHEN bad IS NULL THEN user_id END AS user_id, CASE WHEN bad IS NULL THEN value END AS value, bad AS reason,
          CASE WHEN bad IS NOT NULL THEN {_line_sql(columns, kind)} END AS line
        FROM (SELECT *, CASE WHEN event_type IN ('signup', 'error') THEN 'wrong number of fields'
          WHEN event_type = 'click' THEN 'ts is no timestamp_ntz' END AS bad FROM events)"""
        for kind, columns in LAYOUTS.items()
    ),
)
def scan_quarantine(spark, sf_dir):
    """Every event as a line of two layouts in one folder: rows by column name, and the lines that do not fit, all of them."""
    folder, events = stage_path(spark, "lines"), mapping.table(spark, sf_dir, "events")
    for kind, columns in LAYOUTS.items():
        # One text column named like the header: the writer puts the header above every file.
        lines = events.select(_line(columns, kind).alias(",".join(columns)))
        lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(f"{folder}/{kind}")
    scan = readers.scan_csv_checked(spark, f"{folder}/*/*.csv", T.StructType.fromDDL(SCANNED))
    layout = F.element_at(F.split("source_file", "/"), -2).alias("layout")
    good = scan.rows.select(layout, "event_id", "ts", "user_id", "value")
    bad = scan.quarantine.select(layout, "reason", "line")
    return good.unionByName(bad, allowMissingColumns=True)


# --- security in the catalog ------------------------------------------------------------------------------------------

GROUPS = {**READERS, "north": {"north_team"}}
HALVES = "CASE {0} WHEN 'EUROPE' THEN 'NORTH' WHEN 'AFRICA' THEN 'SOUTH' ELSE {0} END"


@query(
    "sql_masks",
    f"""WITH {CUSTOMER_REGIONS}, readers(reader) AS (SELECT * FROM (VALUES ('engineer'), ('analyst'), ('guest'), ('north')) AS t(r)),
      c AS (SELECT user_id, "LCLid", {HALVES.format('region')} AS region FROM customer_regions),
      seen AS (SELECT reader, 'customers' AS view, user_id AS id, CASE WHEN reader = 'engineer' THEN "LCLid" ELSE '********' END AS name,
          CAST(NULL AS DOUBLE) AS amount, region FROM c, readers
        UNION ALL SELECT reader, 'bills', o_orderkey, CASE WHEN reader = 'engineer' THEN "LCLid" ELSE '********' END,
          CASE WHEN reader IN ('engineer', 'analyst') THEN o_totalprice END, region
        FROM orders LEFT JOIN c ON o_custkey = user_id, readers)
      SELECT * FROM seen WHERE CASE WHEN reader = 'north' THEN region = 'NORTH' ELSE true END""",
)
def sql_masks(spark, sf_dir):
    """Customers and bills as each kind of reader sees them through persistent views; what a reader sets changes nothing."""
    region = F.expr(HALVES.format("region"))
    customers = mapping.customer_regions(spark, sf_dir).withColumn("region", region)
    bills = mapping.table(spark, sf_dir, "orders").join(customers.withColumnRenamed("user_id", "o_custkey"), "o_custkey", "left")
    with scratch_lake(spark) as lake:
        lake.create("silver.dim_customer", customers.select("user_id", "LCLid", "region"))
        lake.create("silver.fact_billing", bills.select("o_orderkey", F.col("LCLid").alias("customer_id"), F.col("o_totalprice").alias("bill_amount"), "region"))
        security.install_masks(lake)
        security.create_secured_view(lake, "gold.customers_seen", "silver.dim_customer")
        security.create_secured_view(lake, "gold.bills_seen", "silver.fact_billing")
        reader, views = spark.sql("SELECT session_user()").first()[0], []
        for kind, groups in GROUPS.items():
            security.set_groups(lake, reader, groups)
            spark.sql(f"DECLARE OR REPLACE VARIABLE reader_groups ARRAY<STRING> DEFAULT array('{security.ENGINEERS}')")
            seen = lake.read("gold.customers_seen").select(
                F.lit("customers").alias("view"), F.col("user_id").alias("id"), F.col("LCLid").alias("name"), F.lit(None).cast("double").alias("amount"), "region"
            )
            seen = seen.unionByName(
                lake.read("gold.bills_seen").select(
                    F.lit("bills").alias("view"), F.col("o_orderkey").alias("id"), F.col("customer_id").alias("name"), F.col("bill_amount").alias("amount"), "region"
                )
            )
            views.append(stage(seen.withColumn("reader", F.lit(kind)), "seen"))
        spark.sql("DROP TEMPORARY VARIABLE IF EXISTS reader_groups")
        return reduce(DataFrame.unionByName, views)
