"""Merges, backfills, schema alignment, history, lineage and watermarks."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.scalars import api_start, literal_of
from meterlake.operators import audit, drift, merge, scd
from meterlake.operators.lookups import lookup_join
from meterlake.plans import mapping
from meterlake.queries.registry import CUSTOMER_REGIONS, query
from meterlake.sources.staging import stage, stage_path

# Stored orders: those not open.  Delivered orders: those not finished, re-priced from their lines where they have any.
# Every order is on one side at least, pending ones are on both.
STORED_SQL = "stored AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'O')"
DELIVERED_SQL = """lines AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS price, count(*) AS line_count FROM lineitem GROUP BY 1),
  delivered AS (SELECT o_orderkey, coalesce(price, o_totalprice) AS o_totalprice, coalesce(line_count, 0) AS line_count
    FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F')"""


def stored_orders(spark, sf_dir):
    orders = mapping.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'O'")
    return orders.select("o_orderkey", "o_totalprice", "o_orderstatus")


def delivered_orders(spark, sf_dir):
    lines = mapping.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    lines = lines.agg(F.round(F.sum("l_extendedprice"), 2).alias("price"), F.count(F.lit(1)).alias("line_count"))
    orders = mapping.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").join(lines, "o_orderkey", "left")
    return orders.select(
        "o_orderkey", F.coalesce("price", "o_totalprice").alias("o_totalprice"), F.coalesce("line_count", F.lit(0)).cast("bigint").alias("line_count")
    )


@query(
    "merge_upsert",
    f"""WITH {STORED_SQL}, {DELIVERED_SQL}
      SELECT * FROM stored WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delivered)
      UNION ALL SELECT o_orderkey, o_totalprice, 'R' FROM delivered""",
)
def merge_upsert(spark, sf_dir):
    source = delivered_orders(spark, sf_dir).drop("line_count").withColumn("o_orderstatus", F.lit("R"))
    return merge.upsert(stored_orders(spark, sf_dir), source, ["o_orderkey"], unique=True)


@query(
    "merge_insert_only",
    f"""WITH {STORED_SQL}, {DELIVERED_SQL}
      SELECT * FROM stored UNION ALL
      SELECT o_orderkey, o_totalprice, 'R' FROM delivered WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stored)""",
)
def merge_insert_only(spark, sf_dir):
    source = delivered_orders(spark, sf_dir).drop("line_count").withColumn("o_orderstatus", F.lit("R"))
    return merge.merge_insert_only(stored_orders(spark, sf_dir), source, ["o_orderkey"], unique=True)


@query(
    "merge_schema_evolution",
    f"""WITH {STORED_SQL}, {DELIVERED_SQL}
      SELECT *, CAST(NULL AS BIGINT) AS line_count FROM stored WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delivered)
      UNION ALL SELECT o_orderkey, o_totalprice, NULL, line_count FROM delivered""",
)
def merge_schema_evolution(spark, sf_dir):
    target, source = stored_orders(spark, sf_dir), delivered_orders(spark, sf_dir)
    return merge.upsert(target, source, ["o_orderkey"], unique=True, evolve=True)


GAPPY_SQL = f"""{CUSTOMER_REGIONS}, facts AS (
  SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN c.region END AS region
  FROM orders LEFT JOIN customer_regions c ON o_custkey = c.user_id)"""


def gappy_facts(spark, sf_dir):
    """Orders whose region is known only for finished ones."""
    places = mapping.customer_regions(spark, sf_dir).select(F.col("user_id").alias("o_custkey"), "region")
    customers = mapping.table(spark, sf_dir, "customer")
    facts = lookup_join(mapping.table(spark, sf_dir, "orders"), places, "o_custkey", sized_by=customers)
    known = F.when(F.col("o_orderstatus") == "F", F.col("region"))
    return facts.select("o_orderkey", "o_custkey", "o_totalprice", known.alias("region"))


@query(
    "backfill_conditional",
    f"""WITH {GAPPY_SQL} SELECT o_orderkey, o_custkey, o_totalprice, coalesce(f.region, c.region) AS region
      FROM facts f LEFT JOIN customer_regions c ON f.o_custkey = c.user_id""",
)
def backfill_conditional(spark, sf_dir):
    places = mapping.customer_regions(spark, sf_dir).select(F.col("user_id").alias("o_custkey"), "region")
    return merge.fill_from(gappy_facts(spark, sf_dir), places, "o_custkey", "region")


@query(
    "backfill_needed",
    f"""WITH {GAPPY_SQL} SELECT 'region' AS column_name, count(*) > 0 AS needed FROM facts WHERE region IS NULL
      UNION ALL SELECT 'o_totalprice', count(*) > 0 FROM facts WHERE o_totalprice IS NULL""",
)
def backfill_needed(spark, sf_dir):
    facts = gappy_facts(spark, sf_dir)
    gates = [(c, merge.needs_fill(facts, c)) for c in ("region", "o_totalprice")]
    return spark.createDataFrame(gates, "column_name string, needed boolean")


@query(
    "align_schemas",
    """SELECT c_custkey AS k, c_nationkey AS nation, c_acctbal AS acctbal, c_name AS name, c_mktsegment AS segment,
        CAST(NULL AS VARCHAR) AS s_name FROM customer
      UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, NULL, NULL, s_name FROM supplier""",
)
def align_schemas(spark, sf_dir):
    source = mapping.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", "c_nationkey AS nation", "c_acctbal AS acctbal", "c_name AS name", "c_mktsegment AS segment"
    )
    target = mapping.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS k", "s_nationkey AS nation", "s_acctbal AS acctbal", "s_name"
    )
    source, target = drift.align_schemas(source, target)
    return source.unionByName(target)


DAY1, DAY2 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"


@query(
    "scd2_apply",
    f"""WITH {CUSTOMER_REGIONS}, base AS (
        SELECT r.*, c_acctbal FROM customer_regions r JOIN customer ON c_custkey = user_id),
      day1 AS (SELECT "LCLid", "stdorToU", region FROM base WHERE region IS DISTINCT FROM 'ASIA' OR c_acctbal < 0),
      day2 AS (SELECT "LCLid", CASE WHEN c_acctbal > 5000 THEN 'ToU' ELSE "stdorToU" END AS "stdorToU", region
        FROM base WHERE c_acctbal >= 0),
      j AS (SELECT coalesce(a."LCLid", b."LCLid") AS "LCLid", a."stdorToU" AS t1, a.region AS r1, b."stdorToU" AS t2,
          b.region AS r2, a."LCLid" IS NOT NULL AS in1, b."LCLid" IS NOT NULL AS in2
        FROM day1 a FULL OUTER JOIN day2 b ON a."LCLid" = b."LCLid")
      SELECT "LCLid", t1 AS "stdorToU", r1 AS region, {DAY1} AS valid_from,
        CASE WHEN in2 AND t1 IS NOT DISTINCT FROM t2 AND r1 IS NOT DISTINCT FROM r2 THEN NULL ELSE {DAY2} END AS valid_to,
        in2 AND t1 IS NOT DISTINCT FROM t2 AND r1 IS NOT DISTINCT FROM r2 AS is_current FROM j WHERE in1
      UNION ALL SELECT "LCLid", t2, r2, {DAY2}, NULL, true FROM j
        WHERE in2 AND NOT (in1 AND t1 IS NOT DISTINCT FROM t2 AND r1 IS NOT DISTINCT FROM r2)""",
)
def scd2_apply(spark, sf_dir):
    """Two customer snapshots: in the second, solvent Asians are new, debtors are gone and wealthy customers moved to ToU."""
    balances = mapping.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    base = mapping.customer_regions(spark, sf_dir).join(balances, "user_id")
    columns = ["LCLid", "stdorToU", "region"]
    day1 = base.filter("NOT (region <=> 'ASIA') OR c_acctbal < 0").select(*columns)
    moved = F.when(F.col("c_acctbal") > 5000, F.lit("ToU")).otherwise(F.col("stdorToU"))
    day2 = base.filter("c_acctbal >= 0").withColumn("stdorToU", moved).select(*columns)
    first, second = (F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2))
    return scd.scd2_apply(scd.open_history(day1, first), day2, ["LCLid"], second)


SNAPSHOTS_SQL = """snapshots AS (SELECT strftime(ts, '%Y%m%d') AS run_id, min(ts) AS pipeline_start_ts,
  event_type AS table_schema, 'user_' || CAST(user_id AS VARCHAR) AS table_name, count(*) AS n
  FROM events GROUP BY strftime(ts, '%Y%m%d'), event_type, user_id)"""


def snapshots(spark, sf_dir):
    """An audit log in the snapshot layout: one run per day, one row per event type and user seen."""
    events = mapping.table(spark, sf_dir, "events")
    return events.groupBy(
        F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.col("event_type").alias("table_schema"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
    ).agg(F.min("ts").alias("pipeline_start_ts"), F.count(F.lit(1)).alias("n"))


@query("lineage_report", f"WITH {SNAPSHOTS_SQL} SELECT * FROM snapshots")
def lineage_report(spark, sf_dir):
    return audit.lineage_report(snapshots(spark, sf_dir))


@query("watermark", f"WITH {SNAPSHOTS_SQL} SELECT max(pipeline_start_ts) AS watermark FROM snapshots")
def watermark(spark, sf_dir):
    return audit.watermark(snapshots(spark, sf_dir))


@query(
    "incremental_extract",
    f"""WITH {SNAPSHOTS_SQL}, wm AS (SELECT max(pipeline_start_ts) AS w FROM snapshots)
      SELECT event_id, ts, user_id, event_type, value, strftime(w, '%Y-%m-%dT%H') AS start_param
      FROM events, wm WHERE ts >= date_trunc('hour', w)""",
)
def incremental_extract(spark, sf_dir):
    high = audit.watermark(snapshots(spark, sf_dir)).first()[0]
    fresh = audit.since(mapping.table(spark, sf_dir, "events"), "ts", high, "hour")
    start = api_start(literal_of(high, T.TimestampNTZType()), "hour").alias("start_param")
    return fresh.select("event_id", "ts", "user_id", "event_type", "value", start)


@query(
    "lineage_snapshot",
    """SELECT 'manual' AS run_id, 'sample_gold' AS table_schema, t AS table_name, 'EXTERNAL' AS table_type, n AS total_rows,
             true AS ended_after_start
      FROM (SELECT 'orders_totals' AS t, count(*) AS n FROM (SELECT DISTINCT o_orderpriority FROM orders)
            UNION ALL SELECT 'events_totals', count(*) FROM (SELECT DISTINCT event_type FROM events))""",
)
def lineage_snapshot(spark, sf_dir):
    """Save the sample's order and event totals as catalog tables, snapshot the catalog, and count the listed tables.

    The schema carries a tag of the run, so that no schema of a user or of another run is dropped; its name is told without it.
    """
    tag = f"_{uuid.uuid4().hex[:10]}"
    schema = f"sample_gold{tag}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{stage_path(spark, schema)}'")
    for name, key in (("orders", "o_orderpriority"), ("events", "event_type")):
        totals = mapping.table(spark, sf_dir, name).groupBy(key).count()
        path = stage_path(spark, name)
        totals.write.mode("overwrite").option("path", path).saveAsTable(f"{schema}.{name}_totals")
    found = stage(audit.lineage_snapshot(spark, (schema,), "manual", datetime(2024, 1, 31, 6, 0, 0)), "lineage")
    names = [row.table_name for row in found.select("table_name").collect()]
    counts = [
        stage(spark.table(f"{schema}.{n}").agg(F.count(F.lit(1)).alias("total_rows")), n).withColumn("table_name", F.lit(n))
        for n in names
    ]
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    untagged = F.replace("table_schema", F.lit(tag)).alias("table_schema")
    ended = (F.col("pipeline_end_ts") >= F.col("pipeline_start_ts")).alias("ended_after_start")
    return found.join(reduce(DataFrame.unionByName, counts), "table_name").select(
        "run_id", untagged, "table_name", "table_type", "total_rows", ended
    )
