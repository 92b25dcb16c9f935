"""Quality checks, drift, contracts and consumer views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators import drift, quality, security
from meterlake.plans import mapping
from meterlake.queries.merges import GAPPY_SQL, gappy_facts
from meterlake.queries.registry import CUSTOMER_REGIONS, query
from meterlake.sources.staging import stage_path

LINE_CHECKS = [
    quality.not_null("l_orderkey"),
    quality.within("l_quantity", 2, 45, name="quantity_range"),
    quality.within("l_discount", min_val=0.01, name="discount_min"),
    quality.within("l_tax", max_val=0.08, name="tax_max"),
    quality.unique("l_orderkey", "l_linenumber", name="line_unique"),
    quality.not_empty("lines_not_empty"),
    {"name": "unbounded", "check_type": "range", "column": "l_tax"},
    {"name": "unknown", "check_type": "no_such_type", "column": "l_tax"},
]
DUPLICATES_SQL = (
    "(SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))"
)
LINE_FAILURES_SQL = f"""counted AS (
  SELECT 1 AS seq, 'quantity_range' AS check_name, 'range' AS check_type, 'l_quantity' AS column_name,
    ' out-of-range values in l_quantity' AS reason, count(*) FILTER (l_quantity < 2 OR l_quantity > 45) AS n FROM lineitem
  UNION ALL SELECT 2, 'discount_min', 'range', 'l_discount', ' out-of-range values in l_discount',
    count(*) FILTER (l_discount < 0.01::DOUBLE) FROM lineitem
  UNION ALL SELECT 3, 'tax_max', 'range', 'l_tax', ' out-of-range values in l_tax',
    count(*) FILTER (l_tax > 0.08::DOUBLE) FROM lineitem
  UNION ALL SELECT 4, 'line_unique', 'unique', 'l_orderkey, l_linenumber',
    ' duplicates on [''l_orderkey'', ''l_linenumber'']', {DUPLICATES_SQL}),
failures AS (SELECT seq, 'lines' AS dq_table, check_name, check_type, column_name,
  CAST(n AS VARCHAR) || reason AS failure_reason, n AS failed_value FROM counted WHERE n > 0)"""


def lines(spark, sf_dir):
    return mapping.table(spark, sf_dir, "lineitem")


@query(
    "dq_not_null",
    f"""WITH {GAPPY_SQL} SELECT 'facts' AS dq_table, 'region_not_null' AS check_name, 'not_null' AS check_type,
      'region' AS column_name, CAST(count(*) AS VARCHAR) || ' nulls in region' AS failure_reason,
      count(*) AS failed_value FROM facts WHERE region IS NULL HAVING count(*) > 0""",
)
def dq_not_null(spark, sf_dir):
    checks = [quality.not_null("region"), quality.not_null("o_orderkey")]
    return quality.run_checks(gappy_facts(spark, sf_dir), "facts", checks)


@query(
    "dq_unique",
    f"""SELECT 'lines' AS dq_table, 'line_unique' AS check_name, 'unique' AS check_type,
      'l_orderkey, l_linenumber' AS column_name,
      CAST({DUPLICATES_SQL} AS VARCHAR) || ' duplicates on [''l_orderkey'', ''l_linenumber'']' AS failure_reason,
      {DUPLICATES_SQL} AS failed_value""",
)
def dq_unique(spark, sf_dir):
    checks = [quality.unique("l_orderkey", "l_linenumber", name="line_unique")]
    return quality.run_checks(lines(spark, sf_dir), "lines", checks)


@query(
    "dq_range",
    f"""WITH {LINE_FAILURES_SQL} SELECT dq_table, check_name, check_type, column_name, failure_reason, failed_value
      FROM failures WHERE check_type = 'range'""",
)
def dq_range(spark, sf_dir):
    checks = [c for c in LINE_CHECKS if c["check_type"] == "range"]
    return quality.run_checks(lines(spark, sf_dir), "lines", checks)


@query(
    "dq_not_empty",
    """SELECT 'no_such_orders' AS dq_table, 'not_empty' AS check_name, 'not_empty' AS check_type, '' AS column_name,
      '0 rows in dataframe' AS failure_reason, count(*) AS failed_value FROM orders WHERE o_orderdate IS NULL
      HAVING count(*) = 0""",
)
def dq_not_empty(spark, sf_dir):
    orders = mapping.table(spark, sf_dir, "orders")
    full = quality.run_checks(orders, "orders", [quality.not_empty()])
    empty = quality.run_checks(orders.filter("o_orderdate IS NULL"), "no_such_orders", [quality.not_empty()])
    return full.unionByName(empty)


FAILURE_SELECT = "SELECT dq_table, check_name, check_type, column_name, failure_reason, failed_value FROM failures"


@query("dq_failures", f"WITH {LINE_FAILURES_SQL} {FAILURE_SELECT}")
def dq_failures(spark, sf_dir):
    return quality.run_checks(lines(spark, sf_dir), "lines", LINE_CHECKS)


@query(
    "dq_log_append",
    f"WITH {LINE_FAILURES_SQL} SELECT check_name, failed_value, count(*) AS times FROM "
    f"({FAILURE_SELECT} UNION ALL {FAILURE_SELECT}) t GROUP BY ALL",
)
def dq_log_append(spark, sf_dir):
    """Two runs of a suite append to one failure log."""
    path = stage_path(spark, "dq_log")
    for _ in range(2):
        quality.annotate_checks(
            lines(spark, sf_dir), "lines", LINE_CHECKS, log=lambda rows: rows.write.mode("append").parquet(path)
        )
    return spark.read.parquet(path).groupBy("check_name", "failed_value").agg(F.count(F.lit(1)).alias("times"))


@query(
    "dq_summary",
    f"""WITH {LINE_FAILURES_SQL} SELECT (SELECT count(*) = 0 FROM failures) AS dq_passed,
      coalesce((SELECT string_agg(check_name || ': ' || failure_reason, '; ' ORDER BY seq) FROM failures), '')
        AS dq_failed_checks, count(*) AS n FROM lineitem""",
)
def dq_summary(spark, sf_dir):
    annotated = quality.annotate_checks(lines(spark, sf_dir), "lines", LINE_CHECKS)
    return annotated.groupBy("dq_passed", "dq_failed_checks").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dq_row_flags",
    """WITH f AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS dup FROM lineitem),
      g AS (SELECT *, concat_ws('; ', CASE WHEN l_orderkey IS NULL THEN 'l_orderkey_not_null' END,
        CASE WHEN l_quantity < 2 OR l_quantity > 45 THEN 'quantity_range' END,
        CASE WHEN dup THEN 'line_unique' END) AS names FROM f)
      SELECT l_orderkey, l_linenumber, l_quantity, names = '' AS dq_row_passed, names AS dq_row_failures FROM g""",
)
def dq_row_flags(spark, sf_dir):
    checks = [LINE_CHECKS[0], LINE_CHECKS[1], LINE_CHECKS[4]]
    flagged = quality.row_flags(lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity"), checks)
    return flagged.select("l_orderkey", "l_linenumber", "l_quantity", "dq_row_passed", "dq_row_failures")


@query(
    "dq_gate_filter",
    """SELECT 'flagged' AS gate, event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY event_type
      UNION ALL SELECT 'unflagged', event_type, count(*) FROM events GROUP BY event_type""",
)
def dq_gate_filter(spark, sf_dir):
    events = mapping.table(spark, sf_dir, "events")
    flagged = events.withColumn("dq_passed", F.col("event_type") != "error")
    gates = [
        quality.passed_only(df).groupBy(F.lit(gate).alias("gate"), "event_type").agg(F.count(F.lit(1)).alias("n"))
        for gate, df in (("flagged", flagged), ("unflagged", events))
    ]
    return gates[0].unionByName(gates[1])


@query("expect_or_fail", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def expect_or_fail(spark, sf_dir):
    events = quality.expect_or_fail(mapping.table(spark, sf_dir, "events"), "user_not_null", "user_id IS NOT NULL")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "schema_drift",
    """SELECT true AS schema_drift_detected, 'o_totalprice (type changed: double -> string), channel (new column)'
      AS schema_drift_columns, o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus""",
)
def schema_drift(spark, sf_dir):
    orders = mapping.table(spark, sf_dir, "orders")
    arriving = orders.drop("o_orderpriority").withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("string"), "channel": F.lit("web")}
    )
    annotated = drift.annotate_drift(arriving, orders)
    return annotated.groupBy("schema_drift_detected", "schema_drift_columns", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n")
    )


FACT_CONTRACT = "o_orderkey BIGINT NOT NULL, o_totalprice DECIMAL(18,2), region STRING NOT NULL, load_ts TIMESTAMP"


@query(
    "schema_contract_check",
    f"""WITH {GAPPY_SQL}, v(column_name, expected, actual, status) AS (VALUES
        ('o_orderkey', 'bigint', 'bigint', 'ok'), ('o_custkey', NULL, 'bigint', 'extra'),
        ('o_totalprice', 'decimal(18,2)', 'double', 'wrong type'), ('region', 'string', 'string', 'ok'),
        ('load_ts', 'timestamp', NULL, 'missing'))
      SELECT v.*, CASE column_name WHEN 'o_orderkey' THEN (SELECT count(*) FROM facts WHERE o_orderkey IS NULL)
        WHEN 'region' THEN (SELECT count(*) FROM facts WHERE region IS NULL) END AS null_rows FROM v""",
)
def schema_contract_check(spark, sf_dir):
    facts = gappy_facts(spark, sf_dir)
    status = drift.check_contract(facts, FACT_CONTRACT)
    return status.join(drift.null_violations(facts, FACT_CONTRACT), "column_name", "left")


def per_reader(readers: dict[str, set[str]], view) -> DataFrame:
    """The same view as each kind of reader sees it, side by side."""
    frames = [view(groups).withColumn("reader", F.lit(name)) for name, groups in readers.items()]
    return reduce(DataFrame.unionByName, frames)


READERS = {"engineer": {security.ENGINEERS}, "analyst": {security.ANALYSTS}, "guest": set()}
READERS_SQL = "readers(reader) AS (VALUES ('engineer'), ('analyst'), ('guest'))"


@query(
    "mask_text",
    f"""WITH {CUSTOMER_REGIONS}, {READERS_SQL} SELECT reader, user_id, region,
      CASE WHEN reader = 'engineer' THEN "LCLid" ELSE '********' END AS "LCLid" FROM customer_regions, readers""",
)
def mask_text(spark, sf_dir):
    customers = mapping.customer_regions(spark, sf_dir).select("user_id", "region", "LCLid")
    return per_reader(READERS, lambda groups: security.mask_text(customers, ["LCLid"], groups))


@query(
    "mask_numeric",
    f"""WITH {READERS_SQL} SELECT reader, o_orderkey,
      CASE WHEN reader IN ('engineer', 'analyst') THEN o_totalprice END AS o_totalprice FROM orders, readers""",
)
def mask_numeric(spark, sf_dir):
    orders = mapping.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return per_reader(READERS, lambda groups: security.mask_numeric(orders, ["o_totalprice"], groups))


TEAMS = {"north": {"north_team"}, "south": {"south_team"}, "both": {"north_team", "south_team"}, "other": set()}


@query(
    "row_filter_region",
    f"""WITH {CUSTOMER_REGIONS}, c AS (SELECT "LCLid", CASE region WHEN 'EUROPE' THEN 'NORTH' WHEN 'AFRICA' THEN 'SOUTH'
        WHEN 'ASIA' THEN NULL ELSE region END AS region FROM customer_regions),
      readers(reader) AS (VALUES ('north'), ('south'), ('both'), ('other'))
      SELECT reader, "LCLid", region FROM c, readers WHERE CASE WHEN reader IN ('north', 'both') THEN region = 'NORTH'
        WHEN reader = 'south' THEN region = 'SOUTH' ELSE true END""",
)
def row_filter_region(spark, sf_dir):
    region = F.col("region")
    half = (
        F.when(region == "EUROPE", F.lit("NORTH"))
        .when(region == "AFRICA", F.lit("SOUTH"))
        .when(region == "ASIA", F.lit(None).cast("string"))
        .otherwise(region)
    )
    customers = mapping.customer_regions(spark, sf_dir).select("LCLid", half.alias("region"))
    return per_reader(TEAMS, lambda groups: security.filter_region(customers, groups))
