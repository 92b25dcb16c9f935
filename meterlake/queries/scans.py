"""Sources and landings: each query writes the sample tables in a raw form and reads them back through a reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.plans import bronze, mapping
from meterlake.queries.registry import DEMAND, READINGS, query
from meterlake.sources import calendar, landing, payloads, readers
from meterlake.sources.staging import stage_path


@query("scan_csv_readings", f'WITH {READINGS} SELECT "LCLid", "stdorToU", "DateTime", kwh_hh FROM readings')
def scan_csv_readings(spark, sf_dir):
    path = stage_path(spark, "csv")
    raw = mapping.readings(spark, sf_dir).select("LCLid", "stdorToU", "DateTime", "kwh_hh")
    raw.withColumnRenamed("kwh_hh", bronze.RAW_CONSUMPTION_HEADER).write.option("header", True).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return readers.scan_csv(spark, f"{path}/*.csv", bronze.RAW_READING_COLUMNS, bronze.READING_RENAMES)


@query("scan_parquet_recursive", "SELECT * FROM orders")
def scan_parquet_recursive(spark, sf_dir):
    root = stage_path(spark, "nested")
    orders = mapping.table(spark, sf_dir, "orders")
    orders.filter("o_orderstatus = 'O'").write.parquet(f"{root}/2024/open")
    orders.filter("o_orderstatus <> 'O'").write.parquet(f"{root}/2024/01/closed")
    orders.select("o_orderstatus").write.text(f"{root}/notes")
    return readers.scan_parquet(spark, root, recursive=True, glob="*.parquet")


@query(
    "scan_parquet_merge_schema",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END "
    "AS o_orderpriority FROM orders",
)
def scan_parquet_merge_schema(spark, sf_dir):
    root = stage_path(spark, "grown")
    orders = mapping.table(spark, sf_dir, "orders")
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    orders.filter(F.col("o_orderdate") < split).select("o_orderkey", "o_totalprice").write.parquet(f"{root}/a")
    late = orders.filter(F.col("o_orderdate") >= split)
    late.select("o_orderkey", "o_totalprice", "o_orderpriority").write.parquet(f"{root}/b")
    return readers.scan_parquet(spark, root, recursive=True, glob="*.parquet", merge_schema=True)


@query(
    "file_provenance",
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS source_file_name, true AS has_size, true AS has_time, count(*) AS n FROM {t}"
        for t in ("events", "orders", "lineitem")
    ),
)
def file_provenance(spark, sf_dir):
    frames = [
        readers.with_provenance(mapping.table(spark, sf_dir, t))
        .groupBy(
            "source_file_name",
            (F.col("source_file_size") > 0).alias("has_size"),
            F.col("source_file_modification_time").isNotNull().alias("has_time"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        for t in ("events", "orders", "lineitem")
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "dim_date",
    """WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
    days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
    n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT days.d AS full_date, CAST(strftime(days.d, '%Y%m%d') AS INTEGER) AS date_key,
      CAST(year(days.d) AS INTEGER) AS year, CAST(quarter(days.d) AS INTEGER) AS quarter,
      CAST(month(days.d) AS INTEGER) AS month, strftime(days.d, '%B') AS month_name,
      CAST(day(days.d) AS INTEGER) AS day, CAST(weekofyear(days.d) AS INTEGER) AS week_of_year,
      CAST(dayofweek(days.d) + 1 AS INTEGER) AS day_of_week, strftime(days.d, '%A') AS day_name,
      dayofweek(days.d) IN (0, 6) AS is_weekend, coalesce(n.n, 0) AS order_count
    FROM days LEFT JOIN n ON days.d = n.d""",
)
def dim_date(spark, sf_dir):
    daily = mapping.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("full_date"))
    daily = daily.agg(F.count(F.lit(1)).alias("order_count"))
    first, last = daily.agg(F.min("full_date"), F.max("full_date")).first()
    dates = calendar.date_dimension(spark, first, last)
    joined = dates.join(daily, "full_date", "left")
    return joined.withColumn("order_count", F.coalesce("order_count", F.lit(0)))


@query(
    "json_records",
    """SELECT strftime(ts, '%Y-%m-%dT%H') AS period, event_type AS "respondent-name",
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS value FROM events
       UNION ALL SELECT strftime(ts, '%Y-%m-%dT%H'), 'user', user_id FROM events""",
)
def json_records(spark, sf_dir):
    events = mapping.table(spark, sf_dir, "events")
    period = F.date_format("ts", "yyyy-MM-dd'T'HH").alias("period")
    k = F.from_json("props", "k bigint").getField("k").alias("value")
    payload = payloads.record_payload(
        F.struct(period, F.col("event_type").alias("respondent-name"), k),
        F.struct(period, F.lit("user").alias("respondent-name"), F.col("user_id").alias("value")),
    )
    landed = payloads.landed_text(events.select(payload.alias("payload")), stage_path(spark, "json"), "payload")
    return payloads.explode_records(landed, "value", "period:string,`respondent-name`:string,value:bigint")


@query(
    "json_arrays_zip",
    """SELECT strftime(ts, '%Y-%m-%dT%H') AS "timestamp", value AS temperature, user_id AS humidity FROM events
       UNION ALL SELECT strftime(ts, '%Y-%m-%dT23'), value + 1, event_id FROM events""",
)
def json_arrays_zip(spark, sf_dir):
    events = mapping.table(spark, sf_dir, "events")
    hourly = F.struct(
        F.array(F.date_format("ts", "yyyy-MM-dd'T'HH"), F.date_format("ts", "yyyy-MM-dd'T23'")).alias("time"),
        F.array(F.col("value"), F.col("value") + 1).alias("temperature_2m"),
        F.array("user_id", "event_id").alias("relative_humidity_2m"),
    )
    payload = F.to_json(F.struct(hourly.alias("hourly")))
    landed = payloads.landed_text(events.select(payload.alias("payload")), stage_path(spark, "json"), "payload")
    arrays = {
        "timestamp": ("time", "string"),
        "temperature": ("temperature_2m", "double"),
        "humidity": ("relative_humidity_2m", "bigint"),
    }
    return payloads.zip_arrays(landed, "value", "hourly", arrays)


@query(
    "raw_landing",
    f"""WITH {DEMAND} SELECT CASE WHEN type = 'O' THEN '20240102_060000' ELSE '20240101_060000' END AS "_load_id",
      'EIA' AS "_source_system", respondent, count(*) AS n, max(value) AS top_value FROM demand GROUP BY ALL""",
)
def raw_landing(spark, sf_dir):
    root = stage_path(spark, "landing")
    demand = mapping.demand(spark, sf_dir)
    landing.land_raw(demand.filter("type <> 'O'"), root, "EIA", "20240101_060000")
    landing.land_raw(demand.filter("type = 'O'"), root, "EIA", "20240102_060000")
    landed = landing.read_landed(spark, root)
    return landed.groupBy("_load_id", "_source_system", "respondent").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("top_value")
    )


@query(
    "partitioned_write_read",
    """SELECT CAST(ts AS DATE) AS event_date, count(*) AS n,
      max(CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN value * 2 ELSE value END) AS top_value
    FROM events GROUP BY 1""",
)
def partitioned_write_read(spark, sf_dir):
    path = stage_path(spark, "partitioned")
    events = mapping.table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    events.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(path)
    # Second load: only the partitions it contains are replaced.
    late = spark.read.parquet(path).filter(F.col("event_date") >= F.lit("2024-01-15").cast("date"))
    doubled = late.withColumn("value", F.col("value") * 2).hint("rebalance", "event_date")
    doubled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    return stored.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top_value"))
