"""Edge cases of the operators on tiny frames."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterlake.functions import classify, scalars
from meterlake.operators import audit, dedup, drift, grid, keys, lookups, marts, merge, quality, rating, scd, security
from meterlake.plans import silver


def test_clean_readings_drops_bad_text_and_missing_meters(spark):
    raw = [("M1", "0.5"), ("M1", "Null"), ("M1", ""), ("M1", None), (None, "1.0"), ("M2", "2")]
    df = spark.createDataFrame(raw, "LCLid string, kwh_hh string")
    assert rows(silver.clean_readings(df).select("LCLid", "consumption_kwh")) == [("M1", 0.5), ("M2", 2.0)]


def test_dedup_latest_is_deterministic_and_groups_nulls(spark):
    raw = [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), (None, 1, "n"), (None, 3, "m")]
    df = spark.createDataFrame(raw, "k string, load int, v string")
    latest = dedup.dedup_latest(df, ["k"], [F.col("load").desc()])
    assert rows(latest) == [("a", 2, "y"), (None, 3, "m")]


def test_dedup_cuts_each_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.dedup_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_surplus_counts_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    assert rows(dedup.surplus_rows(df, ["a", "b"])) == [(1,)]


def test_hash_sample_is_stable_and_near_its_rate(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    kept = dedup.hash_sample(df, ["k"], 5, 100)
    assert rows(kept) == rows(dedup.hash_sample(df.repartition(7), ["k"], 5, 100))
    assert 800 < kept.count() < 1200


def test_dense_number_equals_the_global_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(6)
    got = [r.k for r in keys.dense_number(df, ["k"], "n", start=10).orderBy("n").collect()]
    assert got == sorted(got) and len(got) == 5000
    bounds = keys.dense_number(df, ["k"], "n", start=10).agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(bounds) == (11, 5010, 5000)


def test_dense_number_of_nothing(spark):
    assert rows(keys.dense_number(spark.range(0), ["id"], "n")) == []


def test_assign_keys_over_two_runs(spark):
    first = keys.assign_keys(spark.createDataFrame([("d",), ("b",)], "m string"), None, "m", "k")
    assert rows(first) == [("b", 1), ("d", 2)]
    second = keys.assign_keys(spark.createDataFrame([(c,) for c in "dcba"], "m string"), first, "m", "k")
    assert rows(second) == [("a", 3), ("b", 1), ("c", 4), ("d", 2)]


def test_padded_id_keeps_long_keys_apart(spark):
    df = spark.createDataFrame([(7,), (999999,), (1234567,)], "k long")
    assert rows(df.select(scalars.padded_id("CUST", "k"))) == [("CUST000007",), ("CUST1234567",), ("CUST999999",)]


def test_business_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert rows(df.select(scalars.business_key("x", "y"))) == [("a_b",), (None,)]


def test_epoch_seconds_and_millis(spark):
    df = spark.createDataFrame([(1700000000.0,), (1700000000123.0,)], "e double")
    got = rows(df.select(scalars.epoch_to_timestamp("e").cast("timestamp_ntz").cast("string")))
    assert got == [("2023-11-14 22:13:20",), ("2023-11-14 22:13:20.123",)]


def test_floor_minutes(spark):
    df = spark.createDataFrame([("2024-01-01 00:29:59.9",), ("2024-01-01 00:30:00",)], "t string")
    got = rows(df.select(scalars.floor_minutes(F.col("t").cast("timestamp_ntz")).cast("string")))
    assert got == [("2024-01-01 00:00:00",), ("2024-01-01 00:30:00",)]


def test_severity_and_unknown(spark):
    df = spark.createDataFrame([("COVER_REMOVAL",), ("REVERSE_ENERGY_FLOW",), ("POWER_OUTAGE",), (None,)], "e string")
    got = df.select(classify.severity(F.col("e")), classify.known_or(F.col("e"))).collect()
    assert [tuple(r) for r in got] == [
        ("CRITICAL", "UNKNOWN"),
        ("HIGH", "UNKNOWN"),
        ("MEDIUM", "UNKNOWN"),
        ("MEDIUM", "UNKNOWN"),
    ]


# --- lookups ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [100, 0])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_broadcast_and_salted_agree(spark, limit, how):
    facts = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 20).alias("k"), "id"
    )
    keyed = spark.range(1, 15).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = lookups.lookup_join(facts, keyed, "k", how, broadcast_bytes=limit, salts=4)
    assert rows(got) == rows(facts.join(keyed, "k", how))


def test_salted_lookup_spreads_exact_copies(spark):
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"))
    keyed = spark.createDataFrame([(1, "x")], "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.lookup_join(copies, keyed, "k", probe=False, salts=8)
        held = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert sum(r[1] for r in held) == 4000 and max(r[1] for r in held) < 4000


def test_salted_lookup_is_never_broadcast(spark, tmp_path):
    """A keyed side counted as too large is not broadcast on the size of its stored file."""
    spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(f"{tmp_path}/keyed")
    facts = spark.range(3000).withColumnRenamed("id", "k")
    joined = lookups.lookup_join(facts, spark.read.parquet(f"{tmp_path}/keyed"), "k", broadcast_bytes=1000)
    assert joined.where("v IS NOT NULL").count() == 2000
    plan = joined._jdf.queryExecution()
    assert "Broadcast" not in plan.executedPlan().toString() and "SortMergeJoin" in plan.executedPlan().toString()


def test_lookup_join_with_two_sides(spark):
    facts = spark.createDataFrame([(1, "f1"), (2, "f2"), (None, "f3")], "k int, f string")
    a = spark.createDataFrame([(1, "a1")], "k int, a string")
    b = spark.createDataFrame([(2, "b2")], "k int, b string")
    expected = [(1, "f1", "a1", None), (2, "f2", None, "b2"), (None, "f3", None, None)]
    for limit in (100, 0):
        assert rows(lookups.lookup_join(facts, [a, b], "k", broadcast_bytes=limit)) == expected


# --- merges -------------------------------------------------------------------------------------------------------


@pytest.fixture
def pair(spark):
    target = spark.createDataFrame([(1, "t1"), (2, "t2"), (None, "tn")], "k int, v string")
    source = spark.createDataFrame([(2, "s2a"), (2, "s2b"), (3, "s3"), (None, "sn")], "k int, v string")
    return target, source


def test_upsert(pair):
    merged = merge.upsert(*pair, ["k"], order_by=[F.col("v").desc()])
    assert rows(merged) == [(1, "t1"), (2, "s2b"), (3, "s3"), (None, "sn"), (None, "tn")]


def test_insert_only(pair):
    merged = merge.merge_insert_only(*pair, ["k"])
    assert rows(merged) == [(1, "t1"), (2, "t2"), (3, "s3"), (None, "sn"), (None, "tn")]


def test_upsert_with_new_columns(spark, pair):
    source = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k int, w double")
    merged = merge.upsert(pair[0], source, ["k"], evolve=True)
    assert rows(merged) == [(1, "t1", None), (2, None, 20.0), (3, None, 30.0), (None, "tn", None)]


def test_backfill_fills_only_gaps(spark):
    target = spark.createDataFrame([(1, "N"), (2, None), (3, None)], "k int, region string")
    lookup = spark.createDataFrame([(1, "S"), (2, "S")], "k int, region string")
    assert merge.needs_fill(target, "region")
    assert rows(merge.fill_from(target, lookup, "k", "region")) == [(1, "N"), (2, "S"), (3, None)]
    assert not merge.needs_fill(target.filter("k = 1"), "region")


# --- drift --------------------------------------------------------------------------------------------------------


def test_drift_texts(spark):
    target = spark.createDataFrame([], "a int, b int, gone int")
    source = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert drift.drifted_columns(source, target) == ["b (type changed: int -> string)", "c (new column)"]
    assert drift.drifted_columns(source, None) == []
    assert drift.annotate_drift(source, target).first()[3:] == (
        True,
        "b (type changed: int -> string), c (new column)",
    )
    assert ("gone", "int", None, "removed") in rows(drift.drift_report(source, target))


def test_align_schemas(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([(2, 1.5)], "k int, b double")
    left, right = drift.align_schemas(a, b)
    assert rows(left.unionByName(right)) == [(1, "x", None), (2, None, 1.5)]


# --- quality ------------------------------------------------------------------------------------------------------

CHECKS = [
    quality.not_null("v"),
    quality.within("v", 0, 10, name="v_range"),
    quality.unique("a", "b", name="ab_unique"),
    quality.not_empty("filled"),
    {"name": "odd", "check_type": "mystery", "column": "v"},
]


def dq_frame(spark):
    raw = [("x", None, 0.0), ("x", None, 10.0), ("y", "1", -1.0), ("y", "2", 11.0), ("z", "1", None)]
    return spark.createDataFrame(raw, "a string, b string, v double")


def test_quality_verdict_and_log(spark):
    logged = []
    checked = quality.annotate_checks(dq_frame(spark), "t", CHECKS, log=logged.append)
    text = "v_not_null: 1 nulls in v; v_range: 2 out-of-range values in v; ab_unique: 1 duplicates on ['a', 'b']"
    assert {tuple(r) for r in checked.select("dq_passed", "dq_failed_checks").collect()} == {(False, text)}
    assert rows(logged[0].drop("check_ts")) == [
        ("t", "ab_unique", "unique", "a, b", "1 duplicates on ['a', 'b']", 1),
        ("t", "v_not_null", "not_null", "v", "1 nulls in v", 1),
        ("t", "v_range", "range", "v", "2 out-of-range values in v", 2),
    ]


def test_quality_on_an_empty_frame(spark):
    empty = dq_frame(spark).limit(0)
    assert rows(quality.run_checks(empty, "t", CHECKS)) == [("t", "filled", "not_empty", "", "0 rows in dataframe", 0)]


def test_quality_raises_after_logging(spark):
    logged = []
    with pytest.raises(RuntimeError, match="Data quality checks failed for t: v_not_null: 1 nulls in v"):
        quality.annotate_checks(dq_frame(spark), "t", CHECKS[:1], log=logged.append, fail_on_error=True)
    assert len(logged) == 1


def test_no_failures_means_passed(spark):
    checked = quality.annotate_checks(dq_frame(spark), "t", [quality.not_null("a")], log=lambda _: pytest.fail("logged"))
    assert checked.select("dq_passed", "dq_failed_checks").distinct().first() == (True, "")


def test_row_flags(spark):
    flagged = quality.row_flags(dq_frame(spark), CHECKS)
    assert rows(flagged.select("a", "v", "dq_row_failures")) == [
        ("x", 0.0, "ab_unique"),
        ("x", 10.0, "ab_unique"),
        ("y", -1.0, "v_range"),
        ("y", 11.0, "v_range"),
        ("z", None, "v_not_null"),
    ]


def test_duplicate_flags_with_hot_and_cold_keys(spark):
    hot = spark.range(6000).select(F.lit(-1).cast("long").alias("k"))
    cold = spark.range(4000).select((F.col("id") % 2500).alias("k"))
    df = hot.union(cold)
    got = quality.flag_duplicates(df, ["k"], "dup").groupBy("dup").count()
    assert rows(got) == [(False, 1000), (True, 9000)]


def test_expectation_aborts(spark):
    df = dq_frame(spark)
    assert quality.expect_or_fail(df, "a_present", "a IS NOT NULL").count() == 5
    with pytest.raises(Exception, match="expectation v_present violated"):
        quality.expect_or_fail(df, "v_present", "v IS NOT NULL").collect()


# --- history ------------------------------------------------------------------------------------------------------


def test_scd2_transitions(spark):
    day = [F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp_ntz") for d in (1, 2, 3)]
    one = spark.createDataFrame([("same", "a"), ("changed", "a"), ("gone", "a"), ("null", None)], "k string, v string")
    two = spark.createDataFrame([("same", "a"), ("changed", "b"), ("new", "a"), ("null", None)], "k string, v string")
    history = scd.scd2_apply(scd.open_history(one, day[0]), two, ["k"], day[1])
    state = history.selectExpr("k", "v", "day(valid_from)", "day(valid_to)", "is_current")
    assert rows(state) == [
        ("changed", "a", 1, 2, False),
        ("changed", "b", 2, None, True),
        ("gone", "a", 1, 2, False),
        ("new", "a", 2, None, True),
        ("null", None, 1, None, True),
        ("same", "a", 1, None, True),
    ]
    again = scd.scd2_apply(history, two, ["k"], day[2])
    assert rows(again) == rows(history)
    back = scd.scd2_apply(history, one, ["k"], day[2]).filter("k = 'gone'")
    assert rows(back.selectExpr("day(valid_from)", "day(valid_to)", "is_current")) == [(1, 2, False), (3, None, True)]


# --- rating and marts ---------------------------------------------------------------------------------------------


def typed(spark, raw, names="customer_type string, reading_timestamp string, consumption_kwh double"):
    return spark.createDataFrame(raw, names).withColumn(
        "reading_timestamp", F.col("reading_timestamp").cast("timestamp_ntz")
    )


def schedule(spark, raw):
    df = spark.createDataFrame(raw, "tariff_half_hour string, rate_per_kwh double")
    return df.withColumn("tariff_half_hour", F.col("tariff_half_hour").cast("timestamp_ntz"))


def test_rating_with_a_schedule_gap(spark):
    readings = typed(
        spark,
        [
            ("Std", "2024-01-01 00:10:00", 1.0),
            ("ToU", "2024-01-01 00:29:59", 2.0),
            ("ToU", "2024-01-01 00:31:00", 3.0),
            (None, "2024-01-01 00:00:00", 4.0),
        ],
    )
    rates = schedule(spark, [("2024-01-01 00:00:00", 0.08)])
    rated = rating.rate_readings(readings, rates).select("consumption_kwh", "applied_rate_per_kwh", "half_hour_cost")
    assert rows(rated) == [(1.0, 0.15, 0.15), (2.0, 0.08, 0.16), (3.0, None, None), (4.0, 0.08, 0.32)]


def test_asof_rating_carries_the_last_change(spark):
    readings = typed(
        spark,
        [("ToU", "2023-12-31 23:00:00", 1.0), ("ToU", "2024-01-01 05:59:00", 1.0), ("ToU", "2024-01-03 09:00:00", 1.0)],
    )
    changes = schedule(
        spark, [("2024-01-01 00:00:00", 0.08), ("2024-01-01 06:00:00", 0.15), ("2024-01-02 00:00:00", 0.25)]
    )
    rated = rating.rate_readings(readings, changes, asof=True)
    assert sorted((r.half_hour_cost is None, r.half_hour_cost) for r in rated.collect()) == [
        (False, 0.08),
        (False, 0.25),
        (True, None),
    ]


def test_changes_off_the_slot_grid_count(spark):
    readings = typed(spark, [("ToU", "2024-01-01 05:59:00", 1.0), ("ToU", "2024-01-01 00:09:59", 2.0)])
    rated = rating.rate_readings(readings, schedule(spark, [("2024-01-01 00:10:00", 0.08)]), asof=True)
    assert rows(rated.select("consumption_kwh", "applied_rate_per_kwh")) == [(1.0, 0.08), (2.0, None)]


def test_bill_equals_the_sum_of_rated_readings(spark):
    consumption = typed(
        spark,
        [
            (1, 11, "2024-01-01 00:10:00", 1.0, "L"),
            (1, 11, "2024-01-01 00:40:00", 2.0, "L"),
            (2, 12, "2024-01-01 00:10:00", 3.0, "L"),
            (2, 12, "2024-02-01 00:10:00", 4.0, "L"),
            (2, 12, "2024-02-01 00:40:00", 5.0, "L"),
            (9, None, "2024-02-01 00:40:00", 6.0, None),
            (3, 13, "2024-01-01 00:10:00", 1.0, "L"),
            (3, 13, "2024-01-01 00:40:00", 1.0, "M"),
        ],
        "customer_key long, meter_key long, reading_timestamp string, consumption_kwh double, region string",
    )
    customers = spark.createDataFrame(
        [(1, "C1", "TAR001", "Std", "L"), (2, "C2", "TAR002", "ToU", "L"), (3, "C3", "TAR001", "Std", "M")],
        "customer_key long, customer_id string, tariff_id string, customer_type string, region string",
    )
    meters = spark.createDataFrame([(11, "M1"), (12, "M2"), (13, "M3")], "meter_key long, meter_id string")
    rates = schedule(spark, [("2024-01-01 00:00:00", 0.5), ("2024-02-01 00:00:00", 0.25)])
    bills = rating.bill(consumption, customers, meters, rates)
    got = bills.select("billing_business_key", "bill_id", "consumption_kwh", F.round("bill_amount", 9), "region")
    assert rows(got) == [
        ("C1_M1_2024-01", "BILLC1_2024-01", 3.0, 0.45, "L"),
        ("C2_M2_2024-01", "BILLC2_2024-01", 3.0, 1.5, "L"),
        ("C2_M2_2024-02", "BILLC2_2024-02", 9.0, 1.0, "L"),
        ("C3_M3_2024-01", "BILLC3_2024-01", 2.0, 0.3, "M"),  # moved: readings of two regions, one bill in the present one
        (None, None, 6.0, None, None),
    ]


def test_peer_outliers(spark):
    raw = [("p", "T1", i, 100.0) for i in range(20)] + [("p", "T1", 99, 1.0), ("p", "T2", 50, 5.0), ("p", None, 60, 0.0)]
    df = spark.createDataFrame(raw, "billing_period string, tariff_id string, m int, kwh double")
    out = marts.peer_outliers(df, ["billing_period", "tariff_id"], "kwh")
    assert [r.m for r in out.filter("theft_flag").collect()] == [99]
    alone, unpeered = out.filter("m = 50").first(), out.filter("m = 60").first()
    assert (alone.peer_stddev_kwh, alone.variance_from_peer_kwh, alone.detection_reason) == (0.0, 0.0, marts.WITHIN_PEERS)
    assert (unpeered.peer_avg_kwh, unpeered.theft_flag) == (None, False)


def test_weather_impact_keeps_hours_without_readings(spark):
    weather = spark.createDataFrame(
        [(20240101, 0, "2024-01-01 00:00:00", 1.0), (20240101, 0, "2024-01-01 00:30:00", 2.0), (20240101, 5, "x", 3.0)],
        "date_key int, hour_of_day int, t string, temperature_c double",
    ).selectExpr(
        "date_key",
        "hour_of_day",
        "try_cast(t AS timestamp_ntz) AS weather_timestamp",
        "temperature_c",
        "0D AS humidity_pct",
        "0D AS wind_speed_kmh",
        "0D AS precipitation_mm",
    )
    consumption = typed(
        spark,
        [(20240101, "2024-01-01 00:10:00", 2.0), (20240101, "2024-01-01 00:20:00", 4.0), (20240101, "2024-01-01 09:00:00", 9.0)],
        "date_key int, reading_timestamp string, consumption_kwh double",
    )
    out = marts.weather_impact(consumption, weather)
    got = out.select("hour_of_day", "temperature_c", "total_consumption_kwh", "avg_meter_consumption_kwh")
    assert rows(got) == [(0, 2.0, 6.0, 3.0), (5, 3.0, None, None)]


def test_grid_and_row_multiplier(spark):
    slots = grid.distinct_slots(spark.createDataFrame([("a",), ("a",), (None,)], "s string"), "s")
    out = grid.grid(slots, [("f1", 1), ("f2", 2)], ["f", "n"], {"twice": F.col("n") * 2})
    assert rows(out) == [("a", "f1", 1, 2), ("a", "f2", 2, 4)]
    assert rows(grid.multiply_rows(slots, 2)) == [("a", 1), ("a", 2)]


# --- audit and security -------------------------------------------------------------------------------------------


def test_watermark_falls_back_and_bounds_the_extract(spark):
    runs = spark.createDataFrame([(datetime(2024, 1, 2, 6, 30),), (datetime(2024, 1, 1, 6, 0),)], "run_ts timestamp_ntz")
    high = audit.watermark(runs).first()[0]
    assert high == datetime(2024, 1, 2, 6, 30)
    assert audit.watermark(runs.withColumnRenamed("run_ts", "other")) is None
    df = runs.withColumnRenamed("run_ts", "ts")
    assert audit.since(df, "ts", high, "day").count() == 1
    assert audit.since(df, "ts", None).count() == 2


def test_fetched_times_keep_their_wall_clock(spark):
    runs = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 06:30:00.123456' AS ts")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        high = runs.first()[0]
        assert audit.since(runs, "ts", high, "hour").count() == 1
        assert audit.since(runs, "ts", high.replace(hour=7), "hour").count() == 0
        literal = scalars.literal_of(high, runs.schema["ts"].dataType)
        assert runs.filter(F.col("ts") == literal).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_masks_and_row_filter(spark):
    df = spark.createDataFrame([("C1", 1.0, "NORTH"), (None, 2.0, "SOUTH"), ("C3", 3.0, None)], "id string, v double, region string")
    assert rows(security.mask_text(df, ["id"], {"x"}).select("id")) == [("********",)] * 3
    assert rows(security.mask_text(df, ["id"], {security.ENGINEERS})) == rows(df)
    assert rows(security.mask_numeric(df, ["v"], {security.ANALYSTS})) == rows(df)
    assert rows(security.mask_numeric(df, ["v"], set()).select("v")) == [(None,)] * 3
    assert security.filter_region(df, {"north_team", "south_team"}).count() == 1
    assert security.filter_region(df, {"south_team"}).count() == 1
    assert security.filter_region(df, set()).count() == 3


def test_masked_key_matches_nothing(spark):
    df = spark.createDataFrame([("C1", 1)], "id string, v int")
    masked = security.mask_text(df, ["id"], set())
    assert masked.join(df.select("id", F.col("v").alias("w")), "id", "left").first()["w"] is None


def test_one_bad_row_keeps_no_batch_out_of_the_facts(spark):
    feeders = [("F1", "S1", "2024-01-01 00:00:00", "230", "1", 0.2, "X", False), (None, "S1", "2024-01-01 00:00:00", "230", "1", 0.2, "X", False)]
    feeders += [("F2", "S1", "2024-01-01 00:00:00", "230", None, None, "X", False)]
    ddl = "feeder_id string, substation_id string, DateTime string, voltage_v string, current_a string, active_power_kw double, source_system string, dq_passed boolean"
    assert rows(silver.fact_feeder_readings(spark.createDataFrame(feeders, ddl)).select("feeder_id")) == [("F1",)]
    events = [("E1", "A", "OUTAGE", "HIGH", "2024-01-01 00:10:00", "X", False), (None, "A", "OUTAGE", "HIGH", "2024-01-01 00:20:00", "X", False)]
    events += [("E1", "A", "OUTAGE", "HIGH", "2024-01-01 00:10:00", "X", False)]
    ddl = "event_id string, LCLid string, event_type string, severity string, event_timestamp string, source_system string, dq_passed boolean"
    assert rows(silver.fact_meter_events(spark.createDataFrame(events, ddl)).select("event_id")) == [("E1",)]
