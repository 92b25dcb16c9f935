"""Tables on disk, the whole refresh, streaming ingestion and sources."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.functions.scalars import floor_minutes
from meterlake.operators import marts, rating, security
from meterlake.operators.drift import check_contract, null_violations
from meterlake.operators.tables import SCHEMAS, Lake
from meterlake.plans import bronze, silver
from meterlake.plans.contracts import CONTRACTS
from meterlake.plans.layout import LAYOUTS
from meterlake.plans.refresh import FAILURE_LOG, LINEAGE, QUARANTINE, RawInputs, checked_csv, load, not_older, refresh, unbuilt_batches, unsettled_months
from meterlake.sources import calendar, landing, payloads, readers, staging
from meterlake.streaming.ingest import ingest_readings


@pytest.fixture
def lake(spark, tmp_path):
    for schema in SCHEMAS:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
    return Lake(spark, str(tmp_path / "lake"))


def frame(spark, raw, ddl="k int, d string, v string"):
    return spark.createDataFrame(raw, ddl)


def test_unpartitioned_table_life(spark, lake):
    lake.upsert("silver.t", frame(spark, [(1, "a", "x"), (2, "a", "y")]), ["k"])
    lake.upsert("silver.t", frame(spark, [(2, "a", "z"), (3, "b", "n")]), ["k"])
    assert rows(lake.read("silver.t")) == [(1, "a", "x"), (2, "a", "z"), (3, "b", "n")]
    lake.upsert("silver.t", frame(spark, [(3, 1.5)], "k int, w double"), ["k"])
    assert rows(lake.read("silver.t")) == [(1, "a", "x", None), (2, "a", "z", None), (3, None, None, 1.5)]
    lake.insert_missing("silver.t", frame(spark, [(1, "q", "q"), (4, "q", "q")]), ["k"])
    assert rows(lake.read("silver.t").select("k", "d")) == [(1, "a"), (2, "a"), (3, None), (4, "q")]


def test_partitioned_merge_touches_only_its_partitions(spark, lake):
    first = [(1, "a", "x"), (2, "b", "y"), (3, None, "n")]
    lake.upsert("silver.p", frame(spark, first), ["k"], ["d"])
    files = {r[0] for r in lake.read("silver.p").filter("d = 'a'").select("_metadata.file_path").collect()}
    lake.upsert("silver.p", frame(spark, [(2, "b", "z"), (4, "c", "w"), (5, None, "m")]), ["k"], ["d"])
    table = lake.read("silver.p").select("k", "d", "v")
    assert rows(table) == [(1, "a", "x"), (2, "b", "z"), (3, None, "n"), (4, "c", "w"), (5, None, "m")]
    assert {r[0] for r in lake.read("silver.p").filter("d = 'a'").select("_metadata.file_path").collect()} == files


def test_backfill_runs_once(spark, lake):
    lake.create("silver.f", frame(spark, [(1, "a", "x"), (2, "b", "y")]), ["d"])
    dimension = frame(spark, [(1, "N"), (2, "S")], "k int, region string")
    assert lake.backfill("silver.f", dimension, "k", "region")
    assert rows(lake.read("silver.f").select("k", "region")) == [(1, "N"), (2, "S")]
    assert not lake.backfill("silver.f", dimension, "k", "region")


def test_sql_functions_follow_the_membership_table(spark, lake):
    security.install_masks(lake)
    reader = spark.sql("SELECT session_user()").first()[0]
    security.set_groups(lake, "somebody else", {security.ENGINEERS})
    calls = "gold.mask_customer_id('C'), gold.mask_lclid('L'), gold.mask_financial_value(1.5D), gold.region_filter('SOUTH')"

    def view(groups):
        security.set_groups(lake, reader, groups)
        return tuple(spark.sql(f"SELECT {calls}").first())

    assert view({security.ENGINEERS}) == ("C", "L", 1.5, True)
    assert view({security.ANALYSTS, "north_team"}) == ("********", "********", 1.5, False)
    spark.sql(f"DECLARE OR REPLACE VARIABLE reader_groups ARRAY<STRING> DEFAULT array('{security.ENGINEERS}')")
    assert view(set()) == ("********", "********", None, True)
    spark.sql("DROP TEMPORARY VARIABLE reader_groups")


def test_lakes_stand_side_by_side(spark, lake, tmp_path):
    other = Lake(spark, str(tmp_path / "other"), prefix="other_")
    lake.upsert("silver.t", frame(spark, [(1, "a", "x")]), ["k"])
    assert not other.exists("silver.t")
    other.upsert("silver.t", frame(spark, [(2, "b", "y")]), ["k"], ["d"])
    other.upsert("silver.t", frame(spark, [(3, "c", "z")]), ["k"], ["d"])
    assert (rows(lake.read("silver.t").select("k")), rows(other.read("silver.t").select("k"))) == ([(1,)], [(2,), (3,)])
    other.forget()
    again = Lake(spark, other.root, prefix="again_")
    assert rows(again.read("silver.t").select("k")) == [(2,), (3,)]
    again.forget()


def test_contract_tables(spark, lake):
    for table, contract in CONTRACTS.items():
        lake.create_from_contract(table, contract)
        statuses = {r.status for r in check_contract(lake.read(table), contract).collect()}
        assert statuses == {"ok"}, table
    expected = {"silver.dim_customer": 12, "silver.dim_date": 15, "silver.dim_meter": 16, "silver.dq_failures": 7}
    assert {t: len(lake.read(t).columns) for t in expected} == expected


def test_contract_violations(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string")
    report = null_violations(df, "a INT NOT NULL, b STRING NOT NULL, c INT")
    assert rows(report) == [("a", 1), ("b", 2)]


def test_check_names_are_unique_per_table():
    for table, layout in LAYOUTS.items():
        names = [c["name"] for c in layout.checks]
        assert len(names) == len(set(names)), table


def test_a_load_evaluates_its_transformation_once(spark, lake):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    raw = [("2024-01", 1, 2, 3.0, 4.0, 5.0, 6.0), ("2024-02", 1, 2, 3.0, 4.0, 5.0, 6.0)]
    ddl = "billing_period string, customer_count long, meter_count long, total_consumption_kwh double, "
    ddl += "total_revenue double, avg_consumption_kwh double, avg_bill_amount double"
    for expected in (2, 4):  # create, then merge
        load(lake, "gold.gold_revenue_summary", frame(spark, raw, ddl).mapInPandas(count, ddl))
        assert seen.value == expected


def test_late_readings_do_not_bring_old_attributes_back(spark):
    ddl = "LCLid string, DateTime string, stdorToU string"
    late = frame(spark, [("A", "2024-01-01", "Std"), ("B", "2024-01-05", "ToU"), ("N", "2024-01-01", "Std")], ddl)
    held = frame(spark, [("A", "2024-01-03"), ("B", "2024-01-03")], "LCLid string, DateTime string")
    assert rows(not_older(late, held)) == [("B", "2024-01-05", "ToU"), ("N", "2024-01-01", "Std")]
    assert not_older(late, None) is late


# --- the whole refresh --------------------------------------------------------------------------------------------


def write_readings(spark, folder, raw, mode="append"):
    df = spark.createDataFrame(raw, "LCLid string, stdorToU string, DateTime string, kwh string")
    df = df.withColumnRenamed("kwh", bronze.RAW_CONSUMPTION_HEADER)
    df.coalesce(1).write.mode(mode).option("header", True).option("ignoreTrailingWhiteSpace", False).csv(folder)


def reading(meter, day, minute, kwh, kind="Std"):
    return (meter, kind, f"2024-01-{day:02d} 00:{minute:02d}:00", kwh)


def test_refresh_twice_with_overlap(spark, lake, tmp_path):
    raw = {name: str(tmp_path / "raw" / name) for name in ("readings", "weather", "demand", "tariff")}
    tariff = [("2024-01-01 00:00:00", "Low"), ("2024-01-01 00:30:00", "High"), ("2024-01-02 00:00:00", "Normal")]
    spark.createDataFrame(tariff, "TariffDateTime string, Tariff string").write.option("header", True).csv(raw["tariff"])
    weather = spark.createDataFrame(
        [("2024-01-01T00:00", 5.0, 50, 1.0, 0.0), ("2024-01-01T00:30", 6.0, 50, 1.0, 0.0)],
        "timestamp string, temperature double, humidity bigint, wind_speed double, precipitation double",
    )
    landing.land_raw(weather, raw["weather"], "OPEN_METEO", "20240101_060000")
    demand = spark.createDataFrame(
        [("2024-01-01T00", "R", "Resp", "D", "Demand", "12.5", "mwh")],
        ["period", "respondent", "respondent-name", "type", "type-name", "value", "value-units"],
    )
    landing.land_raw(demand, raw["demand"], "EIA", "20240101_060000")
    inputs = RawInputs(raw["readings"] + "/*.csv", raw["weather"], raw["demand"], raw["tariff"] + "/*.csv")

    write_readings(
        spark,
        raw["readings"],
        [
            reading("B", 1, 0, "1.0"),
            reading("D", 1, 10, "2.0", "ToU"),
            reading("D", 1, 40, "Null", "ToU"),
            reading("B", 1, 0, "1.0"),
        ],
    )
    refresh(lake, inputs, "run-1", datetime(2024, 1, 1, 6))
    keys = "LCLid", "customer_key", "customer_id", "tariff_id"
    first = rows(lake.read("silver.dim_customer").select(*keys))
    assert first == [("B", 1, "CUST000001", "TAR001"), ("D", 2, "CUST000002", "TAR002")]
    bills = lake.read("silver.fact_billing").select("customer_key", F.round("bill_amount", 9))
    assert rows(bills) == [(1, 0.15), (2, 0.16)]

    # The second delivery repeats the first files, corrects a value and brings a new meter and a new day.
    write_readings(spark, raw["readings"], [reading("A", 2, 0, "4.0", "ToU"), reading("D", 1, 50, "3.0", "ToU")])
    refresh(lake, inputs, "run-2", datetime(2024, 1, 2, 6))
    assert rows(lake.read("silver.dim_customer").select("LCLid", "customer_key")) == [("A", 3), ("B", 1), ("D", 2)]
    fact = lake.read("silver.fact_consumption")
    assert rows(fact.select("customer_key", "date_key", "consumption_kwh")) == [
        (1, 20240101, 1.0),
        (2, 20240101, 2.0),
        (2, 20240101, 3.0),
        (3, 20240102, 4.0),
    ]
    bills = lake.read("silver.fact_billing").select("customer_key", F.round("bill_amount", 9))
    assert rows(bills) == [(1, 0.15), (2, 0.91), (3, 0.6)]
    assert rows(lake.read("gold.gold_peak_load").select("date_key", "reading_count")) == [(20240101, 3), (20240102, 1)]
    assert rows(lake.read("gold.gold_weather_impact").select("temperature_c", "total_consumption_kwh")) == [(6.0, 6.0)]
    revenue = lake.read("gold.gold_revenue_summary").select("billing_period", "customer_count", "total_consumption_kwh")
    assert rows(revenue) == [("2024-01", 3, 10.0)]
    # Two observations in one hour break the batch's unique check; the later one is the fact.  Run 2 has no new load.
    failures = lake.read(FAILURE_LOG).filter("dq_table = 'silver.fact_weather'")
    assert rows(failures.select("check_name", "failed_value")) == [("weather_business_key_unique", 1)]
    assert rows(lake.read(LINEAGE).groupBy("run_id").count().select("run_id")) == [("run-1",), ("run-2",)]
    for table, contract in CONTRACTS.items():
        bad = check_contract(lake.read(table), contract).filter("status <> 'ok'")
        assert rows(bad) == [], table


def test_stream_equals_batch_and_ignores_replays(spark, lake, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "progress")
    write_readings(spark, folder, [reading("A", 1, 0, "1.0"), reading("A", 1, 30, "2.0")])
    write_readings(spark, folder, [reading("A", 1, 30, "2.5"), reading("B", 2, 0, "3.0")])
    ingest_readings(lake, folder, checkpoint, files_per_batch=1)
    table = "bronze.bronze_meter_readings"
    assert lake.read(table).count() == 3
    write_readings(spark, folder, [reading("B", 2, 0, "3.0"), reading("C", 2, 0, "4.0")])
    ingest_readings(lake, folder, checkpoint)
    assert rows(lake.read(table).select("LCLid").distinct()) == [("A",), ("B",), ("C",)]
    assert lake.read(table).count() == 4


def test_streamed_rows_and_those_of_a_dead_run_reach_the_facts(spark, lake, tmp_path, monkeypatch):
    raw = {name: str(tmp_path / "raw" / name) for name in ("readings", "stream", "weather", "demand", "tariff", "feeders", "events")}
    spark.createDataFrame([("2024-01-01 00:00:00", "Low")], "TariffDateTime string, Tariff string").write.option("header", True).csv(raw["tariff"])
    weather = [("2024-01-01T00", 5.0, 50, 1.0, 0.0)]
    weather = spark.createDataFrame(weather, "timestamp string, temperature double, humidity bigint, wind_speed double, precipitation double")
    landing.land_raw(weather, raw["weather"], "OPEN_METEO", "20240101_060000")
    demand = [("2024-01-01T00", "R", "Resp", "D", "Demand", "12.5", "mwh")]
    demand = spark.createDataFrame(demand, ["period", "respondent", "respondent-name", "type", "type-name", "value", "value-units"])
    landing.land_raw(demand, raw["demand"], "EIA", "20240101_060000")
    feeders = [("F1", "S1", "2024-01-01 00:00:00", "230.0", "100"), ("F1", "S1", "2024-01-01 00:00:00", "230.0", "100")]
    spark.createDataFrame(feeders, bronze.FEEDER_COLUMNS).write.option("header", True).csv(raw["feeders"])
    events = [("E1", "A", "OUTAGE", "2024-01-01 00:10:00"), ("E2", "A", "odd", "2024-01-01 00:20:00")]
    spark.createDataFrame(events, bronze.EVENT_COLUMNS).write.option("header", True).csv(raw["events"])
    glob = {k: v + "/*.csv" for k, v in raw.items()}
    landed = RawInputs(glob["readings"], raw["weather"], raw["demand"], glob["tariff"], glob["feeders"], glob["events"])
    write_readings(spark, raw["readings"], [reading("A", 1, 0, "1.0"), reading("B", 2, 0, "2.0")])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("meterlake.plans.refresh.build_facts", dies)
        with pytest.raises(RuntimeError):
            refresh(lake, landed, "run-1", datetime(2024, 1, 1, 6))
    assert not lake.exists("silver.fact_consumption")
    write_readings(spark, raw["stream"], [reading("S", 1, 0, "4.0"), reading("B", 2, 0, "3.0")])
    ingest_readings(lake, raw["stream"], str(tmp_path / "progress"))

    # Neither the dead run's reading files nor the streamed ones are delivered again.
    later = RawInputs(None, raw["weather"], raw["demand"], glob["tariff"])
    for run in ("run-2", "run-3"):
        refresh(lake, later, run, datetime(2024, 1, 2, 6))
        fact = lake.read("silver.fact_consumption").join(lake.read("silver.dim_meter").select("meter_key", "LCLid"), "meter_key")
        assert rows(fact.select("LCLid", "consumption_kwh")) == [("A", 1.0), ("B", 3.0), ("S", 4.0)]
        assert lake.read("silver.fact_weather").count() == lake.read("silver.fact_eia_demand").count() == 1
        assert rows(lake.read("silver.fact_feeder_readings").select("feeder_id", "voltage_v", "current_a")) == [("F1", 230.0, 100.0)]
        assert rows(lake.read("silver.fact_meter_events").select("event_id")) == [("E1",), ("E2",)]
    assert unbuilt_batches(lake)[1] == []


# --- sources ------------------------------------------------------------------------------------------------------


def test_calendar(spark):
    dates = calendar.date_dimension(spark)
    assert dates.count() == 9496
    row = dates.filter("date_key = 20240229").first()
    assert (row.quarter, row.month_name, row.day_name, row.week_of_year, row.day_of_week, row.is_weekend) == (
        1,
        "February",
        "Thursday",
        9,
        5,
        False,
    )


def test_record_and_array_payloads(spark):
    df = spark.createDataFrame(
        [('{"response":{"data":[{"a-b":"x","v":1},{"v":2}]}}', '{"hourly":{"time":["t1","t2"],"temp":[1.5]}}'), ("bad", "{}")],
        "records string, arrays string",
    )
    assert rows(payloads.explode_records(df, "records", "`a-b`:string,v:bigint")) == [("x", 1), (None, 2)]
    zipped = payloads.zip_arrays(df, "arrays", "hourly", {"at": ("time", "string"), "deg": ("temp", "double")})
    assert rows(zipped) == [("t1", 1.5), ("t2", None)]


def test_csv_scan_keeps_text_and_renames(spark, tmp_path):
    write_readings(spark, str(tmp_path / "csv"), [("007", "Std", "2024-01-01", "Null")])
    df = readers.scan_csv(spark, f"{tmp_path}/csv/*.csv", renames=bronze.READING_RENAMES)
    assert df.columns == ["LCLid", "stdorToU", "DateTime", "kwh_hh"]
    assert rows(df) == [("007", "Std", "2024-01-01", "Null")]


def write_lines(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_csv_columns_go_by_name(spark, tmp_path):
    """Files of one folder with different orders and extra columns; a file that lacks a column raises."""
    folder = tmp_path / "mixed"
    kwh = bronze.RAW_CONSUMPTION_HEADER
    write_lines(folder, "a.csv", f"LCLid,stdorToU,DateTime,{kwh}", "A,Std,2024-01-01 00:00:00,1.0")
    write_lines(folder, "b.csv", f"DateTime,note,LCLid,{kwh},stdorToU", "2024-01-01 00:30:00,x,B,2.0,ToU")
    df = readers.scan_csv(spark, f"{folder}/*.csv", bronze.RAW_READING_COLUMNS, bronze.READING_RENAMES)
    assert rows(df) == [("A", "Std", "2024-01-01 00:00:00", "1.0"), ("B", "ToU", "2024-01-01 00:30:00", "2.0")]
    every = readers.scan_csv(spark, f"{folder}/*.csv")
    assert rows(every.select("LCLid", "note")) == [("A", None), ("B", "x")]
    write_lines(folder, "c.csv", "LCLid,DateTime", "C,2024-01-01 00:30:00")
    with pytest.raises(ValueError, match="no column stdorToU"):
        readers.scan_csv(spark, f"{folder}/*.csv", bronze.RAW_READING_COLUMNS)


def test_lines_that_do_not_fit_are_set_apart(spark, tmp_path):
    folder = tmp_path / "bad"
    write_lines(folder, "a.csv", "at,name,n", "2024-01-01 00:00:00,ok,1", "2024-01-01,short", "2024-01-01 00:00:00,long,2,3")
    write_lines(folder, "b.csv", "n,at,name", 'x,"not, a time",two', ",,", "7,2024-01-02 00:00:00,")
    write_lines(folder, "c.csv", "note,n,at,name", "x,1", "x,1,2024-01-01 00:00:00,extra,more")
    scan = readers.scan_csv_checked(spark, f"{folder}/*.csv", StructType.fromDDL("at timestamp_ntz, name string, n int"))
    assert rows(scan.rows.select("name", "n")) == [("ok", 1), (None, 7), (None, None)]
    assert rows(scan.quarantine.select("line", "reason")) == sorted(
        [
            ("2024-01-01 00:00:00,long,2,3", "wrong number of fields"),
            ("2024-01-01,short", "wrong number of fields"),
            ("x,1", "wrong number of fields"),
            ("x,1,2024-01-01 00:00:00,extra,more", "wrong number of fields"),
            ('x,"not, a time",two', "n is no int; at is no timestamp_ntz"),
        ],
        key=repr,
    )
    (tmp_path / "none").mkdir()
    write_lines(tmp_path / "none", "empty.csv")
    (tmp_path / "none" / "empty.csv").write_text("")
    assert readers.scan_csv(spark, f"{tmp_path}/none/*.csv", ["a"]).collect() == []


def test_bad_lines_of_a_delivery_are_kept(spark, lake, tmp_path):
    """A tariff line without a time and a streamed line without its last field stay readable, once, however often delivered."""
    tariff, stream = tmp_path / "tariff", tmp_path / "stream"
    write_lines(tariff, "t.csv", "Tariff,TariffDateTime", "Low,2024-01-01 00:00:00", "High,soon")
    schema = StructType.fromDDL("TariffDateTime TIMESTAMP_NTZ, Tariff STRING")
    for _ in range(2):
        good = checked_csv(lake, "bronze.bronze_tariff", f"{tariff}/*.csv", schema)
    assert rows(good.select("Tariff")) == [("Low",)]
    kwh = bronze.RAW_CONSUMPTION_HEADER
    write_lines(stream, "r.csv", f"DateTime,LCLid,{kwh},stdorToU", "2024-01-01 00:00:00,A,1.0,Std", "2024-01-01 00:30:00,A")
    ingest_readings(lake, str(stream), str(tmp_path / "progress"))
    assert rows(lake.read("bronze.bronze_meter_readings").select("LCLid", "kwh_hh")) == [("A", "1.0")]
    kept = lake.read(QUARANTINE).select("table_name", "line", "reason")
    assert rows(kept) == [
        ("bronze.bronze_meter_readings", "2024-01-01 00:30:00,A", "wrong number of fields"),
        ("bronze.bronze_tariff", "High,soon", "TariffDateTime is no timestamp_ntz"),
    ]


def test_staged_frames_go_when_the_work_is_done(spark):
    import os

    def there(frame):
        return [os.path.exists(f.removeprefix("file://")) for f in files[frame]]

    files = {}
    with staging.released(spark):
        frames = {"own": staging.stage(spark.range(3)), **dict(zip("ab", staging.side_by_side([lambda: staging.stage(spark.range(3))] * 2)))}
        files = {name: df.inputFiles() for name, df in frames.items()}
        assert all(all(there(name)) for name in files)
    assert not any(any(there(name)) for name in files)
    outside = staging.stage(spark.range(3))
    assert outside.count() == 3


def test_meters_are_described_by_their_last_reading_in_time(spark):
    """Two formats of one moment's text: '2024-01-02' sorts after '2024-01-01T...', but not before every later text."""
    raw = spark.createDataFrame(
        [("A", "2024-01-09 00:00:00", "Std", "1"), ("A", " 2024-01-10 00:00:00", "ToU", "2"), ("A", "not a time", "odd", "3")],
        "LCLid string, DateTime string, stdorToU string, kwh_hh string",
    )
    assert rows(silver.latest_per_meter(raw, ["stdorToU"]).select("stdorToU")) == [("ToU",)]
    last = silver.last_readings(raw)
    assert rows(silver.dim_meter(last).select("stdorToU", "kwh_hh")) == [("ToU", "2")]
    assert rows(silver.dim_customer(last).select("customer_type")) == [("ToU",)]


def test_two_events_of_a_meter_at_one_moment_are_both_kept(spark, lake):
    raw = [("E1", "A", "OUTAGE", "2024-01-01 00:10:00"), ("E2", "A", "RESTORE", "2024-01-01 00:10:00")]
    for part in (raw[:1], raw):
        load(lake, "bronze.bronze_meter_events", bronze.bronze_meter_events(spark.createDataFrame(part, bronze.EVENT_COLUMNS)))
    assert rows(lake.read("bronze.bronze_meter_events").select("event_id")) == [("E1",), ("E2",)]


def test_missing_table_is_none(spark):
    assert readers.scan_table(spark, "nowhere_at_all") is None


def test_half_hour_pushes_no_rows_to_python(spark):
    plan = spark.range(5).select(floor_minutes(F.timestamp_seconds("id")))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_retyped_values_are_cast_or_refused(spark, lake):
    for name, by in (("bronze.retyped_flat", None), ("bronze.retyped_parts", ["p"])):
        lake.upsert(name, spark.createDataFrame([(1, 1, 5)], "k int, p int, v bigint"), ["k", "p"], by)
        lake.upsert(name, spark.createDataFrame([(2, 1, 6.0), (3, 1, None)], "k int, p int, v double"), ["k", "p"])
        assert dict(lake.read(name).dtypes)["v"] == "bigint"
        with pytest.raises(TypeError, match="v"):
            lake.upsert(name, spark.createDataFrame([(4, 1, 2.5)], "k int, p int, v double"), ["k", "p"])
        assert sorted((r.k, r.v) for r in lake.read(name).collect()) == [(1, 5), (2, 6), (3, None)]


def test_loads_are_told_apart_by_record_not_by_time(spark, tmp_path):
    root = str(tmp_path / "landed")
    for load_id, x in (("20240102_060000", 1), ("20231220_060000", 2), ("odd: id/1 %", 3)):
        landing.land_raw(spark.createDataFrame([(x,)], "x int"), root, "S", load_id)
    recorded = spark.createDataFrame([(root, "20240102_060000"), ("other", "20231220_060000")], "root string, _load_id string")
    late, ids = landing.new_loads(spark, root, recorded, provenance=True)
    assert ids == ["20231220_060000", "odd: id/1 %"]
    assert rows(late.select("_load_id", "x")) == [("20231220_060000", 2), ("odd: id/1 %", 3)]
    # The recorded load is not even listed: its folder may be gone.
    assert not [f for f in late.inputFiles() if "20240102" in f]
    assert landing.new_loads(spark, root, None)[0].count() == 3
    every = spark.createDataFrame([(root, i) for i in landing.load_ids(spark, root)], "root string, _load_id string")
    nothing, ids = landing.new_loads(spark, root, every)
    assert ids == [] and nothing.count() == 0 and "x" in nothing.columns


def test_changed_schedule_and_class_reach_earlier_months(spark, lake, tmp_path):
    raw = {name: str(tmp_path / "raw" / name) for name in ("readings", "weather", "demand", "tariff")}
    schema = "TariffDateTime string, Tariff string"

    def tariff(*found):
        spark.createDataFrame(found, schema).write.mode("append").option("header", True).csv(raw["tariff"])

    def observed(hour, load):
        frame = spark.createDataFrame(
            [(f"2024-01-01T{hour:02d}:00", 5.0, 50, 1.0, 0.0)],
            "timestamp string, temperature double, humidity bigint, wind_speed double, precipitation double",
        )
        landing.land_raw(frame, raw["weather"], "OPEN_METEO", load)

    observed(0, "20240301_060000")
    demand = spark.createDataFrame(
        [("2024-01-01T00", "R", "Resp", "D", "Demand", "12.5", "mwh")],
        ["period", "respondent", "respondent-name", "type", "type-name", "value", "value-units"],
    )
    landing.land_raw(demand, raw["demand"], "EIA", "20240301_060000")
    tariff(("2024-01-01 00:00:00", "Low"), ("2024-02-01 00:00:00", "Low"))
    inputs = RawInputs(raw["readings"] + "/*.csv", raw["weather"], raw["demand"], raw["tariff"] + "/*.csv")
    write_readings(spark, raw["readings"], [reading("A", 1, 0, "2.0", "ToU"), reading("B", 1, 0, "2.0")])
    refresh(lake, inputs, "run-1", datetime(2024, 3, 1, 6))
    # A rate of January changes, B becomes a time-of-use customer in February, and an old weather load comes late.
    tariff(("2024-01-01 00:00:00", "High"))
    observed(1, "20231220_060000")
    write_readings(spark, raw["readings"], [("B", "ToU", "2024-02-01 00:00:00", "1.0")])
    refresh(lake, inputs, "run-2", datetime(2024, 3, 2, 6))
    tables = (lake.read(f"silver.{t}") for t in ("fact_consumption", "dim_customer", "dim_meter", "tariff_schedule"))
    amounts = ["customer_key", "billing_period", F.round("bill_amount", 9)]
    assert rows(lake.read("silver.fact_billing").select(*amounts)) == rows(rating.bill(*tables).select(*amounts))
    assert lake.read("bronze.bronze_weather").count() == 2 and lake.read("silver.fact_weather").count() == 2


@pytest.mark.parametrize("step", ["build_facts", "build_marts"])
def test_months_reached_by_a_dead_run_are_rebuilt(spark, lake, tmp_path, monkeypatch, step):
    """A run that dies after its dimensions leaves the months of a changed rate and a changed class to the next one."""
    raw = {name: str(tmp_path / "raw" / name) for name in ("readings", "weather", "demand", "tariff")}

    def tariff(*found):
        spark.createDataFrame(found, "TariffDateTime string, Tariff string").write.mode("append").option("header", True).csv(raw["tariff"])

    weather = [("2024-01-01T00:00", 5.0, 50, 1.0, 0.0)]
    weather = spark.createDataFrame(weather, "timestamp string, temperature double, humidity bigint, wind_speed double, precipitation double")
    landing.land_raw(weather, raw["weather"], "OPEN_METEO", "20240301_060000")
    demand = [("2024-01-01T00", "R", "Resp", "D", "Demand", "12.5", "mwh")]
    demand = spark.createDataFrame(demand, ["period", "respondent", "respondent-name", "type", "type-name", "value", "value-units"])
    landing.land_raw(demand, raw["demand"], "EIA", "20240301_060000")
    tariff(("2024-01-01 00:00:00", "Low"), ("2024-02-01 00:00:00", "Low"), ("2024-03-01 00:00:00", "Low"))
    inputs = RawInputs(raw["readings"] + "/*.csv", raw["weather"], raw["demand"], raw["tariff"] + "/*.csv")
    old = [("A", "ToU", "2024-01-01 00:00:00", "2.0"), ("B", "Std", "2024-02-01 00:00:00", "2.0")]
    write_readings(spark, raw["readings"], old)
    refresh(lake, inputs, "run-1", datetime(2024, 3, 1, 6))
    # The rate of January changes, and B, so far billed in February, becomes a time-of-use customer in March.
    tariff(("2024-01-01 00:00:00", "High"))
    write_readings(spark, raw["readings"], [("B", "ToU", "2024-03-01 00:00:00", "1.0")])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(f"meterlake.plans.refresh.{step}", dies)
        with pytest.raises(RuntimeError):
            refresh(lake, inputs, "run-2", datetime(2024, 3, 2, 6))
    assert {month for month, _ in unsettled_months(lake)} == {202401, 202402}
    refresh(lake, RawInputs(None, *(getattr(inputs, k) for k in ("weather", "demand", "tariff_csv"))), "run-3", datetime(2024, 3, 3, 6))
    tables = [lake.read(f"silver.{t}") for t in ("fact_consumption", "dim_customer", "dim_meter", "tariff_schedule")]
    amounts = ["customer_key", "billing_period", "tariff_id", F.round("bill_amount", 9)]
    assert rows(lake.read("silver.fact_billing").select(*amounts)) == rows(rating.bill(*tables).select(*amounts))
    revenue = marts.revenue_summary(lake.read("silver.fact_billing"))
    assert rows(lake.read("gold.gold_revenue_summary").select(*revenue.columns)) == rows(revenue)
    theft = marts.theft_detection(tables[0], tables[1])
    assert rows(lake.read("gold.gold_theft_detection").select(*theft.columns)) == rows(theft)
    assert unsettled_months(lake) == []


def test_a_lake_opens_again_under_an_empty_catalog(spark, lake):
    lake.upsert("silver.t", frame(spark, [(1, "a", "x"), (2, "a", "y")]), ["k"])
    lake.upsert("silver.t", frame(spark, [(2, "a", "z")]), ["k"])
    lake.upsert("silver.p", frame(spark, [(1, "2024-01", "x"), (2, None, "y")]), ["k"], ["d"])
    lake.upsert("silver.p", frame(spark, [(3, "2024-02", "n", 7)], "k int, d string, v string, w int"), ["k"], ["d"])
    before = {t: (rows(lake.read(t)), lake.read(t).dtypes) for t in ("silver.t", "silver.p")}
    for table in before:
        spark.sql(f"DROP TABLE {table}")
    again = Lake(spark, lake.root)
    assert {t: (rows(again.read(t)), again.read(t).dtypes) for t in before} == before
    again.upsert("silver.t", frame(spark, [(3, "b", "n")]), ["k"])
    assert rows(again.read("silver.t").select("k")) == [(1,), (2,), (3,)]
    again.upsert("silver.p", frame(spark, [(1, "2024-01", "later", None)], "k int, d string, v string, w int"), ["k"], ["d"])
    assert rows(again.read("silver.p").select("k", "v")) == [(1, "later"), (2, "y"), (3, "n")]


def test_old_versions_go(spark, tmp_path):
    for schema in SCHEMAS:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
    lake = Lake(spark, str(tmp_path / "lake"), keep_versions=2)
    for i in range(5):
        lake.upsert("silver.t", frame(spark, [(i, "a", "x")]), ["k"])
    assert len(list((tmp_path / "lake" / "silver" / "t").glob("v=*"))) == 2
    assert lake.read("silver.t").count() == 5


def test_a_tariff_correction_takes_effect(spark):
    ddl = "TariffDateTime string, Tariff string, load_ts string"
    for first, second in (("Low", "High"), ("High", "Low")):
        raw = spark.createDataFrame(
            [("2024-01-01 00:00:00", first, "2024-01-01 06:00:00"), ("2024-01-01 00:00:00", second, "2024-01-02 06:00:00")], ddl
        ).selectExpr("CAST(TariffDateTime AS TIMESTAMP_NTZ) AS TariffDateTime", "Tariff", "CAST(load_ts AS TIMESTAMP) AS load_ts")
        assert rows(rating.tariff_schedule(raw).select("tariff_name")) == [(second,)]


def test_a_customer_who_moved_has_one_bill(spark):
    facts = spark.createDataFrame(
        [(1, 1, "2024-01-01 00:00:00", 1.0, "N"), (1, 1, "2024-01-02 00:00:00", 2.0, "S")],
        "customer_key int, meter_key int, reading_timestamp string, consumption_kwh double, region string",
    ).withColumn("reading_timestamp", F.col("reading_timestamp").cast("timestamp_ntz"))
    customers = spark.createDataFrame([(1, "C", "TAR001", "Std", "S")], "customer_key int, customer_id string, tariff_id string, customer_type string, region string")
    meters = spark.createDataFrame([(1, "M")], "meter_key int, meter_id string")
    schedule = spark.createDataFrame([], "tariff_half_hour timestamp_ntz, rate_per_kwh double")
    bills = rating.bill(facts, customers, meters, schedule)
    assert rows(bills.select("region", "consumption_kwh")) == [("S", 3.0)]


def test_the_newest_file_wins_within_a_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    for kwh in ("9.0", "1.0", "5.0"):  # neither the smallest nor the largest text comes last
        write_readings(spark, folder, [reading("A", 1, 0, kwh)])
    raw = readers.scan_csv(spark, folder + "/*.csv", bronze.RAW_READING_COLUMNS, bronze.READING_RENAMES, provenance=True)
    raw = raw.withColumn("_file_time", F.col("source_file_modification_time")).drop(*readers.PROVENANCE)
    assert rows(bronze.bronze_readings(raw).select("kwh_hh")) == [("5.0",)]
