"""As-of lookups, gap filling, histories from snapshots, and aggregates kept by deliveries."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterlake.operators import states
from meterlake.operators.asof import asof_join, densify_carry
from meterlake.operators.scd import open_history, scd2_apply, scd2_sequence

START = datetime(2024, 1, 1)


def moment(seconds):
    return START + timedelta(seconds=seconds)


@pytest.mark.parametrize("rows_a_task", [3, 100_000])
def test_asof_join_by_group(spark, rows_a_task):
    """Against a search per row: times on no grid, groups without changes, NULL times, groups and values, hot buckets."""
    rnd = random.Random(rows_a_task)
    spots = [rnd.randrange(9 * 86400) for _ in range(40)]
    facts = [(i, rnd.choice(["a", "b", "c", None]), moment(rnd.choice(spots + [rnd.randrange(9 * 86400)]))) for i in range(300)]
    facts += [(1000 + i, "a", moment(3 * 86400 + i)) for i in range(200)] + [(2000, "a", None), (2001, None, None)]
    seen, points = set(), []
    for _ in range(60):
        key, at = rnd.choice(["a", "b", "d"]), rnd.choice(spots)
        if (key, at) not in seen:
            seen.add((key, at))
            points.append((key, moment(at), rnd.choice([1.5, 2.5, None]), rnd.randrange(9)))
    points += [(None, moment(5), 9.0, 9), ("a", None, 9.0, 9)]
    left = spark.createDataFrame(facts, "i int, k string, at timestamp_ntz")
    right = spark.createDataFrame(points, "k string, since timestamp_ntz, rate double, code int")
    got = asof_join(left, right, "at", "since", ["k"], rows_a_task=rows_a_task)
    assert got.columns == ["i", "k", "at", "since", "rate", "code"]
    want = []
    for i, k, at in facts:
        known = [p for p in points if None not in (p[0], p[1], k, at) and p[0] == k and p[1] <= at]
        want.append((i, k, at, *(max(known, key=lambda p: p[1])[1:] if known else (None,) * 3)))
    assert rows(got) == sorted(want, key=repr)


def test_asof_join_absurd_times(spark):
    """A reading of the year 9999 and one of the year 1 cost one bucket each."""
    left = spark.createDataFrame([(1, datetime(9999, 12, 31, 23)), (2, datetime(1, 1, 2)), (3, START)], "i int, at timestamp_ntz")
    right = spark.createDataFrame([(START, 0.5), (moment(0.5), 0.7), (START, 0.6)], "since timestamp_ntz, rate double")
    assert rows(asof_join(left, right, "at", "since").select("i", "rate")) == [(1, 0.7), (2, None), (3, 0.5)]
    assert rows(asof_join(left, right.limit(0), "at", "since").select("i", "rate")) == [(1, None), (2, None), (3, None)]
    assert asof_join(left.limit(0), right, "at", "since").collect() == []
    with pytest.raises(ValueError, match="rate"):
        asof_join(left.withColumn("rate", F.lit(1)), right, "at", "since")


def test_densify_carries_over_gaps_and_days(spark):
    slots = spark.createDataFrame([(moment(h * 3600),) for h in (0, 1, 2, 30, 31)], "slot timestamp_ntz")
    measured = spark.createDataFrame([(moment(3600), "n", 5.0), (moment(31 * 3600), "n", 7.0)], "slot timestamp_ntz, side string, v double")
    out = densify_carry(measured, slots, [("n",), ("s",)], ["side"], "slot")
    got = rows(out.select("side", F.hour("slot") + 24 * (F.dayofmonth("slot") - 1), "v"))
    assert got == [("n", 0, None), ("n", 1, 5.0), ("n", 2, 5.0), ("n", 30, 5.0), ("n", 31, 7.0), *(("s", h, None) for h in (0, 1, 2, 30, 31))]
    assert out.where("v = 5 AND measured_slot <> TIMESTAMP_NTZ '2024-01-01 01:00:00'").count() == 0


def test_a_sequence_of_snapshots_is_that_many_steps(spark):
    """Unchanged, changed, vanished, new and returning keys; NULL attributes; a snapshot date that only one key is in."""
    rnd = random.Random(3)
    days = [START + timedelta(days=d) for d in (0, 3, 4, 10, 40)]
    raw = [(f"k{k}", rnd.choice(["x", "y", None]), rnd.choice([1, None]), day) for k in range(40) for day in days if rnd.random() < 0.7]
    raw.append(("alone", "x", 1, START + timedelta(days=99)))
    days.append(START + timedelta(days=99))
    snapshots = spark.createDataFrame(raw, "k string, a string, b int, at timestamp_ntz")

    def at(day):
        return F.lit(str(day)).cast("timestamp_ntz")

    stepped = open_history(snapshots.where(F.col("at") == at(days[0])).drop("at"), at(days[0]))
    for day in days[1:]:
        after = scd2_apply(stepped, snapshots.where(F.col("at") == at(day)).drop("at"), ["k"], at(day))
        stepped = spark.createDataFrame(after.collect(), stepped.schema)
    told = scd2_sequence(snapshots, ["k"], "at")
    assert told.columns == stepped.columns
    assert rows(told) == rows(stepped)


LOADS = "id int, g string, v double"


def test_load_state_follows_deliveries(spark):
    """Three deliveries: values that shrink, groups that empty or appear, NULL measures and groups, rows delivered unchanged."""
    rnd = random.Random(7)
    held = spark.createDataFrame([(i, rnd.choice(["a", "b", None]), float(rnd.randrange(9))) for i in range(60)] + [(90, "gone", 1.0)], LOADS)
    state = states.load_state(held, ["g"], "v")
    for step in range(3):
        new = [(i, rnd.choice(["a", "b", "new", None]), rnd.choice([None, float(rnd.randrange(9))])) for i in rnd.sample(range(80), 30)]
        new += [(90, "moved", 2.0)] if step == 1 else []
        new += [tuple(r) for r in held.where("id < 3").collect() if r.id not in {n[0] for n in new}]
        delivered = spark.createDataFrame(new, LOADS)
        gone, come = states.changes_of(held, delivered, ["id"])
        now = held.join(delivered.select("id"), "id", "left_anti").unionByName(delivered)
        now = spark.createDataFrame(now.collect(), LOADS)
        state = spark.createDataFrame(states.apply_load(state, gone, come, now, ["g"], "v").collect(), state.schema)
        held = now
        assert rows(state) == rows(states.load_state(held, ["g"], "v"))


def test_moments_follow_deliveries(spark):
    rnd = random.Random(11)
    held = spark.createDataFrame([(i, rnd.choice(["a", "b", None]), rnd.random()) for i in range(60)] + [(90, "gone", 1.0)], LOADS)
    state = states.moments(held, ["g"], "v")
    for step in range(3):
        new = [(i, rnd.choice(["a", "b", "new"]), rnd.random()) for i in rnd.sample(range(80), 30)] + ([(90, "one", 2.0)] if step else [])
        delivered = spark.createDataFrame(new, LOADS)
        gone, come = states.changes_of(held, delivered, ["id"])
        state = spark.createDataFrame(states.apply_moments(state, gone, come, ["g"], "v").collect(), state.schema)
        held = spark.createDataFrame(held.join(delivered.select("id"), "id", "left_anti").unionByName(delivered).collect(), LOADS)
        want = held.groupBy("g").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
        got = state.select("g", "n", "mean", states.spread(state))
        for a, b in zip(rows(got), rows(want), strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-7)


def test_many_delivered_keys_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Keys counted as too many are not broadcast on the size of their stored file."""
    spark.range(2000).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("g"), F.lit(1.0).alias("v")).write.parquet(f"{tmp_path}/held")
    held = spark.read.parquet(f"{tmp_path}/held")
    monkeypatch.setattr(states, "BROADCAST_BYTES", 1000, raising=False)
    gone, come = states.changes_of(held, held.where("id % 2 = 0"), ["id"])
    assert "Broadcast" not in gone._jdf.queryExecution().executedPlan().toString()
    assert gone.count() == come.count() == 1000


def test_sketches_unite(spark):
    df = spark.range(20_000).select(F.expr("id % 30").alias("day"), F.expr("id % 7000").alias("member"))
    daily = states.distinct_sketches(df, ["day"], ["member"])
    total = states.united(daily.withColumn("all", F.lit(1)), ["all"], ["member"]).first().member_count
    assert abs(total - 7000) <= 0.05 * 7000
