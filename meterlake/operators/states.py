"""Aggregates kept as mergeable states: a delivery changes them by what it adds and takes out, without reading the rest again.

A change is a frame of rows that go and a frame of rows that come (`changes_of`).  Counts, sums, means and squared deviations
follow from both alone.  A maximum does not when its holder goes: only those groups are read again.  Groups are few against
rows, and partial states are made before the shuffle, so a hot group costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.lookups import BROADCAST_BYTES, at_most, row_bytes


def changes_of(held: DataFrame, delivered: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(gone, come): rows of ``held`` that ``delivered`` replaces, and all delivered rows.

    Both hold one row per key and the same columns; rows that come as they are stand on both sides and cancel out.
    The delivered keys are broadcast only if they were counted and found few.
    """
    replaced = delivered.select(*keys)
    few = at_most(delivered, BROADCAST_BYTES // row_bytes(replaced))
    gone = held.join(F.broadcast(replaced) if few else replaced.hint("merge"), keys, "left_semi")
    return gone.select(*held.columns), delivered.select(*held.columns)


# --- count, sum, maximum ----------------------------------------------------------------------------------------------


def load_state(rows: DataFrame, groups: list[str], measure: str) -> DataFrame:
    """groups, n, total, top of the rows whose measure is not NULL."""
    known = rows.where(F.col(measure).isNotNull()).groupBy(*groups)
    return known.agg(F.count(F.lit(1)).alias("n"), F.sum(measure).alias("total"), F.max(measure).alias("top"))


def apply_load(
    state: DataFrame, gone: DataFrame, come: DataFrame, now: DataFrame, groups: list[str], measure: str
) -> DataFrame:
    """The state after ``gone`` left and ``come`` arrived.

    ``now`` are all rows after the change; only the groups whose maximum left, and did not come back as large, are read in it.
    A group without rows is no longer there.
    """
    minus, plus = load_state(gone, groups, measure), load_state(come, groups, measure)
    minus = minus.select(*groups, *(F.col(c).alias(f"{c}_out") for c in ("n", "total", "top")))
    plus = plus.select(*groups, *(F.col(c).alias(f"{c}_in") for c in ("n", "total", "top")))
    both = _outer(_outer(state, plus, groups), minus, groups)
    zero = F.lit(0)
    merged = both.select(
        *groups,
        (F.coalesce("n", zero) + F.coalesce("n_in", zero) - F.coalesce("n_out", zero)).alias("n"),
        (F.coalesce("total", zero) + F.coalesce("total_in", zero) - F.coalesce("total_out", zero)).alias("total"),
        F.greatest("top", "top_in").alias("top"),
        F.coalesce((F.col("top_out") >= F.col("top")) & (F.coalesce(F.col("top_in") < F.col("top"), F.lit(True))), F.lit(False)).alias("__stale"),
    ).where("n > 0")
    stale = merged.where("__stale").select(*groups)
    tops = now.alias("a").join(stale.alias("b"), _same(groups), "left_semi").groupBy(*groups).agg(F.max(measure).alias("__top"))
    merged = merged.alias("a").join(tops.alias("b"), _same(groups), "left")
    return merged.select(*(f"a.{g}" for g in groups), "n", "total", F.when(F.col("__stale"), F.col("__top")).otherwise(F.col("top")).alias("top"))


# --- moments ----------------------------------------------------------------------------------------------------------


def moments(rows: DataFrame, groups: list[str], measure: str) -> DataFrame:
    """groups, n, mean, m2 (sum of squared deviations) of the rows whose measure is not NULL."""
    known = rows.where(F.col(measure).isNotNull()).groupBy(*groups)
    state = known.agg(F.count(F.lit(1)).alias("n"), F.avg(measure).alias("mean"), F.var_pop(measure).alias("v"))
    return state.select(*groups, "n", "mean", (F.col("v") * F.col("n")).alias("m2"))


def merge_moments(a: DataFrame, b: DataFrame, groups: list[str]) -> DataFrame:
    """State of the rows of both, from their states alone."""
    both = _outer(a, b.select(*groups, *(F.col(c).alias(f"{c}_b") for c in ("n", "mean", "m2"))), groups)
    n_a, n_b = F.coalesce("n", F.lit(0)), F.coalesce("n_b", F.lit(0))
    apart = F.coalesce("mean_b", "mean") - F.coalesce("mean", "mean_b")
    return both.select(
        *groups,
        (n_a + n_b).alias("n"),
        (F.coalesce("mean", "mean_b") + apart * n_b / (n_a + n_b)).alias("mean"),
        (F.coalesce("m2", F.lit(0.0)) + F.coalesce("m2_b", F.lit(0.0)) + apart * apart * n_a * n_b / (n_a + n_b)).alias("m2"),
    )


def retract_moments(a: DataFrame, b: DataFrame, groups: list[str]) -> DataFrame:
    """State of the rows of ``a`` without those of ``b``, which are among them; emptied groups are no longer there."""
    taken = b.select(*groups, *(F.col(c).alias(f"{c}_b") for c in ("n", "mean", "m2")))
    both = a.alias("a").join(taken.alias("b"), _same(groups), "left")
    both = both.select(*(f"a.{g}" for g in groups), "n", "mean", "m2", "n_b", "mean_b", "m2_b")
    n_b = F.coalesce("n_b", F.lit(0))
    left = F.col("n") - n_b
    mean = F.when(n_b == 0, F.col("mean")).otherwise((F.col("n") * F.col("mean") - n_b * F.col("mean_b")) / F.nullif(left, F.lit(0)))
    both = both.withColumn("__n", left).withColumn("__mean", mean).where("__n > 0")
    apart = F.col("mean_b") - F.col("__mean")
    m2 = F.col("m2") - F.col("m2_b") - apart * apart * F.col("__n") * n_b / F.col("n")
    return both.select(*groups, F.col("__n").alias("n"), F.col("__mean").alias("mean"), F.greatest(F.lit(0.0), F.coalesce(m2, "m2")).alias("m2"))


def apply_moments(state: DataFrame, gone: DataFrame, come: DataFrame, groups: list[str], measure: str) -> DataFrame:
    """The state after the values of ``gone`` were taken out and those of ``come`` put in.

    What comes is merged first: taking a value out of a group loses the least digits when the group is large.
    """
    grown = merge_moments(state, moments(come, groups, measure), groups)
    return retract_moments(grown, moments(gone, groups, measure), groups)


def spread(state: DataFrame) -> Column:
    """Population standard deviation of a state."""
    return F.sqrt(state["m2"] / state["n"])


def _same(groups: list[str]) -> Column:
    """Equal groups of the sides a and b, NULL members of a group key being equal."""
    return reduce(lambda x, y: x & y, [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups])


def _outer(a: DataFrame, b: DataFrame, groups: list[str]) -> DataFrame:
    joined = a.alias("a").join(b.alias("b"), _same(groups), "full_outer")
    rest = [F.col(f"{side}.{c}").alias(c) for side, df in (("a", a), ("b", b)) for c in df.columns if c not in groups]
    return joined.select(*(F.coalesce(F.col(f"a.{g}"), F.col(f"b.{g}")).alias(g) for g in groups), *rest)


# --- distinct counts --------------------------------------------------------------------------------------------------


def distinct_sketches(rows: DataFrame, groups: list[str], measures: list[str], precision: int = 14) -> DataFrame:
    """groups and, for each measure, <measure>_sketch: a mergeable sketch of its distinct values (relative error about
    1.04 / sqrt(2 ** precision))."""
    return rows.groupBy(*groups).agg(*(F.hll_sketch_agg(m, precision).alias(f"{m}_sketch") for m in measures))


def united(sketches: DataFrame, groups: list[str], measures: list[str]) -> DataFrame:
    """Estimated distinct counts of coarser groups, from sketches alone."""
    return sketches.groupBy(*groups).agg(
        *(F.hll_sketch_estimate(F.hll_union_agg(f"{m}_sketch", F.lit(True))).alias(f"{m}_count") for m in measures)
    )
