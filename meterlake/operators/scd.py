"""Slowly changing dimensions, type 2, from full snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.operators.lookups import lookup_join
from meterlake.sources.staging import stage

HISTORY_COLUMNS = ["valid_from", "valid_to", "is_current"]


def open_history(snapshot: DataFrame, as_of: Column) -> DataFrame:
    """First load: every snapshot row becomes an open row."""
    return snapshot.withColumns(
        {"valid_from": as_of, "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)}
    )


def scd2_apply(history: DataFrame, snapshot: DataFrame, keys: list[str], as_of: Column) -> DataFrame:
    """Next state of ``history`` after ``snapshot`` (one row per non-NULL key).

    New key: open a row.  Changed row: close the open one and open the new one.  Vanished key: close.  Unchanged: keep.
    One full outer join of the open rows with the snapshot; each pair yields one or two rows in place.
    """
    attributes = [c for c in snapshot.columns if c not in keys]
    old = history.filter("is_current").select(*keys, F.struct(*attributes, "valid_from").alias("__old"))
    new = snapshot.select(*keys, F.struct(*attributes).alias("__new"))

    def row(side: str, start: Column, end: Column, current: bool) -> Column:
        return F.struct(
            *[F.col(side).getField(a).alias(a) for a in attributes],
            start.alias("valid_from"),
            end.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    never = F.lit(None).cast("timestamp_ntz")
    began = F.col("__old").getField("valid_from")
    kept, closed = row("__old", began, never, True), row("__old", began, as_of, False)
    opened = row("__new", as_of, never, True)
    equal = reduce(
        lambda a, b: a & b,
        [F.col("__old").getField(a).eqNullSafe(F.col("__new").getField(a)) for a in attributes],
        F.lit(True),
    )
    is_new, vanished = F.col("__old").isNull(), F.col("__new").isNull()
    rows = (
        F.when(is_new, F.array(opened))
        .when(vanished, F.array(closed))
        .when(equal, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    stepped = old.join(new, keys, "full_outer").select(*keys, F.explode(rows).alias("__row")).select(*keys, "__row.*")
    columns = [*keys, *attributes, *HISTORY_COLUMNS]
    return stepped.select(*columns).unionByName(history.filter(~F.col("is_current")).select(*columns))


def scd2_sequence(snapshots: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The history that a sequence of full snapshots tells, in one pass: what `scd2_apply` gives, snapshot after snapshot.

    ``at`` dates the snapshots (NULL is no snapshot); each holds one row per non-NULL key.  A key's rows are islands of
    consecutive snapshots with equal attributes: a row is valid from the first snapshot of its island to the snapshot after its
    last one, open if there is none.  A key that vanishes is closed there, and opens anew when it returns.  The calendar of
    snapshots, one row each, is all that is ordered globally; a key's window holds its own rows.
    """
    attributes = [c for c in snapshots.columns if c not in (*keys, at)]
    dated = snapshots.where(F.col(at).isNotNull())
    order = Window.partitionBy(F.lit(1)).orderBy(at)
    calendar = dated.select(at).distinct().select(at, F.row_number().over(order).alias("__n"), F.lead(at).over(order).alias("__next"))
    placed = lookup_join(dated.withColumn("__now", F.struct(*attributes)), stage(calendar, "snapshots"), at, "inner")
    by_time = Window.partitionBy(*keys).orderBy("__n")
    follows = (F.lag("__n").over(by_time) == F.col("__n") - 1) & F.lag("__now").over(by_time).eqNullSafe(F.col("__now"))
    islands = placed.withColumn("__fresh", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    islands = islands.withColumn("__island", F.sum("__fresh").over(by_time))
    history = islands.groupBy(*keys, "__island").agg(
        F.min_by("__now", "__n").alias("__now"), F.min(at).alias("valid_from"), F.max_by("__next", "__n").alias("valid_to")
    )
    return history.select(*keys, "__now.*", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))
