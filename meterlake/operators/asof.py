"""As-of lookups and gap filling along a time axis, without a dense schedule and without a global window.

Rows and change points meet in time buckets.  Inside a bucket each row takes the last change before it; what a bucket starts
with is carried in from the last change of the buckets before, one summary row for each bucket that holds anything.  A bucket
with many rows is dealt to several tasks, each with all changes of the bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.operators.dedup import dedup_latest
from meterlake.operators.grid import grid

ROWS_A_TASK = 100_000  # a group with more rows, and more than 1 / HOT_GROUPS of all rows, is dealt to several tasks
HOT_GROUPS = 1_000


def _present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns])


def asof_join(
    rows: DataFrame,
    changes: DataFrame,
    at: str,
    since: str,
    by: list[str] | None = None,
    unit: str = "day",
    rows_a_task: int = ROWS_A_TASK,
) -> DataFrame:
    """Each row with the columns of the last change of its ``by`` group whose ``since`` is at or before the row's ``at``.

    Where there is none, or ``at`` or a ``by`` column is NULL, they are NULL.  A change with NULL values counts: it ends the one
    before.  Of several changes at one moment the first by its values stays.  Times may lie anywhere and on no grid: the work
    follows the buckets (of length ``unit``) that hold rows or changes, not the time between them.
    """
    by = list(by or [])
    values = [c for c in changes.columns if c not in by]
    if clash := {*values} & {*rows.columns}:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")

    def bucket(column: str) -> Column:
        return F.date_trunc(unit, F.col(f"`{column}`")).cast("timestamp_ntz").alias("__bucket")

    keyed = [F.col(f"`{c}`") for c in by]
    group = [*by, "__bucket"]
    change = F.struct(*(F.col(f"`{c}`") for c in values)).alias("__value")
    points = dedup_latest(changes.where(_present([since, *by])), [*by, since])
    points = points.select(*keyed, bucket(since), F.col(f"`{since}`").cast("timestamp_ntz").alias("__at"), change)
    findable = _present([at, *by])
    timed = rows.where(findable).select(
        *keyed, bucket(at), F.col(f"`{at}`").cast("timestamp_ntz").alias("__at"), F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("__row")
    )
    sizes = timed.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    # Fewer than HOT_GROUPS groups can hold so many rows each: they may be broadcast.
    most = max(rows_a_task, (timed.count()) // HOT_GROUPS)
    hot = sizes.where(F.col("__n") > most).select(*group, F.ceil(F.col("__n") / most).cast("int").alias("__salts"))
    hot = F.broadcast(hot)
    ends = points.groupBy(*group).agg(F.max_by("__value", "__at").alias("__end"))
    earlier = Window.partitionBy(*(by or [F.lit(1)])).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.join(ends, group, "full_outer").withColumn("__value", F.last("__end", ignorenulls=True).over(earlier))
    carried = carried.where("__n IS NOT NULL AND __value IS NOT NULL")

    def salted(df: DataFrame, every: bool) -> DataFrame:
        df = df.withColumn("__part", F.spark_partition_id()).join(hot, group, "left").withColumn("__salts", F.coalesce("__salts", F.lit(1)))
        salt = F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)) if every else F.pmod("__part", "__salts")
        return df.withColumn("__salt", salt).drop("__part", "__salts")

    start = F.lit(None).cast("timestamp_ntz").alias("__at")  # before everything in its bucket
    known = points.select(*group, "__at", "__value").unionByName(carried.select(*group, start, "__value"))
    axis = salted(timed, False).unionByName(salted(known, True), allowMissingColumns=True)
    so_far = Window.partitionBy(*group, "__salt").orderBy(F.col("__at").asc_nulls_first(), F.col("__row").isNotNull())
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = axis.withColumn("__value", F.last("__value", ignorenulls=True).over(so_far)).where(F.col("__row").isNotNull())
    out = filled.select("__row.*", *(F.col("__value").getField(c).alias(c) for c in values))
    nothing = [F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in values]
    return out.unionByName(rows.where(~F.coalesce(findable, F.lit(False))).select("*", *nothing))


def densify_carry(
    measured: DataFrame, slots: DataFrame, members: list[tuple], names: list[str], at: str, unit: str = "day"
) -> DataFrame:
    """Every slot for every member, with the last measures known by then and the slot they were taken in (``measured_<at>``).

    ``slots`` has one column, ``at``; ``measured`` one row per member and slot with measures, a sparse subset.  NULL before a
    member's first measure.
    """
    since = f"measured_{at}"
    return asof_join(grid(slots.select(at), members, names), measured.withColumnRenamed(at, since), at, since, names, unit)
