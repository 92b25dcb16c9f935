"""Dense numbering and stable surrogate keys without a single-task global window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.sources.staging import stage

_PLACE = "__place"
# monotonically_increasing_id: partition number in the upper bits, position in the partition in the lower 33.
_POSITION_BITS = 33


def dense_number(df: DataFrame, order_by: list[str], column: str, start: int = 0) -> DataFrame:
    """Number rows start+1, start+2, ... in the order of ``order_by``, which must identify a row.

    Range-partition, sort inside partitions, stage the placement, then add each partition's offset.  Only one counter
    per partition reaches the driver, never a row.
    """
    spark = df.sparkSession
    placed = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(_PLACE, F.monotonically_increasing_id()),
        "numbering",
    )
    part = F.shiftright(F.col(_PLACE), _POSITION_BITS).cast("int")
    sizes = dict(placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    bases, base = [], start
    for number in range(max(sizes, default=0) + 1):
        bases.append(base)
        base += sizes.get(number, 0)
    # One literal per partition, bounded by the partition number.
    offset = F.element_at(F.lit(bases).cast("array<bigint>"), part + 1)
    position = F.col(_PLACE).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.withColumn(column, offset + position + 1).drop(_PLACE)


def max_key(df: DataFrame, key_col: str) -> DataFrame:
    """One row with the highest key, 0 for an empty dimension."""
    return df.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("bigint").alias("max_key"))


def new_members(members: DataFrame, existing: DataFrame, natural_key: str) -> DataFrame:
    """Members the dimension does not hold yet."""
    return members.join(existing.select(natural_key), natural_key, "left_anti")


def assign_keys(members: DataFrame, existing: DataFrame | None, natural_key: str, key_col: str) -> DataFrame:
    """Surrogate keys that never change: known members keep theirs, new ones continue after the highest.

    ``members`` holds one row per non-NULL natural key.
    """
    if existing is None:
        return dense_number(members, [natural_key], key_col)
    stored = existing.select(natural_key, F.col(key_col).cast("bigint").alias(key_col))
    top = max_key(stored, key_col).first()[0]
    fresh = dense_number(new_members(members, stored, natural_key), [natural_key], key_col, start=top)
    return members.join(stored, natural_key, "inner").unionByName(fresh)


def paged(df: DataFrame, order_by: list[str], page_rows: int, column: str = "page_no") -> DataFrame:
    """Give every row the number (from 0) of its ``page_rows``-long page in ``order_by`` order; no row is left out."""
    numbered = dense_number(df, order_by, "__n")
    return numbered.withColumn(column, F.floor((F.col("__n") - 1) / page_rows).cast("bigint")).drop("__n")
