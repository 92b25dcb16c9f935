"""Duplicate removal and duplicate counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.scalars import portable_hash

_RANK = "__rank"


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct key tuples; NULLs count as equal.  Map-side partial aggregation absorbs hot keys."""
    return df.select(*keys).distinct()


def dedup_latest(df: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """One row per key: the first under ``order_by``, ties broken by the remaining columns, so the survivor is fixed.

    The ``= 1`` filter lets the planner cut each key to one row before the shuffle (WindowGroupLimit, partial), so a
    key holding a third of the input costs one row per map task.
    """
    rest = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]
    order = [*(order_by or []), *rest] or [F.col(f"`{k}`") for k in keys]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def surplus_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows repeat an earlier key (rows minus distinct keys, NULLs equal)."""
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus"))


def hash_sample(df: DataFrame, keys: list[str], keep: int, out_of: int) -> DataFrame:
    """Deterministic sample: the rows whose key hash falls into ``keep`` of ``out_of`` slots."""
    return df.filter(F.pmod(portable_hash(*keys), F.lit(out_of)) < keep)
