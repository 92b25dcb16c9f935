"""Keyed merges as DataFrame algebra.

Contract: keys compare with plain equality, so a NULL key part never matches; the source holds one row per key, or is
reduced to one deterministically here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.scalars import literal_of
from meterlake.operators.dedup import dedup_latest
from meterlake.operators.lookups import lookup_join


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])


def one_per_key(source: DataFrame, keys: list[str], order_by: list[Column] | None, unique: bool) -> DataFrame:
    return source if unique else dedup_latest(source, keys, order_by)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order_by: list[Column] | None = None,
    unique: bool = False,
    evolve: bool = False,
) -> DataFrame:
    """Source rows replace target rows of the same key or are added; other target rows stay.

    ``unique`` promises that the source already has one row per key.  ``evolve`` adds columns only one side has.
    Target rows with a NULL key part cannot match: they bypass the join and its shuffle.
    """
    source = one_per_key(source, keys, order_by, unique)
    keyless = _any_null(keys)
    kept = target.filter(~keyless).join(source.select(*keys).filter(~keyless), keys, "left_anti")
    kept = kept.select(*target.columns)
    merged = kept.unionByName(target.filter(keyless))
    return merged.unionByName(source, allowMissingColumns=evolve)


def insert_missing(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order_by: list[Column] | None = None,
    unique: bool = False,
    prune_by: str | None = None,
) -> DataFrame:
    """The source rows an insert-only merge adds: those whose key the target does not hold.

    ``prune_by`` names a key column, usually a time: target rows outside the source's range of it cannot match, and the
    literal bounds let the scan skip their row groups.
    """
    source = one_per_key(source, keys, order_by, unique)
    if prune_by:
        low, high = source.agg(F.min(prune_by), F.max(prune_by)).first()
        kind = target.schema[prune_by].dataType
        target = target.filter(F.col(prune_by).between(literal_of(low, kind), literal_of(high, kind)))
    # Reduce the big side first: only target keys that occur in the source take part in the anti join.
    held = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    return source.join(held, keys, "left_anti").select(*source.columns)


def merge_insert_only(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order_by: list[Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Target rows untouched, plus the source rows with unheld keys."""
    return target.unionByName(insert_missing(target, source, keys, order_by, unique))


def fill_from(target: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """Backfill: where ``column`` is NULL take it from ``lookup``; filled values are never overwritten."""
    found = lookup.select(key, F.col(column).alias("__fill"))
    filled = lookup_join(target, found, key)
    return filled.withColumn(column, F.coalesce(column, "__fill")).select(*target.columns)


def needs_fill(df: DataFrame, column: str) -> bool:
    """Gate of a backfill: whether any NULL is left.  Stops at the first one found."""
    return not df.filter(F.col(column).isNull()).select(F.lit(1)).isEmpty()
