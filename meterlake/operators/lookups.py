"""Lookups of a large fact side in keyed sides, safe against hot keys.

A keyed side is broadcast only after its rows were counted and their bytes, by the width of its columns, found few.  Beyond that
bound both sides are shuffled on the key plus a salt: the fact side takes its salt from the partition a row sits in, which stays the same when a task is
retried and spreads even exact copies of one row; the keyed side is repeated once per salt.  That join is asked to merge: Spark
takes the size of the stored files for that of the repeated side, and would send it to the driver for a broadcast of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
ROW_BYTES = 32  # what a hashed row takes besides its columns
SALTS = 16
_SALT = "__salt"
# Bytes of a value; texts, arrays and whatever else is not listed are taken to be long.
_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
_LONG_VALUE = 64


def row_bytes(df: DataFrame) -> int:
    """Bytes of one row of ``df`` in a hash table, about."""
    return ROW_BYTES + sum(_WIDTHS.get(f.dataType.simpleString(), _LONG_VALUE) for f in df.schema.fields)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows.  A plain count: on stored Parquet it only reads footers."""
    return df.select(F.lit(1)).count() <= rows


def lookup_join(
    facts: DataFrame,
    keyed: DataFrame | list[DataFrame],
    on: str | list[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    probe: bool = True,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Equi-join ``facts`` with one or more sides that each hold one row per key.  NULL keys do not match.

    Several sides on the same key share one salted shuffle of the facts.  ``probe=False`` skips the count, for keyed
    sides that are themselves costly to evaluate.  ``sized_by`` names a frame with at least as many rows as any keyed
    side that is cheaper to count.
    """
    keys = [on] if isinstance(on, str) else list(on)
    sides = keyed if isinstance(keyed, list) else [keyed]
    small = [probe and at_most(side if sized_by is None else sized_by, broadcast_bytes // row_bytes(side)) for side in sides]
    for side, is_small in zip(sides, small):
        if is_small:
            facts = facts.join(F.broadcast(side), keys, how)
    if all(small):
        return facts
    facts = facts.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(salts)))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    for side, is_small in zip(sides, small):
        if not is_small:
            facts = facts.join(side.withColumn(_SALT, every_salt).hint("merge"), [*keys, _SALT], how)
    return facts.drop(_SALT)
