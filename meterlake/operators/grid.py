"""Densify: every time slot for every member of a fixed list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The feeders every slot is expanded to.
FEEDERS = [
    ("FDR_LDN_NORTH_01", "SUB_NORTH_HIGHBURY"),
    ("FDR_LDN_SOUTH_01", "SUB_SOUTH_BRIXTON"),
    ("FDR_LDN_EAST_01", "SUB_EAST_STRATFORD"),
    ("FDR_LDN_WEST_01", "SUB_WEST_ACTON"),
]


def distinct_slots(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-NULL values of a time column."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def grid(
    slots: DataFrame,
    members: list[tuple],
    names: list[str],
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Each slot once per member, with measure expressions over slot and member columns.

    The member list is a literal in the plan, so the expansion is a narrow explode inside the slot's own task.
    Measures are added in order, later ones may use earlier ones.
    """
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, m)]) for m in members])
    expanded = slots.select("*", F.inline(listed))
    for name, value in (measures or {}).items():
        expanded = expanded.withColumn(name, value)
    return expanded


def multiply_rows(df: DataFrame, times: int, column: str = "copy_no") -> DataFrame:
    """Each row ``times`` times, numbered from 1."""
    return df.select("*", F.explode(F.array(*[F.lit(i) for i in range(1, times + 1)])).alias(column))
