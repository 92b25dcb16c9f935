"""Schema drift, schema alignment and schema contracts.  Only metadata is compared; data is never read for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.sources.readers import type_map


# The texts of the two kinds of drift.
DRIFT_TEXTS = {"new": "{name} (new column)", "retyped": "{name} (type changed: {want} -> {have})"}


def column_status(actual: dict[str, str], expected: dict[str, str], words: tuple[str, str, str, str]) -> list[tuple]:
    """(column, expected type, actual type, status) of each column of either side, the actual side's first.

    words: the status of a column only in actual, only in expected, of another type, and equal.
    """
    surplus, lacking, differs, equal = words
    both = dict.fromkeys([*actual, *expected])
    types = [(name, expected.get(name), actual.get(name)) for name in both]
    return [
        (name, want, have, surplus if want is None else lacking if have is None else equal if want == have else differs)
        for name, want, have in types
    ]


def drifted_columns(source: DataFrame, target: DataFrame | None) -> list[str]:
    """Texts for new and retyped source columns in source order; a missing target or a removed column is no drift."""
    if target is None or not target.columns:
        return []
    rows = column_status(type_map(source), type_map(target), ("new", "removed", "retyped", "same"))
    return [DRIFT_TEXTS[status].format(name=n, want=w, have=h) for n, w, h, status in rows if status in DRIFT_TEXTS]


def annotate_drift(source: DataFrame, target: DataFrame | None) -> DataFrame:
    """Add ``schema_drift_detected`` and ``schema_drift_columns``."""
    found = drifted_columns(source, target)
    return source.withColumns(
        {"schema_drift_detected": F.lit(bool(found)), "schema_drift_columns": F.lit(", ".join(found))}
    )


def drift_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per column of either side with its status: same, new, retyped or removed."""
    return compare_schemas(type_map(source), type_map(target), source.sparkSession, "new", "removed", "retyped", "same")


def check_contract(df: DataFrame, contract: T.StructType | str) -> DataFrame:
    """One row per column of the frame or its declared contract: ok, wrong type, missing or extra."""
    declared = T.StructType.fromDDL(contract) if isinstance(contract, str) else contract
    expected = {f.name: f.dataType.simpleString() for f in declared.fields}
    return compare_schemas(type_map(df), expected, df.sparkSession, "extra", "missing", "wrong type", "ok")


def compare_schemas(actual, expected, spark, only_actual, only_expected, differs, equal) -> DataFrame:
    rows = column_status(actual, expected, (only_actual, only_expected, differs, equal))
    return spark.createDataFrame(rows, "column_name string, expected string, actual string, status string")


def null_violations(df: DataFrame, contract: T.StructType | str) -> DataFrame:
    """Per NOT NULL column of the contract, how many rows break it: one aggregation over exactly those columns."""
    declared = T.StructType.fromDDL(contract) if isinstance(contract, str) else contract
    required = [f.name for f in declared.fields if not f.nullable and f.name in df.columns]
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in required])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_rows")) for c in required]
    return counted.select(F.inline(F.array(*rows)))


def empty_from_contract(spark: SparkSession, contract: T.StructType | str) -> DataFrame:
    """An empty frame with the declared columns, for create-if-absent."""
    return spark.createDataFrame([], contract)


def conform_types(source: DataFrame, target: DataFrame) -> DataFrame:
    """Cast source columns to the types the target holds; raises if a value would change or be lost.

    The check is one aggregation over the retyped columns only, made before anything is written.
    """
    held = {f.name: f.dataType for f in target.schema.fields}
    retyped = [f for f in source.schema.fields if f.name in held and held[f.name] != f.dataType]
    if not retyped:
        return source
    cast = {f.name: F.col(f"`{f.name}`").try_cast(held[f.name]) for f in retyped}

    def kept(f: T.StructField) -> Column:
        return F.col(f"`{f.name}`").isNull() | F.coalesce(cast[f.name].try_cast(f.dataType) == F.col(f"`{f.name}`"), F.lit(False))

    lost = source.agg(*(F.count_if(~kept(f)).alias(f.name) for f in retyped)).first().asDict()
    if any(lost.values()):
        raise TypeError("values do not fit the types of the table: " + ", ".join(f"{c} ({n} rows)" for c, n in lost.items() if n))
    return source.withColumns(cast)


def align_schemas(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give both sides all columns: each side's missing ones become typed NULLs."""

    def widened(df: DataFrame, other: DataFrame) -> DataFrame:
        missing = {f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns}
        return df.withColumns(missing) if missing else df

    return widened(source, target), widened(target, source)
