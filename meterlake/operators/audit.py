"""Run lineage and incremental watermarks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.scalars import literal_of

WATERMARK_COLUMNS = ("pipeline_start_ts", "run_ts")
LAYERS = ("bronze", "silver", "gold", "audit")


def lineage_snapshot(
    spark: SparkSession,
    schemas: tuple[str, ...],
    run_id: str,
    pipeline_start_ts: datetime,
    audit_start_ts: datetime | None = None,
) -> DataFrame:
    """One row per catalog table of ``schemas``, stamped with the run.  Reads the catalog, not the tables."""
    found = []
    for schema in schemas:
        if spark.catalog.databaseExists(schema):
            for table in spark.catalog.listTables(schema):
                if not table.isTemporary:
                    found.append((table.catalog, schema, table.name, table.tableType))
    tables = spark.createDataFrame(
        found, "table_catalog string, table_schema string, table_name string, table_type string"
    )
    started = F.lit(pipeline_start_ts).cast("timestamp")
    return tables.select(
        F.lit(run_id).alias("run_id"),
        started.alias("run_ts"),
        started.alias("pipeline_start_ts"),
        F.current_timestamp().alias("pipeline_end_ts"),
        F.lit(audit_start_ts or pipeline_start_ts).cast("timestamp").alias("audit_task_start_ts"),
        F.current_timestamp().alias("audit_ts"),
        "table_catalog",
        "table_schema",
        "table_name",
        "table_type",
    )


def lineage_report(snapshots: DataFrame) -> DataFrame:
    """Snapshots newest run first, then by schema and table."""
    return snapshots.orderBy(F.col("pipeline_start_ts").desc(), F.col("table_schema").asc(), F.col("table_name").asc())


def watermark(snapshots: DataFrame, columns: tuple[str, ...] = WATERMARK_COLUMNS) -> DataFrame | None:
    """One row with the highest start of any earlier run; the first of ``columns`` that exists is read."""
    for column in columns:
        if column in snapshots.columns:
            return snapshots.agg(F.max(column).alias("watermark"))
    return None


def since(df: DataFrame, ts_col: str, high_water: datetime | None, unit: str = "hour") -> DataFrame:
    """Rows from the watermark's hour or day on; everything on the first run.

    The bound is a literal, so it reaches the file scan as a pushed filter.
    """
    if high_water is None:
        return df
    floor = {"hour": dict(minute=0, second=0, microsecond=0), "day": dict(hour=0, minute=0, second=0, microsecond=0)}
    bound = high_water.replace(**floor[unit])
    return df.filter(F.col(ts_col) >= literal_of(bound, df.schema[ts_col].dataType))
