"""Raw landing: append-only Parquet stamped with the load that brought it."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.sources.readers import with_provenance

_PLAIN = " -_.~!$&()+,;@"  # what a folder name keeps as it is


def new_load_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S")


def land_raw(df: DataFrame, root: str, source: str, load_id: str) -> str:
    """Append ``df`` below ``root`` with load metadata; the load id is a partition folder, so loads prune."""
    (
        df.withColumns(
            {
                "_source_system": F.lit(source),
                "_ingestion_ts": F.current_timestamp(),
                "_load_id": F.lit(load_id),
            }
        )
        .write.mode("append")
        .partitionBy("_load_id")
        .parquet(root)
    )
    return root


def read_landed(spark: SparkSession, root: str, provenance: bool = False, loads: list[str] | None = None) -> DataFrame:
    """Every load below ``root``, or the named ones, schemas merged; optionally with the file each row came from."""
    reader = spark.read.option("mergeSchema", True).option("basePath", root)
    df = reader.parquet(*(f"{root.rstrip('/')}/_load_id={quote(i, safe=_PLAIN)}" for i in loads)) if loads else reader.parquet(root)
    df = with_provenance(df) if provenance else df
    return df.withColumn("_load_id", F.col("_load_id").cast("string"))


def load_ids(spark: SparkSession, root: str) -> list[str]:
    """Ids of the loads below ``root``, from the names of its folders: no file is opened, and no load is listed inside."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    return sorted(unquote(name.removeprefix("_load_id=")) for name in names if name.startswith("_load_id="))


def new_loads(spark: SparkSession, root: str, recorded: DataFrame | None, provenance: bool = False) -> tuple[DataFrame, list[str]]:
    """Loads below ``root`` that no earlier run recorded (root, _load_id), whatever their time and order; and their ids.

    Only their folders are read.  Without new loads the frame is empty, with the columns of the newest load.
    """
    ids = load_ids(spark, root)
    if not ids:
        raise FileNotFoundError(f"{root}: no load has been landed")
    done = set()
    if recorded is not None:  # one id a load
        done = {row[0] for row in recorded.where(F.col("root") == root).select("_load_id").distinct().collect()}
    fresh = [i for i in ids if i not in done]
    df = read_landed(spark, root, provenance, fresh or ids[-1:])
    return (df if fresh else df.limit(0)), fresh
