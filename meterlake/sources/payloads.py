"""Landed JSON payloads to rows, entirely inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_records(df: DataFrame, json_col: str, record_schema: str, path: str = "response.data") -> DataFrame:
    """One row per element of the record list found at ``path``; field names, hyphens included, become columns."""
    payload = f"array<struct<{record_schema}>>"
    for step in reversed(path.split(".")):
        payload = f"struct<{step}:{payload}>"
    records = F.from_json(F.col(json_col), payload).getField(path.split(".")[0])
    for step in path.split(".")[1:]:
        records = records.getField(step)
    return df.select(F.explode(records).alias("_record")).select("_record.*")


def zip_arrays(df: DataFrame, json_col: str, root: str, arrays: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per position of the parallel arrays below ``root``.

    ``arrays`` maps output column -> (array name in the payload, element type).
    """
    fields = ",".join(f"`{name}`:array<{kind}>" for name, kind in arrays.values())
    body = F.from_json(F.col(json_col), f"struct<`{root}`:struct<{fields}>>").getField(root)
    zipped = F.arrays_zip(*[body.getField(name).alias(out) for out, (name, _) in arrays.items()])
    return df.select(F.explode(zipped).alias("_row")).select(
        *[F.col("_row").getField(out).alias(out) for out in arrays]
    )


def record_payload(*records: Column) -> Column:
    """The inverse of `explode_records` for the default path, for landing and tests."""
    return F.to_json(F.struct(F.struct(F.array(*records).alias("data")).alias("response")))


def landed_text(df: DataFrame, path: str, json_col: str) -> DataFrame:
    """Land payloads as text, one document per line, and read them back as raw text."""
    df.select(F.col(json_col).alias("value")).write.text(path)
    return df.sparkSession.read.schema(T.StructType([T.StructField("value", T.StringType())])).text(path)
