"""File and table scans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.sources.staging import side_by_side, stage

PROVENANCE = ("source_file", "source_file_name", "source_file_size", "source_file_modification_time")
HEADERS_AT_ONCE = 8
_LINE, _REASON, _LEFT_OVER = "__line", "__reason", "__left_over"


@dataclass(frozen=True)
class CheckedScan:
    """What a CSV scan found: rows that fit, and the lines that do not (source_file, line, reason)."""

    rows: DataFrame
    quarantine: DataFrame


def _as_schema(columns: list[str] | T.StructType) -> T.StructType:
    if isinstance(columns, T.StructType):
        return columns
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_layouts(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that have it.  Lists the files, without their content, and reads one line of each."""
    files = [row.path for row in spark.read.format("binaryFile").load(paths).select("path", "length").where("length > 0").collect()]
    headers = side_by_side([lambda f=f: spark.read.option("header", True).csv(f).columns for f in files], HEADERS_AT_ONCE)
    found: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        found.setdefault(tuple(header), []).append(file)
    return found


def _by_layout(spark: SparkSession, paths: str | list[str], wanted: T.StructType | None, line: str | None) -> list[DataFrame]:
    """One frame for each header among the files: the wanted columns by name, provenance, and the text of bad lines."""
    frames = []
    for header, files in csv_layouts(spark, paths).items():
        given = wanted or _as_schema(list(header))
        if lacking := [f.name for f in given.fields if f.name not in header]:
            raise ValueError(f"{files[0]}: the header has no column {', '.join(lacking)}; it has {', '.join(header)}")
        kinds = {f.name: f.dataType for f in given.fields}
        fields = [T.StructField(c, kinds.get(c, T.StringType())) for c in header]
        reader = spark.read.option("header", True)
        if line:
            fields.append(T.StructField(line, T.StringType()))
            # Fields are only counted where none is skipped.
            reader = reader.option("columnNameOfCorruptRecord", line).option("columnPruning", False)
        frame = with_provenance(reader.schema(T.StructType(fields)).csv(files))
        if line:
            frame = frame.withColumn(_REASON, _reason(header, kinds, line))
        frames.append(frame.select(*(f"`{c}`" for c in kinds), *PROVENANCE, *([line, _REASON] if line else [])))
    if not frames:
        given = wanted or T.StructType()
        meta = "source_file string, source_file_name string, source_file_size bigint, source_file_modification_time timestamp"
        extra = f", {line} string, {_REASON} string" if line else ""
        frames = [spark.createDataFrame([], T.StructType([*given.fields, *T.StructType.fromDDL(meta + extra).fields]))]
    return frames


def _reason(header: tuple[str, ...], kinds: dict[str, T.DataType], line: str) -> Column:
    """Why a line does not fit: its number of fields, or the columns whose text is no value of their type."""
    texts = ", ".join(f"`{c}` STRING" for c in (*header, _LEFT_OVER))
    parsed = F.from_csv(F.col(line), texts, {"columnNameOfCorruptRecord": _LEFT_OVER})
    bad = [
        F.when(parsed[c].isNotNull() & F.col(f"`{c}`").isNull(), F.lit(f"{c} is no {kinds[c].simpleString()}")) for c in header if c in kinds
    ]
    miscounted = parsed[_LEFT_OVER].isNotNull()
    return F.when(F.col(line).isNotNull(), F.when(miscounted, "wrong number of fields").otherwise(F.concat_ws("; ", *bad)))


def scan_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | T.StructType | None = None,
    renames: dict[str, str] | None = None,
    provenance: bool = False,
) -> DataFrame:
    """CSV files with a header row each, columns taken by name whatever their order; other columns are left out.

    Every value stays text unless a schema is given.  A file whose header lacks a wanted column raises.  Without ``columns``
    all columns of all files are read, absent ones as NULL.
    """
    wanted = None if columns is None else _as_schema(columns)
    frames = _by_layout(spark, paths, wanted, None)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=wanted is None), frames)
    if not provenance:
        df = df.drop(*PROVENANCE)
    return df.withColumnsRenamed(renames) if renames else df


def scan_csv_checked(
    spark: SparkSession, paths: str | list[str], columns: list[str] | T.StructType, renames: dict[str, str] | None = None
) -> CheckedScan:
    """Like ``scan_csv`` with provenance, but lines with too few or too many fields, or with text that is no value of its
    column's type, are set apart with their text instead of coming in as NULLs.  The files are parsed once."""
    frames = _by_layout(spark, paths, _as_schema(columns), _LINE)
    parsed = stage(reduce(DataFrame.unionByName, frames), "csv")
    rows = parsed.where(F.col(_LINE).isNull()).drop(_LINE, _REASON)
    bad = parsed.where(F.col(_LINE).isNotNull()).select("source_file", F.col(_LINE).alias("line"), F.col(_REASON).alias("reason"))
    return CheckedScan(rows.withColumnsRenamed(renames) if renames else rows, bad)


def scan_parquet(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    glob: str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Parquet files below ``path``; ``merge_schema`` unions the file schemas, absent columns read as NULL."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.parquet(path)


def with_provenance(df: DataFrame) -> DataFrame:
    """Path, name, size and modification time of the file each row came from (must sit directly on a file scan)."""
    return df.withColumns(
        {
            "source_file": F.col("_metadata.file_path"),
            "source_file_name": F.col("_metadata.file_name"),
            "source_file_size": F.col("_metadata.file_size"),
            "source_file_modification_time": F.col("_metadata.file_modification_time"),
        }
    )


def scan_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None when it does not exist yet (first run)."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def type_map(df: DataFrame) -> dict[str, str]:
    """Column name to type string, in column order."""
    return {field.name: field.dataType.simpleString() for field in df.schema.fields}
