"""Catalog tables on plain Parquet that can be created, appended to, merged into and evolved.

Unpartitioned tables are rewritten into a new version folder and the catalog entry is pointed at it, so a failed job
leaves the old version in place.  Partitioned tables are merged by rewriting only the partitions the source touches.
"""

from __future__ import annotations

import json
import operator
import threading
import uuid
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators import merge
from meterlake.operators.drift import align_schemas, conform_types, empty_from_contract
from meterlake.sources.staging import stage

SCHEMAS = ("bronze", "silver", "gold", "audit")
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
PLACE = "table string, at string, path string, columns string, partitions array<string>"


class _DynamicOverwrite:
    """The session's overwrite mode is dynamic while any write needs it, and as it was before when the last one is done."""

    _lock, _writes, _before = threading.Lock(), 0, "static"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        shared = type(self)
        with shared._lock:
            if not shared._writes:
                shared._before = self.spark.conf.get(_OVERWRITE_MODE)
                self.spark.conf.set(_OVERWRITE_MODE, "dynamic")
            shared._writes += 1

    def __exit__(self, *_: object) -> None:
        shared = type(self)
        with shared._lock:
            shared._writes -= 1
            if not shared._writes:
                self.spark.conf.set(_OVERWRITE_MODE, shared._before)


class Lake:
    """Named tables ``<schema>.<table>`` below one root folder on shared storage.

    Where each table stands is written below the root too, so that a session with an empty catalog opens the lake as it was
    left.  Of unpartitioned tables the newest ``keep_versions`` versions stay on disk.
    """

    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 5, prefix: str = ""):
        """``prefix`` goes before the catalog names of the schemas, so that lakes can stand side by side in one catalog."""
        self.spark, self.root, self.keep_versions, self.prefix = spark, root.rstrip("/"), max(1, keep_versions), prefix
        self._appending = threading.Lock()
        # Dropping a schema deletes its location in some catalogs, so the tables do not lie there.
        for schema in SCHEMAS:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{schema} LOCATION '{self.root}/catalog/{prefix}{schema}'")
        self._reopen()

    @property
    def schemas(self) -> tuple[str, ...]:
        """The catalog names of the lake's schemas."""
        return tuple(f"{self.prefix}{schema}" for schema in SCHEMAS)

    def name(self, table: str) -> str:
        """The catalog name of a table ``<schema>.<table>`` of this lake."""
        return f"{self.prefix}{table}"

    def forget(self) -> None:
        """Take the lake's schemas out of the catalog; the files stay, so it can be opened again."""
        for schema in self.schemas:
            self.spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")

    def _reopen(self) -> None:
        """Enter the tables found below the root that the catalog does not know."""
        try:
            places = self.spark.read.schema(PLACE).parquet(f"{self.root}/places/*/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        newest = places.groupBy("table").agg(F.max_by(F.struct("path", "columns", "partitions"), "at").alias("place"))
        for table, place in newest.collect():  # one row per table
            if self.exists(table):
                continue
            fields = T.StructType.fromJson(json.loads(place.columns)).fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in place.partitions)})" if place.partitions else ""
            self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {by} LOCATION '{place.path}'")
            if place.partitions:
                self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")

    def _note(self, table: str, path: str, partitions: list[str]) -> None:
        """Write down where a table stands now; each note is a folder of its own, so that writers do not meet."""
        at = f"{datetime.now():%Y%m%d%H%M%S%f}"
        note = self.spark.createDataFrame([(table, at, path, self.read(table).schema.json(), partitions)], PLACE)
        note.coalesce(1).write.parquet(f"{self.root}/places/{table}/{at}-{uuid.uuid4().hex[:8]}")

    def _location(self, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").filter("col_name = 'Location'")
        return described.first()["data_type"]

    def _drop_old_versions(self, table: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(table))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        versions = sorted((s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("v=")), key=str)
        for old in versions[: -self.keep_versions]:
            files.delete(old, True)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _new_version(self, table: str) -> str:
        return f"{self._folder(table)}/v={datetime.now():%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def _partition_columns(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def create(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """First write of a table."""
        if partition_by:
            # Rebalance: one partition's rows meet in few files, while AQE splits a hot partition over several writers.
            path = self._folder(table)
            writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
        else:
            path = self._new_version(table)
            writer = df.write
        writer.option("path", path).format("parquet").saveAsTable(self.name(table))
        self._note(table, path, partition_by or [])

    def create_from_contract(self, table: str, contract: str, partition_by: list[str] | None = None) -> None:
        """Create an empty table with declared columns unless it exists."""
        if not self.exists(table):
            self.create(table, empty_from_contract(self.spark, contract), partition_by)

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows; creates the table on first use.  One append at a time: they share the table's commit folder."""
        with self._appending:
            if not self.exists(table):
                self.create(table, df)
                return
            self.add_missing_columns(table, df)
            columns = self.read(table).columns
            df = conform_types(df, self.read(table))
            align_schemas(df, self.read(table))[0].select(*columns).write.insertInto(self.name(table))

    def add_missing_columns(self, table: str, df: DataFrame) -> None:
        """Widen the table by the frame's new columns; existing files read them as NULL."""
        held = self.read(table).columns
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in held]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({', '.join(new)})")
            self._note(table, self._location(table), self._partition_columns(table))

    def replace(self, table: str, df: DataFrame) -> None:
        """Write a new version of an unpartitioned table, then switch the catalog entry to it."""
        path = self._new_version(table)
        df.select(*self.read(table).columns).write.parquet(path)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.name(table))
        self._note(table, path, [])
        self._drop_old_versions(table)

    def upsert(
        self,
        table: str,
        source: DataFrame,
        keys: list[str],
        partition_by: list[str] | None = None,
        order_by: list[Column] | None = None,
        unique: bool = False,
        staged: bool = False,
    ) -> None:
        """Create the table or merge ``source`` into it; new source columns widen the table.

        ``staged`` promises that ``source`` is read from a written copy: if it has one row per key, it is not written again.

        The table's types stay: values that fit are cast, others raise before anything is written.
        In a partitioned table the partition follows from the key, so only the partitions the source has rows in can
        change; the others are neither read nor written.
        """
        if not self.exists(table):
            # As in a merge, the first load holds one row per key.
            self.create(table, merge.one_per_key(source, keys, order_by, unique), partition_by)
            return
        source = conform_types(source, self.read(table))
        self.add_missing_columns(table, source)
        target = self.read(table)
        source, _ = align_schemas(source, target)
        source = merge.one_per_key(source, keys, order_by, unique)
        partitions = self._partition_columns(table)
        if not partitions:
            self.replace(table, merge.upsert(target, source, keys, unique=True))
            return
        source = source if staged and unique else stage(source, "merge_source")
        affected = target.filter(self._touched(source, partitions))
        self._overwrite_partitions(table, merge.upsert(affected, source, keys, unique=True), partitions)

    def _touched(self, df: DataFrame, partitions: list[str]) -> Column:
        """Literal predicate for the partitions ``df`` has rows in, so the scan prunes statically.

        Only partition values reach the driver; their number is bounded by the partitions of the batch.
        """
        present = df.select(*partitions).distinct().collect()
        if len(partitions) == 1:
            column, values = F.col(partitions[0]), [row[0] for row in present]
            listed = column.isin(*[v for v in values if v is not None])
            return listed | column.isNull() if None in values else listed
        tuples = [[F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partitions, row)] for row in present]
        return reduce(operator.or_, [reduce(operator.and_, parts) for parts in tuples], F.lit(False))

    def _overwrite_partitions(self, table: str, df: DataFrame, partitions: list[str]) -> None:
        columns = self.read(table).columns
        spread = df.select(*columns).hint("rebalance", *partitions)
        # Replaces the partitions that are written and no others; inserts take this from the session only.
        with _DynamicOverwrite(self.spark):
            spread.write.insertInto(self.name(table), overwrite=True)

    def insert_missing(self, table: str, source: DataFrame, keys: list[str], **options) -> None:
        """Insert-only merge (options of `merge.insert_missing`): existing files stay, only new rows are appended."""
        if not self.exists(table):
            self.create(table, merge.one_per_key(source, keys, options.get("order_by"), options.get("unique", False)))
        else:
            source = conform_types(source, self.read(table))
            self.append(table, stage(merge.insert_missing(self.read(table), source, keys, **options), "inserts"))

    def backfill(self, table: str, lookup: DataFrame, key: str, column: str) -> bool:
        """Fill NULLs of ``column`` from ``lookup``; does nothing, cheaply, when there are none."""
        if column not in self.read(table).columns:
            self.add_missing_columns(table, lookup.select(column))
        target = self.read(table)
        if not merge.needs_fill(target, column):
            return False
        partitions = self._partition_columns(table)
        if partitions:
            affected = target.filter(self._touched(target.filter(F.col(column).isNull()), partitions))
            self._overwrite_partitions(table, merge.fill_from(affected, lookup, key, column), partitions)
        else:
            self.replace(table, merge.fill_from(target, lookup, key, column))
        return True
