"""Layered tables: scans of one date, partition replacement, append, keyed versions.

Writes of plain file tables go beside the stored rows, into a fresh folder, and become visible by
pointing partitions at it. A failing or empty write therefore leaves everything as it was, running
reads keep their files, and no session setting is involved. Folders that no partition points at any
more are left to the storage's own expiry.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluice.model import BUSINESS_DATE

OUTSIDE = "rows outside the target partition"
# Names that a table has for the moment in which its schema changes.
FRESH, OLD = "__fresh", "__old"
# Columns of keyed tables, and the slices above which an upsert merges them.
VERSION, SLICE = "_version", "_slice"
VERSION_FIELDS = (StructField(VERSION, LongType()), StructField(SLICE, StringType()))
SLICES = 32


class EmptyPartition(RuntimeError):
    """A layer would be published without rows."""


class PartitionContract(RuntimeError):
    """A write would break the one-date-per-partition contract of a table."""


class Lake:
    """Name resolution and writes for ``<catalog>.<layer>.<table>``."""

    def __init__(
        self,
        spark: SparkSession,
        catalog: str | None = None,
        fmt: str = "parquet",
        root: str | None = None,
        prefix: str = "",
    ):
        """``root`` is the folder of new layers, else the warehouse; ``prefix`` starts their names."""
        self.spark = spark
        self.catalog = catalog
        self.fmt = fmt
        self.root = root
        self.prefix = prefix

    # -- names and reads ---------------------------------------------------

    def _layer(self, layer: str) -> str:
        own = f"{self.prefix}{layer}"
        return own if self.catalog is None else f"{self.catalog}.{own}"

    def name(self, layer: str, table: str) -> str:
        return f"{self._layer(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.table(self.name(layer, table))

    def partition(self, layer: str, table: str, odate: date) -> DataFrame:
        """The rows of one date; the filter on the partition column prunes files."""
        return self.read(layer, table).where(F.col(BUSINESS_DATE) == F.lit(odate))

    def ensure_layer(self, layer: str) -> None:
        place = "" if self.root is None else f" LOCATION '{self.root}/{layer}'"
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self._layer(layer)}{place}")

    # -- replace one date --------------------------------------------------

    def replace_partition(
        self,
        frame: DataFrame,
        layer: str,
        table: str,
        odate: date,
        cluster_by: Sequence[str] = (),
    ) -> int:
        """Replace exactly the ``odate`` partition; returns the rows written.

        The rows are computed once, into a folder of their own: a row of another
        date raises inside that job, and an empty result replaces nothing. Other
        dates are never touched. The schema may change while no other date is
        stored; the new table then takes the name of the old one when it is whole.
        """
        target = self.name(layer, table)
        self._finish_swap(layer, table)
        existed = self.exists(layer, table)
        recreate = False
        if existed:
            self._check_partitioning(target)
            recreate = not self._same_schema(target, frame)
            if recreate and not self._only_holds(target, odate):
                raise PartitionContract(
                    f"refusing to change the schema of {target}: other dates are present"
                )
        self.ensure_layer(layer)
        written = Observation()
        rows = _clustered(_only_date(frame, target, odate), cluster_by)
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        try:
            if self.fmt == "delta":
                self._replace_where(frame, rows, target, odate, existed, recreate)
            else:
                beside = self._write_one(rows, layer, table, {BUSINESS_DATE: odate})
        except PySparkException as error:
            if OUTSIDE in str(error):
                raise PartitionContract(f"refusing to write {target}: {OUTSIDE}") from error
            raise
        # Retried tasks may be counted twice, so this is only tested against zero.
        count = written.get["rows"]
        if count == 0:
            raise EmptyPartition(f"{target} has no rows for odate={odate.isoformat()}")
        if self.fmt != "delta":
            day = {BUSINESS_DATE: odate}
            if recreate:
                self._swap_table(frame.schema, layer, table, day, beside)
            else:
                if not existed:
                    self._create(frame.schema, target, [BUSINESS_DATE])
                self._point(target, day, beside)
        return count

    def _check_partitioning(self, target: str) -> None:
        found = [c.name for c in self.spark.catalog.listColumns(target) if c.isPartition]
        if found != [BUSINESS_DATE]:
            raise PartitionContract(
                f"{target} must be partitioned by {BUSINESS_DATE} only, found {found}"
            )

    def _same_schema(self, target: str, frame: DataFrame) -> bool:
        return _shape(self.spark.read.table(target).schema) == _shape(frame.schema)

    def _only_holds(self, target: str, odate: date) -> bool:
        stored = F.col(BUSINESS_DATE)
        others = self.spark.read.table(target).select(BUSINESS_DATE)
        return others.where(stored.isNull() | (stored != F.lit(odate))).isEmpty()

    def _replace_where(
        self,
        frame: DataFrame,
        rows: DataFrame,
        target: str,
        odate: date,
        existed: bool,
        recreate: bool,
    ) -> None:
        """The same with a format whose commits replace a part of a table."""
        if existed:
            # Committed as a whole, so the rows are known to be good beforehand.
            _check_first(frame, target, odate)
        writer = rows.write.format(self.fmt).mode("overwrite").partitionBy(BUSINESS_DATE)
        if existed and not recreate:
            only = f"{BUSINESS_DATE} = DATE '{odate.isoformat()}'"
            writer = writer.option("replaceWhere", only)
        else:
            writer = writer.option("overwriteSchema", "true")
        writer.saveAsTable(target)

    # -- folders beside, and the partitions that point at them -------------

    def _beside(self, layer: str, table: str) -> str:
        place = self.spark.catalog.getDatabase(self._layer(layer)).locationUri
        return f"{place.rstrip('/')}/_versions/{table}/{uuid.uuid4().hex}"

    def _write_beside(
        self, rows: DataFrame, layer: str, table: str, partition_by: Sequence[str]
    ) -> str:
        folder = self._beside(layer, table)
        rows.write.format(self.fmt).partitionBy(*partition_by).save(folder)
        return folder

    def _write_one(
        self,
        rows: DataFrame,
        layer: str,
        table: str,
        values: dict[str, object],
        rows_per_file: int = 0,
    ) -> str:
        """The same for rows of one partition.

        A partitioned write sorts its rows by the partition columns, here for nothing.
        """
        folder = self._beside(layer, table)
        writer = rows.drop(*values).write.format(self.fmt)
        writer.option("maxRecordsPerFile", rows_per_file).save(_part(folder, values))
        return folder

    def _create(self, schema: StructType, target: str, partition_by: Sequence[str]) -> None:
        last = [f for f in schema.fields if f.name in partition_by]
        first = [f for f in schema.fields if f.name not in partition_by]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*first, *last])
        by = ", ".join(f"`{name}`" for name in partition_by)
        self.spark.sql(f"CREATE TABLE {target} ({columns}) USING {self.fmt} PARTITIONED BY ({by})")

    def _point(self, target: str, values: dict[str, object], folder: str) -> None:
        """Let one partition of ``target`` be what was written into ``folder``."""
        spec = ", ".join(f"`{name}` = {_literal(value)}" for name, value in values.items())
        path = _part(folder, values)
        there = f"PARTITION ({spec})"
        self.spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {there} LOCATION '{path}'")
        self.spark.sql(f"ALTER TABLE {target} {there} SET LOCATION '{path}'")

    def _swap_table(
        self, schema: StructType, layer: str, table: str, values: dict[str, object], folder: str
    ) -> None:
        """A table of another schema under the same name; the old one goes last."""
        target, fresh, old = (self.name(layer, table + end) for end in ("", FRESH, OLD))
        self.spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        self._create(schema, fresh, list(values))
        self._point(fresh, values, folder)
        self.spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
        try:
            self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {target}")
        except PySparkException:
            self.spark.sql(f"ALTER TABLE {old} RENAME TO {target}")
            raise
        self.spark.sql(f"DROP TABLE IF EXISTS {old}")

    def _finish_swap(self, layer: str, table: str) -> None:
        """What a writer that was lost between two renames has left to do."""
        if self.exists(layer, table + OLD):
            target, old = self.name(layer, table), self.name(layer, table + OLD)
            if self.exists(layer, table):
                self.spark.sql(f"DROP TABLE {old}")
            else:
                self.spark.sql(f"ALTER TABLE {old} RENAME TO {target}")

    def drop_if_other(self, schema: StructType, layer: str, table: str) -> None:
        """Drop a table of working rows that an older release has written in another shape."""
        target = self.name(layer, table)
        if self.exists(layer, table) and _shape(self.spark.read.table(target).schema) != _shape(
            schema
        ):
            self.spark.sql(f"DROP TABLE {target}")

    def replace_slices(
        self, rows: DataFrame, layer: str, table: str, by: Sequence[str]
    ) -> list[dict[str, object]]:
        """Replace the partitions (of the columns ``by``) that get rows; returns which.

        Their number is that of the days or batches of one write. Values are dates or numbers.
        """
        self.ensure_layer(layer)
        target = self.name(layer, table)
        if self.fmt == "delta":
            return self._overwrite_slices(rows, layer, table, by)
        written = Observation()
        folder = self._write_beside(
            rows.observe(written, F.count(F.lit(1)).alias("rows")), layer, table, by
        )
        if not self.exists(layer, table):
            self._create(rows.schema, target, by)
        if written.get["rows"] == 0:
            return []
        stored = self.spark.read.schema(rows.schema).format(self.fmt).load(folder)
        slices = [row.asDict() for row in stored.select(*by).distinct().collect()]
        for values in slices:
            self._point(target, values, folder)
        return slices

    def replace_slice(
        self,
        rows: DataFrame,
        layer: str,
        table: str,
        values: dict[str, object],
        rows_per_file: int = 0,
    ) -> None:
        """Replace one partition with ``rows``, which all belong to it, in the order they have.

        A task starts another file after ``rows_per_file`` rows (0: never).
        """
        if self.fmt == "delta":
            self.replace_slices(rows, layer, table, list(values))
            return
        self.ensure_layer(layer)
        folder = self._write_one(rows, layer, table, values, rows_per_file)
        if not self.exists(layer, table):
            self._create(rows.schema, self.name(layer, table), list(values))
        self._point(self.name(layer, table), values, folder)

    def _overwrite_slices(
        self, rows: DataFrame, layer: str, table: str, by: Sequence[str]
    ) -> list[dict[str, object]]:
        target = self.name(layer, table)
        if not self.exists(layer, table):
            rows.write.format(self.fmt).partitionBy(*by).saveAsTable(target)
            rows = self.spark.read.table(target)
            return [row.asDict() for row in rows.select(*by).distinct().collect()]
        slices = [row.asDict() for row in rows.select(*by).distinct().collect()]
        if slices:
            only = " OR ".join(
                "(" + " AND ".join(f"`{n}` = {_literal(v)}" for n, v in values.items()) + ")"
                for values in slices
            )
            rows.write.format(self.fmt).mode("overwrite").option("replaceWhere", only).saveAsTable(
                target
            )
        return slices

    # -- append and upsert -------------------------------------------------

    def ensure_table(
        self, layer: str, table: str, schema: StructType, partition_by: Sequence[str] = ()
    ) -> None:
        """Create the table if absent, add columns it lacks."""
        target = self.name(layer, table)
        if not self.exists(layer, table):
            self.ensure_layer(layer)
            empty = self.spark.createDataFrame([], schema)
            empty.write.format(self.fmt).partitionBy(*partition_by).saveAsTable(target)
            return
        have = set(self.spark.read.table(target).columns)
        missing = [f for f in schema.fields if f.name not in have]
        if missing:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({added})")

    def append(self, frame: DataFrame, layer: str, table: str) -> None:
        """Append by name. New columns are added to the table, lacking ones are NULL."""
        self.ensure_table(layer, table, frame.schema)
        target = self.name(layer, table)
        have = set(frame.columns)
        fields = self.spark.read.table(target).schema.fields
        filled = frame.select(
            *(
                F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                for f in fields
            )
        )
        filled.write.insertInto(target)

    def ensure_keyed(self, layer: str, table: str, schema: StructType) -> None:
        """Create a table for ``upsert`` if absent, add columns it lacks."""
        versioned = StructType([*schema.fields, *VERSION_FIELDS])
        if self.fmt == "delta":
            self.ensure_table(layer, table, schema)
        elif self.exists(layer, table):
            self.ensure_table(layer, table, versioned)
        else:
            self.ensure_layer(layer)
            self._create(versioned, self.name(layer, table), [SLICE])

    def upsert(
        self,
        frame: DataFrame,
        layer: str,
        table: str,
        keys: Sequence[str],
        schema: StructType,
        at: int | None = None,
    ) -> None:
        """Insert or replace the row of each key.

        Plain files have no MERGE: every upsert adds a slice of versioned rows, and
        ``current`` reads the latest version of each key. Writers never touch each
        other's slices, so none can undo another; of two versions the later ``at``
        (microseconds, now by default) wins, then the larger slice name.
        """
        self.ensure_keyed(layer, table, schema)
        target = self.name(layer, table)
        if self.fmt == "delta":
            frame.createOrReplaceTempView("__incoming")
            same = " AND ".join(f"t.{k} = s.{k}" for k in keys)
            self.spark.sql(
                f"MERGE INTO {target} t USING __incoming s ON {same} "
                "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
            )
            return
        stamp = time.time_ns() // 1000 if at is None else at
        rows = frame.select(*schema.names).withColumn(VERSION, F.lit(stamp).cast("bigint"))
        self._add_slice(rows, layer, table, f"u{uuid.uuid4().hex}")
        if len(self._slices(target)) > SLICES:
            self.compact(layer, table, keys)

    def current(self, layer: str, table: str, keys: Sequence[str]) -> DataFrame:
        """The latest version of each key of a table that is written by ``upsert``."""
        stored = self.read(layer, table)
        if self.fmt == "delta":
            return stored
        return _latest(stored, keys).drop(VERSION, SLICE)

    def compact(self, layer: str, table: str, keys: Sequence[str]) -> int:
        """Merge the slices of a keyed table into one; returns how many there were.

        The merged slice is added before its parts go. A reader in between meets a
        version twice, which changes nothing, and a slice added meanwhile stays.
        """
        target = self.name(layer, table)
        merged = self._slices(target)
        if len(merged) > 1:
            parts = self.read(layer, table).where(F.col(SLICE).isin(*merged))
            latest = _latest(parts, keys).drop(SLICE)
            self._add_slice(latest, layer, table, f"c{uuid.uuid4().hex}")
            gone = ", ".join(f"PARTITION (`{SLICE}` = '{name}')" for name in merged)
            self.spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {gone}")
        return len(merged)

    def _add_slice(self, rows: DataFrame, layer: str, table: str, name: str) -> None:
        """Rows become visible all at once, as one new partition."""
        folder = self._write_one(rows, layer, table, {SLICE: name})
        self._point(self.name(layer, table), {SLICE: name}, folder)

    def _slices(self, target: str) -> list[str]:
        shown = self.spark.sql(f"SHOW PARTITIONS {target}").collect()
        return [row["partition"].split("=", 1)[1] for row in shown]


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key. NULLs are one key; rows of one version are ordered by all columns."""
    others = [name for name in rows.columns if name not in (*keys, VERSION, SLICE)]
    newest = F.max(F.struct(VERSION, SLICE, *others)).alias("newest")
    found = rows.groupBy(*keys).agg(newest)
    return found.select(
        *(F.col(n) if n in keys else F.col(f"newest.{n}").alias(n) for n in rows.columns)
    )


def _part(folder: str, values: dict[str, object]) -> str:
    return "/".join([folder, *(f"{name}={value}" for name, value in values.items())])


def _literal(value: object) -> str:
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return str(value) if isinstance(value, int) else f"'{value}'"


def _check_first(frame: DataFrame, target: str, odate: date) -> None:
    """The checks of a write ahead of it, for writes that cannot be undone."""
    require_rows(frame, target, odate)
    inside = F.col(BUSINESS_DATE).eqNullSafe(F.lit(odate).cast("date"))
    if not frame.where(~inside).isEmpty():
        raise PartitionContract(f"refusing to write {target}: {OUTSIDE}")


def _only_date(frame: DataFrame, target: str, odate: date) -> DataFrame:
    """The same rows; a row of another date fails the job that reads it."""
    inside = F.col(BUSINESS_DATE).eqNullSafe(F.lit(odate).cast("date"))
    message = F.lit(f"{target}: {OUTSIDE} odate={odate.isoformat()}")
    return frame.where(F.when(inside, True).otherwise(F.raise_error(message).cast("boolean")))


def _clustered(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range-partitioned and sorted rows, so files have narrow column ranges.

    A value that is more frequent than one partition should hold is split over
    several by the columns that follow it.
    """
    if not columns:
        return frame
    return frame.repartitionByRange(*columns).sortWithinPartitions(*columns)


def _shape(schema: StructType) -> list[tuple[str, str]]:
    """Column order without the partition column, which files always store last."""
    fields = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    last = [f for f in fields if f[0] == BUSINESS_DATE]
    return [f for f in fields if f[0] != BUSINESS_DATE] + last


def require_rows(frame: DataFrame, name: str, odate: date) -> DataFrame:
    """The frame itself, or an error naming table and date if it is empty."""
    if frame.isEmpty():
        raise EmptyPartition(f"{name} has no rows for odate={odate.isoformat()}")
    return frame
