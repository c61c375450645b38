"""Stored tables: Parquet folders below one root, partitioned by day.

The partition column ``_date`` is the first ten characters of the column a table
names as ``day_from``, or ``undated``; the column itself keeps its text.

A table without days (a dimension, the marks) is replaced as a whole, version by version (``versions``): readers
keep what they see, and a writer that another one overtook merges again with the newer version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skybasin.functions.timestamps import valid_date
from skybasin.operators.quality import repeated_keys
from skybasin.operators.upsert import CHANGE, change_counts, upsert
from skybasin.schemas import TABLES, Table
from skybasin.session import shared_dir
from skybasin.sources.versions import Versions

DAY = "_date"
UNDATED = "undated"
#: How often a writer that is overtaken starts over.
TRIES = 20


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        shared_dir(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create_all(self) -> None:
        """Create the tables of all layers that do not exist yet."""
        for table in TABLES.values():
            nothing = self.spark.range(0).limit(0)
            if not table.day_from:
                versions = Versions(self.spark, self.path(table.name))
                if not versions.current()[0]:
                    self._publish(versions, 1, self._shaped(table, nothing))
                continue
            self._writer(table, self._shaped(table, nothing)).mode("ignore").parquet(
                self.path(table.name)
            )

    def read(self, name: str, days: DataFrame | None = None) -> DataFrame:
        """A table with its declared schema, of some days (see ``days_of``) if given.

        The days are joined, which prunes the partitions when the query runs.  They are
        broadcast: there are no more than the calendar has, however large the table is.
        """
        table = TABLES[name]
        schema = table.schema
        if table.day_from:
            schema = T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])
        if table.day_from:
            df = self.spark.read.schema(schema).parquet(self.path(name))
        else:
            df = self._version(table, Versions(self.spark, self.path(name)).current()[1])
        if days is not None:
            # Spark prunes by a joined side that has a filter of its own.
            df = df.join(F.broadcast(days.filter(F.col(DAY) >= "")), DAY, "left_semi")
        return df.drop(DAY)

    def read_from_day(self, name: str, day: str | None) -> DataFrame:
        """A table without the partitions before a day."""
        table = TABLES[name]
        schema = T.StructType([*table.schema.fields, T.StructField(DAY, T.StringType())])
        df = self.spark.read.schema(schema).parquet(self.path(name))
        return (df if day is None else df.filter(F.col(DAY) >= day)).drop(DAY)

    def append(self, name: str, rows: DataFrame) -> None:
        table = TABLES[name]
        if not table.day_from:
            versions = Versions(self.spark, self.path(name))
            for _ in range(TRIES):
                number, folder = versions.current()
                before = self._version(table, folder)
                if self._publish(versions, number + 1, before.union(self._shaped(table, rows))):
                    return
            raise RuntimeError(f"{name}: overtaken by other writers {TRIES} times")
        self._writer(table, self._shaped(table, rows)).mode("append").parquet(self.path(name))

    def days_of(self, name: str, rows: DataFrame) -> DataFrame:
        """The days some rows belong to, one per row in the column ``_date``."""
        return rows.select(_day(TABLES[name]).alias(DAY)).distinct()

    def day(self, day: str) -> DataFrame:
        return self.spark.createDataFrame([(day,)], f"{DAY} string")

    def upsert(self, name: str, updates: DataFrame) -> DataFrame | None:
        """Set updates (one per key) on a table; returns the days they belong to.

        None stands for a table without days.  The updates are checkpointed once.  Only the
        partitions they touch are read and replaced, and a partition is swapped in when all
        tasks are done, so tasks that are lost and run again read unchanged files.
        """
        return self.upsert_counted(name, updates, count=False)[0]

    def upsert_counted(
        self, name: str, updates: DataFrame, count: bool = True
    ) -> tuple[DataFrame | None, DataFrame | None]:
        """``upsert``, and how many rows it inserted and modified."""
        table = TABLES[name]
        updates = updates.checkpoint()
        if not table.day_from:
            return None, self._replace(name, updates, count)
        days = self.days_of(name, updates).checkpoint()
        if days.isEmpty():
            return days, change_counts(updates.withColumn(CHANGE, F.lit("kept"))) if count else None
        merged = upsert(self.read(name, days), updates, table.key, with_change=count)
        counts = None
        if count:
            # Counted from what is written, so the tables are joined once.
            merged = merged.checkpoint()
            counts = change_counts(merged)
        self._writer(table, self._shaped(table, merged)).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(self.path(name))
        return days, counts

    def _replace(self, name: str, updates: DataFrame, count: bool) -> DataFrame | None:
        """Merge updates with the version that counts, and again if another writer's comes first."""
        table, versions = TABLES[name], Versions(self.spark, self.path(name))
        for _ in range(TRIES):
            number, folder = versions.current()
            before = self._version(table, folder)
            merged = upsert(before, updates, table.key, with_change=count)
            if count:
                merged = merged.checkpoint()
            if self._publish(versions, number + 1, self._shaped(table, merged)):
                return change_counts(merged) if count else None
        raise RuntimeError(f"{name}: overtaken by other writers {TRIES} times")

    def _version(self, table: Table, folder: str | None) -> DataFrame:
        """The rows of a version's folder; none before the first version."""
        if folder is None:
            return self.spark.createDataFrame([], table.schema)
        return self.spark.read.schema(table.schema).parquet(folder)

    @staticmethod
    def _publish(versions: Versions, number: int, rows: DataFrame) -> bool:
        folder = versions.folder(number)
        rows.write.parquet(folder)
        published = versions.publish(number, folder)
        if not published:
            versions.discard(folder)
        return published

    def turn(self) -> int:
        """How many refreshes of the joined days there have been (see ``end_turn``)."""
        return Versions(self.spark, self.path("_refreshes")).current()[0]

    def end_turn(self, turn: int) -> bool:
        """Count a refresh that began at ``turn``; false if another one was counted meanwhile.

        Two flows that refresh days at once may each have read sources that the other one was
        about to change; the one that is told so reads and joins its days again.
        """
        return Versions(self.spark, self.path("_refreshes")).publish(turn + 1, "refresh")

    def changes(self, name: str, updates: DataFrame) -> DataFrame:
        """What ``upsert`` would do to each row, in the column ``_change``."""
        days = self.days_of(name, updates) if TABLES[name].day_from else None
        changed = upsert(self.read(name, days), updates, TABLES[name].key, with_change=True)
        return changed.filter(F.col(CHANGE) != "kept")

    def repeated_keys(self, name: str) -> DataFrame:
        return repeated_keys(self.read(name), list(TABLES[name].key))

    def _shaped(self, table: Table, rows: DataFrame) -> DataFrame:
        """The declared columns in order, missing ones null, plus the day."""
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
        shaped = rows.select(*columns)
        return shaped.withColumn(DAY, _day(table)) if table.day_from else shaped

    def _writer(self, table: Table, rows: DataFrame):
        if DAY not in rows.columns:
            rows = rows.withColumn(DAY, _day(table))
        # Gathers a day into few files and splits a day that is too large for one;
        # sorted by place, so that a query of one place skips most row groups.
        places = [name for name in table.key if name == "province"]
        return rows.hint("rebalance", DAY).sortWithinPartitions(DAY, *places).write.partitionBy(DAY)


def _day(table: Table):
    day = F.substring(F.col(table.day_from), 1, 10)
    return F.when(valid_date(day), day).otherwise(UNDATED)
