"""Ids of stored messages, beside the raw tables: a look-up that does not grow with history.

One narrow row per stored id, in folders by source, day and hash bucket.  The day is that of the
record, where the id is the hash of the record's content (``functions.identity``): all messages with such an
id have the same content, so the same day, and a batch reads the folders of its own days and
buckets only.  An id that is something else may come with any day; it is kept under ``ANY_DAY`` and
looked up on all days of its bucket.  So the look-up is exact on the id alone in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skybasin import fixed_values as fv
from skybasin.functions.identity import content_id
from skybasin.functions.timestamps import valid_date
from skybasin.operators.upsert import absent

BUCKETS = 16
ANY_DAY = "any"
PLACE = ["_source", "_day", "_bucket"]
SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("message_id", "_source", "_day")]
    + [T.StructField("_bucket", T.IntegerType())]
)


def record_time(source: Column, fields: Column) -> Column:
    """The text that says when a record was made."""
    when = F.try_element_at(fields, F.when(source == "flood", "date").otherwise("timestamp"))
    return F.when(source.isin(*fv.SOURCES), when)


def placed(readable: DataFrame) -> DataFrame:
    """Readable messages (``source``, ``fields``, ``message_id``) with the place of their id in the index."""
    day = F.substring(record_time(F.col("source"), F.col("fields")), 1, 10)
    by_content = F.col("message_id") == content_id(F.col("source"), F.col("fields"))
    return readable.withColumns(
        {
            "_source": F.col("source"),
            "_day": F.when(by_content & valid_date(day), day).otherwise(ANY_DAY),
            "_bucket": F.pmod(F.xxhash64("message_id"), F.lit(BUCKETS)).cast("int"),
        }
    )


class IdIndex:
    def __init__(self, store):
        self.spark, self.path = store.spark, store.path("bronze_ids")

    def create(self) -> None:
        nothing = self.spark.createDataFrame([], SCHEMA)
        nothing.write.mode("ignore").partitionBy(*PLACE).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def near(self, ids: DataFrame) -> DataFrame:
        """The stored ids in the folders where these (see ``placed``) can be.

        The folders are joined, which prunes the scan when the query runs; they are broadcast, as there are
        no more of them than sources, days of the calendar and buckets.
        """
        return self._of_days(ids).union(self._of_buckets(ids))

    def _of_days(self, ids: DataFrame) -> DataFrame:
        dated = ids.filter(F.col("_day") != ANY_DAY).select(*PLACE)
        folders = dated.union(dated.withColumn("_day", F.lit(ANY_DAY))).distinct()
        return self._pruned(folders, PLACE)

    def _of_buckets(self, ids: DataFrame) -> DataFrame:
        folders = ids.filter(F.col("_day") == ANY_DAY).select("_source", "_bucket").distinct()
        return self._pruned(folders, ["_source", "_bucket"])

    def _pruned(self, folders: DataFrame, by: list[str]) -> DataFrame:
        # Spark prunes by a joined side that has a filter of its own.
        return self.read().join(F.broadcast(folders.filter("_bucket >= 0")), by, "left_semi").select(
            "_source", "message_id"
        )

    def unknown(self, ids: DataFrame) -> DataFrame:
        """The rows of ``ids`` (one per source and id) whose id is not stored."""
        return absent(ids, self.near(ids), ["_source", "message_id"])

    def append(self, ids: DataFrame) -> None:
        if ids.isEmpty():
            return
        rows = ids.select("message_id", *PLACE)
        rows.hint("rebalance", *PLACE).write.mode("append").partitionBy(*PLACE).parquet(self.path)

    def compact(self, before_day: str) -> None:
        """Rewrite the folders of days before a day, each as few files; run it beside no ingest."""
        old = self.read().filter((F.col("_day") < before_day) & (F.col("_day") != ANY_DAY)).checkpoint()
        old.hint("rebalance", *PLACE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *PLACE
        ).parquet(self.path)
