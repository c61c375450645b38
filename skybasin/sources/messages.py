"""Message envelopes (topic, key, value) and their sources and sinks.

The same functions serve a Kafka topic and, where no broker is at hand, a folder
of files with the columns ``topic``, ``key`` and ``value``, and those of ``ARRIVAL`` if it has them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skybasin import fixed_values as fv
from skybasin.schemas import ARRIVAL, EXTRA, MESSAGE, RAW


def read_stream(
    spark: SparkSession,
    format: str = "kafka",
    path: str | None = None,
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """All topics as one stream, from the earliest message on.

    ``max_per_trigger`` limits a micro-batch: messages for Kafka, else files.  Without
    it a batch takes what is there.
    """
    reader = spark.readStream.format(format).options(**options)
    if max_per_trigger:
        limit = "maxOffsetsPerTrigger" if format == "kafka" else "maxFilesPerTrigger"
        reader = reader.option(limit, max_per_trigger)
    if format == "kafka":
        reader = reader.option("subscribe", ",".join(fv.TOPICS.values())).option(
            "startingOffsets", "earliest"
        )
        return reader.load().select(
            "topic",
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            "partition",
            "offset",
            F.col("timestamp").cast("string"),
        )
    return reader.schema(MESSAGE).load(path)


def envelope(records: DataFrame, source: str, beside: Sequence[str] = ()) -> DataFrame:
    """Records as messages: the id is the key, the JSON of the row the value; columns ``beside`` it stay columns."""
    return records.select(
        F.lit(fv.TOPICS[source]).alias("topic"),
        F.col("message_id").alias("key"),
        F.to_json(F.struct(*(c for c in records.columns if c not in beside))).alias("value"),
        *beside,
    )


def send_stream(
    messages: DataFrame, checkpoint: str, path: str, format: str = "parquet", available_now: bool = False, **options: str
) -> StreamingQuery:
    """Send a stream of messages to a folder; its commit log makes a restart add no message twice."""
    writer = messages.writeStream.format(format).options(**options).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def send(messages: DataFrame, format: str = "kafka", path: str | None = None, **options: str) -> None:
    messages.write.format(format).mode("append").options(**options).save(path)


def routed(messages: DataFrame) -> DataFrame:
    """Messages with the ``source`` of their topic; null for an unknown topic."""
    route = F.create_map(*(F.lit(x) for s, t in fv.TOPICS.items() for x in (t, s)))
    return messages.withColumn("source", F.try_element_at(route, F.col("topic")))


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with the fields of their JSON object as the map ``fields``, null for anything else.

    Values keep the text that arrived.  The columns of ``ARRIVAL`` are null where they are missing.
    """
    missing = {f.name: F.lit(None).cast(f.dataType) for f in ARRIVAL if f.name not in messages.columns}
    known = messages.withColumns(missing) if missing else messages
    return known.withColumn("fields", F.from_json(F.col("value"), "map<string, string>"))


def record(source: str) -> list[Column]:
    """The declared columns of a source from ``fields``; what is not declared is gathered in ``_extra``."""
    names = RAW[source].fieldNames()
    extra = F.map_filter("fields", lambda name, _: ~name.isin(*names))
    return [
        *(F.try_element_at("fields", F.lit(name)).alias(name) for name in names),
        F.when(F.size(extra) > 0, F.to_json(extra)).alias(EXTRA),
    ]


def decode(messages: DataFrame, source: str) -> DataFrame:
    """Messages with the fields of their JSON object as ``record``; null for anything else."""
    fields = F.struct(*record(source))
    decoded = parsed(messages).withColumn("record", F.when(F.col("fields").isNotNull(), fields))
    return decoded.select(*messages.columns, "record")
