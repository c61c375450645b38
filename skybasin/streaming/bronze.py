"""Continuous ingest of all topics into the raw layer.

Each micro-batch is routed by topic, decoded, stamped and inserted if absent.
Duplicates are found on ``message_id`` alone, over everything stored so far:

* ``dedup="table"`` looks the batch up in the raw table.  Exact whatever wrote
  the table; costs one scan of its id column per batch.
* ``dedup="state"`` keeps the ids in the streaming state (RocksDB, spread over
  the executors), so a batch costs what it holds, however long the table is.  The first
  batch of every start is also looked up in the table, since only that one can
  be a repetition of a batch that was written before a failure.
* ``dedup="index"`` looks ids up in an index beside the raw tables (``id_index``), of which a
  batch reads the folders of its own days and buckets.  Exact over everything ingested this
  way, and neither state nor reading grows with history.
* ``dedup="watermark"`` keeps ids in the state until the event time, the newest that the records
  name less ``delay``, has passed theirs.  An id that is not new to the state is looked up in the
  index: it is a duplicate if it is there, else the message came too late and goes to
  ``bronze_late``, once for each id.  Messages without a time are looked up in the index alone.

Of the copies of a message the one that arrived first is stored.  All modes give the same
rows, rejects and counts (but for late messages), and all drop a batch that is run twice, so restarting
from the checkpoint leaves every message and every reject stored once.  The index is written after
the raw tables; what a failure left out of it is added when the batch is run again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skybasin import fixed_values as fv
from skybasin.operators.latest import earliest_rows
from skybasin.operators.upsert import absent
from skybasin.session import side_by_side
from skybasin.sources.messages import parsed, record, routed
from skybasin.sources.tables import TableStore
from skybasin.streaming.id_index import IdIndex, placed, record_time

MODES = ("table", "state", "index", "watermark")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def stamped(records: DataFrame, source: str, ingested_at: str) -> DataFrame:
    return records.withColumns(
        {
            "_ingested_at": F.lit(ingested_at),
            "_source": F.lit(source),
            "_layer": F.lit("bronze"),
        }
    )


#: The earliest copy of a message is the one that counts: by time, then by place in its partition.
#: Copies that do not say when they arrived are told apart by their text.
_ARRIVED = ["timestamp", "partition", "offset", "value"]


def ingest_batch(
    store: TableStore,
    batch: DataFrame,
    ingested_at: str,
    look_up: bool = True,
    new_ids: DataFrame | None = None,
    index: IdIndex | None = None,
) -> dict[str, int]:
    """Store one micro-batch; returns total, written, duplicates, errors and unmapped, and with both an index and new ids late.

    Every message is decoded once.  Counts come from grouped counts over the decoded rows, and a
    table without new rows is not written, so no batch depends on what another branch holds.
    ``new_ids`` (source, message_id), if given, are the ids not met before; ``look_up`` compares
    with the stored tables.  With an ``index`` ids are looked up there, and those that are new to it are
    added; with both, ids that are neither new nor known there are late.  Total counts messages of known topics.
    """
    kept = StorageLevel.MEMORY_AND_DISK
    messages = parsed(routed(batch)).persist(kept)
    fresh = rejects = unseen = late = None
    try:
        state = F.when(F.col("source").isNull(), "unmapped").when(F.col("fields").isNull(), "errors")
        counts = {
            r["state"]: r["count"]
            for r in messages.groupBy(state.otherwise("records").alias("state")).count().collect()
        }
        readable = messages.filter("source IS NOT NULL AND fields IS NOT NULL").withColumn(
            "message_id", F.try_element_at("fields", F.lit("message_id"))
        )
        if new_ids is not None and index is None:
            same = readable["source"].eqNullSafe(new_ids["source"]) & readable["message_id"].eqNullSafe(
                new_ids["message_id"]
            )
            readable = readable.join(new_ids, same, "left_semi")
        if index is None:
            fresh = _absent(store, readable, look_up).persist(kept)
        else:
            first = placed(earliest_rows(readable, ["source", "message_id"], _ARRIVED))
            unseen = index.unknown(first)
            if new_ids is not None:
                unseen = _marked_late(unseen, new_ids)
            unseen = unseen.persist(kept)
            in_time = unseen.filter(~F.col(_LATE)) if new_ids is not None else unseen
            fresh = (_not_stored(store, in_time) if look_up else in_time).persist(kept)
            if new_ids is not None:
                late = _late(store, unseen.filter(_LATE), ingested_at).persist(kept)
        rejects = _new_rejects(store, messages, ingested_at).persist(kept)
        written = {r["source"]: r["count"] for r in fresh.groupBy("source").count().collect()}

        def write(source: str) -> None:
            rows = fresh.filter(F.col("source") == source).select(*record(source))
            store.append(fv.BRONZE[source], stamped(rows, source, ingested_at))

        jobs = [partial(write, source) for source in written]
        if counts.get("errors") and not rejects.isEmpty():
            jobs.append(lambda: store.append("bronze_rejects", rejects))
        # Counted before anything is written: a frame that reads what is written is computed anew.
        n_late = unseen.filter(_LATE).count() if late is not None else 0
        if late is not None and not late.isEmpty():
            jobs.append(lambda: store.append("bronze_late", late))
        if jobs:
            side_by_side(store.spark, jobs)
        # Last: an id that is in the index is stored for certain.
        if index is not None:
            index.append(in_time)
    finally:
        for frame in (messages, fresh, rejects, unseen, late):
            if frame is not None:
                frame.unpersist()
    stored = sum(written.values())
    result = {
        "total": counts.get("records", 0) + counts.get("errors", 0),
        "written": stored,
        "duplicates": counts.get("records", 0) - stored - n_late,
        "errors": counts.get("errors", 0),
        "unmapped": counts.get("unmapped", 0),
    }
    return result | ({"late": n_late} if late is not None else {})


def _absent(store: TableStore, readable: DataFrame, look_up: bool) -> DataFrame:
    """The earliest copy of each message of a source that is not stored yet."""
    first = earliest_rows(readable, ["source", "message_id"], _ARRIVED)
    return _not_stored(store, first) if look_up else first


def _not_stored(store: TableStore, first: DataFrame) -> DataFrame:
    known = [
        store.read(fv.BRONZE[source]).select(F.lit(source).alias("source"), "message_id") for source in fv.SOURCES
    ]
    return absent(first, reduce(DataFrame.union, known), ["source", "message_id"])


_LATE = "_is_late"


def _marked_late(unseen: DataFrame, new_ids: DataFrame) -> DataFrame:
    """Messages whose id is not in the index, and whether the state has dropped them for their time."""
    new = new_ids.select(F.col("source").alias("_new_source"), F.col("message_id").alias("_new"), F.lit(True).alias("_seen"))
    same = unseen["source"].eqNullSafe(new["_new_source"]) & unseen["message_id"].eqNullSafe(new["_new"])
    timed = _event_time(F.col("source"), F.col("fields")).isNotNull()
    return unseen.join(new, same, "left").withColumn(_LATE, F.col("_seen").isNull() & timed).drop("_new_source", "_new", "_seen")


def _late(store: TableStore, rows: DataFrame, ingested_at: str) -> DataFrame:
    """Late messages whose id has not been reported yet."""
    report = rows.select("source", "message_id", "topic", "key", "value", F.lit(ingested_at).alias("_ingested_at"))
    return absent(report, store.read("bronze_late"), ["source", "message_id"])


def _event_time(source: Column, fields: Column) -> Column:
    return record_time(source, fields).try_cast("timestamp")


def _new_rejects(store: TableStore, messages: DataFrame, ingested_at: str) -> DataFrame:
    """Messages of known topics that are no JSON object and are not stored yet.

    Their place in the topic is their identity.  Without one it is their text, and the number of
    that copy among those of the batch.
    """
    text = ["topic", "key", "value"]
    place = ["partition", "offset"]
    # Copies are counted where they are and numbered after, so a line that a feed repeats is no hot group.
    alike = messages.filter("source IS NOT NULL AND fields IS NULL").groupBy(*text, *place).agg(F.count("*").alias("n"))
    # A place that is repeated within a batch is one message.
    copies = F.when(F.col("offset").isNull(), F.col("n")).otherwise(1).cast("int")
    broken = alike.select(*text, *place, F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return absent(broken, store.read("bronze_rejects"), [*text, *place, "copy"]).withColumn(
        "_ingested_at", F.lit(ingested_at)
    )


def start_ingest(
    messages: DataFrame,
    store: TableStore,
    checkpoint: str,
    dedup: str = "table",
    processing_time: str = "1 second",
    available_now: bool = False,
    clock: Callable[[], str] = utc_now,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
    delay: str = "7 days",
) -> StreamingQuery:
    """Start the ingest of a message stream (see ``messages.read_stream``); ``delay`` is that of the watermark."""
    if dedup not in MODES:
        raise ValueError(f"unknown dedup {dedup!r}")
    by_state = dedup in ("state", "watermark")
    index = IdIndex(store) if dedup in ("index", "watermark") else None
    if by_state:
        store.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        messages = _with_new_ids(messages, delay if dedup == "watermark" else None)
    started = {"first": True}

    def write(batch: DataFrame, batch_id: int) -> None:
        new_ids = None
        if by_state:
            new_ids = batch.filter(_NEW).select("source", F.col("key").alias("message_id"))
            batch = batch.filter(~F.col(_NEW)).drop(_NEW, "source")
        look_up = started["first"] or dedup == "table"
        counts = ingest_batch(store, batch, clock(), look_up, new_ids, index)
        started["first"] = False
        if on_batch:
            on_batch(batch_id, counts)

    store.create_all()
    if index is not None:
        index.create()
    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    return writer.trigger(**trigger).start()


_NEW = "__new_id"
_TIME = "__event_time"


def _with_new_ids(messages: DataFrame, delay: str | None) -> DataFrame:
    """All messages, and beside them a row for each id that the state has not met (id as ``key``).

    Only ids of readable messages are remembered; the messages themselves pass unchanged, so that
    counts, rejects and the choice of the earliest copy see all of them.  With a ``delay`` ids are forgotten
    when the event time is so far beyond theirs, and ids without a time are not remembered.
    """
    known = routed(parsed(messages))
    readable = known.filter("source IS NOT NULL AND fields IS NOT NULL").select(
        "source",
        F.try_element_at("fields", F.lit("message_id")).alias("key"),
        _event_time(F.col("source"), F.col("fields")).alias(_TIME),
    )
    if delay is None:
        ids = readable.drop(_TIME).dropDuplicates(["source", "key"])
    else:
        timed = readable.filter(F.col(_TIME).isNotNull()).withWatermark(_TIME, delay)
        ids = timed.dropDuplicatesWithinWatermark(["source", "key"]).drop(_TIME)
    ids = ids.withColumn(_NEW, F.lit(True))
    return known.drop("fields").withColumn(_NEW, F.lit(False)).unionByName(ids, allowMissingColumns=True)
