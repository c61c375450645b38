"""Streams over a folder of message files: replay, duplicates, broken messages."""

import hashlib
import json

import pytest

from skybasin import fixed_values as fv
from skybasin.session import working_dir
from skybasin.sources import messages
from skybasin.sources.tables import TableStore
from skybasin.streaming.bronze import MODES, ingest_batch, start_ingest
from skybasin.streaming.id_index import IdIndex, placed

RUN = "2026-05-01T00:00:00+00:00"


def message(topic, value, **fields):
    return (topic, None, value if value is not None else json.dumps(fields))


def air(message_id, pm25="1"):
    return message("air_quality_raw", None, timestamp="2026-04-21T14:00:00Z", province="Bangkok", pm25=pm25,
                   message_id=message_id)


def weather(message_id):
    return message("weather_raw", None, timestamp="2026-04-21T14:00:00Z", temperature=30.5, message_id=message_id)


class Ingest:
    def __init__(self, spark, dedup, **options):
        self.spark, self.dedup, self.options = spark, dedup, options
        self.folder = working_dir(spark, "stream")
        self.store = TableStore(spark, f"{self.folder}/store")
        self.counts = []

    def send(self, *rows):
        frame = self.spark.createDataFrame(rows, "topic string, key string, value string").coalesce(1)
        messages.send(frame, "json", f"{self.folder}/in")

    def run(self, checkpoint="checkpoint"):
        stream = messages.read_stream(self.spark, "json", f"{self.folder}/in", max_per_trigger=1)
        query = start_ingest(stream, self.store, f"{self.folder}/{checkpoint}", self.dedup, available_now=True,
                             clock=lambda: RUN, on_batch=self.count, **self.options)
        query.awaitTermination()
        return query

    def count(self, _, counts):
        # The watermark also moves in batches without messages.
        if counts["total"] or counts["unmapped"] or self.dedup != "watermark":
            self.counts.append(counts)

    def ids(self, source="air_quality"):
        return sorted((r.message_id for r in self.store.read(fv.BRONZE[source]).collect()), key=str)


@pytest.mark.parametrize("dedup", MODES)
def test_ingest(spark, dedup):
    stream = Ingest(spark, dedup)
    stream.send(air("a"), air("a"), air("b", 17), air(None), air(None, "2"), weather("a"),
                message("air_quality_raw", "{broken"), message("air_quality_raw", "[1]"),
                message("flood_raw", "5"), message("elsewhere", "{}"))
    stream.run()
    stream.send(air("b"), air("c", 1e-05), air(None, "3"), weather("w"))
    stream.run()
    assert stream.ids() == [None, "a", "b", "c"]
    assert stream.ids("weather") == ["a", "w"]
    rejects = sorted((r.topic, r.value) for r in stream.store.read("bronze_rejects").collect())
    assert rejects == [("air_quality_raw", "[1]"), ("air_quality_raw", "{broken"), ("flood_raw", "5")]
    row = stream.store.read("bronze_air_quality").filter("message_id = 'b'").first()
    assert (row.pm25, row._ingested_at, row._source, row._layer) == ("17", RUN, "air_quality", "bronze")
    none_late = {"late": 0} if dedup == "watermark" else {}
    assert stream.counts[0] == {"total": 9, "written": 4, "duplicates": 2, "errors": 3, "unmapped": 1} | none_late
    assert stream.counts[1] == {"total": 4, "written": 2, "duplicates": 2, "errors": 0, "unmapped": 0} | none_late


@pytest.mark.parametrize("dedup", MODES)
def test_a_lost_checkpoint_adds_nothing(spark, dedup):
    stream = Ingest(spark, dedup)
    stream.send(air("a"), air("b"), weather("w"))
    stream.run()
    stream.run("another_checkpoint")
    assert stream.ids() == ["a", "b"] and stream.ids("weather") == ["w"]


def test_a_batch_run_twice_adds_nothing(spark, store):
    rows = [air("a"), air("b"), air(None), weather("w")]
    batch = spark.createDataFrame(rows, "topic string, key string, value string")
    assert ingest_batch(store, batch, RUN)["written"] == 4
    assert ingest_batch(store, batch, RUN)["written"] == 0


def test_a_hot_message_is_stored_once(spark, store):
    rows = [air("hot")] * 3000 + [air(f"m{i}") for i in range(2000)]
    batch = spark.createDataFrame(rows, "topic string, key string, value string").repartition(8)
    assert ingest_batch(store, batch, RUN) == {
        "total": 5000, "written": 2001, "duplicates": 2999, "errors": 0, "unmapped": 0}


ARRIVED = "topic string, key string, value string, partition int, offset bigint"


@pytest.mark.parametrize("rows", [
    [], [air("a")], [weather("w")], [air("a"), weather("w")], [message("elsewhere", "{}")],
    [message("air_quality_raw", "{broken")], [air("a"), message("flood_raw", "5")]])
def test_sparse_batches_and_their_replay(spark, store, rows):
    batch = spark.createDataFrame(rows, "topic string, key string, value string")
    known = [r for r in rows if r[0] != "elsewhere"]
    broken = [r for r in known if not r[2].startswith('{"')]
    first = ingest_batch(store, batch, RUN)
    assert first == {"total": len(known), "written": len(known) - len(broken), "duplicates": 0,
                     "errors": len(broken), "unmapped": len(rows) - len(known)}
    for _ in range(2):
        again = ingest_batch(store, batch, RUN)
        assert again == first | {"written": 0, "duplicates": first["written"]}
    assert store.read("bronze_rejects").count() == len(broken)


def test_rejects_are_told_apart_by_their_place(spark, store):
    rows = [("flood_raw", None, "5", 0, 1), ("flood_raw", None, "5", 0, 2), ("flood_raw", None, "5", 0, 2)]
    for _ in range(2):
        ingest_batch(store, spark.createDataFrame(rows, ARRIVED), RUN)
    ingest_batch(store, spark.createDataFrame([("flood_raw", None, "5", 1, 1)], ARRIVED), RUN)
    assert store.read("bronze_rejects").count() == 3


def test_copies_of_a_reject_without_a_place_all_stay(spark, store):
    batch = spark.createDataFrame([message("flood_raw", "5")] * 3, "topic string, key string, value string")
    for _ in range(2):
        ingest_batch(store, batch, RUN)
    assert store.read("bronze_rejects").count() == 3


@pytest.mark.parametrize("dedup", MODES)
def test_the_first_arrival_wins(spark, dedup):
    stream = Ingest(spark, dedup)

    def send(*rows):
        frame = spark.createDataFrame([(*air(i, pm25), 0, offset) for i, pm25, offset in rows], ARRIVED)
        messages.send(frame.coalesce(1), "json", f"{stream.folder}/in")

    send(("a", "9", 7), ("a", "1", 3), ("a", "5", 4))
    send(("a", "0", 8), ("b", "2", 9))
    stream.run()
    stored = stream.store.read("bronze_air_quality").select("message_id", "pm25").collect()
    assert sorted(map(tuple, stored)) == [("a", "1"), ("b", "2")]


def own_air(day, pm25="1", province="Bangkok"):
    """A message whose id is the hash of its content."""
    when = f"{day}T14:00:00Z"
    fields = {"timestamp": when, "province": province, "pm25": pm25}
    return message("air_quality_raw", None, **fields, message_id=hashlib.md5(f"{when}|{province}|{pm25}".encode()).hexdigest())


def _scanned_files(df):
    """Files that the scans of a query opened, by its own metrics."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    text, files = [plan], 0
    while text:
        node = text.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        elif name.endswith("QueryStageExec"):
            node = node.plan()
        metric = node.metrics().get("numFiles")
        files += metric.get().value() if metric.isDefined() else 0
        text += [node.children().apply(i) for i in range(node.children().size())]
        text += [node] if name == "AdaptiveSparkPlanExec" else []
    return files


def test_a_look_up_reads_the_days_and_buckets_of_the_batch(spark, store):
    index = IdIndex(store)
    index.create()

    def batch(*rows):
        from skybasin.sources.messages import parsed, routed

        known = parsed(routed(spark.createDataFrame(list(rows), "topic string, key string, value string")))
        return placed(known.withColumn("message_id", known["fields"]["message_id"]))

    def ingest(days):
        rows = [own_air(f"2026-{d // 28 + 1:02d}-{d % 28 + 1:02d}", str(i)) for d in days for i in range(40)]
        frame = spark.createDataFrame(rows, "topic string, key string, value string")
        assert ingest_batch(store, frame, RUN, look_up=False, index=index)["written"] == len(rows)

    ingest(range(3))
    looked_up = batch(own_air("2026-01-02", "7"), own_air("2026-01-02", "new"))
    near = index._of_days(looked_up)
    assert "dynamicpruning" in near._jdf.queryExecution().executedPlan().toString()
    before = _scanned_files(near)
    ingest(range(3, 33))
    after = _scanned_files(index._of_days(looked_up))
    assert 0 < before == after
    assert [r.message_id for r in index.unknown(looked_up).collect()] == [json.loads(own_air("2026-01-02", "new")[2])["message_id"]]
    # An id that is no hash of its content is looked up in all days of its bucket.
    known = json.loads(own_air("2026-01-02", "7")[2])["message_id"]
    assert index.unknown(batch(air(known), air("else"))).select("message_id").collect() == [("else",)]
    # Folders of few large files hold the same.
    index.compact("2026-01-20")
    assert index.unknown(looked_up).count() == 1 and index.read().count() == 33 * 40


def test_an_id_of_another_day_is_the_same_id(spark, store):
    index = IdIndex(store)
    index.create()
    own = own_air("2026-01-02")
    foreign = air(json.loads(own[2])["message_id"], "99")
    schema = "topic string, key string, value string"
    for rows in ([foreign], [own], [foreign, own]):
        ingest_batch(store, spark.createDataFrame(rows, schema), RUN, look_up=False, index=index)
    assert [r.pm25 for r in store.read("bronze_air_quality").collect()] == ["99"]


def test_an_index_that_a_failure_left_behind_is_completed(spark, store):
    index = IdIndex(store)
    index.create()
    batch = spark.createDataFrame([own_air("2026-01-02", str(i)) for i in range(5)], "topic string, key string, value string")
    # Raw rows are written, the index is not.
    assert ingest_batch(store, batch, RUN)["written"] == 5 and index.read().count() == 0
    assert ingest_batch(store, batch, RUN, look_up=True, index=index)["written"] == 0
    assert index.read().count() == 5
    assert ingest_batch(store, batch, RUN, look_up=False, index=index)["written"] == 0


def test_ids_beyond_the_watermark_are_forgotten_and_reported(spark):
    stream = Ingest(spark, "watermark", delay="2 days")
    stream.send(*(own_air("2026-01-01", str(i)) for i in range(20)))
    stream.run()
    stream.send(own_air("2026-01-20"), own_air("2026-01-01", "3"))
    stream.run()
    # 1 January is beyond the watermark now: an id that is stored is a duplicate, any other is late.
    stream.send(own_air("2026-01-21"), own_air("2026-01-01", "4"), own_air("2026-01-01", "late"), air(None))
    query = stream.run()
    assert {k: stream.counts[-1][k] for k in ("written", "duplicates", "late")} == {"written": 2, "duplicates": 1, "late": 1}
    stream.send(own_air("2026-01-01", "late"), own_air("2026-01-21"))
    query = stream.run()
    assert {k: stream.counts[-1][k] for k in ("written", "duplicates", "late")} == {"written": 0, "duplicates": 1, "late": 1}
    reported = [json.loads(r.value)["pm25"] for r in stream.store.read("bronze_late").collect()]
    assert reported == ["late"]
    rows = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert 0 < min(rows) <= 2
    assert stream.store.read("bronze_air_quality").count() == 23


def test_messages_without_a_time_need_no_state(spark):
    stream = Ingest(spark, "watermark", delay="1 day")
    timeless = [message("air_quality_raw", None, pm25="1", message_id=i) for i in ("x", "y", "x")]
    stream.send(own_air("2026-03-01"), *timeless)
    stream.run()
    stream.send(own_air("2026-03-09"), timeless[0], message("flood_raw", None, date="no day", message_id="z"))
    stream.run()
    assert [c["written"] for c in stream.counts] == [3, 2] and [c["late"] for c in stream.counts] == [0, 0]
