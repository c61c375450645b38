"""Stored tables and whole flows."""

import os

import pytest
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.operators import cleaning
from skybasin.plans import flows
from skybasin.schemas import RAW, TABLES
from skybasin.sources import files
from skybasin.sources.versions import KEPT, Versions

RUN = "2026-05-01T00:00:00+00:00"
LATER = "2026-05-02T00:00:00+00:00"


def add(store, source, *rows):
    names = RAW[source].fieldNames() + ["_ingested_at", "_source", "_layer"]
    stamps = {"_source": source, "_layer": "bronze"}
    full = [tuple({**stamps, **row}.get(n) for n in names) for row in rows]
    store.append(fv.BRONZE[source], store.spark.createDataFrame(full, ", ".join(f"{n} string" for n in names)))


def air(province, hour, pm25, at, day="2026-04-21"):
    return dict(timestamp=f"{day}T{hour:02d}:10:00Z", province=province, pm25=pm25, _ingested_at=at,
                message_id=f"{province}{day}{hour}{at}")


def weather(province, hour, temperature, at, day="2026-04-21"):
    return dict(timestamp=f"{day}T{hour:02d}:20:00Z", province=province, temperature=temperature, humidity="50",
                weather_condition="Clear", _ingested_at=at, message_id=f"{province}{day}{hour}{at}")


def flood(province, risk, at, day="2026-04-21"):
    return dict(date=day, province=province, flood_risk=risk, affected_area_km2="1.5", water_level_m="0.5",
                _ingested_at=at, message_id=f"{province}{day}{at}")


def state(store, name):
    """A table without its run stamps."""
    table = store.read(name).drop("_processed_at", "_updated_at")
    return sorted(map(str, table.collect()))


def test_tables_are_created_once(store):
    row = store.spark.createDataFrame([("P", 1.0, 2.0, "Thailand", RUN)], TABLES[fv.DIM_LOCATION].schema)
    store.append(fv.DIM_LOCATION, row)
    store.create_all()
    assert store.read(fv.DIM_LOCATION).count() == 1
    assert all(store.read(name).schema.names == TABLES[name].schema.names for name in TABLES)


def test_stored_upsert_rewrites_only_touched_days(store):
    def rows(*items):
        names = ["province", "date", "flood_risk"]
        return store.spark.createDataFrame(items, ", ".join(f"{n} string" for n in names))

    table = fv.SILVER["flood"]
    store.upsert(table, rows(("A", "2026-01-01", "Low"), ("B", "2026-01-02", "Low"), ("C", "odd", "High")))
    kept = f"{store.path(table)}/_date=2026-01-02"
    before = sorted(os.listdir(kept))
    days = store.upsert(table, rows(("A", "2026-01-01", "High"), ("D", "2026-01-01", "Medium"), ("C", "odd", "Low")))
    assert sorted(r._date for r in days.collect()) == ["2026-01-01", "undated"]
    assert sorted(os.listdir(kept)) == before
    got = sorted((r.province, r.date, r.flood_risk) for r in store.read(table).collect())
    assert got == [("A", "2026-01-01", "High"), ("B", "2026-01-02", "Low"), ("C", "odd", "Low"),
                   ("D", "2026-01-01", "Medium")]
    assert store.repeated_keys(table).count() == 0
    change = store.changes(table, rows(("A", "2026-01-01", "High"), ("E", "2026-01-02", "Low")))
    assert sorted((r.province, r._change) for r in change.collect()) == [("A", "matched"), ("E", "inserted")]


def test_days_prune_the_partitions(store):
    table = fv.SILVER["flood"]
    store.upsert(table, store.spark.createDataFrame(
        [("A", f"2026-01-0{n}", "Low") for n in range(1, 8)], "province string, date string, flood_risk string"))
    rows = store.read(table, store.day("2026-01-03"))
    assert [r.date for r in rows.collect()] == ["2026-01-03"]
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def loaded(store):
    add(store, "air_quality", air("Bangkok", 3, "120.5", RUN), air("Bangkok", 9, "17", RUN),
        air("Pattaya", 4, "160", RUN), air("Phuket", 4, "-1", RUN), air("Nowhere", 5, "200", RUN))
    add(store, "weather", weather("Bangkok", 9, "41", RUN), weather("Chon Buri", 2, "41", RUN))
    add(store, "flood", flood("Bangkok", "High", RUN), flood("Phuket", "Very High", RUN), flood("KhonKaen", "Low", RUN))
    return store


def test_hourly_then_daily_flow(loaded):
    overall = flows.hourly_flow(loaded, RUN).collect()
    assert [(r.province, r.risk_score, r.risk_level, r.color, r.pm25, r.temperature, r.flood_risk) for r in overall] == [
        ("Chon Buri", 66.0, "High", "#f57c00", "160.0 µg/m³", "41.0 °C", "N/A")]
    alarm = flows.daily_flow(loaded, RUN).collect()
    assert [(r.province, r.flood_risk, r.color) for r in alarm] == [
        ("Phuket", "Very High", "#d32f2f"), ("Bangkok", "High", "#f57c00")]
    facts = {r.province: r for r in loaded.read(fv.FACT).collect()}
    assert sorted(facts) == ["Bangkok", "Chon Buri", "KhonKaen", "Nowhere", "Phuket"]
    assert (facts["Bangkok"].pm25, facts["Bangkok"].hour_bucket[11:13], facts["Bangkok"].risk_score) == (17.0, "09", 45.0)
    assert facts["Nowhere"].lat is None and facts["Phuket"].pm25 is None
    marks = {(r.flow, r.source): r.high_water for r in loaded.read("watermarks").collect()}
    assert marks == {("air_quality_weather", "air_quality"): RUN, ("air_quality_weather", "weather"): RUN,
                     ("flood", "flood"): RUN}
    rejects = loaded.read("silver_rejects").collect()
    assert [(r.source, r.errors) for r in rejects] == [("air_quality", ["range:pm25"])]


def test_running_again_changes_nothing(loaded):
    flows.run_flow(loaded, RUN, fv.SOURCES)
    names = [*fv.SILVER.values(), fv.FACT, fv.DIM_LOCATION, fv.DIM_TIME]
    before = {name: state(loaded, name) for name in names}
    flows.run_flow(loaded, LATER, fv.SOURCES)  # nothing new
    flows.run_flow(loaded, LATER, ["flood", "weather", "air_quality"])  # the same set of sources
    flows.run_flow(loaded, LATER, ["air_quality"])  # a set of its own reads everything again
    assert {name: state(loaded, name) for name in names} == before
    assert all(loaded.repeated_keys(name).count() == 0 for name in names)


def test_late_rows_reach_the_fact_table(loaded):
    flows.run_flow(loaded, RUN, fv.SOURCES)
    add(loaded, "air_quality", air("Bangkok", 11, "99", LATER), air("Bangkok", 9, "18", LATER),
        air("KhonKaen", 1, "5", LATER, "2026-04-25"))
    flows.run_flow(loaded, LATER, fv.SOURCES)
    facts = {(r.province, r.date): r for r in loaded.read(fv.FACT).collect()}
    assert facts["Bangkok", "2026-04-21"].pm25 == 99.0
    assert facts["Bangkok", "2026-04-21"].temperature == 41.0
    assert facts["KhonKaen", "2026-04-25"].pm25_score == 10
    assert facts["Chon Buri", "2026-04-21"]._processed_at == LATER  # its day was joined again
    assert {r.date for r in loaded.read(fv.DIM_TIME).collect()} == {"2026-04-21", "2026-04-25"}


def test_a_run_that_broke_off_is_run_again(loaded, monkeypatch):
    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(flows, "silver_to_gold", fail)
        with pytest.raises(RuntimeError):
            flows.run_flow(loaded, RUN, fv.SOURCES)
    assert loaded.read("watermarks").count() == 0
    flows.run_flow(loaded, LATER, fv.SOURCES)
    assert loaded.read(fv.FACT).count() == 5
    assert loaded.read(fv.SILVER["air_quality"]).count() == 4


def test_as_of_joins_one_day_only(loaded):
    add(loaded, "air_quality", air("Bangkok", 1, "5", RUN, "2026-04-22"))
    flows.run_flow(loaded, RUN, fv.SOURCES, as_of="2026-04-22")
    assert {(r.province, r.date) for r in loaded.read(fv.FACT).collect()} == {("Bangkok", "2026-04-22")}
    assert loaded.read(fv.SILVER["air_quality"]).count() == 5


def test_reseed(store):
    path = f"{store.root}/export.json"
    lines = [
        '{"_id":{"$oid":"1"},"date":"2026-04-22","province":"Phuket","humidity":70,"pm25":17,"temperature":31.12,'
        '"flood_risk":"Low","weather_condition":"Clouds","hour_bucket":"2026-04-22T10:00:00+00:00"}',
        "",
        '{"_id":{"$oid":"2"},"date":"","province":"Phuket","pm25":1}',
        '{"_id":{"$oid":"3"},"date":"2026-04-23","pm25":1}',
    ]
    store.spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    export = files.read_export(store.spark, path).drop("weather_description", "_seeded_from")
    assert export.count() == 3
    old = store.spark.createDataFrame([("Phuket", "2026-04-22", "as it was")],
                                      "province string, date string, weather_description string")
    store.upsert(fv.SILVER["joined"], old)
    for _ in range(2):
        flows.reseed(store, export, RUN)
    silver = store.read(fv.SILVER["joined"]).collect()
    assert [(r.humidity, r._seeded_from, r._layer, r.weather_description) for r in silver] == [
        (70.0, "json_export", "silver", "as it was")]
    fact = store.read(fv.FACT).collect()
    assert [(r.risk_score, r.heat_index, r._seeded_from, r._layer) for r in fact] == [
        (23.0, 37.9, "silver_environmental_joined", "gold")]
    assert [r.date for r in store.read(fv.DIM_TIME).orderBy("date").collect()] == ["2026-04-22", "2026-04-23"]
    assert store.read(fv.DIM_LOCATION).count() == 5
    # A later run of the pipeline keeps the mark of the seed.
    store.upsert(fv.FACT, store.read(fv.FACT).drop("_seeded_from").withColumn("pm25", F.lit(1.0)))
    assert [(r.pm25, r._seeded_from) for r in store.read(fv.FACT).collect()] == [(1.0, "silver_environmental_joined")]


def test_csv_is_appended_and_read_by_date(store):
    path = f"{store.root}/csv"
    for rows in ([("2026-04-21", " Phuket ", "Low", "1.50", "", "x")], [("2026-04-22", "A,B", None, "2", "3", "y")]):
        files.append_csv(store.spark.createDataFrame(
            rows, "date string, province string, flood_risk string, affected_area_km2 string, "
            "water_level_m string, source string"), path)
    assert sorted(map(tuple, files.read_flood_csv(store.spark, path).collect())) == [
        ("2026-04-21", " Phuket ", "Low", "1.50", "", "x"), ("2026-04-22", "A,B", "", "2", "3", "y")]
    assert files.read_flood_csv(store.spark, path, "2026-04-22").count() == 1


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    from types import SimpleNamespace

    from skybasin.session import shared_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                              sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        shared_dir(cluster)


def test_metrics_rejects_and_cleaners_of_a_flow(loaded):
    add(loaded, "air_quality", air("Bangkok", 9, "18", RUN) | {"timestamp": "not-a-time", "message_id": "odd"})
    add(loaded, "flood", flood("Trat", "Low", RUN) | {"date": "2026-13-45", "message_id": "odd"})
    metrics = {r.source: tuple(r)[1:] for r in flows.run_flow(loaded, RUN, fv.SOURCES).collect()}
    assert metrics["air_quality"][:3] == (6, 5, 1) and metrics["flood"] == (4, 4, 0, 4, 0)
    rejects = sorted((r.source, r.errors) for r in loaded.read("silver_rejects").collect())
    assert rejects == [("air_quality", ["range:pm25"]), ("air_quality", ["undated"]), ("flood", ["undated"])]

    def nothing(bronze, run_ts, strict=False):
        return cleaning.check_flood(bronze, run_ts, strict=strict).limit(0)

    again = flows.run_flow(loaded, LATER, ["flood"], checks=cleaning.CHECKS | {"flood": nothing}).collect()
    assert [tuple(r) for r in again] == [("flood", 0, 0, 0, 0, 0)]


def test_a_version_counts_when_its_pointer_is_there(store):
    versions = Versions(store.spark, store.path("things"))
    assert versions.current() == (0, None)
    first, broken = versions.folder(1), versions.folder(2)
    store.spark.range(3).write.parquet(first)
    assert versions.publish(1, first) and versions.current() == (1, first)
    # A writer that dies before the pointer moves leaves a folder that nobody reads.
    store.spark.range(9).write.parquet(broken)
    assert versions.current() == (1, first)
    # Of two writers that saw version 1 one publishes the next.
    mine, other = versions.folder(2), versions.folder(2)
    store.spark.range(4).write.parquet(mine)
    store.spark.range(5).write.parquet(other)
    assert versions.publish(2, other) and not versions.publish(2, mine)
    assert versions.current() == (2, other) and store.spark.read.parquet(other).count() == 5


def test_old_versions_go_and_readers_keep_theirs(store):
    row = lambda i: store.spark.createDataFrame([(f"P{i}", 1.0, 2.0, "Thailand", RUN)], TABLES[fv.DIM_LOCATION].schema)
    store.upsert(fv.DIM_LOCATION, row(0))
    seen = store.read(fv.DIM_LOCATION)
    store.upsert(fv.DIM_LOCATION, row(1))
    assert seen.count() == 1 and store.read(fv.DIM_LOCATION).count() == 2
    for i in range(2, 6):
        store.upsert(fv.DIM_LOCATION, row(i))
    versions = Versions(store.spark, store.path(fv.DIM_LOCATION))
    assert store.read(fv.DIM_LOCATION).count() == 6
    assert len(versions.numbers()) == KEPT
    assert sum(name.startswith("v") for name in os.listdir(store.path(fv.DIM_LOCATION))) == KEPT


def test_a_writer_that_is_overtaken_merges_again(store, monkeypatch):
    def mark(flow):
        return store.spark.createDataFrame([(flow, "air_quality", RUN)], TABLES["watermarks"].schema)

    publish, others = Versions.publish, ["hourly"]

    def slow(self, number, folder):
        # Another flow's marks are published between this one's reading and its own turn.
        if others and self.root.endswith("watermarks"):
            store.upsert("watermarks", mark(others.pop()))
        return publish(self, number, folder)

    monkeypatch.setattr(Versions, "publish", slow)
    store.upsert("watermarks", mark("daily"))
    assert sorted(r.flow for r in store.read("watermarks").collect()) == ["daily", "hourly"]


def test_flows_that_overlap_leave_both_in_the_joined_days(store, monkeypatch):
    """The daily flow runs between the hourly one's reading of the sources and the end of its refresh."""
    add(store, "air_quality", air("A", 10, "5", "2026-04-21T10:00:00"))
    add(store, "flood", flood("A", "High", "2026-04-21T10:00:00"), flood("B", "Low", "2026-04-21T10:00:00"))
    join, waiting = flows.join_sources, [True]

    def joined(*inputs, **options):
        out = join(*inputs, **options).checkpoint()
        if waiting:
            waiting.pop()
            flows.daily_flow(store, RUN)
        return out

    monkeypatch.setattr(flows, "join_sources", joined)
    flows.run_flow(store, RUN, flows.HOURLY)
    for name in (fv.SILVER["joined"], fv.FACT):
        rows = {r.province: (r.pm25, r.flood_risk) for r in store.read(name).collect()}
        assert rows == {"A": (5.0, "High"), "B": (None, "Low")}
    assert store.turn() == 2


def test_a_stream_of_silver_takes_up_what_appends_bring(store):
    from skybasin.streaming.silver import start_silver

    metrics = []

    def run():
        start_silver(
            store, store.path("_silver"), available_now=True, clock=lambda: RUN, on_batch=lambda _, rows: metrics.append(rows)
        ).awaitTermination()
        return {r.source: (r.read, r.valid, r.inserted, r.modified) for r in (metrics.pop() if metrics else [])}

    add(store, "air_quality", air("A", 10, "5", "2026-04-21T10:00:00"), air("A", 11, "no", "2026-04-21T10:00:00"))
    assert run()["air_quality"] == (2, 1, 1, 0)
    # An older stamp than the newest that was read, as of an append that was under way.
    add(store, "air_quality", air("B", 9, "7", "2026-04-21T09:00:00"))
    add(store, "weather", weather("A", 10, "30", "2026-04-21T08:00:00"))
    found = run()
    assert found["air_quality"] == (1, 1, 1, 0) and found["weather"] == (1, 1, 1, 0) and found["flood"] == (0, 0, 0, 0)
    assert run() == {}
    rows = {r.province: (r.pm25, r.temperature) for r in store.read(fv.FACT).collect()}
    assert rows == {"A": (5.0, 30.0), "B": (7.0, None)}
    assert store.read("silver_rejects").count() == 1


def test_a_stream_of_messages_is_sent_once(spark):
    from skybasin.session import working_dir
    from skybasin.sources import messages

    folder = working_dir(spark, "outbox")
    rows = spark.createDataFrame([("2026-04-21T14:00:00Z", "A", "1", "m1"), (None, "B", "2", "m2")], "timestamp string, province string, pm25 string, message_id string")
    rows.write.parquet(f"{folder}/in")
    for _ in range(2):
        sent = messages.envelope(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), "air_quality")
        messages.send_stream(sent, f"{folder}/log", f"{folder}/out", available_now=True).awaitTermination()
    found = sorted(spark.read.parquet(f"{folder}/out").collect())
    assert [(r.topic, r.key) for r in found] == [(fv.TOPICS["air_quality"], "m1"), (fv.TOPICS["air_quality"], "m2")]
    assert messages.decode(spark.read.parquet(f"{folder}/out"), "air_quality").filter("record.province = 'B'").count() == 1
