"""Operators against brute force on small frames."""

import json
import random

import pytest
from pyspark.sql import functions as F

from skybasin.operators import cleaning, gold, quality, watermarks
from skybasin.operators.joining import join_sources, source_keys
from skybasin.operators.latest import latest_and_aggregates, latest_rows, latest_values
from skybasin.operators.upsert import change_counts, insert_absent, last_write, upsert
from skybasin.plans import bi, dashboards
from skybasin.schemas import FACT, RAW, SILVER
from skybasin.sources import files, messages, payloads

RUN = "2026-05-01T00:00:00+00:00"
STAMPS = ", _ingested_at string, _source string, _layer string"


def first_plan(df):
    """The physical plan before adaptive execution changed it."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]



def raw(spark, source, *rows):
    names = RAW[source].fieldNames() + ["_ingested_at", "_source", "_layer"]
    ddl = ", ".join(f"{n} string" for n in names)
    full = [tuple({**{"_ingested_at": RUN}, **row}.get(n) for n in names) for row in rows]
    return spark.createDataFrame(full, ddl)


def air(**more):
    return {"timestamp": "2026-04-21T14:37:00Z", "province": "Bangkok", "pm25": "1", **more}


def flood(**more):
    return {"date": "2026-04-21", "province": "Bangkok", "flood_risk": "Low", **more}


def errors(checked):
    return [row[quality.ERRORS] for row in checked.collect()]


def test_air_rules(spark):
    rows = [air(), air(pm25="0"), air(pm25="-0.1"), air(pm25=None), air(pm25="n/a"), air(pm25="NaN"),
            air(timestamp=None, pm25=None), air(province="  ")]
    checked = cleaning.check_air(raw(spark, "air_quality", *rows), RUN)
    assert errors(checked) == [[], [], ["range:pm25"], ["null:pm25"], ["null:pm25"], [],
                               ["null:timestamp", "null:pm25"], []]
    strict = cleaning.check_air(raw(spark, "air_quality", rows[-1]), RUN, strict=True)
    assert errors(strict) == [["blank:province"]]


def test_weather_rules(spark):
    base = {"timestamp": "2026-04-21T14:37:00Z", "province": "Bangkok"}
    values = ["-10", "60", "60.1", "-10.5", None, "NaN", "hot"]
    rows = [{**base, "temperature": v} for v in values]
    checked = cleaning.check_weather(raw(spark, "weather", *rows), RUN)
    assert errors(checked) == [[], [], ["range:temperature"], ["range:temperature"], ["null:temperature"],
                               ["range:temperature"], ["null:temperature"]]


def test_flood_rules(spark):
    rows = [flood(), flood(flood_risk=" Very High "), flood(flood_risk="Extreme"), flood(flood_risk=""),
            flood(flood_risk=None), flood(date=None)]
    checked = cleaning.check_flood(raw(spark, "flood", *rows), RUN)
    assert errors(checked) == [[], [], ["category:flood_risk"], [], [], ["null:date"]]
    assert [r.flood_risk for r in checked.collect()] == ["Low", "Very High", "Extreme", "", "", "Low"]


def test_cleaned_columns(spark):
    row = cleaning.check_air(raw(spark, "air_quality", air(province=" Pattaya\t", pm25="16.9")), RUN).first()
    assert (row.province, row.hour_bucket, row.pm25, row.unit, row.source, row._layer, row._processed_at) == (
        "Chon Buri", "2026-04-21T14:00:00+00:00", 16.9, "µg/m³", "unknown", "silver", RUN)


def test_counts_and_quarantine(spark):
    checked = cleaning.check_air(raw(spark, "air_quality", air(), air(pm25=None)), RUN)
    assert tuple(cleaning.cleaning_counts(checked, "air_quality").first()) == ("air_quality", 2, 1, 1)
    bad = cleaning.quarantine(checked, "air_quality", RUN).first()
    assert bad.errors == ["null:pm25"] and '"province":"Bangkok"' in bad.record
    nothing = cleaning.cleaning_counts(checked.limit(0), "air_quality").first()
    assert tuple(nothing) == ("air_quality", 0, 0, 0)


def test_since(spark):
    rows = raw(spark, "air_quality", air(_ingested_at="2026-01-01"), air(_ingested_at="2026-01-02"))
    assert cleaning.since(rows, None).count() == 2
    assert cleaning.since(rows, "2026-01-01").count() == 1


def hot_rows(n=6000):
    """A third of all rows share one key."""
    draw = random.Random(n)
    return [("hot" if draw.random() < 0.34 else f"k{draw.randint(0, 400)}",
             f"2026-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}", i, draw.random())
            for i in range(n)]


def test_latest_rows_with_a_hot_key(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, d string, i int, v double").repartition(8)
    best = {}
    for row in rows:
        if row[0] not in best or (row[1], row[2]) > (best[row[0]][1], best[row[0]][2]):
            best[row[0]] = row
    got = latest_rows(df, ["k"], ["d", "i"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(best.values())
    plan = first_plan(got)
    assert plan.count("WindowGroupLimit") == 2  # one of them before the shuffle


def test_latest_values_is_a_hash_aggregation(spark):
    rows = [("a", "2026-01-02", 2.0, 5), ("a", "2026-01-01", 1.0, 9), ("b", None, 7.0, 1), ("b", "2025-01-01", 8.0, 2),
            ("c", None, 3.0, 3)]
    df = spark.createDataFrame(rows, "k string, d string, v double, n int")
    got = latest_values(df, ["k"], "d", {"v": "v", "n": "n"}, "newest", total=F.sum("n"))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 2.0, 5, "2026-01-02", 14), ("b", 8.0, 2, "2025-01-01", 3), ("c", 3.0, 3, None, 3)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_latest_keeps_nulls_of_the_newest_row(spark):
    rows = [("a", "2026-01-01", "old"), ("a", "2026-01-02", None), ("b", None, "only")]
    df = spark.createDataFrame(rows, "k string, d string, t string")
    got = latest_and_aggregates(df, ["k"], "d", {"t": "t", "day": "d"}, n=F.count("*"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", None, "2026-01-02", 2), ("b", "only", None, 1)]


def test_last_write_wins(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    assert sorted(tuple(r) for r in last_write(df, ["k"], ["at"]).collect()) == [("a", 2, "y"), ("b", 1, "z")]


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1, "keep", 5), ("b", 2, "keep", 6), (None, 3, "keep", 7)],
                                   "k string, v int, mine string, w int")
    updates = spark.createDataFrame([("a", None, 5), ("c", 9, 8), (None, 4, 7)], "k string, v int, w int")
    got = upsert(target, updates, ["k"], with_change=True)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([
        ("a", None, "keep", 5, "modified"), ("b", 2, "keep", 6, "kept"), ("c", 9, None, 8, "inserted"),
        (None, 4, "keep", 7, "modified")], key=str)
    assert tuple(change_counts(got).first()) == (1, 2)
    again = upsert(got.drop("_change"), updates, ["k"], with_change=True)
    assert {r._change for r in again.collect()} == {"kept", "matched"}


def test_upsert_of_whole_rows_takes_one_shuffle(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    updates = spark.createDataFrame([("a", None, "n"), ("c", 9, "n"), (None, 4, "n")], "k string, v int, new string")
    got = upsert(target, updates, ["k"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [("a", None, "n"), ("b", 2, None), ("c", 9, "n"), (None, 4, "n")], key=str)
    assert first_plan(got).count("Exchange") == 1
    joined = upsert(target, updates.select("k", "v"), ["k"], with_change=True).drop("_change")
    assert sorted(map(str, joined.collect())) == sorted(map(str, got.drop("new").collect()))


def test_insert_absent(spark):
    stored = spark.createDataFrame([("a", 0), (None, 0)], "id string, n int")
    incoming = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5), ("c", 6)], "id string, n int")
    got = insert_absent(incoming, stored, "id", [F.col("n")])
    assert sorted(tuple(r) for r in got.collect()) == [("b", 3), ("c", 6)]
    into_empty = insert_absent(incoming, stored.limit(0), "id", [F.col("n")])
    assert sorted((tuple(r) for r in into_empty.collect()), key=str) == sorted(
        [("a", 1), ("b", 3), ("c", 6), (None, 5)], key=str)


def silver_rows(spark, source, *rows):
    names = SILVER[source].fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], SILVER[source])


def sources(spark):
    def hour(n):
        return f"2026-04-21T{n:02d}:00:00+00:00"

    a = silver_rows(spark, "air_quality",
                    dict(province="P1", hour_bucket=hour(3), pm25=3.0), dict(province="P1", hour_bucket=hour(9), pm25=9.0),
                    dict(province="P2", hour_bucket=hour(1), pm25=1.0), dict(province="P3", hour_bucket=hour(2), pm25=2.0),
                    dict(province="P9", hour_bucket=":00:00+00:00", pm25=2.0))
    w = silver_rows(spark, "weather",
                    dict(province="P1", hour_bucket=hour(5), temperature=25.0, weather_condition="Rain"),
                    dict(province="P2", hour_bucket=hour(4), temperature=24.0),
                    dict(province="P4", hour_bucket=hour(6), temperature=26.0))
    f = silver_rows(spark, "flood", dict(province="P1", date="2026-04-21", flood_risk="Low"),
                    dict(province="P5", date="2026-04-21", flood_risk="High"),
                    dict(province="P5", date="2026-04-22", flood_risk="Low"),
                    dict(province="P5", date="2026-13-22", flood_risk="Low"))
    return a, w, f


def test_join_of_one_two_and_three_sources(spark):
    a, w, f = sources(spark)
    got = join_sources(a, w, f, RUN)
    assert sorted((r.province, r.date, (r.hour_bucket or "")[11:13], r.pm25, r.temperature, r.flood_risk)
                  for r in got.collect()) == [
        ("P1", "2026-04-21", "09", 9.0, 25.0, "Low"), ("P2", "2026-04-21", "01", 1.0, 24.0, None),
        ("P3", "2026-04-21", "02", 2.0, None, None), ("P4", "2026-04-21", "06", None, 26.0, None),
        ("P5", "2026-04-21", "", None, None, "High"), ("P5", "2026-04-22", "", None, None, "Low")]


def test_join_as_of_one_day(spark):
    a, w, f = sources(spark)
    whole = [r for r in join_sources(a, w, f, RUN).collect() if r.date == "2026-04-21"]
    one = join_sources(a, w, f, RUN, as_of="2026-04-21").collect()
    assert sorted(map(str, one)) == sorted(map(str, whole))


def test_joined_keys_are_the_union_of_the_sources(spark):
    a, w, f = sources(spark)
    dated = [df.withColumn("date", F.substring("hour_bucket", 1, 10)).filter("date like '2026%'") for df in (a, w)]
    keys = source_keys(*dated, f.filter("date not like '%-13-%'"))
    assert sorted(map(str, keys.collect())) == sorted(
        map(str, join_sources(a, w, f, RUN).select("province", "date").collect()))


def test_schema_reports(spark):
    bronze = raw(spark, "air_quality", air(message_id="m", _layer="bronze"), air(_layer="silver"))
    assert [r.violations for r in quality.bronze_violations(bronze).collect()] == [["null:message_id", "enum:_layer"]]
    rows = [("P", "2026-01-01", 1.0, 2.0, 3.0, "Low", "gold"), ("P", None, None, None, None, "Odd", None)]
    facts = spark.createDataFrame(
        rows, "province string, date string, pm25 double, temperature double, risk_score double, "
        "risk_level string, _layer string")
    assert [r.violations for r in quality.fact_violations(facts).collect()] == [["null:date", "enum:risk_level"]]
    texts = facts.withColumn("pm25", F.col("pm25").cast("string")).limit(1)
    assert [r.violations for r in quality.fact_violations(texts).collect()] == [["type:pm25"]]


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    assert sorted((tuple(r) for r in quality.repeated_keys(df, ["k", "n"]).collect()), key=str) == [
        ("a", 1, 2), (None, 1, 2)]


def test_marks(spark):
    rows = spark.createDataFrame([("2026-01-01",), ("2026-01-03",)], "_ingested_at string")
    flow = watermarks.flow_name(["weather", "air_quality"])
    assert flow == "air_quality_weather"
    marks = watermarks.next_mark(rows, flow, "weather")
    assert watermarks.stored_mark(marks, flow, "weather") == "2026-01-03"
    assert watermarks.stored_mark(marks, flow, "air_quality") is None
    assert watermarks.next_mark(rows.limit(0), flow, "weather").count() == 0


def facts(spark, *rows):
    names = FACT.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], FACT)


def test_global_averages_of_nothing_have_no_row(spark):
    nothing = facts(spark, dict(province="P", date="2026-01-01", pm25=0.0, weather_pm25_impact="Lower"))
    assert dashboards.impact_bars(nothing).count() == 0
    assert dashboards.rainy_bars(nothing).count() == 0
    some = facts(spark, dict(pm25=3.0, weather_pm25_impact="Unknown"), dict(pm25=5.0, is_rainy=True,
                 weather_pm25_impact="Lower"))
    assert tuple(dashboards.impact_bars(some).first())[1:] == (5.0, None, None, None)
    assert tuple(dashboards.rainy_bars(some).first())[1:] == (3.0, 5.0)


def test_monthly_summary_keeps_unknown_months(spark):
    table = facts(spark, dict(province="P", date="2026-01-01", pm25=1.005, risk_score=30.0),
                  dict(province="P", date="2026-01-02", pm25=None, risk_score=31.0), dict(province="P", date="odd"))
    days = gold.build_dim_time(table, RUN)
    assert [tuple(r) for r in bi.monthly_summary(table, days).collect()] == [
        (None, None, "P", None, None, None, 1), (2026, 1, "P", round(1.005, 2), None, 30.5, 2)]
    assert bi.monthly_summary(table, days, "Q").count() == 0


def test_bars_and_trends_ignore_row_order(spark):
    draw = random.Random(1)
    rows = [dict(province=f"P{i % 7}", date=f"2026-01-{i % 28 + 1:02d}", pm25=round(draw.uniform(0.01, 400), 3),
                 humidity=round(draw.uniform(0, 100), 1), hour_bucket=f"2026-01-{i % 28 + 1:02d}T{i % 24:02d}:00:00+00:00",
                 weather_pm25_impact=draw.choice(["Lower", "Higher"]), is_rainy=draw.choice([True, False, None]))
            for i in range(2000)]
    queries = [dashboards.impact_bars, dashboards.rainy_bars, dashboards.daily_trend,
               dashboards.daily_trend_by_province, dashboards.hourly_trend, dashboards.hourly_trend_by_province]
    first = [q(facts(spark, *rows).repartition(3)).collect() for q in queries]
    draw.shuffle(rows)
    assert [q(facts(spark, *rows).repartition(7)).collect() for q in queries] == first


def test_hour_label(spark):
    row = dashboards.hourly_trend(facts(spark, dict(hour_bucket="2026-04-23T00:00:00+00:00", pm25=1.0))).first()
    assert row.Hour == "04-23T00:00"


def test_payloads(spark):
    answers = spark.createDataFrame(
        [('{"data":[{"province":"ภูเก็ต","pm25":17,"unit":null,"datetime":{"utc":"t1"}},'
          '{"province":"elsewhere","pm25":1,"datetime":{"utc":"t2"}}]}',), ('{"data":[]}',), ("{}",)], "payload string")
    got = payloads.flatten_air(answers).collect()
    assert [tuple(r) for r in got] == [("t1", "Phuket", 17.0, None, "µg/m³", "openaq_custom")]
    weather = spark.createDataFrame(
        [("t", "P", '{"main":{"temp":31.5,"humidity":70},"weather":[{"main":"Rain","description":"light rain"}]}'),
         ("t", "P", '{"main":{"temp":1,"humidity":2},"weather":[]}'), ("t", "P", '{"main":{"temp":1,"humidity":2}}')],
        "timestamp string, province string, payload string")
    assert [tuple(r)[2:6] for r in payloads.flatten_weather(weather).collect()] == [
        (31.5, 70.0, "Rain", "light rain"), (1.0, 2.0, None, None), (1.0, 2.0, None, None)]


def test_envelope_round_trip(spark):
    records = payloads.with_message_id(
        spark.createDataFrame([("2026-04-21", "Bangkok", "Low", "1.50", None)],
                              "date string, province string, flood_risk string, affected_area_km2 string, source string"),
        "flood")
    sent = messages.envelope(records, "flood")
    row = messages.decode(messages.routed(sent), "flood").first()
    assert row.topic == "flood_raw" and row.source == "flood" and row.key == row.record.message_id
    assert (row.record.affected_area_km2, row.record.source) == ("1.50", None)


def test_decode_keeps_every_field_as_it_came(spark):
    values = ['{"date":"d","flood_risk":"Low","affected_area_km2":1.5,"sensor":"s1","n":17,"deep":{"a":[1,2]}}',
              '{"date":null}', "{}", "{broken", '{"date":"d"', "[1]", "5", "null", "", None, '["date"]', '"date"']
    rows = spark.createDataFrame([("flood_raw", str(i), v) for i, v in enumerate(values)],
                                 "topic string, key string, value string")
    got = [r.record for r in messages.decode(messages.routed(rows), "flood").orderBy(F.col("key").cast("int")).collect()]
    assert (got[0].date, got[0].affected_area_km2) == ("d", "1.5")
    assert json.loads(got[0]._extra) == {"sensor": "s1", "n": "17", "deep": '{"a":[1,2]}'}
    assert [g and (g.date, g._extra) for g in got[1:3]] == [(None, None)] * 2
    assert got[3:] == [None] * 9


def test_guards(spark):
    records = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2), (None, 3)], "date string, n int")
    loaded = records.filter("n = 1")
    assert sorted(r.n for r in files.not_loaded(records, loaded).collect()) == [2, 3]
    stamped = records.withColumnRenamed("date", "timestamp")
    assert files.newer_than(stamped, None).count() == 3
    assert [r.n for r in files.newer_than(stamped, "2026-01-01").collect()] == [2]


@pytest.mark.parametrize("top_n", [1, 3])
def test_top_n(spark, top_n):
    table = facts(spark, *[dict(province=f"P{i}", date="2026-01-01", pm25=float(i), temperature=float(i),
                                flood_risk="High", flood_score=80) for i in range(5)])
    assert [r.province for r in bi.pm25_by_province(table, top_n).collect()] == [f"P{4 - i}" for i in range(top_n)]
    assert [r.province for r in bi.temperature_by_province(table, top_n).collect()] == [f"P{4 - i}" for i in range(top_n)]
    assert [r.province for r in bi.flood_risk_by_province(table, top_n).collect()] == [f"P{i}" for i in range(top_n)]


def test_reference_tables_that_list_a_key_twice(spark):
    rows = spark.createDataFrame([("P", 1)], "province string, n int")
    twice = spark.createDataFrame([("P", "Q"), ("P", "R")], "alias string, canonical string")
    assert [r.province for r in cleaning.canonical_province(rows, twice).collect()] == ["R"]
    places = spark.createDataFrame([("P", 1.0, 2.0), ("P", 3.0, 1.0)], "name string, lat double, lon double")
    assert [(r.lat, r.lon) for r in gold.with_coordinates(rows, places).collect()] == [(3.0, 1.0)]
