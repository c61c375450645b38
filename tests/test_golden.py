"""The 30 rows of FIXTURES.md: measures in, scores and labels out."""

import os

import pytest
from pyspark.sql import functions as F

from skybasin.operators import gold
from skybasin.plans import bi
from skybasin.schemas import JOINED
from skybasin.sources import reference

FIXTURES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md")
RUN = "2026-05-01T00:00:00+00:00"


def golden_rows():
    rows = []
    with open(FIXTURES, encoding="utf-8") as lines:
        for line in lines:
            cells = [cell.strip() for cell in line.strip().strip("|").split("|")]
            if len(cells) == 17 and cells[0].startswith("2026-"):
                rows.append(cells)
    return rows


@pytest.fixture(scope="module")
def fact(spark):
    inputs = [
        (c[1], c[0], f"{c[0]}T10:00:00+00:00", float(c[2]), float(c[3]), float(c[4]), c[6], None, c[5],
         1.0, 2.0, RUN, "silver", None)
        for c in golden_rows()
    ]
    return gold.build_fact(spark.createDataFrame(inputs, JOINED), RUN).cache()


def test_there_are_thirty_rows():
    assert len(golden_rows()) == 30


def test_scores_and_labels(fact):
    got = {(r.date, r.province): r for r in fact.collect()}
    for cells in golden_rows():
        row = got[(cells[0], cells[1])]
        shown = [row.pm25_score, row.temp_score, row.flood_score, row.risk_score, row.risk_level,
                 row.pm25_category, row.heat_index, row.humidity_level, row.weather_pm25_impact,
                 str(row.is_rainy).lower()]
        assert [str(x) for x in shown] == cells[7:], cells[:2]


def test_coordinates(fact):
    places = {(r.province, r.lat, r.lon) for r in fact.collect()}
    assert places == {
        ("Bangkok", 13.7563, 100.5018), ("ChiangMai", 18.7883, 98.9853), ("Phuket", 7.8804, 98.3923),
        ("KhonKaen", 16.4322, 102.8236), ("Chon Buri", 12.9236, 100.8825)}


def test_dashboard(spark, fact):
    places = gold.build_dim_location(reference.provinces(spark), RUN)
    rows = bi.risk_dashboard(fact, places).collect()
    assert [(r.province, r.risk_score) for r in rows] == [
        ("ChiangMai", 48.0), ("KhonKaen", 47.0), ("Chon Buri", 37.0), ("Bangkok", 23.0), ("Phuket", 19.0)]
    assert {r.latest_date for r in rows} == {"2026-04-27"}


def test_trend_and_alerts(fact):
    trend = bi.risk_trend(fact, "ChiangMai", 3).collect()
    assert [(r.date, r.risk_score) for r in trend] == [
        ("2026-04-25", 40.0), ("2026-04-26", 49.0), ("2026-04-27", 48.0)]
    assert bi.alerts(fact).collect() == []
    on_23rd = bi.alerts(fact.filter("date <= '2026-04-23'")).collect()
    assert [(r.province, r.risk_level) for r in on_23rd] == [("ChiangMai", "High")]


def test_calendar(spark, fact):
    days = {r.date: r for r in gold.build_dim_time(fact, RUN).collect()}
    saturday = days["2026-04-25"]
    assert len(days) == 6
    assert saturday[1:9] == (2026, 2, 4, "April", 17, 25, "Saturday", True)
    assert not days["2026-04-27"].is_weekend


def test_every_calendar_day_against_python(spark):
    from datetime import date

    days = spark.sql(
        "SELECT explode(transform(sequence(date '2015-12-20', date '2027-01-10'), d -> cast(d AS string))) AS date"
    )
    for r in gold.build_dim_time(days, RUN).collect():
        d = date.fromisoformat(r.date)
        assert r[1:9] == (d.year, (d.month - 1) // 3 + 1, d.month, f"{d:%B}", d.isocalendar()[1], d.day,
                          f"{d:%A}", d.weekday() >= 5)


def test_level_is_a_function_of_the_score(fact):
    levels = fact.groupBy("risk_score").agg(F.count_distinct("risk_level").alias("n"))
    assert levels.filter("n > 1").count() == 0
