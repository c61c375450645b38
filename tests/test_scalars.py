"""Boundary values of every scalar, and rounding against Python's own."""

import hashlib
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skybasin.functions import identity, labels, rounding, scores, text, timestamps

NAN = float("nan")


def column(spark, values, kind, function):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    shown = rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
    return [row.y for row in shown]


@pytest.mark.parametrize("places", [1, 2])
def test_rounding_equals_python(spark, places):
    draw = random.Random(places)
    values = [24.15, 26.95, 0.005, 0.015, 2.675, 1e-9, 0.05, 0.25, 0.125, 1e12, 5e-324, 0.0]
    values += [n / 1000 for n in range(0, 40000, 5)]
    values += [n / 8 for n in range(-2000, 2000)]
    values += [draw.uniform(-500, 500) for _ in range(20000)]
    values += [draw.uniform(-1, 1) * 10 ** draw.randint(-8, 17) for _ in range(8000)]
    values += [12345678901234.567, -12345678901234.567, 1e13, 2.0**52 - 0.5, 2.0**52, 2.0**53 + 2]
    got = column(spark, values, "double", lambda x: rounding.half_even(x, places))
    assert [(v, g) for v, g in zip(values, got) if g != round(v, places)] == []


def test_rounding_passes_odd_values_through(spark):
    got = column(spark, [None, NAN, math.inf, -math.inf, 1e300], "double",
                 lambda x: rounding.half_even(x, 1))
    assert got[0] is None and math.isnan(got[1])
    assert got[2:] == [math.inf, -math.inf, 1e300]


def averages(spark, values, partitions):
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
    return rows.agg(rounding.steady_avg(F.col("x")).alias("a")).first().a


def test_average_does_not_depend_on_order(spark):
    draw = random.Random(5)
    values = [round(draw.uniform(-50, 500), 4) for _ in range(3000)]
    found = {averages(spark, values, n) for n in (1, 3, 7)}
    draw.shuffle(values)
    found.add(averages(spark, values, 5))
    assert len(found) == 1
    assert found.pop() == pytest.approx(math.fsum(values) / len(values), rel=1e-15)


@pytest.mark.parametrize(
    "values", [[4e-7, 4e-7], [1 / 3, 1 / 3], [0.1234564, 0.1234564], [1 / 3, 1e15 / 7], [-2e12, 5.0, 1e-9]]
)
def test_average_keeps_every_digit(spark, values):
    assert averages(spark, values, 1) == pytest.approx(math.fsum(values) / len(values), rel=1e-15)


def test_average_of_odd_values(spark):
    assert averages(spark, [None, None], 1) is None
    assert averages(spark, [1.0, None, 2.0], 1) == 1.5
    assert math.isnan(averages(spark, [1.0, NAN], 1))
    assert averages(spark, [1.0, math.inf], 1) == math.inf
    assert averages(spark, [-0.25, -1.5], 1) == -0.875


@pytest.mark.parametrize(
    "value, bucket",
    [
        ("2026-04-21T14:37:00+00:00", "2026-04-21T14:00:00+00:00"),
        ("2026-04-21T14:37:00Z", "2026-04-21T14:00:00+00:00"),
        ("2026-04-21T14:37:00+07:00", "2026-04-21T14:00:00+00:00"),
        ("2026-04-21T23:59:59.999999-11:30", "2026-04-21T23:00:00+00:00"),
        ("2026-04-21 14:37", "2026-04-21T14:00:00+00:00"),
        ("2026-04-21T14", "2026-04-21T14:00:00+00:00"),
        ("2026-04-21", "2026-04-21T00:00:00+00:00"),
        ("20260421T143700", "2026-04-21T14:00:00+00:00"),
        ("2026-03-08T02:30:00", "2026-03-08T02:00:00+00:00"),
        ("2026-02-30T10:00:00", "2026-02-30T10:00:00+00:00"),
        ("2026-04-21T24:10:00", "2026-04-21T24:00:00+00:00"),
        ("yesterday at noon", "yesterday at :00:00+00:00"),
        ("", ":00:00+00:00"),
        (None, None),
    ],
)
def test_hour_bucket(spark, value, bucket):
    assert column(spark, [value], "string", timestamps.hour_bucket) == [bucket]


def test_hour_bucket_agrees_with_python_parser(spark):
    draw = random.Random(3)
    zones = ["", "Z", "+00:00", "+07:00", "-0330", "+05"]
    values = []
    for _ in range(400):
        day = f"{draw.randint(1990, 2030)}-{draw.randint(1, 13):02d}-{draw.randint(1, 31):02d}"
        clock = f"{draw.randint(0, 24):02d}:{draw.randint(0, 60):02d}:{draw.randint(0, 59):02d}"
        values.append(day + draw.choice("T _") + clock + draw.choice(["", ".5", ".123456"]) + draw.choice(zones))

    def expected(value):
        try:
            moment = datetime.fromisoformat(value.replace("Z", "+00:00"))
            return f"{moment:%Y-%m-%dT%H}:00:00+00:00"
        except ValueError:
            return value[:13] + ":00:00+00:00"

    got = column(spark, values, "string", timestamps.hour_bucket)
    assert [(v, g, expected(v)) for v, g in zip(values, got) if g != expected(v)] == []


def test_valid_date(spark):
    values = ["2026-04-25", "2024-02-29", "2023-02-29", "2024-13-45", "2026-4-25", "26-04-25",
              "0000-01-01", "", "not-a-date", None]
    assert column(spark, values, "string", timestamps.valid_date) == [True, True] + [False] * 8


def test_pm25_score(spark):
    values = [25.0, 25.01, 50.0, 50.5, 100.0, 100.1, 150.0, 150.01, None, -1.0, NAN]
    assert column(spark, values, "double", scores.pm25_score) == [
        10, 30, 30, 60, 60, 80, 80, 100, 0, 10, 100]


def test_temperature_score(spark):
    values = [19.9, 20.0, 25.0, 25.1, 30.0, 35.0, 40.0, 40.1, None, NAN]
    assert column(spark, values, "double", scores.temperature_score) == [
        80, 20, 20, 40, 40, 60, 75, 80, 0, 75]


def test_flood_score(spark):
    values = ["Low", "Medium", "High", "Very High", "low", "", None]
    assert column(spark, values, "string", scores.flood_score) == [20, 50, 80, 100, 0, 0, 0]


def test_risk_level(spark):
    values = [0.0, 30.0, 30.01, 60.0, 60.5, 80.0, 80.01, 96.0]
    assert column(spark, values, "double", scores.risk_level) == [
        "Low", "Low", "Moderate", "Moderate", "High", "High", "Critical", "Critical"]


def test_risk_score_of_every_combination(spark):
    combinations = [(p, t, f) for p in (0, 10, 30, 60, 80, 100) for t in (0, 20, 40, 60, 75, 80)
                    for f in (0, 20, 50, 80, 100)]
    rows = spark.createDataFrame(combinations, "p int, t int, f int")
    shown = rows.select("p", "t", "f", scores.risk_score(F.col("p"), F.col("t"), F.col("f")).alias("s"))
    for row in shown.collect():
        assert row.s == round(row.p * 0.5 + row.t * 0.2 + row.f * 0.3, 2)


@pytest.mark.parametrize(
    "temperature, humidity, felt",
    [(None, 50.0, None), (30.0, None, None), (20.0, None, None), (None, None, None), (26.95, 75.0, 26.9),
     (24.15, 79.0, 24.1), (30.0, 39.0, 30.0), (31.12, 70.0, 37.9), (27.0, 71.0, 28.9)],
)
def test_heat_index(spark, temperature, humidity, felt):
    row = spark.createDataFrame([(temperature, humidity)], "t double, h double")
    assert row.select(labels.heat_index(F.col("t"), F.col("h")).alias("y")).first().y == felt


def test_labels(spark):
    assert column(spark, [25.0, 37.0, 50.0, 90.0, 90.1, None, NAN], "double", labels.pm25_category) == [
        "Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Unknown",
        "Very Unhealthy"]
    assert column(spark, [39.9, 40.0, 70.0, 70.1, None], "double", labels.humidity_level) == [
        "Low", "Normal", "Normal", "High", "Unknown"]
    conditions = ["Light Rain", "Thunderstorm", "Clear", "Haze", "Snow", "", None, "Clear with rain", "HOT"]
    assert column(spark, conditions, "string", labels.weather_impact) == [
        "Lower", "Lower", "Higher", "Moderate", "Neutral", "Unknown", "Unknown", "Lower", "Higher"]
    assert column(spark, ["Drizzle", "Clear", "", None], "string", labels.is_rainy) == [
        True, False, False, False]
    assert column(spark, ["Critical", "Medium", "?", None], "string", labels.level_color) == [
        "#d32f2f", "#fbc02d", "#000", "#000"]
    assert column(spark, [12.25, 12.35, None], "double", lambda x: labels.with_unit(x, "°C")) == [
        "12.2 °C", "12.3 °C", "N/A"]


def test_strip_cuts_every_kind_of_blank(spark):
    blanks = [c for c in map(chr, range(0x110000)) if c.isspace() and not 0xD800 <= ord(c) < 0xE000]
    values = [f"{c}Chon Buri{c}" for c in blanks] + ["", None, " \t "]
    assert column(spark, values, "string", text.strip) == ["Chon Buri"] * len(blanks) + ["", "", ""]


def test_to_double(spark):
    values = ["17", " 16.9 ", "1e-05", "-0.5", "12d", "12f ", "1.D", "-inf", "abc", "", None]
    assert column(spark, values, "string", text.to_double) == [
        17.0, 16.9, 1e-05, -0.5, None, None, None, -math.inf, None, None, None]


def test_number_text_is_pythons(spark):
    draw = random.Random(9)
    numbers = [17, 0, -3, 17.0, 16.9, 1e-05, 0.0001, 0.00012, 0.001, 1e7, 12345678.9, 1e15, 1e16, 1.5e16,
               123456789012345680.0, -2.5e-07, 0.1, 100.0]
    numbers += [draw.uniform(0, 1) * 10 ** draw.randint(-9, 20) for _ in range(300)]
    got = column(spark, [repr(n) for n in numbers], "string", text.number_text)
    # Java 17 may print one digit too many; the number has to be the same.
    wrong = [(n, g) for n, g in zip(numbers, got) if g != repr(n) and float(g) != n]
    assert wrong == []
    assert got[:18] == [repr(n) for n in numbers[:18]]


def test_message_id(spark):
    row = spark.createDataFrame(
        [("2026-04-21T14:00:00", "Bangkok", "17"), ("2026-04-21T14:00:00", None, "1.0E-5")],
        "timestamp string, province string, pm25 string",
    )
    got = [r.id for r in row.select(identity.air_message_id().alias("id")).collect()]
    want = ["2026-04-21T14:00:00|Bangkok|17", "2026-04-21T14:00:00|None|1e-05"]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in want]
