"""Business queries over the star schema.

Every sort ends in a unique column, so limits cut the same rows on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin.functions.rounding import half_even, steady_avg
from skybasin.operators.latest import latest_rows, latest_values

PLACE = ["province"]
NEWEST = ["date"]


def latest_facts(fact: DataFrame) -> DataFrame:
    """The newest fact row of every province; (province, date) is unique."""
    return latest_rows(fact, PLACE, NEWEST)


def _top(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(column), "province").limit(n)


def pm25_by_province(fact: DataFrame, top_n: int = 5) -> DataFrame:
    """Newest and average PM2.5 per province, most polluted first."""
    known = latest_values(
        fact.filter(F.col("pm25").isNotNull()),
        PLACE,
        "date",
        {"latest_pm25": "pm25", "pm25_score": "pm25_score"},
        "latest_date",
        avg_pm25=steady_avg(F.col("pm25")),
    )
    shown = known.select(
        "province",
        half_even(F.col("latest_pm25"), 2).alias("latest_pm25"),
        half_even(F.col("avg_pm25"), 2).alias("avg_pm25"),
        "pm25_score",
        "latest_date",
    )
    return _top(shown, "latest_pm25", top_n)


def temperature_by_province(fact: DataFrame, top_n: int = 5) -> DataFrame:
    """Newest and average temperature per province, hottest first."""
    known = latest_values(
        fact.filter(F.col("temperature").isNotNull()),
        PLACE,
        "date",
        {"latest_temp": "temperature", "temp_score": "temp_score"},
        "latest_date",
        avg_temp=steady_avg(F.col("temperature")),
    )
    shown = known.select(
        "province",
        half_even(F.col("latest_temp"), 1).alias("latest_temp"),
        half_even(F.col("avg_temp"), 1).alias("avg_temp"),
        "temp_score",
        "latest_date",
    )
    return _top(shown, "latest_temp", top_n)


def flood_risk_by_province(fact: DataFrame, top_n: int = 5) -> DataFrame:
    """Newest flood risk per province, highest score first."""
    known = latest_facts(fact.filter(F.col("flood_risk").isNotNull())).select(
        "province",
        "flood_risk",
        "flood_score",
        F.col("water_level_m").alias("water_level"),
        F.col("date").alias("latest_date"),
    )
    return _top(known, "flood_score", top_n)


def risk_dashboard(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Newest measures and scores of every province with its coordinates."""
    places = dim_location.select("province", "latitude", "longitude")
    return (
        latest_facts(fact)
        .join(latest_rows(places, PLACE, ["latitude", "longitude"]), "province", "left")
        .select(
            "province",
            F.col("date").alias("latest_date"),
            half_even(F.col("pm25"), 2).alias("pm25"),
            half_even(F.col("temperature"), 1).alias("temperature"),
            "flood_risk",
            "pm25_score",
            "temp_score",
            "flood_score",
            "risk_score",
            "risk_level",
            "latitude",
            "longitude",
        )
        .orderBy(F.desc("risk_score"), "province")
    )


def risk_trend(fact: DataFrame, province: str, days: int = 7) -> DataFrame:
    """The last ``days`` records of a province, oldest first."""
    columns = ["date", "pm25", "temperature", "flood_risk", "risk_score", "risk_level"]
    last = fact.filter(F.col("province") == province).select(*columns)
    return last.orderBy(F.desc("date")).limit(days).orderBy("date")


def alerts(fact: DataFrame) -> DataFrame:
    """Provinces whose newest level is Critical or High."""
    newest = latest_rows(
        fact.select("province", "date", "risk_level", "risk_score"), PLACE, NEWEST
    )
    return (
        newest.filter(F.col("risk_level").isin("Critical", "High"))
        .select("province", "risk_level", "risk_score", F.col("date").alias("latest_date"))
        .orderBy(F.desc("risk_score"), "province")
    )


def monthly_summary(
    fact: DataFrame, dim_time: DataFrame, province: str | None = None
) -> DataFrame:
    """Averages and record counts per month and province."""
    if province:
        fact = fact.filter(F.col("province") == province)
    months = dim_time.select("date", "year", "month")
    means = (
        fact.join(months, "date", "left")
        .groupBy("year", "month", "province")
        .agg(
            steady_avg(F.col("pm25")).alias("avg_pm25"),
            steady_avg(F.col("temperature")).alias("avg_temp"),
            steady_avg(F.col("risk_score")).alias("avg_risk_score"),
            F.count("*").alias("record_count"),
        )
    )
    return means.withColumns(
        {
            "avg_pm25": half_even(F.col("avg_pm25"), 2),
            "avg_temp": half_even(F.col("avg_temp"), 1),
            "avg_risk_score": half_even(F.col("avg_risk_score"), 2),
        }
    ).orderBy("year", "month", "province")


def current_risk(fact: DataFrame) -> DataFrame:
    """Newest risk score and level per province, highest first."""
    newest = latest_rows(
        fact.select("province", "date", "risk_score", "risk_level"), PLACE, NEWEST
    )
    return newest.drop("date").orderBy(F.desc("risk_score"), "province")


def average_pm25(fact: DataFrame) -> DataFrame:
    """Average and highest PM2.5 per province."""
    return (
        fact.groupBy("province")
        .agg(steady_avg(F.col("pm25")).alias("avg_pm25"), F.max("pm25").alias("max_pm25"))
        .orderBy(F.desc("avg_pm25"), "province")
    )


def recent_records(fact: DataFrame, province: str, n: int = 7) -> DataFrame:
    """The last ``n`` records of a province, newest first."""
    columns = ["date", "risk_score", "risk_level", "pm25"]
    return (
        fact.filter(F.col("province") == province)
        .select(*columns)
        .orderBy(F.desc("date"))
        .limit(n)
    )
