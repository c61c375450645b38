"""Dashboard cards over the fact table; column names are the cards' own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions.rounding import steady_avg
from skybasin.operators.latest import latest_and_aggregates, latest_rows, latest_values

PLACE = ["province"]

MAP_METRICS = {
    "PM25_ugm3": "pm25",
    "Temp_C": "temperature",
    "Flood_Score": "flood_score",
    "Risk_Score": "risk_score",
}


def _as_province(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("province", "Province")


def metric_map(fact: DataFrame, label: str, metric: str | None = None) -> DataFrame:
    """Newest value of one number per province with its coordinates."""
    columns = {"lat": "lat", "lon": "lon", label: metric or MAP_METRICS[label]}
    newest = latest_values(fact, PLACE, "date", columns, "__date")
    return _as_province(newest.drop("__date")).orderBy("Province")


def pm25_table(fact: DataFrame) -> DataFrame:
    newest = latest_rows(
        fact.select("province", "date", "pm25", "pm25_score", "risk_level"), PLACE, ["date"]
    )
    return newest.select(
        F.col("province").alias("Province"),
        F.col("pm25").alias("PM25_ugm3"),
        F.col("pm25_score").alias("PM25_Score"),
        F.col("risk_level").alias("Risk_Level"),
        F.col("date").alias("Last_Updated"),
    ).orderBy(F.desc("PM25_ugm3"), "Province")


def weather_table(fact: DataFrame) -> DataFrame:
    """Average temperature and humidity beside the newest condition."""
    table = latest_and_aggregates(
        fact,
        PLACE,
        "date",
        {"Condition": "weather_condition", "Temp_Score": "temp_score", "Last_Updated": "date"},
        Temp_C=steady_avg(F.col("temperature")),
        Humidity_pct=steady_avg(F.col("humidity")),
    )
    return _as_province(table).orderBy(F.desc("Temp_C"), "Province")


def flood_table(fact: DataFrame) -> DataFrame:
    """Newest flood risk beside the average area and water level."""
    table = latest_and_aggregates(
        fact,
        PLACE,
        "date",
        {"Flood_Risk": "flood_risk", "Flood_Score": "flood_score", "Last_Updated": "date"},
        Affected_Area_km2=steady_avg(F.col("affected_area_km2")),
        Water_Level_m=steady_avg(F.col("water_level_m")),
    )
    return _as_province(table).orderBy(F.desc("Flood_Score"), "Province")


def risk_table(fact: DataFrame) -> DataFrame:
    columns = ["risk_score", "risk_level", "pm25_score", "temp_score", "flood_score"]
    newest = latest_rows(fact.select("province", "date", *columns), PLACE, ["date"])
    return newest.select(
        F.col("province").alias("Province"),
        F.col("risk_score").alias("Risk_Score"),
        F.col("risk_level").alias("Risk_Level"),
        F.col("pm25_score").alias("PM25_Score"),
        F.col("temp_score").alias("Temp_Score"),
        F.col("flood_score").alias("Flood_Score"),
        F.col("date").alias("Last_Updated"),
    ).orderBy(F.desc("Risk_Score"), "Province")


def impact_bars(fact: DataFrame) -> DataFrame:
    """Average PM2.5 per weather impact, one column each; no row for no input."""
    impact = F.col("weather_pm25_impact")
    pm25 = F.col("pm25")
    bars = [
        steady_avg(F.when(impact == name, pm25)).alias(name)
        for name in ("Lower", "Moderate", "Higher", "Neutral")
    ]
    known = fact.filter(impact.isNotNull() & (pm25 > 0))
    return known.groupBy(F.lit(fv.IMPACT_CAPTION).alias("Category")).agg(*bars)


def rainy_bars(fact: DataFrame) -> DataFrame:
    """Average PM2.5 without and with rain; an unknown rain flag counts as dry."""
    rainy = F.coalesce("is_rainy", F.lit(False))
    pm25 = F.col("pm25")
    return (
        fact.filter(pm25 > 0)
        .groupBy(F.lit(fv.RAINY_CAPTION).alias("Category"))
        .agg(
            steady_avg(F.when(~rainy, pm25)).alias("Non_Rainy"),
            steady_avg(F.when(rainy, pm25)).alias("Rainy"),
        )
    )


def daily_trend(fact: DataFrame) -> DataFrame:
    known = fact.filter(F.col("pm25").isNotNull() & F.col("humidity").isNotNull())
    return (
        known.groupBy(F.col("date").alias("Date"))
        .agg(
            steady_avg(F.col("pm25")).alias("PM25"),
            steady_avg(F.col("humidity")).alias("Humidity"),
        )
        .orderBy("Date")
    )


def daily_trend_by_province(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("pm25").isNotNull())
        .groupBy(F.col("date").alias("Date"), F.col("province").alias("Province"))
        .agg(steady_avg(F.col("pm25")).alias("PM25"))
        .orderBy("Date", "Province")
    )


def weather_by_flood(fact: DataFrame) -> DataFrame:
    known = fact.filter(F.col("weather_condition").isNotNull() & F.col("flood_risk").isNotNull())
    return (
        known.groupBy(
            F.col("weather_condition").alias("Weather"), F.col("flood_risk").alias("Flood_Risk")
        )
        .agg(
            steady_avg(F.col("risk_score")).alias("Avg_Risk_Score"),
            F.count("*").alias("Count"),
        )
        .orderBy("Weather", "Flood_Risk")
    )


def _hour_label(bucket: str):
    """``2026-04-23T05:00:00+00:00`` as ``04-23T05:00``."""
    return F.substring(F.col(bucket), 6, 11)


def hourly_trend(fact: DataFrame, last: int = 24) -> DataFrame:
    """The last hour buckets, oldest first."""
    return (
        fact.filter(F.col("hour_bucket").isNotNull())
        .groupBy("hour_bucket")
        .agg(
            steady_avg(F.col("pm25")).alias("PM25"),
            steady_avg(F.col("humidity")).alias("Humidity"),
        )
        .orderBy(F.desc("hour_bucket"))
        .limit(last)
        .orderBy("hour_bucket")
        .select(_hour_label("hour_bucket").alias("Hour"), "PM25", "Humidity")
    )


def hourly_trend_by_province(fact: DataFrame, last: int = 120) -> DataFrame:
    """The last (hour, province) groups, oldest first."""
    return (
        fact.filter(F.col("hour_bucket").isNotNull())
        .groupBy("hour_bucket", "province")
        .agg(steady_avg(F.col("pm25")).alias("PM25"))
        .orderBy(F.desc("hour_bucket"), "province")
        .limit(last)
        .orderBy("hour_bucket", "province")
        .select(
            _hour_label("hour_bucket").alias("Hour"), F.col("province").alias("Province"), "PM25"
        )
    )
