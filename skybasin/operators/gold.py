"""Star schema: fact table and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions import labels, scores
from skybasin.functions.rounding import half_even
from skybasin.functions.timestamps import valid_date
from skybasin.operators.latest import latest_rows
from skybasin.sources import reference


def with_coordinates(df: DataFrame, locations: DataFrame | None = None) -> DataFrame:
    """Add ``lat`` and ``lon`` of the province, null where it is unknown.

    Of a place that ``locations`` lists twice, the entry of the largest coordinates counts.
    """
    if locations is None:
        places = reference.provinces(df.sparkSession)
    else:
        places = latest_rows(locations.select("name", "lat", "lon"), ["name"], ["lat", "lon"])
    places = places.select(F.col("name").alias("__name"), "lat", "lon")
    return df.join(places, df["province"] == places["__name"], "left").drop("__name")


def with_scores(df: DataFrame) -> DataFrame:
    """Component scores, risk score and level.

    One select per step: Catalyst keeps a step that the next one uses more than
    once, so no expression is evaluated twice.
    """
    return (
        df.withColumns(
            {
                "pm25_score": scores.pm25_score(F.col("pm25")),
                "temp_score": scores.temperature_score(F.col("temperature")),
                "flood_score": scores.flood_score(F.col("flood_risk")),
            }
        )
        .withColumn(
            "risk_score",
            scores.risk_score(F.col("pm25_score"), F.col("temp_score"), F.col("flood_score")),
        )
        .withColumn("risk_level", scores.risk_level(F.col("risk_score")))
    )


def with_labels(df: DataFrame) -> DataFrame:
    felt = labels.felt_temperature(F.col("temperature"), F.col("humidity"))
    return df.withColumn("heat_index", felt).withColumns(
        {
            "heat_index": half_even(F.col("heat_index"), 1),
            "pm25_category": labels.pm25_category(F.col("pm25")),
            "humidity_level": labels.humidity_level(F.col("humidity")),
            "weather_pm25_impact": labels.weather_impact(F.col("weather_condition")),
            "is_rainy": labels.is_rainy(F.col("weather_condition")),
        }
    )


def build_fact(
    joined: DataFrame,
    run_ts: str,
    locations: DataFrame | None = None,
    seeded_from: str | None = None,
) -> DataFrame:
    """Fact rows for joined rows: a narrow projection plus one small lookup."""
    fact = joined.transform(with_scores).transform(with_labels)
    fact = with_coordinates(fact, locations).select(
        "province",
        "date",
        "lat",
        "lon",
        "pm25",
        "temperature",
        "humidity",
        "weather_condition",
        "weather_description",
        "flood_risk",
        "affected_area_km2",
        "water_level_m",
        "pm25_score",
        "temp_score",
        "flood_score",
        "risk_score",
        "risk_level",
        "pm25_category",
        "heat_index",
        "humidity_level",
        "weather_pm25_impact",
        "is_rainy",
        "hour_bucket",
        F.lit(run_ts).alias("_processed_at"),
        F.lit("gold").alias("_layer"),
    )
    return fact if seeded_from is None else fact.withColumn("_seeded_from", F.lit(seeded_from))


def build_dim_location(locations: DataFrame, run_ts: str) -> DataFrame:
    return locations.select(
        F.col("name").alias("province"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.lit(fv.COUNTRY).alias("country"),
        F.lit(run_ts).alias("_updated_at"),
    )


def build_dim_time(dated: DataFrame, run_ts: str) -> DataFrame:
    """Calendar parts of the distinct real dates of a frame (ISO week number)."""
    day = F.col("__day")
    days = _dates(dated).filter(_per_date(valid_date(F.col("date"))))
    return days.withColumn("__day", F.col("date").try_cast("date")).select(
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.lit(run_ts).alias("_updated_at"),
    )


def invalid_dates(dated: DataFrame) -> DataFrame:
    """Dates no calendar row can be built for, with the rows that carry them."""
    return _dates(dated).filter(_per_date(F.col("date").isNotNull() & ~valid_date(F.col("date"))))


def _dates(dated: DataFrame) -> DataFrame:
    return dated.groupBy("date").agg(F.count("*").alias("rows"))


def _per_date(test: Column) -> Column:
    """The test, tied to the row count so that Spark leaves it behind the grouping:
    it runs once per date instead of once per row."""
    return F.when(F.col("rows") > 0, test)
