"""Silver tables to one row per province and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin.functions.text import filled
from skybasin.functions.timestamps import bucket_day, valid_date

KEYS = ["province", "date"]


def _dated(silver: DataFrame, as_of: str | None) -> DataFrame:
    """Rows of an hourly table that have a day, or of one day."""
    dated = silver.withColumn("date", bucket_day(F.col("hour_bucket")))
    return dated.filter(F.col("date").isNotNull() if as_of is None else F.col("date") == as_of)


def join_sources(
    air: DataFrame, weather: DataFrame, flood: DataFrame, run_ts: str, as_of: str | None = None
) -> DataFrame:
    """One row per province and day that any source has, with the row of the last hour of each.

    Covers all days in one job, or a single one with ``as_of``.  The sources are laid under each
    other, each in a column of its own, and reduced by one aggregation: a task keeps one row per
    key before the only shuffle, so a key with very many hours is harmless.
    """
    day = valid_date(F.col("date")) if as_of is None else F.col("date") == as_of
    sky = ["temperature", "humidity", "weather_condition", "weather_description"]
    water = ["flood_risk", "affected_area_km2", "water_level_m"]
    # Compared field by field: the last hour first, then the message.
    rows = (
        _dated(air, as_of)
        .select(*KEYS, F.struct("hour_bucket", "message_id", "pm25").alias("air"))
        .unionByName(
            _dated(weather, as_of).select(*KEYS, F.struct("hour_bucket", "message_id", *sky).alias("sky")),
            allowMissingColumns=True,
        )
        .unionByName(
            flood.filter(day).select(*KEYS, F.struct(*water).alias("water")), allowMissingColumns=True
        )
    )
    newest = rows.groupBy(*KEYS).agg(*(F.max(name).alias(name) for name in ("air", "sky", "water")))
    return newest.select(
        *KEYS,
        F.coalesce(filled(F.col("air.hour_bucket")), "sky.hour_bucket").alias("hour_bucket"),
        "air.pm25",
        *(f"sky.{name}" for name in sky),
        *(f"water.{name}" for name in water),
        F.lit(run_ts).alias("_processed_at"),
        F.lit("silver").alias("_layer"),
    )


def source_keys(*silver: DataFrame) -> DataFrame:
    """The distinct (province, date) pairs of several frames."""
    first, *others = [df.select(*KEYS) for df in silver]
    for other in others:
        first = first.union(other)
    return first.distinct()
