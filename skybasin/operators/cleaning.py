"""Raw layer to silver: standardise and check the three sources.

Each ``check_*`` returns all rows with ``_errors``; ``quality.valid`` and
``quality.rejected`` split them.  A cleaner is any function DataFrame → DataFrame
that adds ``_errors``, for use with ``DataFrame.transform``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions.text import strip, to_double
from skybasin.functions.timestamps import bucket_day, hour_bucket, valid_date
from skybasin.operators import quality
from skybasin.operators.latest import latest_rows
from skybasin.sources import reference

#: (raw rows, run stamp, strict=False) -> the rows with ``_errors``.
Cleaner = Callable[..., DataFrame]

# Carried through so that the newest of several rows for one key can be told.
INGESTED = "_ingested_at"


def canonical_province(df: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Strip the province name and replace a known alias; of one listed twice, the last name counts."""
    if aliases is None:
        names = reference.aliases(df.sparkSession)
    else:
        names = latest_rows(aliases.select("alias", "canonical"), ["alias"], ["canonical"])
    stripped = df.withColumn("province", strip(F.col("province")))
    matched = stripped.join(names, stripped["province"] == names["alias"], "left")
    return matched.withColumn("province", F.coalesce("canonical", "province")).drop(
        "alias", "canonical"
    )


def since(bronze: DataFrame, high_water: str | None) -> DataFrame:
    """Rows ingested after the mark; all of them without one."""
    return bronze if high_water is None else bronze.filter(F.col(INGESTED) > F.lit(high_water))


def check_air(
    bronze: DataFrame, run_ts: str, aliases: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    return canonical_province(bronze, aliases).select(
        "province",
        "timestamp",
        hour_bucket(F.col("timestamp")).alias("hour_bucket"),
        to_double(F.col("pm25")).alias("pm25"),
        F.coalesce("unit", F.lit(fv.DEFAULT_UNIT)).alias("unit"),
        *_lineage(run_ts),
    ).withColumn(quality.ERRORS, quality.air_errors(strict))


def check_weather(
    bronze: DataFrame, run_ts: str, aliases: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    return canonical_province(bronze, aliases).select(
        "province",
        "timestamp",
        hour_bucket(F.col("timestamp")).alias("hour_bucket"),
        to_double(F.col("temperature")).alias("temperature"),
        to_double(F.col("humidity")).alias("humidity"),
        "weather_condition",
        "weather_description",
        *_lineage(run_ts),
    ).withColumn(quality.ERRORS, quality.weather_errors(strict))


def check_flood(
    bronze: DataFrame, run_ts: str, aliases: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    return canonical_province(bronze, aliases).select(
        "province",
        "date",
        strip(F.col("flood_risk")).alias("flood_risk"),
        to_double(F.col("affected_area_km2")).alias("affected_area_km2"),
        to_double(F.col("water_level_m")).alias("water_level_m"),
        *_lineage(run_ts),
    ).withColumn(quality.ERRORS, quality.flood_errors(strict))


CHECKS: dict[str, Callable[..., DataFrame]] = {
    "air_quality": check_air,
    "weather": check_weather,
    "flood": check_flood,
}


def quarantine(checked: DataFrame, source: str, run_ts: str) -> DataFrame:
    """Rejected rows of one source as text, with the rules they break."""
    bad = quality.rejected(checked)
    fields = [name for name in bad.columns if name != quality.ERRORS]
    return bad.select(
        F.lit(source).alias("source"),
        F.to_json(F.struct(*fields)).alias("record"),
        F.col(quality.ERRORS).alias("errors"),
        F.lit(run_ts).alias("_processed_at"),
    )


def undated(checked: DataFrame, source: str, run_ts: str) -> DataFrame:
    """Valid rows without a real day, as text: they are stored, but no day's join will hold them."""
    day = bucket_day(F.col("hour_bucket")) if "hour_bucket" in checked.columns else F.col("date")
    rows = quality.valid(checked)
    rows = rows.filter(~F.coalesce(valid_date(day), F.lit(False)))
    return rows.select(
        F.lit(source).alias("source"),
        F.to_json(F.struct(*rows.columns)).alias("record"),
        F.array(F.lit("undated")).alias("errors"),
        F.lit(run_ts).alias("_processed_at"),
    )


def cleaning_counts(checked: DataFrame, source: str) -> DataFrame:
    """Rows read, valid and dropped; one row, also for no input."""
    good = F.size(quality.ERRORS) == 0
    return checked.agg(
        F.lit(source).alias("source"),
        F.count("*").alias("read"),
        F.count_if(good).alias("valid"),
        F.count_if(~good).alias("dropped"),
    )


def _lineage(run_ts: str) -> list[str | Column]:
    return [
        "message_id",
        F.coalesce("source", F.lit(fv.UNKNOWN_SOURCE)).alias("source"),
        F.lit(run_ts).alias("_processed_at"),
        F.lit("silver").alias("_layer"),
        INGESTED,
    ]
