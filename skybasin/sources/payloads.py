"""API answers, stored as JSON text, to flat messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions import identity
from skybasin.operators.latest import latest_rows
from skybasin.schemas import AIR_PAYLOAD, WEATHER_PAYLOAD
from skybasin.sources import reference


def canonical_names(df: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Replace local-language province names; rows with other names are dropped.

    Of a local name that ``names`` lists twice, the last province counts.
    """
    if names is None:
        known = reference.local_names(df.sparkSession)
    else:
        known = latest_rows(names.select("local_name", "province"), ["local_name"], ["province"])
    known = known.select(F.col("local_name"), F.col("province").alias("__canonical"))
    return (
        df.join(known, df["province"] == known["local_name"], "inner")
        .withColumn("province", F.col("__canonical"))
        .drop("local_name", "__canonical")
    )


def flatten_air(
    payloads: DataFrame, column: str = "payload", names: DataFrame | None = None
) -> DataFrame:
    """One row per reading of ``data[]``."""
    answer = F.from_json(F.col(column), AIR_PAYLOAD)
    readings = payloads.select(F.explode(answer["data"]).alias("r")).select(
        F.col("r.datetime.utc").alias("timestamp"),
        F.col("r.province").alias("province"),
        F.col("r.pm25").alias("pm25"),
        F.col("r.pm10").alias("pm10"),
        F.coalesce("r.unit", F.lit(fv.DEFAULT_UNIT)).alias("unit"),
        F.lit(fv.AIR_API_SOURCE).alias("source"),
    )
    return canonical_names(readings, names)


def flatten_weather(
    payloads: DataFrame,
    timestamp: str = "timestamp",
    province: str = "province",
    column: str = "payload",
) -> DataFrame:
    """One row per answer; the condition is the first of ``weather[]``, if any."""
    answer = F.from_json(F.col(column), WEATHER_PAYLOAD)
    first = F.get(F.col("a.weather"), F.lit(0))
    return payloads.withColumn("a", answer).select(
        F.col(timestamp).alias("timestamp"),
        F.col(province).alias("province"),
        F.col("a.main.temp").alias("temperature"),
        F.col("a.main.humidity").alias("humidity"),
        first["main"].alias("weather_condition"),
        first["description"].alias("weather_description"),
        F.lit(fv.WEATHER_API_SOURCE).alias("source"),
    )


MESSAGE_IDS = {
    "air_quality": identity.air_message_id,
    "weather": identity.weather_message_id,
    "flood": identity.flood_message_id,
}


def with_message_id(records: DataFrame, source: str) -> DataFrame:
    return records.withColumn("message_id", MESSAGE_IDS[source]())
