"""Declared schemas, keys and layout of every table.

Nothing is inferred at read time: inference would turn whole-number humidity
into bigint and cost a pass over the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from skybasin import fixed_values as fv


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(text: str) -> T.StructType:
    """``"a string, b double"`` as a StructType, without needing a session."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Messages keep every value as the text that arrived, so a number that does not
# parse reaches the cleaners (and the quarantine) instead of vanishing at decode.
# Where a message arrived; null where a source of messages does not say.
ARRIVAL = _schema("partition int, offset bigint, timestamp string")
MESSAGE = T.StructType(_schema("topic string, key string, value string").fields + ARRIVAL.fields)
RAW = {
    "air_quality": _schema(
        "timestamp string, province string, pm25 string, pm10 string, unit string, "
        "source string, message_id string"
    ),
    "weather": _schema(
        "timestamp string, province string, temperature string, humidity string, "
        "weather_condition string, weather_description string, source string, message_id string"
    ),
    "flood": _schema(
        "date string, province string, flood_risk string, affected_area_km2 string, "
        "water_level_m string, source string, ingested_at string, message_id string"
    ),
}
# Fields a message has beyond the declared ones, as a JSON object.
EXTRA = "_extra"
_STAMPS = _schema(f"{EXTRA} string, _ingested_at string, _source string, _layer string")

# Nested API answers, as DDL for from_json.
AIR_PAYLOAD = (
    "data array<struct<province: string, pm25: double, pm10: double, unit: string, "
    "datetime: struct<utc: string>>>"
)
WEATHER_PAYLOAD = (
    "main struct<temp: double, humidity: double>, "
    "weather array<struct<main: string, description: string>>"
)

FLOOD_CSV = _schema(
    "date string, province string, flood_risk string, affected_area_km2 string, "
    "water_level_m string, source string"
)

SILVER = {
    "air_quality": _schema(
        "province string, timestamp string, hour_bucket string, pm25 double, unit string, "
        "message_id string, source string, _processed_at string, _layer string"
    ),
    "weather": _schema(
        "province string, timestamp string, hour_bucket string, temperature double, "
        "humidity double, weather_condition string, weather_description string, "
        "message_id string, source string, _processed_at string, _layer string"
    ),
    "flood": _schema(
        "province string, date string, flood_risk string, affected_area_km2 double, "
        "water_level_m double, message_id string, source string, _processed_at string, "
        "_layer string"
    ),
}
JOINED = _schema(
    "province string, date string, hour_bucket string, pm25 double, temperature double, "
    "humidity double, weather_condition string, weather_description string, "
    "flood_risk string, affected_area_km2 double, water_level_m double, "
    "_processed_at string, _layer string, _seeded_from string"
)
FACT = _schema(
    "province string, date string, lat double, lon double, pm25 double, temperature double, "
    "humidity double, weather_condition string, weather_description string, "
    "flood_risk string, affected_area_km2 double, water_level_m double, pm25_score int, "
    "temp_score int, flood_score int, risk_score double, risk_level string, "
    "pm25_category string, heat_index double, humidity_level string, "
    "weather_pm25_impact string, is_rainy boolean, hour_bucket string, "
    "_processed_at string, _layer string, _seeded_from string"
)
DIM_LOCATION = _schema(
    "province string, latitude double, longitude double, country string, _updated_at string"
)
DIM_TIME = _schema(
    "date string, year int, quarter int, month int, month_name string, week_of_year int, "
    "day int, day_of_week string, is_weekend boolean, _updated_at string"
)
WATERMARKS = _schema("flow string, source string, high_water string")
QUARANTINE = _schema("source string, record string, errors array<string>, _processed_at string")


@dataclass(frozen=True)
class Table:
    """A stored table: its columns, unique key and the column that names its day.

    ``day_from`` is the column whose first ten characters give the partition.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    day_from: str | None = None


TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        *(
            Table(
                fv.BRONZE[s],
                T.StructType(RAW[s].fields + _STAMPS.fields),
                ("message_id",),
                "_ingested_at",
            )
            for s in fv.SOURCES
        ),
        Table("bronze_rejects", _schema(
            "topic string, key string, value string, partition int, offset bigint, copy int, "
            "_ingested_at string"
        ), (), "_ingested_at"),
        Table("bronze_late", _schema(
            "source string, message_id string, topic string, key string, value string, _ingested_at string"
        ), (), "_ingested_at"),
        Table(fv.SILVER["air_quality"], SILVER["air_quality"],
              ("province", "hour_bucket"), "hour_bucket"),
        Table(fv.SILVER["weather"], SILVER["weather"],
              ("province", "hour_bucket"), "hour_bucket"),
        Table(fv.SILVER["flood"], SILVER["flood"], ("province", "date"), "date"),
        Table(fv.SILVER["joined"], JOINED, ("province", "date"), "date"),
        Table("silver_rejects", QUARANTINE, (), "_processed_at"),
        Table(fv.FACT, FACT, ("province", "date"), "date"),
        Table(fv.DIM_LOCATION, DIM_LOCATION, ("province",)),
        Table(fv.DIM_TIME, DIM_TIME, ("date",)),
        Table("watermarks", WATERMARKS, ("flow", "source")),
    ]
}
