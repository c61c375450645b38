"""Raw environmental records read out of the ``events`` table.

Every event becomes one record of one source.  The expressions are plain SQL that
Spark and DuckDB read alike.  They also produce what the cleaners have to deal
with: blank space and aliases in names, several timestamp forms, nulls, texts that
are no numbers, values out of range, and days without one of the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUN_TS = "2024-02-01T00:00:00+00:00"
LAST_DAY = "2024-01-30"

BASE = {
    "event_id": "event_id",
    "user_id": "user_id",
    "event_type": "event_type",
    "value": "value",
    "k": "cast(regexp_extract(props, '([0-9]+)', 1) AS int)",
    "ts_s": "substring(cast(ts AS string), 1, 19)",
    "iso": "replace(substring(cast(ts AS string), 1, 19), ' ', 'T')",
    "dom": "cast(substring(cast(ts AS string), 9, 2) AS int)",
}

# Days of the month that miss a source, so that the outer join has one-sided rows.
SOURCE = """CASE event_id % 3
  WHEN 0 THEN CASE WHEN dom % 7 = 0 THEN 'flood' ELSE 'air_quality' END
  WHEN 1 THEN CASE WHEN dom % 5 = 0 THEN 'air_quality' ELSE 'weather' END
  ELSE CASE WHEN dom % 11 = 0 THEN 'weather' ELSE 'flood' END END"""

PROVINCE = """CASE
  WHEN event_id % 83 = 1 THEN NULL
  WHEN user_id % 37 = 3 THEN 'Station-' || cast(user_id AS string)
  WHEN event_type = 'click' THEN 'Bangkok'
  WHEN event_type = 'view' THEN 'ChiangMai'
  WHEN event_type = 'purchase' THEN '  Phuket '
  WHEN event_type = 'signup' THEN 'KhonKaen'
  ELSE 'Pattaya' END"""

# Many keys instead of few: one station per event type and user.
STATION = "event_type || '_' || cast(user_id AS string)"

TIMESTAMP = """CASE
  WHEN event_id % 89 = 3 THEN NULL
  WHEN event_id % 97 = 6 THEN 'not-a-time'
  WHEN event_id % 101 = 9 THEN ''
  WHEN event_id % 5 = 0 THEN iso || '+00:00'
  WHEN event_id % 5 = 1 THEN iso || 'Z'
  WHEN event_id % 5 = 2 THEN iso || '+07:00'
  WHEN event_id % 5 = 3 THEN ts_s
  ELSE iso || '.250000+00:00' END"""

_COMMON = {
    "message_id": "'m' || lpad(cast(event_id AS string), 12, '0')",
    "_ingested_at": "iso || '+00:00'",
    "_layer": "'bronze'",
}

AIR = {
    "timestamp": TIMESTAMP,
    "pm25": """CASE WHEN event_id % 51 = 0 THEN NULL WHEN event_id % 57 = 0 THEN '-' || cast(value AS string)
      WHEN event_id % 119 = 2 THEN 'n/a' ELSE cast(value AS string) END""",
    "pm10": "cast(value * 2e0 AS string)",
    "unit": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'ug/m3' END",
    "source": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'sensor' END",
    **_COMMON,
    "_source": "'air_quality'",
}
WEATHER = {
    "timestamp": TIMESTAMP,
    "temperature": """CASE WHEN event_id % 64 = 1 THEN '99' WHEN event_id % 91 = 4 THEN NULL
      WHEN event_id % 113 = 7 THEN 'warm' ELSE cast((150 + k * 3) / 10e0 AS string) END""",
    "humidity": "CASE WHEN event_id % 47 = 4 THEN NULL ELSE cast(k AS string) END",
    "weather_condition": """CASE user_id % 7 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Light Rain'
      WHEN 3 THEN 'Thunderstorm' WHEN 4 THEN 'Snow' WHEN 5 THEN 'Haze' END""",
    "weather_description": "CASE WHEN user_id % 2 = 0 THEN 'reported by ' || event_type END",
    "source": "CASE WHEN event_id % 9 = 1 THEN NULL ELSE 'station' END",
    **_COMMON,
    "_source": "'weather'",
}
FLOOD = {
    "date": """CASE WHEN event_id % 103 = 8 THEN '2024-13-45' WHEN event_id % 107 = 5 THEN NULL
      ELSE substring(ts_s, 1, 10) END""",
    "flood_risk": """CASE WHEN event_id % 79 = 2 THEN NULL WHEN user_id % 5 = 0 THEN 'Low'
      WHEN user_id % 5 = 1 THEN ' Medium ' WHEN user_id % 5 = 2 THEN 'High'
      WHEN user_id % 5 = 3 THEN 'Very High' ELSE 'Extreme' END""",
    "affected_area_km2": "CASE WHEN event_id % 41 = 5 THEN NULL ELSE cast(value AS string) END",
    "water_level_m": "cast(k / 16e0 AS string)",
    "source": "'gauge'",
    "ingested_at": "iso || '+00:00'",
    **_COMMON,
    "_source": "'flood'",
}
FIELDS = {"air_quality": AIR, "weather": WEATHER, "flood": FLOOD}


def province(wide: bool) -> str:
    return STATION if wide else PROVINCE


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*_as(BASE))


def bronze(spark: SparkSession, sf_dir: str, source: str, wide: bool = False) -> DataFrame:
    return records(base(spark, sf_dir), source, wide)


def records(rows: DataFrame, source: str, wide: bool = False) -> DataFrame:
    """The raw records of one source out of ``base`` rows."""
    mine = rows.filter(f"{SOURCE} = '{source}'")
    return mine.selectExpr(*_as({"province": province(wide), **FIELDS[source]}))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference of many places: one per event type and user."""
    return base(spark, sf_dir).groupBy("event_type", "user_id").agg(
        {"event_id": "min"}
    ).withColumnRenamed("min(event_id)", "first_id").selectExpr(*_as(STATIONS))


STATIONS = {
    "name": STATION,
    "lat": "cast(first_id % 180 - 90 AS double)",
    "lon": "cast(first_id % 360 - 180 AS double)",
    "weather_query": "event_type",
}


def sql(columns: dict[str, str]) -> str:
    return ", ".join(_as(columns))


def _as(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]
