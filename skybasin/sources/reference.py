"""Inline reference tables.

All are fixed lists of a few rows, so Spark knows their size and broadcasts them
by itself; a longer table passed in their place joins by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skybasin import fixed_values as fv


def _inline(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    def literal(value: object) -> str:
        return f"{value}D" if isinstance(value, float) else f"'{value}'"

    values = ", ".join(f"({', '.join(map(literal, row))})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def provinces(spark: SparkSession) -> DataFrame:
    return _inline(spark, "name, lat, lon, weather_query", fv.PROVINCES)


def aliases(spark: SparkSession) -> DataFrame:
    return _inline(spark, "alias, canonical", fv.PROVINCE_ALIASES)


def local_names(spark: SparkSession) -> DataFrame:
    return _inline(spark, "local_name, province", fv.THAI_NAMES)
