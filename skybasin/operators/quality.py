"""Validation: every row gets the list of rules it breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions.text import filled

ERRORS = "_errors"


def _rules(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*(F.when(broken, name) for broken, name in rules)))


def _missing(*names: str) -> list[tuple[Column, str]]:
    return [(F.col(name).isNull(), f"null:{name}") for name in names]


def _blank(strict: bool, *names: str) -> list[tuple[Column, str]]:
    """Blank texts pass unless ``strict``: only nulls count as missing."""
    return [(F.col(name) == "", f"blank:{name}") for name in names] if strict else []


def air_errors(strict: bool = False) -> Column:
    return _rules(
        *_missing("timestamp", "province", "pm25"),
        *_blank(strict, "timestamp", "province"),
        (F.col("pm25") < fv.PM25_MIN, "range:pm25"),
    )


def weather_errors(strict: bool = False) -> Column:
    low, high = fv.TEMPERATURE_RANGE
    return _rules(
        *_missing("timestamp", "province", "temperature"),
        *_blank(strict, "timestamp", "province"),
        (~F.col("temperature").between(low, high), "range:temperature"),
    )


def flood_errors(strict: bool = False) -> Column:
    risk = F.col("flood_risk")
    return _rules(
        *_missing("date", "province", "flood_risk"),
        *_blank(strict, "date", "province", "flood_risk"),
        ((risk != "") & ~risk.isin(*fv.FLOOD_LEVELS), "category:flood_risk"),
    )


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(ERRORS) > 0)


def with_place_and_day(df: DataFrame) -> DataFrame:
    """Only rows that name a province and a date."""
    named = filled(F.col("province")).isNotNull() & filled(F.col("date")).isNotNull()
    return df.filter(named)


def bronze_violations(df: DataFrame) -> DataFrame:
    """Rows that break the raw-layer schema, with ``violations``; nothing is rejected."""
    return _violating(
        df,
        *_missing("message_id", "_ingested_at", "_layer"),
        (F.col("_layer") != "bronze", "enum:_layer"),
    )


def fact_violations(df: DataFrame) -> DataFrame:
    """Rows that break the fact schema, with ``violations``; nothing is rejected."""
    number_types = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    kinds = dict(df.dtypes)
    wrong_type = [
        (F.col(name).isNotNull(), f"type:{name}")
        for name in ("pm25", "temperature", "risk_score")
        if kinds[name] not in number_types
    ]
    levels = [level for _, level in fv.RISK_LEVELS] + [fv.RISK_LEVEL_ABOVE]
    return _violating(
        df,
        *_missing("province", "date", "risk_level"),
        *wrong_type,
        (~F.col("risk_level").isin(*levels), "enum:risk_level"),
        (F.col("_layer") != "gold", "enum:_layer"),
    )


def _violating(df: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    return df.withColumn("violations", _rules(*rules)).filter(F.size("violations") > 0)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; empty when ``keys`` is unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
