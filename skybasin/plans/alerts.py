"""Alert tables: newest record per province above a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions.labels import level_color, with_unit
from skybasin.operators.latest import latest_rows


def overall_alert(fact: DataFrame, threshold: float = fv.ALERT_THRESHOLD) -> DataFrame:
    """Provinces whose newest risk score exceeds the threshold, highest first."""
    columns = ["risk_score", "risk_level", "pm25", "temperature", "flood_risk"]
    newest = latest_rows(fact.select("province", "date", *columns), ["province"], ["date"])
    score = F.coalesce("risk_score", F.lit(0.0))
    return (
        newest.filter(score > threshold)
        .select(
            "province",
            "date",
            "risk_score",
            "risk_level",
            level_color(F.col("risk_level")).alias("color"),
            with_unit(F.col("pm25"), "µg/m³").alias("pm25"),
            with_unit(F.col("temperature"), "°C").alias("temperature"),
            F.coalesce("flood_risk", F.lit(fv.NOT_AVAILABLE)).alias("flood_risk"),
        )
        .orderBy(F.desc("risk_score"), "province")
    )


def flood_alert(fact: DataFrame) -> DataFrame:
    """Provinces whose newest flood risk is High or Very High, highest score first."""
    columns = ["flood_risk", "flood_score", "affected_area_km2", "water_level_m"]
    newest = latest_rows(fact.select("province", "date", *columns), ["province"], ["date"])
    return (
        newest.filter(F.col("flood_risk").isin(*fv.ALERT_FLOOD_LEVELS))
        .select(
            "province",
            "date",
            "flood_risk",
            level_color(F.col("flood_risk")).alias("color"),
            "affected_area_km2",
            "water_level_m",
            "flood_score",
        )
        .orderBy(F.desc("flood_score"), "province")
    )
