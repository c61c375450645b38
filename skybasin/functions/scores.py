"""Risk model: component scores, weighted score and level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions.rounding import half_even


def banded(x: Column, bands: list[tuple[float, object]], above: object) -> Column:
    """The value of the first band whose upper bound is not exceeded."""
    (bound, value), *rest = bands
    chain = F.when(x <= bound, value)
    for bound, value in rest:
        chain = chain.when(x <= bound, value)
    return chain.otherwise(above)


def pm25_score(pm25: Column) -> Column:
    return F.when(pm25.isNull(), 0).otherwise(
        banded(pm25, fv.PM25_SCORES, fv.PM25_SCORE_ABOVE)
    )


def temperature_score(temperature: Column) -> Column:
    coldest, hottest, extreme = fv.TEMPERATURE_EXTREME
    # Spark orders NaN above every number; a NaN reading is not extreme heat.
    too_hot = (temperature > hottest) & ~F.isnan(temperature)
    return (
        F.when(temperature.isNull(), 0)
        .when((temperature < coldest) | too_hot, extreme)
        .otherwise(banded(temperature, fv.TEMPERATURE_SCORES, fv.TEMPERATURE_SCORE_ABOVE))
    )


def flood_score(flood_risk: Column) -> Column:
    chain = F.when(flood_risk.isNull(), 0)
    for level, score in fv.FLOOD_SCORES.items():
        chain = chain.when(flood_risk == level, score)
    return chain.otherwise(0)


def risk_score(pm25: Column, temperature: Column, flood: Column) -> Column:
    """Weighted sum of the three component scores, to two places."""
    by_pm25, by_temperature, by_flood = fv.RISK_WEIGHTS
    return half_even(pm25 * by_pm25 + temperature * by_temperature + flood * by_flood, 2)


def risk_level(score: Column) -> Column:
    return banded(score, fv.RISK_LEVELS, fv.RISK_LEVEL_ABOVE)
