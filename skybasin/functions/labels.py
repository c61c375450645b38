"""Labels derived from the measures."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.functions.rounding import half_even
from skybasin.functions.scores import banded


def mentions(text: Column, words: tuple[str, ...]) -> Column:
    """True where the text holds one of the words, in any case."""
    lowered = F.lower(text)
    return reduce(or_, [lowered.contains(word) for word in words])


def pm25_category(pm25: Column) -> Column:
    return F.when(pm25.isNull(), fv.UNKNOWN).otherwise(
        banded(pm25, fv.PM25_CATEGORIES, fv.PM25_CATEGORY_ABOVE)
    )


def humidity_level(humidity: Column) -> Column:
    low, high = fv.HUMIDITY_BOUNDS
    return (
        F.when(humidity.isNull(), fv.UNKNOWN)
        .when(humidity < low, "Low")
        .when(humidity <= high, "Normal")
        .otherwise("High")
    )


def weather_impact(condition: Column) -> Column:
    """Expected effect of the weather on PM2.5; the first matching group wins."""
    return (
        F.when(condition.isNull() | (condition == ""), fv.UNKNOWN)
        .when(mentions(condition, fv.RAIN_WORDS), "Lower")
        .when(mentions(condition, fv.CLEAR_WORDS), "Higher")
        .when(mentions(condition, fv.CLOUD_WORDS), "Moderate")
        .otherwise("Neutral")
    )


def is_rainy(condition: Column) -> Column:
    return F.coalesce(mentions(condition, fv.RAIN_WORDS), F.lit(False))


def felt_temperature(temperature: Column, humidity: Column) -> Column:
    """Heat index before rounding; the plain temperature where it is mild or dry."""
    powers = {
        0: lambda column: None,
        1: lambda column: column,
        2: lambda column: column * column,
    }
    total = None
    for coefficient, of_temperature, of_humidity in fv.HEAT_TERMS:
        term = F.lit(coefficient)
        for factor in (powers[of_temperature](temperature), powers[of_humidity](humidity)):
            term = term if factor is None else term * factor
        total = term if total is None else total + term
    mild = (temperature < fv.HEAT_MIN_TEMPERATURE) | (humidity < fv.HEAT_MIN_HUMIDITY)
    known = temperature.isNotNull() & humidity.isNotNull()
    return F.when(known & mild, temperature).when(known, total)


def heat_index(temperature: Column, humidity: Column) -> Column:
    return half_even(felt_temperature(temperature, humidity), 1)


def level_color(level: Column) -> Column:
    chain = F.when(level.isNull(), fv.OTHER_COLOR)
    for name, color in fv.LEVEL_COLORS.items():
        chain = chain.when(level == name, color)
    return chain.otherwise(fv.OTHER_COLOR)


def with_unit(x: Column, unit: str) -> Column:
    """One decimal place and a unit, ``N/A`` for null."""
    shown = F.format_string(f"%.1f {unit}", half_even(x, 1))
    return F.when(x.isNull(), fv.NOT_AVAILABLE).otherwise(shown)
