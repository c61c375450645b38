"""Text and number clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skybasin import fixed_values as fv


def strip(text: Column) -> Column:
    """Cut blank space of any script from both ends; null becomes ``""``."""
    return F.trim(F.coalesce(text, F.lit("")), F.lit(fv.BLANKS))


def to_double(text: Column) -> Column:
    """Number text as double; null where it is no number.

    Java would also read ``12d`` and ``12f`` as numbers, so those are cut out.
    """
    shown = F.rtrim(text.cast("string"))
    java_suffix = F.substring(shown, -1, 1).isin("d", "D", "f", "F") & ~shown.ilike("%inf")
    return F.when(~java_suffix, text.try_cast("double"))


def number_text(text: Column) -> Column:
    """Number text in its shortest form: ``17`` and ``17.0`` stay apart,
    exponents are used from 1e16 up and below 1e-4, as ``1e-05``.

    Message ids hash this text, so it has to be the producers' form.
    """
    value = text.try_cast("double")
    size = F.abs(value)
    java = value.cast("string")
    plain = F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.regexp_replace(plain, r"\.$", ".0")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    sign = F.when(exponent < 0, "-").otherwise("+")
    scientific = F.concat(
        mantissa, F.lit("e"), sign, F.lpad(F.abs(exponent).cast("string"), 2, "0")
    )
    return (
        F.when(text.rlike(r"^-?\d+$") | value.isNull(), text)
        .when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def filled(text: Column) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(text, F.lit(""))
