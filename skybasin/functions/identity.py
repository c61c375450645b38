"""Content-derived message ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skybasin.functions.text import number_text


def message_id(when: Column, province: Column, reading: Column) -> Column:
    """MD5 of ``when|province|reading``; a null part is written ``None``."""
    parts = [F.coalesce(part, F.lit("None")) for part in (when, province, reading)]
    return F.md5(F.concat_ws("|", *parts))


def air_message_id() -> Column:
    return message_id(F.col("timestamp"), F.col("province"), _number("pm25"))


def weather_message_id() -> Column:
    return message_id(F.col("timestamp"), F.col("province"), _number("temperature"))


def flood_message_id() -> Column:
    return message_id(F.col("date"), F.col("province"), F.col("flood_risk"))


def _number(name: str) -> Column:
    return number_text(F.col(name).cast("string"))


def content_id(source: Column, fields: Column) -> Column:
    """The id that the producers give a record, from the map of its fields as texts."""

    def field(name: str) -> Column:
        return F.try_element_at(fields, F.lit(name))

    return (
        F.when(source == "air_quality", message_id(field("timestamp"), field("province"), number_text(field("pm25"))))
        .when(source == "weather", message_id(field("timestamp"), field("province"), number_text(field("temperature"))))
        .when(source == "flood", message_id(field("date"), field("province"), field("flood_risk")))
    )
