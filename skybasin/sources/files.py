"""CSV and line-delimited JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skybasin.schemas import FLOOD_CSV, JOINED


# Spark cuts blank space around CSV values unless told not to.
_CSV = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_flood_csv(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """Flood records with a header line, of one date if given.

    All fields are text, an empty field is an empty text.
    """
    records = spark.read.options(**_CSV).schema(FLOOD_CSV).csv(path).fillna("")
    return records if date is None else records.filter(F.col("date") == date)


def append_csv(records: DataFrame, path: str) -> None:
    """Append records; every part file starts with the header."""
    records.write.mode("append").options(**_CSV).csv(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType = JOINED) -> DataFrame:
    """An export with one JSON document per line; blank lines and ``_id`` are left out."""
    return spark.read.schema(schema).json(path)


def write_export(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def not_loaded(records: DataFrame, loaded: DataFrame) -> DataFrame:
    """Records of dates that were not loaded before (once-a-day guard)."""
    dates = loaded.select(F.col("date").alias("__loaded")).distinct()
    return records.join(dates, records["date"] == dates["__loaded"], "left_anti")


def newer_than(records: DataFrame, last: str | None) -> DataFrame:
    """Records stamped after the last one sent; all of them without a mark."""
    return records if last is None else records.filter(F.col("timestamp") > F.lit(last))
