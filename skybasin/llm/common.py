"""Helpers shared by the operators: stored intermediate tables and column names."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skybasin.session import working_dir

#: One word: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str | Column) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def stored(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """Write a step's rows to the shared folder and read them back.

    This cuts the lineage with files that every executor reaches, so a lost executor
    costs the tasks it ran and no earlier step.  The folder goes when the application
    ends.  Shuffle files of the finished step are dropped at the driver's next garbage
    collection, which is asked for here, as else they stay for up to half an hour.
    """
    spark = df.sparkSession
    path = working_dir(spark, f"llm-{purpose}")
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    release(spark)
    return spark.read.schema(schema).parquet(path)


#: Seconds between two calls of the driver's garbage collection.
RELEASE_EVERY = 3.0
_released = 0.0


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files that no plan refers to any more, every few seconds."""
    global _released
    if time.monotonic() - _released < RELEASE_EVERY:
        return
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _released = time.monotonic()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the installed public tokenizers keep a file; every executor has them there."""
    import public_tokenizers

    return public_tokenizers.path(name)
