"""High-water marks of incremental runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flow_name(sources: Iterable[str]) -> str:
    """Every set of sources keeps its own marks."""
    return "_".join(sorted(sources))


def high_water(rows: DataFrame, column: str) -> DataFrame:
    """The greatest stamp of the rows, one row (null for none)."""
    return rows.agg(F.max(column).alias("high_water"))


def next_mark(rows: DataFrame, flow: str, source: str, column: str = "_ingested_at") -> DataFrame:
    """The mark to store after a run: the newest stamp among the rows it read.

    Not the clock: rows that arrive between reading and saving stay above it.
    """
    return (
        high_water(rows, column)
        .filter(F.col("high_water").isNotNull())
        .select(F.lit(flow).alias("flow"), F.lit(source).alias("source"), "high_water")
    )


def stored_mark(marks: DataFrame, flow: str, source: str) -> str | None:
    row = marks.filter((F.col("flow") == flow) & (F.col("source") == source)).first()
    return row["high_water"] if row else None
