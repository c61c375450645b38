"""Places of rows within groups, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skybasin.llm.common import stored

#: Bits that monotonically_increasing_id() keeps for the row within its partition.
_ROW_BITS = 33


def ranked(rows: DataFrame, group: str, order: list[str], place: str) -> DataFrame:
    """``rows`` with their ``place`` (0, 1, ..) within the rows of a group, ordered by ``order`` (null first).

    One range shuffle by group and order; a place is the row's place in its partition, plus the rows
    of the group in the partitions before, of which there are few numbers.  So a group that holds
    most rows takes as many tasks as its rows need.  Rows equal in ``group`` and ``order`` have to
    be alike, as their order is not defined.  Null groups are not supported; no rows give none.
    """
    at, part = "__at", "__part"
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(sorted_rows.withColumn(at, F.monotonically_increasing_id()), "ranked").withColumn(
        part, F.shiftright(F.col(at), _ROW_BITS)
    )
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each group and partition that it reaches into.
    starts = placed.groupBy(group, part).agg(F.min(at).alias("__first"), F.count("*").alias("__rows"))
    shifts = starts.select(
        group, part, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    return placed.join(shifts, [group, part]).withColumn(place, F.col(at) + F.col("__shift")).drop(at, part, "__shift")
