"""Exact dedup by a content sort, in native operations only.

Spark samples splitters over the normalised text and deals the rows out by range, each range is
sorted outside memory, equal texts are then neighbours, and a window over the text compares
neighbouring rows in full.  That window needs no further shuffle.  Splitters are the first
``LEAD`` characters and a hash of the whole text, which follows them in the sort key: the sample
that the driver sorts stays small with long texts, and a beginning that many texts share is split.

A text with very many copies would be one range.  The at most ``HOT_TEXTS`` most frequent texts
with ``HOT_COPIES`` copies or more are found by a narrow pre-aggregation over digests, and
their rows get a salt behind the text in the sort key, so that splitters can fall inside such a
group.  Any text left out of that list has fewer than a thousandth of all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skybasin.llm.common import text_of

LEAD = 32
HOT_COPIES = 1_000
HOT_TEXTS = 1_000
SALTS = 256


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def mark_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Every row as ``row`` (struct), with ``keep_id, group_size, kept, text_sha256``.

    Texts are compared as they are, or as ``normalise`` makes them.

    ``keep`` names the row of equal texts that stays: that with the "smallest" or the "largest"
    id.  Null texts are empty ones and equal to each other.  Rows with a null id lose against
    all others; among rows that are alike in id and text exactly one is kept.  An empty table
    gives no rows.  Working columns stand beside ``row``, so no name of the input clashes.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    best = F.max if keep == "largest" else F.min
    # Without a normal form of its own the text travels once: it is put back into the row later.
    bare = [c for c in docs.columns if normalise or c != text_col]
    rows = docs.select(
        F.struct(*(_quoted(c) for c in bare)).alias("row"),
        _quoted(id_col).alias("id"),
        (normalise or (lambda text: text))(text_of(_quoted(text_col))).alias("content"),
        _quoted(text_col).isNull().alias("no_text"),
    ).withColumn("text_sha256", F.sha2("content", 256))
    text = F.when(~F.col("no_text"), F.col("content"))
    whole_row = F.struct(
        *(
            F.col("row").getField(c).alias(c) if c in bare else text.alias(c)
            for c in docs.columns
        )
    )

    # At most HOT_TEXTS rows reach the driver and are broadcast.
    heavy = (
        rows.groupBy("text_sha256")
        .agg(F.count("*").alias("hot_size"), best("id").alias("hot_id"))
        .filter(F.col("hot_size") >= HOT_COPIES)
        .orderBy(F.desc("hot_size"), "text_sha256")
        .limit(HOT_TEXTS)
    )
    hot = docs.sparkSession.createDataFrame(heavy.collect(), heavy.schema)
    salted = rows.join(F.broadcast(hot), "text_sha256", "left").withColumn(
        "salt",
        F.when(F.col("hot_size").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0)),
    )

    order = F.desc_nulls_last("id") if keep == "largest" else F.asc_nulls_last("id")
    key = ["lead", "spread", "salt"]
    sorted_text = salted.withColumns(
        {"lead": F.substring("content", 1, LEAD), "spread": F.xxhash64("content")}
    ).repartitionByRange(*key)
    group = Window.partitionBy(*key, "content").orderBy(order)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sorted_text.select(
        whole_row.alias("row"),
        "id",
        F.col("hot_id"),
        F.col("hot_size"),
        "text_sha256",
        F.row_number().over(group).alias("place"),
        F.first("id").over(whole).alias("first_id"),
        F.count("*").over(whole).alias("copies"),
    ).select(
        "row",
        F.when(F.col("hot_size").isNull(), F.col("first_id")).otherwise(F.col("hot_id")).alias("keep_id"),
        F.coalesce("hot_size", "copies").alias("group_size"),
        (
            (F.col("place") == 1)
            & (F.col("hot_size").isNull() | F.col("id").eqNullSafe(F.col("hot_id")))
        ).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with the columns they came with."""
    return mark_copies(docs, **options).filter("kept").select("row.*")
