"""Upsert by composite key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin.operators.latest import latest_rows

CHANGE = "_change"


def last_write(updates: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]) -> DataFrame:
    """The last of several updates to one key."""
    return latest_rows(updates, keys, newest)


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], with_change: bool = False
) -> DataFrame:
    """Target rows with the updates set on them, and the new rows.

    Given columns overwrite, also with null; columns only the target has survive.
    Keys match null-safe.  ``updates`` holds at most one row per key (see
    ``last_write``).  ``with_change`` adds ``_change``: inserted, modified,
    matched (set to equal values) or kept (not touched).

    Updates that give every column replace whole rows, so the newer of two rows is
    picked after a single shuffle; otherwise the two rows are joined.
    """
    if not with_change and set(target.columns) <= set(updates.columns):
        versions = target.withColumn("__version", F.lit(0)).unionByName(
            updates.withColumn("__version", F.lit(1)), allowMissingColumns=True
        )
        return latest_rows(versions, keys, ["__version"]).drop("__version")
    old = target.select(F.struct(*target.columns).alias("old"))
    new = updates.select(F.struct(*updates.columns).alias("new"))
    same_key = None
    for key in keys:
        equal = F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}"))
        same_key = equal if same_key is None else same_key & equal
    both = old.join(new, same_key, "full_outer")

    touched = F.col("new").isNotNull()
    columns = []
    for name in [*target.columns, *(c for c in updates.columns if c not in target.columns)]:
        before = F.col(f"old.{name}") if name in target.columns else F.lit(None)
        if name in updates.columns:
            columns.append(F.when(touched, F.col(f"new.{name}")).otherwise(before).alias(name))
        else:
            columns.append(before.alias(name))
    if with_change:
        equal = F.lit(True)
        for name in updates.columns:
            before = F.col(f"old.{name}") if name in target.columns else F.lit(None)
            equal = equal & before.eqNullSafe(F.col(f"new.{name}"))
        columns.append(
            F.when(~touched, "kept")
            .when(F.col("old").isNull(), "inserted")
            .when(equal, "matched")
            .otherwise("modified")
            .alias(CHANGE)
        )
    return both.select(*columns)


def change_counts(changed: DataFrame) -> DataFrame:
    """Rows inserted and modified by an upsert."""
    return changed.agg(
        F.count_if(F.col(CHANGE) == "inserted").alias("inserted"),
        F.count_if(F.col(CHANGE) == "modified").alias("modified"),
    )


def insert_absent(incoming: DataFrame, stored: DataFrame, key: str, first: Sequence[Column]) -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key.

    A null key counts as a key like any other.  ``first`` sorts the copies inside
    ``incoming``.  The stored side is read once, key column only, and reduced to
    the keys that occur in ``incoming`` before the second join: when the incoming
    rows are few, Spark broadcasts them and the stored table is not shuffled.  Both
    joins see every incoming key once, however often it is repeated.
    """
    return absent(latest_rows(incoming, [key], first), stored, [key])


def absent(unique: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``unique`` (one per key) whose key is not stored; null keys match each other."""
    names = {key: f"__known_{key}" for key in keys}
    known = stored.select(*(F.col(key).alias(name) for key, name in names.items()))
    same = None
    for key, name in names.items():
        equal = F.col(key).eqNullSafe(F.col(name))
        same = equal if same is None else same & equal
    known = known.join(unique.select(*keys), same, "left_semi")
    return unique.join(known, same, "left_anti")
