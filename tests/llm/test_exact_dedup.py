import hashlib

import pytest
from pyspark.sql import functions as F

from skybasin.llm import exact_dedup

ROWS = [(5, "a"), (3, "a"), (9, None), (7, ""), (None, "a"), (4, "b" * 300_000), (8, "b" * 300_000), (2, "c"), (2, "c"), (6, "A")]


@pytest.mark.parametrize("keep, kept", [("largest", [2, 5, 6, 8, 9]), ("smallest", [2, 3, 4, 6, 7])])
@pytest.mark.parametrize("hot", [1000, 2])
def test_one_row_of_equal_texts_stays(docs_of, monkeypatch, keep, kept, hot):
    monkeypatch.setattr(exact_dedup, "HOT_COPIES", hot)
    docs = docs_of(ROWS)
    left = exact_dedup.drop_copies(docs, keep=keep)
    assert left.columns == docs.columns and left.schema == docs.schema
    assert sorted(r.doc_id for r in left.collect()) == kept
    marked = {(r.row.doc_id, r.row.text): r for r in exact_dedup.mark_copies(docs, keep=keep).collect()}
    assert marked[(None, "a")].group_size == 3 and not marked[(None, "a")].kept
    assert marked[(9, None)].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert marked[(9, None)].keep_id == (9 if keep == "largest" else 7)
    assert marked[(2, "c")].group_size == 2


def test_a_null_id_alone_is_kept(docs_of):
    assert [r.text for r in exact_dedup.drop_copies(docs_of([(None, "x"), (None, "x")])).collect()] == ["x"]


def test_normal_form(docs_of):
    left = exact_dedup.drop_copies(docs_of(ROWS[:1] + ROWS[-1:]), normalise=F.lower)
    assert [(r.doc_id, r.text) for r in left.collect()] == [(5, "a")]


def test_empty_table(docs_of):
    assert exact_dedup.drop_copies(docs_of([])).count() == 0


def test_texts_are_shuffled_once_and_stay_native(docs_of):
    plan = exact_dedup.mark_copies(docs_of(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    assert "Python" not in plan and "Arrow" not in plan


def test_a_hot_text_is_spread_over_partitions(spark, docs_of, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_COPIES", 50)
    docs = docs_of([(i, "same" if i % 3 == 0 else f"text {i}") for i in range(900)])
    marked = exact_dedup.mark_copies(docs, keep="largest").withColumn("p", F.spark_partition_id())
    # A few hundred short rows would be read as one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = marked.select("row.doc_id", "keep_id", "group_size", "kept", "p").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [r for r in rows if r.doc_id % 3 == 0]
    assert {(r.keep_id, r.group_size) for r in hot} == {(897, 300)}
    assert [r.doc_id for r in hot if r.kept] == [897]
    assert len({r.p for r in hot}) > 1
