import hashlib

import pytest
from pyspark.sql import functions as F
from oracle_check import connect, difference

import corpus_pipeline
from skybasin.llm import bpe, mixing, toxicity
from skybasin.llm.common import stored, tokenizer_file
from skybasin.llm.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert difference(spark, connect(DIR), QUERIES[name], ORACLES[name], DIR) is None


def test_there_is_a_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert all(callable(q) for q in QUERIES.values())


def test_pipeline_is_its_stages_one_by_one(spark):
    """Each stage again, with plain Python where it decides."""
    docs = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    columns = spark.read.parquet(f"{DIR}/documents.parquet").schema
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    model = toxicity.train(spark.createDataFrame(docs, columns), labels.filter(~toxicity.held_out("doc_id")))
    score = model.scorer()
    docs = [d for d in docs if score([d[1] or ""])[0] < toxicity.THRESHOLD]
    best = {}
    for d in docs:
        best[d[1] or ""] = min(d[0], best.get(d[1] or "", d[0]))
    docs = [d for d in docs if best[d[1] or ""] == d[0]]

    sets = {}
    for d in docs:
        words = (d[1] or "").encode().lower().split()
        n = min(5, len(words))
        sets[d[0]] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    group = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    docs = [d for d in docs if group[d[0]] == d[0]]

    mixed = mixing.take_mix(spark.createDataFrame(docs, columns)).collect()
    library = bpe.ByteBpe(tokenizer_file("byte_bpe_50k.json"))
    wanted = []
    for r in mixed:
        ids = library.encode([r.text])[0].tolist()
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted.append((r.doc_id, len(ids), digest, hashlib.sha256(r.text.encode()).hexdigest()))
    found = [tuple(r) for r in corpus_pipeline.run(spark, DIR).collect()]
    assert sorted(found) == sorted(wanted)


def test_the_last_stage_gives_the_token_ids(spark):
    texts = {1: "some words, some more", 2: "", 3: "\u00e9t\u00e9 \U0001f600"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = corpus_pipeline.encode(spark, docs, DIR).collect()
    library = bpe.ByteBpe(tokenizer_file("byte_bpe_50k.json"))
    assert {r.doc_id: r.ids for r in rows} == {i: library.encode([t])[0].tolist() for i, t in texts.items()}
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_stages():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["drop_toxic", "drop_copies", "drop_near_copies", "mix_sources", "encode"]


def _through(spark, docs):
    """The documents after each stage."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DIR), f"test-{name}".replace(" ", "-"))
        out.append(docs)
    return out


def test_pipeline_over_an_empty_table(spark, docs_of):
    empty = docs_of([])
    *before, last = _through(spark, empty)
    assert all(x.columns == empty.columns and x.isEmpty() for x in before) and last.isEmpty()


def test_pipeline_with_nulls_repeats_and_clashing_names(spark, docs_of):
    base = " ".join(f"word{i}" for i in range(40))
    rows = [(1, base), (1, base), (2, base), (None, base), (3, f"{base} more"), (None, "alone and without an id"), (4, None), (4, None), (5, "")]
    rows += [(6, "some other words entirely", None)]
    docs = docs_of(rows).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    toxic, exact, near, mixed, last = _through(spark, docs)
    assert all(x.columns == docs.columns for x in (toxic, exact, near, mixed))
    assert toxic.count() == len(rows)
    # One of the equal texts stays, null and empty ones being equal; then one of those that are near.
    assert sorted((r.doc_id or 0, r.text or "") for r in exact.collect()) == sorted(
        [(1, base), (3, f"{base} more"), (0, "alone and without an id"), (4, ""), (6, "some other words entirely")]
    )
    assert sorted(r.doc_id or 0 for r in near.collect()) == [0, 1, 4, 6]
    assert {r.doc_id for r in mixed.collect()} <= {None, 1, 6}
    assert all(r.n_tokens == len(r.ids) for r in last.collect()) and last.count() == mixed.count()
