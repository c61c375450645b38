import math
import zlib

import numpy as np
import pytest

from skybasin.llm import quality
from skybasin.llm.queries import QUERIES
from skybasin.llm.shingles import word_hashes

DIR = "/root/testdata/sf0.01"


def _kind(byte):
    char = chr(byte)
    if byte >= 128 or "a" <= char <= "z":
        return 0
    if "A" <= char <= "Z":
        return 1
    if char.isdigit():
        return 2
    if char in " \t":
        return 3
    if 10 <= byte <= 13:
        return 4
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    return 5 + signs.index(byte) if byte in signs else 38


def _plain_features(text):
    """The features one by one."""
    raw = text.encode()
    kinds = [_kind(b) for b in raw]
    triples, buckets = {}, {}
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        at = (a * 40 + b) * 40 + c
        triples[at] = triples.get(at, 0) + 1
    words = raw.lower().split()
    for word in words:
        at = quality._TRIPLES + (int(word_hashes([word])[0][0]) >> 20) % quality.WORDS
        buckets[at] = buckets.get(at, 0) + 1
    out = {at: math.sqrt(n / sum(triples.values())) for at, n in triples.items()}
    out |= {at: math.sqrt(n / len(words)) / 2 for at, n in buckets.items()}
    distinct, runs = len(set(words)), list(zip(words, words[1:], words[2:]))
    share = lambda test: sum(map(test, kinds)) / max(1, len(raw))
    figures = [
        sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words) - 1),
        1 - len(set(runs)) / len(runs) if runs else 0,
        min(2, distinct / len(words) ** 0.8) if words else 0,
        max(words.count(w) for w in set(words)) / len(words) if words else 0,
        min(2, len(raw) / (8 * len(words))) if words else 0,
        min(2, math.log1p(len(words)) / 8),
        share(lambda k: k == 1),
        share(lambda k: k == 2),
        10 * share(lambda k: k == 4),
        share(lambda k: k >= 5),
    ]
    return out | {quality.SIZE - 10 + i: 2 * x for i, x in enumerate(figures)}


TEXTS = ["", "Word", "a a a b", "THE END!! 12,5 %\n\n| x |", "é ü\x00 \x7f ~", "one two three four five one two three " * 30, " \t\n"]


def test_features_are_those_counted_one_by_one():
    for text, (places, values) in zip(TEXTS, quality.features(TEXTS), strict=True):
        wanted = {k: v for k, v in _plain_features(text).items()}
        found = dict(zip(places.tolist(), values.tolist()))
        assert found.keys() == wanted.keys()
        assert all(math.isclose(found[k], wanted[k], abs_tol=1e-12) for k in wanted)


def test_long_texts_are_counted_in_segments(monkeypatch):
    text = "Some words, and 12 more.\n" * 40
    whole = next(iter(quality.features([text])))
    monkeypatch.setattr(quality, "SEGMENT", 64)
    parts = next(iter(quality.features([text])))
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_the_prior_of_known_mixtures():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        good = rng.normal(2, 1, 4000)
        mixed = np.concatenate([rng.normal(2, 1, int(4000 * share)), rng.normal(-3, 1, 4000 - int(4000 * share))])
        assert abs(quality.estimated_prior(good, mixed) - share) < 0.04


def test_the_risk_falls_along_its_slope():
    """Steps lower the non-negative risk, here computed by its definition."""
    rng = np.random.default_rng(2)
    good = [(np.array([0, 1]), rng.normal([1, 0], 0.3)) for _ in range(80)]
    bad = [(np.array([0, 1]), rng.normal([-1, 0], 0.3)) for _ in range(40)]
    rows = quality._Rows([p for p, _ in good + bad], [v for _, v in good + bad])
    trusted = np.arange(120) < 40
    weights, constant = quality._fit(rows, trusted, 0.5)
    sums = rows.sums(weights) + constant

    def risk(z):
        as_good, as_bad = 1 / (1 + np.exp(z)), 1 / (1 + np.exp(-z))
        return 0.5 * as_good[trusted].mean() + max(0, as_bad[~trusted].mean() - 0.5 * as_bad[trusted].mean())

    assert risk(sums) < 0.1 < risk(np.zeros(120))
    assert (sums[80:] < 0).all() and (sums[:80] > 0).all()


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op12_quality"](spark, DIR).collect()


def test_scores_of_held_out_rows(spark, scored):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in scored) == sorted(r.doc_id for r in spark.read.parquet(f"{DIR}/documents.parquet").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    pairs = [(labels[r.doc_id], r.predicted) for r in scored if r.held_out and r.doc_id in labels]
    for label in (0, 1):
        of = [p for y, p in pairs if y == label]
        assert sum(p == label for p in of) >= 0.95 * len(of)


def test_scores_are_weights_times_features(spark, docs_of):
    good = [(i, f"The {i} words of a text, and some more of it.") for i in range(30)]
    rows = good + [(100 + i, "XX!! " * (i + 3)) for i in range(15)] + [(200 + i, t) for i, t in enumerate(TEXTS)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good], "doc_id bigint, quality int")
    docs = docs_of(rows)
    model = quality.train(docs, labels)
    found = {r.doc_id: r.s for r in docs.select("doc_id", quality.score("text", model).alias("s")).collect()}
    for doc_id, text in rows:
        total = sum(model.weights[at] * value for at, value in _plain_features(text).items()) + model.constant
        assert math.isclose(found[doc_id], 1 / (1 + math.exp(-total)), abs_tol=1e-9)
    assert found[100] < 0.5 < found[0]


def test_nulls_repeated_ids_and_nothing_to_learn_from(spark, docs_of):
    docs = docs_of([(1, None), (1, "a"), (None, "b"), (2, "c")])
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (2, 7)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    assert {r.s for r in docs.select(quality.score("text", model).alias("s")).collect()} == {0.5}
    empty = docs_of([])
    model = quality.train(empty, labels.limit(0))
    assert empty.select(quality.score("text", model)).collect() == []


def test_training_is_bounded(spark, docs_of):
    docs = docs_of([(i, f"text {i}") for i in range(300)])
    ids = quality._sampled(docs.select(docs.doc_id.alias("id")), 20, 1).collect()
    assert len({r.id for r in ids}) == 20
