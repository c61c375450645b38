import random
import zlib

from pyspark.sql import functions as F

from skybasin.llm import toxicity

DIR = "/root/testdata/sf0.01"


def _corpus(docs_of, spark, count=600):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(count):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}o" for _ in range(60)]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["Vileword", "nastyone", "hatefulx"])
        docs.append((i, " ".join(words)))
        labels.append((i, toxic, "x"))
    return docs_of(docs), spark.createDataFrame(labels, "doc_id bigint, toxic int, text string")


def test_held_out_texts_are_told_apart(spark, docs_of):
    docs, labels = _corpus(docs_of, spark)
    model = toxicity.train(docs, labels.filter(~toxicity.held_out("doc_id")))
    rows = docs.filter(toxicity.held_out("doc_id")).select("doc_id", toxicity.score("text", model).alias("s")).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows) and len(rows) > 100
    assert all((r.s >= toxicity.THRESHOLD) == (r.doc_id % 5 == 0) for r in rows)


def test_held_out_accuracy_on_the_test_tables(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.filter(~toxicity.held_out("doc_id")))
    scored = docs.select("doc_id", toxicity.score("text", model).alias("s")).join(labels, "doc_id")
    rows = scored.filter(toxicity.held_out("doc_id")).collect()
    right = sum((r.s >= toxicity.THRESHOLD) == bool(r.toxic) for r in rows)
    assert right >= 0.95 * len(rows)
    assert not [r for r in rows if r.s >= toxicity.THRESHOLD and not r.toxic]


def test_the_bound_on_training_rows(spark, docs_of):
    docs, labels = _corpus(docs_of, spark, 200)
    few = toxicity.train(docs, labels, training_rows=50)
    assert len(few.chosen) and len(few.chosen) <= toxicity.FEATURES


def test_nulls_empty_long_and_one_label(spark, docs_of):
    docs, labels = _corpus(docs_of, spark, 120)
    odd = spark.createDataFrame([(None, 1, ""), (3, None, ""), (4, 7, ""), (5, 1, ""), (5, 0, "")], labels.schema)
    model = toxicity.train(docs, labels.unionByName(odd))
    texts = docs_of([(1, None), (1, None), (2, ""), (3, "x" * (2 * toxicity.SEGMENT) + " vileword")])
    scores = [r.s for r in texts.select(toxicity.score("text", model).alias("s")).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] == scores[2]
    same = toxicity.train(docs, labels.filter("toxic = 0"))
    assert not len(same.chosen) and texts.select(F.countDistinct(toxicity.score("text", same))).head()[0] == 1
    empty = toxicity.train(docs_of([]), labels)
    assert 0 < texts.select(toxicity.score("text", empty).alias("s")).head().s < 1
    assert docs_of([]).select(toxicity.score("text", model)).count() == 0


def test_segments_give_all_n_grams(monkeypatch):
    whole = sorted(set(x for part in toxicity.buckets("some longer text, twice") for x in part.tolist()))
    monkeypatch.setattr(toxicity, "SEGMENT", 6)
    assert sorted(set(x for part in toxicity.buckets("some longer text, twice") for x in part.tolist())) == whole


def _plain_buckets(text):
    """Hashes of all n-grams one by one, in whole numbers."""
    whole = 1 << 64
    text, found = text.lower(), set()
    for size in toxicity.SIZES:
        for at in range(len(text) - size + 1):
            x = (size + sum(ord(c) * int(f) for c, f in zip(text[at : at + size], toxicity._FACTORS))) % whole
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % whole
            x = (x ^ x >> 27) * 0x94D049BB133111EB % whole
            found.add((x ^ x >> 31) % toxicity.BUCKETS)
    return found


def test_scores_are_sums_over_ngrams_counted_one_by_one(spark, docs_of):
    rows = [(i, f"good words here {i}") for i in range(20)] + [(50 + i, f"Bad nasty words {i}") for i in range(12)]
    rows += [(90, ""), (91, None), (92, "é nasty \U0001f600 x" * 9), (93, "ab")]
    labels = spark.createDataFrame([(i, int(i >= 50)) for i, _ in rows[:32]], "doc_id bigint, toxic int")
    docs = docs_of(rows)
    model = toxicity.train(docs, labels)
    weight = dict(zip(model.chosen.tolist(), model.weights.tolist()))
    found = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score("text", model).alias("s")).collect()}
    for doc_id, text in rows:
        total = model.constant + sum(weight.get(b, 0.0) for b in _plain_buckets(text or ""))
        assert abs(found[doc_id] - 1 / (1 + 2.718281828459045 ** -total)) < 1e-9
    # The weight of a bucket has its naive Bayes ratio as a factor: the sides of a bucket decide its sign.
    texts = [(_plain_buckets(t), i >= 50) for i, t in rows[:32]]
    for bucket in list(weight)[:200]:
        p = sum(bucket in b for b, toxic in texts if toxic) + 0.5
        q = sum(bucket in b for b, toxic in texts if not toxic) + 0.5
        assert weight[bucket] * ((p / 13) - (q / 21)) >= -1e-6
