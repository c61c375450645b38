import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skybasin.llm import repeats


def _plain(rows, threshold):
    raw = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k : k + threshold] for _, b in raw for k in range(len(b) - threshold + 1))
    out = []
    for i, b in raw:
        hit = [False] * len(b)
        for k in range(len(b) - threshold + 1):
            if counts[b[k : k + threshold]] > 1:
                hit[k : k + threshold] = [True] * threshold
        spans, at = [], 0
        while at < len(b):
            end = at
            while end < len(b) and hit[end] == hit[at]:
                end += 1
            if hit[at]:
                spans.append((at, end))
            at = end
        out.append((i, len(b), sum(hit), tuple(spans), bytes(x for x, h in zip(b, hit) if not h)))
    return sorted(out, key=str)


def _found(df):
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in df.collect()),
        key=str,
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_are_those_of_all_windows(docs_of, seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    passages = [letters(n) for n in (30, 45, 60, 90, 200)]
    rows = []
    for i in range(60):
        parts = [letters(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), letters(rng.randint(0, 40))]
        rows.append((i, "".join(parts)))
    rows += [(60, "ab" * 100), (61, "ab" * 90 + "c"), (62, "z" * 39), (63, "z" * 40), (64, "q" * 41), (65, None), (66, "")]
    rows += [(67, passages[4]), (67, passages[4]), (67, passages[3]), (None, passages[3] + "x"), (None, None)]
    found = repeats.remove_repeats(docs_of(rows), threshold=40, gram=8, widths=(6, 3, 1))
    assert _found(found) == _plain(rows, 40)


def test_segments_of_long_texts(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh") for _ in range(500))
    rows = [(1, "x" * 7 + shared), (2, shared[100:400] + "yy" + shared[:90]), (3, shared[::-1])]
    assert _found(repeats.remove_repeats(docs_of(rows), threshold=40, gram=8, widths=(6, 3, 1))) == _plain(rows, 40)


def test_a_text_of_a_million_bytes(docs_of):
    rng = random.Random(6)
    body = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    rows = [(1, body + "x" * 50 + body[1000:2000]), (2, "y")]
    one = {r.doc_id: r for r in repeats.remove_repeats(docs_of(rows)).collect()}[1]
    assert [(s.start, s.end) for s in one.spans] == [(1000, 2000), (300_050, 301_050)]


def test_empty_table(docs_of):
    assert repeats.remove_repeats(docs_of([])).count() == 0


def test_cells_cover_a_range_once():
    for start, windows, anchor, width in [(3, 10, 12, 4), (0, 1, 0, 1), (5, 48, 60, 8), (7, 3, 9, 100)]:
        parts = list(repeats.cut(start, windows, anchor, width))
        covered = sorted(w for first, count, _ in parts for w in range(first, first + count))
        assert covered == list(range(start, start + windows))
        assert all(highest >= first for first, _, highest in parts)


def test_texts_of_one_id_are_told_apart_beyond_32_bits(spark, docs_of):
    texts = spark.range(300_000).selectExpr("repeat(md5(cast(id AS string)), 13) AS text")
    pairs = texts.groupBy(F.hash("text")).agg(F.sort_array(F.collect_list("text")).alias("pair"))
    first, second = pairs.filter("size(pair) > 1").agg(F.min("pair")).head()[0][:2]
    rows = [(None, first), (None, second), (7, first)]
    assert _found(repeats.remove_repeats(docs_of(rows))) == _plain(rows, repeats.THRESHOLD)
