import random

import numpy as np
import pytest

from skybasin.llm import components, minhash
from skybasin.llm.shingles import SEGMENT, shingle_set, word_hashes


def _sets(texts):
    out = []
    for text in texts:
        raw = (text or "").encode().lower().split()
        n = min(5, len(raw))
        out.append({tuple(raw[i : i + n]) for i in range(len(raw) - n + 1)} if raw else set())
    return out


def _plain(rows, percent):
    """Components by comparing all pairs."""
    sets = _sets(t for _, t in rows)
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and both:
                x, y = sorted((root(rows[a][0]), root(rows[b][0])))
                parent[y] = x
    return {i: (len(s), root(i)) for (i, _), s in zip(rows, sets)}


def _family(rng, count, edits, words=120):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(count - 1):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(5000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_components_are_those_of_all_pairs(docs_of, percent):
    rng = random.Random(percent)
    texts = _family(rng, 60, 6) + _family(rng, 25, 3, 60) + _family(rng, 5, 1) + [f"alone {i} " * 9 for i in range(30)]
    texts += ["few words", "FEW  words\t", "few", None, "", " \n", texts[0], texts[3].upper()]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, texts[i]) for i in order]
    found = minhash.near_duplicates(docs_of(rows), percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == _plain(rows, percent)


def test_documents_that_stay_keep_their_columns(docs_of):
    docs = docs_of([(4, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (9, None), (8, ""), (8, "")])
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 2, 8, 8, 9]


def test_empty_table(docs_of):
    assert minhash.near_duplicates(docs_of([])).count() == 0
    assert minhash.drop_near_duplicates(docs_of([])).count() == 0


def test_repeated_ids_are_one_document(docs_of):
    rows = minhash.near_duplicates(docs_of([(1, "a b"), (1, "x y z u v w"), (3, "x y z u v w")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [(1, 2, 1), (3, 2, 1)]


A, B = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))


def test_rows_that_share_an_id_are_grouped_by_their_texts(docs_of):
    rows = [(1, A), (3, f"{A} x"), (3, B), (5, f"{B} x"), (3, "a clean text"), (None, f"{B} y"), (None, "alone"), (5, None)]
    found = minhash.near_duplicate_rows(docs_of(rows)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 56, 1, True), (3, 57, 1, False), (3, 56, 3, True), (5, 57, 3, False), (3, 1, 3, True)]
        + [(None, 57, 3, False), (None, 1, None, True), (5, 0, 5, True)],
        key=str,
    )
    left = minhash.drop_near_duplicates(docs_of(rows), null_ids_stay=False)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, A), (3, B), (3, "a clean text"), (None, "alone"), (5, None)], key=str
    )


def test_equal_rows_keep_one(docs_of):
    rows = [(3, A), (3, A), (3, A), (None, B), (None, B), (None, f"{B} x"), (7, f"{A} x"), (8, "")]
    found = minhash.near_duplicate_rows(docs_of(rows)).collect()
    assert len(found) == 8 and sorted((r.component_id or 0) for r in found if r.kept) == [0, 3, 8]
    left = minhash.drop_near_duplicates(docs_of(rows), null_ids_stay=False).collect()
    assert sorted((r.doc_id or 0) for r in left) == [0, 3, 8]


def test_an_id_with_several_texts_reaches_all_of_their_links(docs_of):
    found = minhash.near_duplicates(docs_of([(1, A), (3, A), (3, B), (5, B)])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [(1, 1, True), (3, 1, False), (5, 1, False)]


def test_words_of_very_long_texts():
    long = b"aB " * SEGMENT + b"x" * (2 * SEGMENT) + b"\x0b" + b"y"
    words = word_hashes([b"ab", long, b"", b"y X"])
    assert [len(w) for w in words] == [1, SEGMENT + 2, 0, 2]
    assert words[1][0] == words[0][0] and words[1][-1] == words[3][0]
    assert len(shingle_set(words[1])) == 3


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:900], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
    packed = minhash._keys_and_bits(np.stack([minhash.minima(a), minhash.minima(b)]))[1].view(np.uint64)
    differ = packed[0] ^ packed[1]
    places = np.uint64(int("01" * 32, 2))
    count = sum(bin(int((d | d >> np.uint64(1)) & places)).count("1") for d in differ)
    estimate = 1 - count / minhash.HASHES / (1 - 2.0**-minhash.BITS)
    assert abs(estimate - 900 / 1100) < 0.08


def test_bands_follow_the_threshold():
    assert minhash.bands_for(85) == (24, 4) and minhash.bands_for(80) == (34, 4)
    for percent in range(5, 101):
        bands, rows = minhash.bands_for(percent)
        assert bands * rows <= minhash.HASHES
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISS
    lowest = np.arange(2 * minhash.HASHES, dtype=np.uint32).reshape(2, -1)
    assert minhash._keys_and_bits(lowest, 80)[0].shape == (2, 34)


def test_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 160)] + [(7, 5), (5, 9), (9, 7), (3, 3), (None, 4)]
    rows = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    found = {r.id: r.component for r in rows}
    assert len(rows) == len(found)
    assert {found[i] for i in range(20, 61)} == {20} and {found[i] for i in range(100, 160)} == {100}
    assert (found[5], found[7], found[9]) == (5, 5, 5) and 3 not in found and 4 not in found
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_round_compares_no_more_pairs_than_there_are_classes(docs_of, monkeypatch):
    """A group of near copies, each other in one place, and texts of their own."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(100)]
    rows += [(500 + i, " ".join(f"t{i}-{j}" for j in range(30))) for i in range(100)]
    counts, plain = [], minhash.stored

    def counted(df, purpose, **options):
        out = plain(df, purpose, **options)
        if purpose == "spokes":
            counts.append(out.count())
        return out

    monkeypatch.setattr(minhash, "stored", counted)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicate_rows(docs_of(rows)).collect()}
    assert all(found[i] == 0 for i in range(100)) and all(found[i] == i for i in range(500, 600))
    assert 1 <= len(counts) <= minhash.ROUNDS and all(n <= 99 for n in counts)
    assert counts == sorted(counts, reverse=True)
