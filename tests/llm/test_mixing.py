import random
import re
from collections import defaultdict

import numpy as np
import pytest

from skybasin.llm import mixing


def _highest_quotients(votes, seats, most):
    given = [0] * len(votes)
    for _ in range(seats):
        free = [i for i, v in enumerate(votes) if v > 0 and given[i] < most[i]]
        if not free:
            break
        given[max(free, key=lambda i: (votes[i] / (2 * given[i] + 1), -i))] += 1
    return given


@pytest.mark.parametrize("seed", range(4))
def test_quotas_are_those_of_the_highest_quotients(seed):
    rng = random.Random(seed)
    for _ in range(80):
        votes = [rng.choice([0, 1, 2, 3, 5, 10, 100, 1000 * rng.random()]) for _ in range(rng.randint(1, 8))]
        seats = rng.randint(0, 60)
        none = [10**9] * len(votes)
        assert mixing.sainte_lague(np.array(votes), seats).tolist() == _highest_quotients(votes, seats, none)
        most = [rng.randint(0, 12) for _ in votes]
        capped = mixing.sainte_lague(np.array(votes), seats, np.array(most))
        assert (capped <= most).all()
        assert capped.sum() == min(seats, sum(m for m, v in zip(most, votes) if v > 0))


def _reshared(sizes, weights):
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(3 * sizes[i] for i in capped)
        free = sum(w for i, w in enumerate(weights) if i not in capped)
        target = [3 * s if i in capped else left * weights[i] / free for i, s in enumerate(sizes)]
        above = {i for i, t in enumerate(target) if t > 3 * sizes[i] and i not in capped}
        if not above:
            return target
        capped |= above


def test_targets():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.choice([1, 5, 100, 1000]) for _ in range(rng.randint(1, 9))]
        weights = [1 + i % 3 for i in range(len(sizes))]
        assert np.allclose(mixing.targets(np.array(sizes), np.array(weights)), _reshared(sizes, weights))
    assert mixing.targets(np.array([0, 0]), np.array([1, 2])).tolist() == [0, 0]


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _rows(rng, count=400):
    sizes = {"big": 1200, "tiny": 4, "src1": 150, "src2": 100, None: 90}
    rows = []
    for i in range(count):
        source = rng.choice(["big"] * 5 + ["src1", "src2", None] + ["tiny"] * (i % 40 == 0))
        rows.append((i, " \n".join(f"w{i}_{k}" for k in range(rng.randint(0, sizes[source]))), source))
    return rows + [(900, None, "src1"), (901, "", "src2"), (902, "same text", "big"), (902, "same text", "big"), (None, "no id here", None)]


def test_words_taken_come_near_the_targets(docs_of):
    rows = _rows(random.Random(3))
    docs = docs_of(rows)
    found = mixing.mix(docs).collect()
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for i, text, source in rows:
        sizes[source] += len(_words(text))
    source_of = {i: s for i, _, s in rows}
    for r in found:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[source_of[r.doc_id]]
        taken[source_of[r.doc_id]] += r.taken
        targets[source_of[r.doc_id]] = r.target
    order = sorted(s for s in sizes if s) + [None]
    wanted = _reshared([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))])
    assert np.allclose([targets[s] for s in order], wanted)
    assert all(abs(taken[s] - targets[s]) <= 0.02 * targets[s] + 2 for s in order)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id or -1, r.size, r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_rows_of_the_mix_hold_the_words_taken(docs_of):
    rows = _rows(random.Random(4), 120)
    docs = docs_of(rows)
    taken = defaultdict(int)
    for r in mixing.mix(docs).collect():
        taken[r.doc_id] += r.taken
    out = mixing.take_mix(docs)
    assert out.columns == docs.columns
    got, texts = defaultdict(int), {i: t for i, t, _ in rows}
    for r in out.collect():
        got[r.doc_id] += len(_words(r.text))
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
    assert {i: n for i, n in taken.items() if n} == dict(got)


def test_shards_of_a_large_source(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 20)
    rows = [(i, "w " * (i % 50), "a" if i % 3 else "b") for i in range(500)]
    found = mixing.mix(docs_of(rows)).collect()
    assert abs(sum(r.taken for r in found) / sum(r.size for r in found) - 1) < 0.01
    assert len(found) == 500


def test_empty_tables_and_texts(docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    assert mixing.take_mix(docs_of([])).count() == 0
    assert [(r.size, r.target, r.taken) for r in mixing.mix(docs_of([(1, "", "a"), (2, None, None)])).collect()] == [(0, 0, 0)] * 2
