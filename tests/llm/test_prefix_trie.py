import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from skybasin.llm import prefix_trie
from skybasin.llm.queries import rebuilt_trie


def _plain(rows):
    """Nodes of the trie over conversations whose texts are really put together."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = tuple(convs.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        children = {p for p in below if len(p) == len(prefix) + 1}
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode().split()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in members if rebuilt[c] == prefix))
        out.append(
            (min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out)


def _found(spark, rows):
    full = [(*r, 1, "k", 2) for r in rows]
    df = spark.createDataFrame(full, "conv_id bigint, turn bigint, role string, text string, part int, key string, depth int")
    return sorted(tuple(r) for r in rebuilt_trie(df).collect())


def _rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["hi", "how are you", "", None, "é \t two  words", "a b"]
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(texts[: 1 + seed % 6])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 5])
def test_nodes_are_those_of_texts_put_together(spark, seed):
    rows = _rows(seed, [*range(0, 60), *range(-25, -18), 105, 106], 7)
    assert _found(spark, rows) == _plain(rows)


def test_null_turns_ties_repeated_rows_and_null_ids(spark):
    rows = [(0, None, "user", "b"), (0, None, "user", "a"), (0, 1, None, None), (0, 1, None, None), (3, 5, "user", "a"), (3, 5, "user", "a")]
    rows += [(None, 1, "user", "x"), (21, 0, "user", "z"), (22, 0, "user", "z"), (23, 0, "user", "z"), (24, 0, "user", "z")]
    assert _found(spark, rows) == _plain(rows)


def test_no_conversations_have_no_nodes(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(None, 0, "user", "x")]) == []


def test_a_conversation_over_many_tasks(spark, monkeypatch):
    """Most turns are of one conversation, which also is the base of others."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rng = random.Random(3)
    rows = [(40, i, "user", f"turn {i} {rng.random()}") for i in range(400)]
    rows += [(c, i, "user", f"other {i}") for c in (39, 41, 42, 43, 44) for i in range(5)]
    rows += [(r[0] + 60, *r[1:]) for r in rows if r[0] == 40]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _found(spark, rows) == _plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_fingerprints_of_different_turns_are_noticed(spark, monkeypatch):
    """A hash that is bad at the first attempt only."""
    rows = _rows(4, range(0, 25), 5)
    good, seen = prefix_trie._nodes, []

    def nodes(turns, base_of, head_of, names, seed):
        seen.append(seed)
        if not seed:
            turns = turns.withColumn("text", prefix_trie.F.lit("same"))
        found, convs = good(turns, base_of, head_of, names, seed)
        return (found.withColumn("mixed", prefix_trie.F.lit(True)) if not seed else found), convs

    monkeypatch.setattr(prefix_trie, "_nodes", nodes)
    assert _found(spark, rows) == _plain(rows)
    assert seen == [0, 1]


def test_a_mixed_node_is_marked(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie.F, "xxhash64", lambda *_: prefix_trie.F.lit(7).cast("bigint"))
    df = spark.createDataFrame([(20, 0, "user", "a"), (40, 0, "user", "b")], "conv_id bigint, turn bigint, role string, text string")
    nodes, _ = prefix_trie._nodes(df, prefix_trie.F.expr("conv_id - conv_id % 20"), prefix_trie.F.lit(0), ["conv_id", "turn", "role", "text"], 0)
    assert [r.mixed for r in nodes.collect()] == [True]


def test_maps_compose():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    m, s = prefix_trie._map_of(hashes)
    starts = np.repeat([0, 15, 16], [15, 1, 24])
    got_m, got_s = prefix_trie._along(hashes, starts)
    a, b = 1, 0
    for i in range(40):
        if i in (0, 15, 16):
            a, b = 1, 0
        a, b = a * int(m[i]) % 2**64, (int(m[i]) * b + int(s[i])) % 2**64
        assert (int(got_m[i]), int(got_s[i])) == (a, b)


def test_word_counts():
    texts = ["a b", "", " x", "y ", "one\n\ttwo", "a b", "é"]
    assert prefix_trie.word_counts(pa.array(texts)).tolist() == [2, 0, 1, 1, 2, 1, 1]
    assert prefix_trie.word_counts(pa.array(texts).slice(2, 3)).tolist() == [1, 1, 2]
