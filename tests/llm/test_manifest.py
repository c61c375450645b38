import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from skybasin.llm import manifest
from skybasin.llm.queries import manifest_digest


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(*values):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(nodes):
    """The root over lists of digests, and the (left, right) steps of each node."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for j in range(len(run)):
                for i in owners[at + j]:
                    paths[i].append((run[:j], run[j + 1 :]))
            above.append(_h("".join(run)))
            above_owners.append([i for o in owners[at : at + 3] for i in o])
        nodes, owners = above, above_owners
    return nodes[0], paths


def _plain(rows):
    sources = {}
    for doc_id, text, lang, source, n_chars in rows:
        tampered = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            tampered = text.replace("\n", "")
        leaf = _leaf(doc_id, source, lang, n_chars, text)
        sources.setdefault(source, []).append((doc_id, leaf, _leaf(doc_id, source, lang, n_chars, tampered)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subs = {name: _tree([leaf for _, leaf, _ in sources[name]]) for name in names}
    root, tops = _tree([subs[name][0] for name in names])
    out = []
    for name, top in zip(names, tops):
        for (doc_id, leaf, tampered), path in zip(sources[name], subs[name][1]):
            folded = tampered
            for left, right in path + top:
                folded = _h("".join(left) + folded + "".join(right))
            proof = _h("".join("".join(left + right) for left, right in path + top))
            out.append((doc_id, leaf, subs[name][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def _table(spark, rows):
    full = [(*r, 1, "k", 2, "p") for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree bigint, key string, i int, place string"
    return spark.createDataFrame(full, schema)


@pytest.mark.parametrize("counts", [[1], [2], [3, 1], [1, 1, 1, 1], [29, 4, 10, 1, 3, 9]])
def test_proofs_are_those_of_a_plain_tree(spark, counts):
    rng = random.Random(sum(counts))
    names = [None, "", "b", "é", "B", "src"]
    rows, doc_id = [], 0
    for name, count in zip(names, counts):
        for _ in range(count):
            doc_id += rng.randint(1, 40)
            text = rng.choice([None, "", "one\ntwo\n", "no line", "é\n" * 50])
            rows.append((doc_id, text, rng.choice(["en", None]), name, rng.choice([7, None])))
    rng.shuffle(rows)
    found = sorted((tuple(r) for r in manifest_digest(_table(spark, rows)).collect()), key=str)
    assert found == _plain(rows)


def test_null_and_repeated_ids_and_rows(spark):
    rows = [(None, "a\n", "en", "s", 1), (None, "b", "en", "s", 1), (3, "x\n", "en", "s", 1), (3, "x\n", "en", "s", 1), (3, "y", None, "s", 1)]
    found = sorted((tuple(r) for r in manifest_digest(_table(spark, rows)).collect()), key=str)
    assert found == _plain(rows)


def test_no_rows_have_no_root(spark):
    built = manifest.build(_table(spark, []))
    assert built.root is None and built.leaves.count() == 0 and built.subroots.count() == 0
    assert manifest_digest(_table(spark, [])).collect() == []


def test_a_proof_leads_to_the_root_and_a_changed_leaf_does_not(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 4}", i) for i in range(50)]
    built = manifest.build(_table(spark, rows))
    checked = built.leaves.select(
        manifest.fold(F.col("leaf"), F.col("proof")).alias("good"), manifest.fold(F.sha2("leaf", 256), F.col("proof")).alias("bad")
    ).collect()
    assert {r.good for r in checked} == {built.root}
    assert built.root not in {r.bad for r in checked}
    assert {r.source: r.leaves for r in built.subroots.collect()} == {"s0": 13, "s1": 13, "s2": 12, "s3": 12}


def test_places_of_a_group_over_many_partitions(spark):
    from skybasin.llm.ranking import ranked

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), (F.col("id") * 7919 % 5000).alias("v"))
        found = ranked(rows, "g", ["v"], "place")
        groups = {}
        for r in found.collect():
            groups.setdefault(r.g, []).append((r.v, r.place))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(groups) == 8
    for pairs in groups.values():
        assert [p for _, p in sorted(pairs)] == list(range(len(pairs)))
