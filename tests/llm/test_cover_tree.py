import numpy as np
import pytest
from pyspark.sql import functions as F

from skybasin.llm import cover_tree

SCHEMA = "vec_id bigint, embedding array<float>, id int, v string, d int, q int, asks string"


def _top(spark, rows, k=5, every=3, **options):
    frame = spark.createDataFrame([(i, x, 1, "a", 2, 3, "b") for i, x in rows], SCHEMA)
    found = cover_tree.top_k(frame, F.col("vec_id") % every == 0, k, **options)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


def _plain(rows, k=5, every=3):
    usable = {}
    for i, x in rows:
        if i is not None and x and all(c is not None and np.isfinite(c) for c in x):
            usable[i] = np.floor(256 * np.array(x, np.float32).astype(float)).astype(int)
    out = []
    for q, a in usable.items():
        if q % every == 0:
            scores = sorted((-int(a @ b), i) for i, b in usable.items() if i != q and len(a) == len(b))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def _rows(kind, count=300, dim=6):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(count, dim))
    if kind == "clusters":
        x = x[rng.integers(0, 6, count)] * 4 + rng.normal(size=(count, dim)) / 20
    if kind == "copies":
        x[100:250] = x[100]
    if kind == "coarse":
        x = np.rint(x)
    return [(int(i), [float(c) for c in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("kind", ["random", "clusters", "copies", "coarse"])
def test_the_best_are_those_of_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(cover_tree, "DATA_BLOCK", 90)
    monkeypatch.setattr(cover_tree, "QUERY_BLOCK", 40)
    rows = _rows(kind)
    assert _top(spark, rows) == _plain(rows)


def test_vectors_that_take_no_part(spark):
    rows = _rows("random", 40, 3)
    bad = [(50, None), (51, [1.0, None, 2.0]), (54, [float("nan"), 0.0, 0.0]), (57, [float("inf"), 0.0, 0.0]), (60, []), (None, [1.0, 1.0, 1.0])]
    other = [(63, [1.0, 2.0]), (64, [3.0, 2.0])]
    assert _top(spark, rows + bad + other) == _plain(rows + bad + other)
    assert _top(spark, rows + rows) == _plain(rows)


def test_few_rows_and_none(spark):
    assert _top(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert _top(spark, [(0, [1.0])]) == []
    assert _top(spark, []) == []


def test_huge_numbers_are_multiplied_exactly(spark):
    rows = [(i, [float(2**20 + 2**4 * i), 1.0, float(i)]) for i in range(9)]
    assert _top(spark, rows) == _plain(rows)


@pytest.mark.parametrize("kind", ["random", "clusters", "copies"])
def test_trees_cover_their_points(kind):
    points = np.array([x for _, x in _rows(kind, 500)])
    pending, seen = [cover_tree.build(points)], []
    while pending:
        node = pending.pop()
        gaps = np.linalg.norm(points[node.rows] - points[node.centre], axis=1)
        assert gaps.max() <= node.radius + 1e-9
        assert all(c.radius <= node.radius / 2 for c in node.children)
        centres = points[[c.centre for c in node.children]]
        for i in range(len(centres)):
            apart = np.linalg.norm(centres[:i] - centres[i], axis=1)
            assert (apart > node.radius / 2 - 1e-9).all()
        pending += node.children
        if not node.children:
            seen += node.rows.tolist()
    assert sorted(seen) == list(range(500))


def test_clusters_are_pruned():
    points = np.floor(256 * np.array([x for _, x in _rows("clusters", 2000)]))
    ids = np.arange(2000)
    search = cover_tree.Search(ids[:60], points[:60], ids, points, 5)
    compared = []
    plain = search.compare
    search.compare = lambda q, r: (compared.append(len(q) * len(r)), plain(q, r))
    search.run()
    assert sum(compared) < 0.7 * 60 * 2000
