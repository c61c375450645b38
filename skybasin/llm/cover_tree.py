"""Exact top-k inner products by a dual-tree search over cover trees.

Data and queries are dealt into blocks; a task gets one block of each, builds a cover tree over
either side and walks both at once.  For a pair of nodes, centres and covering radii bound every
score between them::

    <q, r>  <=  <cq, cr> + radius_q * |cr| + radius_r * |cq| + radius_q * radius_r

A pair whose bound is below the worst k-th score of all queries in its query node is pruned.
Pairs are taken best bound first, so that k-th scores rise early.  Where vectors have no near
neighbours, as with random ones, radii don't shrink and little is pruned; the cost is then that of
all inner products in blocks, never more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one block; memory and the time of a task grow with their product.
DATA_BLOCK, QUERY_BLOCK = 4096, 2048
#: A node of at most this many points is a leaf.
LEAF = 32
#: Leaves of the data compared in one pass.
COLUMNS = 512
SCALE = 256
#: Below this all sums of products are exact in double precision.
_EXACT = float(1 << 53)


@dataclass
class Node:
    """Points ``rows`` of a matrix, all within ``radius`` of the point ``centre``."""

    centre: int
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)


def build(points: np.ndarray) -> Node:
    """A cover tree: the children of a node cover it at half its scale, the first around its own centre.

    Centres of siblings are further apart than their scale, and every point belongs to one child.
    """
    rows = np.arange(len(points))
    gaps = _distances(points, rows, 0)
    root = Node(0, float(gaps.max()), rows)
    pending = [(root, gaps)]
    while pending:
        node, gaps = pending.pop()
        if len(node.rows) <= LEAF or node.radius == 0:
            continue
        scale = node.radius / 2
        open_rows, open_gaps, centre = node.rows, gaps, node.centre
        while True:
            near = open_gaps <= scale
            child = Node(centre, float(open_gaps[near].max()), open_rows[near])
            node.children.append(child)
            pending.append((child, open_gaps[near]))
            open_rows = open_rows[~near]
            if not len(open_rows):
                break
            centre = int(open_rows[0])
            open_gaps = _distances(points, open_rows, centre)
    return root


def _distances(points: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
    apart = points[rows] - points[centre]
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


class Search:
    """The k best of a block of data for each query of a block; both as whole numbers in doubles."""

    def __init__(self, query_ids, queries, data_ids, data, k: int):
        self.query_ids, self.queries = query_ids, queries
        self.data_ids, self.data = data_ids, data
        self.k = k
        # Numbers too large for exact doubles are multiplied as Python integers.
        self.exact = (
            np.abs(queries).max() * np.abs(data).max() * max(1, queries.shape[1]) < _EXACT
        )
        self.norms_q = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        self.norms_r = np.sqrt(np.einsum("ij,ij->i", data, data))
        empty = np.iinfo(np.int64).max
        self.best_ids = np.full((len(queries), k), empty)
        kind = np.float64 if self.exact else object
        self.best = np.full((len(queries), k), -np.inf).astype(kind)
        self.worst = np.full(len(queries), -np.inf)

    def scores(self, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        if self.exact:
            return self.queries[q] @ self.data[r].T
        whole = lambda x: np.array([[int(v) for v in row] for row in x], object)
        return whole(self.queries[q]) @ whole(self.data[r]).T

    def bounds(self, q: list[Node], r: list[Node]) -> np.ndarray:
        cq, cr = np.array([n.centre for n in q]), np.array([n.centre for n in r])
        radius_q, radius_r = np.array([n.radius for n in q]), np.array([n.radius for n in r])
        top = (
            self.queries[cq] @ self.data[cr].T
            + radius_q[:, None] * self.norms_r[cr]
            + radius_r * self.norms_q[cq][:, None]
            + radius_q[:, None] * radius_r
        )
        return top + 1e-6 + 1e-9 * np.abs(top)  # room for rounding

    def run(self) -> None:
        """Walk both trees; a step takes some nodes of either side and all pairs between them."""
        pending = [([build(self.queries)], [build(self.data)])]
        while pending:
            q, r = pending.pop()
            bounds = self.bounds(q, r)
            open_pairs = bounds >= np.array([self.worst[n.rows].min() for n in q])[:, None]
            inner_q = np.array([bool(n.children) for n in q])
            inner_r = np.array([bool(n.children) for n in r])
            self.compare_leaves(
                [n for n, inner in zip(q, inner_q) if not inner],
                [n for n, inner in zip(r, inner_r) if not inner],
                bounds[np.ix_(~inner_q, ~inner_r)],
            )
            # The last one pushed is taken first: that of the best bound.
            todo = []
            for j in np.flatnonzero(inner_r):
                who = np.flatnonzero(open_pairs[:, j] & ~inner_q)
                if len(who):
                    todo.append((bounds[who, j].max(), [q[i] for i in who], r[j].children))
            for i in np.flatnonzero(inner_q):
                which = np.flatnonzero(open_pairs[i])
                if len(which):
                    todo.append((bounds[i, which].max(), q[i].children, [r[j] for j in which]))
            pending += [(x, y) for _, x, y in sorted(todo, key=lambda t: t[0])]

    def compare_leaves(self, q: list[Node], r: list[Node], bounds: np.ndarray) -> None:
        """All open pairs of leaves, those of the best bounds first; a pass takes some columns."""
        if not q or not r:
            return
        rows = np.concatenate([n.rows for n in q])
        of_row = np.repeat(np.arange(len(q)), [len(n.rows) for n in q])
        order = np.argsort(-bounds.max(axis=0))
        for at in range(0, len(order), COLUMNS):
            part = order[at : at + COLUMNS]
            can = (bounds[:, part].max(axis=1)[of_row]) >= self.worst[rows]
            if can.any():
                self.compare(rows[can], np.concatenate([r[j].rows for j in part]))

    def compare(self, q: np.ndarray, r: np.ndarray) -> None:
        found = self.scores(q, r)
        ids = self.data_ids[r]
        can = (found >= self.worst[q][:, None]) & (ids != self.query_ids[q][:, None])
        for i in np.flatnonzero(can.any(axis=1)):
            row = q[i]
            scores = np.concatenate([self.best[row], found[i, can[i]]])
            names = np.concatenate([self.best_ids[row], ids[can[i]]])
            top = np.lexsort((names, -scores))[: self.k] if self.exact else _slow_top(scores, names, self.k)
            self.best[row], self.best_ids[row] = scores[top], names[top]
            self.worst[row] = float(scores[top][-1])

    def found(self) -> pd.DataFrame:
        real = self.best != -np.inf
        query = np.broadcast_to(self.query_ids[:, None], real.shape)[real]
        low, high = -(1 << 63), (1 << 63) - 1
        scores = [min(max(int(s), low), high) for s in self.best[real]]
        return pd.DataFrame({"query_id": query, "vec_id": self.best_ids[real], "score": np.array(scores, np.int64)})


def _slow_top(scores, names, k: int) -> list[int]:
    return sorted(range(len(names)), key=lambda i: (-scores[i], names[i]))[:k]


def whole_numbers(vector: str | Column) -> Column:
    """Each component x as floor(SCALE * x) in double precision; null where one is null or not finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(
        column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    # Spark's floor gives a long; a double beyond 2 ** 53 is a whole number already.
    def floored(x: Column) -> Column:
        scaled = F.lit(float(SCALE)) * x.cast("double")
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.when(finite, F.transform(column, floored))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of each query among all other rows.

    Ties go to the smaller id; with fewer than k other rows all are given.  Vectors that are null
    or empty, or hold a null or a number that is not finite, and rows with a null id take no part.
    An id stands for one vector: of rows that repeat one, the smallest vector counts.  Vectors are
    compared with those of their own length.  An empty table gives no rows.  ``is_query`` is a
    condition on the columns of ``vectors``; other columns are not read.
    """
    rows = (
        vectors.select(
            F.col(f"`{id_col}`").cast("bigint").alias("id"),
            whole_numbers(f"`{vector_col}`").alias("v"),
            is_query.alias("asks"),
        )
        .filter("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
        .groupBy("id")
        .agg(F.min(F.struct("v", "asks")).alias("one"))
        .select("id", "one.v", "one.asks")
    )
    counts = rows.agg(F.count("*").alias("rows"), F.count_if("asks").alias("queries")).head()
    data_blocks = max(1, -(-counts["rows"] // DATA_BLOCK))
    query_blocks = max(1, -(-counts["queries"] // QUERY_BLOCK))

    def block(blocks: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    # Each block of one side meets each block of the other: rows are dealt to all of them.
    data = rows.select(
        "id", "v", block(data_blocks).alias("d"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q")
    )
    queries = rows.filter("asks").select(
        "id", "v", F.explode(F.sequence(F.lit(0), F.lit(data_blocks - 1))).alias("d"), block(query_blocks).alias("q")
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = [_by_length(left), _by_length(right)]
        found = [
            _search(*sides[0][size], *sides[1][size], k) for size in sides[0].keys() & sides[1].keys()
        ]
        empty = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
        return pa.Table.from_pandas(pd.concat([empty, *found]), preserve_index=False)

    best = (
        queries.groupBy("d", "q")
        .cogroup(data.groupBy("d", "q"))
        .applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    )
    order = F.array_sort(
        F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("vec_id").alias("vec_id")))
    )
    # A query has at most k rows from each block of data.
    ranked = best.groupBy("query_id").agg(F.slice(order, 1, k).alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("place", "hit")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.minus")).alias("score"),
    )


def _by_length(side: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids, ascending, and matrix of the vectors of each length."""
    side = side.select(["id", "v"]).combine_chunks().sort_by("id")
    if not side.num_rows:
        return {}
    ids = side.column("id").to_numpy()
    vectors = side.column("v").combine_chunks()
    sizes = vectors.value_lengths().to_numpy()
    out = {}
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        flat = vectors.take(pa.array(own)).flatten().to_numpy()
        out[int(size)] = (ids[own], flat.reshape(len(own), size))
    return out


def _search(query_ids, queries, data_ids, data, k: int) -> pd.DataFrame:
    search = Search(query_ids, queries, data_ids, data, k)
    search.run()
    return search.found()
