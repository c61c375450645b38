"""Merkle manifest of a dataset with pointer-jumping proofs, in native operations.

Every row is a leaf.  The leaves of a source, by id, form a tree: runs of ``FANOUT`` neighbours become
their common digest until one node, the source's root, is left.  The roots of the sources, in
order of their names, form a tree above in the same way.

A node's *segment* is the siblings to its left and right, level by level, on the way to the ancestor
that it points to.  At first that is its parent; then a round joins every pointer with the node it
points to, appends that node's segment and takes over its pointer, which doubles the distance.  After
as many rounds as the height has binary digits all leaves point to the root, and their segments are
their proofs.  A round needs only nodes at multiples of its distance as targets, so the joined
side shrinks by a power of the fan-out from round to round.

Texts are read once, for the leaves; from there on rows hold digests of 32 bytes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin.llm.common import stored
from skybasin.llm.ranking import ranked

FANOUT = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree above the sources.
_TOP = -1


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (hex) of values one after the other: ``-`` for null, else byte count, ``:`` and value."""
    return F.sha2(F.concat(*(_field(v.cast("string")) for v in values)).cast("binary"), 256)


def _field(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    )


def _text(digest: Column) -> Column:
    """A digest as the text that is hashed further."""
    return F.lower(F.hex(digest))


def _together(digests: Column) -> Column:
    """A list of digests as one string of bytes."""
    return F.array_join(F.transform(digests, _text), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root (hex) that a leaf (hex) and its proof give."""
    return F.aggregate(
        proof,
        leaf,
        lambda digest, step: F.sha2(
            F.concat(_together(step["left"]), digest, _together(step["right"])).cast("binary"), 256
        ),
    )


def proof_digest(proof: Column) -> Column:
    """SHA-256 (hex) of all siblings of a proof, from the leaf up, left to right."""
    steps = F.transform(proof, lambda step: F.concat(_together(step["left"]), _together(step["right"])))
    return F.sha2(F.array_join(steps, "").cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves`` with proofs (see ``build``), ``subroots`` (source, leaves, subroot) and the root (null without rows)."""

    leaves: DataFrame
    subroots: DataFrame
    root: str | None


def build(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    source_col: str = "source",
    carried: Column | None = None,
) -> Manifest:
    """The manifest of ``docs``; ``columns`` are those a leaf stands for, in this order.

    ``leaves`` has one row per row of ``docs``: ``doc_id, source, place`` (among the leaves of its source),
    ``leaf, subroot`` (hex), ``proof`` (array of left and right siblings, digests as bytes) and
    ``carried``, which is computed from the row.  Null ids come first, as do null sources; rows
    that repeat an id are ordered by their leaf and then by ``carried``.  Any column may be null, and an
    empty text differs from a null one.  An empty table has no leaf and no root.  Other columns are not read.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        # Null sorts before every name; names sort by their bytes.
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`")), F.lit("-")).alias("key"),
        F.unhex(leaf_digest(*(F.col(f"`{c}`") for c in columns))).alias("digest"),
        (F.lit(None).cast("string") if carried is None else carried).alias("carried"),
    )
    placed = ranked(rows, "key", ["id", "digest", "carried"], "place")
    placed = stored(placed, "leaves")
    counts = placed.groupBy("key").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    sources = stored(ranked(counts, "all", ["key"], "tree").drop("all"), "sources")
    leaves = placed.join(sources, "key").select(
        "tree", F.col("place").alias("i"), "n", "digest", F.struct("id", "carried").alias("row")
    )
    count, largest = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).head()

    trees, ends = _grow(leaves, largest)
    subroots = stored(_all(x.select("tree", "digest") for x in ends), "subroots")
    above = subroots.select(
        F.lit(_TOP).alias("tree"),
        F.col("tree").alias("i"),
        F.lit(count).cast("bigint").alias("n"),
        "digest",
        F.lit(None).cast("string").alias("row"),
    )
    tops, last = _grow(above, count)
    root = _all(x.select("digest") for x in last).head()

    # The only leaf of a source is its root, which points to the tree above without a step.
    single = leaves.filter("n = 1").select(
        "tree", "i", "digest", "row", _node(_TOP, 0, "tree").alias("to"), F.array().cast(_STEPS).alias("steps")
    )
    reach = single
    if trees:
        reach = _edges(trees[0], 0).select("tree", "i", "digest", "row", "to", "steps").unionByName(single)
    inner = [_edges(x, level) for level, x in enumerate(trees) if level]
    inner += [_edges(x, level) for level, x in enumerate(tops)]
    # The tree above may be one node, which is the root.
    only = above.filter("n = 1").withColumns({"level": F.lit(0), "to": F.lit(None).cast(_NODE), "steps": F.array().cast(_STEPS)})
    nodes = _all(
        x.select(_node("tree", "level", "i").alias("at"), "to", "steps") for x in [*inner, only]
    )
    reach = _jump(reach, nodes, max(1, (len(trees) + len(tops)).bit_length()))

    names = sources.join(subroots.withColumnRenamed("digest", "top"), "tree").withColumn(
        "source", F.when(F.col("key") != "-", F.expr("substring(key, 2)"))
    )
    return Manifest(
        reach.join(names, "tree").select(
            F.col("row.id").alias("doc_id"),
            "source",
            F.col("i").alias("place"),
            _text(F.col("digest")).alias("leaf"),
            _text(F.col("top")).alias("subroot"),
            F.col("steps").alias("proof"),
            "row.carried",
        ),
        names.select("source", F.col("n").alias("leaves"), _text(F.col("top")).alias("subroot")),
        bytes(root.digest).hex() if root else None,
    )


_NODE = "struct<tree:bigint,level:int,i:bigint>"
_STEPS = "array<struct<left:array<binary>,right:array<binary>>>"


def _all(parts: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _node(tree: int | str, level: int | str, i: str) -> Column:
    parts = (F.lit(x) if isinstance(x, int) else F.col(x) for x in (tree, level, i))
    return F.struct(*(p.cast(t).alias(n) for p, t, n in zip(parts, ("bigint", "int", "bigint"), ("tree", "level", "i"))))


def _grow(level: DataFrame, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The runs of every level, and the nodes that are left alone, level by level.

    ``level`` has ``tree, i, n`` (nodes of the tree in this level), ``digest`` and ``row``.
    """
    runs, ends = [], []
    while True:
        ends.append(level.filter("n = 1"))
        if most <= 1:
            return runs, ends
        run = F.array_sort(F.collect_list(F.struct("i", "digest", "row")))
        runs.append(
            stored(
                level.filter("n > 1")
                .groupBy("tree", F.expr(f"i div {FANOUT}").alias("parent"))
                .agg(F.max("n").alias("n"), run.alias("run")),
                "runs",
            )
        )
        level = runs[-1].select(
            "tree",
            F.col("parent").alias("i"),
            F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
            F.unhex(F.sha2(_together(F.col("run.digest")).cast("binary"), 256)).alias("digest"),
            F.lit(None).cast("string").alias("row"),
        )
        most = -(-most // FANOUT)


def _edges(runs: DataFrame, level: int) -> DataFrame:
    """Every node of a level with its parent and the step to it."""
    children = runs.select("tree", "parent", "n", "run", F.posexplode("run").alias("j", "child"))
    digests = F.col("run.digest")
    to_root = (F.col("n") <= FANOUT) & (F.col("tree") == _TOP)
    to_subroot = (F.col("n") <= FANOUT) & (F.col("tree") != _TOP)
    step = F.struct(
        F.slice(digests, F.lit(1), F.col("j")).alias("left"),
        F.slice(digests, F.col("j") + 2, F.size("run")).alias("right"),
    )
    return children.select(
        "tree",
        F.lit(level).alias("level"),
        F.col("child.i").alias("i"),
        F.col("child.digest").alias("digest"),
        F.col("child.row").alias("row"),
        F.when(to_root, F.lit(None))
        .when(to_subroot, _node(_TOP, 0, "tree"))
        .otherwise(F.struct(F.col("tree"), F.lit(level + 1).alias("level"), F.col("parent").alias("i")))
        .cast(_NODE)
        .alias("to"),
        F.array(step).alias("steps"),
    )


def _jump(reach: DataFrame, nodes: DataFrame, rounds: int) -> DataFrame:
    """``reach`` with its pointers at the root, which is null, and all steps to it."""
    for k in range(rounds):
        nodes = stored(nodes, "segments")
        reach = _doubled(reach, nodes)
        if k + 1 < rounds:
            # Pointers of the next round lead to these nodes only.
            further = nodes.filter((F.col("at.tree") == _TOP) | (F.col("at.level") % 2 ** (k + 1) == 0))
            nodes = _doubled(further, nodes)
    return reach


def _doubled(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    # What has arrived looks for a node that isn't there, a different one in each row.
    nowhere = F.struct(F.lit(_TOP).cast("bigint").alias("tree"), F.lit(-1).alias("level"), F.xxhash64("steps").alias("i"))
    targets = nodes.select(F.col("at").alias("__at"), F.col("to").alias("__to"), F.col("steps").alias("__more"))
    joined = rows.withColumn("__key", F.coalesce("to", nowhere)).join(targets, F.col("__key") == F.col("__at"), "left")
    steps = F.concat("steps", F.coalesce("__more", F.array().cast(_STEPS)))
    return joined.select(
        *(c for c in rows.columns if c not in ("to", "steps")), F.col("__to").alias("to"), steps.alias("steps")
    )
