"""Prefix trie of rebuilt conversations, by composable fingerprints.

A conversation is rebuilt from the first turns of another one, its *base*, and its own turns after
as many; the texts of rebuilt conversations are never made.  A turn is a map ``x -> m * x + s`` on
numbers modulo 2 ** 64, with ``m`` (odd) and ``s`` from a hash of role and text, in two lanes.
Maps compose, so a run of turns is a map again, and what counts is what it makes of 0: the
*fingerprint*.  For each stored turn the map of its conversation up to there is computed once.  The map of a
rebuilt prefix is then that of the base's head, the inverse of that of the own turns left out,
and that of the own turns up to there: three stored maps, whatever the length.

1.  Turns are sorted by a range shuffle; a task composes along its rows, and the driver composes what
    reaches from one task into the next (a row per task).  No task holds a conversation.
2.  Equal fingerprints at a depth are a node, named by its smallest member.  Turns taken from a base
    are references to its stored turns; all other members bring theirs, and the smallest and the largest
    turn and parent of each node have to be equal.  If they are not, all is done anew with other hashes.
3.  The members of a node only get fewer with depth, so every conversation owns one chain of
    nodes, which hangs on a node of a smaller conversation's chain.  Sums over subtrees are sums along
    chains and over the chains that hang on them; those come from pointer jumping over chains.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skybasin.llm.common import stored, text_of
from skybasin.llm.shingles import _SPACE, mix

#: Heads have at most this many turns.
MOST_HEAD = 3
#: Numbers added up in one task along a chain.
BLOCK = 4096
ATTEMPTS = 4
#: Characters of a text that deal turns out to tasks; texts are sorted whole.
_DEAL_CHARS = 16

_LANES = ["m1", "s1", "m2", "s2"]
_SCAN = (
    "conv_id bigint, part int, at bigint, m1 bigint, s1 bigint, m2 bigint, s2 bigint, "
    "h1 bigint, h2 bigint, words bigint, role string, text string, first boolean, last boolean"
)
_SALT = np.uint64(0xA0761D6478BD642F)
_ONE = np.uint64(1)


def _map_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The map of each turn in one lane."""
    return mix(hashes) | _ONE, mix(hashes ^ _SALT)


def _inverse(odd: np.ndarray) -> np.ndarray:
    """The number whose product with an odd one is 1, modulo 2 ** 64; every step doubles the right bits."""
    found = odd * np.uint64(3) ^ np.uint64(2)
    for _ in range(4):
        found = found * (np.uint64(2) - odd * found)
    return found


def _along(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maps composed along runs of turns; ``starts`` is the first place of each turn's run."""
    m, s = _map_of(hashes)
    product = np.multiply.accumulate(m)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(s * _inverse(product), dtype=np.uint64)])
    before = np.concatenate([[_ONE], product])[starts]
    return product * _inverse(before), product * (sums[1:] - sums[starts])


def _numbers(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False)).astype(np.int64, copy=False).view(np.uint64)


def _column(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def word_counts(texts: pa.Array) -> np.ndarray:
    """How many runs without ASCII white space each text has."""
    raw = texts.cast(pa.binary())
    edges = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    firsts = edges[:-1][edges[:-1] < edges[1:]]
    opens[firsts] = inside[firsts]
    return np.diff(np.concatenate([[0], np.cumsum(opens)])[edges])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns with their place in the conversation and its map up to there, as far as this task sees."""
    names = [x.split()[0] for x in _SCAN.split(", ")]
    part = TaskContext.get().partitionId()
    conv, count, state = None, 0, [_ONE, np.uint64(0), _ONE, np.uint64(0)]
    held, is_first = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column(0).to_numpy()
        rows = len(convs)
        fresh = np.concatenate([[True], convs[1:] != convs[:-1]])
        starts = np.maximum.accumulate(np.where(fresh, np.arange(rows), 0))
        places = np.arange(rows) - starts
        lanes = [*_along(_numbers(batch.column(3)), starts), *_along(_numbers(batch.column(4)), starts)]
        if conv is not None and convs[0] == conv:
            same = int(np.argmax(np.concatenate([fresh[1:], [True]]))) + 1
            places[:same] += count
            for i in (0, 2):
                lanes[i + 1][:same] += lanes[i][:same] * state[i + 1]
                lanes[i][:same] *= state[i]
        conv, count, state = convs[-1], int(places[-1]) + 1, [x[-1] for x in lanes]
        flags = np.zeros(rows, bool)
        first = flags.copy()
        first[0], is_first = is_first, False
        columns = [
            batch.column(0), pa.array(np.full(rows, part, np.int32)), pa.array(places.astype(np.int64)),
            *(_column(x) for x in lanes), batch.column(3), batch.column(4),
            pa.array(word_counts(batch.column(2)).astype(np.int64)), batch.column(1), batch.column(2),
            pa.array(first), pa.array(flags),
        ]
        if held is not None:
            yield pa.RecordBatch.from_arrays(held, names)
        held = columns
    if held is not None:
        flags = np.zeros(len(held[0]), bool)
        flags[-1] = True
        yield pa.RecordBatch.from_arrays([*held[:-1], pa.array(flags)], names)


def _carries(edges: list) -> list[tuple]:
    """What a conversation that goes on from one task to the next brings along: turns so far and their map.

    ``edges`` are the first and last row of each task, in order of the tasks.
    """
    whole = 1 << 64
    out: list[tuple] = []
    conv, state = None, (0, 1, 0, 1, 0)
    for part in sorted({r.part for r in edges}):
        first = next(r for r in edges if r.part == part and r.first)
        last = next(r for r in edges if r.part == part and r.last)
        goes_on = conv is not None and conv == first.conv_id
        if goes_on:
            out.append((part, conv, state[0], *(x - whole if x >= whole >> 1 else x for x in state[1:])))
        own = (last.at + 1, *(x % whole for x in (last.m1, last.s1, last.m2, last.s2)))
        if goes_on and last.conv_id == conv:
            own = (
                state[0] + own[0],
                state[1] * own[1] % whole,
                (own[1] * state[2] + own[2]) % whole,
                state[3] * own[3] % whole,
                (own[3] * state[4] + own[4]) % whole,
            )
        conv, state = last.conv_id, own
    return out


def _mapped(df: DataFrame, work: Callable[[dict[str, pa.Array]], dict[str, np.ndarray]], kept: list[str], new: list[str]) -> DataFrame:
    """``df`` with the columns ``kept`` and, of whole numbers, the ``new`` ones that ``work`` gives."""
    schema = ", ".join([*(f"{c} {df.schema[c].dataType.simpleString()}" for c in kept), *(f"{c} bigint" for c in new)])
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = dict(zip(columns, batch.columns))
            made = work(given)
            yield pa.RecordBatch.from_arrays([*(given[c] for c in kept), *(_column(made[c]) for c in new)], [*kept, *new])

    return df.mapInArrow(run, schema)


def _go_on(given: dict[str, pa.Array]) -> dict[str, np.ndarray]:
    """Places and maps of turns whose conversation began in an earlier task."""
    x = {c: _numbers(given[c]) for c in [*_LANES, "at", "count", *(f"c_{lane}" for lane in _LANES)]}
    return {
        "pos": x["at"] + x["count"] + _ONE,
        "m1": x["c_m1"] * x["m1"],
        "s1": x["m1"] * x["c_s1"] + x["s1"],
        "m2": x["c_m2"] * x["m2"],
        "s2": x["m2"] * x["c_s2"] + x["s2"],
    }


def _rebuild(given: dict[str, pa.Array]) -> dict[str, np.ndarray]:
    """What the base's head and the own turns left out amount to, and the fingerprint at the end."""
    x = {c: _numbers(given[c]) for c in given if c[:5] in ("head_", "skip_", "last_")}
    out = {}
    for lane in "12":
        out[f"g{lane}"] = (x[f"head_s{lane}"] - x[f"skip_s{lane}"]) * _inverse(x[f"skip_m{lane}"])
        own = x[f"last_m{lane}"] * out[f"g{lane}"] + x[f"last_s{lane}"]
        out[f"k{lane}"] = np.where(_numbers(given["n"]) > _numbers(given["h"]), own, x[f"head_s{lane}"])
    return out


def _members(given: dict[str, pa.Array]) -> dict[str, np.ndarray]:
    """Fingerprints of the own turns of rebuilt conversations, and of what is before them."""
    out = {}
    for lane in "12":
        m, s = _map_of(_numbers(given[f"h{lane}"]))
        key = _numbers(given[f"m{lane}"]) * _numbers(given[f"g{lane}"]) + _numbers(given[f"s{lane}"])
        out[f"k{lane}"], out[f"up{lane}"] = key, (key - s) * _inverse(m)
    return out


def prefix_nodes(
    turns: DataFrame,
    base_of: Column,
    head_of: Column,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The trie's nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``base_of`` and ``head_of`` (0 to ``MOST_HEAD``) are expressions over ``conv_id``: a conversation is rebuilt from as
    many turns of its base, all if it has fewer and none if there is no such conversation, and its own turns after
    as many of them.  Turns stand in order of ``turn``, null first, then of role and text; null roles and texts are empty ones.
    Repeated rows are turns of their own.  Rows without a conversation id are left out.  A node is named by its smallest
    member and its depth; the root's parent is null.  An empty table gives no node.  Other columns are not read.
    """
    for attempt in range(ATTEMPTS):
        nodes, convs = _nodes(turns, base_of, head_of, [conv_col, turn_col, role_col, text_col], attempt)
        if nodes.filter("mixed").isEmpty():
            return _summed(nodes.drop("mixed"), convs)
    raise RuntimeError("different conversations had equal fingerprints in every attempt")


def _nodes(turns: DataFrame, base_of: Column, head_of: Column, names: list[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """Nodes without sums, and the conversations with the fingerprint of their end."""
    conv, turn, role, text = (F.col(f"`{c}`") for c in names)
    role, text = text_of(role), text_of(text)
    rows = turns.filter(conv.cast("bigint").isNotNull()).select(
        conv.cast("bigint").alias("conv_id"),
        turn.alias("turn"),
        role.alias("role"),
        text.alias("text"),
        *(F.xxhash64(F.lit(2 * seed + lane), role, text).alias(f"h{lane}") for lane in (1, 2)),
    )
    # A range ends between two turns; the sort within it looks at whole texts.
    dealt = rows.withColumn("dealt", F.substring("text", 1, _DEAL_CHARS)).repartitionByRange("conv_id", "turn", "role", "dealt")
    in_order = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text", "h1", "h2")
    scanned = stored(in_order.mapInArrow(_scan, _SCAN), "turns")

    edges = scanned.filter("first OR last").select("part", "conv_id", "at", *_LANES, "first", "last").collect()
    carries = turns.sparkSession.createDataFrame(
        _carries(edges), "part int, conv_id bigint, count bigint, " + ", ".join(f"c_{x} bigint" for x in _LANES)
    )
    # A row for each task at most.
    carries = F.broadcast(carries)
    keep = ["conv_id", "h1", "h2", "words", "role", "text"]
    begun = scanned.join(carries, ["part", "conv_id"], "left_anti").select(*keep, (F.col("at") + 1).alias("pos"), *_LANES)
    going_on = _mapped(scanned.join(carries, ["part", "conv_id"]), _go_on, keep, ["pos", *_LANES])
    turns_ = begun.unionByName(going_on)

    convs = _conversations(turns_, base_of, head_of)
    own = turns_.join(convs.select("conv_id", "h", "hb", "g1", "g2"), "conv_id").filter("pos > h")
    own = own.withColumn("depth", F.col("hb") + F.col("pos") - F.col("h"))
    members = _mapped(own, _members, ["conv_id", "depth", "words", "role", "text"], ["k1", "k2", "up1", "up2"]).select(
        "depth", "k1", "k2", "conv_id", F.struct("up1", "up2").alias("up"), "words", F.struct("role", "text").alias("turn")
    )
    # Turns of the base are references to rows above: the base is a member of the same node.
    nothing = F.lit(None).cast("struct<role:string,text:string>")
    heads = convs.select("conv_id", F.posexplode(F.slice("heads", F.lit(2), F.col("hb"))).alias("j", "key"), "heads").select(
        (F.col("j") + 1).cast("bigint").alias("depth"),
        F.col("key.s1").alias("k1"),
        F.col("key.s2").alias("k2"),
        "conv_id",
        F.struct(F.col("heads")[F.col("j")]["s1"].alias("up1"), F.col("heads")[F.col("j")]["s2"].alias("up2")).alias("up"),
        F.lit(None).cast("bigint").alias("words"),
        nothing.alias("turn"),
    )
    nodes = (
        members.unionByName(heads)
        .groupBy("depth", "k1", "k2")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.max("words").alias("words"),
            F.min("up").alias("up"),
            (
                (F.min("up") != F.max("up")) | F.max("turn").isNull() | (F.min("turn") != F.max("turn"))
            ).alias("mixed"),
        )
    )
    return stored(nodes, "nodes"), convs


def _conversations(turns: DataFrame, base_of: Column, head_of: Column) -> DataFrame:
    """Each conversation with its number of turns ``n``, what it takes from its base and its end's fingerprint."""
    lanes = F.struct(*_LANES)
    grouped = turns.groupBy("conv_id").agg(
        F.max("pos").alias("n"),
        F.max_by(lanes, "pos").alias("last"),
        *(F.max(F.when(F.col("pos") == j, lanes)).alias(f"p{j}") for j in range(1, MOST_HEAD + 1)),
    )
    start = F.struct(*(F.lit(int(x[0] == "m")).cast("bigint").alias(x) for x in _LANES))
    maps = F.array(start, *(F.col(f"p{j}") for j in range(1, MOST_HEAD + 1)))
    # A conversation that is its own base is as it was.
    own_base = F.coalesce(F.col("base") == F.col("conv_id"), F.lit(False))
    all_ = stored(
        grouped.select("conv_id", "n", "last", maps.alias("maps"), base_of.cast("bigint").alias("base"), head_of.cast("bigint").alias("h"))
        .withColumn("h", F.when(own_base, 0).otherwise(F.col("h")))
        .withColumn("base", F.when(~own_base, F.col("base"))),
        "conversations",
    )
    bases = all_.join(all_.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi")
    bases = bases.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("maps").alias("heads"))
    # Few share a base, but many may have none: they need no join.
    joined = all_.filter("base IS NOT NULL").join(bases, "base", "left").unionByName(
        all_.filter("base IS NULL"), allowMissingColumns=True
    )
    hb = F.least(F.col("h"), F.coalesce("base_n", F.lit(0)))
    placed = joined.withColumn("hb", hb.cast("bigint")).select(
        "conv_id", "n", "h", "hb",
        F.coalesce("heads", F.array(start)).alias("heads"),
        F.coalesce(F.expr("heads[int(hb)]"), start).alias("head"),
        F.expr("maps[int(least(h, n))]").alias("skip"),
        "last",
    )
    flat = placed.select(
        "conv_id", "n", "h", "hb", "heads", *(F.col(f"{a}.{b}").alias(f"{a}_{b}") for a in ("head", "skip", "last") for b in _LANES)
    )
    return stored(_mapped(flat, _rebuild, ["conv_id", "n", "h", "hb", "heads"], ["g1", "g2", "k1", "k2"]), "rebuilt")


def _summed(nodes: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes with parents, children, sums over subtrees and ends; the root is added."""
    count, lowest = convs.agg(F.count("*"), F.min("conv_id")).head()
    spark = nodes.sparkSession
    roots = [(lowest, 0, None, count, 0)] if count else []
    root = spark.createDataFrame(roots, "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, words bigint")

    # Nodes of depth 1 hang on the root, the others on the node of their parent's fingerprint.
    key = F.struct((F.col("depth") - 1).alias("depth"), "up.up1", "up.up2")
    parents = nodes.select(F.struct("depth", "k1", "k2").alias("key"), F.col("conv_id").alias("parent_conv_id"))
    deeper = nodes.filter("depth > 1").withColumn("key", key).join(parents, "key")
    first = nodes.filter("depth = 1").withColumn("parent_conv_id", F.lit(lowest).cast("bigint"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "words"]
    linked = stored(deeper.select(*columns).unionByName(first.select(*columns)).unionByName(root), "linked")

    children = linked.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    counted = linked.join(children.agg(F.count("*").alias("n_children")), ["conv_id", "depth"], "left").select(
        *columns[:4],
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    counted = stored(counted, "counted")
    hangs = F.when(F.col("parent_conv_id") != F.col("conv_id"), F.struct("parent_conv_id", (F.col("depth") - 1).alias("depth")))
    chains = counted.groupBy("conv_id").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max(hangs).alias("on")
    )
    chains = stored(chains, "chains")
    totals = _below(chains.select("conv_id", "leaves", "saved", F.col("on.parent_conv_id").alias("to")))
    hanging = (
        chains.filter("on IS NOT NULL")
        .select("conv_id", "on")
        .join(totals, "conv_id")
        .groupBy(F.col("on.parent_conv_id").alias("conv_id"), F.col("on.depth").alias("depth"))
        .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    )
    both = counted.join(hanging, ["conv_id", "depth"], "left").select(
        *columns[:4],
        "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
    )
    summed = _from_here_down(stored(both, "hung"))
    ends = _ends(nodes, convs, lowest)
    none = hashlib.sha256(b"").hexdigest()
    return summed.join(ends, ["conv_id", "depth"], "left").select(
        *columns[:4],
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def _below(chains: DataFrame) -> DataFrame:
    """``conv_id, leaves, saved`` summed over each chain and all that hang on it, at any distance.

    In a round every chain adds its sums to those of the chain that it points to, and points as far
    again; after as many rounds as the longest way has binary digits none points anywhere.
    """
    while not chains.filter("to IS NOT NULL").isEmpty():
        pointing = chains.filter("to IS NOT NULL")
        added = pointing.groupBy(F.col("to").alias("conv_id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        targets = chains.filter("to IS NOT NULL").select(F.col("conv_id").alias("to"), F.col("to").alias("further"))
        moved = pointing.join(targets, "to", "left").select("conv_id", "leaves", "saved", F.col("further").alias("to"))
        at_rest = chains.filter("to IS NULL")
        chains = stored(
            moved.unionByName(at_rest.select("conv_id", "leaves", "saved", "to"))
            .join(added, "conv_id", "left")
            .select(
                "conv_id",
                (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
                "to",
            ),
            "chains",
        )
    return chains.drop("to")


def _from_here_down(nodes: DataFrame) -> DataFrame:
    """Sums along each chain from a node to its end; long chains are added up block by block."""
    rows = nodes.withColumn("block", F.expr(f"depth div {BLOCK}"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    later = blocks.select(
        "conv_id", "block", *(F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"later_{c}") for c in ("l", "s"))
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(later, ["conv_id", "block"])
        .withColumn("leaves", F.sum("leaves").over(inside) + F.col("later_l"))
        .withColumn("saved", F.sum("saved").over(inside) + F.col("later_s"))
        .drop("block", "later_l", "later_s")
    )


def _ends(nodes: DataFrame, convs: DataFrame, root: int | None) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of the nodes where conversations end.

    A digest is made along its ids, in one pass over sorted rows that holds one id at a time.
    """
    depth = F.when(F.col("n") > F.col("h"), F.col("hb") + F.col("n") - F.col("h")).otherwise(F.col("hb"))
    last = convs.select(F.col("conv_id").alias("member"), depth.alias("depth"), "k1", "k2")
    at_root = last.filter("depth = 0").select(F.lit(root).cast("bigint").alias("conv_id"), "depth", "member")
    named = nodes.select("depth", "k1", "k2", "conv_id")
    ends = last.filter("depth > 0").join(named, ["depth", "k1", "k2"]).select("conv_id", "depth", "member")
    in_order = ends.unionByName(at_root).repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member")
    return in_order.mapInArrow(_digests, "conv_id bigint, depth bigint, ends_sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None
    names = ["conv_id", "depth", "ends_sha256"]

    def done(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names)

    for batch in batches:
        rows = []
        for conv, depth, member in zip(*(c.to_pylist() for c in batch.columns)):
            if node == (conv, depth):
                digest.update(b",%d" % member)
                continue
            if node is not None:
                rows.append((*node, digest.hexdigest()))
            node, digest = (conv, depth), hashlib.sha256(b"%d" % member)
        if rows:
            yield done(rows)
    if node is not None:
        yield done([(*node, digest.hexdigest())])
