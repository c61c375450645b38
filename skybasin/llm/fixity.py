"""Merkle fixity audit of WARC records, in native operations.

A replica's records stand in order of their number in archive files of ``FILE_RECORDS`` numbers each.
Leaves are digests of single records; a node covers ``FANOUT`` neighbouring numbers, then
``FANOUT`` such nodes, and so on up to the root.  Its digest is that of its children in order: of each the
number, the offset range and the digest.  Offsets are relative: a record's begins where the record
before it in its file ends (0 bytes further, unless something stands between), and a node's range is as long
as those of its children.  So records that are moved, swapped or pushed apart by foreign bytes show, while a lost or
shortened record changes the nodes above it and no others.

Two replicas are compared from the root down: only nodes whose digests differ are opened, and
their children are all that is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skybasin.llm.common import stored

FANOUT = 64
FILE_RECORDS = 4096
#: Numbers below zero for records without one.
UNNUMBERED = 1 << 40


def warc_record(number: Column, uri: Column, payload: Column) -> Column:
    """The bytes of a WARC resource record; null parts are empty."""
    body = F.coalesce(payload.cast("binary"), F.lit(b""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"),
        F.coalesce(number.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit(b"\r\n\r\n"))


@dataclass(frozen=True)
class Tree:
    """Records (level 0) and nodes (levels from 1) of a replica; ``top`` is the root's level."""

    levels: tuple[DataFrame, ...]

    @property
    def top(self) -> int:
        return len(self.levels) - 1


def build_tree(
    records: DataFrame,
    number_col: str = "number",
    bytes_col: str = "record",
    top: int | None = None,
    file_col: str | None = None,
    offset_col: str | None = None,
) -> Tree:
    """The tree over ``records`` (a whole number and the record's bytes), with ``top`` levels of nodes.

    ``file_col`` (a whole number) and ``offset_col`` say where a record was found; without them, or where
    they are null, it is where an archive without gaps has it.  Of several records under one number the first place counts.

    Repeated numbers make one leaf over the distinct records and how often each is there.  Null bytes are an empty
    record.  A null number stands for numbers below zero that the digest gives, so that
    such records are compared as well.  An empty table gives a tree of empty levels.
    """
    digest = F.sha2(F.coalesce(F.col(f"`{bytes_col}`"), F.lit(b"")), 256)
    rows = records.select(
        _number(number_col, bytes_col).alias("node"),
        _digest(bytes_col).alias("digest"),
        F.coalesce(F.octet_length(f"`{bytes_col}`"), F.lit(0)).cast("bigint").alias("length"),
        F.struct(
            *((F.col(f"`{c}`") if c else F.lit(None)).cast("bigint").alias(a) for c, a in ((file_col, "file"), (offset_col, "offset")))
        ).alias("found"),
    )
    same = rows.groupBy("node", "digest", "length").agg(F.count("*").alias("copies"), F.min("found").alias("found"))
    leaves = same.groupBy("node").agg(
        F.min("found").alias("found"),
        F.sum(F.col("length") * F.col("copies")).alias("length"),
        F.sum("copies").alias("records"),
        F.array_sort(F.collect_list(F.struct("digest", "copies"))).alias("parts"),
    )
    in_order = Window.partitionBy("file").orderBy("node")
    in_file = in_order.rowsBetween(Window.unboundedPreceding, -1)
    own_file = F.floor(F.col("node") / FILE_RECORDS)
    placed = (
        leaves.withColumn("file", F.coalesce("found.file", own_file))
        .withColumn("start", F.coalesce("found.offset", F.sum("length").over(in_file), F.lit(0)))
        .withColumn("gap", F.col("start") - F.coalesce(F.lag(F.col("start") + F.col("length")).over(in_order), F.lit(0)))
        .select(
            "node",
            # One record is its own digest; several under one number are listed.
            F.when(
                (F.size("parts") == 1) & (F.col("records") == 1), F.col("parts")[0]["digest"]
            )
            .otherwise(F.sha2(F.to_json("parts"), 256))
            .alias("digest"),
            F.col("file").alias("first_file"),
            F.col("file").alias("last_file"),
            "start",
            (F.col("start") + F.col("length")).alias("end"),
            "records",
            (F.col("file") - own_file).alias("shift"),
            "gap",
            "length",
        )
    )
    levels = [stored(placed, "merkle")]
    for _ in range(height([records], number_col, bytes_col) if top is None else top):
        levels.append(stored(_parents(levels[-1]), "merkle"))
    return Tree(tuple(levels))


def _digest(bytes_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(f"`{bytes_col}`"), F.lit(b"")), 256)


def _number(number_col: str, bytes_col: str) -> Column:
    unnumbered = -1 - F.pmod(F.xxhash64(_digest(bytes_col)), F.lit(UNNUMBERED))
    return F.coalesce(F.col(f"`{number_col}`").cast("bigint"), unnumbered)


def height(replicas: list[DataFrame], number_col: str = "number", bytes_col: str = "record") -> int:
    """Levels of nodes after which one is left, or one for either sign, over all replicas."""
    number = F.col(f"`{number_col}`").cast("bigint")
    largest = max(
        row[0] or 0
        for row in (x.agg(F.max(F.coalesce(F.abs(number), F.lit(UNNUMBERED)))).head() for x in replicas)
    )
    levels = 1
    while FANOUT**levels <= largest:
        levels += 1
    return levels


def _parents(level: DataFrame) -> DataFrame:
    children = F.array_sort(
        F.collect_list(F.struct("node", "digest", "first_file", "start", "last_file", "end", "shift", "gap", "length"))
    )
    hashed = ("node", "shift", "gap", "length", "digest")
    return (
        level.groupBy(F.floor(F.col("node") / FANOUT).alias("node"))
        .agg(
            children.alias("children"),
            F.sum("records").alias("records"),
            F.sum(F.col("gap") + F.col("length")).alias("length"),
        )
        .select(
            "node",
            F.sha2(
                F.array_join(
                    F.transform("children", lambda c: F.concat_ws(":", *(c[x].cast("string") for x in hashed))), "\n"
                ),
                256,
            ).alias("digest"),
            F.col("children")[0]["first_file"].alias("first_file"),
            F.element_at("children", -1)["last_file"].alias("last_file"),
            F.col("children")[0]["start"].alias("start"),
            F.element_at("children", -1)["end"].alias("end"),
            "records",
            F.lit(0).cast("bigint").alias("shift"),
            F.lit(0).cast("bigint").alias("gap"),
            "length",
        )
    )


def audit(expected: Tree, found: Tree) -> DataFrame:
    """The records that differ between two replicas, and where each lies in either.

    ``node`` (the record's number), ``state`` (missing, extra, changed or, where only the place differs, moved), ``file, start, end`` of the
    record where it is expected and ``found_start, found_end`` where it was found, ``expected_digest,
    found_digest``.  Equal replicas, two empty ones included, give no rows.
    """
    if expected.top != found.top:
        raise ValueError("the trees have different heights; build both with the same top")
    suspects: DataFrame | None = None
    for left, right in zip(reversed(expected.levels), reversed(found.levels)):
        if suspects is not None:
            left, right = (
                x.withColumn("parent", F.floor(F.col("node") / FANOUT)).join(suspects, "parent", "left_semi")
                for x in (left, right)
            )
        pairs = _differences(left, right)
        suspects = stored(pairs, "suspects").select(F.col("node").alias("parent"))
    return pairs


def _differences(left: DataFrame, right: DataFrame) -> DataFrame:
    a = left.select(
        "node",
        F.col("digest").alias("expected_digest"),
        F.col("first_file").alias("file"),
        "start",
        "end",
        F.struct("shift", "gap").alias("place"),
    )
    b = right.select(
        "node",
        F.col("digest").alias("found_digest"),
        F.col("start").alias("found_start"),
        F.col("end").alias("found_end"),
        F.struct("shift", "gap").alias("found_place"),
    )
    state = (
        F.when(F.col("found_digest").isNull(), "missing")
        .when(F.col("expected_digest").isNull(), "extra")
        .when(F.col("expected_digest") != F.col("found_digest"), "changed")
        .otherwise("moved")
    )
    return (
        a.join(b, "node", "full_outer")
        .filter(
            ~F.col("expected_digest").eqNullSafe(F.col("found_digest")) | ~F.col("place").eqNullSafe(F.col("found_place"))
        )
        .select("node", state.alias("state"), "file", "start", "end", "found_start", "found_end", "expected_digest", "found_digest")
    )


def audit_records(
    expected: DataFrame,
    found: DataFrame,
    number_col: str = "number",
    bytes_col: str = "record",
    file_col: str | None = None,
    offset_col: str | None = None,
) -> DataFrame:
    """Build both trees, to one height, and compare them; a replica may lack the columns of places."""
    top = height([expected, found], number_col, bytes_col)

    def tree(records: DataFrame) -> Tree:
        places = (c if c in records.columns else None for c in (file_col, offset_col))
        return build_tree(records, number_col, bytes_col, top, *places)

    return audit(tree(expected), tree(found))
