"""MinHash near-dedup: bands for candidates, b-bit signatures for estimates, full sets for links.

1.  Each text becomes its set of word shingles and ``HASHES`` minima over it.  The first
    minima, as many as the threshold takes, make the band keys; the ``BITS`` low bits of all minima are packed
    into a signature.  Texts with equal sets are one class, which goes on as one of its rows.
2.  Classes that share a band key are candidates.  How many places of two signatures differ, by
    xor and bit counts, gives their similarity; of the differing share of minima only
    ``1 - 2 ** -BITS`` show in the low bits, which the threshold on counts takes into account.
3.  Each bucket of a band names a centre, at first its member with most bucket mates.  In a round a
    class is compared with one of its buckets' centres; what is linked becomes a component, and the next
    round, with other centres, is only for buckets that still hold several components.  So there are no
    more pairs than classes in a round, and a group of copies is mostly joined by that.
4.  Members of one bucket that are still in different components are compared with each other, on
    the full sets where their signatures allow a link.  That join emits only links.
5.  Every link is confirmed on the full sets.

Ids may repeat or be null: inside, a row is its number in the stored sketches, and its id and a
128-bit hash of its text where texts are read again.

A pair at the threshold is missed by all bands with probability ``MISS`` at most, and its signatures
are off by more than ``SIGMAS`` standard deviations with 3e-7; closer pairs are safer.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin.llm.bpe import slices
from skybasin.llm.common import stored, text_of
from skybasin.llm.components import components
from skybasin.llm.shingles import mix, shingle_set, word_hashes

HASHES, BITS = 512, 2
#: Rows of a band where there are minima for it, and the chance that all bands miss a pair at the threshold.
ROWS, MISS = 4, 2.1e-8
SIGMAS = 5
#: Rounds in which a class is compared with one centre each.
ROUNDS = 5
#: Rounds end, and all that is left is compared, when no more than one pair in so many is a link.
WORTH = 20
_WORDS = HASHES * BITS // 64
_SIGNATURE = [f"s{i}" for i in range(_WORDS)]

_random = np.random.default_rng(20240229)
_XOR = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_MULTIPLY = (_random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1))[:, None]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(values), 256):
        part = (values[at : at + 256] ^ _XOR) * _MULTIPLY
        np.minimum(lowest, part.min(axis=1), out=lowest)
    return lowest


def bands_for(percent: int) -> tuple[int, int]:
    """Bands, and rows of a band, that miss a pair of this similarity with probability ``MISS`` at most."""
    for rows in range(ROWS, 0, -1):
        same = (percent / 100) ** rows
        bands = 1 if same >= 1 else math.ceil(math.log(MISS) / math.log1p(-same)) if same > 0 else HASHES + 1
        if bands * rows <= HASHES:
            return bands, rows
    raise ValueError(f"{HASHES} minima are too few for pairs of {percent} percent")


def _keys_and_bits(lowest: np.ndarray, percent: int = 85) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed signatures of a (documents, HASHES) array of minima."""
    count, rows = bands_for(percent)
    bands = lowest[:, : count * rows].astype(np.uint64).reshape(-1, count, rows)
    keys = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), bands.shape[:2])
    for row in range(rows):
        keys = mix(keys ^ (bands[:, :, row] + np.uint64(row << 40)))
    low = mix(lowest.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    shifts = (np.arange(HASHES, dtype=np.uint64) % np.uint64(64 // BITS)) * np.uint64(BITS)
    packed = np.bitwise_or.reduce((low << shifts).reshape(len(lowest), _WORDS, -1), axis=2)
    return keys.view(np.int64), packed.view(np.int64)


_SKETCH = (
    "row bigint, doc_id bigint, text_md5 string, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, "
    + ", ".join(f"{s} bigint" for s in _SIGNATURE)
)


def _sketch(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SKETCH.split(", ")]
    for batch in batches:
        for part in slices(batch):
            sets = [shingle_set(w, width) for w in word_hashes(_utf8(part.column(3)))]
            keys, packed = _keys_and_bits(np.stack([minima(s) for s in sets]), percent)
            # Two sums over the set, each of a different mix: 128 bits that stand for the set.
            first = [int(mix(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
            second = [int(mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
            edges = pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:3],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(first, np.uint64).view(np.int64)),
                    pa.array(np.array(second, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(edges, pa.array(keys.ravel())),
                    *(pa.array(packed[:, i].copy()) for i in range(_WORDS)),
                ],
                names,
            )


def _utf8(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Sets of (id, text) rows; of neighbours with one id, which have one text, the first is enough."""
    before = None
    for batch in batches:
        ids = batch.column(0).to_pylist()
        fresh = [a != b for a, b in zip(ids, [before, *ids])]
        before = ids[-1] if ids else before
        for part in slices(batch.filter(pa.array(fresh, pa.bool_()))):
            sets = [shingle_set(w, width).view(np.int64) for w in word_hashes(_utf8(part.column(1)))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"]
            )


def may_link(left: str, right: str, percent: int) -> Column:
    """Whether sizes and signatures of two rows allow a similarity of ``percent``."""
    similarity = percent / 100
    seen = (1 - 2.0**-BITS) * (1 - similarity)
    most = math.floor(HASHES * seen + SIGMAS * math.sqrt(HASHES * seen * (1 - seen)))
    places = F.lit(int("01" * 32, 2)).cast("bigint")
    differ = [F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}")) for s in _SIGNATURE]
    counts = [F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(places)) for x in differ]
    small = F.least(F.col(f"{left}.n"), F.col(f"{right}.n"))
    large = F.greatest(F.col(f"{left}.n"), F.col(f"{right}.n"))
    return (100 * small >= percent * large) & (functools.reduce(operator.add, counts) <= most)


def _identity(id_col: str, text_col: str) -> list[Column]:
    """What a row is known by where it is read again: its id, which may be null, and its text."""
    return [
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.md5(text_of(F.col(f"`{text_col}`")).cast("binary")).alias("text_md5"),
    ]


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every id.

    As ``near_duplicate_rows``, with the rows that repeat an id taken as one document: it has the size
    of the longest set and is linked to what any of its rows is linked to.  Rows with a null id are left out.
    """
    rows = near_duplicate_rows(docs.filter(F.col(f"`{id_col}`").cast("bigint").isNotNull()), percent, width, id_col, text_col)
    rows = stored(rows, "rows")
    final = components(rows.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")))
    return (
        rows.groupBy("doc_id")
        .agg(F.max("n_shingles").alias("n_shingles"))
        .join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )


def near_duplicate_rows(
    docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Rows are linked when 100 * shared shingles >= percent * shingles of either; a component is what
    links connect, named by its smallest id (null if it has no other).  One row of it is kept: one
    with that id, of several the one with the smallest hash of the text.  Rows that repeat an id are
    rows of their own.  Texts with fewer than ``width`` words are one shingle; an empty or null text
    has none and no link.  An empty table gives no rows.  Other columns are not read.
    """
    return _grouped(docs, percent, width, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicate_rows`` with the hash of the text."""
    rows = docs.select(*_identity(id_col, text_col), text_of(F.col(f"`{text_col}`")).alias("text"))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_md5", "text")

    # Numbers hold from here on, as they are read from the stored rows.
    sketches = stored(numbered.mapInArrow(lambda x: _sketch(x, width, percent), _SKETCH), "sketches")
    full = sketches.filter("n_shingles > 0")
    sets = ["set_a", "set_b", "n_shingles"]
    # The first of a class: by id, null last, then by text; its row number is the class.
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_md5", "row")
    classes = full.groupBy(*sets).agg(F.min(place).alias("first")).withColumn("class", F.col("first.row"))
    firsts = full.join(classes.select(F.col("class").alias("row")), "row", "left_semi").select(
        F.col("row").alias("id"), "doc_id", "text_md5", F.col("n_shingles").alias("n"), "bands", *_SIGNATURE
    )

    # Buckets of two or more classes, and how many mates each class has over all bands.
    placed = firsts.select("id", F.posexplode("bands").alias("band", "key"))
    shared = placed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(placed.join(shared, "key"), "buckets")
    mates = members.groupBy("id").agg(F.sum("size").alias("mates"))
    signatures = stored(firsts.join(mates, "id"), "signatures")
    # Merged at every size: with a plan that changes with the size, costs can't be foreseen.
    wanted = signatures.select("id", F.col("doc_id").alias("of"), F.col("text_md5").alias("hash"))
    texts = rows.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_md5") == F.col("hash")))
    shingles = stored(
        texts.select("id", "text").mapInArrow(lambda x: _full_sets(x, width), "id bigint, shingles array<bigint>"),
        "shingles",
    )

    # Buckets are read again in each round: what is still open is stored, so that later rounds read less.
    rows = stored(members.join(signatures.select("id", "mates"), "id").withColumn("component", F.col("id")), "open")
    links = None
    for turn in range(ROUNDS):
        pairs = stored(_spokes(rows, turn), "spokes")
        linked = stored(_confirm(_likely(pairs, signatures, percent), shingles, percent).filter("linked"), "tests")
        links = linked if links is None else links.unionByName(linked)
        if turn and linked.count() * WORTH <= pairs.count():
            break
        rows = stored(_open(rows, components(links)), "open")

    # Buckets that still hold several components.
    # The sets travel with the rows, so that only links leave the join: of texts that are alike, but not
    # enough, a bucket has as many pairs as the square of its size.
    open_rows = rows.select("key", "band", "id", "component").join(signatures, "id").join(shingles, "id")
    left, right = open_rows.alias("l"), open_rows.alias("r")
    both = F.size(F.array_intersect("l.shingles", "r.shingles"))
    across = left.join(
        right,
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.id") < F.col("r.id"))
        & (F.col("l.component") != F.col("r.component"))
        & may_link("l", "r", percent)
        # A pair comes from the first of the bands that it shares.
        & ~F.arrays_overlap(F.expr("slice(l.bands, 1, l.band)"), F.expr("slice(r.bands, 1, r.band)"))
        & (100 * both >= percent * (F.size("l.shingles") + F.size("r.shingles") - both)),
    ).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    final = components(links.select("a", "b").union(across)).select(F.col("id").alias("class"), "component")

    # The first of a component, for the classes that have links; other classes have their own.
    linked = classes.select("class", "first").join(final, "class")
    heads = linked.groupBy("component").agg(F.min("first").alias("head"))
    moved = linked.join(heads, "component").select("class", "head")
    named = classes.join(moved, "class", "left").select(*sets, F.coalesce("head", "first").alias("head"))
    found = full.join(named, sets).select(
        "doc_id",
        "text_md5",
        "n_shingles",
        F.col("head.doc_id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("kept"),
    )
    empty = sketches.filter("n_shingles = 0")
    return found.union(
        empty.select("doc_id", "text_md5", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    )


def _open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with their new component, of the buckets that hold several components; others never do again."""
    named = labels.select("id", F.col("component").alias("now"))
    labelled = rows.join(named, "id", "left").withColumn("component", F.coalesce("now", "id")).drop("now")
    mixed = labelled.groupBy("key").agg(
        F.min("component").alias("lowest"), F.max("component").alias("highest")
    ).filter("lowest < highest")
    return labelled.join(mixed.select("key"), "key")


def _spokes(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs to compare in a round: each class with one member of another component in one of its open buckets.

    A bucket's centre is at first its member with most mates, in later rounds another one each time.
    Of its buckets' centres a class takes the one that is centre to most, so there are no more pairs than classes.
    A centre ranks above the classes that take it, so no pair comes twice in a round.
    """
    rank = F.col("mates") if not turn else F.xxhash64(F.lit(turn), "id")
    centres = rows.groupBy("key").agg(
        F.max(F.struct(rank.alias("rank"), F.col("id").alias("centre"), F.col("component").alias("other"))).alias("c")
    )
    pairs = rows.select("key", "id", "component").join(centres.select("key", "c.*"), "key").filter("component <> other")
    best = pairs.groupBy("id").agg(F.max(F.struct("rank", "centre")).alias("best"))
    return best.select(F.col("best.centre").alias("a"), F.col("id").alias("b"))


def _likely(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures allow a link."""
    left = signatures.select(F.col("id").alias("a"), F.struct("n", *_SIGNATURE).alias("l"))
    right = signatures.select(F.col("id").alias("b"), F.struct("n", *_SIGNATURE).alias("r"))
    return pairs.join(right, "b").join(left, "a").filter(may_link("l", "r", percent)).select("a", "b")


def _confirm(pairs: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked``: the exact test on the full sets."""
    left = shingles.select(F.col("id").alias("a"), F.col("shingles").alias("l"))
    right = shingles.select(F.col("id").alias("b"), F.col("shingles").alias("r"))
    both = F.size(F.array_intersect("l", "r"))
    either = F.size("l") + F.size("r") - both
    return pairs.join(right, "b").join(left, "a").select("a", "b", (100 * both >= percent * either).alias("linked"))


def drop_near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    width: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    null_ids_stay: bool = True,
) -> DataFrame:
    """The rows that stay, with the columns they came with: one of each component, all without shingles.

    Rows with a null id stay and keep no other row from staying; with ``null_ids_stay`` false they
    are rows like all others, after those with an id.  Of rows equal in id and text any one stays.
    """
    named = docs.filter(F.col(f"`{id_col}`").cast("bigint").isNotNull()) if null_ids_stay else docs
    found = _grouped(named, percent, width, id_col, text_col).filter("n_shingles > 0")
    verdicts = stored(
        found.groupBy("doc_id", "text_md5")
        .agg(F.max("kept").alias("kept"), F.count("*").alias("copies"))
        .filter("NOT kept OR copies > 1"),
        "verdicts",
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        *(x.alias(a) for x, a in zip(_identity(id_col, text_col), ["of", "hash"])),
    )
    same = F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_md5"))
    left = rows.join(verdicts, same, "left_anti")
    repeated = verdicts.filter("kept")
    if not repeated.isEmpty():
        left = left.union(rows.join(repeated, same, "left_semi").dropDuplicates(["of", "hash"]))
    return left.select("row.*")
