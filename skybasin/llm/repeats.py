"""Repeated byte windows, by a depth-limited radix sort from the most significant digit.

Only windows of ``THRESHOLD`` bytes matter, so suffixes are told apart to that depth and no
further: equal groups at that depth are exactly the repeated windows.

To keep suffixes together while they can't be told apart, a pass works on *ranges*: neighbouring
windows of one document that share a digit.  The first digit of a window is its anchor, the
``GRAM`` bytes in it with the smallest hash (the leftmost of equals); it depends on the window's
bytes alone, so equal windows have equal anchors at equal offsets.  Windows of one anchor are one
range.  A pass groups ranges by the bytes that all their windows have in common, its digit:

* a digit that occurs once: no window of the range is repeated, the range is done;
* a range whose bytes from first to last window occur as a whole elsewhere: all its windows are
  repeated, the range is done (one of the equal ranges goes on to be compared with others);
* else the range is cut into shorter ones, whose digit reaches deeper.

``WIDTHS`` are the lengths of ranges; with the last, one window, the digit is the window.  The
cuts are at fixed offsets from the anchor, so equal windows are always in ranges of one digit.
Passes shuffle hashes and places, not texts, and count digits with partial aggregates, so a passage that a third
of all documents share is no hot group.  Digits are 128-bit hashes of the bytes from the second pass on, as are
whole ranges in every pass; the first digit only sorts out windows and may collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin.llm.bpe import slices
from skybasin.llm.common import stored, text_of
from skybasin.llm.shingles import mix, prefix_sums, range_hashes

THRESHOLD = 400
GRAM = 64
WIDTHS = (48, 8, 1)
#: Windows looked at together; a longer text is taken in segments of this size.
SEGMENT = 1 << 18

#: Rows may repeat an id: a text is known by its id, a 64-bit hash (its version) and its length.
_TEXT = ["doc", "version", "length"]
#: A place is a text and a window in it.
_PLACE = [*_TEXT, "base", "anchor", "start", "windows"]
_DIGIT = ["digit_a", "digit_b"]
_WHOLE = ["whole_a", "whole_b"]
_RANGES = (
    "doc bigint, version bigint, length int, base int, anchor int, start int, windows int, "
    "digit_a bigint, digit_b bigint, whole_a bigint, whole_b bigint"
)
_NAMES = [x.split()[0] for x in _RANGES.split(", ")]
_TYPES = [pa.int64(), pa.int64(), *[pa.int32()] * 5, *[pa.int64()] * 4]


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by running minima within blocks."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def anchored_ranges(data: bytes, threshold: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """First window, number of windows, anchor and its hash for each range of a text."""
    raw = np.frombuffer(data, np.uint8)
    span = threshold - gram + 1
    place_bits = np.uint64((SEGMENT + threshold).bit_length())
    for at in range(0, len(raw) - threshold + 1, SEGMENT):
        part = raw[at : at + SEGMENT + threshold - 1]
        sums = prefix_sums(part)
        starts = np.arange(len(part) - gram + 1)
        hashes = mix(range_hashes(sums, starts, starts + gram))
        # High bits decide, the place breaks ties to the left.
        ranked = hashes >> place_bits << place_bits | starts.astype(np.uint64)
        anchors = (_lowest(ranked, span) & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
        firsts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        sizes = np.diff(np.concatenate([firsts, [len(anchors)]]))
        anchor = anchors[firsts]
        yield firsts + at, sizes, anchor + at, hashes[anchor]


def _halves(data: bytes) -> tuple[int, int]:
    """128 bits for a string of bytes, as two signed numbers."""
    value = xxhash.xxh3_128_intdigest(data)
    low, high = value & (1 << 64) - 1, value >> 64
    return low - (low >> 63 << 64), high - (high >> 63 << 64)


def _first_ranges(batches: Iterator[pa.RecordBatch], threshold: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Every text as ranges of windows with one anchor; the digit is the anchor's hash."""
    for batch in batches:
        for part in slices(batch):
            found: list[tuple[np.ndarray, ...]] = []
            wholes: list[tuple[int, int]] = []
            docs, versions, lengths, texts = part.columns
            for doc, version, length, text in zip(
                docs.to_pylist(), versions.to_pylist(), lengths.to_pylist(), texts.cast(pa.binary()).to_pylist()
            ):
                for starts, sizes, anchors, hashes in anchored_ranges(text, threshold, gram):
                    same = np.ones(len(starts), np.int64)
                    text_key = (doc * same, version * same, length * same)
                    found.append((*text_key, starts, anchors, starts, sizes, hashes.view(np.int64), 0 * same))
                    ends = (starts + sizes + threshold - 1).tolist()
                    wholes += [_halves(text[a:b]) for a, b in zip(starts.tolist(), ends)]
            if found:
                columns = [*(np.concatenate(c) for c in zip(*found)), *zip(*wholes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c).cast(t) for c, t in zip(columns, _TYPES)], _NAMES
                )


def cut(start: int, windows: int, anchor: int, width: int) -> Iterator[tuple[int, int, int]]:
    """Parts of a range: first window, number of windows, and the last window of the part's cell.

    A cell is the windows that begin ``cell * width`` to ``(cell + 1) * width - 1`` bytes before the
    anchor.  Its digit is what all of them share, also where the range covers the cell in part.
    """
    last = start + windows - 1
    for cell in range((anchor - last) // width, (anchor - start) // width + 1):
        lowest, highest = anchor - (cell + 1) * width + 1, anchor - cell * width
        first = max(lowest, start)
        yield first, min(highest, last) - first + 1, highest


def _deeper(batches: Iterator[pa.RecordBatch], threshold: int, width: int) -> Iterator[pa.RecordBatch]:
    """Cut the open ranges of each piece of text and hash what the next digit is made of."""
    for batch in batches:
        for part in slices(batch):
            rows: list[tuple] = []
            for doc, version, length, base, anchor, text, ranges in zip(*(c.to_pylist() for c in part.columns)):
                for one in ranges:
                    for first, count, highest in cut(one["start"], one["windows"], anchor, width):
                        digit = text[highest - base : highest - base + threshold - width + 1]
                        whole = text[first - base : first - base + count + threshold - 1]
                        rows.append(
                            (doc, version, length, base, anchor, first, count, *_halves(digit), *_halves(whole))
                        )
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES
                )


def _pass(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ranges that are repeated as a whole, and one of each kind whose digit has several."""
    wholes = stored(
        ranges.groupBy(*_DIGIT, *_WHOLE).agg(
            F.count("*").alias("copies"), F.min(F.struct(*_PLACE)).alias("first")
        ),
        "wholes",
    )
    several = wholes.groupBy(*_DIGIT).agg(F.count("*").alias("kinds")).filter("kinds > 1")
    still_open = wholes.join(several, _DIGIT, "left_semi").select("first.*")
    known = wholes.filter("copies > 1").select(*_DIGIT, *_WHOLE)
    repeated = ranges.join(known, [*_DIGIT, *_WHOLE], "left_semi").select(*_TEXT, "start", "windows")
    return stored(repeated, "repeated"), stored(still_open, "open")


def remove_repeats(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    gram: int = GRAM,
    widths: tuple[int, ...] = WIDTHS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` for every row.

    ``spans`` are the maximal runs (start, end) of bytes covered by a string of ``threshold`` bytes
    that also starts elsewhere, in this or another row; ``kept`` is what is left, as bytes, since a
    run may begin or end inside a character.  A null text is an empty one; a text shorter than the
    threshold keeps everything.  Rows that repeat an id are rows of their own, and equal texts
    repeat each other; a null id stays null.  An empty table gives no rows.  Other columns are not read.
    """
    if widths[-1] != 1 or not 0 < gram <= threshold:
        raise ValueError("the last width is 1, and an anchor lies within a window")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(text_of(F.col(f"`{text_col}`"))).alias("version"),
        F.octet_length(text_of(F.col(f"`{text_col}`"))).alias("length"),
        text_of(F.col(f"`{text_col}`")).alias("text"),
    )
    long_rows = rows.filter(F.col("length") >= threshold).select(*_TEXT, "text")

    ranges = stored(long_rows.mapInArrow(lambda x: _first_ranges(x, threshold, gram), _RANGES), "ranges")
    repeated, still_open = _pass(ranges)
    found = [repeated]

    # The texts of the open ranges, once; later passes cut these.
    wanted = still_open.groupBy(*_TEXT).agg(
        F.collect_set(F.struct("base", "anchor", "windows")).alias("pieces")
    )
    pieces = stored(
        long_rows.join(wanted, _TEXT)
        .select(*_TEXT, F.col("text").cast("binary").alias("raw"), F.explode("pieces").alias("p"))
        .select(
            *_TEXT,
            "p.base",
            "p.anchor",
            F.expr(f"substring(raw, p.base + 1, p.windows + {threshold - 1})").alias("piece"),
        ),
        "pieces",
    )
    for width in widths:
        grouped = still_open.groupBy(*_TEXT, "base").agg(
            F.collect_set(F.struct("start", "windows")).alias("ranges")
        )
        texts = pieces.join(grouped, [*_TEXT, "base"]).select(
            *_TEXT, "base", "anchor", "piece", "ranges"
        )
        ranges = stored(texts.mapInArrow(lambda x, w=width: _deeper(x, threshold, w), _RANGES), "ranges")
        repeated, still_open = _pass(ranges)
        found.append(repeated)

    covered = found[0]
    for more in found[1:]:
        covered = covered.unionByName(more)
    runs = covered.groupBy(*_TEXT).agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    marked = rows.join(runs, _TEXT, "left").select("doc_id", "text", "runs")
    schema = (
        "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    )
    return marked.mapInArrow(lambda x: _cut_out(x, threshold), schema)


def _spans(runs: list[dict], threshold: int) -> list[dict[str, int]]:
    """Maximal runs of covered bytes."""
    spans: list[dict[str, int]] = []
    for start, windows in sorted((r["start"], r["windows"]) for r in runs):
        end = start + windows - 1 + threshold
        if spans and start <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], end)
        else:
            spans.append({"start": start, "end": end})
    return spans


def _cut_out(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    places = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), places, pa.binary()]
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    for batch in batches:
        for part in slices(batch):
            rows = []
            ids, texts, runs = part.columns
            for doc_id, text, own in zip(ids.to_pylist(), texts.cast(pa.binary()).to_pylist(), runs.to_pylist()):
                spans = _spans(own or [], threshold)
                edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((doc_id, len(text), len(text) - len(kept), spans, kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
