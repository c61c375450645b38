"""Word shingles of whole texts as 64-bit hashes, computed for many texts at once with numpy.

Words are the runs between ASCII white space after lower-casing A to Z, on the UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np

#: Fixed multipliers: odd numbers without a pattern.
_BASE = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ORDER = [0xD6E8FEB86659FD93, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
#: Bytes hashed at once; a longer word is still taken whole.
SEGMENT = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base ** 0 .. size - 1, modulo 2 ** 64."""
    known = _powers.get(base, np.ones(1, np.uint64))
    while len(known) < size:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
    _powers[base] = known
    return known[:size]


def inverse_powers(base: int, size: int) -> np.ndarray:
    return powers(pow(base, -1, 1 << 64), size)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of them; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte * base ** place up to each place: any range's hash is a difference of two."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (sums[ends] - sums[starts]) * inverse_powers(_BASE, len(sums))[starts]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word in the bytes."""
    data = _LOWER[data]
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    return mix(range_hashes(prefix_sums(data), starts, ends)), starts


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The words of each text, in order."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        if not held:
            return
        firsts = np.cumsum([0, *(len(x) + 1 for x in held)])
        hashes, starts = _word_hashes(np.frombuffer(b"\n".join(held), np.uint8))
        out.extend(np.split(hashes, np.searchsorted(starts, firsts[1:-1])))
        held.clear()

    for text in texts:
        if size + len(text) > SEGMENT:
            flush()
            size = 0
        if len(text) <= SEGMENT:
            held.append(text)
            size += len(text) + 1
        else:
            out.append(_long_text(text))
    flush()
    return out


def _long_text(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    space = np.flatnonzero(_SPACE[data])
    parts, at = [], 0
    while at < len(data):
        nearest = np.searchsorted(space, at + SEGMENT)
        end = int(space[nearest]) if nearest < len(space) else len(data)
        parts.append(_word_hashes(data[at:end])[0])
        at = end
    return np.concatenate(parts)


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``width`` are one shingle, none is no shingle."""
    count = len(words)
    if not count:
        return words
    n = min(width, count)
    total = np.full(count - n + 1, n, np.uint64)
    for i in range(n):
        total += words[i : count - n + 1 + i] * np.uint64(_ORDER[i % len(_ORDER)] + 2 * (i // len(_ORDER)))
    return np.unique(mix(total))
