"""Token ids of many texts by way of their distinct pieces, held in a bounded cache."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bounds of a cache in one Python worker; a full cache starts anew.
MAX_PIECES = 400_000
MAX_CHARS = 8_000_000
#: The same for a cache of Arrow pieces.
MAX_BYTES = 32_000_000
#: Characters of text cut into pieces at once.
CHUNK_CHARS = 1_000_000

#: Ids of all pieces one after the other, and how many each piece has.
Encoded = tuple[np.ndarray, np.ndarray]


class PieceCache:
    """Ids of pieces already met; ``encode`` turns a list of new pieces into ids."""

    def __init__(self, encode: Callable[[list], Encoded], most: int = MAX_PIECES):
        self._encode, self._most = encode, most
        self._clear()

    def _clear(self) -> None:
        self._code: dict[str | bytes, int] = {}
        self._chars = 0
        self._flat = np.zeros(1 << 16, np.int32)
        self._start = np.zeros(1 << 16, np.int64)
        self._size = np.zeros(1 << 16, np.int32)
        self._used = 0

    def _add(self, pieces: list) -> None:
        first, last = len(self._code), len(self._code) + len(pieces)
        self._keep(pieces, first)
        self._chars += sum(map(len, pieces))
        self._code.update(zip(pieces, range(first, last)))

    def _keep(self, pieces: list, first: int) -> None:
        """Encode pieces whose numbers start with ``first``."""
        ids, sizes = self._encode(pieces)
        last = first + len(pieces)
        self._flat = _room(self._flat, self._used + len(ids))
        self._start, self._size = _room(self._start, last), _room(self._size, last)
        self._flat[self._used : self._used + len(ids)] = ids
        self._size[first:last] = sizes
        self._start[first:last] = self._used + np.cumsum(sizes) - sizes
        self._used += len(ids)

    def codes(self, pieces: list) -> np.ndarray:
        """A number for each piece; new pieces are encoded.  It holds until the next call."""
        # The cache holds what the bounds allow and, beyond them, the pieces of one call.
        if len(self._code) > self._most or self._chars > MAX_CHARS:
            self._clear()
        missing = set(pieces).difference(self._code)
        if missing:
            self._add(list(missing))
        return np.fromiter(map(self._code.__getitem__, pieces), np.int64, len(pieces))

    def of(self, codes: np.ndarray) -> Encoded:
        """Ids of the pieces with these numbers, and how many each has."""
        sizes = self._size[codes].astype(np.int64)
        ends = np.cumsum(sizes)
        shift = np.repeat(self._start[codes] - ends + sizes, sizes)
        return self._flat[np.arange(len(shift)) + shift], sizes

    def ids(self, texts: list[list]) -> Encoded:
        """Ids of texts that are given as lists of pieces (str or bytes), and how many each has."""
        ids, sizes = self.of(self.codes(list(chain.from_iterable(texts))))
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(edges)


class ArrowCache(PieceCache):
    """Ids of pieces that come as Arrow arrays, compared by Arrow's hash tables, byte for byte."""

    def _clear(self) -> None:
        super()._clear()
        self._known = pa.array([], pa.binary())

    def ids_of(self, pieces: pa.BinaryArray) -> Encoded:
        """Ids of all pieces one after the other, and how many each has."""
        if len(self._known) > self._most or self._known.nbytes > MAX_BYTES:
            self._clear()
        found = pieces.dictionary_encode()
        codes = pc.index_in(found.dictionary, value_set=self._known)
        new = found.dictionary.filter(pc.is_null(codes))
        codes = codes.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        if len(new):
            first = len(self._known)
            self._keep(new.to_pylist(), first)
            codes[codes < 0] = np.arange(first, first + len(new))
            self._known = pa.concat_arrays([self._known, new])
        return self.of(codes[found.indices.to_numpy(zero_copy_only=False)])


def _room(array: np.ndarray, wanted: int) -> np.ndarray:
    if wanted <= len(array):
        return array
    grown = np.zeros(max(wanted, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


def chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    """Runs of texts of about CHUNK_CHARS characters; a longer text stands alone."""
    held: list[str] = []
    chars = 0
    for text in texts:
        if held and chars + len(text) > CHUNK_CHARS:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held
