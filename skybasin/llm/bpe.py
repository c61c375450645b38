"""Byte-level BPE: encoding in batched numpy merge rounds, and decoding.

Texts are cut into pieces by the tokenizer's pattern; only pieces not met before are merged.
Their symbols stand in one flat array.  A round looks up every neighbouring pair of it by
binary search over the sorted pair keys, finds the lowest rank in each word, merges all places
of that pair in that word and lets finished words go.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from skybasin.llm.pieces import Encoded, PieceCache, chunks

#: Fixed value: the pattern that cuts text into pieces in this family of tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NEVER = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if it can be printed."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class ByteBpe:
    """A tokenizer file of the byte-level kind, without normaliser."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self._of_byte = np.array([vocab[x] for x in letters], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        keys = left << 32 | right
        self._rank = np.argsort(keys, kind="stable")
        self._keys = keys[self._rank]
        self._merged = np.array([vocab[a + b] for a, b in merges], np.int64)[self._rank]
        byte_of = {x: b for b, x in enumerate(letters)}
        self._bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self._bytes[i] = bytes(byte_of[x] for x in token)
        for token, i in self.special.items():
            self._bytes[i] = token.encode()
        self._cut = regex.compile(PATTERN).findall
        self._apart = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._cache = PieceCache(self._encode_pieces)

    def _pieces(self, text: str) -> list[str]:
        if not any(token in text for token in self.special):
            return self._cut(text)
        return [
            piece
            for part in self._apart.split(text)
            for piece in ([part] if part in self.special else self._cut(part))
        ]

    def encode(self, texts: list[str]) -> Encoded:
        """Ids of all texts, one after the other, and how many each has."""
        found = [self._cache.ids([self._pieces(x) for x in part]) for part in chunks(texts)]
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def _encode_pieces(self, pieces: list[str]) -> Encoded:
        special = np.array([self.special.get(p, -1) for p in pieces], np.int64)
        words = [b"\0" if s >= 0 else p.encode() for p, s in zip(pieces, special)]
        ids, sizes = self.merge(words)
        firsts = np.cumsum(sizes) - sizes
        ids[firsts[special >= 0]] = special[special >= 0]
        return ids, sizes

    def merge(self, words: list[bytes]) -> Encoded:
        """Ids of words that are not empty, all merged together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self._of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        while len(symbols):
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self._keys, pair), len(self._keys) - 1)
            known = (self._keys[at] == pair) & (word[1:] == word[:-1])
            rank = np.full(len(symbols), _NEVER)
            rank[:-1][known] = self._rank[at[known]]

            firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.minimum.reduceat(rank, firsts)
            runs = np.diff(np.concatenate([firsts, [len(word)]]))
            lowest = np.repeat(lowest, runs)
            over = lowest == _NEVER
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])

            # In a row of places that overlap every second one is merged, from the left.
            hit = rank == lowest
            hit &= ~over
            place = np.arange(len(symbols))
            opens = hit & ~np.concatenate([[False], hit[:-1]])
            since = place - np.maximum.accumulate(np.where(opens, place, 0))
            hit &= since % 2 == 0
            left = np.flatnonzero(hit)
            symbols[left] = self._merged[at[left]]
            stays = ~over
            stays[left + 1] = False
            symbols, word = symbols[stays], word[stays]
        if not done_words:
            return np.zeros(0, np.int64), sizes
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBpe:
    """One tokenizer for each file and Python worker."""
    return ByteBpe(path)


def encode(
    docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None
) -> DataFrame:
    """The rows with their token ids (array<int>) and, if wanted, the text decoded from those.

    A null text is an empty one and has no ids.  All other columns stay as they are; a column of
    the name of a new one is replaced.  ``path`` names the tokenizer file on every executor.
    """
    new = [ids_col, *([decoded_col] if decoded_col else [])]
    kept = [c for c in docs.columns if c not in new]
    source = docs.select(
        *(F.col(f"`{c}`") for c in kept),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("\0text"),
    )
    fields = [StructField(ids_col, ArrayType(IntegerType(), False))]
    if decoded_col:
        fields.append(StructField(decoded_col, StringType()))
    schema = StructType([docs.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded_batches(batches, path, [*kept, *(f.name for f in fields)], bool(decoded_col))

    return source.mapInArrow(run, schema)


#: Bytes of text encoded at once in a Python worker.  A slice's pieces, ids and decoded texts take
#: some 30 times that while it is worked on, in each of an executor's workers.
SLICE_BYTES = 500_000


def encoded_batches(
    batches: Iterator[pa.RecordBatch], path: str, names: list[str], decoded: bool
) -> Iterator[pa.RecordBatch]:
    """Batches of the columns before the last, the ids of the last (text) and, if wanted, their text."""
    bpe = tokenizer(path)
    for batch in batches:
        for part in slices(batch, SLICE_BYTES):
            texts = part.column(part.num_columns - 1).to_pylist()
            ids, sizes = bpe.encode(texts)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            arrays = part.columns[:-1] + [
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))
            ]
            if decoded:
                values = ids.tolist()
                arrays.append(pa.array([bpe.decode(values[a:b]) for a, b in zip(edges, edges[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names)


def slices(batch: pa.RecordBatch, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most about ``size`` bytes, a longer row alone."""
    step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids; null ids give a null text."""
    kept = [c for c in rows.columns if c != decoded_col]
    schema = StructType([rows.schema[c] for c in kept] + [StructField(decoded_col, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            ids = batch.column(kept.index(ids_col)).to_pylist()
            texts = [None if x is None else bpe.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*kept, decoded_col]
            )

    return rows.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(run, schema)


def digest(encoded: DataFrame, *others: str) -> DataFrame:
    """Counts and digests of ``ids`` and ``decoded``, and the columns named beside them."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *others,
    )
