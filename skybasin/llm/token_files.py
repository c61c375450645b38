"""Token ids in files: a shared zstandard dictionary, one frame per document, an offset index.

A file set is two Parquet folders, so that Spark commits, lists and prunes it anywhere:

``dictionary``
    one row: ``hash`` (SHA-256 of the dictionary), ``data``, ``width`` (bytes of one id).
``blocks``
    one row per block of neighbouring documents, in order of ``shard, block``:
    ``doc_ids`` (ascending), ``n_tokens``, ``ends`` (the index: where each frame of ``payload``
    ends), ``payload`` (the frames), ``dictionary_hash``, ``first_id, last_id, tokens``.

A frame holds one document's ids as little-endian unsigned integers, so a short document costs
one small frame to read; the dictionary makes up for what a small frame can't learn.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skybasin.llm.bpe import slices
from skybasin.llm.common import stored, text_of
from skybasin.llm.pieces import ArrowCache, Encoded, PieceCache
from skybasin.llm.shingles import _SPACE

#: The dictionary is trained on at most this many pieces of documents, and characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 500, 8_000
DICTIONARY_BYTES = 64 * 1024
#: A block is closed when its frames reach this size.
BLOCK_BYTES = 1 << 20
LEVEL = 1
#: Bounds of the caches of words and of their parts in one Python worker.
MAX_WORDS, MAX_PARTS = 2_000_000, 800_000
#: Parts of words in one text for the library.
GROUP = 64

BLOCKS = (
    "shard int, block int, first_id bigint, last_id bigint, tokens bigint, doc_ids array<bigint>, "
    "n_tokens array<bigint>, ends array<bigint>, payload binary, dictionary_hash string"
)


#: Words whose normal form keeps every character's kind: ASCII and the letters of Latin-1.
_PLAIN = regex.compile("[\\x00-\\x7F\\xC0-\\xD6\\xD8-\\xF6\\xF8-\\xFF]*").fullmatch


class WordTokenizer:
    """A tokenizer that drops white space, called once for each distinct word.

    Its normaliser and its pattern work between white space only, so the ids of a text are those
    of its words one after the other.  ``encode`` makes the tokenizers library encode the words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self.width = 2 if self._library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._is_end, self._cut = self._word_ends(path)
        self._special_bytes = [s.lower().encode() for s in self._special]
        self._lowers = self._library.normalizer is not None and self._library.normalizer.normalize_str("AZ") == "az"
        self._cache = ArrowCache(self._encode_words, MAX_WORDS)
        self._parts = PieceCache(self._encode_parts, MAX_PARTS)

    @staticmethod
    def _word_ends(path: str):
        """Which tokens end a part of a word, and the pattern that cuts words into parts, if there are any."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"].get("end_of_word_suffix")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        patterns = [x["pattern"]["Regex"] for x in steps if x["type"] == "Split" and "Regex" in x["pattern"]]
        if not suffix or len(patterns) != 1:
            return None, None
        vocab = spec["model"]["vocab"]
        is_end = np.zeros(max(vocab.values()) + 1, bool)
        is_end[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return is_end, regex.compile(f"{patterns[0]}| ").findall

    def _encode_words(self, words: list[bytes]) -> Encoded:
        """Plain words by way of their parts, cut in one go; the others one by one."""
        joined = b" ".join(words).decode()
        if self._is_end is None or any(s in joined for s in self._special):
            return self._one_by_one([w.decode() for w in words])
        if not _PLAIN(joined):
            texts = joined.split(" ")
            plain = np.array([bool(_PLAIN(x)) for x in texts])
            others, other_sizes = self._one_by_one([x for x, p in zip(texts, plain) if not p])
            ids, own = self._by_parts(" ".join([x for x, p in zip(texts, plain) if p]))
            sizes = np.zeros(len(words), np.int64)
            sizes[plain], sizes[~plain] = own, other_sizes
            out = np.empty(int(sizes.sum()), np.int64)
            from_plain = np.repeat(plain, sizes)
            out[from_plain], out[~from_plain] = ids, others
            return out, sizes
        return self._by_parts(joined)

    def _by_parts(self, joined: str) -> Encoded:
        """Words that a blank separates: a blank is a part without ids that ends a word."""
        if not joined:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts = self._cut(joined.lower())
        ids, sizes = self._parts.of(self._parts.codes(parts))
        blank = np.fromiter((x == " " for x in parts), bool, len(parts))
        ends = np.concatenate([np.flatnonzero(blank), [len(parts)]])
        return ids, np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(sizes)])[ends]]))

    def _encode_parts(self, parts: list[str]) -> Encoded:
        """Many parts in one call, which costs more than a part; each ends in a token of a kind of its own."""
        if " " in parts:
            ids, sizes = self._encode_parts([x for x in parts if x != " "])
            return ids, np.insert(sizes, parts.index(" "), 0)
        groups = [" ".join(parts[at : at + GROUP]) for at in range(0, len(parts), GROUP)]
        found = self._library.encode_batch(groups, add_special_tokens=False)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids = np.concatenate([np.array(x.ids, np.int64) for x in found])
        ends = np.flatnonzero(self._is_end[ids])
        if len(ends) != len(parts):
            return self._one_by_one(parts)
        return ids, np.diff(np.concatenate([[-1], ends]))

    def _one_by_one(self, texts: list[str]) -> Encoded:
        found = [x.ids for x in self._library.encode_batch(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([i for x in found for i in x], np.int64), sizes

    def _lower(self, text: str) -> bytes:
        """A to Z as a to z, which the normaliser does anyway, unless that would make a special token."""
        raw = text.encode()
        if not self._lowers:
            return raw
        low = raw.lower()
        return raw if any(s in low for s in self._special_bytes) else low

    def encode(self, texts: pa.Array) -> Encoded:
        """Ids of all texts one after the other, and how many each has; the texts are one of Spark's batches."""
        raw = texts.cast(pa.binary()).to_pylist()
        joined = b"\n".join(raw)
        if self._lowers:
            low = joined.lower()
            special = any(s in low for s in self._special_bytes)
            joined = b"\n".join(self._lower(x.decode()) for x in raw) if special else low
        # Words end at ASCII white space and nowhere else.
        data = np.frombuffer(joined, np.uint8)
        inside = np.concatenate([[False], ~_SPACE[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        words = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[inside[1:-1]])]
        )
        ids, sizes = self._cache.ids_of(words)
        firsts = np.cumsum([0, *(len(x) + 1 for x in raw)])
        counts = np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, firsts)])
        return ids, counts


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of at most DICTIONARY_BYTES; empty where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _sample(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """At most SAMPLE_DOCS pieces of at most SAMPLE_CHARS characters, from anywhere in texts of any id, null included."""
    text = text_of(F.col(f"`{text_col}`"))
    # Rows are told apart by id and length, so that rows without an id are drawn like all others.
    draw = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("bigint"), F.octet_length(text)), F.lit(1 << 40))
    rows = docs.select(draw.alias("draw"), text.alias("text"))
    found = docs.count()
    if found > 4 * SAMPLE_DOCS:
        rows = rows.filter(F.col("draw") < int((1 << 40) * 2 * SAMPLE_DOCS / found))
    start = F.pmod(F.xxhash64("draw"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)).cast("int")
    piece = F.substring(F.col("text"), start + 1, F.lit(SAMPLE_CHARS))
    return [r.piece for r in rows.select("draw", piece.alias("piece")).orderBy("draw", "piece").limit(SAMPLE_DOCS).collect()]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every whole text, add ``end_id`` to each and write the file set to ``folder``.

    Documents are written in ascending order of id, equal ids in order of their text, a null id
    first.  A null text is an empty one and holds the end id alone.  An empty table gives a file
    set without blocks.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(F.col(f"`{text_col}`")).alias("text"))

    words = tokenizer(tokenizer_path)
    kind = f"<u{words.width}"
    samples = _sample(docs, id_col, text_col)
    ids, counts = words.encode(pa.array(samples, pa.string()))
    ends = np.cumsum(counts)
    dictionary = train_dictionary([ids[a:b].astype(kind).tobytes() for a, b in zip(ends - counts, ends)])
    fingerprint = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame(
        [(fingerprint, bytearray(dictionary), words.width)], "hash string, data binary, width int"
    ).coalesce(1).write.option("compression", "none").parquet(f"{folder}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path)
        known = _dictionary(dictionary)
        pack = zstandard.ZstdCompressor(level=LEVEL, **({"dict_data": known} if known else {})).compress
        shard, block = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in frames]).tolist()
            row = (shard, block, ids[0], ids[-1], sum(counts), ids, counts, ends, b"".join(frames), fingerprint)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _ARROW)], _NAMES)

        for batch in batches:
            for part in slices(batch):
                tokens, sizes = encoder.encode(part.column(1))
                places = np.cumsum(sizes)
                flat = memoryview(np.insert(tokens, places, end_id).astype(kind).tobytes())
                stops = (places + np.arange(1, len(sizes) + 1)) * encoder.width
                start = 0
                for doc_id, size, stop in zip(part.column(0).to_pylist(), sizes.tolist(), stops.tolist()):
                    frame = pack(flat[start:stop])
                    start = stop
                    ids.append(doc_id)
                    counts.append(size + 1)
                    frames.append(frame)
                    held += len(frame)
                    if held >= BLOCK_BYTES:
                        yield close()
                        ids, counts, frames, held, block = [], [], [], 0, block + 1
        if ids:
            yield close()

    # Rows without an id, or of one id, are dealt out by how their texts begin.
    dealt = rows.withColumn("begins", F.substring("text", 1, 16)).repartitionByRange("doc_id", "begins").drop("begins")
    in_order = dealt.sortWithinPartitions("doc_id", "text")
    in_order.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


_NAMES = [x.split()[0] for x in BLOCKS.split(", ")]
_ARROW = [
    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
    pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.string(),
]


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, read from the files.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` counts the ids of all documents
    before.  With ``doc_ids`` only blocks that can hold these are read, and of those only the
    frames asked for are unpacked.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    data = spark.read.parquet(f"{folder}/dictionary").head()
    dictionary, width = bytes(data.data), data.width
    if hashlib.sha256(dictionary).hexdigest() != data.hash:
        raise ValueError(f"{folder}: the dictionary is damaged")

    # Tokens before a block: those of the shards before, and of the blocks before in its shard.
    counts = blocks.select("shard", "block", "tokens")
    shards = counts.groupBy("shard").agg(F.sum("tokens").alias("in_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("in_shard").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Stored, as Spark then knows how small it is and need not deal out the payloads to join it.
    starts = stored(
        counts.select("shard", "block", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("block_start"))
        .join(shards, "shard")
        .select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("start")),
        "starts",
    )

    wanted = None
    if doc_ids is not None:
        wanted = frozenset(doc_ids)
        ranges = [F.col("first_id").isNull() | ((F.col("first_id") <= i) & (F.col("last_id") >= i)) for i in wanted]
        any_range = F.lit(False)
        for one in ranges:
            any_range |= one
        blocks = blocks.filter(any_range)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _dictionary(dictionary)
        unpack = zstandard.ZstdDecompressor(**({"dict_data": known} if known else {})).decompress
        for batch in batches:
            for row in range(batch.num_rows):
                one = [c[row] for c in batch.columns]
                if one[5].as_py() != data.hash:
                    raise ValueError(f"{folder}: a block needs another dictionary")
                names, sizes, ends = (x.as_py() for x in one[1:4])
                payload = memoryview(one[4].as_buffer())
                at, start = 0, one[0].as_py()
                out: list[tuple] = []
                held = 0
                for name, size, end in zip(names, sizes, ends):
                    if wanted is None or name in wanted:
                        ids = np.frombuffer(unpack(payload[at:end]), f"<u{width}").astype("<u4").tobytes()
                        if len(ids) != 4 * size:
                            raise ValueError(f"{folder}: document {name} has {len(ids) // 4} ids, not {size}")
                        out.append((name, start, size, ids))
                        held += len(ids)
                    at, start = end, start + size
                    if held > 4 * BLOCK_BYTES:
                        yield _documents(out)
                        out, held = [], 0
                yield _documents(out)

    chosen = ["doc_ids", "n_tokens", "ends", "payload", "dictionary_hash"]
    placed = blocks.join(starts, ["shard", "block"]).select("start", *chosen)
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "n_tokens", "ids"]
    )
