import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skybasin.llm import bpe, pieces, token_files
from skybasin.llm.common import tokenizer_file
from skybasin.session import working_dir

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
LETTERS = ["a" * k for k in range(1, 9)] + list(" \n\t'sdreltvmSTABİΣς.0123") + [
    "<|endoftext|>", "<|startoftext|>", "É", "日本", "́", " ́", "\x1c", "\x85", "\xa0", " ", "　", "ß", "😀", "  ", "The", "Ⅷ", "²",
]


def _texts(count, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(count)]


@pytest.mark.parametrize("most", [pieces.MAX_PIECES, 20])
def test_numpy_rounds_give_the_tokenizers_ids(monkeypatch, most):
    monkeypatch.setattr(pieces, "MAX_PIECES", most)
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 500)
    library, own = Tokenizer.from_file(BYTES), bpe.ByteBpe(BYTES)
    own._cache = pieces.PieceCache(own._encode_pieces, most)
    texts = _texts(3000)
    ids, sizes = own.encode(texts)
    found = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    wanted = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert found == wanted
    assert [own.decode(x) for x in wanted] == [library.decode(x, skip_special_tokens=False) for x in wanted]
    assert own.decode(wanted[0][:1] + [255, 127]) == library.decode(wanted[0][:1] + [255, 127], skip_special_tokens=False)


@pytest.mark.parametrize("most", [token_files.MAX_WORDS, 20])
def test_words_by_parts_give_the_tokenizers_ids(monkeypatch, most):
    monkeypatch.setattr(token_files, "MAX_WORDS", most)
    monkeypatch.setattr(token_files, "MAX_PARTS", most)
    library, own = Tokenizer.from_file(WORDS), token_files.WordTokenizer(WORDS)
    texts = _texts(3000, 4) + ["<|STARTOFTEXT|> Ab", "", " \n"]
    wanted = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    found = []
    for at in range(0, len(texts), 250):
        ids, sizes = own.encode(pa.array(texts).slice(at, 250))
        found += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert found == wanted
    assert [len(x) for x in own.encode(pa.array([], pa.string()))] == [0, 0]


def test_columns_of_rows_stay(docs_of):
    docs = docs_of([(1, "one two"), (1, "one two"), (None, None), (2, ""), (3, "x " * 200_000)])
    rows = bpe.encode(docs, BYTES, decoded_col="content").collect()
    assert [c for c in rows[0].asDict() if c not in ("ids", "content")] == [c for c in docs.columns if c != "content"]
    assert all(r.content == (r.text or "") for r in rows)
    assert [len(r.ids) for r in rows if r.doc_id is None] == [0]
    assert bpe.encode(docs_of([]), BYTES).count() == 0


def test_decode_rows(spark, docs_of):
    encoded = bpe.encode(docs_of([(1, "héllo <|endoftext|>")]), BYTES)
    nothing = encoded.withColumn("ids", F.lit(None).cast("array<int>"))
    rows = bpe.decode(encoded.unionByName(nothing), BYTES).collect()
    assert [r.decoded for r in rows] == ["héllo <|endoftext|>", None]


def _written(spark, docs):
    folder = working_dir(spark, "tokens")
    token_files.write_token_files(docs, folder, WORDS, end_id=1)
    return folder


def test_files_hold_every_document_in_order(spark, docs_of, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 300)
    texts = _texts(300, 5)
    rows = [(i, t) for i, t in enumerate(texts)] + [(300, None), (301, ""), (7, "again"), (None, "no id"), (302, "long " * 100_000)]
    folder = _written(spark, docs_of(rows[::-1]))
    library, start = Tokenizer.from_file(WORDS), 0
    wanted = []
    for i, text in sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
        wanted.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    found = token_files.read_token_files(spark, folder).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in found), key=lambda r: r[1]) == wanted
    assert spark.read.parquet(f"{folder}/blocks").count() > 10

    some = token_files.read_token_files(spark, folder, doc_ids=[7, 250]).collect()
    assert sorted(r.doc_id for r in some) == [7, 7, 250]
    assert {(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in some} <= set(wanted)


def test_short_documents_profit_from_the_dictionary(spark, docs_of):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    docs = docs_of([(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(400)])
    folder = _written(spark, docs)
    blocks = spark.read.parquet(f"{folder}/blocks").select(F.sum(F.octet_length("payload")), F.sum("tokens")).head()
    assert blocks[0] < blocks[1] * 2 * 0.6


def test_most_rows_without_an_id_or_with_one(spark, docs_of):
    """They are written in order of their texts, by several tasks, and drawn for the dictionary like others."""
    rows = [(None, f"text number {i}") for i in range(300)] + [(4, f"more {i}") for i in range(300)] + [(i, "few") for i in range(9)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = _written(spark, docs_of(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{folder}/blocks").filter("first_id IS NULL").select("shard").distinct().count() > 1
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))
    assert len(token_files._sample(docs_of(rows), "doc_id", "text")) == token_files.SAMPLE_DOCS


def test_empty_table_and_damaged_dictionary(spark, docs_of):
    assert token_files.read_token_files(spark, _written(spark, docs_of([]))).count() == 0
    folder = _written(spark, docs_of([(1, "a b")]))
    spark.createDataFrame([("0" * 64, bytearray(b"x"), 2)], "hash string, data binary, width int").write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError, match="damaged"):
        token_files.read_token_files(spark, folder)


def test_encoding_a_batch_holds_little_memory_at_once():
    """A 4 MB Arrow batch is encoded in slices, so a Python worker never holds all its pieces and ids at once."""
    import tracemalloc

    texts = _texts(200, seed=5)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(20_000), pa.int64()), pa.array([texts[i % 200] * 10 for i in range(20_000)], pa.string())],
        ["doc_id", "\0text"],
    )
    assert batch.nbytes > 4_000_000
    bpe.tokenizer(BYTES).encode(texts)  # the tokenizer and its cache of these pieces are no part of the peak
    tracemalloc.start()
    try:
        rows, decoded = 0, []
        for out in bpe.encoded_batches(iter([batch]), BYTES, ["doc_id", "ids", "decoded"], True):
            rows += out.num_rows
            decoded += out.column(2).to_pylist()[: 200 - len(decoded)]
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert rows == 20_000
    assert decoded == [x * 10 for x in texts]
    assert peak < 30_000_000
