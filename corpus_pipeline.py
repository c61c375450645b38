"""The corpus pipeline: documents through the stages below, each written and read again.

Toxic documents go, of equal texts one stays, of each group of near-copies one stays, sources are mixed
to their weights, and what is left is encoded to token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skybasin.llm import bpe, exact_dedup, minhash, mixing, toxicity
from skybasin.llm.common import stored, table, tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of two thirds of the ids.

    Every row is scored by itself, also one without an id or that repeats one; a null text is an empty
    one.  Other columns, whatever their names, stay as they are.  An empty table gives no rows.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out("doc_id")))
    return docs.filter(toxicity.score("text", model) < toxicity.THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays, one without id as last; null texts equal empty ones.

    Of rows that are equal in id and text one stays.  Other columns stay as they are.  An empty table gives no rows.
    """
    return exact_dedup.drop_copies(docs, keep="smallest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more the row with the smallest id stays, one without id as last.

    Texts without words are linked with nothing and stay.  Other columns stay as they are.  An empty table gives no rows.
    """
    return minhash.drop_near_duplicates(docs, percent=80, null_ids_stay=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes; a document may give several rows, each with the words of one taking.

    Rows without a source are a source of their own, the last; null and empty texts give no row.  Other
    columns are repeated with every row.  An empty table gives no rows.
    """
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of ids and of the text decoded from them.

    A null text is an empty one, without ids.  Columns other than id and text are not read.  An empty table gives no rows.
    """
    encoded = bpe.encode(docs.select("doc_id", "text"), tokenizer_file("byte_bpe_50k.json"), decoded_col="decoded")
    return bpe.digest(encoded, "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The classifier and the token ids are beyond SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokenized corpus: ``ids`` of every row, with its count and digests."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the stored corpus."""
    return corpus(spark, sf_dir).drop("ids")
