"""Mixing sources to target weights: Sainte-Lague quotas of equal-word blocks, then seeded selection.

Each source has a weight.  Its target is its share of all words by weight, at most ``MOST`` times
its own words; what a capped source leaves is shared by weight among the others until none is
above its cap.  Targets are turned into whole blocks twice by highest quotients (target over 1, 3,
5, ...): blocks of the mix to sources, then a source's blocks to its shards.  Within a shard the documents
stand in a seeded order, and as many equal blocks of words as its quota are taken from a seeded
place on, in a circle; a quota of more words than the shard has takes it whole before that.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skybasin.llm.common import WORD, stored, text_of

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
SEED = 17
#: Words of a block, fewer where the smallest target would have under BLOCKS_EACH blocks.
BLOCK_WORDS, BLOCKS_EACH = 256, 256
#: Documents of a shard, about.
SHARD_DOCS = 4096


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats by the highest quotients votes / (2 * seats + 1); ties go to the earlier party.

    With ``most`` a party gets no more than that; what it can't take goes to the others.
    """
    votes = np.asarray(votes, float)
    limit = np.full(len(votes), np.iinfo(np.int64).max // 4) if most is None else np.asarray(most, np.int64)
    given = np.zeros(len(votes), np.int64)
    free = (votes > 0) & (limit > 0)
    seats = int(min(seats, limit[free].astype(float).sum()))
    while seats - given.sum() > 0 and free.any():
        left = seats - given[~free].sum()
        part = _uncapped(votes[free], int(left))
        given[free] = part
        over = free & (given > limit)
        if not over.any():
            break
        given[over] = limit[over]
        free &= ~over
        given[free] = 0
    return given


def _uncapped(votes: np.ndarray, seats: int) -> np.ndarray:
    """Whole numbers near votes / divisor, for the divisor that makes them add up."""
    def at(divisor: float) -> np.ndarray:
        return np.floor(votes / divisor + 0.5).astype(np.int64)

    low, high = votes.sum() / (seats + len(votes)), votes.max() * 2 + 1  # enough seats, too few
    for _ in range(200):
        middle = (low + high) / 2
        if at(middle).sum() >= seats:
            low = middle
        else:
            high = middle
    # One seat less each than the divisor gives, then the rest one by one by highest quotient.
    given = np.maximum(at(low) - 1, 0)
    queue = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes.tolist(), given.tolist()))]
    heapq.heapify(queue)
    for _ in range(int(seats - given.sum())):
        _, i = queue[0]
        given[i] += 1
        heapq.heapreplace(queue, (-float(votes[i]) / (2 * int(given[i]) + 1), i))
    return given


def targets(sizes: np.ndarray, weights: np.ndarray, most: float = MOST) -> np.ndarray:
    """Shares of the sum of sizes by weight, none above ``most`` times its size."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    cap = most * sizes
    order = np.argsort(cap / weights, kind="stable")
    before = np.concatenate([[0], np.cumsum(cap[order])[:-1]])
    level = (sizes.sum() - before) / np.cumsum(weights[order][::-1])[::-1]
    free = np.flatnonzero(cap[order] >= level * weights[order])
    unit = level[free[0]] if len(free) else np.inf
    return np.minimum(cap, unit * weights) if sizes.sum() else np.zeros(len(sizes))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _plan_sources(weights: tuple[float, ...]):
    def plan(sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("rank", kind="stable").reset_index(drop=True)
        weight = np.array([weights[i % len(weights)] for i in range(len(sources))])
        wanted = targets(sources["source_size"].to_numpy(), weight)
        block = block_words(wanted)
        quotas = sainte_lague(wanted, round(wanted.sum() / block))
        return pd.DataFrame(
            {"source_key": sources["source_key"], "source_size": sources["source_size"], "target": wanted,
             "docs": sources["docs"], "quota": quotas, "block": block}
        )

    return plan


def block_words(wanted: np.ndarray) -> int:
    """Words of a block: BLOCK_WORDS, or so few that the smallest target has BLOCKS_EACH."""
    wanted = wanted[wanted > 0]
    return int(max(1, min(BLOCK_WORDS, wanted.min() // BLOCKS_EACH))) if len(wanted) else 1


def _plan_shards(shards: pd.DataFrame) -> pd.DataFrame:
    """Quotas of the shards of one source, and which words of each are taken."""
    shards = shards.sort_values("shard").reset_index(drop=True)
    words = shards["words"].to_numpy(np.int64)
    block = int(shards["block"].iloc[0])
    # Blocks follow each other from a seeded word on, in a circle over the shard's words.
    quota = sainte_lague(words, int(shards["quota"].iloc[0]), -(-MOST * words // block))
    wanted = np.minimum(quota * block, MOST * words)
    whole, rest = wanted // np.maximum(words, 1), wanted % np.maximum(words, 1)
    first = shards["place"].to_numpy(np.int64) % np.maximum(words, 1)
    last = first + rest
    return pd.DataFrame(
        {
            "source_key": shards["source_key"],
            "shard": shards["shard"],
            "whole": whole,
            "from_a": first,
            "to_a": np.minimum(last, words),
            "to_b": np.maximum(last - words, 0),
        }
    )


def _source_key(column: Column) -> Column:
    """Sorts by code point, null last."""
    return F.concat(F.when(column.isNull(), F.lit("1")).otherwise(F.lit("0")), F.coalesce(column, F.lit("")))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, whole, parts`` for every row.

    Sources by code point, null last, weigh ``weights``, repeating.  ``taken`` is how many words of
    the row the mix takes: ``whole`` times all of them and the words in ``parts`` (first word, end).
    No row gives more than MOST times its words.  Null and empty texts have no words, and nothing is taken of them;
    a null id is an id like others; rows that repeat an id are rows of their own.  The same rows give the
    same mix, whatever their order.  An empty table gives no rows.  Other columns are not read.
    """
    rows = stored(
        docs.select(
            F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
            _source_key(F.col(f"`{source_col}`")).alias("source_key"),
            word_count(text_of(F.col(f"`{text_col}`"))).alias("size"),
            F.xxhash64(F.lit(seed), f"`{id_col}`", f"`{text_col}`").alias("place"),
        ),
        "sizes",
    )
    # One row per source goes through one task; it holds a few numbers for each.
    sources = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy("source_key")))
    plan = stored(
        ranked.groupBy(F.lit(1).alias("all")).applyInPandas(
            lambda x: _plan_sources(weights)(x),
            "source_key string, source_size bigint, target double, docs bigint, quota bigint, block bigint",
        ),
        "sources",
    )
    sharded = stored(
        rows.join(plan, "source_key").withColumn(
            "shard", F.pmod("place", F.ceil(F.col("docs") / SHARD_DOCS)).cast("bigint")
        ),
        "shards",
    )
    shards = sharded.groupBy("source_key", "shard").agg(
        F.sum("size").alias("words"),
        F.first("quota").alias("quota"),
        F.first("block").alias("block"),
        F.abs(F.bit_xor("place") % (1 << 62)).alias("place"),
    )
    chosen = shards.groupBy("source_key").applyInPandas(
        _plan_shards, "source_key string, shard bigint, whole bigint, from_a bigint, to_a bigint, to_b bigint"
    )
    order = Window.partitionBy("source_key", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "place"), "place", "doc_id")
    placed = sharded.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("end") - F.col("size")

    def part(first: Column, last: Column) -> Column:
        return F.struct(
            (F.greatest(first, start) - start).alias("first"), (F.least(last, "end") - start).alias("end")
        )

    parts = F.filter(
        F.array(part(F.lit(0), F.col("to_b")), part(F.col("from_a"), F.col("to_a"))), lambda x: x["first"] < x["end"]
    )
    words = F.aggregate("parts", F.lit(0).cast("bigint"), lambda done, x: done + x["end"] - x["first"])
    return (
        placed.join(chosen, ["source_key", "shard"])
        .select("doc_id", "place", "size", "source_size", "target", "whole", parts.alias("parts"))
        .withColumn("taken", F.col("whole") * F.col("size") + words)
    )


def take_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, **columns: str) -> DataFrame:
    """The words that the mix takes, as rows with the columns of ``docs``.

    A document taken whole several times gives several rows; one taken in part gives the part's words
    with the white space between them, and ``n_chars`` then counts that text.
    """
    names = {"id_col": "doc_id", "text_col": "text", "source_col": "source"} | columns
    text = names["text_col"]
    no_id = F.lit(-(1 << 63))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.xxhash64(F.lit(seed), f"`{names['id_col']}`", f"`{text}`").alias("place"),
        F.coalesce(F.col(f"`{names['id_col']}`").cast("bigint"), no_id).alias("id"),
    )
    whole_row = F.struct(F.lit(0).cast("bigint").alias("first"), F.col("size").alias("end"))
    times = F.when(F.col("size") > 0, F.col("whole")).otherwise(0).cast("int")
    pieces = F.concat(F.array_repeat(whole_row, times), F.col("parts"))
    # Rows alike in id and text share a place; each of them has its own pieces in the list.
    taken = (
        mix(docs, weights, seed=seed, **names)
        .select(F.coalesce("doc_id", no_id).alias("id"), "place", "size", pieces.alias("pieces"))
        .groupBy("id", "place", "size")
        .agg(F.array_sort(F.collect_list("pieces")).alias("copies"))
        .filter(F.size(F.flatten("copies")) > 0)
    )
    numbered = rows.join(taken, ["id", "place"]).withColumn(
        "copy", F.row_number().over(Window.partitionBy("id", "place").orderBy("size"))
    )
    exploded = numbered.select("row", "size", F.explode(F.expr("copies[copy - 1]")).alias("piece"))
    cut = F.when(
        (F.col("piece.first") == 0) & (F.col("piece.end") == F.col("size")), F.col(f"row.`{text}`")
    ).otherwise(_words(F.col(f"row.`{text}`"), F.col("piece.first"), F.col("piece.end")))
    whole = exploded.select("row", cut.alias("cut"))
    new = {text: F.col("cut"), "n_chars": F.char_length("cut").cast("bigint")}
    return whole.select(
        *(
            (new[c].cast(docs.schema[c].dataType) if c in new else F.col("row").getField(c)).alias(c)
            for c in docs.columns
        )
    )


def _words(text: Column, first: Column, end: Column) -> Column:
    """Words ``first`` to ``end`` (exclusive) of a text, with what stands between them."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    chosen = F.slice(pieces, (first + 1).cast("int"), (end - first).cast("int"))
    return F.regexp_replace(F.array_join(chosen, ""), r"^[\x20\x09-\x0D]+", "")
