"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the n-grams of the lower-cased text, present or not, hashed to ``BUCKETS``.  Over the
training texts each bucket gets the log of the ratio of its shares in toxic and clean texts; a logistic
regression is then trained on the present features times their ratios.  Only the ``FEATURES``
buckets whose ratio is surest enter.

Training reads at most ``TRAINING_ROWS`` labelled texts, those with the smallest hash of the id; the bound
keeps the trained matrix small and is a parameter.  Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skybasin.llm.bpe import slices
from skybasin.llm.common import stored, text_of
from skybasin.llm.shingles import mix

SIZES = (3, 4, 5)
BUCKETS = 1 << 20
TRAINING_ROWS = 20_000
#: Below 2 ** 15, as features travel as 16-bit numbers.
FEATURES = 4096
ROUNDS = 300
#: A toxic training text counts as so many clean ones.
TOXIC_WEIGHT = 3.0
#: Characters hashed at once.
SEGMENT = 1 << 18
THRESHOLD = 0.7

_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407)]


def buckets(text: str) -> Iterator[np.ndarray]:
    """The bucket of every n-gram of a text, repeats included, a segment at a time."""
    text = text.lower()
    overlap = max(SIZES) - 1
    for at in range(0, max(len(text), 1), SEGMENT):
        letters = np.frombuffer(text[at : at + SEGMENT + overlap].encode("utf-32-le"), np.uint32).astype(np.uint64)
        for size in SIZES:
            count = len(letters) - size + 1
            if count > 0:
                total = np.full(count, size, np.uint64)
                for i in range(size):
                    total += letters[i : i + count] * _FACTORS[i]
                yield (mix(total) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Weight of each chosen bucket (already times its ratio), and the constant."""

    chosen: np.ndarray
    weights: np.ndarray
    constant: float

    def scorer(self):
        place = np.full(BUCKETS, -1, np.int32)
        place[self.chosen] = np.arange(len(self.chosen))

        def score(texts: list[str]) -> np.ndarray:
            sums = np.empty(len(texts))
            for i, text in enumerate(texts):
                sums[i] = self.weights[present(text, place)].sum() + self.constant
            return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))

        return score


def present(text: str, place: np.ndarray) -> np.ndarray:
    """The chosen features that a text has."""
    found = [np.zeros(0, np.int32)]
    for part in buckets(text):
        hit = place[part]
        found.append(np.unique(hit[hit >= 0]))
    return np.unique(np.concatenate(found))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts each bucket occurs."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            parts = [np.zeros(0, np.int64), *buckets(text)]
            counts[int(toxic), np.unique(np.concatenate(parts))] += 1
    used = np.flatnonzero(counts.any(axis=0))
    for at in range(0, len(used), 1 << 16):
        part = used[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(counts[1, part]), pa.array(counts[0, part])], ["bucket", "toxic", "clean"]
        )


def _features(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    for batch in batches:
        for part in slices(batch):
            # As bytes, which reach the driver without an object for each number.
            rows = [present(text, place).astype(np.int16).tobytes() for text in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(rows, pa.binary())], ["toxic", "features"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    training_rows: int = TRAINING_ROWS,
) -> Model:
    """Fit the classifier on at most ``training_rows`` rows of ``labels`` (id, 0 or 1) that have a text.

    Rows with a null id or label, or another label, are left out; of labels that repeat an id the largest
    counts.  Without both labels every text scores the same: the share of toxic training texts.
    """
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
        .filter("id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Bounded by training_rows, and so broadcast.
    chosen_rows = known.orderBy(F.xxhash64("id"), "id").limit(training_rows)
    texts = stored(
        docs.select(F.col(f"`{id_col}`").alias("id"), text_of(F.col(f"`{text_col}`")).alias("text"))
        .join(F.broadcast(chosen_rows), "id")
        .select("text", "toxic"),
        "training",
    )
    totals = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    share = (toxic + 0.5) / (toxic + clean + 1)
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    if not toxic or not clean:
        return nothing

    counts = texts.mapInArrow(_count, "bucket bigint, toxic bigint, clean bigint")
    sums = counts.groupBy("bucket").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("q"))
    p, q = F.col("p") + 0.5, F.col("q") + 0.5
    ratio = F.log(p / (toxic + 1)) - F.log(q / (clean + 1))
    sure = F.abs(ratio) / F.sqrt(1 / p + 1 / q)
    best = (
        sums.filter(F.col("p") + F.col("q") > 1)
        .select("bucket", ratio.alias("ratio"), sure.alias("sure"))
        .orderBy(F.desc("sure"), "bucket")
        .limit(FEATURES)
        .collect()
    )
    buckets_chosen = np.array([r["bucket"] for r in best], np.int64)
    ratios = np.array([r["ratio"] for r in best])
    if not len(best):
        return nothing
    rows = texts.mapInArrow(
        lambda x: _features(x, buckets_chosen), "toxic int, features binary"
    ).collect()
    wanted = np.array([r["toxic"] for r in rows], float)
    sizes = np.array([len(r["features"]) // 2 for r in rows])
    features = np.frombuffer(b"".join([r["features"] for r in rows]), np.int16).astype(np.int32)
    del rows
    weights, constant = _logistic(features, sizes, wanted, ratios, nothing.constant)
    return Model(buckets_chosen, weights * ratios, constant)


def _logistic(features, sizes, wanted, scale, constant, strength: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights by accelerated gradient steps on the mean log loss with a small quadratic penalty."""
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    values = scale[features]
    share = np.where(wanted == 1, TOXIC_WEIGHT, 1.0)
    share /= share.sum()

    def sums_of(weights: np.ndarray) -> np.ndarray:
        return np.bincount(row, values * weights[features], len(sizes))

    def slopes_of(off: np.ndarray) -> np.ndarray:
        return np.bincount(features, values * (share * off)[row], len(scale))

    # The largest curvature, by power iteration, bounds the step.
    direction = np.random.default_rng(0).normal(size=len(scale))
    for _ in range(20):
        direction /= np.linalg.norm(direction) or 1
        direction = slopes_of(sums_of(direction))
    step = 1 / (0.25 * 1.1 * np.linalg.norm(direction) + 0.25 + strength)

    weights = ahead = np.zeros(len(scale))
    bias = bias_ahead = constant
    pace = 1.0
    for _ in range(ROUNDS):
        sums = sums_of(ahead) + bias_ahead
        off = 1 / (1 + np.exp(-np.clip(sums, -500, 500))) - wanted
        new = ahead - step * (slopes_of(off) + strength * ahead)
        new_bias = bias_ahead - step * (share * off).sum()
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / faster * (new - weights)
        bias_ahead = new_bias + (pace - 1) / faster * (new_bias - bias)
        weights, bias, pace = new, new_bias, faster
    return weights, float(bias)


def score(text: str | Column, model: Model) -> Column:
    """The score of a text column, 0 to 1; a null text is an empty one."""

    @F.arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = model.scorer()
        for part in parts:
            yield pa.array(run(part.to_pylist()), pa.float64())

    return scored(text_of(text))


def held_out(id_col: str | Column) -> Column:
    """A third of all ids, by the crc32 of the id as text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("string").cast("binary")) % 3 == 1
