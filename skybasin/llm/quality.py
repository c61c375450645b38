"""Quality: a linear classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; unlabelled texts are a sample of all texts, of which an
unknown share, the class prior, is good as well.  Texts labelled bad are not used.

1.  A first classifier separates trusted from unlabelled texts.
2.  The prior is estimated from its scores: among the texts above any score, the share of the unlabelled
    divided by the share of the trusted is at least the prior, and equals it where no bad text
    scores so high.  The estimate is the lowest such ratio.
3.  The final classifier minimises the non-negative unbiased risk for that prior ``p``:
    ``p * loss(trusted as good) + max(0, loss(unlabelled as bad) - p * loss(trusted as bad))``.
    Where the second term falls below zero, which no bad texts can cause, the step goes back up along it.

Features: which kinds of characters follow each other (letters, capitals, digits and each sign as it
is), hashed words, and a few figures of the whole text: repetition, lengths, shares of kinds.

Training reads at most ``TRUSTED`` trusted and ``UNLABELLED`` unlabelled texts, those with the smallest hash of
the id; both bounds are parameters.  Scoring reads every whole text.
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
from skybasin.llm.shingles import word_hashes

TRUSTED, UNLABELLED = 4_000, 8_000
THRESHOLD = 0.5
#: Buckets of words; kinds of characters.
WORDS, KINDS = 1 << 14, 40
STEPS, RATE, PENALTY = 150, 0.1, 1e-4
#: Bytes whose kinds are counted at once.
SEGMENT = 1 << 20

_FIGURES = 10
_TRIPLES = KINDS**3
SIZE = _TRIPLES + WORDS + _FIGURES


def _kinds() -> np.ndarray:
    """The kind of each byte: capitals 1, digits 2, blanks 3, line ends 4, signs from 5 on, all else (letters) 0."""
    kind = np.zeros(256, np.int64)
    kind[65:91], kind[48:58], kind[32], kind[9] = 1, 2, 3, 3
    kind[[10, 11, 12, 13]] = 4
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    kind[signs] = 5 + np.arange(len(signs))
    # Control bytes and what is left of the kinds.
    kind[:9], kind[14:32], kind[127] = 38, 38, 38
    return kind


_KIND = _kinds()


def _triples(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the kinds of three neighbouring bytes."""
    counts = np.zeros(_TRIPLES, np.int64)
    for at in range(0, len(data), SEGMENT):
        kind = _KIND[data[at : at + SEGMENT + 2]]
        if len(kind) > 2:
            counts += np.bincount((kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:], minlength=_TRIPLES)
    used = np.flatnonzero(counts)
    return used, counts[used]


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and values of the features that each text has."""
    raw = [t.encode() for t in texts]
    for text, words in zip(raw, word_hashes(raw)):
        data = np.frombuffer(text, np.uint8)
        at, count = _triples(data)
        distinct, times = np.unique(words, return_counts=True)
        buckets = np.bincount((distinct >> np.uint64(20)).astype(np.int64) % WORDS, times, WORDS) if len(words) else np.zeros(0)
        used = np.flatnonzero(buckets)
        places = np.concatenate([at, _TRIPLES + used, np.arange(SIZE - _FIGURES, SIZE)])
        values = np.concatenate(
            [np.sqrt(count / max(1, count.sum())), np.sqrt(buckets[used] / max(1, len(words))) / 2, _figures(data, words, times)]
        )
        yield places, values


def _figures(data: np.ndarray, order: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Figures of a whole text, each about 0 to 1."""
    kinds = np.bincount(_KIND[data], minlength=KINDS) / max(1, len(data)) if len(data) else np.zeros(KINDS)
    words = len(order)
    runs = order[2:] + order[1:-1] * np.uint64(3) + order[:-2] * np.uint64(5)
    return 2 * np.array(
        [
            # A word after itself, and three words that were there before.
            np.count_nonzero(order[1:] == order[:-1]) / max(1, words - 1),
            1 - len(np.unique(runs)) / len(runs) if len(runs) else 0.0,
            # Different words for the number of words: natural texts follow a power of it.
            min(2.0, len(times) / max(1.0, words) ** 0.8) if words else 0.0,
            times.max() / words if words else 0.0,
            min(2.0, len(data) / (8.0 * words)) if words else 0.0,
            min(2.0, np.log1p(words) / 8),
            kinds[1],
            kinds[2],
            kinds[4] * 10,
            kinds[5:].sum(),
        ]
    )


@dataclass(frozen=True)
class Model:
    """Weights of all features, the constant, and the estimated share of good texts."""

    weights: np.ndarray
    constant: float
    prior: float

    def scores(self, texts: list[str]) -> np.ndarray:
        sums = np.fromiter((self.weights[at] @ value for at, value in features(texts)), float, len(texts))
        return _sigmoid(sums + self.constant)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class _Rows:
    """Feature rows of all training texts, one after the other."""

    def __init__(self, places: list[np.ndarray], values: list[np.ndarray]):
        self.count = len(places)
        self.row = np.repeat(np.arange(self.count, dtype=np.int32), [len(x) for x in places])
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        # Only features that occur take part.
        self.used, self.place = np.unique(place, return_inverse=True)
        self.place = self.place.astype(np.int32)
        self.value = np.concatenate(values).astype(np.float32) if values else np.zeros(0, np.float32)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.place], self.count)

    def slopes(self, off: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, self.value * off[self.row], len(self.used))


def _fit(rows: _Rows, trusted: np.ndarray, prior: float | None) -> tuple[np.ndarray, float]:
    """Weights and constant by Adam steps on the risk for a prior, or, without one, on trusted against unlabelled."""
    good, rest = trusted / max(1, trusted.sum()), ~trusted / max(1, (~trusted).sum())
    weights = np.zeros(len(rows.used) + 1)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        sums = rows.sums(weights[:-1]) + weights[-1]
        share = _sigmoid(sums)
        if prior is None:
            off = good * (share - 1) + rest * share
        else:
            # The loss of a text as bad is its share, as good the rest of it: bounded, so a prior
            # that is a little too high does not outweigh the bad texts.
            steep = share * (1 - share)
            bad = rest - prior * good
            off = (bad - prior * good) * steep if bad @ share >= 0 else -bad * steep
        slope = np.concatenate([rows.slopes(off) + PENALTY * weights[:-1], [off.sum()]])
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        pace = RATE * min(1.0, 2 - 2 * step / STEPS)
        weights -= pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def estimated_prior(trusted: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good texts among the unlabelled, from scores of either.

    The lowest ratio of shares above a score, over the scores that at least half of the trusted reach,
    so that no few texts decide it.
    """
    if not len(trusted) or not len(unlabelled):
        return 0.5
    bounds = np.quantile(trusted, np.linspace(0.0, 0.5, 51))
    t = 1 - np.searchsorted(np.sort(trusted), bounds) / len(trusted)
    u = 1 - np.searchsorted(np.sort(unlabelled), bounds) / len(unlabelled)
    return float(np.clip((u / t).min(), 0.01, 0.99))


def fit(trusted: list[tuple], unlabelled: list[tuple]) -> Model:
    """The model from rows of (places, values) of trusted and unlabelled texts."""
    if not trusted or not unlabelled:
        return Model(np.zeros(SIZE), 0.0, 0.5)
    rows = _Rows([p for p, _ in [*trusted, *unlabelled]], [v for _, v in [*trusted, *unlabelled]])
    is_trusted = np.arange(rows.count) < len(trusted)

    # Every third text is kept from the first classifier, for the estimate.
    aside = np.arange(rows.count) % 3 == 0
    parts = [*trusted, *unlabelled]
    learn = _Rows([p for (p, _), a in zip(parts, aside) if not a], [v for (_, v), a in zip(parts, aside) if not a])
    some, constant = _fit(learn, is_trusted[~aside], None)
    first = np.zeros(SIZE)
    first[learn.used] = some
    sums = np.array([first[p] @ v for (p, v), a in zip(parts, aside) if a]) + constant
    prior = estimated_prior(sums[is_trusted[aside]], sums[~is_trusted[aside]])

    some, constant = _fit(rows, is_trusted, prior)
    weights = np.zeros(SIZE)
    weights[rows.used] = some
    return Model(weights, constant, prior)


_FEATURES = "trusted boolean, places binary, values binary"


def _training_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            rows = [
                # As bytes, which reach the driver without an object for each number.
                (p.astype(np.uint32).tobytes(), v.astype(np.float16).tobytes())
                for p, v in features(part.column(1).to_pylist())
            ]
            places, values = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(places, pa.binary()), pa.array(values, pa.binary())], ["trusted", "places", "values"]
            )


def _sampled(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` ids, those with the smallest hash; few more than these are ever compared."""
    found = ids.count()
    order = F.xxhash64(F.lit(seed), "id")
    if found > 4 * most:
        share = 1 << 40
        ids = ids.filter(F.pmod(order, F.lit(share)) < F.lit(int(share * 2 * most / found)))
    return ids.orderBy(F.pmod(order, F.lit(1 << 40)), "id").limit(most)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    trusted: int = TRUSTED,
    unlabelled: int = UNLABELLED,
) -> Model:
    """Fit the classifier on at most ``trusted`` texts that ``labels`` calls good (1), and ``unlabelled`` of all ``docs``.

    Rows without an id are not learnt from; of labels that repeat an id the smallest counts, so that an id is
    trusted if all its labels are; of rows that repeat an id the smallest text counts.  A null text is an empty one.  Other labels are not
    read.  Without a trusted or any other text every text scores 0.5.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(F.col(f"`{text_col}`")).alias("text")).filter("id IS NOT NULL")
    good = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .filter("label = 1")
        .select("id")
    )
    chosen = _sampled(good, trusted, 1).withColumn("trusted", F.lit(True)).unionByName(
        _sampled(rows.select("id").distinct(), unlabelled, 2).withColumn("trusted", F.lit(False))
    )
    # Bounded by the two numbers of texts, and so broadcast.
    texts = rows.join(F.broadcast(stored(chosen, "chosen")), "id").groupBy("id", "trusted").agg(F.min("text").alias("text"))
    found = stored(texts.select("trusted", "text"), "training").mapInArrow(_training_features, _FEATURES).collect()
    parts: dict[bool, list] = {True: [], False: []}
    for row in found:
        parts[row.trusted].append((np.frombuffer(row.places, np.uint32), np.frombuffer(row.values, np.float16).astype(np.float32)))
    return fit(parts[True], parts[False])


def score(text: str | Column, model: Model) -> Column:
    """The score of a text column, 0 to 1; a null text is an empty one."""

    @F.arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(model.scores(part.to_pylist()), pa.float64())

    return scored(text_of(text))
