"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams and of itself, hashed into
buckets; a text's vector is the mean of its words' vectors; a softmax of it gives the score. All
of it is trained jointly, in numpy, so a misspelling that was never seen shares most of its
n-grams with the word it comes from.

The model is fitted on a bounded sample (``SAMPLE_ROWS`` labelled texts); every whole text is
scored, word by word through a bounded cache, since a linear output of a mean is the mean of the
words' outputs. The bias is set so that a score of 0.5 is the best cut on a fourth of the sample, which
is not trained on.

Null and empty texts, and texts without words, get the score of the bias alone.
Repeated rows and null IDs are scored like any others; a null ID is held out. Without labels of both kinds every score
is 0. Columns of the results' names are replaced.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.llm.common import bounded_sample

SAMPLE_ROWS = 5_000
BUCKETS = 1 << 20
SIZE = 8
GRAMS = (3, 5)
EPOCHS = 24
RATE = 2.0
SOFTMAX_RATE = 0.05
# A subword counts if at least this share of the training texts, and this many, hold it.
LEAST_SHARE, LEAST_TEXTS = 0.02, 5
# A text counts as if it had so many words without a sign more, or a short one would say too much.
EMPTY_WORDS = 10
CACHE_WORDS = 200_000
# The cut lets at most this share of clean texts through to the rejected; below that, an alarm
# weighs as much as so many toxic texts missed.
MOST_ALARMS, ALARM_WEIGHT = 0.02, 4.0
# This share of the words of training have no sign, whatever their output.
QUIET = 0.99
# So many vectors are gathered at once in training.
GATHERED = 1 << 18
EDGES = ".,;:!?\"'()[]"


def words_of(text: str | None) -> list[str]:
    """Lower-case words without punctuation at their ends."""
    return [w for w in (x.strip(EDGES) for x in (text or "").lower().split()) if w]


def buckets_of(word: str, buckets: int = BUCKETS, grams: tuple[int, int] = GRAMS) -> list[int]:
    """Buckets of the whole word and of its n-grams, ends marked."""
    marked = f"<{word}>"
    parts = [marked] + [
        marked[i : i + n] for n in range(grams[0], grams[1] + 1) for i in range(len(marked) - n + 1) if n < len(marked)
    ]
    return [zlib.crc32(p.encode()) % buckets for p in parts]


@dataclass(frozen=True)
class Model:
    """One output per bucket (the embeddings times the softmax weights), and the bias.

    A word's output counts by how far it is above `floor`: a long text's many words without a
    sign would otherwise outweigh the few with one.
    """

    outputs: np.ndarray
    bias: float
    floor: float = 0.0

    @cached_property
    def known(self) -> dict[int, float]:
        """The outputs that aren't 0."""
        there = np.flatnonzero(self.outputs)
        return dict(zip(there.tolist(), self.outputs[there].tolist()))

    def word(self, word: str) -> float:
        buckets = buckets_of(word, len(self.outputs))
        return max(0.0, math.fsum(self.known.get(b, 0.0) for b in buckets) / len(buckets) - self.floor)

    def margin(self, bag: Iterable[tuple[str, int]], word: Callable[[str], float]) -> float:
        """Of words and counts."""
        bag = list(bag)
        return self.bias + math.fsum(n * word(w) for w, n in bag) / (sum(n for _, n in bag) + EMPTY_WORDS)

    def score(self, text: str | None, outputs: Callable[[str], float | None] | None = None) -> float:
        """`outputs`: of a token, the output of its word; None if it has no word in it."""
        found = [v for v in map(outputs or self.token, (text or "").split()) if v is not None]
        margin = self.bias + math.fsum(found) / (len(found) + EMPTY_WORDS)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, margin))))

    def token(self, token: str, word: Callable[[str], float] | None = None) -> float | None:
        bare = token.lower().strip(EDGES)
        return (word or self.word)(bare) if bare else None


class Kept(dict):
    """Values of a function, a bounded number of them."""

    def __init__(self, function: Callable, limit: int = CACHE_WORDS):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key: str):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


class _Sums:
    """Weighted means of rows by group, and gradients of the means back to the rows.

    Members are taken a part at a time, so what is gathered at once stays small.
    """

    def __init__(self, members: np.ndarray, starts: np.ndarray, size: int, weights: np.ndarray | None = None, empty: float = 0.0):
        lengths = np.diff(np.append(starts, len(members)))
        group = np.repeat(np.arange(len(starts), dtype=np.int32), lengths)
        weights = np.ones(len(members), np.float32) if weights is None else weights.astype(np.float32)
        weights = weights / (np.add.reduceat(weights, starts) + np.float32(empty))[group]
        order = np.argsort(members, kind="stable").astype(np.int32)
        self.size = size
        self.forth = self._grouped(group, members, weights)
        self.back = self._grouped(members[order], group[order], weights[order])

    @staticmethod
    def _grouped(by: np.ndarray, members: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
        first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
        return by[first], members, first, weights

    @staticmethod
    def _sums(rows: np.ndarray, members: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.empty((len(starts), rows.shape[1]), np.float32)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + GATHERED, side="right")) - 1)
            low, high = starts[at], starts[to] if to < len(starts) else len(members)
            part = rows[members[low:high]] * weights[low:high, None]
            out[at:to] = np.add.reduceat(part, starts[at:to] - low)
            at = to
        return out

    def mean(self, rows: np.ndarray) -> np.ndarray:
        return self._sums(rows, *self.forth[1:])

    def spread(self, gradient: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, gradient.shape[1]), np.float32)
        out[self.back[0]] = self._sums(gradient, *self.back[1:])
        return out


def train(
    bags: Iterable[list[tuple[str, int]]],
    toxic: np.ndarray,
    buckets: int = BUCKETS,
    size: int = SIZE,
    epochs: int = EPOCHS,
    rate: float = RATE,
    least_share: float = LEAST_SHARE,
) -> Model:
    """Fit embeddings and softmax together by gradient descent with momentum.

    `bags`: words and counts of texts. The number of steps is fixed and small, which keeps the
    vectors of subwords without a sign near zero.
    """
    vocabulary: dict[str, int] = {}
    members, weights, starts, labels = array("i"), array("f"), [], []
    for bag, label in zip(bags, toxic):
        if bag:
            starts.append(len(members))
            labels.append(label)
            members.extend(vocabulary.setdefault(w, len(vocabulary)) for w, _ in bag)
            weights.extend(n for _, n in bag)
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(buckets, np.float32), -60.0)
    members, weights, starts = np.array(members), np.array(weights), np.array(starts)
    grams, edges = array("i"), array("i", [0])
    for word in vocabulary:
        grams.extend(buckets_of(word, buckets))
        edges.append(len(grams))
    grams, edges = np.frombuffer(grams, np.int32), np.frombuffer(edges, np.int32)
    texts = np.zeros(buckets, np.int32)
    for part in np.split(members, starts[1:]):
        texts[np.unique(np.concatenate([grams[edges[w] : edges[w + 1]] for w in part]))] += 1
    known = texts >= max(LEAST_TEXTS, least_share * len(y))
    place = np.where(known, np.cumsum(known), 0).astype(np.int32)
    docs = _Sums(members, starts, len(vocabulary), weights, EMPTY_WORDS)
    subwords = _Sums(place[grams], edges[:-1], int(known.sum()) + 1)
    # Rare and common subwords get a like spread: each is scaled by the root of its mean share.
    share = subwords.spread(docs.spread(np.full((len(y), 1), 1 / len(y), np.float32)))
    scale = 1 / np.sqrt(np.maximum(share, 1e-12))
    scale[0] = 0  # the place of the subwords that don't count
    random = np.random.default_rng(7)
    table = np.zeros((subwords.size, size), np.float32)
    out = random.normal(0, 1 / np.sqrt(size), (size, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    moved = [np.zeros_like(p) for p in (table, out, bias)]
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))[:, None].astype(np.float32)
    target = np.stack([1 - y, y], 1)
    weight = balance / len(y)
    for _ in range(epochs):
        mean = docs.mean(subwords.mean(scale * table))
        logits = mean @ out + bias
        logits -= logits.max(1, keepdims=True)
        likely = np.exp(logits)
        likely /= likely.sum(1, keepdims=True)
        error = (likely - target) * weight
        gradients = scale * subwords.spread(docs.spread(error @ out.T)), mean.T @ error, error.sum(0)
        for k, (p, g) in enumerate(zip((table, out, bias), gradients)):
            moved[k] = 0.9 * moved[k] - (rate if k == 0 else SOFTMAX_RATE) * g
            p += moved[k]
    margin = out[:, 1] - out[:, 0]
    outputs = np.zeros(buckets, np.float32)
    outputs[known] = (scale * (table @ margin)[:, None])[place[known], 0]
    words = subwords.mean(scale * (table @ margin)[:, None])[:, 0]
    floor = max(0.0, float(np.quantile(words, QUIET)))
    margins = docs.mean(np.maximum(0, words - floor)[:, None])[:, 0]
    return Model(outputs, -best_cut(margins, y > 0), floor)


def best_cut(margins: np.ndarray, toxic: np.ndarray, most: float = MOST_ALARMS, weight: float = ALARM_WEIGHT) -> float:
    """The cut with the least share of toxic texts under it plus `weight` times the clean share at or over it.

    That clean share is at most `most`.
    """
    clean, bad = np.sort(margins[~toxic]), np.sort(margins[toxic])
    cuts = np.unique(np.concatenate([margins, [margins.max() + 1.0]]))
    alarms = 1 - np.searchsorted(clean, cuts) / len(clean)
    missed = np.searchsorted(bad, cuts) / len(bad)
    cost = np.where(alarms <= most, missed + weight * alarms, np.inf)
    at = int(cost.argmin())
    return float((cuts[at] + (cuts[at - 1] if at else cuts[at])) / 2)


def train_calibrated(rows: Sequence, toxic: np.ndarray, bag: Callable[..., list[tuple[str, int]]] = list) -> Model:
    """A model of all rows but each fourth, its bias moved to the best cut on those.

    `bag` makes a row's words and counts; only one row's are there at a time.
    """
    aside = np.arange(len(rows)) % 4 == 0
    if any(len(np.unique(toxic[part])) < 2 for part in (aside, ~aside)):
        return train(map(bag, rows), toxic)
    model = train((bag(r) for r, out in zip(rows, aside) if not out), toxic[~aside])
    word = Kept(model.word).__getitem__
    margins = np.array([model.margin(bag(rows[i]), word) for i in np.flatnonzero(aside)])
    return replace(model, bias=model.bias - best_cut(margins, toxic[aside]))


def fold(id_column: str) -> Column:
    """0 for held-out documents, else 1 to 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(5)), F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Train on about `rows` labelled documents that aren't held out.

    Workers reduce the texts to words and counts, so the driver gets bags of a bounded number of texts.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull() & (fold(id_column) != 0))
    sample = bounded_sample(known.select(F.col(id_column).alias("_id"), F.col(label).alias("_label")), "_id", rows)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))

    @F.pandas_udf("struct<words:string,counts:array<int>>")
    def bag(texts: pd.Series) -> pd.DataFrame:
        counts = [sorted(Counter(words_of(t)).items()) for t in texts]
        return pd.DataFrame({"words": [" ".join(w for w, _ in c) for c in counts], "counts": [[n for _, n in c] for c in counts]})

    found = texts.join(F.broadcast(sample), "_id").select("_id", "_label", bag("_text").alias("_bag")).collect()
    found.sort(key=lambda r: (r["_id"], r["_label"], r["_bag"]["words"]))
    toxic = np.array([r["_label"] == 1 for r in found], dtype=bool)
    return train_calibrated(found, toxic, lambda r: list(zip(r["_bag"]["words"].split(), r["_bag"]["counts"])))


def score(docs: DataFrame, model: Model, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """`docs` with the probability that each whole text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        word = Kept(model.word).__getitem__
        outputs = Kept(lambda token: model.token(token, word)).__getitem__
        for texts in batches:
            yield texts.map(lambda t: model.score(t, outputs)).astype("float64")

    return docs.withColumn(score_column, scored(F.coalesce(F.col(text_column), F.lit(""))))


def reject(docs: DataFrame, model: Model, text_column: str = "text", at: float = 0.5) -> DataFrame:
    """`docs` without those that score `at` or more."""
    return score(docs, model, text_column, "_score").filter(F.col("_score") < at).drop("_score")
