"""Supervised subword embeddings as a quality classifier.

A document is the average of learned vectors, one per word and one per hashed
character n-gram of that word (with word-boundary marks), plus one that marks a
word repeated right after itself or one word later. A softmax layer sits on the
average. Vectors and layer are trained together by plain numpy stochastic
gradient descent on a bounded sample of labelled rows.

Scoring needs no vectors: the layer is linear, so each hashed feature has one
number, its share of the logit. These numbers (``BUCKETS`` floats, 1 MB) are
what the workers get, so scoring is one pass over the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import MIX, map_batches, mixed, words_of

BUCKETS = 1 << 18
SAME, SAME_NEXT = 0, 1
CHUNK = 500_000     # characters scored together
LONG, PIECE = 64, 1 << 16   # bytes of a word that is not kept, characters of a long word hashed at once


@dataclass(frozen=True)
class Training:
    sample: int = 5000      # labelled rows at most, those of the smallest hash; bounds the training task
    dim: int = 16
    epochs: int = 6
    rate: float = 0.25
    grams: tuple = (3, 4)
    seed: int = 7


def word_buckets(words: list[bytes], grams: tuple):
    """Yields (buckets, word position) of all features of ``words``: the words themselves and their
    character n-grams, with < and > as ends. Long words come in pieces that overlap by an n-gram
    less one character; about ``CHUNK`` characters are hashed at a time."""
    own = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint64, len(words))
    yield _bucket(own), np.arange(len(words))
    pieces, of, size = [], [], 0
    for i, w in enumerate(words):
        marked = "<" + w.decode("utf-8", "replace") + ">"
        for at in range(0, len(marked), PIECE):
            pieces.append(marked[at:at + PIECE + max(grams) - 1])
            of.append(i)
            size += len(pieces[-1])
            if size > CHUNK:
                yield from _gram_buckets(pieces, of, grams)
                pieces, of, size = [], [], 0
    if pieces:
        yield from _gram_buckets(pieces, of, grams)


def _gram_buckets(pieces: list[str], of: list[int], grams: tuple):
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    point = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32).astype(np.uint64)
    piece = np.repeat(np.arange(len(pieces)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(point))     # characters from here to the piece's end
    starts = size[piece] - left < PIECE                                 # what follows starts in the next piece
    for k in grams:
        at = np.flatnonzero((left >= k) & starts)
        h = np.full(len(at), k, np.uint64)
        for j in range(k):
            h = h * MIX + point[at + j]
        yield _bucket(h), np.asarray(of)[piece[at]]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mixed(h) % np.uint64(BUCKETS - 2)).astype(np.int64) + 2


class Features(dict):
    """Word -> dense id; ``parts[id]`` are the buckets of the word and its character n-grams.
    Starts anew past ``limit`` words, between two documents; words over LONG bytes are forgotten there."""

    def __init__(self, grams=(3, 4), limit: int = 1 << 18):
        super().__init__()
        self.grams, self.limit = grams, limit
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.parts, self.n, self.long = [], 0, []

    def learn(self, found, n: int) -> None:
        """The next ``n`` words, of which ``found`` yields (buckets, word position)."""
        buckets, of = map(np.concatenate, zip(*found))
        order = np.argsort(of, kind="stable")
        self.parts += np.split(buckets[order], np.cumsum(np.bincount(of, minlength=n))[:-1])

    def forget(self, at: int) -> None:
        self.parts[at] = np.empty(0, np.int64)

    def ids(self, words: list[bytes]) -> np.ndarray:
        if self.n > self.limit:
            self.reset()
        for w in self.long:
            self.forget(self.pop(w))
        new = [w for w in set(words) if w not in self]
        self.long = [w for w in new if len(w) > LONG]
        if new:
            self.update(zip(new, range(self.n, self.n + len(new))))
            self.n += len(new)
            self.learn(word_buckets(new, self.grams), len(new))
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class _Scored(Features):
    """Keeps, per word, only the sum of its features' shares and their number."""

    def __init__(self, shares: np.ndarray, grams):
        self.shares = shares
        super().__init__(grams)

    def reset(self) -> None:
        super().reset()
        self.sums, self.sizes = np.empty(0), np.empty(0)

    def learn(self, found, n) -> None:
        at = self.n - n
        if self.n > len(self.sums):
            grow = np.zeros(self.n + len(self.sums) // 2)
            self.sums, self.sizes = np.append(self.sums[:at], grow), np.append(self.sizes[:at], grow)
        self.sums[at:self.n] = self.sizes[at:self.n] = 0
        for buckets, of in found:
            self.sums[at:self.n] += np.bincount(of, self.shares[buckets], n)
            self.sizes[at:self.n] += np.bincount(of, minlength=n)

    def forget(self, at: int) -> None:
        pass    # two numbers a word stay until the reset

    def logits(self, texts: list, bias: float) -> np.ndarray:
        """The logit of each text; the words of all are looked up together."""
        words, ends = [], [0]
        for text in texts:
            words += words_of(text)
            ends.append(len(words))
        ids = self.ids(words)
        sums, sizes = (np.append(0, np.cumsum(x[ids])) for x in (self.sums, self.sizes))
        out = np.full(len(texts), bias)
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            if a < b:
                same, later = _repeats(ids[a:b])
                total = sums[b] - sums[a] + same * self.shares[SAME] + later * self.shares[SAME_NEXT]
                out[i] += total / (sizes[b] - sizes[a] + same + later)
        return out


def _repeats(ids: np.ndarray) -> tuple[int, int]:
    """Repeats weigh as much as a word's whole set of features (about 12)."""
    return 12 * int((ids[1:] == ids[:-1]).sum()), 12 * int((ids[2:] == ids[:-2]).sum())


def bag(words: list[bytes], features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and their weights (sum 1)."""
    ids = features.ids(words)
    uniq, n = np.unique(ids, return_counts=True)
    parts = [features.parts[i] for i in uniq]
    same, later = _repeats(ids)
    buckets = np.concatenate([*parts, [SAME, SAME_NEXT]]).astype(np.int64)
    weights = np.concatenate([np.repeat(n, [len(p) for p in parts]), [same, later]]).astype(np.float64)
    at, where = np.unique(buckets, return_inverse=True)
    weights = np.bincount(where, weights)
    return at, (weights / max(1.0, weights.sum())).astype(np.float32)


def train(rows: list[tuple[str | None, int]], t: Training = Training()) -> tuple[np.ndarray, float]:
    """(share of the logit per bucket, bias) from (text, label) rows."""
    rng = np.random.default_rng(t.seed)
    features = Features(t.grams)
    data = [(bag(w, features), y) for text, y in rows if (w := words_of(text))]
    vectors = rng.uniform(-1 / t.dim, 1 / t.dim, (BUCKETS, t.dim)).astype(np.float32)
    layer, bias = np.zeros((2, t.dim), np.float32), np.zeros(2, np.float32)
    layer[1], layer[0] = (s * rng.uniform(0.1, 0.3, t.dim) for s in (1, -1))
    steps, step = max(1, t.epochs * len(data)), 0
    for _ in range(t.epochs):
        for i in rng.permutation(len(data)):
            (at, weights), y = data[i]
            rate = t.rate * (1 - step / steps)
            step += 1
            rows_ = vectors[at]
            mean = weights @ rows_
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            # a bag's vectors share one average: steps in proportion to their weight, kept from vanishing in long texts
            vectors[at] = rows_ - (rate * 40) * np.outer(weights, p @ layer)
            layer -= rate * np.outer(p, mean)
            bias -= np.float32(rate * 0.1) * p
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def training_rows(docs: DataFrame, labels: DataFrame, t: Training = Training()) -> DataFrame:
    """(doc_id, text, quality): a bounded sample of labelled documents that are not
    held out, the ``t.sample`` ids of the smallest hash."""
    labels = (labels.where("doc_id is not null and quality in (0, 1)").where(~held_out("doc_id"))
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(t.sample)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def trained(docs: DataFrame, labels: DataFrame, t: Training = Training()):
    """Broadcast (share per bucket, bias). One task trains on the sample, whose size is bounded; the driver gets the shares only."""

    def run(batches):
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        if rows:
            shares, bias = train([(text, y) for _, text, y in sorted(rows, key=lambda r: (r[0], r[1] or ""))], t)
            yield {"shares": [shares.astype(np.float32).tobytes()], "bias": [bias]}

    rows = map_batches(training_rows(docs, labels, t).repartition(1), run, "shares binary, bias double").collect()
    model = (np.frombuffer(rows[0]["shares"], np.float32), rows[0]["bias"]) if rows else (np.zeros(BUCKETS, np.float32), 0.0)
    return docs.sparkSession.sparkContext.broadcast(model)


def held_out(column: str):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _probabilities(texts: list, words: _Scored, bias: float) -> np.ndarray:
    z, some, size = [], [], 0
    for text in texts:
        some.append(text)
        size += len(text or "")
        if size > CHUNK:
            z.append(words.logits(some, bias))
            some, size = [], 0
    z = np.concatenate([*z, words.logits(some, bias)])
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def accepted(docs: DataFrame, labels: DataFrame, t: Training = Training(), threshold: float = 0.3) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; all columns stay."""
    model = trained(docs, labels, t)
    made = []

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(_Scored(model.value[0].astype(np.float64), t.grams))
        return pd.Series(_probabilities(list(texts), made[0], model.value[1]) >= threshold, dtype=bool)

    return docs.where(good("text"))


def score(docs: DataFrame, labels: DataFrame, t: Training = Training(), threshold: float = 0.3) -> DataFrame:
    """``docs(doc_id, text)`` scored by a model trained on ``labels(doc_id,
    quality)`` -> per row (doc_id, held_out, score, predicted).

    Only the text enters a score. A null or empty text gets the score of the
    bias alone; a null doc_id is not held out; labels that are null or not 0
    or 1 are left out of training, of contradicting ones the lower counts.
    Without any label the model is the bias 0, score 0.5.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    model = trained(docs, labels, t)
    grams = t.grams

    def run(batches):
        shares, bias = model.value
        words = _Scored(shares.astype(np.float64), grams)
        for batch in batches:
            p = _probabilities(batch.column(1).to_pylist(), words, bias)
            yield {"doc_id": batch.column(0), "score": p, "predicted": (p >= threshold).astype(np.int32)}

    return map_batches(docs, run, "doc_id bigint, score double, predicted int").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
