"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is its set of word shingles; it is found in a document that holds
``num/den`` of the set or more, however long the document is. Items are
partitioned by size (powers of two). A partition keeps of each item the
``SKETCH`` smallest shingle hashes and, as its bound, the largest of these: of
a document only hashes up to the bound can meet the sketches, so partitions of
long items look at few of a document's shingles, and those of short items at
all. Hits estimate the containment; items within six standard errors of the
threshold are verified on the full shingle sets.

The index is broadcast in blocks of at most ``BLOCK`` bytes, one pass over the
documents for each, so its size is bounded for a benchmark of any size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Vocab, gram_hashes, map_batches, shingle_set, words_of

SHINGLE, NUM, DEN = 5, 4, 5
SKETCH, BLOCK = 32, 64 << 20


@dataclass
class Partition:
    """Items of one shingle length and size class."""

    k: int
    items: list = field(default_factory=list)   # (item_id, sorted full set, sketch size)
    bound: int = 0
    values: np.ndarray | None = None            # sorted retained hashes
    owners: np.ndarray | None = None            # item position per value
    need: np.ndarray | None = None              # hits that an item needs


def index(items: list[tuple[int, str | None]], shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> list[Partition]:
    """Partitions of the items. An item of fewer than ``shingle`` words is one shingle of all its
    words; one without words is left out."""
    parts: dict[tuple[int, int], Partition] = {}
    vocab = Vocab()
    for item, text in items:
        words = words_of(text, lower=True)
        if words:
            full = shingle_set(vocab.hashes(words), shingle)
            k = min(shingle, len(words))
            parts.setdefault((k, len(full).bit_length()), Partition(k)).items.append((item, full))
    t = num / den
    for p in parts.values():
        sketches = [full[:SKETCH] for _, full in p.items]
        values, owners = np.concatenate(sketches), np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
        order = np.argsort(values, kind="stable")
        p.values, p.owners, p.bound = values[order], owners[order], values.max()
        p.need = np.array([max(1, math.floor(len(s) * t - (0 if len(s) == len(full) else 6 * math.sqrt(len(s) * t * (1 - t)))))
                           for s, (_, full) in zip(sketches, p.items)])
    return list(parts.values())


def leaks(text: str | None, parts: list[Partition], vocab: Vocab, num: int = NUM, den: int = DEN) -> list[tuple[int, int, int]]:
    """(item_id, shared shingles, item shingles) of the items that a whole text contains."""
    h = vocab.hashes(words_of(text, lower=True))
    out, grams = [], {}
    for p in parts:
        if len(h) < p.k:
            continue
        if p.k not in grams:
            grams[p.k] = gram_hashes(h, p.k)
        g = grams[p.k]
        probe = g[g <= p.bound]
        at = np.searchsorted(p.values, probe)
        at = np.unique(probe[p.values[np.minimum(at, len(p.values) - 1)] == probe])
        if not len(at):
            continue
        lo, hi = np.searchsorted(p.values, at, "left"), np.searchsorted(p.values, at, "right")
        found = np.concatenate([p.owners[a:b] for a, b in zip(lo, hi)])
        hits = np.bincount(found, minlength=len(p.items))
        close = np.flatnonzero(hits >= p.need)
        if len(close):
            whole = np.unique(g)
            for i in close:
                item, full = p.items[i]
                shared = len(np.intersect1d(full, whole, assume_unique=True))
                if den * shared >= num * len(full):
                    out.append((item, shared, len(full)))
    return out


def blocks(benchmark: DataFrame):
    """The benchmark's items in bounded blocks, dealt by their hash."""
    benchmark = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = benchmark.agg(F.sum(F.octet_length("text") * 4)).first()[0] or 0   # hashes take about four times the text
    n = max(1, -(-size // BLOCK))
    for b in range(n):
        yield [(r["item_id"], r["text"]) for r in benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs(doc_id, text)``, ``benchmark(item_id, text)`` -> one row (doc_id,
    item_id, n_shared, n_item, containment) for each item that a document contains.

    Null and empty documents contain nothing; null and empty items are in
    nothing. A null doc_id or item_id stays null; repeated rows match each.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index(items, shingle, num, den))

        def run(batches, shared=shared):
            vocab = Vocab()
            for batch in batches:
                rows = [(d, *x) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in leaks(t, shared.value, vocab, num, den)]
                yield dict(zip(("doc_id", "item_id", "n_shared", "n_item"), list(zip(*rows)) or [[]] * 4))

        found = map_batches(docs, run, "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint")
        out = found if out is None else out.unionByName(found)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` without the documents that contain an item; all columns stay."""
    for items in blocks(benchmark):
        docs = docs.where(_free_of(docs.sparkSession.sparkContext.broadcast(index(items, shingle, num, den)), num, den)("text"))
    return docs


def _free_of(shared, num: int, den: int):
    vocab = Vocab()

    @F.pandas_udf("boolean")
    def free(texts: pd.Series) -> pd.Series:
        return pd.Series([not leaks(t, shared.value, vocab, num, den) for t in texts], dtype=bool)

    return free
