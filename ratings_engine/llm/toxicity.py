"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features (``FEATURES``) are rates per word or character: density and strength of
lexicon words, their nearness to second-person words, capitals, punctuation,
obfuscation (stretched letters, digits and signs inside words, spelt-out words)
and the share of lexicon words seen only once the obfuscation is undone.

The lexicon is learned: words and word beginnings that toxic documents use more
than others, by the log-likelihood ratio. Its entries fit the documents they were
learned on too well, so the trees never see such features: the sample is halved, and
the features of each half come from the lexicon of the other. A fifth of the sample is kept
from the trees for the calibration. New texts are read with the lexicon of the whole sample.
"""

from __future__ import annotations

import math
import re
import string
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import discard, materialize
from .text import map_batches

#: Second-person words of the languages in the tables, common look-alike characters.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen tu te ti tus vous votre vos toi ton ta tes usted ustedes tuyo".split())
LOOK_ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "+": "t"})

PREFIXES = range(3, 9)      # lengths of word beginnings
NEAR = 8                    # words between a lexicon word and a second-person word
LONG = 64                   # characters of a word that may be a lexicon entry; a longer one only counts by its beginning and shape
PIECE = 200_000             # characters of a text whose words are held at once
TABLE = 300_000             # lexicon candidates that a counting task holds

FEATURES = ("hits", "weight", "strong", "hits_log", "top_weight", "distinct", "hidden", "you", "near_you", "capitals", "shouted",
            "punctuation", "exclaimed", "runs", "mixed", "stretched", "spelt", "length_log", "word_chars")


@dataclass(frozen=True)
class Training:
    sample: int = 8_000         # labelled documents at most, those of the smallest hash
    tasks: int = 16             # that read the sample
    lexicon: int = 1000         # entries at most, the strongest
    min_docs: int = 3           # toxic documents that hold an entry
    min_g2: float = 20.0        # log-likelihood ratio of its use in toxic and other documents (chi-square, one degree)
    trees: int = 20
    depth: int = 3
    step: float = 0.3
    seed: int = 7


# ------------------------------------------------------------------ words

EDGES = string.punctuation + "«»“”‘’„…¡¿–—"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_STRETCH = re.compile(r"([^\W\d_])\1\1+")
_MIXED = re.compile(r"[^\W\d_][\d@$!+*._-]+(?=[^\W\d_])|\d[^\W\d_]")
_RUN = re.compile(r"([!?.,*#-])\1+")


def core(word: str) -> str:
    """A word without signs at its ends, in lower case."""
    return word.strip(EDGES).lower()


def plain(word: str) -> str:
    """A word with look-alike characters, inner signs and stretched letters undone."""
    return re.sub(r"[\W\d_]+", "", _STRETCH.sub(r"\1", word.lower().translate(LOOK_ALIKE)))


def entries(word: str) -> list[str]:
    """Lexicon candidates of a core: the word, and its beginnings (marked by ``~``)."""
    return ([word] if len(word) <= LONG else []) + [word[:k] + "~" for k in PREFIXES if len(word) >= k]


def pieces(text: str | None):
    """Words of a whole text, about ``PIECE`` characters at a time."""
    text, at = text or "", 0
    while at < len(text):
        m = _BLANK.search(text, at + PIECE)
        end = m.start() if m else len(text)
        if words := _WORD.findall(text, at, end):
            yield words
        at = end


class Shapes(dict):
    """Word -> dense id; row id of ``table`` holds what a text sums over its words. Starts anew past ``limit`` words."""

    COLUMNS = ("weight", "strong", "hidden", "you", "upper", "letters", "shouted", "punctuation", "exclaimed", "runs", "mixed", "stretched", "single", "chars")

    def __init__(self, lexicon: dict[str, float], strong: float, limit: int = 1 << 17):
        super().__init__()
        self.lexicon, self.strong, self.limit = lexicon, strong, limit
        self.starts = {e.rstrip("~")[:min(PREFIXES)] for e in lexicon}
        self.table = np.empty((0, len(self.COLUMNS)))

    def weight(self, word: str) -> float:
        if word[:min(PREFIXES)] not in self.starts:
            return 0.0
        return max((self.lexicon.get(e, 0.0) for e in entries(word)), default=0.0)

    def row(self, w: str) -> tuple:
        c = core(w)
        own = found = self.weight(c)
        upper = 0 if w.islower() else sum(map(str.isupper, w))
        stretched = bool(_STRETCH.search(c))
        if c.isalpha():
            letters, signs, mixed = len(c), len(w) - len(c), False
        else:
            letters, signs = sum(map(str.isalpha, c)), len(w) - sum(map(str.isalnum, w))
            mixed = bool(_MIXED.search(w))
        if not own and (stretched or not c.isalpha() or w[0] in "@$+"):
            found = self.weight(plain(w[:LONG]))
        return (found, found >= self.strong, found > 0 and not own, c in SECOND_PERSON, upper, letters, upper == letters > 1, signs,
                w.count("!") if signs else 0, signs > 1 and bool(_RUN.search(w)), mixed, stretched, letters == len(c) == 1, len(w))

    def ids(self, words: list[str]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        new = [w for w in set(words) if w not in self]
        if new:
            at, end = len(self), len(self) + len(new)
            self.update(zip(new, range(at, end)))
            if end > len(self.table):
                grown = np.empty((end + end // 2, len(self.COLUMNS)))
                grown[:at] = self.table[:at]
                self.table = grown
            self.table[at:end] = np.array([self.row(w) for w in new], np.float64)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _near(hits: np.ndarray, you: np.ndarray) -> int:
    """How many of the ascending places ``hits`` have a place of ``you`` within ``NEAR`` words."""
    if not len(hits) or not len(you):
        return 0
    after = np.append(you, np.iinfo(np.int64).max // 2)[np.searchsorted(you, hits)]
    before = np.append(-(1 << 60), you)[np.searchsorted(you, hits, "right")]
    return int(np.count_nonzero(np.minimum(after - hits, hits - before) <= NEAR))


def features(text: str | None, shapes: Shapes) -> np.ndarray:
    """The values of ``FEATURES``; a text without words has only zeros."""
    col = {name: i for i, name in enumerate(Shapes.COLUMNS)}
    sums, n, hits, near, top, spelt, distinct = np.zeros(len(col)), 0, 0, 0, 0.0, 0, set()
    for words in pieces(text):
        ids = shapes.ids(words)
        kinds, times = np.unique(ids, return_counts=True)
        rows = shapes.table[kinds]
        sums += times @ rows
        n += len(words)
        hit_kind = rows[:, col["weight"]] > 0
        if hit_kind.any():
            at = np.flatnonzero(shapes.table[ids, col["weight"]] > 0)
            hits += len(at)
            top = max(top, rows[:, col["weight"]].max())
            distinct.update(hash(words[i]) for i in at)
            if rows[:, col["you"]].any():
                near += _near(at, np.flatnonzero(shapes.table[ids, col["you"]] > 0))
        if rows[:, col["single"]].any():
            single = np.append(0, shapes.table[ids, col["single"]])
            runs = np.flatnonzero(np.diff(np.append(single, 0)))        # starts and ends of runs of single letters
            size = runs[1::2] - runs[::2]
            spelt += int(size[size >= 3].sum())
    if not n:
        return np.zeros(len(FEATURES))
    s = dict(zip(Shapes.COLUMNS, sums))
    return np.array([hits / n, s["weight"] / n, s["strong"] / n, np.log1p(hits), top, len(distinct) / n, s["hidden"] / n, s["you"] / n,
                     near / n, s["upper"] / max(1, s["letters"]), s["shouted"] / n, s["punctuation"] / s["chars"], s["exclaimed"] / n,
                     s["runs"] / n, s["mixed"] / n, s["stretched"] / n, spelt / n, np.log1p(n), s["chars"] / n])


# ------------------------------------------------------------------ training

def held_out(column: str):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, t: Training) -> DataFrame:
    """(doc_id, text, toxic, half, fifth): one row per labelled document that is not held out, at
    most ``t.sample``; half (of the lexicon) and fifth (0: calibration) come from a hash of the id."""
    marked = (labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id"))
              .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(t.sample)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
            .withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(t.seed)), F.lit(10)))
            .select("doc_id", "text", "toxic", (F.col("h") % 2).alias("half"), F.floor(F.col("h") / 2).alias("fifth")))


def candidates(rows: DataFrame) -> DataFrame:
    """(entry, and for each half: toxic and other use, toxic documents). A document gives an entry
    log2(1 + its count), so one text that repeats a word does not make it an entry."""
    names = [f"{kind}{half}" for half in (0, 1) for kind in ("a", "b", "docs")]

    def run(batches):
        found = defaultdict(lambda: [0.0] * 6)

        def flush():
            out = {"entry": list(found)} | {n: [x[i] for x in found.values()] for i, n in enumerate(names)}
            found.clear()
            return out

        for batch in batches:
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                times = defaultdict(int)
                for words in pieces(text):
                    for w in words:
                        times[core(w)] += 1
                seen = defaultdict(int)
                for w, k in times.items():
                    for e in entries(w):
                        seen[e] += k
                for e, k in seen.items():
                    x = found[e]
                    x[3 * half + 1 - toxic] += math.log2(1 + k)
                    x[3 * half + 2] += toxic
                if len(found) > TABLE:
                    yield flush()
        if found:
            yield flush()

    counted = map_batches(rows.select("text", "toxic", F.col("half").cast("int")), run, "entry string, " + ", ".join(f"{n} double" for n in names))
    return counted.groupBy("entry").agg(*(F.sum(n).alias(n) for n in names))


def choose(counted: DataFrame, halves: tuple, t: Training) -> dict[str, float]:
    """Entry -> log-odds of the ``t.lexicon`` entries at most that mark the toxic documents of ``halves``."""
    per = counted.select("entry", *(sum(F.col(f"{kind}{h}") for h in halves).alias(kind) for kind in ("a", "b", "docs")))
    total = per.agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
    a, b, n = F.col("a"), F.col("b"), F.col("all_a") + F.col("all_b")
    told = lambda x, side: F.when(x > 0, x * F.log(x * n / ((a + b) * F.col(side)))).otherwise(0.0)
    odds = F.log((a + 0.5) / (F.col("all_a") + 0.5)) - F.log((b + 0.5) / (F.col("all_b") + 0.5))
    best = (per.crossJoin(F.broadcast(total))       # one row
            .select("entry", "docs", odds.alias("w"), (2 * (told(a, "all_a") + told(b, "all_b"))).alias("g2"))
            .where((F.col("docs") >= t.min_docs) & (F.col("w") > 0) & (F.col("g2") >= t.min_g2))
            .orderBy(F.desc("g2"), "entry").limit(t.lexicon))
    return {r["entry"]: r["w"] for r in best.collect()}     # at most t.lexicon rows


def with_features(rows: DataFrame, lexicon: dict[str, float], *keep: str) -> DataFrame:
    """``keep`` columns of ``rows`` and a ``features`` vector of its text. The lexicon is bounded, so it goes with the tasks."""
    strong = float(np.median(list(lexicon.values()))) if lexicon else 1.0
    types = dict(rows.dtypes)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        shapes = Shapes(lexicon, strong)
        for batch in batches:
            values = [features(text, shapes) for text in batch.column(0).to_pylist()]
            yield {"x": values} | {n: batch.column(i + 1) for i, n in enumerate(names)}

    out = map_batches(rows.select("text", *keep), run, ", ".join(["x array<double>", *(f"{n} {types[k]}" for n, k in zip(names, keep))]))
    return out.select(*(F.col(n).alias(k) for n, k in zip(names, keep)), array_to_vector("x").alias("features"))


@dataclass
class Model:
    lexicon: dict
    trees: object       # None: one class or no label, every text has the score ``base``
    calibration: object
    base: float

    def apply(self, featured: DataFrame) -> DataFrame:
        """``featured`` with a ``score``."""
        if self.trees is None:
            return featured.withColumn("score", F.lit(self.base)).drop("features")
        p = vector_to_array("probability")[1]
        x = self.trees.transform(featured).select(*(c for c in featured.columns if c != "features"), p.alias("raw"))
        if self.calibration is not None:
            x = self.calibration.transform(x)
        else:
            x = x.withColumn("score", F.col("raw"))
        return x.withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))).drop("raw")


def train(docs: DataFrame, labels: DataFrame, t: Training = Training()) -> Model:
    """Lexicon, trees and calibration from ``labels(doc_id, toxic)`` and the texts of ``docs``."""
    rows = materialize(training_rows(docs, labels, t).repartition(t.tasks), "toxic_rows")
    counted = materialize(candidates(rows), "toxic_words")
    halves = [choose(counted, (h,), t) for h in (0, 1)]
    lexicon = choose(counted, (0, 1), t)
    featured = materialize(with_features(rows.where("half = 0"), halves[1], "toxic", "fifth").unionByName(
        with_features(rows.where("half = 1"), halves[0], "toxic", "fifth")), "toxic_features")
    seen = {(r["fit"], r["toxic"]): r["count"] for r in featured.groupBy((F.col("fifth") > 0).alias("fit"), "toxic").count().collect()}
    fit, check = ({y: seen.get((side, y), 0) for y in (0, 1)} for side in (True, False))
    base = (fit[1] + check[1]) / max(1, sum(fit.values()) + sum(check.values()))
    if not fit[0] or not fit[1]:
        discard(rows, counted, featured)
        return Model(lexicon, None, None, base)
    few = featured.coalesce(4)      # at most t.sample rows of len(FEATURES) numbers
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=t.trees, maxDepth=t.depth, stepSize=t.step, seed=t.seed,
                          minInstancesPerNode=5).fit(few.where("fifth > 0").select("features", F.col("toxic").cast("double").alias("label")))
    calibration = None
    if check[0] and check[1]:
        held = trees.transform(few.where("fifth = 0")).select(vector_to_array("probability")[1].alias("raw"), F.col("toxic").cast("double").alias("label"))
        calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(held)
    discard(rows, counted, featured)
    return Model(lexicon, trees, calibration, base)


def score(docs: DataFrame, labels: DataFrame, t: Training = Training(), threshold: float = 0.3) -> DataFrame:
    """``docs(doc_id, text)`` scored by a model trained on ``labels(doc_id, toxic)`` -> per row
    (doc_id, held_out, score, predicted).

    Only the text enters a score, whole and of any length; other columns are not read.
    A null, empty or blank text has all features 0 and the score of that point. A null
    doc_id is not held out and not trained on. Labels that are null or not 0 or 1 are
    left out, of contradicting ones the higher counts; of rows that repeat a
    doc_id the smallest text is trained on, all are scored. Without labels of both
    classes every score is the share of toxic ones (0 without any); without both
    in the part for calibration the trees' probability is the score. No rows, no result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    model = train(docs, labels, t)
    scored = model.apply(with_features(docs, model.lexicon, "doc_id"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
