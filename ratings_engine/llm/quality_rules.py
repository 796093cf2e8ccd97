"""Quality rules by distribution divergence.

A document's histograms of character classes and of its language's commonest
words are held against references gathered from the whole corpus, by
Jensen-Shannon distance (base 2, 0 to 1). Short texts have noisy histograms, so
either distance counts only above a minimum length.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import Vocab, gram_hashes, map_batches, words_of

# Character classes of UTF-8 bytes (fixed values); continuation bytes count with their lead byte.
SPACE, LOWER, UPPER, DIGIT, SENTENCE, MARK, WIDE, CONTROL, TAIL = range(9)
SYMBOLS = "#*$%&|<>"
CLASS = np.full(256, MARK, np.uint8)
CLASS[:32], CLASS[127] = CONTROL, CONTROL
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[97:123], CLASS[65:91], CLASS[48:58] = LOWER, UPPER, DIGIT
CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = SENTENCE
CLASS[128:192], CLASS[192:] = TAIL, WIDE


@dataclass(frozen=True)
class Rules:
    common_words: int = 100        # words of a language's reference
    min_chars: int = 300           # guard of the character distance
    min_words: int = 80            # guard of the word distance
    max_char_distance: float = 0.22
    max_word_distance: float = 0.43
    reference_words: int = 1000    # a language with less text is compared with the closest reference


def _class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(CLASS[np.frombuffer(raw, np.uint8)], minlength=9)[:TAIL]


def _js(p: np.ndarray, q: np.ndarray) -> float:
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = [np.where(x > 0, x * np.log2(x / m), 0.0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, (kl[0] + kl[1]) / 2)))


def references(docs: DataFrame, rules: Rules) -> dict:
    """lang -> (class counts, {common word: count}, words). Bounded: a row of
    classes and ``common_words`` words for each language."""
    docs = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), "text")

    def count(batches):
        seen: dict[str, Counter] = {}

        def flush():
            rows = [(lang, w.decode("utf-8", "surrogateescape"), c) for lang, words in seen.items() for w, c in words.items()]
            seen.clear()
            return {"lang": [r[0] for r in rows], "word": [r[1] for r in rows], "n": [r[2] for r in rows]}

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, seen.values())) > 400_000:
                yield flush()
        yield flush()

    def classes(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    total[lang] = total.get(lang, 0) + _class_counts(text.encode("utf-8", "surrogatepass"))
        yield {"lang": list(total), **{f"c{i}": [int(v[i]) for v in total.values()] for i in range(TAIL)}}

    cols = [f"c{i}" for i in range(TAIL)]
    by_class = (map_batches(docs, classes, "lang string, " + ", ".join(f"{c} bigint" for c in cols))
                .groupBy("lang").agg(*(F.sum(c).alias(c) for c in cols)))
    words = map_batches(docs, count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    top = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = words.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= rules.common_words)
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    out = {}
    for r in common.groupBy("lang").agg(F.collect_list(F.struct("word", "n")).alias("common")).join(totals, "lang").join(by_class, "lang").collect():
        if r["words"] >= rules.reference_words and r["lang"]:
            vocab = {w["word"].encode("utf-8", "surrogateescape"): w["n"] for w in r["common"]}
            out[r["lang"]] = (np.array([r[c] for c in cols], float), vocab, r["words"])
    return out


def _repeat_words(h: np.ndarray) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    g = gram_hashes(h, 3)
    if len(g) < 2:
        return 0
    _, where, n = np.unique(g, return_inverse=True, return_counts=True)
    again = n[where] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[j:j + len(g)] |= again
    return int(covered.sum())


def _dup_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    return sum(c - 1 for line, c in Counter(lines).items() if c > 1 and line.strip("\x20\t\n\x0b\x0c\r"))


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs(doc_id, text, lang)`` -> per row (doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance, word_distance).

    A document fails if the base rules fail it, or if a distance above its
    length guard exceeds its threshold. Distances are null under the guard. The
    reference is that of the document's language; a null or little-seen
    language takes the closest one. Null and empty texts have no words and fail
    the base rule. Null ids stay null. Rows that repeat are judged each.
    """
    refs = references(docs, rules)
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def run(batches):
        vocab = Vocab()
        known = {}
        for lang, (classes, words, total) in shared.value.items():
            h = vocab.hashes(list(words))
            order = np.argsort(h)
            n = np.array(list(words.values()), float)[order]
            known[lang] = (classes, h[order], np.append(n, total - n.sum()))

        def distances(raw, h, lang):
            pick = [known[lang]] if lang in known else list(known.values())
            char = word = None
            if len(raw) >= rules.min_chars and pick:
                mine = _class_counts(raw).astype(float)
                char = min(_js(mine, r[0]) for r in pick)
            if len(h) >= rules.min_words and pick:
                word = min(_js(_word_counts(h, r[1]), r[2]) for r in pick)
            return char, word

        for batch in batches:
            rows = []
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = text or ""
                raw = text.encode("utf-8", "surrogatepass")
                h = vocab.hashes(raw.split())
                spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
                rep = _repeat_words(h)
                failed = len(h) < 50 or 100 * rep > 50 * len(h)
                char, word = distances(raw, h, lang)
                kept = not failed and not (char or 0) > rules.max_char_distance and not (word or 0) > rules.max_word_distance
                rows.append((len(h), len(text) - spaces, sum(text.count(c) for c in SYMBOLS), _dup_lines(text), rep, failed, kept, char, word))
            cols = list(zip(*rows)) or [[]] * 9
            yield {"doc_id": batch.column(0)} | dict(zip(OUT, cols))

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text", "lang"), run,
                       "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                       "n_repeat_words bigint, base_failed boolean, kept boolean, char_distance double, word_distance double")


OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def _word_counts(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    n = np.bincount(at[common[at] == h], minlength=len(common)).astype(float)
    return np.append(n, len(h) - n.sum())
