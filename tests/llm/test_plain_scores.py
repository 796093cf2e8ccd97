"""Scores and verdicts of operators 2, 5 and 10 against plain versions, word by word."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from ratings_engine.llm import lm_score, quality_model, quality_rules
from tests.conftest import SF_SMALL

MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()


def _words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


# ------------------------------------------------------------------ op2

def _mixed(h):
    h ^= h >> 31
    h = h * 0xBF58476D1CE4E5B9 & MASK
    h ^= h >> 29
    h = h * 0x94D049BB133111EB & MASK
    return h ^ h >> 32


def _bucket(h):
    return _mixed(h) % (quality_model.BUCKETS - 2) + 2


def _buckets(word):
    out = [_bucket(xxhash.xxh32_intdigest(word))]
    marked = "<" + word.decode() + ">"
    for k in (3, 4):
        for i in range(len(marked) - k + 1):
            h = k
            for c in marked[i:i + k]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) & MASK
            out.append(_bucket(h))
    return out


def test_op2_logit(documents):
    shares = np.random.default_rng(5).normal(size=quality_model.BUCKETS)
    texts = [r["text"] for r in documents][:80] + [None, "", " \n", "one", "a a a b a", "é東京 𝄞 é東京"]
    got = quality_model._Scored(shares, (3, 4)).logits(texts, 0.25)
    for text, z in zip(texts, got):
        words = _words(text)
        parts = [b for w in words for b in _buckets(w)]
        parts += [quality_model.SAME] * (12 * sum(a == b for a, b in zip(words, words[1:])))
        parts += [quality_model.SAME_NEXT] * (12 * sum(a == b for a, b in zip(words, words[2:])))
        assert math.isclose(z, 0.25 + (sum(shares[b] for b in parts) / len(parts) if parts else 0), rel_tol=1e-9, abs_tol=1e-9)


# ------------------------------------------------------------------ op5

def _class(c):
    if c in " \t\n\v\f\r":
        return 0
    if ord(c) >= 128:
        return 6
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return 1 if c.islower() else 2
    if c.isdigit():
        return 3
    if c in ".,;:!?'\"()-":
        return 4
    return 7 if ord(c) < 32 or ord(c) == 127 else 5


def _histogram(text):
    n = collections.Counter(map(_class, text))
    return [n[i] for i in range(8)]


def _js(p, q):
    p, q = ([x / sum(v) for x in v] for v in (p, q))
    out = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        out += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(0.0, out))


def test_op5_distances_and_verdict(spark, documents):
    rules = quality_rules.Rules()
    by_lang = collections.defaultdict(list)
    for r in documents:
        by_lang[r["lang"]].append(r["text"] or "")
    refs = {}
    for lang, texts in by_lang.items():
        words = collections.Counter(w for t in texts for w in _words(t))
        if lang and sum(words.values()) >= rules.reference_words:
            top = dict(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:rules.common_words])
            refs[lang] = ([sum(x) for x in zip(*map(_histogram, texts))], top, sum(words.values()))
    assert refs
    got = {r["doc_id"]: r for r in entry.queries()["op5_quality_rules"](spark, SF_SMALL).collect()}
    counted = 0
    for r in documents:
        text, words, g = r["text"] or "", _words(r["text"]), got[r["doc_id"]]
        pick = [refs[r["lang"]]] if r["lang"] in refs else list(refs.values())
        char = min(_js(_histogram(text), ref[0]) for ref in pick) if len(text.encode()) >= rules.min_chars else None
        word = None
        if len(words) >= rules.min_words:
            mine = collections.Counter(words)
            word = min(_js([mine[w] for w in ref[1]] + [len(words) - sum(mine[w] for w in ref[1])],
                           [*ref[1].values(), ref[2] - sum(ref[1].values())]) for ref in pick)
        for a, b in ((g["char_distance"], char), (g["word_distance"], word)):
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)), r["doc_id"]
        assert g["kept"] == (not g["base_failed"] and (char or 0) <= rules.max_char_distance and (word or 0) <= rules.max_word_distance)
        counted += char is not None and word is not None
    assert counted > 50


# ------------------------------------------------------------------ op10

def test_op10_score_with_exact_pair_counts(spark, documents):
    """The filter can only raise a pair's count: scores lie at or above those of exact counts, by little."""
    tokens = {r["doc_id"]: [b"\n", *_words((r["text"] or "").encode().lower().decode()), b""] for r in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    words, pairs = collections.Counter(), collections.Counter()
    for i, ws in tokens.items():
        if not held[i]:
            words.update(ws[1:])
            words[b"\n"] += 1
            pairs.update(zip(ws, ws[1:]))
    starts = words.pop(b"\n")
    n, v = sum(words.values()), len(words)
    got = {r["doc_id"]: r["score"] for r in entry.queries()["op10_lm_score"](spark, SF_SMALL).collect()}
    more = total = 0
    for i, ws in tokens.items():
        exact = 0.0
        for u, w in zip(ws, ws[1:]):
            p, before = (words[w] + 1) / (n + v + 1), starts if u == b"\n" else words[u]
            c = 2 ** int(math.log2(pairs[u, w])) if pairs[u, w] else 0
            exact += math.log10(lm_score.WEIGHT * min(1, c / before) + (1 - lm_score.WEIGHT) * p if before else p)
        assert got[i] >= exact - 1e-9 * abs(exact)
        more += got[i] - exact
        total += len(ws) - 1
    assert more / total < 0.02


def test_large_models_are_asked_by_chunk(spark, monkeypatch):
    """No row per token: chunks of texts ask for their distinct words and pairs. Scores are those of the broadcast model."""
    monkeypatch.setattr(lm_score, "ASKED", 2000)
    texts = [" ".join(f"w{(i * j) % 37}" for j in range(i % 60)) for i in range(300)] + [None, "", "w1 " * 3000]
    docs = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts)] * 2, "doc_id bigint, text string").repartition(3)
    asked = lm_score.score(docs, broadcast_bytes=0)
    assert "Join" not in asked._jdf.queryExecution().optimizedPlan().toString()
    plain = lambda df: sorted((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in df.collect())
    assert plain(asked) == plain(lm_score.score(docs))
