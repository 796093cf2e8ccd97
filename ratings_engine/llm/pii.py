"""Personal data: patterns for protected entities, and information-theoretic
sanitisation of the terms around them.

The pattern spans (email, ip, card, phone) are the protected entities. A term
of a document that holds an entity can give it away without naming it. What a
term t reveals of an entity e is estimated from the corpus:

    PMI(e, t) = log(N * df(e, t) / (df(e) * df(t)))     IC(e) = log(N / df(e))

with document frequencies over all N documents. A term whose share PMI / IC is
``DISCLOSURE`` or more is disclosing if their co-occurrence is no chance: of the n
documents of e, a share x holds t, and by the Chernoff bound so many have
probability exp(-n KL(x, df(t)/N)) at most. n counts documents by what differs
between them (``_entities``): a document and its copies, edited here and there, are little over
one. Tested are the pairs that share ``SHARED`` such documents or more: a single
one goes with all of its words alike and tells none apart. Of the tested pairs those
are kept whose false-discovery rate (Benjamini-Hochberg) is at most ``RISK``, so what is found in
a part of a corpus does not get lost as other entities and terms are added. Every occurrence of a disclosing term
in every document is a span of kind ``term``, also where the entity is not spelled out.

The share of a pair is under ``DISCLOSURE`` whenever df(t) is above
N * (df(e) / N) ** DISCLOSURE, so pairs are formed only below it. Up to ``BROADCAST``
disclosing terms (8 bytes each) go to all tasks; more of them meet the documents' terms in a join.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import discard, materialize
from .spans import Cover, digest, in_order
from .text import Vocab, map_batches, signed

DISCLOSURE, RISK, SHARED = 0.75, 0.05, 1.5
BINS, STEP = 16, 0x9E3779B97F4A7C15       # of a document's sketch
BROADCAST = 1 << 20

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match that starts inside a digit run also starts at the run, so the look-behind changes
# nothing but keeps a long run of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?()[]{}\"'<>|*#&%$"


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            floor = m.end()
        at = text.find("@", max(at + 1, floor))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _card(s: str) -> bool:
    d = _digits(s)
    return 14 <= len(d) <= 19 and _luhn(d)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def entities(text: str) -> dict[str, list[tuple[int, int]]]:
    """Base spans of a whole text, leftmost and not overlapping within a kind."""
    return {
        "email": _emails(text),
        "ip": [m.span() for m in IP.finditer(text) if all(map(_byte, m[0].split(".")))],
        "card": [m.span() for m in CARD.finditer(text) if _card(m[0])],
        "phone": [m.span() for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15] if "+" in text else [],
    }


def _clean(word: str) -> tuple[str, int]:
    left = len(word) - len(word.lstrip(EDGES))
    return word.strip(EDGES), left


def _hash(s: str) -> int:
    """64-bit hash as a signed number."""
    h = xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _seen(text: str, found: dict) -> tuple[list, list, list]:
    """Of a document with entities: these, its distinct terms outside them, and a sketch of the terms, the
    least hash of each of ``BINS`` bins. An empty bin takes the next one's, changed by the distance, so
    that two documents agree in a bin as often as they share words; without terms there is no sketch."""
    spans = [s for v in found.values() for s in v]
    if not spans:
        return [], [], []
    taken = Cover(spans)
    terms = {_clean(m[0])[0].lower() for m in TERM.finditer(text) if not taken.meets(*m.span())}
    hashes, least, sketch = sorted(map(_hash, terms - {""})), {}, []
    for h in reversed(hashes):
        least[h % BINS] = h
    for i in range(BINS) if least else ():
        step = next(d for d in range(BINS) if (i + d) % BINS in least)
        sketch.append((least[(i + step) % BINS] + step * STEP + (1 << 63)) % (1 << 64) - (1 << 63))
    return sorted({_hash(text[s:e].lower()) for s, e in spans}), hashes, sketch


def _term_counts(docs: DataFrame) -> DataFrame:
    """(t, df): documents that hold each term, over the whole corpus."""

    def run(batches):
        vocab, parts, size = _TermVocab(), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    parts.append(np.unique(vocab.hashes(list(set(text.encode("utf-8", "surrogatepass").split())))))
                    size += len(parts[-1])
            if size > 1_000_000:
                yield _counted(parts)
                parts, size = [], 0
        if parts:
            yield _counted(parts)

    return map_batches(docs.select("text"), run, "t bigint, df bigint").groupBy("t").agg(F.sum("df").alias("df"))


class _TermVocab(Vocab):
    """Words by the hash of their cleaned, lower-cased form."""

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.table)
        self.table.append(_hash(_clean(word.decode("utf-8", "surrogatepass"))[0].lower()) % (1 << 64))
        return i


def _counted(parts):
    t, n = np.unique(np.concatenate(parts), return_counts=True)
    return {"t": signed(t), "df": n}


def _counts_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``_term_counts`` of the terms of ``terms`` (t) alone. Up to ``BROADCAST`` of them go to all tasks, which then look up
    words instead of shuffling the vocabulary of the corpus."""
    n = terms.count()
    if not n:
        return docs.sparkSession.createDataFrame([], "t bigint, df bigint")
    if n > BROADCAST:
        return _term_counts(docs).join(terms, "t", "left_semi")
    known = docs.sparkSession.sparkContext.broadcast(np.sort(terms.toPandas()["t"].to_numpy(np.int64)))

    def run(batches):
        at, df, seen = _Places(known.value), np.zeros(len(known.value), np.int64), []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen += at.of(set(text.encode("utf-8", "surrogatepass").split()))
            df += np.bincount(np.array(seen, np.int64), minlength=len(df))
            seen = []
        held = np.flatnonzero(df)
        yield {"t": known.value[held], "df": df[held]}

    return map_batches(docs.select("text"), run, "t bigint, df bigint").groupBy("t").agg(F.sum("df").alias("df"))


class _Places(dict):
    """Word -> place of its term among the sorted ``terms``, -1 if it is none; starts anew past ``limit`` words."""

    def __init__(self, terms: np.ndarray, limit: int = 1 << 18):
        super().__init__()
        self.terms, self.limit = memoryview(terms), limit

    def __missing__(self, word: bytes) -> int:
        h = _hash(_clean(word.decode("utf-8", "surrogatepass"))[0].lower())
        at = bisect_left(self.terms, h)
        self[word] = at = at if at < len(self.terms) and self.terms[at] == h else -1
        return at

    def of(self, words: set) -> set:
        """Distinct places of the words of a text."""
        if len(self) > self.limit:
            self.clear()
        return set(map(self.__getitem__, words)) - {-1}


def disclosing(docs: DataFrame) -> DataFrame:
    """(t): hashes of the terms above the disclosure threshold, over the whole corpus, written."""

    def run(batches):
        for batch in batches:
            rows = [r for text in batch.column(0).to_pylist() if text and (r := _seen(text, entities(text)))[0]]
            yield dict(zip(("es", "ts", "sketch"), zip(*rows))) if rows else {"es": [], "ts": [], "sketch": []}

    total = docs.count()
    scan = map_batches(docs.select("text"), run, "es array<bigint>, ts array<bigint>, sketch array<bigint>")
    scan = materialize(scan.withColumn("key", F.monotonically_increasing_id()), "pii")
    of = scan.select("key", F.explode("es").alias("e"))
    df_e = _entities(scan).where(F.col("df_e") < total)
    known = df_e = materialize(df_e, "entities")
    df_e = df_e.where(F.col("n_e") >= SHARED)
    top = df_e.agg(F.max("df_e")).first()[0]
    if top is None:
        discard(scan, known)
        return docs.sparkSession.createDataFrame([], "t bigint")
    most = lambda n: total * F.pow(n / total, F.lit(DISCLOSURE)) * (1 + 1e-9)
    of = of.join(df_e, "e")
    ts = scan.join(of.select("key").distinct(), "key", "left_semi").select("key", F.explode("ts").alias("t"))
    # a pair shares SHARED documents only if two or more of these documents hold its term; its df is not below their number
    near = ts.groupBy("t").agg(F.count("*").alias("n")).where((F.col("n") >= 2) & (F.col("n") <= most(F.lit(top))))
    near = materialize(near.select("t"), "near")
    counts = materialize(_counts_of(docs, near), "terms")
    held = ts.join(counts.where(F.col("df") <= most(F.lit(top))), "t")
    pairs = held.join(of, "key").where(F.col("df") <= most(F.col("df_e"))).groupBy("e", "t").agg(
        F.count("*").alias("df_et"), *(F.first(c).alias(c) for c in ("df", "df_e", "n_e")))     # a document has each e and each t once
    share = F.log(F.lit(total) * F.col("df_et") / (F.col("df_e") * F.greatest("df", "df_et"))) / F.log(F.lit(total) / F.col("df_e"))
    x = F.col("df_et") / F.col("df_e")
    q = F.least(F.col("df") / total, x)
    chance = F.col("n_e") * (x * F.log(x / q) + F.when(x < 1, (1 - x) * F.log((1 - x) / (1 - q))).otherwise(0.0))
    tested = materialize(pairs.where(F.col("n_e") * x >= SHARED).select("t", share.alias("share"), chance.alias("chance")), "tested")
    terms = materialize(tested.where((F.col("share") >= DISCLOSURE) & (F.col("chance") >= _least_chance(tested))).select("t").distinct(), "disclosing")
    discard(scan, known, near, counts, tested)
    return terms


def _entities(scan: DataFrame) -> DataFrame:
    """(e, df_e, n_e): documents of each entity, and how many they amount to. In each bin of the
    sketches, documents are counted by the value there; the inverse Simpson index of the counts is n if all differ
    and little over 1 if most agree. Two documents agree in a bin as often as they share words, so the
    mean over the bins counts a copy as a small part of a document, and different texts nearly whole."""
    df_e = scan.select(F.explode("es").alias("e")).groupBy("e").agg(F.count("*").alias("df_e"))
    long = (scan.select(F.explode("es").alias("e"), "sketch").join(df_e.where("df_e > 1").select("e"), "e", "left_semi")
            .select("e", F.posexplode("sketch").alias("at", "q")))
    bins = long.groupBy("e", "at", "q").agg(F.count("*").alias("c")).groupBy("e", "at").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("cc"))
    index = bins.groupBy("e").agg(F.avg(F.col("n") * F.col("n") / F.col("cc")).alias("n_e"))
    return df_e.join(index, "e", "left").select("e", "df_e", F.coalesce("n_e", F.lit(1.0)).alias("n_e"))


BIN, TOP = 1 / 16, 60.0     # steps of -log probability, and where they end


def _least_chance(tested: DataFrame) -> float:
    """The -log probability from which on pairs are kept: the lowest at which the expected share of
    chance finds, tests * probability / pairs kept, is at most ``RISK``. One small histogram."""
    hist = tested.groupBy(F.floor(F.least("chance", F.lit(TOP)) / BIN).cast("int").alias("b")).count().collect()    # TOP / BIN rows at most
    tests, kept, least = sum(r["count"] for r in hist), 0, math.inf
    for r in sorted(hist, key=lambda r: -r["b"]):
        kept += r["count"]
        if tests * math.exp(-r["b"] * BIN) <= RISK * kept:
            least = r["b"] * BIN
    return least


class _Disclosing(dict):
    """Word -> whether its term is in the set; starts anew past ``limit`` words."""

    def __init__(self, terms: np.ndarray, limit: int = 1 << 18):
        super().__init__()
        self.terms, self.limit = memoryview(terms), limit

    def __missing__(self, word: bytes) -> bool:
        h = _hash(_clean(word.decode("utf-8", "surrogatepass"))[0].lower())
        at = bisect_left(self.terms, h)
        yes = self[word] = at < len(self.terms) and self.terms[at] == h
        return yes

    def spans(self, text: str, found: dict) -> list[tuple[int, int]]:
        """Every occurrence in a text, outside its entities."""
        if len(self) > self.limit:
            self.clear()
        if not len(self.terms):
            return []
        words = {w.decode("utf-8", "surrogatepass") for w in set(text.encode("utf-8", "surrogatepass").split()) if self[w]}
        return _occurrences(text, found, words) if words else []


def _occurrences(text: str, found: dict, words: set) -> list[tuple[int, int]]:
    """Spans of the terms of ``words`` in one pass over the text, outside its entities."""
    taken, out = Cover(s for v in found.values() for s in v), []
    for m in TERM.finditer(text):
        if m[0] in words and not taken.meets(*m.span()):
            term, left = _clean(m[0])
            out.append((m.start() + left, m.start() + left + len(term)))
    return out


def _with_terms(docs: DataFrame, terms: DataFrame):
    """(``docs``, marker): the marker gives the term spans of (text, entities, held). With few terms it holds the set and
    ``held`` is null; with more, ``docs`` gets a column ``_held`` with the disclosing terms of each row, by a join."""
    if terms.count() <= BROADCAST:
        known = docs.sparkSession.sparkContext.broadcast(np.sort(terms.toPandas()["t"].to_numpy(np.int64)))
        made = []

        def mark(text, found, held):
            if not made:
                made.append(_Disclosing(known.value))
            return made[0].spans(text, found)

        return docs.withColumn("_held", F.lit(None).cast("array<bigint>")), mark

    def hashes(batches):
        for batch in batches:
            of = [sorted({_hash(_clean(w)[0].lower()) for w in TERM.findall(t or "")}) for t in batch.column(1).to_pylist()]
            yield {"_key": batch.column(0), "ts": of}

    rows = materialize(docs.withColumn("_key", F.monotonically_increasing_id()), "keyed")
    long = map_batches(rows.select("_key", "text"), hashes, "_key bigint, ts array<bigint>").select("_key", F.explode("ts").alias("t"))
    held = long.join(terms, "t", "left_semi").groupBy("_key").agg(F.collect_list("t").alias("_held"))   # at most a row's own terms

    def mark(text, found, held):
        if held is None or not len(held):
            return []
        held = set(held)
        return _occurrences(text, found, {w for w in set(TERM.findall(text)) if _hash(_clean(w)[0].lower()) in held})

    return rows.join(held, "_key", "left").drop("_key"), mark


def scan_pii(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> per row (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, terms).

    ``spans`` lists base and term spans of the whole text (code points, end
    exclusive), ``terms`` the term spans alone, null if there are none. Null and
    empty texts have none; long texts are read whole, in time proportional to their length. Each
    row counts as a document, whatever its doc_id. No rows, no result; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    docs, mark = _with_terms(docs, disclosing(docs))

    def run(batches):
        for batch in batches:
            rows = []
            for text, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = entities(text or "")
                term = mark(text or "", found, held)
                rows.append((*(len(v) for v in found.values()), digest(found), ",".join(in_order(found | {"term": term})),
                             [{"s": s, "f": f} for s, f in term] or None))
            yield {"doc_id": batch.column(0)} | dict(zip(("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "terms"), list(zip(*rows)) or [[]] * 7))

    return map_batches(docs, run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
                       "spans string, terms array<struct<s:bigint,f:bigint>>")


def _sanitised(text: str, spans: str) -> str:
    """Entities become their kind, disclosing numbers their shape, other disclosing terms [TERM].
    Of spans that overlap in part, the later one is what the earlier leaves of it."""
    out, at = [], 0
    for kind, s, e in sorted((x.split(":") for x in spans.split(",")), key=lambda x: (int(x[1]), -int(x[2]))):
        s, e = int(s), int(e)
        if e <= at:
            continue
        s = max(s, at)
        old = text[s:e]
        new = re.sub(r"[0-9]", "0", old) if kind == "term" and old.isdigit() else f"[{kind.upper()}]"
        out += [text[at:s], new]
        at = e
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``; rows and columns stay.

    Null and empty texts stay as they are; long texts are read whole. Rows that repeat an id are each a
    document. Columns of any name may come along (but ``_held`` and ``_key``). No rows, no result.
    """
    columns = docs.columns
    docs, mark = _with_terms(docs, disclosing(docs))

    @F.pandas_udf("string")
    def clean(texts: pd.Series, held: pd.Series) -> pd.Series:
        out = []
        for text, terms in zip(texts, held):
            found = entities(text) if text else {}
            labels = in_order(found | {"term": mark(text, found, terms)}) if text else []
            out.append(_sanitised(text, ",".join(labels)) if labels else text)
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", clean("text", "_held")).select(*columns)
