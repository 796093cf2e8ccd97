"""Which sources of a language use its words differently: an audit over run-length columns.

The kept terms of a language are its rows, its sources the columns, the counts
the cells. Rows are reordered so that equal count vectors meet (equal vectors
become one row with a weight, then the vectors are sorted), and each source's
column is run-length encoded in blocks of that order. The divergence of two
sources is a sum over terms; it is taken once per stretch in which both columns
are constant: the run boundaries of the pair are intersected and each value is
multiplied by the length of its stretch. Most terms are rare and absent from
most sources, so a column has few runs where it has many terms.

All arithmetic is exact (integers). Nothing but one language's block is held by
a task: a block has at most ``BLOCK`` cells that are not zero (or one vector).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import discard, materialize
from .text import map_batches

SCALE = 1_000_000_000
BLOCK = 1 << 17         # cells of a block that are not zero
TABLE = 300_000         # (group, term) entries that a counting task holds before it hands them on
PIECE = 1 << 20         # bytes of a text split at once

#: ASCII letters lower-cased, all other ASCII bytes blank: ``split`` then cuts exactly the terms.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(raw: bytes):
    """Terms of a text, in lists of about ``PIECE`` bytes (a longer term stays whole)."""
    clean = raw.translate(LETTERS)
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n occurrences, d documents) of ``docs``, added up within a task only.
    Every group also gives the term '' with zeros, so groups without terms stay."""

    def run(batches):
        found: dict[tuple, tuple[Counter, Counter]] = {}

        def flush():
            cols = {"lang": [], "source": [], "term": [], "n": [], "d": []}
            for (lang, source), (n, d) in found.items():
                cols["lang"] += [lang] * (len(n) + 1)
                cols["source"] += [source] * (len(n) + 1)
                cols["term"] += [b"", *n]
                cols["n"] += [0, *n.values()]
                cols["d"] += [0, *map(d.__getitem__, n)]
            cols["term"] = pa.array(cols["term"], pa.binary()).cast(pa.string())
            found.clear()
            return cols

        for batch in batches:
            for lang, source, raw in zip(*(c.to_pylist() for c in batch.columns)):
                n, d = found.setdefault((lang, source), (Counter(), Counter()))
                once: set = set()
                for terms in _pieces(raw):
                    n.update(terms)
                    once.update(terms)
                d.update(once)
            if sum(len(n) + 1 for n, _ in found.values()) > TABLE:
                yield flush()
        if found:
            yield flush()

    text = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return map_batches(text, run, "lang string, source string, term string, n bigint, d bigint")


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, n, cells array of (source, n)) of terms in at least ``min_docs`` documents of
    their language. The term '' holds every group of the language with 0."""
    per = (term_counts(docs).repartition("lang", "term")        # both aggregates below keep this partitioning
           .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
           .groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"),
                                        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("cells")))
    return per.where((F.col("d") >= min_docs) | (F.col("term") == "")).select("lang", "term", "n", "cells")


def group_totals(terms: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, vocab): one row per group, few columns, many times smaller than the terms."""
    cells = terms.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang = terms.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if(F.col("term") != "").alias("vocab"))
    return cells.join(lang, "lang")


def _share(n: str, total: str):
    return F.expr(f"1 + (cast({n} + 2 as decimal(20,0)) * {SCALE}) div ({total} + 2 * vocab)")


def over_used(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms of each group that it uses more than its language does.
    The ranking is cut within each task before rows of a group meet."""
    x = (terms.where("term <> ''").select("lang", "term", F.col("n").alias("n_lang"), F.inline("cells")).where("n > 0")
         .join(groups, ["lang", "source"])
         .select("lang", "source", "term", _share("n", "total").alias("p"), _share("n_lang", "lang_total").alias("q"))
         .where("p > q")
         .select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))
    return ranked(x, "term").where(F.col("rank") <= top)


def ranked(x: DataFrame, part: str) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return x.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(w).alias("rank"))


# ------------------------------------------------------------------ run-length columns

def encode(starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs (start, value) of a column that is ``values[i]`` in [starts[i], ends[i]) and 0 elsewhere; the
    stretches ascend and do not overlap. Equal neighbours become one run, the first starts at 0."""
    at = np.stack([starts, ends], 1).ravel()
    v = np.stack([values, np.zeros_like(values)], 1).ravel()
    at, v = np.append(0, at), np.append(0, v)
    last = np.append(at[1:] != at[:-1], True)              # of marks at one place the last holds
    at, v = at[last], v[last]
    new = np.append(True, v[1:] != v[:-1])
    return at[new], v[new]


def columns(terms: DataFrame) -> DataFrame:
    """Run-length columns (lang, block, length, source, starts, counts) of the reordered vocabulary.
    A source that is absent from a whole block has no row there."""
    ordered = (terms.where("term <> ''").groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("weight"))
               .repartitionByRange("lang", "cells").sortWithinPartitions("lang", "cells"))

    def run(batches):
        part, seq = TaskContext.get().partitionId() << 32, 0

        def block(lang, weights, sizes, sources, counts):
            ends = np.cumsum(np.array(weights, np.int64))
            row = np.repeat(np.arange(len(weights)), sizes)
            names, of = np.unique(np.array(sources, object), return_inverse=True)
            counts = np.array(counts, np.int64)
            out = {k: [] for k in ("lang", "block", "length", "source", "starts", "counts")}
            order = np.argsort(of, kind="stable")
            for name, at in zip(names, np.split(order, np.cumsum(np.bincount(of, minlength=len(names)))[:-1])):
                e = ends[row[at]]
                starts, values = encode(e - np.array(weights, np.int64)[row[at]], e, counts[at])
                inner = starts < ends[-1]
                for key, value in (("lang", lang), ("block", part + seq), ("length", int(ends[-1])), ("source", name),
                                   ("starts", starts[inner]), ("counts", values[inner])):
                    out[key].append(value)
            return out

        held, lang_now = ([], [], [], []), None
        for batch in batches:
            for lang, cells, weight in zip(*(c.to_pylist() for c in batch.columns)):
                if held[0] and (lang != lang_now or len(held[2]) + len(cells) > BLOCK):
                    yield block(lang_now, *held)
                    held, seq = ([], [], [], []), seq + 1
                lang_now = lang
                held[0].append(weight)
                held[1].append(len(cells))
                held[2].extend(c["source"] for c in cells)
                held[3].extend(c["n"] for c in cells)
        if held[0]:
            yield block(lang_now, *held)

    return map_batches(ordered, run, "lang string, block bigint, length bigint, source string, starts array<bigint>, counts array<bigint>")


def shares(counts: np.ndarray, total: int, vocab: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * vocab)), by long division of three digits a step:
    exact in 64 bits up to 9e15 terms."""
    by = total + 2 * vocab
    whole, rest = np.divmod(counts + 2, by)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, by)
        whole = whole * 1000 + digits
    return whole + 1


def intersect(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """Sum of f over a block: f once per stretch in which both columns are constant, times its length."""
    at = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], at, "right") - 1]
    q = b[1][np.searchsorted(b[0], at, "right") - 1]
    return int(((p - q) ** 2 // (p + q) * np.diff(np.append(at, length))).sum())


def pair_sums(cols: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language. A group of the
    Python step is one block: its columns, and a run of zeros for each source absent there.
    A block of length 0 stands for each language, so that pairs without kept terms appear with 0."""
    blocks = cols.select("lang", "block", "length").distinct().unionByName(
        groups.select("lang", F.lit(-1).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("length")).distinct())
    full = (blocks.join(groups.select("lang", "source", "total", "vocab"), "lang")
            .join(cols.drop("length"), ["lang", "block", "source"], "left"))

    def run(x: pd.DataFrame) -> pd.DataFrame:
        length, lang = int(x["length"].iloc[0]), x["lang"].iloc[0]
        names, out = sorted(x["source"]), []
        if length:
            by = {}
            for source, total, vocab, starts, counts in zip(x["source"], x["total"], x["vocab"], x["starts"], x["counts"]):
                starts, counts = ((np.zeros(1, np.int64),) * 2 if starts is None
                                  else (np.asarray(starts, np.int64), np.asarray(counts, np.int64)))
                by[source] = (starts, shares(counts, int(total), int(vocab)))
        for i, a in enumerate(names):
            for b in names[:i]:
                out.append((lang, a, b, intersect(by[a], by[b], length) if length else 0))
        return pd.DataFrame(out, columns=["lang", "a", "b", "value"])

    sums = (full.groupBy("lang", "block").applyInPandas(run, "lang string, a string, b string, value bigint")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    return sums.select("lang", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                F.struct(F.col("b").alias("source"), F.col("a").alias("item")))), "value")


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """``docs(text, lang, source)`` -> (lang, source, part, item, value, rank).

    Part ``pair``: every other source of the language by its divergence from
    the group, all ranks. Part ``term``: the ``top`` terms that the group uses
    more than its language. Null text, lang and source count as ''; each row is a
    document, repeated ids or not; other columns are not read. A group without
    terms still has its pairs; a language with one source has no pair, one
    without kept terms has the value 0 in all of them. Equal values are ordered
    by item (UTF-8). An empty table gives no rows. Texts of any length count whole.
    A term's row holds one cell per source of its language at most, and pairs are
    quadratic in the sources of a language, as the result is.
    """
    terms = materialize(kept_terms(docs, min_docs), "terms")
    groups = materialize(group_totals(terms), "groups")
    cols = materialize(columns(terms), "columns")
    return ranked(pair_sums(cols, groups), "pair").unionByName(over_used(terms, groups, top))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
tok AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
per AS (SELECT lang, source, id, term, count(*) AS n FROM tok GROUP BY ALL),
vocab AS (SELECT lang, term, sum(n) AS n FROM per GROUP BY lang, term HAVING count(*) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM vocab GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, sum(n) AS n FROM per GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, t.term, t.n AS n_lang, coalesce(c.n, 0) AS n
  FROM groups g JOIN vocab t ON t.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
shares AS (
  SELECT c.lang, c.source, c.term, c.n,
         1 + (1000000000::HUGEINT * (c.n + 2)::HUGEINT) // (t.total + 2 * l.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (c.n_lang + 2)::HUGEINT) // (l.total + 2 * l.v)::HUGEINT AS q
  FROM cells c JOIN totals t ON t.lang = c.lang AND t.source = c.source JOIN langs l ON l.lang = c.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce(sum(CASE WHEN x.p IS NOT NULL THEN ((x.p - y.p) * (x.p - y.p)) // (x.p + y.p) END), 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
               UNION ALL SELECT lang, source, 'term', item, value FROM terms),
numbered AS (SELECT lang, source, part, item, value::BIGINT AS value,
                    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM both_parts)
SELECT lang, source, part, item, value, rank FROM numbered WHERE part = 'pair' OR rank <= 10
"""
