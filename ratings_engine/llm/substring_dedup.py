"""Substring dedup by suffix automata of reference shards.

A window is ``window`` consecutive words. A window goes if its words also start
in a document with a smaller doc_id. Which earlier document to look in is found
first; the matching is done by automata.

1. Anchors. A window's anchor is the smallest hash among its runs of ``run``
   words, so equal windows have equal anchors wherever they stand. An anchor of
   two or more documents is shared; its owner is the smallest of them.
2. Shards. The reference shard of an owner is its windows with the anchors that
   it owns. Every other document sends its windows with these anchors, in runs
   as long as the owner stays the same, to the owner's shard. Owners with many
   followers have copies of their shard (salted by the number of documents per
   anchor), so a passage that a third of all documents share is spread.
3. Matching. A task builds the suffix automaton of a shard, streams the
   documents' runs through it, and takes the matching statistics: where the
   longest match ending at a word is ``window`` words or more, the window
   ending there is in the owner. Adjacent windows give maximal spans.
4. Rest. A window that shares its anchor but not all its words with the owner
   may still equal one in a third document. These windows (edges of passages,
   edited copies) are compared with each other by a 128-bit hash.

A broadcast of the automata, as one would do for a small reference, would grow
with the corpus; shards therefore travel to their readers by a shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import discard, materialize
from .text import gram_hashes, map_batches, row_slices, signed, word_hashes, words_of

WINDOW, RUN = 13, 5
FOLLOWERS = 512          # documents per copy of a shard, about
SPANS_BROADCAST = 64 << 20
CHUNK = 2_000_000        # characters hashed together


def anchors_of(h: np.ndarray, window: int, run: int) -> np.ndarray:
    """The anchor of each window of a document, by doubling the width of a running minimum."""
    g = gram_hashes(h, run)
    width, need = 1, window - run + 1
    while width < need:
        step = min(width, need - width)
        g = np.minimum(g[:-step], g[step:])
        width += step
    return g


def row_anchors(texts, window: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, bounds): the anchors of all windows of a column of texts; row ``i`` has those from bounds[i] to bounds[i + 1]."""
    found, sizes = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
    for part in row_slices(texts, CHUNK):
        h, counts = word_hashes(part)
        sizes.append(np.maximum(counts - window + 1, 0))
        if sizes[-1].any():
            a = anchors_of(h, window, run)         # over all words: a window that runs into the next row goes
            left = np.repeat(np.cumsum(counts), counts)[:len(a)] - np.arange(len(a))
            found.append(a[left >= window])
    return np.concatenate(found), np.cumsum(np.concatenate(sizes))


class Automaton:
    """Suffix automaton over words; ``extend`` texts, then ``ends`` gives the matches of a text."""

    def __init__(self):
        self.next, self.link, self.length, self.texts = [{}], [-1], [0], 0

    def extend(self, words: list[bytes]) -> None:
        nexts, links, lengths = self.next, self.link, self.length
        self.texts += 1
        last = 0                                   # generalised: every text starts at the root
        for c in words:
            if c in nexts[last]:                   # the text so far is already known
                q = nexts[last][c]
                if lengths[q] == lengths[last] + 1:
                    last = q
                    continue
                last = self._split(last, q, c)
                continue
            state = len(nexts)
            nexts.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = state
                p = links[p]
            if p >= 0:
                q = nexts[p][c]
                links[state] = q if lengths[q] == lengths[p] + 1 else self._split(p, q, c)
            last = state

    def _split(self, p: int, q: int, c: bytes) -> int:
        """A copy of state q for the shorter contexts that end in p and c."""
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def ends(self, words: list[bytes], least: int) -> list[int]:
        """Positions where the longest match ending there has ``least`` words or more."""
        nexts, links, lengths = self.next, self.link, self.length
        out, state, size = [], 0, 0
        for i, c in enumerate(words):
            to = nexts[state].get(c)
            while to is None and state:
                state = links[state]
                size = lengths[state]
                to = nexts[state].get(c)
            if to is None:
                size = 0
            else:
                state, size = to, size + 1
            if size >= least:
                out.append(i)
        return out


def _runs(at: np.ndarray, step: int = 1) -> list[tuple[int, int]]:
    """Runs [a, b) of sorted positions that follow each other by ``step`` at most."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > step) + 1
    return [(int(x[0]), int(x[-1]) + 1) for x in np.split(at, cut)]


def _pairs(bounds: np.ndarray) -> zip:
    """(start, end) of each row."""
    return zip(bounds[:-1].tolist(), bounds[1:].tolist())


def _join(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "surrogatepass")


def anchors(docs: DataFrame, window: int, run: int) -> DataFrame:
    """(h, doc_id, tk): the distinct anchors of each row; ``tk`` tells rows of one doc_id apart."""

    def emit(batches):
        for batch in batches:
            a, bounds = row_anchors(batch.column(1), window, run)
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            new = np.append(True, (a[1:] != a[:-1]) | (row[1:] != row[:-1]))[:len(a)]
            a, row = a[new], row[new]
            for s, e in _pairs(np.searchsorted(row, np.arange(batch.num_rows + 1))):
                a[s:e].sort()
            new = np.append(True, (a[1:] != a[:-1]) | (row[1:] != row[:-1]))[:len(a)]
            row = row[new]
            yield {"h": signed(a[new]), "doc_id": batch.column(0).to_numpy()[row], "tk": batch.column(2).to_numpy()[row]}

    return map_batches(docs.select("doc_id", "text", "tk"), emit, "h bigint, doc_id bigint, tk bigint")


def routed(docs: DataFrame, hits: DataFrame, window: int, run: int) -> DataFrame:
    """(owner, copies, copy, role, doc_id, tk, start, text): role 0 the parts of a
    reference shard, role 1 the runs of windows to be matched against it."""

    def emit(batches):
        for batch in batches:
            rows = []
            hits = batch.column(2)
            ends, flat = hits.offsets.to_numpy(), hits.values
            all_known, all_owner, all_copies = (flat.field(c).to_numpy() for c in ("h", "owner", "copies"))
            anchored, bounds = row_anchors(batch.column(1), window, run)
            anchored = signed(anchored)
            for n, (doc, text, tk, (first, last)) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)), _pairs(bounds))):
                some = slice(ends[n], ends[n + 1])
                order = np.argsort(all_known[some])
                known = all_known[some][order]
                h = anchored[first:last]
                i = np.minimum(np.searchsorted(known, h), len(known) - 1)
                starts = np.flatnonzero(known[i] == h)
                if not len(starts):
                    continue
                i = order[i[starts]]
                owner, copies = all_owner[some][i], all_copies[some][i]
                # runs of windows of one owner and one number of copies
                new = (np.diff(starts) > 1) | (np.diff(owner) != 0) | (np.diff(copies) != 0)
                at = np.append(0, np.flatnonzero(new) + 1)
                words = words_of(text)
                for a, b, o, c in zip(starts[at].tolist(), starts[np.append(at[1:], len(starts)) - 1].tolist(), owner[at].tolist(), copies[at].tolist()):
                    run_of = _join(words[a:b + window])
                    if o == doc:
                        rows += [(o, c, k, 0, doc, tk, a, run_of) for k in range(c)]
                    else:
                        copy = xxhash.xxh32_intdigest(str(doc).encode()) % c if c > 1 else 0
                        rows.append((o, c, copy, 1, doc, tk, a, run_of))
                if len(rows) > 2000:
                    yield dict(zip(ROUTE, zip(*rows)))
                    rows = []
            if rows:
                yield dict(zip(ROUTE, zip(*rows)))

    both = docs.join(hits, ["doc_id", "tk"]).select("doc_id", "text", "hits", "tk")
    return map_batches(both, emit, "owner bigint, copies bigint, copy bigint, role int, doc_id bigint, tk bigint, start bigint, text string")


ROUTE = ("owner", "copies", "copy", "role", "doc_id", "tk", "start", "text")


def matched(routes: DataFrame, window: int) -> DataFrame:
    """(doc_id, tk, s, e, h1, h2): spans found in a shard (h1 null), and windows that were not (with their hash)."""

    def emit(batches):
        key, shard = None, None
        for batch in batches:
            spans, left, digests = [], [], bytearray()
            for owner, copies, copy, role, doc, tk, start, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (owner, copies, copy):
                    key, shard = (owner, copies, copy), Automaton()
                words = words_of(text)
                if role == 0:
                    shard.extend(words)
                    continue
                found = np.array(shard.ends(words, window), np.int64) - window + 1
                spans += [(doc, tk, start + a, start + b + window - 1) for a, b in _runs(found)]
                windows = len(words) - window + 1
                if len(found) == windows:
                    continue
                some = np.ones(windows, bool)
                some[found] = False
                some = np.flatnonzero(some).tolist()
                for a in some:
                    digests += xxhash.xxh3_128_digest(b" ".join(words[a:a + window]))
                left += [(doc, tk, start + a, start + a + window) for a in some]
            if spans or left:
                h = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
                h = np.concatenate([np.zeros((len(spans), 2), np.int64), h])
                null = np.arange(len(h)) < len(spans)
                yield dict(zip(("doc_id", "tk", "s", "e"), np.array(spans + left, np.int64).T)) | {
                    c: pa.array(h[:, n], mask=null) for n, c in enumerate(("h1", "h2"))}

    dealt = routes.repartition("owner", "copies", "copy").sortWithinPartitions("owner", "copies", "copy", "role", "doc_id", "tk", "start")
    return map_batches(dealt, emit, "doc_id bigint, tk bigint, s bigint, e bigint, h1 bigint, h2 bigint")


def merged(batches):
    """Overlapping and touching spans of a row as one, in order."""
    for batch in batches:
        starts, ends = [], []
        for s, e in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            s, e = np.sort(s), np.sort(e)                # sorted apart, a span ends where the next start lies beyond
            cut = s[1:] > e[:-1]
            starts.append(s[np.append(True, cut)].tolist())
            ends.append(e[np.append(cut, True)].tolist())
        yield {"doc_id": batch.column(0), "tk": batch.column(1), "s": starts, "e": ends}


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(doc_id, tk, s, e): starts and ends of the word spans to remove from the rows of ``docs(doc_id, text, tk)``."""
    docs = docs.where("doc_id is not null and text is not null")
    found = anchors(docs, window, run)
    copies = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") / FOLLOWERS)))).cast("bigint")
    shared = materialize(found.groupBy("h").agg(F.min("doc_id").alias("owner"), F.count("*").alias("n")).where("n > 1")
                         .select("h", "owner", copies.alias("copies")), "anchors")
    hits = (found.join(shared, "h")
            .groupBy("doc_id", "tk").agg(F.collect_list(F.struct("h", "owner", "copies")).alias("hits")))
    parts = materialize(matched(routed(docs, hits, window, run), window), "spans")
    discard(shared)
    rest = parts.where("h1 is not null")
    first = rest.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h1", "h2", "lo")
    spans = parts.where("h1 is null").select("doc_id", "tk", "s", "e").unionByName(
        rest.join(first, ["h1", "h2"]).where("doc_id > lo").select("doc_id", "tk", "s", "e"))
    out = materialize(map_batches(spans.groupBy("doc_id", "tk").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e")), merged,
                                  "doc_id bigint, tk bigint, s array<int>, e array<int>"), "spans")
    discard(parts)
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, text: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> per row (doc_id, n_words, n_removed, kept_sha256[, kept_text]).

    Windows are judged on the input, not on what is left; a word goes if any of
    its windows goes. Null and empty texts have no words. A row without doc_id
    has no order, loses nothing and takes nothing from others. Rows that repeat
    a doc_id, whatever their texts, keep their words against each other; each is judged by
    its own windows, and others are judged against all of them. The sha256 is of the kept words joined by one space.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    alone = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    docs = docs.withColumn("tk", F.lit(0).cast("bigint") if alone else F.xxhash64("text"))
    spans = repeated_spans(docs, window, run)
    size = spans.agg(F.sum(F.size("s") * 8 + 64)).first()[0] or 0
    joined = docs.join(F.broadcast(spans) if size <= SPANS_BROADCAST else spans, ["doc_id", "tk"], "left").select("doc_id", "text", "s", "e")

    def emit(batches):
        for batch in batches:
            rows = []
            for body, s, e in zip(*(c.to_pylist() for c in batch.columns[1:])):
                words = words_of(body)
                kept, at = [], 0
                for start, end in zip(s or (), e or ()):
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                line = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(line).hexdigest(), line.decode("utf-8", "surrogatepass")))
            cols = list(zip(*rows)) or [[]] * 4
            yield {"doc_id": batch.column(0)} | dict(zip(("n_words", "n_removed", "kept_sha256", "kept_text"), cols))

    return map_batches(joined, emit, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if text else ""))
