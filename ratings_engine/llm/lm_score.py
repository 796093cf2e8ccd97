"""Language-model scores from a log-frequency Bloom filter.

Training tokens are counted over the whole corpus. Word counts are kept
exactly. Every word pair enters a Bloom filter once for each level up to
floor(log2(count)) + 1; a reader probes level after level until one is missing, so the filter holds quantised counts without holding the pairs.
Counts and filter are gathered in blocks by hash: a block's pairs are counted
in one task and fill a slice of the filter that is sized by their number, so
the filter grows with the corpus and its error does not (about 0.4 % per
absent pair).

The score interpolates, with u the word before w and c~ the quantised count
(a lower bound, so the shares of a word's followers sum to 1 at most):

    p(w | u) = L * c~(u, w) / c(u) + (1 - L) * p(w)     p(w) = (c(w) + 1) / (N + V + 1)

and p(w | u) = p(w) where u was not seen. Counts and filter are broadcast while
they stay under ``BROADCAST`` bytes; beyond it each chunk of texts asks the blocks
for its distinct words and pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from .text import MIX, map_batches, mixed, row_slices, word_hashes

BROADCAST = 384 << 20
BLOCK_TOKENS = 2_000_000        # training tokens per block, on average
FLUSH = 3_000_000               # tokens that a task counts before it passes them on
BATCH_HASHES = 1 << 19          # hashes passed on in one Arrow batch, about
CHUNK = 1_000_000               # characters counted or scored together
ASKED = 18_000_000              # characters whose words and pairs are asked for together
BITS, HASHES = 11.6, 8          # bits per entry and probes: 0.4 % false positives
WEIGHT = 0.4
REMEMBERED = 1 << 18            # hashes whose counts a scoring task keeps, a power of two
END, BEGIN = b"", b"\n"         # no word equals either


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _pair(h: np.ndarray) -> np.ndarray:
    """Hash of each word with the one before it; ``h`` starts with BEGIN."""
    return mixed(h[:-1] * MIX + h[1:])


def _sequences(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h, starts, token) of a column of texts: the hashes of BEGIN, words and END
    of each text, where each text starts, and which of ``h[1:]`` are tokens."""
    words, counts = word_hashes(texts, lower=True)
    starts = np.append(0, np.cumsum(counts + 2))
    h = np.empty(starts[-1], np.uint64)
    inner = np.ones(len(h), bool)
    for at, mark in ((starts[:-1], BEGIN), (starts[1:] - 1, END)):
        h[at], inner[at] = xxhash.xxh64_intdigest(mark), False
    h[inner] = words
    token = np.ones(max(0, len(h) - 1), bool)
    token[starts[1:-1] - 1] = False        # from one text's END to the next one's BEGIN
    return h, starts[:-1], token


def _packed(h: np.ndarray) -> bytes:
    """Ascending hashes as the bytes of their steps, by place: the high ones are zeros, which shuffles compress."""
    return np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(b: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _cuts(blocks: int) -> np.ndarray:
    """First hash of each block but the first."""
    return np.array([(i << 64) // blocks for i in range(1, blocks)], np.uint64)


def _gathered(docs: DataFrame, blocks: int, pairs: bool) -> DataFrame:
    """(block, h, c): sorted hashes and counts of one task's tokens, cut by block (the hash's range)."""

    def flush(parts):
        h, c = np.unique(np.concatenate(parts), return_counts=True)
        ends = [0, *np.searchsorted(h, _cuts(blocks)).tolist(), len(h)]
        at = [i for i in range(blocks) if ends[i] < ends[i + 1]]
        step = min(64, max(1, BATCH_HASHES * blocks // max(1, len(h))))
        for some in (at[i:i + step] for i in range(0, len(at), step)):
            yield {"block": some, "h": [_packed(h[ends[i]:ends[i + 1]]) for i in some],
                   "c": [c[ends[i]:ends[i + 1]].astype(np.int64).tobytes() for i in some]}

    def run(batches):
        parts, size = [], 0
        for texts in (part for batch in batches for part in row_slices(batch.column(0), CHUNK)):
            h, _, token = _sequences(texts)
            parts.append((_pair(h) if pairs else h[1:])[token])
            size += len(parts[-1])
            if size > FLUSH:
                yield from flush(parts)
                parts, size = [], 0
        if parts:
            yield from flush(parts)

    return map_batches(docs.select("text"), run, "block int, h binary, c binary").repartition(blocks, "block").sortWithinPartitions("block")


def _merged(batches):
    """(block, hashes, counts) of each block of a task's sorted rows."""
    now, hs, cs = None, [], []

    def done():
        h = np.concatenate(hs)
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        return now, h[first], np.add.reduceat(np.concatenate(cs)[order], first)

    for batch in batches:
        for block, h, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if block != now:
                if hs:
                    yield done()
                now, hs, cs = block, [], []
            hs.append(_unpacked(h))
            cs.append(np.frombuffer(c, np.int64))
    if hs:
        yield done()


def word_counts(train: DataFrame, blocks: int) -> DataFrame:
    """(block, h, c, n, v): words of a block as arrays, their tokens and number."""

    def run(batches):
        for block, h, c in _merged(batches):
            yield {"block": [block], "h": [h.tobytes()], "c": [c.tobytes()], "n": [int(c.sum())], "v": [len(h)]}

    return map_batches(_gathered(train, blocks, False), run, "block int, h binary, c binary, n bigint, v bigint")


def _levels(c: np.ndarray) -> np.ndarray:
    """floor(log2(count)) + 1: the levels that a pair enters."""
    return np.frexp(c.astype(np.float64))[1].astype(np.int64)


def _probes(h: np.ndarray, level) -> tuple[np.ndarray, np.ndarray]:
    """(first, step) of (hash, level): probe ``i`` is the bit (first + i * step) % size of a slice."""
    a = mixed(h + np.uint64(0x632BE59BD9B4E019 * level % (1 << 64)))
    return a, mixed(a) | np.uint64(1)


def slice_of(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A block's slice of the filter: its pairs, once per level."""
    levels = _levels(c)
    size = np.uint64(max(64, int(levels.sum() * BITS) // 8 * 8 + 8))
    bits = np.zeros(int(size), bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        probe, step = _probes(h[levels >= level], level)
        for _ in range(HASHES):
            bits[(probe % size).view(np.int64)] = True
            probe += step
    return np.packbits(bits, bitorder="little")


def pair_filter(train: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): the filter's slices."""

    def run(batches):
        for block, h, c in _merged(batches):
            yield {"block": [block], "bits": [slice_of(h, c).tobytes()]}

    return map_batches(_gathered(train, blocks, True), run, "block int, bits binary")


class Model:
    """Word counts and filter in memory; ``score`` takes one document's words."""

    def __init__(self, words: list, slices: list, blocks: int, n: int, v: int):
        words = sorted(words, key=lambda r: r[0])
        self.h = np.concatenate([np.frombuffer(r[1], np.uint64) for r in words] or [np.empty(0, np.uint64)])
        self.c = np.concatenate([np.frombuffer(r[2], np.int64) for r in words] or [np.empty(0, np.int64)]).astype(np.uint32 if n < 1 << 32 else np.int64)
        by = {b: np.frombuffer(x, np.uint8) for b, x in slices}
        parts = [by.get(i, np.zeros(8, np.uint8)) for i in range(blocks)]
        self.bits = np.concatenate(parts)
        self.size = np.array([len(p) * 8 for p in parts], np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.uint64)
        self.cuts = _cuts(blocks)
        self.n, self.v = n, v

    def counts(self, h: np.ndarray) -> np.ndarray:
        if not len(self.h):
            return np.zeros(len(h))
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, self.c[at], 0).astype(np.float64)

    def quantised(self, h: np.ndarray) -> np.ndarray:
        """2 ** (level - 1) of each pair by repeated probes, 0 for pairs that the filter lacks."""
        block = np.searchsorted(self.cuts, h, "right")
        size, start = self.size[block], self.start[block]
        out, alive, level = np.zeros(len(h)), np.arange(len(h)), 1
        while len(alive):
            probe, step = _probes(h[alive], level)
            of, at = size[alive], start[alive]
            for _ in range(HASHES):
                b = probe % of + at
                there = np.flatnonzero(self.bits[(b >> np.uint64(3)).view(np.int64)] >> (b & np.uint64(7)).astype(np.uint8) & 1)
                if len(there) < len(alive):
                    alive, probe, step, of, at = (x[there] for x in (alive, probe, step, of, at))
                if not len(alive):
                    break
                probe = probe + step
            out[alive] = 2.0 ** (level - 1)
            level += 1
        return out

    def log_terms(self, now: np.ndarray, before: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(base, model) log10 probability of each token from its count, its predecessor's and the pair's quantised one."""
        p = (now + 1) / (self.n + self.v + 1)
        share = WEIGHT * np.minimum(1, pairs / np.maximum(before, 1)) + (1 - WEIGHT) * p
        return np.log10(p), np.log10(np.where(before > 0, share, p))


class _Remembered:
    """Values of hashes by ``of``, kept in one slot per hash; a later hash of ``least`` or more takes the slot."""

    def __init__(self, of, least: float = 0.0):
        self.of, self.least = of, least
        self.key, self.value = np.zeros(REMEMBERED, np.uint64), np.zeros(REMEMBERED)
        self.key[0] = 1                    # no slot starts with a hash of its own

    def __call__(self, h: np.ndarray) -> np.ndarray:
        slot = (h & np.uint64(REMEMBERED - 1)).view(np.int64)
        out = self.value[slot]
        new = np.flatnonzero(self.key[slot] != h)
        new = new[np.argsort(h[new])]      # in the order of the counts and slices that are read
        value = out[new] = self.of(h[new])
        keep = new[value >= self.least]
        self.key[slot[keep]], self.value[slot[keep]] = h[keep], out[keep]
        return out


def _scored(model: Model, count, quantised, sequences, begin: int):
    """(n_tokens, n_known, base, score) of the texts of ``_sequences``; their tokens are looked up together."""
    h, starts, token = sequences
    c = count(h)
    c[starts] = begin
    first = starts - np.arange(len(starts))
    now = c[1:][token]
    base, model_terms = model.log_terms(now, c[:-1][token], quantised(_pair(h)[token]))
    return (np.diff([*first, len(base)]), *(np.add.reduceat(x, first) for x in ((now > 0).astype(np.int64), base, model_terms)))


def score(docs: DataFrame, broadcast_bytes: int = BROADCAST) -> DataFrame:
    """``docs(doc_id, text)`` -> per row (doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score); trained on the rows that are not held out.

    Words are lower-cased (A-Z); every text ends with one end token, which a
    null or empty text consists of. A null doc_id is not held out. Repeated
    rows count and are scored each. An empty table gives no rows; without
    training rows every count is 0.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    train = docs.where(~held_out())
    # Words per text are estimated only to choose the number of blocks.
    length = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(max(4, length // 6 // BLOCK_TOKENS + 1))
    words = materialize(word_counts(train, blocks), "words")
    n, v = (x or 0 for x in words.agg(F.sum("n"), F.sum("v")).first())
    slices = materialize(pair_filter(train, blocks), "filter")
    size = (slices.agg(F.sum(F.octet_length("bits"))).first()[0] or 0) + 12 * v
    if size > broadcast_bytes:
        return score_by_joins(docs, words, slices, blocks, n, v)
    begin = train.count()
    # partition by partition: the driver's JVM holds one at a time, its Python the arrays and their parts
    model = Model([tuple(r) for r in words.select("block", "h", "c").toLocalIterator()],
                  [tuple(r) for r in slices.select("block", "bits").toLocalIterator()], blocks, n, v)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    del model

    def run(batches):
        m = shared.value
        count, quantised = _Remembered(m.counts), _Remembered(m.quantised, 2.0)
        for batch in batches:
            cols = [_scored(m, count, quantised, _sequences(texts), begin) for texts in row_slices(batch.column(1), CHUNK)]
            if cols:
                yield {"doc_id": batch.column(0), "train_tokens": np.full(batch.num_rows, n)} | dict(
                    zip(("n_tokens", "n_known", "base_score", "score"), map(np.concatenate, zip(*cols))))

    return map_batches(docs, run, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _asked(sequences: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and pairs of some texts, ascending."""
    return np.unique(np.concatenate([h for h, _, _ in sequences])), np.unique(np.concatenate([_pair(h)[token] for h, _, token in sequences]))


def score_by_joins(docs: DataFrame, words: DataFrame, slices: DataFrame, blocks: int, n: int, v: int) -> DataFrame:
    """The same scores where counts and filter are too large to broadcast.

    Texts are written in chunks of about ``ASKED`` characters. A chunk asks every block for its distinct words and
    pairs, so what is shuffled are 8 bytes for each of them (less, as they ascend), not a row per token. Counts and levels
    come back in the order asked, without the hashes, and meet their texts again by chunk. A task holds one block
    or one chunk; a single longer text is a chunk of its own.
    """
    begin = docs.where(~held_out()).count()

    def dealt(batches):
        done, chunk = 0, None
        for batch in batches:
            length = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_numpy().astype(np.int64)
            row = batch.column(0).to_numpy()
            if chunk is None and len(row):
                chunk = int(row[0])            # ids of a task's rows ascend by one
            ends = done + np.cumsum(length)
            done = int(ends[-1]) if len(ends) else done
            yield {"chunk": chunk + (ends // ASKED if len(ends) else ends), "row": row, "doc_id": batch.column(1), "text": batch.column(2)}

    rows = materialize(map_batches(docs.select(F.monotonically_increasing_id(), "doc_id", "text"), dealt, "chunk bigint, row bigint, doc_id bigint, text string"), "rows")

    def ask(batches):
        """A chunk may come in parts (of several tasks), each known by its first row."""
        now, first, found = None, None, []

        def asks():
            cut = [(x, [0, *np.searchsorted(x, _cuts(blocks)).tolist(), len(x)]) for x in _asked(found)]
            at = [i for i in range(blocks) if any(e[i] < e[i + 1] for _, e in cut)]
            step = min(64, max(1, BATCH_HASHES * blocks // sum(len(x) for x, _ in cut)))
            for some in (at[i:i + step] for i in range(0, len(at), step)):
                yield {"block": some, "o": np.ones(len(some)), "chunk": [now] * len(some), "first": [first] * len(some), "bits": [None] * len(some)} | {
                    k: [_packed(x[e[i]:e[i + 1]]) for i in some] for k, (x, e) in zip("hc", cut)}

        for batch in batches:
            chunk, row = (batch.column(i).to_numpy() for i in range(2))
            ends = [*(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for a, b in zip([0, *ends], ends):
                if a == b:
                    continue
                if chunk[a] != now:
                    if found:
                        yield from asks()
                    now, first, found = int(chunk[a]), int(row[a]), []
                found += map(_sequences, row_slices(batch.column(2).slice(a, b - a), CHUNK))
        if found:
            yield from asks()

    def answer(batches):
        m = now = None
        known = {}
        for batch in batches:
            for block, chunk, first, h, c, bits in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if block != now:
                    m, now, known = None, block, {}
                if chunk is None:              # the block's counts or its slice, sorted before all that ask
                    known |= {"bits": bits} if bits is not None else {"words": (0, h, c)}
                    continue
                m = m or Model([known["words"]] if "words" in known else [], [(0, known["bits"])] if "bits" in known else [], 1, n, v)
                levels = np.frexp(m.quantised(_unpacked(c)))[1]
                yield {"chunk": [chunk], "first": [first], "block": [block], "counts": [m.counts(_unpacked(h)).astype(np.int64).tobytes()],
                       "levels": [levels.astype(np.uint8).tobytes()]}

    none = lambda t, k: F.lit(None).cast(t).alias(k)
    asked = map_batches(rows.select("chunk", "row", "text"), ask, "block int, o int, chunk bigint, first bigint, h binary, c binary, bits binary")
    of = lambda x, *cols: x.select("block", F.lit(0).alias("o"), none("bigint", "chunk"), none("bigint", "first"), *cols)
    both = asked.unionByName(of(words, "h", "c", none("binary", "bits"))).unionByName(of(slices, none("binary", "h"), none("binary", "c"), "bits"))
    answers = materialize(map_batches(both.repartition(blocks, "block").sortWithinPartitions("block", "o").select("block", "chunk", "first", "h", "c", "bits"),
                                      answer, "chunk bigint, first bigint, block int, counts binary, levels binary"), "answers")
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def meet(texts: pa.Table, found: pa.Table) -> pa.Table:
        texts, found = texts.sort_by("row").combine_chunks(), found.sort_by([("first", "ascending"), ("block", "ascending")])
        row, first = texts["row"].to_numpy(), found["first"].to_numpy()
        out, m = [], Model([], [], 1, n, v)
        starts = np.unique(first)
        for f, a, b in zip(starts.tolist(), np.searchsorted(row, starts).tolist(), [*np.searchsorted(row, starts[1:]).tolist(), len(row)]):
            part = texts.slice(a, b - a)
            sequences = [_sequences(x) for x in row_slices(part["text"].combine_chunks(), CHUNK)]
            values = [np.frombuffer(b"".join(found[k].filter(pa.array(first == f)).to_pylist()), t) for k, t in (("counts", np.int64), ("levels", np.uint8))]
            h, pairs = _asked(sequences)
            c, q = values[0].astype(np.float64), np.where(values[1] > 0, np.ldexp(0.5, values[1].astype(np.int64)), 0.0)
            cols = [_scored(m, lambda x, h=h, c=c: c[np.searchsorted(h, x)], lambda x, p=pairs, q=q: q[np.searchsorted(p, x)], s, begin) for s in sequences]
            out.append(pa.table([part["doc_id"], *(pa.array(np.concatenate(x), t) for x, t in zip(zip(*cols), schema.types[1:]))], schema=schema))
        return pa.concat_tables(out)

    scored = rows.select("chunk", "row", "doc_id", "text").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        meet, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
