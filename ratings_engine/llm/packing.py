"""Packing token sequences by minimum bin slack.

A document is its token ids and one closing id. Full windows of it fill
sequences of their own; the tails are packed. Tails are dealt at random into
buckets of about ``BUCKET`` rows (bounded, whatever the corpus), and a bucket's
tails are a multiset of lengths: each window takes the longest remaining tail
and the multiset of remaining lengths that comes closest to filling the rest.
That multiset comes from a subset-sum table kept as bitsets, one shift per
length, and is read back by walking the bitsets. A window's pattern is reused
as often as its lengths last, so a bucket needs few tables.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import materialize
from .text import list_array, map_batches

SIZE, CLOSING, BUCKET = 1024, 0, 25_000
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of the ``tokenizers`` file. The same vocabulary is read as ranks by
    tiktoken, which gives equal ids about four times as fast; texts with the file's
    special token go to ``tokenizers`` itself."""

    def __init__(self, path: str | None = None, ranks: str | None = None):
        import base64

        import public_tokenizers as files
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path or files.path("byte_bpe_50k.json"))
        with open(ranks or files.path("byte_bpe_50k.tiktoken"), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=files.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if SPECIAL in text:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def pieces(docs: DataFrame, size: int = SIZE, path: str | None = None, ranks: str | None = None, ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, piece, deal[, ids]): windows of each document and its tail.
    ``piece`` numbers the rows of the table, ``deal`` spreads them evenly."""

    def run(batches):
        encoder = Encoder(path, ranks)
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng(task)
        made = 0
        for batch in batches:
            doc_ids, rows = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = np.append(encoder.ids(text), np.uint32(CLOSING)).astype("<u4")
                for start in range(0, len(tokens), size):
                    part = tokens[start:start + size]
                    doc_ids.append(doc)
                    rows.append((start, len(part), zlib.crc32(part.tobytes()), len(tokens), (task << 32) + made, part))
                    made += 1
            cols = list(zip(*rows)) or [[]] * 6
            out = {"doc_id": doc_ids} | dict(zip(("start", "length", "ids_crc32", "doc_tokens", "piece"), cols[:5]))
            out["deal"] = rng.integers(0, 1 << 62, len(rows))
            if ids:
                flat = np.concatenate(cols[5] or [np.empty(0, "<u4")]).astype(np.int32)
                out["ids"] = list_array([0, *np.cumsum(out["length"], dtype=np.int64)], flat)
            yield out

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), run,
                       "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, piece bigint, deal bigint"
                       + (", ids array<int>" if ids else ""))


def closest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The multiset [(length, n)] of ``counts`` whose sum is the largest that fits into ``room``."""
    reach, walked, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x, c in counts.items() if c and x <= room), reverse=True):
        walked.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:
            n = min(step, left)
            reach |= (reach << (length * n)) & mask
            left, step = left - n, step * 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, before in reversed(walked):
        n = 0
        while not before >> total & 1:
            total, n = total - length, n + 1
        if n:
            out.append((length, n))
    return out


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns [(length, n)] and how often each is used, until every length is used up."""
    left = {k: c for k, c in counts.items() if c}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = dict([(longest, 1)])
        for length, n in closest(left, size - longest):
            pattern[length] = pattern.get(length, 0) + n
        left[longest] += 1
        times = min(left[k] // n for k, n in pattern.items())
        for k, n in pattern.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((sorted(pattern.items(), reverse=True), times))
    return out


def place(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) per length of one bucket."""
    order = np.argsort(lengths, kind="stable")
    values, first, n = np.unique(lengths[order], return_index=True, return_counts=True)
    at = dict(zip(values.tolist(), first.tolist()))
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    base = 0
    for pattern, times in plan(dict(zip(values.tolist(), n.tolist())), size):
        fill = 0
        for length, k in pattern:
            rows = order[at[length]:at[length] + k * times]
            at[length] += k * times
            sequence[rows] = base + np.repeat(np.arange(times), k)
            offset[rows] = fill + np.tile(np.arange(k) * length, times)
            fill += length * k
        base += times
    return sequence, offset


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None, ranks: str | None = None, ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> per piece (doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset[, ids]).

    A null or empty text is its closing id alone. A null doc_id stays null;
    repeated rows are packed each. An empty table gives no pieces. Sequences
    hold at most ``size`` ids; what is missing to ``size`` is padding.
    """
    table = materialize(pieces(docs, size, path, ranks, ids), "pieces")
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    extra = ["ids"] if ids else []
    whole = table.where(f"length = {size}").select(*keep, F.expr("piece * 2 + 1").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), *extra)
    tails = table.where(f"length < {size}")
    buckets = max(1, -(-tails.count() // BUCKET))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = place(group["length"].to_numpy(), size)
        return pd.DataFrame({"piece": group["piece"], "sequence_id": ((group["bucket"].to_numpy() << 32) + sequence) * 2, "offset": offset})

    # Only a tail's length and number go through the buckets; its columns join again after.
    placed = (tails.select("piece", "length", F.expr(f"deal % {buckets}").alias("bucket")).groupBy("bucket")
              .applyInPandas(fill, "piece bigint, sequence_id bigint, offset bigint"))
    return whole.unionByName(tails.join(placed, "piece").select(*keep, "sequence_id", "offset", *extra))
