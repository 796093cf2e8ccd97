"""Fill-in-the-middle: a document's middle is moved to its end, so that a model learns to fill a gap.

Cuts fall between units (a word with the blanks before it; blanks at the end are
one unit). A document's bytes are seen as blocks of a fixed size; a Fenwick tree
over the blocks stores how many units end in each and how many code points begin
there. The block of a cut is found by binary lifting down the tree, the place
within the block by looking at that block alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import map_batches

BLOCK = 1024            # bytes
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class BlockTree:
    """Fenwick tree over the blocks of one text: row i holds (units, code points) of the ``i & -i`` blocks up to the i-th."""

    def __init__(self, ends: np.ndarray, leads: np.ndarray, block: int = BLOCK):
        self.ends, self.leads, self.block = ends, leads, block
        at = np.arange(0, len(ends), block)
        sums = np.zeros((len(at) + 1, 2), np.int64)
        if len(at):
            sums[1:, 0] = np.cumsum(np.add.reduceat(ends, at, dtype=np.int64))
            sums[1:, 1] = np.cumsum(np.add.reduceat(leads, at, dtype=np.int64))
        i = np.arange(len(at) + 1)
        self.tree = sums - sums[i - (i & -i)]
        self.units = int(sums[-1, 0])

    def descend(self, unit: int) -> tuple[int, int, int]:
        """(block, units before it, code points before it) of the block in which the ``unit``-th unit (from 1) ends."""
        at, units, points = 0, 0, 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            if at + step < len(self.tree) and units + self.tree[at + step, 0] < unit:
                at += step
                units += int(self.tree[at, 0])
                points += int(self.tree[at, 1])
            step >>= 1
        return at, units, points

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``units`` units."""
        if not units:
            return 0, 0
        block, before, points = self.descend(units)
        a = block * self.block
        end = a + int(np.flatnonzero(self.ends[a:a + self.block])[units - before - 1]) + 1
        return end, points + int(np.count_nonzero(self.leads[a:end]))


def marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the joined bytes of several texts: where a unit ends (last byte), where a code point begins."""
    blank = _BLANK[data]
    ends = np.empty(len(data), bool)
    if len(data):
        ends[:-1] = ~blank[:-1] & blank[1:]
        last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        first = offsets[:-1][offsets[1:] > offsets[:-1]]
        ends[first[first > 0] - 1] = True
        ends[last] = True           # a word's end, or blanks at the end of the text
    return ends, (data & 0xC0) != 0x80


def draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of sha256("seed:doc_id") as numbers; a null id is written as nothing."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row (doc_id, n, form, prefix_chars, middle_chars, output).

    ``rate`` of 100 documents are cut, ``spm`` of 100 of these suffix first. The
    draws depend on seed and doc_id only, so a task that runs again cuts alike, and
    rows that repeat an id and a text give equal rows. A null text counts as
    empty; an empty text and one that holds a marker stay plain (prefix_chars and
    middle_chars null). Equal draws give an empty middle; prefix and suffix may be
    empty too. Texts of any length are cut whole; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    h = draws(F.col("doc_id"), seed)
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (h[2] % 100 >= rate)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.cast("binary").alias("text"), h[0].alias("a"), h[1].alias("b"),
                       F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm").alias("form"))
    mark = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
            data = texts.buffers()[2]
            data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
            offsets -= offsets[0]
            ends, leads = marks(data, offsets)
            out = {"n": [], "prefix_chars": [], "middle_chars": [], "output": []}
            draw = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            for s, e, (a, b, form) in zip(offsets, offsets[1:], draw):
                raw = data[s:e].tobytes()
                if form == "plain":
                    out["n"].append(int(np.count_nonzero(ends[s:e])))
                    row = None, None, raw
                else:
                    tree = BlockTree(ends[s:e], leads[s:e])
                    out["n"].append(tree.units)
                    x, y = sorted((a % (tree.units + 1), b % (tree.units + 1)))
                    (x, px), (y, py) = tree.cut(x), tree.cut(y)
                    p, m, t = raw[:x], raw[x:y], raw[y:]
                    row = px, py - px, b"".join((mark[1], t, mark[0], p, mark[2], m) if form == "spm" else (mark[0], p, mark[1], t, mark[2], m))
                for key, value in zip(("prefix_chars", "middle_chars", "output"), row):
                    out[key].append(value)
            out["output"] = pa.array(out["output"], pa.binary()).cast(pa.string())
            yield out | {"doc_id": batch.column(0), "form": batch.column(4)}

    return map_batches(rows, run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text again. It holds no marker itself, so the markers of the output cut it unambiguously."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(part, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second))
            .otherwise(F.concat(second, middle, first)))


def digests(cut: DataFrame) -> DataFrame:
    """``transform``'s rows with hashes of the output and of the text rebuilt from it in place of the output."""
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d),
c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS x, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT *, coalesce(array_to_string(units[1:x], ''), '') AS prefix, coalesce(array_to_string(units[x + 1:y], ''), '') AS middle,
         coalesce(array_to_string(units[y + 1:n], ''), '') AS suffix
  FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
