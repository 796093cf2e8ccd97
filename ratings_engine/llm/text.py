"""Word splitting, word hashing and Arrow helpers shared by the operators.

Words are runs of ``[^\\x20\\x09-\\x0D]+``. ``bytes.split()`` splits UTF-8 on
exactly these six ASCII characters, so every operator works on the encoded text.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

MIX = np.uint64(0x9E3779B97F4A7C15)

#: Rows and bytes of one Arrow batch: a Python worker holds one batch at a time, so these
#: bound its memory whatever the length of the texts (a single longer text is a batch of its own).
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a whole text; a null text has none."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class Vocab(dict):
    """Word -> dense id with a 64-bit hash per id, kept per task.

    Ids hold for one call only: the table starts anew past ``limit`` words, so
    a task's memory stays bounded whatever the vocabulary of the corpus.
    """

    def __init__(self, limit: int = 1 << 17):
        super().__init__()
        self.limit, self.table = limit, array("Q")

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.table)
        self.table.append(xxhash.xxh64_intdigest(word))
        return i

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
            self.table = array("Q")
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids(words)
        return np.frombuffer(self.table, np.uint64)[ids] if len(ids) else np.empty(0, np.uint64)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, number of words of each row) of a column of texts.

    The same words and hashes as ``words_of`` and ``Vocab`` give, text after
    text; a word is hashed once per call, so a call takes many texts.
    """
    texts = pc.fill_null(texts, "")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = parts.flatten()
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    h = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))[coded.indices.to_numpy()]
    some = pc.binary_length(flat).to_numpy() > 0          # a text that starts or ends with a space has empty parts
    ends = np.append(0, np.cumsum(some))[parts.offsets.to_numpy()]
    return h[some], np.diff(ends)


def row_slices(texts: pa.Array, characters: int) -> Iterator[pa.Array]:
    """The column in parts cut before the row in which a further ``characters`` are full."""
    part = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy().astype(np.int64)) // characters
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return (texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if a < b)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads a 64-bit value over all bits (array in, array out)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (``len(h) - k + 1`` values)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * MIX + h[j:j + n]
    return mixed(out)


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer than ``k`` words is one shingle, an empty one none."""
    if not len(h):
        return h
    return np.unique(gram_hashes(h, min(k, len(h))))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns an iterator of batches into dicts of
    columns; ``schema`` is a DDL string whose types Arrow can take over."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    for key, value in BATCH.items():
        df.sparkSession.conf.set(key, value)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def list_array(offsets, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), pa.array(values))
