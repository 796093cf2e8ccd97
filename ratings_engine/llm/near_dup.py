"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A document's set is its distinct word shingles, hashed once to 64 bits; its
   sketch is the ``SKETCH`` smallest values.
2. Documents with equal sets form a class first (one aggregate), so a group of
   copies, however large, goes on as one representative.
3. Inverted lists: each representative files ``INDEX`` retained values, rare
   ones before frequent ones, both by hash. Of two sets of similarity 0.8 at
   most a fifth of either's values is not shared, so the filed values miss each
   other only if ``INDEX`` of ``SKETCH`` fall into that fifth: 2e-6.
4. A list of up to ``LIST`` members gives all its pairs. A longer one only
   arises among documents that mostly consist of frequent shingles (large
   groups of near copies). Its members are held against a few pivots; where
   they are then not all in one component, ``across`` finds the pairs that
   could still join two components, by an exact prefix and position filter.
5. The union sketch of a pair estimates its similarity; pairs more than
   ``SLACK`` (six standard errors) below the threshold go.
6. The rest is verified on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import discard, materialize
from ..operators.windows import numbered
from .components import connected_components
from .text import Vocab, list_array, map_batches, shingle_set, signed, words_of

SKETCH, INDEX, LIST = 48, 24, 32
SLACK = 0.36


def sketches(docs: DataFrame, shingle: int, lower: bool = True) -> DataFrame:
    """(doc_id, n, sig_a, sig_b, sketch): set size, two 64-bit checksums of the set, its smallest hashes."""

    def run(batches):
        vocab = Vocab()
        for batch in batches:
            n, sig_a, sig_b, values, ends = [], [], [], [], [0]
            for text in batch.column(1).to_pylist():
                s = shingle_set(vocab.hashes(words_of(text, lower)), shingle)
                n.append(len(s))
                sig_a.append(s.sum(dtype=np.uint64))
                sig_b.append(((s ^ (s >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64))
                values.append(s[:SKETCH])
                ends.append(ends[-1] + len(values[-1]))
            flat = np.concatenate(values) if values else np.empty(0, np.uint64)
            yield {"doc_id": batch.column(0), "n": n, "sig_a": signed(np.array(sig_a, np.uint64)),
                   "sig_b": signed(np.array(sig_b, np.uint64)), "sketch": list_array(ends, signed(flat))}

    return map_batches(docs.select("doc_id", "text"), run,
                       "doc_id bigint, n bigint, sig_a bigint, sig_b bigint, sketch array<bigint>")



def inverted_lists(reps: DataFrame) -> DataFrame:
    """(v, doc_id, n, df): the values a representative files; df members have v among their retained values."""
    long = reps.select("doc_id", "n", F.explode("sketch").alias("v"))
    counts = long.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    shared = long.join(counts, "v").groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("v", "df"))).alias("dfs"))
    ranked = reps.join(shared, "doc_id").select(
        "doc_id", "n",
        F.slice(F.array_sort(F.transform("sketch", lambda v: F.struct(
            (F.coalesce(F.col("dfs")[v], F.lit(1)) > LIST).alias("frequent"),
            v.bitwiseXOR(F.lit(-2 ** 63)).alias("o"), v.alias("v"),
            F.coalesce(F.col("dfs")[v], F.lit(1)).alias("df")))), 1, INDEX).alias("filed"))
    return ranked.select("doc_id", "n", F.inline("filed")).where("df > 1").select("v", "doc_id", "n")


def _similar_size(num: int, den: int):
    return F.expr(f"{den} * least(a_n, b_n) >= {num} * greatest(a_n, b_n)")


def estimated(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose union sketch does not rule the threshold out."""
    s = reps.select("doc_id", "sketch")
    both = (pairs.join(s.withColumnsRenamed({"doc_id": "a", "sketch": "sa"}), "a")
            .join(s.withColumnsRenamed({"doc_id": "b", "sketch": "sb"}), "b"))
    least = num / den - SLACK

    def run(batches):
        for batch in batches:
            a, b = (batch.column(i) for i in (2, 3))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (c[i].values.to_numpy().view(np.uint64) for c in (a, b))
                union = np.union1d(x, y)[:SKETCH]
                keep[i] = len(np.intersect1d(np.intersect1d(union, x, True), y, True)) >= least * len(union)
            at = np.flatnonzero(keep)
            yield {"a": batch.column(0).take(at_array(at)), "b": batch.column(1).take(at_array(at))}

    return map_batches(both.select("a", "b", "sa", "sb"), run, "a bigint, b bigint")


def at_array(at: np.ndarray):
    return pa.array(at, pa.int64())


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, num: int, den: int, lower: bool = True) -> DataFrame:
    """Links: pairs whose full sets meet ``den * |A and B| >= num * |A or B|``."""
    texts = docs.select("doc_id", "text")
    both = (pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a")
            .join(texts.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b"))

    def run(batches):
        vocab = Vocab()
        for batch in batches:
            at, last, x = [], None, None
            # the second join leaves equal b together: its set is kept from row to row
            for i, (b, ta, tb) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if x is None or b != last:
                    last, x = b, shingle_set(vocab.hashes(words_of(tb, lower)), shingle)
                y = shingle_set(vocab.hashes(words_of(ta, lower)), shingle)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common and den * common >= num * (len(x) + len(y) - common):
                    at.append(i)
            at = at_array(np.array(at, np.int64))
            yield {"a": batch.column(0).take(at), "b": batch.column(1).take(at)}

    return map_batches(both.select("a", "b", "ta", "tb"), run, "a bigint, b bigint")


def across(rest: DataFrame, docs: DataFrame, shingle: int, num: int, den: int, lower: bool) -> DataFrame:
    """Pairs (a, b) of ``rest(doc_id, n, c)`` from different components c that
    can be linked, none left out: with a set's shingles ordered from rare to
    frequent, linked sets share one of the first ``n - ceil(num/den n) + 1``,
    and from the first shared one on enough shingles must be left in both.
    Documents with many shingles of their own so leave the long lists, and
    those close to the centre of a group are in one component already."""
    texts = docs.join(rest.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")

    def run(batches):
        vocab = Vocab()
        for batch in batches:
            sets = [shingle_set(vocab.hashes(words_of(t, lower)), shingle) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)])
            yield {"doc_id": batch.column(0), "t": list_array(ends, signed(np.concatenate(sets)))}

    long = materialize(map_batches(texts, run, "doc_id bigint, t array<bigint>").select("doc_id", F.explode("t").alias("t")), "rest")
    counts = long.groupBy("t").agg(F.count("*").alias("df"))
    order = (long.join(counts, "t").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("o"))
             .join(rest, "doc_id"))
    prefix = order.select("doc_id", "n", "c", F.posexplode(F.slice("o", F.lit(1), F.expr(f"int(n - ceil({num} * n / {den}) + 1)"))))
    filed = materialize(prefix.where("col.df > 1").select(F.col("col.t").alias("t"), "doc_id", "n", "c", (F.col("n") - F.col("pos")).alias("left")), "filed")
    least = filed.groupBy("t").agg(F.min("n").alias("least"))
    filed = filed.join(least, "t").where(f"left * {num + den} >= {num} * (n + greatest({num} * n / {den}, least))")
    mixed_lists = filed.groupBy("t").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("t")
    filed = filed.join(mixed_lists, "t", "left_semi")
    x, y = (filed.select("t", *(F.col(k).alias(f"{p}_{k}") for k in ("doc_id", "n", "c", "left"))) for p in "ab")
    return (x.join(y, "t").where("a_doc_id < b_doc_id and a_c <> b_c").where(_similar_size(num, den))
            .where(f"least(a_left, b_left) * {num + den} >= {num} * (a_n + b_n)")
            .select(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, lower: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> per document (doc_id, n_shingles, component_id, kept, class_id).

    Documents are linked if ``den * |A and B| >= num * |A or B|`` over their
    sets of ``shingle``-word shingles; ``component_id`` is the smallest doc_id
    reachable and ``kept`` marks it. ``class_id`` is the smallest doc_id with
    the same set. A null or empty text has an empty set and is linked with nothing.
    A row without doc_id stays, with null ids, and is kept. Rows that repeat a
    doc_id count as one document with that id. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = docs.where("doc_id is not null")
    table = materialize(sketches(docs, shingle, lower), "sketches")
    full = table.where("n > 0 and doc_id is not null")
    classes = full.groupBy("n", "sig_a", "sig_b").agg(F.min("doc_id").alias("class_id"))
    reps = materialize(full.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi")
                       .groupBy("doc_id").agg(F.min_by(F.struct("n", "sketch"), F.struct("n", "sig_a", "sig_b")).alias("one"))
                       .select("doc_id", "one.n", "one.sketch"), "reps")
    lists = materialize(inverted_lists(reps), "lists")
    sizes = lists.groupBy("v").agg(F.count("*").alias("m"), F.min("doc_id").alias("p0"), F.max("doc_id").alias("p1"),
                                   F.min_by("doc_id", F.xxhash64("doc_id")).alias("p2")).where("m > 1")
    small = lists.join(sizes.where(f"m <= {LIST}").select("v"), "v")
    x, y = (small.select("v", F.col("doc_id").alias(c), F.col("n").alias(f"{c}_n")) for c in "ab")
    near = x.join(y, "v").where("a < b").where(_similar_size(num, den)).select("a", "b")
    long = sizes.where(f"m > {LIST}")
    spokes = lists.join(long, "v").select("doc_id", F.explode(F.array("p0", "p1", "p2")).alias("p")).where("doc_id <> p")
    near = near.unionByName(spokes.select(F.least("doc_id", "p").alias("a"), F.greatest("doc_id", "p").alias("b"))).distinct()
    near = materialize(estimated(near, reps, num, den), "pairs")
    links = materialize(verified(near, known, shingle, num, den, lower), "links")
    discard(near)
    comps = materialize(connected_components(links), "components")

    # Long lists whose members are not all in one component.
    member = (lists.join(long.select("v"), "v").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .select("v", "doc_id", "n", F.coalesce("component", "doc_id").alias("c")))
    open_lists = member.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    rest = materialize(member.join(open_lists, "v", "left_semi").select("doc_id", "n", "c").distinct(), "rest")
    if not rest.isEmpty():
        more = materialize(estimated(across(rest, known, shingle, num, den, lower), reps, num, den), "pairs")
        links = materialize(links.unionByName(verified(more, known, shingle, num, den, lower)), "links")
        comps = materialize(connected_components(links), "components")
        discard(more)
    discard(rest)
    ids = classes.join(comps.withColumnRenamed("node", "class_id"), "class_id", "left")
    out = table.select("doc_id", "n", "sig_a", "sig_b").join(ids, ["n", "sig_a", "sig_b"], "left")
    component = F.coalesce("component", "class_id", "doc_id")
    return out.select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))


def one_of_each(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each group, that of the smallest doc_id; all columns stay.

    Null, empty and blank texts are in no group and stay, as do rows without doc_id; a text of any length is
    compared whole. Rows that repeat a doc_id are judged each by its own text: near copies
    among them leave one (of equal texts the one of the smallest hash), different texts all stay. No rows, no result.
    """
    known = docs.where("doc_id is not null")
    if known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        gone = near_duplicates(docs, shingle, num, den).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
        return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    columns = docs.columns
    rows = known.withColumn("_text", F.xxhash64("text")).withColumn("_whole", F.xxhash64(*columns))
    rows = materialize(numbered(rows, ["doc_id", "_text", "_whole"], "_row"), "rows")
    gone = near_duplicates(rows.select(F.col("_row").cast("bigint").alias("doc_id"), "text"), shingle, num, den).where("not kept")
    left = rows.join(gone.select(F.col("doc_id").alias("_gone")), F.col("_row") == F.col("_gone"), "left_anti").select(*columns)
    return left.unionByName(docs.where("doc_id is null"))
