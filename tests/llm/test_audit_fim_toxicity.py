"""Operators 11 to 13 against plain versions, and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from ratings_engine.llm import divergence, fill_in_middle, toxicity
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n int, value string, score int, form string, part int"


def _frame(spark, rows):
    """Columns whose names the operators use themselves come along."""
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], SCHEMA)


# ------------------------------------------------------------------ source divergence

def _audit(rows, min_docs=10, top=10):
    n, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if c.isascii() else c for c in text)
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        for t in found:
            n[lang, source, t] += 1
        for t in set(found):
            docs[lang, t] += 1
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), d in docs.items() if x == lang and d >= min_docs]
        sources = [s for x, s in groups if x == lang]
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        whole = sum(total.values())

        def share(c, all_):
            return 1 + 10**9 * (c + 2) // (all_ + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)
        for a in sources:
            pair = [(b, sum(f(share(n[lang, a, t], total[a]), share(n[lang, b, t], total[b])) for t in kept)) for b in sources if b != a]
            pq = [(t, share(n[lang, a, t], total[a]), share(sum(n[lang, s, t] for s in sources), whole)) for t in kept if n[lang, a, t]]
            term = [(t, f(p, q)) for t, p, q in pq if p > q]
            for part, items in (("pair", pair), ("term", term)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, a, part, t, v, i + 1) for i, (t, v) in enumerate(ranked) if part == "pair" or i < top}
    return out


def _rows(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("block", [3, 1 << 17])
def test_op11(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TABLE", 2000)
    docs = [(r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = _rows(entry.queries()["op11_source_divergence"](spark, SF_SMALL))
    assert got == _audit(docs) and any(r[2] == "term" for r in got)


def test_audit_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 64)
    rows = [(1, "Alpha beta É é ß", "en", "a"), (1, "alpha ALPHA gamma", "en", "a"), (2, None, "en", "b"), (3, "", None, None), (4, " 12 -- \n", "", "c"),
            (5, "beta " * 300 + "x" * 500, "en", "c"), (None, "alpha é東京", "en", "c"), (6, "solo", "de", "only"), (6, "solo", "de", "only"),
            (7, "tie one two", "fr", "p"), (8, "tie one two", "fr", "q"), (9, "tie", "fr", "r")]
    for min_docs, top in ((1, 10), (2, 1), (50, 3)):
        got = _rows(divergence.audit(_frame(spark, rows), min_docs, top))
        assert got == _audit([r[1:] for r in rows], min_docs, top)
    assert ("", "", "pair", "c", 0, 1) in got and not any(r[0] == "de" for r in got)
    assert _rows(divergence.audit(_frame(spark, []))) == set()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=12), st.integers(0, 5), st.integers(1, 9))
def test_runs_give_the_sum_over_rows(vectors, more, vocab):
    weights = np.array([v[0] for v in vectors])
    ends = np.cumsum(weights)
    dense = [np.repeat([v[i] for v in vectors], weights) for i in (1, 2)]
    runs = []
    for d, i in zip(dense, (1, 2)):
        has = np.array([v[i] > 0 for v in vectors])
        starts, counts = divergence.encode((ends - weights)[has], ends[has], np.array([v[i] for v in vectors])[has])
        inner = starts < ends[-1]
        runs.append((starts[inner], divergence.shares(counts[inner], int(d.sum()) + more, vocab)))
        assert (np.diff(runs[-1][0]) > 0).all() and runs[-1][0][0] == 0
    p, q = ([1 + 10**9 * (int(c) + 2) // (int(d.sum()) + more + 2 * vocab) for c in d] for d in dense)
    assert divergence.intersect(*runs, int(ends[-1])) == sum((a - b) ** 2 // (a + b) for a, b in zip(p, q))


@given(st.integers(0, 10**13), st.integers(0, 10**14), st.integers(1, 10**9))
def test_shares_are_exact(count, rest, vocab):
    assert divergence.shares(np.array([count]), count + rest, vocab)[0] == 1 + 10**9 * (count + 2) // (count + rest + 2 * vocab)


# ------------------------------------------------------------------ fill in the middle

def _fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    assert "".join(units) == text
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        form, out, sizes = "plain", text, (None, None)
    else:
        form = "spm" if h[3] % 100 < 80 else "psm"
        out, sizes = (f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"), (len(p), len(m))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
    return (len(units), form, *sizes, *sha)


COLS = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def test_op12(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in entry.queries()["op12_fill_in_middle"](spark, SF_SMALL).collect()}
    assert got == {i: _fim(i, t) for i, t in texts.items()}
    assert {r[1] for r in got.values()} == {"plain", "psm", "spm"}


def test_fim_odd_rows(spark, odd_rows):
    rows = [*odd_rows, *((100 + i, t) for i in range(40) for t in ("a < b <", "S> x <S", "<", " lead and tail \n", "\x1c\x85　 ü𝄞 東京\t<P", "has <M> in it", "\n \n"))]
    got = fill_in_middle.digests(fill_in_middle.transform(_frame(spark, [(*r, "en", "s") for r in rows]))).collect()
    assert sorted(((r["doc_id"], *(r[c] for c in COLS)) for r in got), key=str) == sorted(((i, *_fim(i, t)) for i, t in rows), key=str)
    assert fill_in_middle.transform(_frame(spark, [])).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab \né東𝄞", max_size=60), st.integers(1, 9))
def test_block_tree_finds_every_cut(text, block):
    raw = np.frombuffer(text.encode(), np.uint8)
    tree = fill_in_middle.BlockTree(*fill_in_middle.marks(raw, np.array([0, len(raw)])), block)
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    assert tree.units == len(units)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert tree.cut(k) == (len(head.encode()), len(head))


# ------------------------------------------------------------------ toxicity

LEXICON = {"idiot": 3.0, "foo~": 1.0}


def _features(text):
    """The named rates, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return [0.0] * len(toxicity.FEATURES)
    cores = [w.strip(toxicity.EDGES).lower() for w in words]

    def weight(c):
        return 3.0 if c == "idiot" else 1.0 if c.startswith("foo") else 0.0

    def undone(w):
        return re.sub(r"[\W\d_]+", "", re.sub(r"([^\W\d_])\1\1+", r"\1", w.lower().translate(toxicity.LOOK_ALIKE)))
    own = [weight(c) for c in cores]
    odd = [not c.isalpha() or w[0] in "@$+" or bool(re.search(r"([^\W\d_])\1\1", c)) for w, c in zip(words, cores)]
    found = [x or (weight(undone(w)) if o else 0.0) for x, w, o in zip(own, words, odd)]
    hits = [i for i, x in enumerate(found) if x]
    you = [i for i, c in enumerate(cores) if c in toxicity.SECOND_PERSON]
    n, chars = len(words), sum(map(len, words))
    letters = [sum(map(str.isalpha, w)) for w in words]
    upper = [sum(map(str.isupper, w)) for w in words]
    signs = [len(w) - sum(map(str.isalnum, w)) for w in words]
    single = "".join("s" if a == len(c) == 1 else "." for a, c in zip(letters, cores))
    return [len(hits) / n, sum(found) / n, sum(x >= 2 for x in found) / n, np.log1p(len(hits)), max(found), len({words[i] for i in hits}) / n,
            sum(x > 0 and not o for x, o in zip(found, own)) / n, len(you) / n, sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in hits) / n,
            sum(upper) / max(1, sum(letters)), sum(a == b > 1 for a, b in zip(upper, letters)) / n, sum(signs) / chars, sum(w.count("!") for w in words) / n,
            sum(k > 1 and bool(re.search(r"([!?.,*#-])\1", w)) for w, k in zip(words, signs)) / n,
            sum(bool(re.search(r"[^\W\d_][\d@$!+*._-]+[^\W\d_]|\d[^\W\d_]", w)) for w, c in zip(words, cores) if not c.isalpha()) / n,
            sum(bool(re.search(r"([^\W\d_])\1\1", c)) for c in cores) / n, sum(len(r) for r in re.findall("s{3,}", single)) / n, np.log1p(n), chars / n]


@pytest.mark.parametrize("text", [None, "", " \n", "You are an IDIOT!!! you idiot", "1d10t and $o i.d.i.o.t f00bar Foolish", "i d i o t you", "sooo foooo fooood... ???",
                                  "ÜBER tu idiot " + "word " * 9 + "tu foo", "\x1c 東京 é@b 12 3x --", "x" * 300 + "1 " + "idiot " * 50 + "a b c d"])
def test_features_are_the_named_rates(text):
    got = toxicity.features(text, toxicity.Shapes(LEXICON, 2.0, limit=3))
    assert np.allclose(got, _features(text)), dict(zip(toxicity.FEATURES, zip(got, _features(text))))


def test_op13_separates_held_out_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = toxicity.score(docs.repartition(4), labels).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(toxic)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [(r["score"], r["predicted"], toxic[r["doc_id"]]) for r in got if r["held_out"]]
    assert np.mean([p for _, p, y in held if y]) > 0.88 and np.mean([p for _, p, y in held if not y]) < 0.03
    assert np.mean([s for s, _, y in held if y]) > 0.8 and np.mean([s for s, _, y in held if not y]) < 0.05       # calibrated


def test_held_out_labels_and_other_columns_change_nothing(spark):
    rows = [(i, ("you are a bad rotten fool " if i % 3 == 0 else "we had a calm day ") * (1 + i % 4), "en", "s") for i in range(240)]
    marks = [(i, int(i % 3 == 0)) for i in range(240)]
    flip = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in marks]
    other = [(i, t, "xx", f"z{y}") for (i, t, *_), (_, y) in zip(rows, marks)]
    t = toxicity.Training(trees=3)
    out = []
    for r, m in ((rows, marks), (other, flip)):
        got = toxicity.score(_frame(spark, r), spark.createDataFrame(m, "doc_id long, toxic int"), t).collect()
        out.append(sorted((x["doc_id"], x["score"], x["predicted"]) for x in got))
    assert out[0] == out[1]
    assert [p for _, _, p in out[0]] == [y for _, y in marks]


def test_toxicity_odd_rows(spark, odd_rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (8, 0), (8, 1), (11, 1), (12, 7)], "doc_id long, toxic int")
    rows = [(*r, "en", "s") for r in odd_rows]
    got = toxicity.score(_frame(spark, rows), labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["score"] == by[4]["score"] == by[5]["score"] and not by[None]["held_out"]
    none = labels.where("false")
    assert {r["score"] for r in toxicity.score(_frame(spark, rows), none).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(_frame(spark, rows), labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.score(_frame(spark, []), labels).collect() == []
