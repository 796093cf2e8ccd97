"""The operators against plain versions of their contracts on the smallest table."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from ratings_engine.llm import components, lm_score, near_dup, packing, pii, quality_model, secrets, substring_dedup, text
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def _query(spark, name):
    return {r["doc_id"]: r for r in entry.queries()[name](spark, SF_SMALL).collect()}


def _words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def _components(sets, num, den):
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def _shingles(text, k):
    w = _words((text or "").encode().lower().decode())
    return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_op1(spark, texts):
    got = _query(spark, "op1_minhash_near_dedup")
    sets = {i: _shingles(t, 3) for i, t in texts.items()}
    want = _components(sets, 85, 100)
    assert {i: (r["component_id"], r["n_shingles"], r["kept"]) for i, r in got.items()} == {i: (want[i], len(sets[i]), want[i] == i) for i in texts}


def test_large_group_of_near_copies(spark, make_docs, monkeypatch):
    """Long lists: pivots, then the exact prefix filter across components."""
    monkeypatch.setattr(near_dup, "LIST", 4)
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.choice(150, rng.integers(0, 9), replace=False):
            w[at] = f"e{rng.integers(0, 30)}"
        rows.append((i, " ".join(w)))
    sets = {i: _shingles(t, 3) for i, t in rows}
    got = near_dup.near_duplicates(make_docs(rows), 3, 85, 100).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == _components(sets, 85, 100)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 502), (502, 501), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {500: 500, 501: 500, 502: 500}


def test_op2_separates_held_out_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [r for r in entry.queries()["op2_quality_classifier"](spark, "/root/testdata/sf0.01").collect() if r["doc_id"] in labels]
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


def test_op3(spark, texts):
    items = {r["item_id"]: _shingles(r["text"], 5) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"], r["n_shared"]) for r in entry.queries()["op3_decontamination"](spark, SF_SMALL).collect()}
    want = {(d, i, len(s & t)) for d, t in ((d, _shingles(t, 5)) for d, t in texts.items()) for i, s in items.items() if 5 * len(s & t) >= 4 * len(s)}
    assert got == want and got


def _kept(texts):
    first, out = {}, {}
    for i in sorted(texts):
        w = _words(texts[i])
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j:j + 13]), i)
    for i, t in texts.items():
        w = _words(t)
        keep = [True] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j:j + 13])] < i:
                keep[j:j + 13] = [False] * 13
        kept = [x for x, k in zip(w, keep) if k]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def test_op4(spark, texts):
    got = _query(spark, "op4_substring_dedup")
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == _kept(texts)


@pytest.mark.parametrize("followers", [1, 512])
def test_passages_shared_by_many(spark, make_docs, monkeypatch, followers):
    monkeypatch.setattr(substring_dedup, "FOLLOWERS", followers)
    monkeypatch.setattr(substring_dedup, "SPANS_BROADCAST", 0)
    passage, other = prose(30, 1), prose(40, 2)
    rows = [(i, f"{prose(10 + i % 7, 3 + i)} {passage} {prose(i % 9, 90 + i)} {other if i % 3 else other[:90]} end{i}") for i in range(60)]
    got = substring_dedup.remove_repeats(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == _kept(dict(rows))


def test_automaton_matches_every_substring():
    rng = np.random.default_rng(1)
    for _ in range(30):
        refs = [[bytes([c]) for c in rng.integers(97, 100, rng.integers(1, 30))] for _ in range(3)]
        a = substring_dedup.Automaton()
        for r in refs:
            a.extend(r)
        probe = [bytes([c]) for c in rng.integers(97, 100, 40)]
        for n in (1, 3, 5):
            seen = {tuple(r[i:i + n]) for r in refs for i in range(len(r) - n + 1)}
            assert a.ends(probe, n) == [i for i in range(n - 1, 40) if tuple(probe[i - n + 1:i + 1]) in seen]


def test_op5_base(spark, texts):
    for i, r in _query(spark, "op5_quality_rules").items():
        t, w = texts[i], _words(texts[i])
        grams = collections.Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
        rep = {k for j in range(len(w) - 2) if grams[tuple(w[j:j + 3])] > 1 for k in (j, j + 1, j + 2)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            dup += bool(_words(line)) and line in seen
            seen.add(line)
        want = (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["base_failed"] and r["kept"])


def test_op6_round_trip(spark, texts):
    from tokenizers import Tokenizer
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), ids=True).collect()
    parts = collections.defaultdict(list)
    fill = collections.defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        got = sorted(parts[i], key=lambda r: r["start"])
        assert [x for r in got for x in r["ids"]] == ids and all(r["doc_tokens"] == len(ids) for r in got)
        for r in got:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
    padding = 0
    for spans in fill.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 1024
        padding += 1024 - at
    assert padding <= 4 * 1024      # one bucket of 200 tails: at most a few sequences more than the ids fill


@pytest.mark.parametrize("text", ["<|endoftext|> a<|endoftext|>", "a  b\n\n c\t'll ǅ ß 東京 👍🏽 ‍ ١٢٣ ¼", "x" * 3000, " " * 500 + "y", "�\x00\x7f"])
def test_fast_ids_equal_the_tokenizer(text):
    e = packing.Encoder()
    assert e.ids(text).tolist() == e.exact.encode(text, add_special_tokens=False).ids


def test_closest_is_the_best_multiset():
    rng = np.random.default_rng(5)
    for _ in range(60):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 40, 5)}
        room = int(rng.integers(0, 100))
        sums = {0}
        for k, c in counts.items():
            sums = {s + k * n for s in sums for n in range(c + 1) if s + k * n <= room}
        got = packing.closest(counts, room)
        assert sum(k * n for k, n in got) == max(sums) and all(n <= counts[k] for k, n in got)


def test_op7(spark, texts):
    pats = {"assign": r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""",
            "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
    for i, r in _query(spark, "op7_secret_scan").items():
        found = {k: [m.span() for m in re.finditer(p, texts[i]) if (len(m[2]) >= 6 if k == "assign" else len(m[0]) >= (20 if k == "access" else 24))] for k, p in pats.items()}
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [len(v) for v in found.values()]
        spans = sorted((s, n, e, k) for n, (k, v) in enumerate(found.items()) for s, e in v)
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans).encode()).hexdigest()


def test_weak_parts_only_together():
    def kinds(text):
        return {k: [text[a:b] for a, b in v] for k, v in secrets.linked_spans(text, secrets.strong_spans(text)).items() if v}
    key = "Zx81kQpT02vLm4Rr7BnW9s"
    assert kinds(f"the value {key} alone") == {}
    assert kinds(f"user: bob\n{key}") == {"weak_id": ["user: bob"], "weak_secret": [key]}
    assert kinds(f"user: bob\n{key} https://db.example.org:5432/x") == {"weak_id": ["user: bob"], "weak_secret": [key], "weak_endpoint": ["https://db.example.org:5432/x"]}
    assert kinds("user: bob " + "word " * 200 + key) == {}
    assert kinds("user: bob at https://db.example.org") == {}


def test_op8(spark, texts):
    def base(t):
        email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
        card = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if pii._card(m[0])]
        phone = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
        return {"email": email, "ip": ip, "card": card, "phone": phone}
    odd = ["a@b.c@d.e f@g @h.i x.y@z..com q@-.-", "1.2.3.4.5.6.7.8 999.1.1.1.2.3.4.5 001.2.3.4", "+1 2 (3) 4-5.6 7 8 9 0 +12", "4111 1111 1111 1111 4111-1111-1111-1112", "a%@b@c.d.e-"]
    for t in odd:
        assert pii.entities(t) == base(t)
    for i, r in _query(spark, "op8_pii").items():
        found = base(texts[i])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [len(v) for v in found.values()]
        spans = sorted((s, n, e, k) for n, (k, v) in enumerate(found.items()) for s, e in v)
        line = [f"{k}:{s}:{e}" for s, _, e, k in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("term")] == line


def test_disclosing_terms(spark, make_docs):
    """A term seen with one entity in several contexts and nowhere else is reported; common words are not."""
    rows = [(i, f"{prose(20, i)} kestrel wrote jo.do@mail.example.com from common{i % 2} {prose(20, 40 + i)}") for i in range(6)]
    rows += [(100 + i, f"{prose(30, 60 + i)} wrote from common0 common1") for i in range(60)]
    for r in pii.scan_pii(make_docs(rows)).collect():
        text = dict(rows)[r["doc_id"]]
        terms = [text[x["s"]:x["f"]] for x in r["terms"] or ()]
        assert terms == (["kestrel"] if r["doc_id"] < 100 else [])


def test_terms_are_marked_wherever_they_stand(spark, make_docs):
    """Far from the entity, in documents without it, and short ones; a rare word of one document is not enough."""
    rows = [(i, f"K7 {prose(30, i)} jo.do@mail.example.com from common{i % 2} {prose(30, 40 + i)} kestrel once{i}") for i in range(8)]
    rows += [(50, f"{prose(20, 120)} (Kestrel) and K7, again")]
    rows += [(100 + i, f"{prose(30, 60 + i)} wrote from common0 common1") for i in range(120)]
    for r in pii.scan_pii(make_docs(rows)).collect():
        text = dict(rows)[r["doc_id"]]
        terms = [text[x["s"]:x["f"]] for x in r["terms"] or ()]
        assert terms == ([] if r["doc_id"] >= 100 else ["Kestrel", "K7"] if r["doc_id"] == 50 else ["K7", "kestrel"])
    cleaned = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(rows)).collect()}
    assert "estrel" not in cleaned[50] and "K7" not in cleaned[50]


def test_two_contexts_are_enough_where_no_chance(spark, make_docs):
    """A short name in both of an address's documents, of 3000."""
    rows = [(i, f"Wu {prose(12, i)} jo.do@mail.example.com") for i in range(2)] + [(10 + i, prose(12, i % 150)) for i in range(3000)]
    got = {r["doc_id"]: [dict(rows)[r["doc_id"]][x["s"]:x["f"]] for x in r["terms"] or ()] for r in pii.scan_pii(make_docs(rows)).collect()}
    assert got == {i: ["Wu"] if i < 2 else [] for i in got}


def test_op10(spark, texts, monkeypatch):
    got = _query(spark, "op10_lm_score")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    tokens = {i: [*_words(t.encode().lower().decode()), b""] for i, t in texts.items()}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    joined = {r["doc_id"]: r for r in lm_score.score(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), broadcast_bytes=0).collect()}
    for i, r in joined.items():
        assert math.isclose(r["score"], got[i]["score"], rel_tol=1e-9) and math.isclose(r["base_score"], got[i]["base_score"], rel_tol=1e-9)


def test_filter_holds_quantised_counts():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 20000).astype(np.uint64)
    c = rng.integers(1, 70, 20000)
    m = lm_score.Model([], [(0, lm_score.slice_of(h, c).tobytes())], 1, 1, 1)
    want = np.where(c >= 2, 2.0 ** np.floor(np.log2(c)), 0)
    got = m.quantised(h)
    assert (got >= want).all() and (got > want).mean() < 0.02
    assert (m.quantised(rng.integers(0, 1 << 63, 20000).astype(np.uint64)) > 0).mean() < 0.01


def test_filter_holds_pairs_seen_once():
    h = np.random.default_rng(4).integers(0, 1 << 63, 20000).astype(np.uint64)
    m = lm_score.Model([], [(0, lm_score.slice_of(h, np.ones(20000, np.int64)).tobytes())], 1, 1, 1)
    got = m.quantised(h)
    assert (got >= 1).all() and (got == 1).mean() > 0.98


def test_probabilities_of_a_context_sum_to_one_at_most():
    words = {b"a": 6, b"b": 5, b"c": 3, b"": 2}
    n, v = sum(words.values()), len(words)
    follow = {b"a": 3, b"b": 2, b"c": 1}          # counts of pairs (a, w), c(a) = 6
    p = {w: lm_score.WEIGHT * (2 ** int(math.log2(f)) if (f := follow.get(w, 0)) > 1 else 0) / 6 + (1 - lm_score.WEIGHT) * (c + 1) / (n + v + 1) for w, c in words.items()}
    assert sum(p.values()) <= 1


def test_training_needs_no_labels(spark, make_docs):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_model.score(make_docs([(1, "a b"), (2, None)]), empty).collect()} == {0.5}


def test_long_words_count_whole(monkeypatch):
    """Every n-gram once, across pieces, and the end of a text without blanks changes its score."""
    monkeypatch.setattr(quality_model, "PIECE", 50)
    def pairs(word):
        buckets = [b for part, _ in quality_model.word_buckets([word.encode()], (3, 4)) for b in part]
        return len(buckets), collections.Counter(buckets)
    word = "".join(chr(0x4E00 + i % 1500) for i in range(1237))
    cut = pairs(word)
    assert cut[0] == 1 + (1239 - 2) + (1239 - 3)
    monkeypatch.setattr(quality_model, "PIECE", 1 << 16)
    assert pairs(word) == cut
    shares = np.random.default_rng(1).normal(size=quality_model.BUCKETS)
    scored = quality_model._Scored(shares, (3, 4))
    a, b = (float(scored.logits([word[:300] + end], 0.0)[0]) for end in ("好" * 400, "坏" * 400))
    assert a != b and scored.logits([word[:300] + "好" * 400, "x"], 0.0)[0] == pytest.approx(a) and sum(len(w) > 64 for w in scored) == 1


def test_weak_parts_of_any_length_and_block():
    def kinds(text):
        return {k: [text[a:b] for a, b in v] for k, v in secrets.linked_spans(text, secrets.strong_spans(text)).items() if v}
    key = "Zx81kQpT02vLm4Rr7BnW9s"
    url = "https://store.example.org/x?sig=" + "aB3/" * 800 + key
    assert kinds(f"user: bob\nsk = {key[::-1]} {url}") == {"weak_id": ["user: bob"], "weak_secret": [key[::-1]], "weak_endpoint": [url]}
    name = "user: " + "q0" * 100
    assert kinds(f"{name}\n{key}")["weak_id"] == [name]
    lines = "\n".join(f"option{i} on" for i in range(60))
    assert kinds(f"[db]\nuser: bob\n{lines}\n{key}") == {"weak_id": ["user: bob"], "weak_secret": [key]}
    assert kinds(f"[db]\nuser: bob\n\n{lines}\n\n{key}\nx") == {}


def test_training_sample_is_shuffled_to_its_task(spark, make_docs, monkeypatch):
    """Only the chosen rows meet in one task; the scan keeps its partitions."""
    seen, real = [], quality_model.map_batches
    monkeypatch.setattr(quality_model, "map_batches", lambda df, *a: seen.append(df) or real(df, *a))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    quality_model.trained(make_docs([(1, "a b"), (2, "c d")]), labels)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Coalesce" not in plan


def test_spans_that_overlap_are_replaced_whole():
    for text, want in (("4111 1111 1111 1111@x.com", "[CARD][EMAIL]"), ("x 10.0.0.4 111 1111 1111 1111 y", "x [IP][CARD] y")):
        assert pii._sanitised(text, ",".join(pii.in_order(pii.entities(text)))) == want


def _linked(text, scope):
    """Added spans of the secret scan, pair by pair."""
    strong = secrets.strong_spans(text)
    taken = [s for v in strong.values() for s in v]
    meet = lambda a, b: a[0] < b[1] and b[0] < a[1]
    free = lambda spans, other: [s for s in spans if not any(meet(s, t) for t in other)]
    ids = free([m.span() for m in secrets.WEAK_ID.finditer(text)], taken)
    ends = free([m.span() for m in secrets.WEAK_ENDPOINT.finditer(text)], taken)
    keys = free([m.span() for m in secrets.WEAK_SECRET.finditer(text) if secrets._mixed(m[0])], taken + ids + ends)

    def near(a, others):
        return any((max(a[0], b[0]) - min(a[1], b[1]) < scope) and not re.search(r"\n[\x20\t\r]*\n", text[min(a[1], b[1]):max(a[0], b[0])]) for b in others)
    strong_keys = keys + strong["assign"] + strong["hex"]
    names = ids + strong["access"]
    return {"weak_id": [s for s in ids if near(s, strong_keys)], "weak_secret": [s for s in keys if near(s, names) or near(s, ends)],
            "weak_endpoint": [s for s in ends if near(s, strong_keys) and near(s, names)]}


def test_linked_parts_match_pair_by_pair():
    rng = np.random.default_rng(8)
    parts = ["user: bob", "client_id=abc.def", "Zx81kQpT02vLm4Rr7BnW9s", "qqWW12eeRR34ttYY56uu", "https://db.example.org:5432/x", "host = h1.example", "AKIA" + "Q" * 16,
             "token: abcdef99", "0123456789abcdef01234567", "word", "plain words here", "\n", "\n\n", "\n \n", "x" * 90]
    found = 0
    for _ in range(400):
        text = " ".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(2, 30)))
        got = secrets.linked_spans(text, secrets.strong_spans(text), 200)
        assert got == _linked(text, 200), text
        found += sum(map(len, got.values()))
    assert found > 300


def test_texts_of_many_spans_take_time_in_proportion():
    import time
    line = "token = abcdef123456\nuser: bob7\nkey Zx81kQpT02vLm4Rr7BnW9s mail jo@example.com 10.0.0.1\n"

    def seconds(n):
        text = line * n
        t = time.perf_counter()
        secrets.linked_spans(text, secrets.strong_spans(text))
        pii._occurrences(text, pii.entities(text), {"bob7"})
        return time.perf_counter() - t
    seconds(100)
    assert seconds(8000) < 40 * max(seconds(800), 0.005)        # 100 where each span is held against all others


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_recurring_addresses_disclose_their_company(spark, make_docs, monkeypatch, limit):
    """Addresses that recur in a corpus of other addresses: names that go with one are found, whatever else the corpus
    holds, broadcast or joined; the words of an address seen once are not."""
    monkeypatch.setattr(pii, "BROADCAST", limit)
    rows, i = [], 0
    for a in range(12):
        for k in range(5):
            i += 1
            rows.append((i, f"{prose(25, i)} Name{a} {prose(9, i + 7)} person{a}@mail.example.com {prose(14, i + 3)} only{i}"))
    rows += [(1000 + j, f"{prose(30, j % 190)} single{j}@mail.example.com rare{j} {prose(20, j % 170)}") for j in range(400)]
    rows += [(5000, "(NAME3), alone"), (5000, "Name3 Name4"), (5001, None), (5002, "")]
    text = collections.defaultdict(list)
    for d, t in rows:
        text[d].append(t)
    got = {}
    for r in pii.scan_pii(make_docs(rows)).collect():
        spans = sorted((x["s"], x["f"]) for x in r["terms"] or ())
        got.setdefault(r["doc_id"], []).append(spans)
    for d, ts in text.items():
        want = sorted([m.span() for m in re.finditer(r"(?i)name\d+", t or "")] for t in ts)
        assert sorted(got[d]) == want, d
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(rows)).collect()}
    assert "Name3" not in clean[16] and "[TERM]" in clean[16] and "rare1" in clean[1001] and clean[5001] is None


def test_only_terms_that_can_disclose_are_counted(spark, make_docs, monkeypatch):
    """Their document counts are those of the whole vocabulary, broadcast or joined; the vocabulary itself is not shuffled."""
    rows = [(i, f"Wu {prose(12, i)} wu, (Wu) \U0001f600 jo.do@mail.example.com") for i in range(3)] + [(10 + i, f"{prose(12, i % 150)} W{i}") for i in range(300)]
    docs = make_docs(rows + [(900, None), (901, "")])
    whole = {r["t"]: r["df"] for r in pii._term_counts(docs).collect()}
    some = sorted(whole)[::3] + [12345]
    terms = spark.createDataFrame([(t,) for t in some], "t bigint")
    for limit in (0, 1 << 20):
        monkeypatch.setattr(pii, "BROADCAST", limit)
        assert {r["t"]: r["df"] for r in pii._counts_of(docs, terms).collect()} == {t: whole[t] for t in some[:-1]}
    assert pii._counts_of(docs, terms.limit(0)).collect() == []
    monkeypatch.setattr(pii, "_term_counts", None)
    assert {r["t"] for r in pii.disclosing(docs).collect()} == {pii._hash("wu"), pii._hash("\U0001f600")}


def test_false_discovery_rate_of_the_bins(spark):
    rng = np.random.default_rng(6)
    for shape in (rng.exponential(1, 500), np.concatenate([rng.exponential(1, 500), rng.uniform(8, 90, 60)]), np.full(3, 1.0), np.full(3, 70.0)):
        least = pii._least_chance(spark.createDataFrame([(float(x),) for x in shape], "chance double"))
        p = np.sort(np.exp(-np.minimum(shape, pii.TOP)))
        ok = np.flatnonzero(p <= pii.RISK * np.arange(1, len(p) + 1) / len(p))
        exact = -np.log(p[ok[-1]]) if len(ok) else np.inf
        assert least == exact or exact - pii.BIN <= least <= exact + 1.0 and (shape >= least).sum() >= 0.9 * len(ok)
    assert pii._least_chance(spark.createDataFrame([], "chance double")) == float("inf")


def test_copies_of_a_document_disclose_nothing(spark, make_docs):
    """One text with an address, copied 40 times with edited words, among other texts; and its address in other texts too."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    base[60] = "jo.do@mail.example.com"
    rows = []
    for i in range(40):
        w = list(base)
        for at in rng.choice(59, rng.integers(0, 7), replace=False):
            w[at] = f"e{rng.integers(0, 500)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, prose(40, i % 190)) for i in range(400)]
    assert all(r["terms"] is None for r in pii.scan_pii(make_docs(rows)).collect())
    rows += [(1000 + i, f"{prose(40, i)} Quill jo.do@mail.example.com") for i in range(4)] + [(2000, f"b1 b2 Quill jo.do@mail.example.com {prose(12, 9)}")]
    got = {r["doc_id"]: r["terms"] for r in pii.scan_pii(make_docs(rows)).collect()}
    assert got[3] is None and got[100] is None


@pytest.mark.parametrize("followers", [1, 512])
def test_rows_that_repeat_a_doc_id_keep_to_their_own_texts(spark, make_docs, monkeypatch, followers):
    monkeypatch.setattr(substring_dedup, "FOLLOWERS", followers)
    passage, other = prose(30, 1), prose(40, 2)
    rows = [(5, f"{passage} tail"), (5, prose(100, 7)), (5, f"{other} x"), (3, f"lead {passage}"), (9, f"{prose(15, 9)} {other}"), (9, prose(100, 7)), (9, passage),
            (9, passage), (None, passage), (2, None), (2, prose(100, 11)), (4, prose(100, 11) + " more")]
    first = {}
    for i, t in rows:
        w = _words(t)
        for j in range(len(w) - 12) if i is not None else ():
            k = tuple(w[j:j + 13])
            first[k] = min(i, first.get(k, i))
    want = []
    for i, t in rows:
        w = _words(t)
        keep = [True] * len(w)
        for j in range(len(w) - 12) if i is not None else ():
            if first[tuple(w[j:j + 13])] < i:
                keep[j:j + 13] = [False] * 13
        kept = [x for x, k in zip(w, keep) if k]
        want.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(make_docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


ODD_TEXTS = [None, "", " ", "one", "\n", " lead and trail \n", "a\x0bb\x0cc\r\nd\te", "é\x85ü\xa0ñ\x1cz ÀB Ab aB", *(prose(40 + i, i) for i in range(30)), "x " * 200]


@pytest.mark.parametrize("lower", [False, True])
def test_words_of_a_column_hash_as_words_of_a_text(lower):
    want = [text.Vocab().hashes(text.words_of(t, lower)) for t in ODD_TEXTS]
    for part in (pa.array(ODD_TEXTS), pa.array(["cut", *ODD_TEXTS, "off"]).slice(1, len(ODD_TEXTS))):
        h, counts = text.word_hashes(part, lower)
        assert counts.tolist() == list(map(len, want)) and np.array_equal(h, np.concatenate(want))
    assert [x for part in text.row_slices(pa.array(ODD_TEXTS), 100) for x in part.to_pylist()] == ODD_TEXTS


@pytest.mark.parametrize("chunk", [300, 1 << 20])
def test_anchors_of_a_batch_are_those_of_its_rows(spark, make_docs, monkeypatch, chunk):
    taken, calls, real = [], [], substring_dedup.gram_hashes
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk, raising=False)
    monkeypatch.setattr(substring_dedup, "map_batches", lambda df, fn, schema: taken.append(fn))
    substring_dedup.anchors(make_docs([]).selectExpr("doc_id", "text", "0L as tk"), 13, 5)
    ids = list(range(7, 7 + len(ODD_TEXTS)))
    want = {(i, int(a)) for i, t in zip(ids, ODD_TEXTS) if len(w := text.words_of(t)) >= 13
            for a in text.signed(substring_dedup.anchors_of(text.Vocab().hashes(w), 13, 5))}
    monkeypatch.setattr(substring_dedup, "gram_hashes", lambda *a: calls.append(1) or real(*a))
    out = list(taken[0](iter([pa.RecordBatch.from_pydict({"doc_id": ids, "text": ODD_TEXTS, "tk": [0] * len(ids)})])))
    rows = [(d, h) for cols in out for d, h in zip(cols["doc_id"].tolist(), cols["h"].tolist())]
    assert len(rows) == len(want) and set(rows) == want
    assert len(calls) == 1 if chunk > 10000 else len(calls) > 1          # once per slice, not per row


def test_filter_hashes_a_pair_once_per_level(monkeypatch):
    rng, hashed, real = np.random.default_rng(5), [], lm_score.mixed
    h, c = rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.integers(1, 70, 5000)
    monkeypatch.setattr(lm_score, "mixed", lambda x: hashed.append(len(x)) or real(x))
    m = lm_score.Model([], [(0, lm_score.slice_of(h, c).tobytes())], 1, 1, 1)
    levels = int(np.frexp(c.astype(float))[1].sum())
    assert sum(hashed) == 2 * levels
    hashed.clear()
    m.quantised(h)
    assert 2 * (levels + len(h)) <= sum(hashed) < 2.1 * (levels + len(h))          # and the level that is missing


def test_frequent_pairs_are_probed_once(monkeypatch):
    monkeypatch.setattr(lm_score, "REMEMBERED", 64)
    asked, rng = [], np.random.default_rng(6)
    value = dict(zip([0, 1, 64, *rng.integers(0, 1 << 63, 200).tolist()], [0.0, 1.0, *(2.0 ** rng.integers(0, 6, 201))]))
    kept = lm_score._Remembered(lambda h: asked.append(len(h)) or np.array([value[x] for x in h.tolist()]), 2.0)
    keys = np.array(list(value), np.uint64)
    for _ in range(20):
        h = rng.choice(keys, 300)
        assert kept(h).tolist() == [value[x] for x in h.tolist()]
    some = [x for x in value if value[x] >= 2][:1] * 50
    kept(np.array(some, np.uint64))
    asked.clear()
    assert kept(np.array(some, np.uint64)).tolist() == [value[some[0]]] * 50 and sum(asked) == 0
