"""Every document operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from ratings_engine.llm import decontaminate, lm_score, near_dup, packing, pii, quality_model, quality_rules, secrets, substring_dedup

from tests.llm.conftest import prose


def _labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (8, 0), (8, 1), (11, 1)], "doc_id long, quality int")


def _bench(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "one"), (3, "one")], "item_id long, text string")


OPS = {
    "near_dup": lambda s, d: near_dup.near_duplicates(d),
    "quality_model": lambda s, d: quality_model.score(d, _labels(s)),
    "decontaminate": lambda s, d: decontaminate.contaminated(d, _bench(s)),
    "substring_dedup": lambda s, d: substring_dedup.remove_repeats(d),
    "quality_rules": lambda s, d: quality_rules.quality_rules(d),
    "packing": lambda s, d: packing.pack(d),
    "secrets": lambda s, d: secrets.scan_secrets(d),
    "pii": lambda s, d: pii.scan_pii(d),
    "lm_score": lambda s, d: lm_score.score(d),
}
ONE_ROW_EACH = set(OPS) - {"decontaminate", "packing"}


@pytest.mark.parametrize("name", OPS)
def test_odd_rows(spark, make_docs, odd_rows, name):
    got = OPS[name](spark, make_docs(odd_rows, extra=True)).collect()
    if name in ONE_ROW_EACH:
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd_rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], r)
    if name == "near_dup":
        assert by[2]["component_id"] == by[8]["component_id"] == 1 and by[7]["component_id"] == 6
        assert [by[i]["n_shingles"] for i in (3, 4, 5, 6)] == [0, 0, 0, 1] and by[None]["kept"] and by[None]["component_id"] is None
    elif name == "substring_dedup":
        assert (by[1]["n_removed"], by[2]["n_removed"], by[8]["n_removed"], by[11]["n_removed"], by[None]["n_removed"]) == (0, 120, 120, 0, 0)
        assert by[3]["n_words"] == 0
    elif name == "decontaminate":
        assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted([(6, None), (6, 3), (7, None), (7, 3)], key=str)
    elif name == "packing":
        assert by[3]["doc_tokens"] == 1 and by[3]["length"] == 1
    elif name == "lm_score":
        assert by[3]["n_tokens"] == 1 and by[9]["n_tokens"] == 60001 and not by[None]["held_out"]
    elif name == "quality_model":
        assert by[3]["score"] == by[4]["score"] and not by[None]["held_out"]
    elif name == "quality_rules":
        assert by[3]["base_failed"] and by[3]["n_words"] == 0 and by[12]["word_chars"] == 7


@pytest.mark.parametrize("name", OPS)
def test_empty_tables(spark, make_docs, name):
    assert OPS[name](spark, make_docs([])).collect() == []


def test_pipeline_stages_keep_columns(spark, make_docs, odd_rows, tmp_path):
    _labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    _bench(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd_rows, []):
        docs = make_docs(rows, extra=True)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= len(rows)


def test_pipeline_stage_effects(spark, make_docs, odd_rows, tmp_path):
    left = near_dup.one_of_each(make_docs(odd_rows))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 9, 10, 11, 12, None, None]))
    clean = decontaminate.without_leaks(make_docs(odd_rows), _bench(spark))
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r[0]) for r in odd_rows if r[0] not in (6, 7))
    text = "write to jo.do@mail.example.com or +1 (846) 555-5432 from 10.1.2.3 now"
    out = pii.sanitise(make_docs([(1, text), (2, None), (3, "")])).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {1: "write to [EMAIL] or [PHONE] from [IP] now", 2: None, 3: ""}


def test_rows_of_one_doc_id_stay_if_their_texts_differ(spark, make_docs):
    a, b, c = prose(80), prose(80, 3), prose(80, 7)
    rows = [(5, a), (5, b), (5, b), (7, a + " tail"), (7, c), (9, c + " end"), (9, None), (9, None), (9, ""), (None, a), (3, b + " x"), (3, "z")]
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in near_dup.one_of_each(make_docs(rows)).collect())
    # b is a copy of 3's, a + tail of 5's, c + end of 7's; rows without a text stay
    assert got == sorted((str(i), str(t)) for i, t in [(5, a), (7, c), (9, None), (9, None), (9, ""), (None, a), (3, b + " x"), (3, "z")])
