import duckdb
import pytest

import __spark_entry__ as entry
from ratings_engine.llm import quotes
from tests.conftest import SF_SMALL

ROWS = [
    (1, 0, "a", "Shall we meet on Monday?\nBring the plan."),
    (1, 1, "b", "On Friday a wrote:\n> Shall we meet on monday\n\nYes, at ten."),
    (1, 2, "c", ">> Bring the plan.\n> Yes, at   ten.\nI will.\n"),
    (1, 3, "a", "> I will.\nThanks"),
    (1, 4, "b", "> never said\nWhat?"),
    (1, 5, "d", ">> Bring the plan!\nwhich one"),
    (2, 0, "a", "> Shall we meet on Monday?\nother conversation"),
    (2, 1, "b", None),
    (2, 2, "b", ""),
    (3, 0, "a", "twice"),
    (3, 0, "a", "twice"),
    (3, 1, "b", "> twice\nok"),
    (None, 0, "x", "> twice"),
    (3, None, "x", "> twice\nlate"),
    (4, 0, "a", "word " * 20000),
    (4, 1, "a", "> > " + "word " * 20000 + "\n>\nend"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def _rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as body", "'z' as thread", "2 as key")
    return quotes.link_quotes(df)


def test_replies_threads_and_bodies(spark):
    got = {(r["conv_id"], r["turn"]): r for r in _rows(spark, ROWS).collect()}
    one = {t: (r["reply_to"], r["thread"], r["depth"], r["n_quoted"], r["n_linked"], r["max_level"]) for (c, t), r in got.items() if c == 1}
    assert one[0] == (None, 0, 0, 0, 0, 0)
    assert one[1] == (0, 0, 1, 1, 1, 1)
    assert one[2] == (1, 0, 2, 2, 2, 2)          # the level-1 line decides
    assert one[3] == (2, 0, 3, 1, 1, 1)
    assert one[4] == (None, 4, 0, 1, 0, 1)       # quoted, but nobody said it
    assert one[5] == (0, 0, 1, 1, 1, 2)          # only a deeper level
    assert got[1, 1]["body"] == "Yes, at ten."
    assert got[1, 2]["body"] == "I will."
    assert got[2, 0]["reply_to"] is None          # other conversation
    assert got[2, 1]["body"] == "" and got[2, 2]["n_lines"] == 0
    assert got[3, 1]["reply_to"] == 0
    assert got[None, 0]["thread"] == 0 and got[None, 0]["reply_to"] is None
    assert got[3, None]["thread"] is None and got[3, None]["body"] == "late"
    assert got[4, 1]["reply_to"] == 0 and got[4, 1]["max_level"] == 2 and got[4, 1]["body"] == "end"


REPEATED = [
    (1, 1, "a", "Good morning all"),
    (1, 2, "b", "The report is due on Friday"),
    (1, 7, "c", "Good morning all\nThe report is due on Friday\nPlease send\nyour part to Kim before noon"),
    (1, 8, "d", "Good morning all\nno news"),
    (1, 9, "e", "> Good morning all\n> The report is due on Friday\nok"),             # 7 holds both, 8 one
    (1, 10, "f", "> please send your part\n> to Kim\n> before noon\nok"),             # wrapped anew
    (1, 11, "g", "> your part to Kim\nok"),                                            # part of a line
    (1, 12, "h", "> The report is due on Friday\n> [...]\n> nobody said this\nok"),    # one line of two
    (1, 5000, "i", "no news"),
    (1, 9000, "j", "> no news\nok"),
    (1, 9001, "k", "> Good morning all\n\n> no news"),                                 # two passages, the later origin
    (1, 9002, "l", "say no news here"),
    (1, 9003, "m", "> no news\nok"),                                                   # the message of this line, not the nearer mention
]


@pytest.mark.parametrize("rows", [ROWS, REPEATED, []])
def test_duckdb_agrees(spark, rows):
    got = _rows(spark, rows)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = con.execute(quotes.SQL)
    names = [d[0] for d in want.description]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_nearest_message_that_holds_the_passage(spark):
    got = {r["turn"]: (r["reply_to"], r["n_quoted"], r["n_linked"]) for r in _rows(spark, REPEATED).collect() if r["n_quoted"]}
    assert got == {9: (7, 2, 2), 10: (7, 3, 3), 11: (7, 1, 1), 12: (7, 2, 1), 9000: (5000, 1, 1), 9001: (5000, 2, 2), 9003: (5000, 1, 1)}


def test_no_python_in_the_plan(spark):
    plan = _rows(spark, ROWS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_replies_derived_from_the_table_are_linked(spark):
    got = entry.queries()["quote_linking_of_replies"](spark, SF_SMALL).collect()
    assert sum(r["n_linked"] for r in got) > 0.9 * sum(r["n_quoted"] for r in got) > 50
    assert {r["max_level"] for r in got} == {0, 1, 2} and max(r["depth"] for r in got) == 2      # turn 7 quotes 5, 5 quotes 2
