import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghijklmnopqrst"]


def prose(n, shift=0):
    """``n`` words that repeat no 3-word run for shifts below 200."""
    return " ".join(WORDS[(i * (7 + shift) + i // 200 + shift) % 200] for i in range(n))


@pytest.fixture()
def make_docs(spark):
    def make(rows, extra=False):
        df = spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], DOCS)
        if extra:      # columns whose names the operators use themselves
            df = df.selectExpr("*", "1 as n", "2 as a", "3 as h", "'x' as spans", "4 as component_id", "5 as kept", "6 as score", "7 as owner", "8 as bucket")
        return df
    return make


@pytest.fixture()
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, one very long text."""
    base = prose(120)
    return [(1, base), (2, base), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one"), (8, base + " tail"), (9, prose(60000, 3)),
            (10, "x" * 200000), (None, base), (None, None), (11, prose(90, 5)), (11, prose(90, 5)), (12, "é ü 𝄞   a b")]
