import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Names that operators use inside; here they are columns of the documents.
EXTRA = ["n", "key", "bucket", "held", "rep", "_hits", "row", "ids", "selected", "text2"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def documents(spark, rows):
    """Documents of (doc_id, text) with columns whose names clash with internal ones."""
    full = [(d, t, "en", None, len(t or ""), *("x" for _ in EXTRA)) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def _texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["über", "naïve", "日本", "The", "THE", "a.b", "it's"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base, passage = prose(80), prose(20)
    near = base.split()
    near[40] = "changed"
    texts = [None, "", " \t\n ", "one", "one two three four", "one two three four", base, base, base.upper(), " ".join(near)]
    texts += [" ".join(near[:-3]), f"{prose(15)} {passage} {prose(9)}", f"{passage}", f"{prose(30)}\n{passage}\n", prose(13), prose(12)]
    texts += ["x" * 5000, prose(3000), "same " * 40, "  lead  and   trail  ", "\x0b\x0cform feed", "a\x00b \x1c c d"]
    texts += [prose(rng.randint(5, 60)) for _ in range(30)]
    return texts


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and long texts, ties, repeated rows and repeated ids."""
    rows = [(i * 3, t) for i, t in enumerate(_texts())]
    return rows + [rows[6], rows[6], (rows[3][0], "other text of a known id here"), (None, rows[7][1]), (None, None), (10**12, rows[6][1])]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return documents(spark, odd_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])


@pytest.fixture
def make_docs(spark):
    return lambda rows: documents(spark, rows)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="session")
def collected():
    return rows_of
