import pytest

from vitrine.llm.common import prepare

TEXT = "Der kleine Hund lief schnell über die grüne Wiese und sah dort einen alten Mann mit Hut sitzen ."


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd(session):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and further columns with names the operators use."""
    import random

    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    long = words(40_000)
    base = words(120)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base.replace(" ", "\n", 1), "en", None), (4, base + " extra", None, "b"),
        (5, None, "en", "b"), (6, "", None, None), (7, " \t\n", "de", "b"), (None, words(80), "de", "b"), (None, None, None, None), (8, long, "en", "a"), (9, long + " tail", "en", "a"),
        (10, TEXT, "de", "a"), (11, "é　 x  y  z", "fr", "a"), (12, "one two", "en", "c"), (13, words(90), "en", "c"), (14, "A" * 300_000, "en", "c"), (8, words(60), "en", "a"),
    ]
    rows = [(*r, len(r[1] or ""), "x", 1.0, True, 5) for r in rows]
    return session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `key` string, score double, kept boolean, slot int").repartition(3)


@pytest.fixture(scope="session")
def documents(session):
    return session.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
