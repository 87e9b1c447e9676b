import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHING = ["v", "n", "size", "_u", "_value", "count", "gram", "fp", "node", "component", "found"]


@pytest.fixture
def documents(spark):
    """Documents from rows (doc_id, text, lang, source), with extra columns of clashing names."""

    def make(rows):
        full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
        df = spark.createDataFrame(full, COLUMNS)
        return df.selectExpr("*", *[f"'clash' as {c}" for c in CLASHING])

    return make


WORDS = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "r", "st")]


@pytest.fixture
def prose():
    """Made-up prose: a function of a seed and a number of words."""

    def make(seed, words):
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) for _ in range(words))

    return make


@pytest.fixture
def odd_rows(prose):
    """Nulls, empty, blank and very long texts, rows that repeat, ties."""
    long = prose(99, 60_000)
    return [
        (1, prose(1, 80), "aa", "s1"),
        (1, prose(1, 80), "aa", "s1"),
        (2, None, None, None),
        (3, "", "aa", None),
        (4, " \n\t ", None, "s2"),
        (5, long, "aa", "s1"),
        (6, long.replace(" ", "  "), "bb", "s2"),
        (7, prose(1, 80), None, "s3"),
        (8, "123 !!", "bb", "s1"),
        (9, "one two", "bb", None),
        (None, "a row without an id", "aa", "s1"),
        (None, None, None, None),
    ]
