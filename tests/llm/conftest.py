import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id long, n long, key string, `own_0` string"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with extra columns whose names the operators use themselves."""
    def build(rows):
        full = [(i, t, lang, source, len(t) if t is not None else None, 1, 2, "k", "own") for i, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    long_text = " ".join(rng.choice(["alpha", "beta", "gamma's", "δέλτα", "x1,y2", "\n"]) for _ in range(40_000))
    words = ["one", "two", "three", "four", "five", "six"]
    same = " ".join(rng.choice(words) for _ in range(80))
    return [(1, "hello  world\n\n it's", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, long_text, "en", "b"), (5, same, "fr", "a"),
            (5, same, "fr", "a"), (6, same, None, None), (None, same, "en", "b"), (None, None, "en", None), (7, "   \t\n", "en", "c"),
            (8, "tab\there \x00 <|endoftext|> é\xa0 　z", "fr", "c"), (-9, "one", "en", "a"), (10, same + " seven", "en", "b")]


@pytest.fixture(scope="session")
def odd(make, odd_rows):
    return make(odd_rows).cache()


@pytest.fixture(scope="session")
def empty(make):
    return make([])
