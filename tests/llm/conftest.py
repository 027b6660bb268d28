import random

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def invented(seed, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    long_ = invented(1, 20_000)
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "   \n\t", None, "a", 5), (4, long_, "en", "b", len(long_)), (5, long_, "en", "b", len(long_)),
        (6, "x" * 5000, "en", None, 5000), (7, "word", None, None, None), (None, "no id here at all", "fr", "c", 3), (None, None, None, None, None),
        (8, invented(2, 300), "en", "a", 1), (8, invented(2, 300), "en", "a", 1), (9, "é ü ß " * 100, "de", "c", 600), (10, "12 34 !!", "en", "a", 8), (-5, "  two  spaces ▁ mark ", "es", "d", 4),
    ]
    return rows + [(100 + i, invented(50 + i, 120 + i), ("en", "fr")[i % 2], "abc"[i % 3], 700) for i in range(30)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOC)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    for name in ("size", "score", "_text", "fp", "rep", "key", "n", "copies", "component_id", "ids", "n_words", "a.b"):
        odd = odd.withColumn(name, F.lit(1))
    return odd
