import random

import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score double, size string, fingerprint string"


def odd_rows():
    """Nulls in every column, empty and very long texts, rows that repeat, one id with two texts."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "of", "the", "mail a.b@c.de now", "call +49 (30) 1234-567", "ÄÖ", "10.0.0.1"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    texts = [None, "", " \n\t ", "one", "one two", "a b c", "A B C", long, long + " x", "naïve 日本語 text", "▁ marked ▁▁ text", "x" * 20_000]
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), "clash", 0.5, "clash", "clash") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (5, "another text", None, None, 12, None, None, None, None)]
    rows += [(None, "a b c", None, None, 5, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    return FOLDER
