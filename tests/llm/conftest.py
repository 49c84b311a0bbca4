import random
import string

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ünïcode", "x1"]) + str(rng.randint(0, 900)) for _ in range(30_000))
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (2, base, "a"), (2, base, "a"), (3, base.replace("w30", "v30"), None), (4, None, "a"), (5, "", "b"), (6, " \t\n", "b"), (7, "one two", "b"),
            (8, "One TWO", None), (9, long, "c"), (10, long, "c"), (None, "some text of a row without an id", "c"), (None, None, None), (11, "x" * 1200, "c"), (12, "ab " * 900, "a")]
    rows = [(*r, "e", 1, "row", 0.5, 9) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, id string, size int, row string, score double, mix_size int")


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)
