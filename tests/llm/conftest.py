import random

import pytest

SF = "/root/testdata/sf0.001"
WORDS = "river stone market winter letter garden window silver morning paper bridge forest summer island kitchen travel".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "er", "ing", "ly", "ful"]) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows that every operator must take: nulls, empty and very long texts, repeats, clashing extra columns."""
    rng = random.Random(11)
    text = prose(rng, 120)
    rows = [
        (0, text, "en"), (1, text, "en"), (1, text, "en"), (2, None, "en"), (3, "", None), (None, text, "en"), (4, "   \n\t ", "en"),
        (5, "1234 5678 !!!", None), (6, "x" * 70_000, "en"), (7, prose(rng, 20_000), "en"), (8, "a\x00b\u2028c \U0001F600 ß", "de"),
        (9, prose(rng, 3), "en"), (10, text + " end", None), (None, None, None),
    ]
    schema = "doc_id long, text string, lang string, score double, id_ string, n long, rep string, kept string, toxic string, bucket int"
    return spark.createDataFrame([(*r, 0.5, "id", 3, "r", None, "t", 1) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(12)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
