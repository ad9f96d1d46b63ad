import pytest
from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta omega kappa sigma theta lambda zeta".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice(WORDS)[: r.randint(2, 6)] for _ in range(2)) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, and extra columns with clashing names."""
    rows = [
        (1, prose(1, 80), "en", "a"),
        (2, prose(1, 80), "en", "a"),
        (2, prose(1, 80), "en", "a"),
        (3, prose(2, 90) + " mail joe@example.com", None, "a"),
        (3, prose(3, 70), "en", None),
        (None, prose(4, 60), "en", "b"),
        (None, None, None, None),
        (4, None, "de", "b"),
        (5, "", "de", "b"),
        (6, " \t\n ", "de", "b"),
        (7, prose(5, 6000), "fr", "c"),
        (8, "x" * 5000, "fr", "c"),
        (9, "日本語 ▁ 😀 \x00 é" * 20, "ja", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ["fp", "mark", "row", "ids", "component_id", "cell", "h", "kept", "_good", "body", "n_chars"]
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(clash)))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame([(1, prose(1, 80)[20:150]), (2, None), (3, ""), (None, "never to be found in any text at all")], "item_id long, text string")
