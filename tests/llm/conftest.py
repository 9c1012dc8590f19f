import random

import pytest
from pyspark.sql import functions as F


def prose(rng, words):
    return " ".join("".join(rng.choice(["ta", "ri", "no", "shel", "qua", "be", "lo"]) for _ in range(rng.randint(1, 4)))
                    for _ in range(words))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, blank, repeated, short and very long texts, and columns that clash with results."""
    rng = random.Random(3)
    base = prose(rng, 120)
    data = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, base), (6, base), (6, base), (7, base + " more"), (None, base),
            (None, None), (8, prose(rng, 30_000)), (9, "x" * 3000), (10, "Ünï \x00 日本 <|endoftext|> ΣΑΣ"), (11, "a\nb\nc\nd\na\nb\nc")]
    return spark.createDataFrame(data, "doc_id bigint, text string").withColumns(
        {"n_tokens": F.lit("clash"), "score": F.lit("clash"), "starts": F.lit(1), "k": F.lit(2), "t": F.lit(3), "f": F.lit(4),
         "odd.name": F.lit(5), "h": F.lit(6)})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
