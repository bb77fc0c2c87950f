"""Tables that every operator must bear."""

import pytest

# Texts that every operator over documents must bear: null, empty, blank, one word, repeats, very long.
LONG = " ".join(f"word{i % 997} says{i % 13}" for i in range(60_000))
ODD_TEXTS = [None, "", "   \n\t ", "one", "same text here and there", "same text here and there", LONG, "é ü ß \U0001f600 𝔘", "a" * 5000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, repeated rows, equal ids, columns with names the operators use themselves."""
    rows = [(i if i != 3 else None, t, None if i % 2 else "en", "src", i) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[0], (5, "other text of the same id", "en", None, None), (None, None, None, None, None)]
    names = "doc_id bigint, text string, score string, key_id string, rank int"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
