import pytest

LONG = "word " * 30_000 + "end"
CLASHING = ("fp", "_text_hash", "_id", "score", "_lines", "_removed", "_key", "part", "n", "shard", "spans", "_h")


@pytest.fixture
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, names that operators use."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta"), (2, ""), (3, None), (None, "alpha beta gamma delta epsilon zeta eta theta"),
        (None, None), (4, LONG), (5, "one two"), (5, "one two"), (6, "  \n\t "), (7, "one two"), (8, "É ß x\r\ny  z"),
    ]
    kinds = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], f"doc_id long, text string, {kinds}")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture
def docs(spark):
    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    return make
