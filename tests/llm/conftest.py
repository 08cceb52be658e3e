import pytest
from pyspark.sql import functions as F

from tallymart.llm.tables import ship

#: Names that operators use inside, as further columns of an input.
CLASHING = ("row", "key", "n", "first", "at", "score", "kept", "label", "digest", "rate", "round", "block", "set", "token", "lang_pred", "draw", "of_id", "of_digest")


@pytest.fixture(scope="session")
def ready(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def edge_rows():
    """doc_id, text, lang, source: nulls in every column, empty and very long texts, ties and repeated rows."""
    base = "the quick brown fox jumps over the lazy dog while nine wizards quietly mix potent brews in heavy iron pots again"
    long = " ".join(f"word{i % 977} more{i % 31}" for i in range(60_000))
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base.replace("lazy", "idle"), "en", "b"), (4, None, None, None), (5, "", "en", None),
        (None, base + " and then some more words follow here", "en", "b"), (None, None, None, None), (6, long, "fr", "b"), (7, "one two three", "fr", "c"),
        (8, "One TWO three", None, "c"), (9, " \t\n ", "en", "c"), (10, "1234 5678 !!", "en", "c"), (11, "élan " * 70, "fr", "a"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(ready, edge_rows):
    docs = ready.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("false")
