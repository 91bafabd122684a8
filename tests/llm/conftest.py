import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = ("the river ran past the old mill and over the stones where children used to play in summer while "
         "their parents talked about the harvest and the price of bread in the market town below")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank and very long texts, repeated rows, and columns whose
    names operators use for themselves."""
    rows = [(1, PROSE, "en", "a", 5), (1, PROSE, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "b", 0),
            (4, " \n\t ", "fr", None, 4), (None, PROSE + " once more", "en", "b", 1), (None, None, None, "c", None),
            (5, "word " * 40_000, "de", "a", 1), (6, "x" * 100_000, "de", "a", 1), (7, "é ü  \r\n ß", None, "b", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(c) for c in (
        "Score", "n_words", "COPIES", "target", "fp", "text_hash", "Labels", "kept", "host", "Rule", "key",
        "n_tokens", "base_score", "t", "word_length", "_id", "size")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
