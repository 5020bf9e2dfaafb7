"""Awkward documents: nulls, empty, very long, repeated and tied rows, and
extra columns whose names the operators use themselves."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} thing{i % 31}." for i in range(60_000))
ROWS = [
    (1, "The cat sat on the mat and looked at the dog for a while.", "en", "a", 57),
    (1, "The cat sat on the mat and looked at the dog for a while.", "en", "a", 57),
    (2, "The cat sat on the mat and looked at the dog for a while.", None, "a", 57),
    (3, "", "en", None, 0),
    (4, None, "en", "b", None),
    (None, "A text without a number of its own, but with enough words.", "en", "b", 10),
    (None, None, None, None, None),
    (5, " \n\t \n", "de", "b", 5),
    (6, LONG, "en", "c", len(LONG)),
    (7, "Ünïcödé 漢字 🙂 <|endoftext|> İstanbul ΟΔΟΣ é é", "fr", "c", 40),
    (8, "12345 !!! ??? 4111 1111 1111 1111 and 10.0.0.1 or +1 (555) 123-4567, a@b.org", "en", "c", 70),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("_key", "_size", "_one", "_range", "shard", "slot", "fp", "row", "word", "score", "mask", "component", "found", "kept", "start", "bad", "tokens")


def awkward(spark):
    """The awkward rows as documents with clashing extra columns."""
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.withColumns({c: F.lit("x") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
