"""Documents with nulls, empty and very long texts, ties, repeated rows, and columns named like the operators' own."""

from pyspark.sql import functions as F

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    base = " ".join(f"Word{i % 37} other{i % 11}" for i in range(60))
    return [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base + " more", None, "b", 1), (4, None, "en", None, 0),
        (5, "", "en", "b", 0), (6, " \t\n", None, None, 3), (None, base + " without id", "de", "c", 1), (None, "two words", "de", "c", 1),
        (7, "x" * 300_000, "en", "a", 1), (8, "long text. " * 30_000, "en", "a", 1), (9, "é😀 ß" * 20, "fr", "", 1), (10, "one", "fr", "", 1),
        (11, "Mit License\nGNU general public license <|endoftext|> <|x", "en", "b", 1),
    ]


def documents(spark, *names):
    """The table, with further columns of the given names."""
    return spark.createDataFrame(rows(), DDL).withColumns({n: F.lit("clash") for n in ("key", "id", "tag", *names)})


def empty(spark):
    return spark.createDataFrame([], DDL)
