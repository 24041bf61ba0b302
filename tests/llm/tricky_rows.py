import pytest

ROWS = [
    # doc_id, text, lang, source
    (1, "the same text here", "en", "a"),
    (2, "the  same\ttext\nhere", "en", "b"),
    (2, "the  same\ttext\nhere", "en", "b"),  # a repeated row
    (3, "the same text here ", None, None),
    (None, "the same text here", "en", "a"),
    (None, None, None, None),
    (None, None, None, None),
    (4, None, "de", "a"),
    (5, "", "de", "a"),
    (6, " \n\t ", "de", "c"),
    (7, "y" * 60_000, "fr", "c"),
    (8, " ".join(f"w{k}" for k in range(40_000)), "fr", "c"),
    (9, "one", "es", ""),
    (9, "another text under the same id", "es", ""),
    (10, "é ü 漢字 \U0001f600 ſ K", "es", "é"),
    (11, "idiot moron scum trash loser you stupid pathetic clown " * 3, "en", "a"),
    (12, "Released under the MIT License.", "en", "a"),
    (13, "mail a.b@c.example.org, card 4111 1111 1111 1111, ip 10.0.0.7, +1 (974) 555-3436.", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# Names that the operators use themselves.
CLASHING = ("digest", "keep_id", "row", "held", "score", "size", "target", "taken", "class_id", "node", "label", "tokens", "kept", "spans")


@pytest.fixture(scope="session")
def tricky(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for k, name in enumerate(CLASHING):
        docs = docs.selectExpr("*", f"'{k}' AS {name}")
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def marks(spark):
    return spark.createDataFrame([(1, 1, 0), (1, None, None), (11, 1, 1), (None, 0, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_marks(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
