import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and blank texts, a long text, ties, repeated rows, and extra columns whose
    names operators might use themselves."""
    long = " ".join(f"word{i % 997} of{i}" for i in range(30_000))
    rows = [
        (1, "A b c d e f g. Second line here\nthird one", 5, "x"),
        (2, None, 6, "y"),
        (3, "", None, None),
        (4, " \t\n ", 7, "z"),
        (None, "no id at all but some words here", 8, "q"),
        (None, None, 9, "r"),
        (5, long, 1, "s"),
        (6, long, 1, "s"),
        (7, "same text twice", 1, "t"),
        (7, "same text twice", 1, "t"),
        (8, "a B c d e f g. second line here third ONE", 2, "u"),
        (9, "it contains \x00 zero and \x0b vertical   spaces É ß 漢字 🙂", 3, "v"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n long, grams string"
    ).selectExpr("doc_id", "text", "n", "grams", "n as one", "n as kept", "n as words_", "n as key")
