import pytest

SF = "/root/testdata/sf0.001"
# Column names that operators use inside.
CLASHING = ("score", "w", "h", "g", "t", "tile", "node", "grp", "row", "vec", "k", "spans", "base", "votes", "file_id")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empties, blanks, one word, one very long text, one very long word,
    repeated rows, repeated ids, other scripts, and columns with clashing names."""
    long_text = " ".join(f"word{i % 5000} of the long text number {i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n\r "), (4, "one"), (5, "two words"), (6, long_text), (7, "x" * 200_000),
            (8, "the same row twice over and over again"), (8, "the same row twice over and over again"),
            (9, "one id"), (9, "with two different texts"), (None, "a row without an id"),
            (10, "漢字 and ελληνικά ❤️   é İ ſ"), (11, "token = \"abcdefgh12345678\" <|endoftext|> \\n"),
            (12, "THE SAME ROW twice over and over again")]
    df = spark.createDataFrame([(i, t, "en", None if i == 4 else "s", len(t or "")) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHING:
        df = df.selectExpr("*", f"'x' AS {c}")
    return df


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.filter("false")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
