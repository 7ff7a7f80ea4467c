import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows, long texts, columns that clash with working names."""
    long = " ".join(f"w{i}" for i in range(20_000)) + "\nend of it"
    rows = [
        (1, "one two three four five six seven", 1),
        (1, "one two three four five six seven", 1),
        (2, None, 2), (3, "", 3), (4, " \n\t ", None), (None, "one two three four five six seven", 4),
        (5, long, 5), (6, long + " more", 6), (7, "é 日本 🎉 #&| token=abcdef123", 7),
        (8, "ONE two THREE four five six seven", 8),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, row int").selectExpr(
        "doc_id", "text", "row", "row AS doc", "row AS key", "row AS _text", "row AS id", "row AS `a.b`"
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """(doc_id, text) of the whole smallest table."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
