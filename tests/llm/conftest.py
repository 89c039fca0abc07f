import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm_spark(spark):
    from fundtide.llm.queries import workers_find_package

    workers_find_package(spark)
    return spark


@pytest.fixture(scope="session")
def corpus():
    """{doc_id: text} of the small documents table."""
    return dict(duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet')").fetchall())


@pytest.fixture(scope="session")
def documents(llm_spark):
    return llm_spark.read.parquet(f"{SF}/documents.parquet")


ODD_TEXTS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one two three"), (5, "one two three"), (5, "one two three"),
    (6, "a b c d e f g h " * 40), (7, "ünï çödé – 漢字 🙂 ' it's"), (8, "x" * 700), (None, "no id here at all, just text"),
    (9, "word " * 3000), (10, "\x00\x01 control"),
]


@pytest.fixture(scope="session")
def odd(llm_spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names used inside."""
    rows = [(d, t, "key", 1, "text2") for d, t in ODD_TEXTS]
    return llm_spark.createDataFrame(rows, "doc_id bigint, text string, key string, label int, score string").withColumn(
        "n_chars", __import__("pyspark").sql.functions.char_length("text"))


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
