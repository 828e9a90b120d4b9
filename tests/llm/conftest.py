import pytest

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
EDGE = [(1, "alpha beta gamma", "en", "s"), (2, None, "en", None), (3, "", None, "s"), (None, "alpha beta gamma", "en", "s"),
        (4, "alpha beta gamma", "en", "s"), (4, "alpha beta gamma", "en", "s"), (5, LONG, "en", "t"), (6, LONG + " end", "en", "t"),
        (7, " \n\t ", "en", "t"), (8, "é ß 中文 😀 " * 30, "xx", "u"), (9, "x" * 5000, "en", "u")]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string")
    for name in ("id", "size", "n_words", "hit", "node", "key", "row", "fail_bits", "h", "pattern", "items", "kept"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)
