import pytest


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "é" * 300), (6, "word " * 3000), (7, "the same text twice over here"), (7, "the same text twice over here"),
    (8, "the same text twice over here"), (None, "no id at all"), (None, None), (9, "MIT License, Apache LICENSE; General Public License"), (10, "mail a@b.co +1 (437) 555-0689 4111 1111 1111 1111 1.2.3.4"), (11, "x" * 20000), (12, "\U0001F600 <|endoftext|> it's 12'd"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id long, text string")
    more = {c: F.lit(None).cast("string") for c in ("score", "row", "kind", "n", "length", "bucket", "value", "y", "u", "v", "component", "epoch", "taken", "digest")}
    return df.withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") > 5, "src1"), "n_chars": F.length("text").cast("long")} | more)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
