
import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text, lang, source); two more columns with names that the operators use inside."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return df.withColumn("n_chars", F.length("text").cast("long")).withColumn("fp", F.lit("x")).withColumn("anchor", F.lit(1)).withColumn("size", F.lit("y"))

    return make


ODD = [(1, None, "en", "a"), (2, "", "en", None), (3, "  \n\t ", None, "a"), (4, "one", "en", "a"), (4, "one", "en", "a"), (None, "one two", None, None), (5, "é " * 30_000 + "end", "fr", "b"), (6, "12 34 !!", "de", "b")]


@pytest.fixture
def odd(docs):
    return docs(ODD)


@pytest.fixture
def empty(docs):
    return docs([])
