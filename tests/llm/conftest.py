import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SMALL


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns with clashing names."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, "   \n\n\t ", "en", "s", 7), (4, "one", "en", "s", 3),
        (5, "one two", "en", None, 7), (6, "the same line of some words here\n" * 3, "en", "s", 99), (6, "the same line of some words here\n" * 3, "en", "s", 99),
        (7, "long text with many words and a 42 in it. " * 20000, "en", "s", 840000), (None, "a text without any id at all", "en", "s", 20), (8, "é́ \U0001f600 中文 Straße <|endoftext|> it's", "de", "s", 30),
    ]
    extra = "key string, node long, n int, fp long, u long, v long, component long, h long, line string, score double, span int"
    import pyspark.sql.functions as F

    df = spark.createDataFrame(rows, DOCS)
    for c in extra.split(", "):
        name, kind = c.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df
