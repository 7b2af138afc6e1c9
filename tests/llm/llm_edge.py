import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
DOCS = [
    (1, "the quick brown fox jumps over the lazy dog\nand runs away", "en", "a", 10),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t\n ", "en", "a", 4),
    (5, "!!! ... ???", None, "b", 11),
    (6, "the quick brown fox jumps over the lazy dog\nand runs away", "en", "a", 10),
    (6, "the quick brown fox jumps over the lazy dog\nand runs away", "en", "a", 10),  # repeated row
    (7, " ".join(f"w{i} of the {i % 97}" for i in range(20000)), "en", "b", 0),  # very long
    (8, "one", "en", "b", 3),
    (None, "no id here but some words", "en", "b", 3),
    (9, "línea única con ñ y ü\nline two\r\nline two", "es", None, 3),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
