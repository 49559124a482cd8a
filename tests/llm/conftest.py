import zlib

import pytest

# edge cases every operator must take: NULLs, empty, ties, repeated rows, long text
LONG = "word " * 20_000 + "end"
EDGE = [(1, "a b c d e", "en", "s1", 9), (2, "a  b c\nd e", "en", None, 10), (2, "a  b c\nd e", "en", None, 10),
        (3, "", None, "s1", 0), (4, None, None, None, None), (None, "x y z", "en", "s2", 5), (5, " \t\n", "de", "s2", 3),
        (6, LONG, "en", "s1", len(LONG)), (7, "you Idiot!! é ß <|im_end|>", "fr", "s1", 26)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside
CLASH = ["digest", "code", "score", "block", "row", "epoch", "tokens", "kept", "shard", "points", "total"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(EDGE, SCHEMA)
    for name in CLASH:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())
