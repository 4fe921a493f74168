import pytest
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ODD = [
    (1, None, "en", "src0", None), (2, "", "en", None, 0), (3, " \t\n ", None, "src0", 4),
    (4, "one two three four five six seven", "en", "src0", 33),
    (5, "one two three four five six seven", "en", "src1", 33),          # copy
    (5, "one two three four five six seven", "en", "src1", 33),          # repeated row
    (None, "one two three four five six seven", "en", "src1", 33),       # no id
    (6, "ONE two three four five six seven", "en", "src0", 33),
    (7, LONG, "en", "src0", len(LONG)), (8, LONG, "en", "src0", len(LONG)),
    (9, "x" * 3000, "de", "src0", 3000), (10, "é ñ ü   emoji \U0001f600 12345", "es", "a/b", 20),
    (11, "12345 67890 ... !!!", "fr", "src0", 19), (None, None, None, None, None),
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and long texts, copies, repeated rows and extra columns with clashing names."""
    df = spark.createDataFrame(ODD, DOC)
    for name in ("kept", "print", "score", "verdict", "text_key", "shard", "cell", "k1", "bucket", "own_id", "spans"):
        df = df.withColumn(name, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)
