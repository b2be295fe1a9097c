import pytest

SF = "/root/testdata/sf0.001"

#: Texts that every operator must take: null, empty, blank, ties, repeats, long.
LONG = " ".join(f"word{i % 977} tail{i}" for i in range(30_000))
ODD = [(1, None, "en", "src1"), (2, "", "en", "src1"), (3, " \n\t ", None, "src1"), (4, "one", "de", None),
       (5, "same text here for two rows", "en", "src2"), (6, "same text here for two rows", "en", "src2"),
       (7, LONG, "en", "src0"), (None, "no id at all", "en", "src3"), (9, "repeated row", "fr", "src1"),
       (9, "repeated row", "fr", "src1"), (10, "né à l'été — ünïcode <|endoftext|> don't", "fr", "src2")]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Columns whose names clash with those used inside the operators.
CLASHING = ("row", "key", "digest", "n", "score", "maybe", "cell", "name", "_h", "label", "spans")


@pytest.fixture(scope="session")
def odd(spark):
    """Every awkward row, with clashing extra columns."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(f"x-{c}") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
