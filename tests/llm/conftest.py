import pytest
from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in texts], DOCS)


@pytest.fixture
def docs(spark):
    return lambda texts: documents(spark, texts)


#: Null and empty texts, a null id, a repeated row, Unicode, special strings, one very long text.
ODD = [(1, None), (2, ""), (None, "null id"), (3, "twice"), (3, "twice"), (4, "ΑΣ İst it's we'LL <|endoftext|> x<|startoftext|>Y 12 \x1c\x1d　c"), (5, "ab" * 3000 + " x " * 2000), (6, "日本 😀😀 é ﬁ ß")]


@pytest.fixture
def odd(docs):
    """With columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    return docs(ODD).withColumns({c: F.lit(7) for c in ("ids", "size", "slot", "shard", "sid", "start", "record", "sketch", "counts", "row", "d", "kept", "_text")})
