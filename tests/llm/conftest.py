import pytest
from llm_rows import DOCS, odd_rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """Columns named like what operators add."""
    from pyspark.sql import functions as F
    names = ("size", "score", "shard", "slot", "key", "node", "component", "kept", "_h", "_stats", "h", "j", "value", "bucket", "w",
             "taken", "copies", "target", "quality", "toxic", "_kept", "_c", "n_words", "raw", "start")
    return odd.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i // 2) % 2) for i in range(40)] + [(None, 1, 1), (3, None, None), (999, 1, 1), (4, 1, 1), (4, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
