import pytest

#: Names that operators use inside, as columns of the input.
CLASHES = ["id", "t", "x", "k", "n", "key", "fp", "bucket", "row", "pos", "hash", "kept", "score", "root", "component_id", "lp", "html_", "label_"]


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang), with clashing columns."""
    from pyspark.sql import functions as F

    def make(rows):
        rows = [(*r, "en")[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return df.select("*", *[F.lit(7).alias(c) for c in CLASHES])

    return make


@pytest.fixture(scope="session")
def spark_for_hypothesis(spark):
    return spark
