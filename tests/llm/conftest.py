import pytest

from pyspark.sql import functions as F


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text, lang, source) rows, with columns whose names operators use inside."""

    def made(rows, clash=()):
        df = spark.createDataFrame(list(rows), "doc_id long, text string, lang string, source string")
        df = df.withColumn("n_chars", F.length("text").cast("long"))
        for name in clash:
            df = df.withColumn(name, F.lit(f"own {name}"))
        return df

    return made
