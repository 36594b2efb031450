import pytest

import corpus_pipeline
from chartmill.llm import queries
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_runs_over_the_whole_table(spark, name):
    rows = queries.QUERIES[name](spark, SF).count()
    table, key = {"op2": ("pages", "page_id"), "op13": ("conversations", "conv_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    if not name.startswith(("op7", "op8")):
        assert rows == spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().count()
    else:
        assert rows > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, SF)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == before.columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "near_duplicates":
            kept = {r.doc_id for r in queries.QUERIES["op1_near_duplicates"](spark, SF).where("kept").collect()}
            assert ids == kept
        if name in ("language", "secrets"):
            assert docs.count() == before.count()  # every document here is clean
        if name == "secrets":
            assert not docs.where(docs["text"].rlike("AKIA[A-Z0-9]{12,}")).count()
    assert corpus_pipeline.run(spark, SF).select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
