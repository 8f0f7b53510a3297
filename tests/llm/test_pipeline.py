"""The pipeline's stages on awkward tables, and the registered queries on the smallest test tables."""

import pytest
from cases import awkward, empty

import corpus_pipeline
from riskmart.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_awkward(spark, name, stage):
    for table in (awkward(spark), empty(spark)):
        out = stage(spark, table, SF)
        n = out.count()
        if name == "packing":
            assert (n > 0) == (table.count() > 0)
        else:
            assert out.schema.names == table.schema.names and n <= table.count()


def test_stages_feed_each_other(spark):
    sizes, kept = [], spark.read.parquet(f"{SF}/documents.parquet")
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES:
        ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        kept = spark.createDataFrame(stage(spark, kept, SF).collect(), stage(spark, kept, SF).schema)
        now = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert now <= ids
        assert name == "packing" or kept.columns == columns
        sizes.append(len(now))
    assert sizes[0] == sizes[1] and sizes[1] > sizes[2] >= sizes[3] == sizes[4] > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0 and CHECKS.keys() <= QUERIES.keys()
