"""Texts reach the Python workers of the pipeline's stages a few rows at a time."""

import pyarrow as pa

import corpus_pipeline


def test_stage_runs_in_small_batches_and_leaves_the_setting(spark):
    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows], pa.int64())], ["n"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    stage = corpus_pipeline.in_small_batches(lambda s, docs, _: docs.mapInArrow(sizes, "n long"))
    got = [r["n"] for r in stage(spark, spark.range(0, 5000, 1, 2), "").collect()]
    assert sum(got) == 5000 and max(got) <= 1000 and spark.conf.get(name) == before
