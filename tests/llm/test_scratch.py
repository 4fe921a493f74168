"""Files that the operators and the pipeline leave in the shared folder."""
import os

import corpus_pipeline
from martkit.llm.common import scratch, stored

from .conftest import SF_SMALL


def held(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f for f in os.listdir(folder) if not f.startswith("rdd-")}


def test_scratch_tables_go_with_their_block(spark):
    stored(spark.range(3))
    before = held(spark)
    with scratch(spark):
        kept = stored(spark.range(5))
        assert kept.count() == 5 and held(spark) > before
    assert held(spark) == before


def test_the_pipeline_leaves_its_result_only(spark):
    before = held(spark)
    out = corpus_pipeline.run(spark, SF_SMALL)
    new = held(spark) - before
    assert len(new) == 1 and out.count() > 0
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert os.listdir(f"{folder}/{new.pop()}") == ["pack"]
