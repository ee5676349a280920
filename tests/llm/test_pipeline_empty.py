"""Every stage of the pipeline on an empty table, and on rows without any value."""

import pytest
from conftest import SF_DIR

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_without_rows_or_values(spark, name, stage):
    empty = stage(spark, spark.createDataFrame([], SCHEMA), SF_DIR)
    assert empty.count() == 0 and set(SCHEMA.replace(",", "").split()[::2]) <= set(empty.columns)
    nothing = stage(spark, spark.createDataFrame([(None,) * 5] * 2, SCHEMA), SF_DIR)
    assert nothing.count() <= 2
