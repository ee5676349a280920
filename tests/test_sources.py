"""Queries over sources that are written first."""

import types

from pyspark.sql import functions as F

from fareflow.catalog.sources import detected_format
from fareflow.schemas import YELLOW
from fareflow.session import fresh_path


def test_the_feed_of_three_formats_is_built_once(spark):
    built = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            built.add(len(batch))
            yield batch

    feed = spark.range(50).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in YELLOW]).mapInArrow(counted, YELLOW)
    t = types.SimpleNamespace(spark=spark, trips=feed, scratch=lambda label: fresh_path(spark, label))
    got = {tuple(r) for r in detected_format(t).collect()}
    assert got == {("csv", 50), ("csv.gz", 50), ("parquet", 50)} and built.value == 50
