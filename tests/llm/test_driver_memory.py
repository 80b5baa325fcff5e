"""What the driver holds at once of the join's tables."""

from __future__ import annotations

import tracemalloc

import numpy as np

from paxflow.llm import shingle_join as S


def test_tables_reach_the_driver_as_bytes(spark):
    rows = spark.range(30).selectExpr("id", "concat('a b c d e f', id % 3) AS text").repartition(3)
    texts = rows.selectExpr("id AS row", "CAST(text AS BINARY) AS text")
    tracemalloc.start()
    found = S.fixed_table(texts, S._frequencies, S._steps)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.dtype == np.uint8 and len(found) == 1 << S.TABLE_BITS
    assert most < 3 * len(found)
    # Of the two shingles of each text one is in all thirty, the other in ten.
    assert sorted(found[found > 0].tolist()) == [13, 13, 13, 19]
    assert not S.fixed_table(texts.limit(0), S._frequencies, S._some).any()

