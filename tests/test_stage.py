"""Where staged tables go."""

from __future__ import annotations

from paxflow.plans.stage import CHECKPOINT_SETTING, shared_folder, staged


def test_staged_tables_use_the_named_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get(CHECKPOINT_SETTING).rstrip("/")
    table = staged(spark.range(10), "numbers")
    assert table.count() == 10
    assert all(folder in path and "numbers-" in path for path in table.inputFiles())
