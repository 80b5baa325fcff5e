"""The entry alone, called from an empty folder, must make the package known to the Python workers."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.shuffle.partitions", "2").getOrCreate())
print("ROWS", entry.queries()["rolling_global"](spark, "/root/testdata/sf0.001").count())
"""


def test_package_reaches_executors(tmp_path):
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    import pyspark

    environment["SPARK_HOME"] = os.path.dirname(pyspark.__file__)
    environment["SPARK_SCALA_VERSION"] = "2.13"
    (tmp_path / "work").mkdir()
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, entry, str(tmp_path / "stage")],
        cwd=tmp_path / "work",
        env=environment,
        capture_output=True,
        text=True,
        timeout=240,
    )
    assert "ROWS 1000" in done.stdout, done.stderr[-2000:]
