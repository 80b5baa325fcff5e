"""Staged tables: the points where a plan's lineage is cut.

A staged table is parquet in the shared folder named by ``spark.checkpoint.dir``, so it outlives
any executor. The setting is required; sessions for tests and benches name a folder themselves.
Tables are removed when the interpreter ends, or earlier by ``drop_staged``.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    return folder.rstrip("/")


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed with the staged tables."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return it as a plain scan with known size."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged() -> None:
    """Remove every staged table of this process; the frames that read them end with it."""
    while _written:
        spark, path = _written.pop()
        try:
            context = spark.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has ended: nothing can reach its folder any more
            continue


atexit.register(drop_staged)
