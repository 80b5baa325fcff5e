"""Versioned stores: a version is there whole or not at all, and knows what it was made from.

A store is a folder. Each version is written to a folder of its own; when all of it is there, one row
appended to the ``versions`` table publishes it. Spark commits that row by a rename, so a writer that
dies leaves a folder that no row names, and readers keep the version before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

VERSIONS = "number LONG, folder STRING, schema STRING"


@dataclass(frozen=True)
class Version:
    """A published version: its number in the store, its folder, and the schema of its source."""

    number: int
    folder: str
    schema: str


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def latest(spark: SparkSession, path: str) -> Version | None:
    """The newest published version of the store at ``path``; of two of one number the one whose
    folder comes last by name, so that all readers agree."""
    rows = stored(spark, f"{path}/versions")
    if rows is None:
        return None
    last = rows.orderBy(F.desc("number"), F.desc("folder")).first()
    return None if last is None else Version(last["number"], f"{path}/{last['folder']}", last["schema"])


def publish(
    spark: SparkSession, path: str, write: Callable[[str], None], schema: str = ""
) -> Version:
    """Calls ``write`` with a new folder and publishes it when that returns."""
    before = latest(spark, path)
    number, folder = (before.number + 1 if before else 1), f"data/{uuid.uuid4().hex}"
    write(f"{path}/{folder}")
    row = spark.createDataFrame([(number, folder, schema)], VERSIONS).coalesce(1)
    row.write.mode("append").parquet(f"{path}/versions")
    return Version(number, f"{path}/{folder}", schema)


def source_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, bytes, modified) of all files below ``paths``; only listed, never read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return found.select(
        F.col("path").alias("file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """(file, change): what was added, removed or rewritten between two lists of files."""
    old = before.select("file", F.struct("bytes", "modified").alias("old"))
    new = after.select("file", F.struct("bytes", "modified").alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old") != F.col("new"), "rewritten")
    )
    both = old.join(new, "file", "full_outer").select("file", change.alias("change"))
    return both.where(F.col("change").isNotNull())


def reuse(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    sources: list[str] | None = None,
    schema: StructType | None = None,
    settings: str = "",
) -> Version:
    """The published table of the store at ``path``; builds and publishes it where there is none.

    With ``sources`` the version carries a manifest of the source's files, and with ``schema`` the
    schema they were read by; a file that was added, removed or rewritten since, another schema or
    other ``settings`` make a new version. The files are listed before they are read, so one that changes meanwhile
    is noticed by the next call. A failing build fails and publishes nothing.
    """
    told = (schema.json() if schema is not None else "") + settings
    found = latest(spark, path)
    if found is not None and sources is None:
        return found
    if found is not None and found.schema == told:
        manifest = stored(spark, f"{found.folder}/manifest")
        if manifest is not None and changed_files(manifest, source_files(spark, sources)).isEmpty():
            return found

    def write(folder: str) -> None:
        if sources is not None:
            source_files(spark, sources).write.parquet(f"{folder}/manifest")
        build().write.parquet(f"{folder}/table")

    return publish(spark, path, write, told)


def read_version(spark: SparkSession, version: Version) -> DataFrame:
    return spark.read.parquet(f"{version.folder}/table")
