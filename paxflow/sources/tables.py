"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paxflow.config import MOVEMENT_COLUMNS, Roles
from paxflow.plans.stage import staged
from paxflow.sources import store
from paxflow.sources.store import stored as stored


def read_movements(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    newest_first: bool = False,
    roles: Roles = Roles(),
    **options: str,
) -> DataFrame:
    """The movement columns of any Spark source (files, catalog table, JDBC, warehouse connector).

    The selection reaches the source. Sorting a large table is left to callers that need it.
    """
    reader = spark.read.format(fmt).options(**options)
    rows = (reader.load(path) if path else reader.load()).select(*MOVEMENT_COLUMNS)
    return rows.orderBy(F.desc(roles.time)) if newest_first else rows


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a stated schema, so the file is read once."""
    return spark.read.schema(schema).option("enforceSchema", False).csv(path, header=True)


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(by) if by else writer).csv(path)


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def reuse_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    sources: list[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The stored table; builds and stores it first where it is missing or its source has changed
    (see :func:`paxflow.sources.store.reuse`)."""
    return store.read_version(spark, store.reuse(spark, path, build, sources, schema))


def read_csv_checked(
    spark: SparkSession, path: str, schema: str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of CSV files under a stated schema, from one read; with a header unless
    ``header="false"``.

    A line whose cells do not fit their types, or that has too few or too many, is a bad row: its
    file and its whole text, ``file`` and ``line``. The rows are staged once with the rejected text
    beside the parsed cells, and both tables are filters over that.
    """
    cells = StructType.fromDDL(schema)
    rejected = "_rejected_line"
    whole = StructType([*cells.fields, StructField(rejected, StringType())])
    reader = spark.read.schema(whole).option("columnNameOfCorruptRecord", rejected)
    reader = reader.options(**({"header": "true", "mode": "PERMISSIVE"} | options))
    rows = staged(reader.csv(path).withColumn("_file", F.input_file_name()), "csv-rows")
    bad = F.col(rejected).isNotNull()
    return (
        rows.where(~bad).select(*[F.col(f"`{f.name}`") for f in cells.fields]),
        rows.where(bad).select(F.col("_file").alias("file"), F.col(rejected).alias("line")),
    )


def write_dated(df: DataFrame, path: str, day: date, column: str = "run_date", fmt: str = "parquet") -> None:
    """Writes the rows as those of one day; a rerun replaces that day's and leaves the others.

    Only the partitions that the rows fall in are overwritten, each by a rename at the end. A day
    without rows keeps what it had, since it writes to no partition.
    """
    dated = df.withColumn(column, F.lit(day).cast("date"))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.option("header", True) if fmt == "csv" else writer).partitionBy(column).format(fmt).save(path)


def write_report(lines: DataFrame, path: str, keys: list[str] = ("day",)) -> None:
    """Report lines as text, one folder per report, its lines in order in one file.

    ``lines`` has the keys, line_no and line. A report is some thirty lines, so a file each is
    small however many days there are.
    """
    keys = list(keys)
    (
        lines.repartition(*keys)
        .sortWithinPartitions(*keys, "line_no")
        .select(*keys, "line")
        .write.mode("overwrite")
        .partitionBy(*keys)
        .text(path)
    )
