"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words: the ASCII blanks of the contracts, as a Java pattern and as its inverse.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Keys that a task of ``running_starts`` sums up.
RUN = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as a string; a null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def parts(spark: SparkSession) -> int:
    """How many partitions the session shuffles to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_starts(counts: DataFrame, key: str, run: str = f"{{}} div {RUN}") -> DataFrame:
    """``key, start``: the sum of ``n`` over all smaller keys, by prefix sums in two levels."""
    runs = counts.withColumn("run", F.expr(run.format(key)))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("run").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    whole = runs.groupBy("run").agg(F.sum("n").alias("n"))
    bases = whole.select("run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = runs.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return own.join(bases, "run").select(key, (F.col("base") + F.col("inside")).alias("start"))
