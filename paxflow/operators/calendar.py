"""Calendar features and spines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paxflow.config import CHUNK_DAYS, CYCLES, Roles
from paxflow.functions import dates as D


def date_features(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Year, Semester, Quarter, Day and the cyclic pairs of five finer parts."""
    ts = D.local_time(df, roles.time)
    parts = {
        "Minute": F.minute(ts),
        "Hour": F.hour(ts),
        "Month": F.month(ts),
        "DayOfWeek": F.weekday(ts),
        "Hour_Of_Week": D.hour_of_week(ts),
    }
    waves = []
    for part, period in CYCLES.items():
        sine, cosine = D.cycle(parts[part], period)
        waves += [sine.alias(f"sin_{part}"), cosine.alias(f"cos_{part}")]
    return df.select(
        *[ts.alias(c) if c == roles.time else F.col(c) for c in df.columns],
        F.year(ts).alias("Year"),
        D.semester(ts).alias("Semester"),
        F.quarter(ts).alias("Quarter"),
        F.day(ts).alias("Day"),
        *waves,
    )


def days_between(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """One row per day of each row's closed date range."""
    return df.where(F.col(start) <= F.col(end)).withColumn(
        day, F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL '1' DAY")))
    )


def day_spine(spark: SparkSession, start: str, end: str, day: str = "day") -> DataFrame:
    """Every day of a closed range."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("_start"), F.lit(end).cast("date").alias("_end")
    )
    return days_between(bounds, "_start", "_end", day).select(day)


def date_chunks(
    df: DataFrame, keys: list[str], day: str, max_days: int = CHUNK_DAYS
) -> DataFrame:
    """Each group's day range, cut into consecutive chunks of at most ``max_days`` + 1 days."""
    ranges = df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return (
        ranges.where(F.col("first_day").isNotNull())
        .withColumn(
            "chunk_start",
            F.explode(
                F.sequence("first_day", "last_day", F.expr(f"INTERVAL '{max_days + 1}' DAY"))
            ),
        )
        .withColumn(
            "chunk_end", F.least(F.date_add("chunk_start", max_days), F.col("last_day"))
        )
    )
