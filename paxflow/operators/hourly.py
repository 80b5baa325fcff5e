"""Hourly totals with empty hours filled, and totals by any set of dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paxflow.config import Roles
from paxflow.functions import dates as D


def hourly_totals(
    df: DataFrame, values: list[str], keys: list[str] = (), roles: Roles = Roles()
) -> DataFrame:
    """Sums per hour, over every hour from the first to the last; hours without rows hold 0.

    The gap after each hour is filled by that hour's own row, so the rows are read once. Only
    hourly sums reach the ordered window: some 8,800 a year and key.
    """
    keys = list(keys)
    hour = D.floor_hour(D.local_time(df, roles.time))
    sums = (
        df.select(hour.alias("_hour"), *keys, *values)
        .where(F.col("_hour").isNotNull())
        .groupBy("_hour", *keys)
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    following = F.lead("_hour").over(Window.partitionBy(*keys).orderBy("_hour"))
    step = F.expr("INTERVAL '1' HOUR")
    return (
        sums.withColumn("_next", F.coalesce(following - step, F.col("_hour")))
        .select(
            *keys,
            *values,
            F.posexplode(F.sequence("_hour", "_next", step)).alias("_gap", roles.time),
        )
        .select(
            roles.time,
            *keys,
            *[
                F.when(F.col("_gap") == 0, F.coalesce(v, F.lit(0)))
                .otherwise(0)
                .cast("long")
                .alias(v)
                for v in values
            ],
        )
    )


def hour_of_day(df: DataFrame, roles: Roles = Roles(), name: str = "Heure") -> DataFrame:
    return df.withColumn(name, F.hour(D.local_time(df, roles.time)))


def totals_by(
    df: DataFrame, values: list[str], dimension_sets: list[list[str]], level: str = "level"
) -> DataFrame:
    """Sums of ``values`` for several sets of dimensions; ``level`` names the set of each row.

    Rows are first summed over all dimensions together, so the sets are formed from that small
    table and not from the rows.
    """
    dims = list(dict.fromkeys(d for s in dimension_sets for d in s))
    fine = df.groupBy(*dims).agg(*[F.sum(v).alias(v) for v in values])
    label = F.concat_ws("+", *[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims])
    return fine.groupingSets([[F.col(d) for d in s] for s in dimension_sets], *dims).agg(
        label.alias(level), *[F.sum(v).alias(v) for v in values]
    )
