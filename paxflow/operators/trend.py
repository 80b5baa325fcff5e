"""Trend ratios: a short time window against a long one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paxflow.config import STATISTICS, TREND_DAYS, Roles
from paxflow.functions import dates as D
from paxflow.functions.numbers import ratio_or_one
from paxflow.operators.rolling import attach, group_name, narrow, spread_join
from paxflow.plans.blocks import previous_value
from paxflow.plans.sliding import STATS, VALUE, WEIGHT, time_frames

_DAY = 86_400_000_000
_CLOCK = "_clock"


def trend_stats(
    df: DataFrame,
    keys: list[str],
    short_days: int = 7,
    long_days: int = 30,
    stats=STATISTICS,
    roles: Roles = Roles(),
) -> DataFrame:
    """Row id and ``{group}_trend_{s}D_vs_{l}D_{stat}``.

    Both windows end just before the row's time and run over the group's target moved down by one
    row. The ratio is 1 where the long value is missing or not positive.

    Rows of one time share their frames, so each group is first counted by (time, value): whatever
    its number of rows, it has at most one entry per minute and whole number of passengers. The
    entries go to slices of time as long as the long window; each slice also receives the slice
    before it, so every frame is whole inside one slice.
    """
    keys, order = list(keys), [roles.time, roles.row_id]
    clock = D.micro_number(F.col(roles.time)).alias(_CLOCK)
    rows = narrow(df, keys, roles).where(F.col(roles.time).isNotNull())
    counted = (
        previous_value(rows, keys, order, F.col(VALUE), "_shifted")
        .groupBy(*keys, clock, F.col("_shifted").alias(VALUE))
        .agg(F.count(F.lit(1)).alias(WEIGHT))
    )
    span = long_days * _DAY
    home = F.floor(F.col(_CLOCK) / F.lit(span))
    sliced = counted.select(
        "*", home.alias("_home"), F.explode(F.array(home, home + 1)).alias("_slice")
    ).withColumn("_owned", F.col("_slice") == F.col("_home"))
    segment = [*keys, "_slice"]
    table = time_frames(
        sliced.drop("_home").repartition(*segment).sortWithinPartitions(*segment, _CLOCK),
        segment,
        _CLOCK,
        [*keys, _CLOCK, "_owned"],
        [(-short_days * _DAY, 0), (-span, 0)],
        "left",
        stats,
        weighted=True,
    ).where("_owned")
    name = f"{group_name(keys)}_trend_{short_days}D_vs_{long_days}D"
    ratios = table.select(
        *keys,
        _CLOCK,
        *[
            ratio_or_one(F.col(STATS)[i], F.col(STATS)[len(stats) + i]).alias(f"{name}_{s}")
            for i, s in enumerate(stats)
        ],
    )
    times = narrow(df, keys, roles).select(roles.row_id, *keys, clock)
    return spread_join(times, ratios, [*keys, _CLOCK]).drop(*keys, _CLOCK)


def trend_features(df: DataFrame, keys: list[str], roles: Roles = Roles(), **options) -> DataFrame:
    return attach(df, trend_stats(df, keys, roles=roles, **options), roles)


def all_trend_features(
    df: DataFrame, keys: list[str], roles: Roles = Roles(), pairs=TREND_DAYS, **options
) -> DataFrame:
    """The rows with the trends of every pair of windows, joined by row id one pair at a time."""
    out = df
    for short, long in pairs:
        stats = trend_stats(df, keys, short, long, roles=roles, **options)
        out = attach(out, stats, roles)
    return out
