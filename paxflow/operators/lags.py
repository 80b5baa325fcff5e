"""Values of the past at the same minute: calendar lags and lagged centered windows.

Both are lookups by (group, minute), so the rows are first averaged to one value per group and
minute. Every lookup is done there, in slices of time: a minute is shuffled with its one value and
finds in its slice all that it looks back at. Rows with the same minute share the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paxflow.config import LAGGED_WINDOWS, LAGS, STATISTICS, Roles
from paxflow.functions import dates as D
from paxflow.operators.rolling import attach, group_name, narrow, packed_name, spread_join
from paxflow.plans.sliding import STATS, VALUE, time_history
from paxflow.plans.stage import staged

MINUTE = "_minute"
_DAY_MINUTES = 1440
#: Rows of a group's history, of some 300 bytes each, that every executor may hold.
BROADCAST_ROWS = 50_000
_UNIT_MINUTES = {"minute": 1, "hour": 60, "day": 1440, "week": 10_080, "month": 44_640, "year": 527_040}


def minute_means(df: DataFrame, keys: list[str], roles: Roles = Roles()) -> DataFrame:
    """One row per group and minute with the mean target."""
    rows = narrow(df, keys, roles)
    return (
        rows.withColumn(MINUTE, D.floor_minute(F.col(roles.time)))
        .where(F.col(MINUTE).isNotNull())
        .groupBy(*keys, MINUTE)
        .agg(F.avg(VALUE).alias(VALUE))
    )


def _most_minutes(interval: str) -> int:
    """Minutes that an interval, as Spark text, has at most."""
    words = interval.lower().split()
    return sum(abs(int(n)) * _UNIT_MINUTES[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2]))


def history_table(
    df: DataFrame,
    keys: list[str],
    lags: dict[str, str] = LAGS,
    windows: dict[str, tuple[int, int]] = LAGGED_WINDOWS,
    stats=STATISTICS,
    roles: Roles = Roles(),
) -> DataFrame:
    """One row per group (keys as text, see ``narrow``) and minute that has any history: ``_stats``, a value
    per lag and the statistics of each lagged window.

    Several days may fall on one month end when months are added; the latest of them counts. Minutes go
    to slices of time as long as the farthest lookup, each slice with those that its own minutes
    look at: most minutes to two. A task holds two such lengths of minutes of one group, however many
    rows the group has.
    """
    keys = list(keys)
    frames = [(delay * _DAY_MINUTES, -days * _DAY_MINUTES // 2, days * _DAY_MINUTES // 2) for delay, days in windows.values()]
    back = max([0, *[delay - low for delay, low, _ in frames]])
    ahead = max([0, *[high - delay for delay, _, high in frames]])
    span = max([1, back, *[_most_minutes(by) for by in lags.values()]])
    clock = D.minute_number(F.col(MINUTE))
    arrivals = {f"_lag_{n}": D.minute_number(F.expr(f"{MINUTE} + INTERVAL {by}")) for n, by in lags.items()}
    farthest = F.greatest(clock, clock + F.lit(back), *arrivals.values())
    nearest = F.least(clock, clock - F.lit(ahead), *arrivals.values())
    slices = F.sequence(F.floor(nearest / F.lit(span)), F.floor(farthest / F.lit(span)))
    segment = [*keys, "_slice"]
    sliced = minute_means(df, keys, roles).select(*keys, MINUTE, VALUE, F.explode(slices).alias("_slice"))
    # Clocks are worked out again where they are needed, not shuffled.
    sliced = sliced.repartition(*segment).withColumns({"_clock": clock, **arrivals})
    sliced = sliced.withColumn("_owned", F.col("_slice") == F.floor(F.col("_clock") / F.lit(span)))
    return time_history(
        sliced.sortWithinPartitions(*segment, "_clock"),
        segment,
        "_clock",
        [*keys, MINUTE],
        "_owned",
        list(arrivals),
        frames,
        stats,
        span,
    )


def history_columns(
    keys: list[str], lags=LAGS, windows=LAGGED_WINDOWS, stats=STATISTICS
) -> list[str]:
    """The packed array as columns."""
    prefix = group_name(keys)
    names = [f"{prefix}_lag_{n}_raw" for n in lags]
    names += [f"{prefix}_{n}_{s}" for n in windows for s in stats]
    return [f"`{packed_name(keys, 'history')}`[{i}] AS `{n}`" for i, n in enumerate(names)]


def history_packed(
    df: DataFrame,
    keys: list[str],
    roles: Roles = Roles(),
    lags=LAGS,
    windows=LAGGED_WINDOWS,
    stats=STATISTICS,
) -> DataFrame:
    """Row id and one array with all history of the row's group and minute, see
    :func:`history_columns`: what is missing of it is null, and so is the array without any."""
    table = history_table(df, keys, lags, windows, stats, roles)
    return _by_row(df, table.withColumnRenamed(STATS, packed_name(keys, "history")), keys, roles)


def _by_row(df: DataFrame, table: DataFrame, keys: list[str], roles: Roles) -> DataFrame:
    rows = narrow(df, keys, roles).select(
        roles.row_id, *keys, D.floor_minute(F.col(roles.time)).alias(MINUTE)
    )
    return spread_join(rows, table, [*keys, MINUTE]).drop(MINUTE, *keys)


def attach_history(out: DataFrame, df: DataFrame, groups: list[list[str]], roles: Roles = Roles()) -> DataFrame:
    """Put the packed history of each group next to the rows of ``out``, by the ids of ``df``.

    Of a group with few minutes in all a row gets its minute by id, and the history of that from a
    table that is broadcast by its counted rows: what rows share is not shuffled with each of them.
    """
    for keys in groups:
        name = packed_name(keys, "history")
        table = staged(history_table(df, keys, roles=roles).withColumnRenamed(STATS, name), "history")
        if table.count() > BROADCAST_ROWS:
            out = attach(out, _by_row(df, table, keys, roles), roles)
            continue
        minute = F.struct(D.floor_minute(F.col(roles.time)).alias(MINUTE), *keys).alias("_at")
        out = attach(out, narrow(df, keys, roles).select(roles.row_id, minute), roles)
        table = table.select(F.struct(MINUTE, *keys).alias("_at"), name)
        out = out.join(F.broadcast(table), "_at", "left").drop("_at")
    return out


def history_stats(df: DataFrame, keys: list[str], roles: Roles = Roles(), **options) -> DataFrame:
    """Row id, ``{group}_lag_{name}_raw`` and ``{group}_{window}_{stat}``."""
    packed = history_packed(df, keys, roles, **options)
    return packed.selectExpr(roles.row_id, *history_columns(keys, **options))


def lag_stats(df: DataFrame, keys: list[str], lags=LAGS, roles: Roles = Roles()) -> DataFrame:
    return history_stats(df, keys, roles, lags=lags, windows={})


def lag_features(df: DataFrame, keys: list[str], lags=LAGS, roles: Roles = Roles()) -> DataFrame:
    """Mean target of the group at exactly one calendar offset before the row's minute."""
    return attach(df, lag_stats(df, keys, lags, roles), roles)


def lagged_window_stats(
    df: DataFrame, keys: list[str], windows=LAGGED_WINDOWS, stats=STATISTICS, roles: Roles = Roles()
) -> DataFrame:
    return history_stats(df, keys, roles, lags={}, windows=windows, stats=stats)


def lagged_window_features(
    df: DataFrame, keys: list[str], windows=LAGGED_WINDOWS, stats=STATISTICS, roles: Roles = Roles()
) -> DataFrame:
    """Statistics of a centered window, looked up after a fixed delay."""
    return attach(df, lagged_window_stats(df, keys, windows, stats, roles), roles)
