"""Row-count rolling statistics, momentum ratios and the one-row shift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paxflow.config import MOMENTUM_PAIRS, ROLLING_ROWS, STATISTICS, Roles
from paxflow.functions import dates as D
from paxflow.functions.numbers import ratio
from paxflow.plans.blocks import BLOCK, OWNED, POSITION, previous_value, row_blocks
from paxflow.plans.sliding import STATS, VALUE, row_frames


def group_name(keys: list[str]) -> str:
    return "_".join(keys) or "global"


def narrow(df: DataFrame, keys: list[str], roles: Roles) -> DataFrame:
    """Row id, time, target and the group keys as text: all that a window needs.

    A key is '=' and its text, a missing key is '': it is a group of its own and plain equality
    joins it, so the joins keep the partitioning of the aggregations before them.
    """
    return df.select(
        F.col(roles.row_id),
        D.local_time(df, roles.time).alias(roles.time),
        F.expr(f"nullif(CAST(`{roles.target}` AS DOUBLE), double('NaN'))").alias(VALUE),
        *[F.expr(f"coalesce(concat('=', CAST(`{k}` AS STRING)), '')").alias(k) for k in keys],
    )


def attach(df: DataFrame, features: DataFrame, roles: Roles) -> DataFrame:
    """Put row features next to their rows.

    Both sides have every row, so neither may be broadcast whatever the planner's estimate says.
    """
    return df.join(features.hint("merge"), roles.row_id, "left")


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of rows with a table that is unique by ``keys``.

    One key may hold very many rows. With a key that the table's aggregation did not have, both
    sides are shuffled for the join, and adaptive execution can then split such a partition.
    """
    spread = F.xxhash64(*keys).alias("_spread")
    return (
        rows.select("*", spread)
        .join(table.select("*", spread).hint("merge"), ["_spread", *keys], "left")
        .drop("_spread")
    )


def packed_name(keys: list[str], family: str) -> str:
    return f"_{group_name(keys)}_{family}"


def rolling_packed(
    df: DataFrame,
    keys: list[str],
    windows: dict[str, int] = ROLLING_ROWS,
    stats=STATISTICS,
    gap: int = 2,
    block_rows: int | None = None,
    roles: Roles = Roles(),
) -> DataFrame:
    """Row id and one array with all rolling statistics, see :func:`rolling_columns`.

    An array is copied as a whole, so a row passes through shuffles and joins at the price of one
    column instead of 25.
    """
    rows = narrow(df, keys, roles)
    order = [roles.time, roles.row_id]
    reach = max(windows.values()) + gap - 1
    blocks = row_blocks(rows, keys, order, reach, block_rows)
    sorted_rows = blocks.repartition(BLOCK).sortWithinPartitions(BLOCK, POSITION)
    segment, keep = [BLOCK, *keys], [roles.row_id, OWNED]
    framed = row_frames(sorted_rows, segment, keep, windows, gap, stats).where(OWNED)
    return framed.select(roles.row_id, F.col(STATS).alias(packed_name(keys, "rolling")))


def rolling_columns(keys: list[str], windows=ROLLING_ROWS, stats=STATISTICS) -> list[str]:
    """The packed array as columns ``{group}_rolling_{window}_{stat}``."""
    names = [f"{group_name(keys)}_rolling_{w}_{s}" for w in windows for s in stats]
    return [f"`{packed_name(keys, 'rolling')}`[{i}] AS `{n}`" for i, n in enumerate(names)]


def rolling_stats(
    df: DataFrame,
    keys: list[str],
    windows: dict[str, int] = ROLLING_ROWS,
    stats=STATISTICS,
    roles: Roles = Roles(),
    **options,
) -> DataFrame:
    """Row id and ``{group}_rolling_{window}_{stat}`` over the group's earlier rows.

    A window of n covers the rows from n+gap-1 to ``gap`` (2) before the current one, in (time, id)
    order within the group. Rows are spread in even blocks, see ``plans.blocks``.
    """
    packed = rolling_packed(df, keys, windows, stats, roles=roles, **options)
    return packed.selectExpr(roles.row_id, *rolling_columns(keys, windows, stats))


def rolling_features(df: DataFrame, keys: list[str], roles: Roles = Roles(), **options) -> DataFrame:
    return attach(df, rolling_stats(df, keys, roles=roles, **options), roles)


def momentum_features(
    df: DataFrame, keys: list[str], pairs=MOMENTUM_PAIRS
) -> DataFrame:
    """Ratios of adjacent rolling means, where both columns are there; null over zero."""
    prefix = group_name(keys)
    means = [c for c in df.columns if f"{prefix}_rolling_" in c and "_mean" in c]
    if len(means) < 2:
        return df
    ratios = []
    for short, long in pairs:
        top, bottom = f"{prefix}_rolling_{short}_mean", f"{prefix}_rolling_{long}_mean"
        if top in means and bottom in means:
            ratios.append(
                ratio(F.col(top), F.col(bottom)).alias(f"{prefix}_momentum_{short}_vs_{long}")
            )
    return df.select("*", *ratios)


def shift_one(
    df: DataFrame,
    keys: list[str],
    name: str,
    roles: Roles = Roles(),
) -> DataFrame:
    """Target of the group's row before."""
    order = [roles.time, roles.row_id]
    return previous_value(df, list(keys), order, F.col(roles.target), name)
