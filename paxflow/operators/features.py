"""Feature interactions and the whole feature set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType

from paxflow.config import Roles
from paxflow.operators.calendar import date_features
from paxflow.operators.lags import attach_history, history_columns
from paxflow.operators.rolling import (
    attach,
    momentum_features,
    rolling_columns,
    rolling_packed,
)


def matching_columns(df: DataFrame, pattern: str, base: str) -> list[str]:
    return [c for c in df.columns if pattern in c and c != base]


def interaction_features(
    df: DataFrame, base: str, pattern: str = "_mean", suffix: str = "x"
) -> DataFrame:
    """``INT_{base}_{suffix}_{column}``: base times every column whose name has the pattern."""
    return df.selectExpr(
        "*",
        *[
            f"CAST(`{base}` AS DOUBLE) * CAST(`{c}` AS DOUBLE) AS `INT_{base}_{suffix}_{c}`"
            for c in matching_columns(df, pattern, base)
        ],
    )


def single_precision(df: DataFrame) -> DataFrame:
    """Double columns as float: half the size where hundreds of features are stored."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)}
    return df.selectExpr(
        *[f"CAST(`{c}` AS FLOAT) AS `{c}`" if c in doubles else f"`{c}`" for c in df.columns]
    )


def add_features(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Date features, then lags, rolling, lagged windows and momentum overall and per group,
    then interactions with the seats.

    Every family is computed on narrow rows and joined once, by row id, as one array; history of few
    minutes in all is broadcast instead. The arrays become columns in the last step and date features
    are made there, so the joins carry and sort rows of few columns. ``df`` is read once per family:
    give a stored table, not a long plan.
    """
    out, groups = df, [[], *[[g] for g in roles.groups]]
    for keys in groups:
        out = attach(out, rolling_packed(df, keys, roles=roles), roles)
    out = attach_history(out, df, groups, roles)
    columns = date_features(df, roles).columns
    unpacked = [c for keys in groups for c in (*history_columns(keys), *rolling_columns(keys))]
    out = date_features(out, roles).selectExpr(*[f"`{c}`" for c in columns], *unpacked)
    for keys in groups:
        out = momentum_features(out, keys)
    return interaction_features(out, roles.seats)
