"""Chronological train, validation and test sets."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from paxflow.config import Roles
from paxflow.functions import dates as D


@dataclass(frozen=True)
class Limits:
    """Train ends before ``train``, validation before ``valid``, test before (or at) ``test``."""

    train: str
    valid: str
    test: str
    inclusive_end: bool = False

    @classmethod
    def for_run(cls, run_date: date, predict_days: int = 2, val_days: int = 7) -> "Limits":
        return cls(
            train=(run_date - timedelta(days=val_days)).isoformat(),
            valid=run_date.isoformat(),
            test=(run_date + timedelta(days=predict_days)).isoformat(),
        )


def _at(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def split_name(ts: Column, limits: Limits) -> Column:
    end = ts <= _at(limits.test) if limits.inclusive_end else ts < _at(limits.test)
    return (
        F.when(ts < _at(limits.train), "train")
        .when(ts < _at(limits.valid), "valid")
        .when(end, "test")
    )


def with_split(df: DataFrame, limits: Limits, roles: Roles = Roles()) -> DataFrame:
    """Adds ``split``; rows after the test set have none."""
    return df.withColumn("split", split_name(D.local_time(df, roles.time), limits))


def split_sets(
    df: DataFrame, limits: Limits, roles: Roles = Roles()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three sets as plain range filters, which reach the file scan."""
    ts = D.local_time(df, roles.time)
    end = ts <= _at(limits.test) if limits.inclusive_end else ts < _at(limits.test)
    return (
        df.where(ts < _at(limits.train)),
        df.where((ts >= _at(limits.train)) & (ts < _at(limits.valid))),
        df.where((ts >= _at(limits.valid)) & end),
    )


def split_summary(df: DataFrame, limits: Limits, roles: Roles = Roles()) -> DataFrame:
    """Rows, first and last time of each set."""
    return (
        with_split(df, limits, roles)
        .where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(roles.time).alias("first_time"),
            F.max(roles.time).alias("last_time"),
        )
    )


def target_sets(df: DataFrame, roles: Roles = Roles()) -> tuple[DataFrame, DataFrame]:
    """Two data sets over the same rows, each without the other's target."""
    return df.drop(roles.reduced_target), df.drop(roles.target)
