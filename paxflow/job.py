"""The whole batch: read, prepare, train or load, predict, total by hour, write."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from paxflow.config import Roles
from paxflow.operators.features import add_features, single_precision
from paxflow.operators.holidays import join_holidays
from paxflow.operators.hourly import hourly_totals
from paxflow.operators.metrics import merge_predictions
from paxflow.operators.model import Boosting, fit_or_load, predict
from paxflow.operators.split import Limits, split_sets, target_sets
from paxflow.plans.stage import staged
from paxflow.sources import store
from paxflow.sources.tables import write_csv, write_dated


@dataclass(frozen=True)
class RunConfig:
    """``run_date`` is the first day to predict, so that a run can be repeated.

    With ``flags`` (see ``operators.holidays.holiday_flags``) and the ``home`` airport, movements carry
    holiday flags. With ``newest``, columns that order the versions of a movement, only the newest of
    each ``row_id`` is kept. ``sources`` and ``source_schema`` describe the files that ``ingest`` reads:
    stored data sets are made anew when these change.
    """

    run_date: date
    data_dir: str
    model_dir: str
    output_dir: str
    predict_days: int = 2
    val_days: int = 7
    force_train: bool = False
    boosting: Boosting = field(default_factory=Boosting)
    roles: Roles = field(default_factory=Roles)
    flags: DataFrame | None = None
    home: str | None = None
    newest: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    source_schema: StructType | None = None


def unique_rows(df: DataFrame, key: str, newest: list[str]) -> DataFrame:
    """One row per ``key``: the one with the largest ``newest`` columns, compared in that order, a
    missing value being the smallest; among equals the one with the largest hash of all its cells.

    One aggregation: the largest row of each key is found before the shuffle, so a key with very many
    versions sends one a task.
    """
    cells = [F.col(f"`{c}`") for c in df.columns]
    place: list[Column] = [F.col(f"`{c}`") for c in newest]
    order = F.struct(*place, F.xxhash64(*cells).alias("_tie"))
    best = df.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max_by(F.struct(*cells), order).alias("_row"))
    return best.select("_row.*")


def preprocess(
    movements: DataFrame,
    roles: Roles = Roles(),
    flags: DataFrame | None = None,
    home: str | None = None,
    newest: list[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """One data set per target; all features for the first, raw columns for the second.

    Unique rows, flagged rows and raw rows are staged before the features, which read them once per
    family.
    """
    if newest:
        movements = unique_rows(movements, roles.row_id, list(newest))
    if flags is not None:
        movements = join_holidays(movements, flags, home, roles)
    if newest or flags is not None:
        movements = staged(movements, "movements")
    passengers, reduced = target_sets(movements, roles)
    return add_features(passengers, roles), reduced


def load_or_prepare(
    spark: SparkSession,
    data_dir: str,
    ingest: Callable[[], DataFrame],
    roles: Roles = Roles(),
    flags: DataFrame | None = None,
    home: str | None = None,
    newest: list[str] = (),
    sources: list[str] | None = None,
    schema: StructType | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The two stored data sets, prepared from the stored or freshly ingested movements where they are
    missing or what they were made from has changed."""
    raw = store.reuse(spark, f"{data_dir}/movements", ingest, sources, schema)

    def prepared(which: int) -> DataFrame:
        movements = store.read_version(spark, raw)
        if not which:
            return single_precision(preprocess(movements, roles, flags, home, newest)[0])
        # The second set needs no features.
        if newest:
            movements = unique_rows(movements, roles.row_id, list(newest))
        if flags is not None:
            movements = join_holidays(movements, flags, home, roles)
        return target_sets(movements, roles)[1]

    settings = f"newest {list(newest)}, home {home}, flags {flags.schema.json() if flags is not None else None}"
    return tuple(
        store.read_version(
            spark,
            store.reuse(
                spark,
                f"{data_dir}/{name}",
                lambda which=which: prepared(which),
                [raw.folder],
                settings=settings,
            ),
        )
        for which, name in enumerate(("passengers", "reduced"))
    )


def run(
    spark: SparkSession, config: RunConfig, ingest: Callable[[], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Writes and returns the hourly and the flight predictions of the coming days.

    Each is one table, ``hourly_predictions`` and ``flight_predictions``, with a partition per run
    date that a rerun replaces; the day's rows are also written as CSV under the day's name. Rows are
    counted by the writes themselves.
    """
    roles = config.roles
    limits = Limits.for_run(config.run_date, config.predict_days, config.val_days)
    passengers, reduced = load_or_prepare(
        spark,
        config.data_dir,
        ingest,
        roles,
        config.flags,
        config.home,
        list(config.newest),
        list(config.sources) or None,
        config.source_schema,
    )

    outputs = []
    for name, table, target in (
        ("passengers", passengers, roles.target),
        ("reduced", reduced, roles.reduced_target),
    ):
        train, valid, test = split_sets(table, limits, roles)
        model = fit_or_load(
            f"{config.model_dir}/{name}",
            train,
            valid,
            target,
            config.force_train,
            config.boosting,
            roles,
        )
        scored = predict(model, test, f"Pred{target}")
        rows = Observation()
        scored = scored.select(roles.row_id, roles.flight, roles.time, f"Pred{target}")
        outputs.append(staged(scored.observe(rows, F.count(F.lit(1)).alias("n")), f"scored-{name}"))
        if not rows.get["n"]:
            warnings.warn(f"no flights for {target} from {limits.valid} to {limits.test}")

    targets = [f"Pred{roles.target}", f"Pred{roles.reduced_target}"]
    stamp = config.run_date.isoformat()

    def written(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
        rows, path = Observation(), f"{config.output_dir}/{name}"
        chosen = df.select(*columns)
        write_dated(chosen.observe(rows, F.count(F.lit(1)).alias("n")), path, config.run_date)
        back = spark.read.schema(f"{_ddl(chosen)}, run_date DATE").parquet(path)
        day = F.col("run_date") == F.lit(config.run_date)
        # A day without rows replaces no partition: what an earlier run left there is not its result.
        back = back.where(day if rows.get["n"] else F.lit(False)).drop("run_date").orderBy(roles.time)
        write_csv(back, f"{path}_{stamp}")
        return back

    merged = merge_predictions(*outputs, roles)
    flights = written(merged, "flight_predictions", [roles.flight, roles.time, *targets])
    hourly = hourly_totals(flights, targets, roles=roles)
    return written(hourly, "hourly_predictions", [roles.time, *targets]), flights


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
