"""Joining forecasts with actuals and measuring the error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paxflow.config import UNASSIGNED_TERMINAL, Roles
from paxflow.functions import dates as D
from paxflow.functions.numbers import ratio, whole_count
from paxflow.operators.hourly import hour_of_day, totals_by
from paxflow.plans.stage import staged


def join_on(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Equi join; with ``null_safe`` a missing key equals a missing key."""
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = F.lit(True)
    for k in keys:
        match = match & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])


def flight_keys(df: DataFrame, other: DataFrame, roles: Roles) -> list[str]:
    """The row id where both sides carry it, else flight and time."""
    if roles.row_id in df.columns and roles.row_id in other.columns:
        return [roles.row_id]
    return [roles.flight, roles.time]


def merge_predictions(
    passengers: DataFrame, reduced: DataFrame, roles: Roles = Roles(), null_safe: bool = False
) -> DataFrame:
    """The two models' predictions of each flight in one row."""
    keys = flight_keys(passengers, reduced, roles)
    shared = [c for c in reduced.columns if c in passengers.columns and c not in keys]
    return join_on(passengers, reduced.drop(*shared), keys, "inner", null_safe)


def forecast_join(
    actuals: DataFrame,
    predictions: DataFrame,
    roles: Roles = Roles(),
    how: str = "inner",
    day: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Actuals next to predictions, for one day or for all; ``how='left'`` keeps every actual."""
    if day:
        actuals = actuals.where(D.on_day(D.local_time(actuals, roles.time), day))
        predictions = predictions.where(D.on_day(D.local_time(predictions, roles.time), day))
    keys = flight_keys(actuals, predictions, roles)
    shared = [c for c in predictions.columns if c in actuals.columns and c not in keys]
    return join_on(actuals, predictions.drop(*shared), keys, how, null_safe)


def rounded_predictions(df: DataFrame, raw: str, name: str) -> DataFrame:
    return df.withColumn(name, whole_count(F.col(raw)))


def error_metrics(df: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    """Rows, totals, difference, ratio in percent, MAE, RMSE and R2, overall or by key."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    both = y.isNotNull() & p.isNotNull()
    y, p = F.when(both, y), F.when(both, p)
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        F.count(y).alias("rows"),
        F.sum(y).alias("total_actual"),
        F.sum(p).alias("total_predicted"),
        (F.sum(p) - F.sum(y)).alias("difference"),
        (ratio(F.sum(p), F.sum(y)) * 100).alias("ratio_percent"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (1 - ratio(F.sum((y - p) * (y - p)), spread)).alias("r2"),
    )


def wape(actual: Column, predicted: Column) -> Column:
    """Absolute difference of the totals over the actual total."""
    return ratio(F.abs(predicted - actual), actual)


def total_metrics(
    df: DataFrame, actual: str, predicted: str, roles: Roles = Roles()
) -> DataFrame:
    """WAPE and ratio of the totals: overall, per day and per hour of day, in one table.

    ``level`` is '' (overall), 'Jour' or 'Heure'.
    """
    ts = D.local_time(df, roles.time)
    dated = hour_of_day(df.withColumn("Jour", F.to_date(ts)), roles)
    sums = totals_by(dated, [actual, predicted], [[], ["Jour"], ["Heure"]])
    a, p = F.col(actual), F.col(predicted)
    return sums.withColumns({"WAPE": wape(a, p), "Ratio_Pred": ratio(p, a) * 100})


def all_metrics(
    df: DataFrame, actual: str, predicted: str, roles: Roles = Roles()
) -> dict[str, DataFrame]:
    """The three levels of :func:`total_metrics` as three tables, read from one staged result."""
    table = staged(total_metrics(df, actual, predicted, roles), "error-totals")
    cells = [actual, predicted, "WAPE", "Ratio_Pred"]
    return {
        "Global": table.where(F.col("level") == "").select(*cells),
        "Daily": table.where(F.col("level") == "Jour").select("Jour", *cells),
        "Hourly": table.where(F.col("level") == "Heure").select("Heure", *cells),
    }


def top_errors(
    df: DataFrame,
    actual: str,
    predicted: str,
    show: list[str],
    n: int = 10,
    roles: Roles = Roles(),
) -> DataFrame:
    """The n rows with the largest absolute error, rounded to one digit for reading."""
    error = F.abs(F.col(actual) - F.col(predicted))
    return (
        df.withColumn("Abs_Error", error)
        .orderBy(F.desc_nulls_last("Abs_Error"), roles.row_id)
        .limit(n)
        .select(
            *[F.round(c, 1).alias(c) if c == predicted else F.col(c) for c in show],
            F.round("Abs_Error", 1).alias("Abs_Error"),
        )
    )


def first_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """Preview in a stated order."""
    return df.orderBy(*order).limit(n)


def error_sums(
    df: DataFrame, pairs: list[tuple[str, str]], levels: list[list[str]], level: str = "level"
) -> DataFrame:
    """Everything errors are made of, for all pairs of actual and predicted and all levels, in one pass.

    The rows are summed once by all dimensions together, and the levels are grouping sets over that
    small table, told apart by their grouping id. A row per level and values of its dimensions; per
    pair ``sums`` has the actual's name, the plain totals, and over the rows that have both sides
    their number, totals, absolute and squared errors and the squares of the actual.
    """
    dims = list(dict.fromkeys(d for own in levels for d in own))
    cells, again = [], []
    for i, (actual, predicted) in enumerate(pairs):
        y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
        both = y.isNotNull() & p.isNotNull()
        ys, ps = F.when(both, y), F.when(both, p)
        parts = {
            "all_actual": F.sum(actual),
            "all_predicted": F.sum(predicted),
            "rows": F.count(ys),
            "actual": F.sum(ys),
            "predicted": F.sum(ps),
            "absolute": F.sum(F.abs(ys - ps)),
            "squared": F.sum((ys - ps) * (ys - ps)),
            "squares": F.sum(ys * ys),
        }
        cells += [c.alias(f"_{i}_{k}") for k, c in parts.items()]
        again.append(
            F.struct(F.lit(actual).alias("target"), *[F.sum(f"_{i}_{k}").alias(k) for k in parts])
        )
    fine = df.groupBy(*dims).agg(*cells)
    sets = [[F.col(d) for d in own] for own in levels]
    ids = F.lit("")
    for own in levels:
        number = sum((d not in own) << (len(dims) - 1 - i) for i, d in enumerate(dims))
        ids = F.when(F.grouping_id(*dims) == number, F.lit("+".join(own))).otherwise(ids)
    return fine.groupingSets(sets, *dims).agg(ids.alias(level), F.array(*again).alias("sums"))


def errors_of(sums: DataFrame, dims: list[str], level: str = "level") -> DataFrame:
    """The figures of :func:`error_metrics` and the WAPE, from :func:`error_sums`: a row per level,
    values of its dimensions and target."""
    flat = sums.select(level, *dims, F.inline("sums"))
    n = F.col("rows").cast("double")
    spread = F.col("squares") - F.col("actual") * F.col("actual") / F.when(n > 0, n)
    return flat.select(
        level,
        *dims,
        "target",
        "rows",
        F.col("actual").alias("total_actual"),
        F.col("predicted").alias("total_predicted"),
        (F.col("predicted") - F.col("actual")).alias("difference"),
        (ratio(F.col("predicted"), F.col("actual")) * 100).alias("ratio_percent"),
        wape(F.col("actual"), F.col("predicted")).alias("wape"),
        (F.col("absolute") / F.when(n > 0, n)).alias("mae"),
        F.sqrt(F.col("squared") / F.when(n > 0, n)).alias("rmse"),
        (1 - ratio(F.col("squared"), spread)).alias("r2"),
    )


def report_levels(roles: Roles = Roles()) -> list[list[str]]:
    """The levels of the forecast report: overall, and those its charts show."""
    hour = ["Heure"]
    whole = [*hour, roles.terminal, roles.direction]
    return [[], hour, [*hour, roles.terminal], [roles.direction], whole]


def forecast_report(
    predictions: DataFrame, actuals: DataFrame, day: str | None, roles: Roles = Roles()
) -> dict[str, DataFrame]:
    """Forecast against actuals of one day (None: of all): errors of both targets and the sums behind
    the charts. The join runs once: all tables but ``joined`` itself are read from its staged sums."""
    joined = hour_of_day(forecast_join(actuals, predictions, roles, day=day), roles)
    targets = [roles.target, roles.reduced_target]
    dims = ["Heure", roles.terminal, roles.direction]
    found = error_sums(joined, [(t, f"Pred{t}") for t in targets], report_levels(roles))
    found = staged(found, "report-sums")
    errors = errors_of(found.where(F.col("level") == ""), []).drop("level", "wape")
    totals = [
        column
        for i, t in enumerate(targets)
        for column in (
            F.col("sums")[i]["all_actual"].alias(t),
            F.col("sums")[i]["all_predicted"].alias(f"Pred{t}"),
        )
    ]
    return {
        "joined": joined,
        "passengers": errors.where(F.col("target") == roles.target).drop("target"),
        "reduced": errors.where(F.col("target") == roles.reduced_target).drop("target"),
        "sums": found.where(F.col("level") != "").select(*dims, "level", *totals),
        "errors": errors_of(found, dims),
    }


def assigned_terminals(
    df: DataFrame, unassigned: str = UNASSIGNED_TERMINAL, roles: Roles = Roles()
) -> DataFrame:
    """Rows with any terminal other than ``unassigned``; a missing terminal stays."""
    return df.where(~F.col(roles.terminal).eqNullSafe(F.lit(unassigned)))
