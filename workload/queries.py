"""One query per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from paxflow.config import MOVEMENT_COLUMNS, ROLLING_ROWS
from paxflow.functions import dates as D
from paxflow.functions import text as X
from paxflow.operators import calendar, features, holidays, hourly, lags, metrics, rolling
from paxflow.operators import model as M
from paxflow.operators import split, staffing, trend
from paxflow.job import unique_rows
from paxflow.plans.stage import staging_path
from paxflow.sources import store, tables
from paxflow.sources.holidays import foreign_periods, read_zone_lookup, write_zone_lookup, zone_pages
from workload import views as V
from workload.views import ROLES, rounded

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

LIMITS = split.Limits("1999-01-01", "2000-07-01", "2001-08-02")
INCLUSIVE = split.Limits("1999-01-01", "2000-07-01", "2001-08-01", inclusive_end=True)
DAYS = {"month": "1 month", "1week": "7 days"}
EVENT_WINDOWS = {"lag7_win6": (7, 6), "lag1_win2": (1, 2)}
BOOSTING = M.Boosting(rounds=10, depth=5)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- calendar ---


@query
def date_features(spark, sf_dir):
    return rounded(calendar.date_features(V.events(spark, sf_dir).select("id", "ts"), ROLES))


@query
def date_chunks(spark, sf_dir):
    rows = V.orders(spark, sf_dir).select("flight", F.to_date("ts").alias("day"))
    return calendar.date_chunks(rows, ["flight"], "day")


# --- lags ---


@query
def lag_raw_global(spark, sf_dir):
    return rounded(lags.lag_stats(V.orders(spark, sf_dir), [], roles=ROLES))


@query
def lag_raw_by_terminal(spark, sf_dir):
    return rounded(lags.lag_stats(V.orders(spark, sf_dir), ["terminal"], roles=ROLES))


@query
def lag_raw_by_minute(spark, sf_dir):
    return rounded(lags.lag_stats(V.events(spark, sf_dir), [], {"1week": "7 days"}, ROLES))


@query
def lagged_rolling_global(spark, sf_dir):
    return rounded(lags.lagged_window_stats(V.orders(spark, sf_dir), [], roles=ROLES))


@query
def lagged_rolling_by_terminal(spark, sf_dir):
    return rounded(lags.lagged_window_stats(V.orders(spark, sf_dir), ["terminal"], roles=ROLES))


@query
def lagged_rolling_by_minute(spark, sf_dir):
    return rounded(
        lags.lagged_window_stats(V.events(spark, sf_dir), ["terminal"], EVENT_WINDOWS, roles=ROLES)
    )


# --- rolling, trend, momentum, interactions ---


@query
def rolling_global(spark, sf_dir):
    return rounded(rolling.rolling_stats(V.events(spark, sf_dir), [], roles=ROLES))


@query
def rolling_by_terminal(spark, sf_dir):
    return rounded(
        rolling.rolling_stats(V.orders(spark, sf_dir), ["terminal"], roles=ROLES)
    )


@query
def rolling_spike(spark, sf_dir):
    """Frames near a value of a thousand millions: those without it must show no trace of it."""
    rows = V.orders(spark, sf_dir)
    spike = F.when(F.col("id") % 997 == 0, 1_000_000_000).otherwise(F.col("pax"))
    found = rolling.rolling_stats(rows.withColumn("pax", spike), ["terminal"], roles=ROLES)
    name = "terminal_rolling_{}_{}"
    cells = [
        F.when(F.col(name.format(w, "max")) < 1_000_000, F.col(name.format(w, s))).alias(name.format(w, s))
        for w in ROLLING_ROWS
        for s in ("mean", "std")
    ]
    return rounded(found.select("id", *cells))


@query
def rolling_by_flight(spark, sf_dir):
    return rounded(rolling.rolling_stats(V.events(spark, sf_dir), ["flight"], roles=ROLES))


@query
def shift_by_terminal(spark, sf_dir):
    rows = V.events(spark, sf_dir).select("id", "ts", "terminal", "pax")
    return rolling.shift_one(rows, ["terminal"], "pax_before", ROLES)


@query
def trend_by_terminal(spark, sf_dir):
    return rounded(trend.trend_stats(V.events(spark, sf_dir), ["terminal"], 2, 7, roles=ROLES))


@query
def trend_global(spark, sf_dir):
    return rounded(
        trend.trend_stats(V.orders(spark, sf_dir), [], 7, 30, roles=ROLES)
    )


@query
def momentum_by_terminal(spark, sf_dir):
    rows = V.orders(spark, sf_dir)
    means = rolling.rolling_stats(rows, ["terminal"], stats=("mean",), roles=ROLES)
    return rounded(
        rolling.momentum_features(means, ["terminal"]).drop(
            *[c for c in means.columns if c != "id"]
        )
    )


@query
def interactions(spark, sf_dir):
    items = V.table(spark, sf_dir, "lineitem")
    parts = V.table(spark, sf_dir, "part")
    rows = items.join(parts, items.l_partkey == parts.p_partkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").alias("seats"),
        F.col("p_retailprice").alias("price_mean"),
        F.col("p_size").alias("size_mean"),
        F.col("l_tax").alias("tax_max"),
    )
    return rounded(features.interaction_features(rows, "seats"))


@query
def feature_set(spark, sf_dir):
    return rounded(features.add_features(V.orders(spark, sf_dir), ROLES))


# --- hourly totals and sums ---


@query
def hourly_filled(spark, sf_dir):
    return hourly.hourly_totals(V.events(spark, sf_dir), ["pax", "reduced"], roles=ROLES)


@query
def hourly_filled_by_flight(spark, sf_dir):
    return hourly.hourly_totals(V.events(spark, sf_dir), ["pax"], ["flight"], ROLES)


@query
def hourly_of_day(spark, sf_dir):
    rows = hourly.hour_of_day(V.events(spark, sf_dir), ROLES)
    return rows.groupBy("Heure").agg(F.sum("pax").alias("pax"), F.sum("reduced").alias("reduced"))


@query
def by_dims_grouping_sets(spark, sf_dir):
    rows = hourly.hour_of_day(V.events(spark, sf_dir), ROLES)
    return hourly.totals_by(
        rows,
        ["pax", "reduced"],
        [["Heure"], ["Heure", "terminal"], ["direction"], ["Heure", "terminal", "direction"]],
    )


# --- forecasts against actuals ---


def _predicted(spark, sf_dir) -> DataFrame:
    rows = V.predictions(spark, sf_dir)
    rows = metrics.rounded_predictions(rows, "raw_pax", "pred_pax")
    return metrics.rounded_predictions(rows, "raw_reduced", "pred_reduced")


def _compared(spark, sf_dir) -> DataFrame:
    predicted = _predicted(spark, sf_dir).select("flight", "ts", "pred_pax", "pred_reduced")
    return metrics.forecast_join(V.events(spark, sf_dir), predicted, ROLES)


@query
def merge_predictions(spark, sf_dir):
    rows = _predicted(spark, sf_dir)
    passengers = rows.select("flight", "ts", "pred_pax")
    # The second model knows other names for some flights and no name for others.
    other = F.when(F.col("flight").endswith("7"), F.concat(F.lit("X"), "flight"))
    named = other.when(~F.col("flight").endswith("3"), F.col("flight"))
    reduced = rows.select(named.alias("flight"), "ts", "pred_reduced")
    return metrics.merge_predictions(passengers, reduced, ROLES)


@query
def forecast_join(spark, sf_dir):
    rows = _predicted(spark, sf_dir)
    # Orders of other years are forecast too: their flights and times meet no actual.
    others = V.orders(spark, sf_dir).select("flight", "ts", F.col("pax").alias("pred_pax"))
    late = F.when(F.col("flight").endswith("5"), F.col("ts") + F.expr("INTERVAL '1' SECOND"))
    predicted = rows.select("flight", F.coalesce(late, "ts").alias("ts"), "pred_pax").unionByName(others)
    return metrics.forecast_join(V.events(spark, sf_dir), predicted, ROLES, how="left")


@query
def forecast_join_day(spark, sf_dir):
    predicted = _predicted(spark, sf_dir).select("flight", "ts", "pred_pax")
    return metrics.forecast_join(V.events(spark, sf_dir), predicted, ROLES, day="2024-01-15")


@query
def metrics_global(spark, sf_dir):
    return rounded(metrics.error_metrics(_compared(spark, sf_dir), "pax", "pred_pax"))


@query
def metrics_by_terminal(spark, sf_dir):
    return rounded(metrics.error_metrics(_compared(spark, sf_dir), "pax", "pred_pax", ["terminal"]))


@query
def metrics_levels(spark, sf_dir):
    return rounded(metrics.total_metrics(_compared(spark, sf_dir), "pax", "pred_pax", ROLES))


@query
def metrics_daily(spark, sf_dir):
    rows = _compared(spark, sf_dir)
    return rounded(metrics.all_metrics(rows, "reduced", "pred_reduced", ROLES)["Daily"])


@query
def metrics_hourly(spark, sf_dir):
    rows = _compared(spark, sf_dir)
    return rounded(metrics.all_metrics(rows, "reduced", "pred_reduced", ROLES)["Hourly"])


@query
def metrics_preview(spark, sf_dir):
    tables = metrics.all_metrics(_compared(spark, sf_dir), "pax", "pred_pax", ROLES)
    return rounded(metrics.first_rows(tables["Hourly"], ["Heure"], 5))


@query
def top_errors(spark, sf_dir):
    rows = _predicted(spark, sf_dir).select("flight", "ts", "pred_pax")
    joined = metrics.forecast_join(V.events(spark, sf_dir), rows, ROLES)
    return metrics.top_errors(
        joined, "pax", "pred_pax", ["id", "flight", "ts", "pax", "pred_pax"], 10, ROLES
    )


@query
def assigned_terminals(spark, sf_dir):
    return metrics.assigned_terminals(V.events(spark, sf_dir), "error", ROLES)


# --- staffing ---


def _plan(spark, sf_dir, keys=()) -> DataFrame:
    days = staffing.daily_hours(V.events(spark, sf_dir), "pax", keys, ROLES)
    return staffing.staffing_plan(days, keys)


@query
def staffing_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@query
def staffing_plan_by_terminal(spark, sf_dir):
    return _plan(spark, sf_dir, ["terminal"])


@query
def staffing_totals(spark, sf_dir):
    return rounded(staffing.staffing_totals(_plan(spark, sf_dir)))


@query
def staffing_report(spark, sf_dir):
    return staffing.staffing_report(_plan(spark, sf_dir))


# --- holidays ---


@query
def departure_airport(spark, sf_dir):
    rows = V.nation_orders(spark, sf_dir).select("id", "direction", "previous")
    return holidays.with_departure(rows, "NN0", roles=ROLES)


@query
def airport_resolution(spark, sf_dir):
    rows = V.nation_orders(spark, sf_dir).select("id", "previous")
    return holidays.resolve_airports(rows, V.airports(spark, sf_dir), "previous")


@query
def unresolved_airports(spark, sf_dir):
    return holidays.unresolved_codes(
        V.nation_orders(spark, sf_dir), V.airports(spark, sf_dir), "previous"
    )


@query
def public_holidays(spark, sf_dir):
    rows = V.nation_orders(spark, sf_dir).select("id", "day", "country")
    return holidays.with_public_holidays(rows, V.nation_holidays(spark, sf_dir, False))


@query
def school_days_interval(spark, sf_dir):
    rows = V.orders(spark, sf_dir).select("id", "terminal", F.to_date("ts").alias("day"))
    periods = V.order_periods(spark, sf_dir, "terminal")
    return holidays.with_school_holidays(rows, periods, "terminal")


@query
def school_days_abroad(spark, sf_dir):
    rows = V.nation_orders(spark, sf_dir).select("id", "day", "country")
    return holidays.school_flags_abroad(rows, V.order_periods(spark, sf_dir, "country"))


@query
def school_days_france(spark, sf_dir):
    rows = V.nation_orders(spark, sf_dir).select("id", "day", "previous")
    placed = holidays.resolve_airports(rows, V.airports(spark, sf_dir), "previous")
    french, _ = holidays.country_split(placed)
    return holidays.school_flags_france(french, _zone_periods(spark, sf_dir), _zones(spark))


def _zone_periods(spark, sf_dir) -> DataFrame:
    return V.order_periods(spark, sf_dir, "zone").withColumn(
        "zone", F.when(F.col("zone") < "3", "Zone A").otherwise("Zone B")
    )


def _zones(spark) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES ('Rennes', 'Zone_B'), ('Lyon', 'Zone A'), ('Guadeloupe', 'Guadeloupe')"
        " AS t(target, zone)"
    )


ZONES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query
def calendar_wide(spark, sf_dir):
    periods = V.order_periods(spark, sf_dir, "zone")
    return holidays.calendar_wide(spark, periods, ZONES, "1995-01-01", "2001-12-31")


@query
def calendar_long(spark, sf_dir):
    return holidays.calendar_long(calendar_wide(spark, sf_dir))


@query
def zone_periods(spark, sf_dir):
    return holidays.zone_periods(
        V.school_records(spark, sf_dir),
        ["Zone A", "Zone B", "Zone C", "1-URGENT"],
        "1996-01-01",
        "1999-12-31",
    )


@query
def zone_lookup(spark, sf_dir):
    return holidays.zone_lookup(V.school_records(spark, sf_dir))


@query
def foreign_payloads(spark, sf_dir):
    rows = V.school_records(spark, sf_dir)
    one = F.concat(
        F.lit('{"startDate":"'), "start_date", F.lit('","endDate":"'), "end_date", F.lit('"}')
    )
    half = F.concat(F.lit('{"startDate":"'), "start_date", F.lit('"}'))
    payloads = rows.select(
        F.col("location").alias("country"),
        F.when(
            F.col("description").startswith("Vacances"),
            F.concat(F.lit("["), one, F.lit(","), half, F.lit(',"none"]')),
        )
        .otherwise(F.concat(F.lit('{"holidays":['), one, F.lit("]}")))
        .alias("value"),
    )
    return foreign_periods(payloads)


@query
def city_clean(spark, sf_dir):
    rows = V.cities(spark, sf_dir)
    return rows.withColumn("clean", X.city_name(F.col("city")))


@query
def city_zone(spark, sf_dir):
    lookup = spark.sql(
        "SELECT * FROM VALUES ('Rennes', 'Zone B'), ('Poitiers', 'Zone A'), ('Lyon', 'Zone A'),"
        " ('Large', 'Zone C') AS t(target, zone)"
    )
    return holidays.with_school_zone(V.cities(spark, sf_dir), lookup)


@query
def country_split_union(spark, sf_dir):
    rows = V.nation_orders(spark, sf_dir).join(
        V.airports(spark, sf_dir).select(F.col("iata").alias("previous"), F.col("country").alias("place")),
        "previous",
        "left",
    )
    return holidays.with_country_branch(rows, "place").select("id", "place", "branch", "direction")


@query
def holiday_flags(spark, sf_dir):
    movements = V.nation_orders(spark, sf_dir).select("id", "ts", "direction", "previous")
    flags = holidays.holiday_flags(
        movements,
        V.airports(spark, sf_dir),
        V.nation_holidays(spark, sf_dir, True),
        _zone_periods(spark, sf_dir),
        V.order_periods(spark, sf_dir, "country"),
        _zones(spark),
        "NN0",
        ROLES,
    )
    return holidays.join_holidays(movements, flags, "NN0", ROLES)


# --- sets and models ---


@query
def split_summary(spark, sf_dir):
    return split.split_summary(V.orders(spark, sf_dir), LIMITS, ROLES)


@query
def split_rows(spark, sf_dir):
    rows = V.orders(spark, sf_dir).select("id", "ts")
    return split.with_split(rows, INCLUSIVE, ROLES)


def _fitted(orders: DataFrame):
    rows = calendar.date_features(orders, ROLES)
    train, valid, test = split.split_sets(rows, LIMITS, ROLES)
    return M.fit(train, valid, "pax", BOOSTING, ROLES), test


@query
def target_means(spark, sf_dir):
    rows = V.orders(spark, sf_dir)
    return rounded(M.target_means(rows, ["terminal", "flight", "direction"], "pax"))


def _regular(spark, sf_dir) -> DataFrame:
    """Orders whose passengers follow the seats, the priority and the month but for a small rest."""
    digit = F.substring("terminal", 1, 1).cast("int")
    uneven = F.element_at(F.array(*map(F.lit, (120, 0, 80, 20, 60))), digit)
    pax = F.col("seats") + uneven + 5 * F.month("ts") + F.col("pax") % 7
    return V.orders(spark, sf_dir).withColumn("pax", pax.cast("int"))


_models: dict[tuple[str, str, Query], tuple] = {}


def _trained(spark, sf_dir, view: Query = V.orders):
    """The model of a session, folder and view, trained once for the queries that show it."""
    key = (spark.sparkContext.applicationId, sf_dir, view)
    if key not in _models:
        _models[key] = _fitted(view(spark, sf_dir))
    return _models[key]


@query
def gbt_forecast(spark, sf_dir):
    """Every row of the test set: its forecast is a whole number and not negative."""
    model, test = _trained(spark, sf_dir)
    found = M.predict(model, test, "pred_pax")
    valid = (F.col("pred_pax") >= 0) & (F.col("pred_pax") == F.floor("pred_pax"))
    return found.select("id", "ts", "pax", valid.alias("valid"))


@query
def gbt_predictions(spark, sf_dir):
    """The forecasts themselves."""
    model, test = _trained(spark, sf_dir)
    return M.predict(model, test, "pred_pax").select("id", "ts", "pax", "pred_pax")


@query
def forecast_quality(spark, sf_dir):
    """The test rows, the error of the training mean, and whether the forecast's error is less
    than half of it."""
    model, test = _trained(spark, sf_dir, _regular)
    mean = split.split_sets(_regular(spark, sf_dir), LIMITS, ROLES)[0].agg(F.avg("pax")).first()[0]
    found = M.predict(model, test, "pred_pax")
    plain, own = F.avg(F.abs(F.col("pax") - F.lit(mean))), F.avg(F.abs(F.col("pax") - F.col("pred_pax")))
    spread = F.count_distinct("pred_pax") > 1
    return rounded(
        found.agg(
            F.count("*").alias("rows"),
            F.sum("pax").alias("pax"),
            plain.alias("mae_of_mean"),
            (own < 0.5 * plain).alias("forecast_is_better"),
            spread.alias("forecasts_differ"),
        )
    )


@query
def feature_importance(spark, sf_dir):
    """A row per input of the model: its importance is a share, and all of them sum up to one."""
    model, _ = _trained(spark, sf_dir)
    found = M.feature_importance(model)
    share = F.col("importance").between(0, 1)
    whole = F.abs(F.sum("importance").over(Window.partitionBy()) - 1) < 1e-9
    return found.select("feature", share.alias("is_share"), whole.alias("sums_to_one"))


@query
def top_features(spark, sf_dir):
    """The twenty most important inputs."""
    return M.top_features(_trained(spark, sf_dir, _regular)[0])


@query
def learning_curve(spark, sf_dir):
    """The validation error of each round, and the round that the patience rule chooses."""
    return M.stopping(_trained(spark, sf_dir, _regular)[0].errors, BOOSTING.patience)


@query
def stopping_rule(spark, sf_dir):
    """The patience rule over many curves: the error of each day as a round, per terminal."""
    days = _compared(spark, sf_dir).groupBy("terminal", F.to_date("ts").alias("day"))
    errors = days.agg(F.sum(F.abs(F.col("pax") - F.col("pred_pax"))).alias("error"))
    order = Window.partitionBy("terminal").orderBy("day")
    errors = errors.withColumn("round", F.row_number().over(order)).drop("day")
    return M.stopping(errors, 3, ["terminal"], "error")


@query
def category_index(spark, sf_dir):
    rows = V.orders(spark, sf_dir)
    return M.category_index(M.category_counts(rows, ["terminal", "flight", "direction"]), 64)


# --- reports, sources and stores ---


@query
def forecast_report_sums(spark, sf_dir):
    """Errors of both targets at every level of the report, from one aggregation."""
    rows = _predicted(spark, sf_dir)
    names = {"pred_pax": "Predpax", "pred_reduced": "Predreduced"}
    predicted = rows.select("flight", "ts", *[F.col(c).alias(n) for c, n in names.items()])
    return rounded(metrics.forecast_report(predicted, V.events(spark, sf_dir), None, ROLES)["errors"])


def _french_pages(spark, sf_dir):
    """The school records as a service's pages; one zone lacks entries, one has a cut page."""
    rows = V.school_records(spark, sf_dir)
    cells = ["description", "start_date", "end_date", "annee_scolaire", "population", "zones", "location"]
    page = F.floor(F.col("population").cast("long") / 400)
    pages = rows.groupBy(F.col("location").alias("zone"), page.alias("number")).agg(
        F.collect_list(F.struct(*cells)).alias("results")
    )
    more = F.when(F.col("zone") == "5-LOW", 7).otherwise(0)
    totals = rows.groupBy(F.col("location").alias("zone")).agg(F.count("*").alias("n"))
    whole = F.to_json(F.struct((F.col("n") + more).alias("total_count"), "results"))
    cut = (F.col("zone") == "2-HIGH") & (F.col("number") == 0)
    text = F.when(cut, F.substring(whole, 1, 60)).otherwise(whole)
    payloads = pages.join(totals, "zone").select("zone", text.alias("value"))
    return zone_pages(payloads)


@query
def french_payloads(spark, sf_dir):
    """What was read of each zone against what the service states."""
    return _french_pages(spark, sf_dir)[1]


@query
def french_records(spark, sf_dir):
    return _french_pages(spark, sf_dir)[0]


@query
def csv_round_trip(spark, sf_dir):
    """Orders as CSV lines, some of them broken, as good and bad rows of one read."""
    rows = V.orders(spark, sf_dir)
    kind = F.col("id") % 10
    pax = F.when(kind == 3, F.concat(F.lit("x"), F.col("pax").cast("string"))).otherwise(
        F.col("pax").cast("string")
    )
    cells = [F.col("id").cast("string"), F.date_format("ts", "yyyy-MM-dd"), F.col("terminal"), pax]
    line = F.concat_ws(",", *cells)
    short = F.concat_ws(",", *cells[:2])
    line = F.when(kind == 7, short).when(kind == 9, F.concat(line, F.lit(",more"))).otherwise(line)
    path = staging_path(spark, "csv")
    rows.select(line.alias("value")).write.text(path)
    schema = "id LONG, day DATE, terminal STRING, pax INT"
    good, bad = tables.read_csv_checked(spark, path, schema, header="false")
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(
        bad.select("line"), allowMissingColumns=True
    )


@query
def dated_outputs(spark, sf_dir):
    """Two days are written, then the first again with other figures; the table read back."""
    path = staging_path(spark, "dated")
    by_terminal = V.events(spark, sf_dir).groupBy("terminal")
    first, second, again = (
        by_terminal.agg(F.sum(c).alias("total"))
        for c in (F.col("pax"), F.col("reduced"), F.col("pax") + F.col("reduced"))
    )
    for rows, day in ((first, 15), (second, 16), (again, 15)):
        tables.write_dated(rows, path, datetime.date(2024, 1, day))
    return spark.read.schema("terminal STRING, total LONG, run_date DATE").parquet(path)


@query
def preprocessed_rows(spark, sf_dir):
    """Movements with older and newer versions of some, as the two data sets see them."""
    rows = V.orders(spark, sf_dir).withColumn("version", F.lit(1))
    older = rows.where("id % 3 = 0").withColumns({"version": F.lit(0), "pax": F.col("pax") - 1})
    newer = rows.where("id % 5 = 0").withColumns({"version": F.lit(2), "pax": F.col("pax") + 1})
    unversioned = rows.where("id % 7 = 0").withColumns({"version": F.lit(None), "pax": F.lit(-1)})
    both = rows.unionByName(older).unionByName(newer).unionByName(unversioned)
    both = unique_rows(both.withColumn("reduced", F.col("pax") % 3), "id", ["version"])
    passengers, reduced = split.target_sets(both, ROLES)
    columns = ["id", "ts", "terminal", "version"]
    return passengers.select(*columns, F.lit("pax").alias("set"), F.col("pax").alias("value")).unionByName(
        reduced.select(*columns, F.lit("reduced").alias("set"), F.col("reduced").alias("value"))
    )


@query
def reused_store(spark, sf_dir):
    """A stored table: made, used again, and made anew when its source has one more file."""
    source, path = staging_path(spark, "source"), staging_path(spark, "store")
    rows = V.orders(spark, sf_dir)
    out = None
    for step, files in enumerate((rows, None, rows.where("id % 2 = 0"), None), 1):
        if files is not None:
            files.write.mode("append").parquet(source)
        build = lambda: spark.read.parquet(source).groupBy("terminal").agg(F.count("*").alias("rows"))
        version = store.reuse(spark, path, build, [source], rows.schema)
        found = store.read_version(spark, version).select(
            F.lit(step).alias("step"), F.lit(version.number).cast("long").alias("version"), "terminal", "rows"
        )
        out = found if out is None else out.unionByName(found)
    return out


@query
def zone_lookup_file(spark, sf_dir):
    """The lookup of zones, saved as one JSON object and read back."""
    path = staging_path(spark, "lookup")
    write_zone_lookup(holidays.zone_lookup(V.school_records(spark, sf_dir)), path)
    return read_zone_lookup(spark, path)


@query
def report_files(spark, sf_dir):
    """Every day's report as a file of lines, read back."""
    path = staging_path(spark, "reports")
    tables.write_report(staffing.staffing_report(_plan(spark, sf_dir)), path)
    return spark.read.schema("value STRING, day DATE").text(path).select("day", F.col("value").alias("line"))


@query
def movement_source(spark, sf_dir):
    """Movements of a stored table with more columns than asked for, newest first."""
    path = staging_path(spark, "movements")
    rows = V.orders(spark, sf_dir).select(
        F.col("id").alias("IdMovement"),
        F.col("ts").alias("LTScheduledDatetime"),
        F.col("pax").alias("NbPaxTotal"),
        F.col("terminal").alias("SysTerminal"),
        F.lit("x").alias("unwanted"),
    )
    missing = [c for c in MOVEMENT_COLUMNS if c not in rows.columns]
    tables.write_parquet(rows.withColumns({c: F.lit(None).cast("string") for c in missing}), path)
    found = tables.read_movements(spark, path, newest_first=True)
    return found.select("IdMovement", "LTScheduledDatetime", "NbPaxTotal", "SysTerminal", "ServiceCode")


@query
def run_limits(spark, sf_dir):
    """The sets of a run on a given day."""
    limits = split.Limits.for_run(datetime.date(2000, 7, 1), predict_days=30, val_days=365)
    return split.split_summary(V.orders(spark, sf_dir), limits, ROLES)


@query
def text_times(spark, sf_dir):
    """Times as text: without a zone, with several zones, as a day only, and unreadable."""
    rows = V.orders(spark, sf_dir)
    day, kind = F.date_format("ts", "yyyy-MM-dd"), F.col("id") % 5
    text = (
        F.when(kind == 0, F.concat(day, F.lit(" 10:30:00")))
        .when(kind == 1, F.concat(day, F.lit("T10:30:00+02:00")))
        .when(kind == 2, F.concat(day, F.lit("T22:30:00-0330")))
        .when(kind == 3, day)
        .otherwise(F.concat(F.lit("on "), day))
    )
    texts = rows.select("id", text.alias("ts"))
    return texts.select("id", D.local_time(texts, "ts").alias("ts"))
