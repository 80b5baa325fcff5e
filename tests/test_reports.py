"""Hourly totals, error metrics and staff plans, with the known figures of one day."""

from __future__ import annotations

import datetime as dt

import pytest

from paxflow import config
from paxflow.config import Roles
from paxflow.functions.numbers import whole_count
from paxflow.functions.text import cell
from paxflow.operators import hourly, metrics, split, staffing
from paxflow.sources.tables import write_report
from pyspark.sql import functions as F

ROLES = Roles(time="ts", row_id="id", target="pax", flight="flight", terminal="terminal")

# --- Fixed values: known figures of 2026-04-01, passengers by hour, forecast and counted. ---
PREDICTED = [394, 152, 0, 0, 3, 179, 1174, 1175, 806, 1807, 1830, 1551, 2590, 2258, 688, 748, 1199,
             1087, 1570, 1051, 1425, 869, 674, 792]
COUNTED = [131, 174, 0, 0, 0, 185, 1228, 1184, 743, 1663, 1931, 1965, 2952, 2074, 513, 918, 1096,
           1213, 1629, 1582, 1532, 753, 620, 602]
PRESENT = [16] * 6 + [48] * 3 + [80] * 3 + [104] * 3 + [72] * 3 + [64] * 6
STARTS = {0: 16, 6: 48, 9: 32, 12: 72, 18: 64}
# --- end of fixed values ---


@pytest.fixture(scope="module")
def day(spark):
    rows = [
        (h, dt.datetime(2026, 4, 1, h, 20), p, c)
        for h, (p, c) in enumerate(zip(PREDICTED, COUNTED))
        if p or c
    ]
    return spark.createDataFrame(rows, "id INT, ts TIMESTAMP_NTZ, pred INT, pax INT")


@pytest.fixture(scope="module")
def plan(day):
    return staffing.staffing_plan(staffing.daily_hours(day, "pred", roles=ROLES)).cache()


def test_known_plan(plan):
    rows = plan.orderBy("Heure").collect()
    assert [r.Pax for r in rows] == PREDICTED
    assert [r.Staff_Starting for r in rows] == [STARTS.get(h, 0) for h in range(24)]
    assert [r.Total_Staff_Present for r in rows] == PRESENT
    assert [r.Lanes_Open for r in rows] == [p // 8 for p in PRESENT]
    assert [r.Staff_Ending for r in rows] == [STARTS.get(h - 6, 0) for h in range(24)]


def test_known_totals(plan):
    total = staffing.staffing_totals(plan).first()
    assert (total.teams, total.paid_hours, total.peak_staff) == (29.0, 1392, 104)
    assert (total.max_capacity, total.cost) == (2600, 34800.0)


def test_known_report(plan, tmp_path):
    report = staffing.staffing_report(plan)
    lines = [r.line for r in report.orderBy("line_no").collect()]
    assert len(lines) == 32
    assert lines[3] == "TIME SLOT    | LANES  | STAFF   | HR MOVEMENTS (IN/OUT)               | COST"
    assert lines[5] == "00:00-01:00  | 2      | 16      | + 16 SHIFT START                    |   400.00 $"
    assert lines[11] == "06:00-07:00  | 6      | 48      | + 48 SHIFT START | - 16 SHIFT END   | 1,200.00 $"
    assert lines[20] == "15:00-16:00  | 9      | 72      | - 32 SHIFT END                      | 1,800.00 $"
    assert lines[28] == "23:00-24:00  | 8      | 64      | ---                                 | 1,600.00 $"
    assert lines[30] == "DAILY TOTAL  | ---    | ---     | ---                                 | 34,800.00 $"
    write_report(report, str(tmp_path / "report"))
    files = list((tmp_path / "report").glob("day=2026-04-01/part-*"))
    assert len(files) == 1 and files[0].read_text().splitlines() == lines


def test_known_metrics(day):
    found = metrics.error_metrics(day, "pax", "pred").first()
    assert (found.total_actual, found.total_predicted, found.difference) == (24688, 24022, -666)
    assert round(found.ratio_percent, 6) == 97.302333


def test_metrics_guard_zero(spark):
    df = spark.createDataFrame([(0, 5), (0, 7)], "pax INT, pred INT")
    found = metrics.error_metrics(df, "pax", "pred").first()
    assert (found.ratio_percent, found.r2, found.mae) == (None, None, 6.0)


def test_levels(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 5), 10, 12), (2, dt.datetime(2024, 1, 2, 5), 0, 3)]
    df = spark.createDataFrame(rows, "id INT, ts TIMESTAMP_NTZ, pax INT, pred INT")
    tables = metrics.all_metrics(df, "pax", "pred", ROLES)
    assert tables["Global"].first().WAPE == 0.5
    daily = {r.Jour: (r.WAPE, r.Ratio_Pred) for r in tables["Daily"].collect()}
    assert daily == {dt.date(2024, 1, 1): (0.2, 120.0), dt.date(2024, 1, 2): (None, None)}
    assert [r.pred for r in tables["Hourly"].collect()] == [15]


def test_a_wide_cell_stays_whole(spark):
    rows = spark.createDataFrame([("+ 1040 SHIFT START | - 1040 SHIFT END",), ("---",), (None,)], "t STRING")
    found = [r[0] for r in rows.select(cell(F.col("t"), 35)).collect()]
    assert found == ["+ 1040 SHIFT START | - 1040 SHIFT END", "---".ljust(35), None]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.0,)], "x DOUBLE")
    assert [r[0] for r in df.select(whole_count(F.col("x"))).collect()] == [0, 2, 2, 0]


def test_hourly_gap_is_zero(spark):
    rows = [(dt.datetime(2024, 1, 1, 22, 59), 4), (dt.datetime(2024, 1, 2, 1, 0), None), (None, 7)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, pax INT")
    found = hourly.hourly_totals(df, ["pax"], roles=ROLES).orderBy("ts").collect()
    assert [(r.ts.hour, r.pax) for r in found] == [(22, 4), (23, 0), (0, 0), (1, 0)]


def test_joins_and_null_keys(spark):
    t = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([("a", t, 1), (None, t, 2)], "flight STRING, ts TIMESTAMP_NTZ, pax INT")
    right = spark.createDataFrame([("a", t, 5), (None, t, 6)], "flight STRING, ts TIMESTAMP_NTZ, pred INT")
    assert metrics.forecast_join(left, right, ROLES).count() == 1
    assert metrics.forecast_join(left, right, ROLES, how="left").count() == 2
    safe = metrics.forecast_join(left, right, ROLES, null_safe=True)
    assert sorted((r.pax, r.pred) for r in safe.collect()) == [(1, 5), (2, 6)]
    assert safe.columns == ["flight", "ts", "pax", "pred"]
    merged = metrics.merge_predictions(left.withColumn("id", F.col("pax")), right.withColumn("id", F.lit(2)), ROLES)
    assert [(r.id, r.pred) for r in merged.where("pred = 6").collect()] == [(2, 6)]


def test_terminal_filter_keeps_missing(spark):
    df = spark.createDataFrame([("T1",), (None,), ("none",)], "terminal STRING")
    assert metrics.assigned_terminals(df, "none", ROLES).count() == 2


def test_split_edges(spark):
    limits = split.Limits.for_run(dt.date(2024, 3, 10), predict_days=2, val_days=7)
    assert (limits.train, limits.valid, limits.test) == ("2024-03-03", "2024-03-10", "2024-03-12")
    rows = [(dt.datetime(2024, 3, d),) for d in (2, 3, 9, 10, 11, 12)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ")
    train, valid, test = split.split_sets(df, limits, ROLES)
    assert [x.count() for x in (train, valid, test)] == [1, 2, 2]
    closed = split.Limits(limits.train, limits.valid, limits.test, inclusive_end=True)
    assert split.split_sets(df, closed, ROLES)[2].count() == 3
    named = {r.ts.day: r.split for r in split.with_split(df, limits, ROLES).collect()}
    assert named == {2: "train", 3: "valid", 9: "valid", 10: "test", 11: "test", 12: None}


def test_plan_cuts_shifts_at_midnight_and_keeps_keys_apart(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 23), "A", 1000),
        (dt.datetime(2024, 1, 2, 0), "A", 1),
        (dt.datetime(2024, 1, 1, 23), None, 200),
    ]
    df = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, terminal STRING, pax INT")
    hours = staffing.daily_hours(df, "pax", ["terminal"], ROLES)
    plan = staffing.staffing_plan(hours, ["terminal"]).where("Staff_Starting > 0")
    found = {(r.day.day, r.terminal, r.Heure): r.Staff_Starting for r in plan.collect()}
    assert found == {(1, "A", 23): 40, (2, "A", 0): 8, (1, None, 23): 8}


def test_forecast_report(spark):
    roles = Roles()
    t = dt.datetime(2026, 4, 1, 7, 30)
    pred = spark.createDataFrame(
        [("A", t, 100.0, 1.0), ("B", t, 50.0, 0.0), ("A", t + dt.timedelta(days=1), 9.0, 9.0)],
        config.PREDICTIONS_DDL,
    )
    real = spark.createDataFrame(
        [("A", t, 90, 2, "T1", "Départ"), ("B", t, 60, 0, None, "Arrivée"), (None, t, 5, 5, "T1", "Départ")],
        config.ACTUALS_DDL,
    )
    report = metrics.forecast_report(pred, real, "2026-04-01", roles)
    assert report["joined"].count() == 2
    assert report["passengers"].first().mae == 10.0
    assert report["reduced"].first().total_actual == 2.0
    sums = {(r.level, r.SysTerminal, r.Direction): r.PredNbPaxTotal for r in report["sums"].collect()}
    assert sums["Heure", None, None] == 150.0
    assert sums["Heure+SysTerminal", "T1", None] == 100.0
    assert sums["Heure+SysTerminal", None, None] == 50.0
    assert sums["Direction", None, "Arrivée"] == 50.0
    assert len(sums) == 1 + 2 + 2 + 2
