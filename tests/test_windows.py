"""Windows and lookups against plain Python on small frames with edge rows."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from paxflow.config import Roles
from paxflow.operators import lags, rolling, trend
from paxflow.plans.blocks import row_blocks

ROLES = Roles(time="ts", row_id="id", target="pax", groups=("grp",))
SCHEMA = "id BIGINT, ts TIMESTAMP_NTZ, grp STRING, pax INT"
STATS = ("mean", "min", "max", "std", "median")


def make_rows(count: int = 400, seed: int = 7):
    """Ties, a null group, a one-row group, missing targets and one group with half of the rows."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(count):
        group = rng.choice(["a", "a", "a", "b", None])
        ts = start + dt.timedelta(hours=rng.randrange(0, 24 * 40))
        pax = None if rng.random() < 0.1 else rng.randrange(0, 200)
        rows.append((i, ts, group, pax))
    rows.append((count, start + dt.timedelta(days=3), "single", 5))
    return rows


def stat(name: str, values: list):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if name == "std":
        return statistics.stdev(values) if len(values) > 1 else None
    return {"mean": statistics.fmean, "min": min, "max": max, "median": statistics.median}[name](
        values
    )


def same(found, wanted) -> bool:
    if found is None or wanted is None:
        return found is None and wanted is None
    return math.isclose(found, wanted, rel_tol=1e-9, abs_tol=1e-9)


def by_group(rows, keys):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[0])):
        groups.setdefault(row[2] if keys else None, []).append(row)
    return groups


@pytest.mark.parametrize("keys", [[], ["grp"]])
@pytest.mark.parametrize("block", [12, 60, 200_000, None])
def test_rolling(spark, keys, block):
    rows = make_rows()
    windows = {"short": 3, "long": 10}
    found = {
        r.id: r
        for r in rolling.rolling_stats(
            spark.createDataFrame(rows, SCHEMA),
            keys,
            windows,
            block_rows=block,
            roles=ROLES,
        ).collect()
    }
    assert len(found) == len(rows)
    prefix = "grp" if keys else "global"
    for group in by_group(rows, keys).values():
        for i, row in enumerate(group):
            for window, size in windows.items():
                values = [r[3] for r in group[max(0, i - size - 1) : max(0, i - 1)]]
                for s in STATS:
                    got = found[row[0]][f"{prefix}_rolling_{window}_{s}"]
                    assert same(got, stat(s, values)), (row, window, s)


def test_blocks_are_even_and_whole(spark):
    df = spark.createDataFrame(make_rows(1000), SCHEMA)
    blocks = row_blocks(df, ["grp"], ["ts", "id"], reach=5, block_rows=50)
    owned = blocks.where("_owned")
    assert owned.count() == 1001
    assert owned.select("id").distinct().count() == 1001
    sizes = [r["count"] for r in owned.groupBy("_block").count().collect()]
    assert max(sizes) == 50 and len(sizes) == 21
    assert blocks.count() == 1001 + 20 * 5


def test_blocks_must_hold_the_reach(spark):
    df = spark.createDataFrame(make_rows(20), SCHEMA)
    with pytest.raises(ValueError):
        row_blocks(df, [], ["ts", "id"], reach=5, block_rows=4)


def test_shift(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.id: r.before for r in rolling.shift_one(df, ["grp"], "before", ROLES).collect()}
    for group in by_group(rows, ["grp"]).values():
        for i, row in enumerate(group):
            assert found[row[0]] == (group[i - 1][3] if i else None)


@pytest.mark.parametrize("keys", [[], ["grp"]])
def test_trend(spark, keys):
    rows = make_rows()
    found = {
        r.id: r
        for r in trend.trend_stats(
            spark.createDataFrame(rows, SCHEMA), keys, 2, 7, roles=ROLES
        ).collect()
    }
    prefix = "grp" if keys else "global"
    for group in by_group(rows, keys).values():
        shifted = [(r[1], group[i - 1][3] if i else None) for i, r in enumerate(group)]
        for row in group:
            frames = {
                days: [v for t, v in shifted if row[1] - dt.timedelta(days=days) <= t < row[1]]
                for days in (2, 7)
            }
            for s in STATS:
                top, bottom = stat(s, frames[2]), stat(s, frames[7])
                wanted = 1.0 if bottom is None or bottom <= 0 else None if top is None else top / bottom
                assert same(found[row[0]][f"{prefix}_trend_2D_vs_7D_{s}"], wanted), (row, s)


def test_trend_of_zero_is_one(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(days=i), "a", 0) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    values = trend.trend_stats(df, ["grp"], 1, 3, roles=ROLES).select("grp_trend_1D_vs_3D_mean")
    assert {r[0] for r in values.collect()} == {1.0}


@pytest.mark.parametrize("keys", [[], ["grp"]])
def test_lagged_windows(spark, keys):
    rows = make_rows()
    windows = {"w": (7, 6), "v": (1, 2)}
    found = {
        r.id: r
        for r in lags.lagged_window_stats(
            spark.createDataFrame(rows, SCHEMA), keys, windows, roles=ROLES
        ).collect()
    }
    prefix = "grp" if keys else "global"
    for group in by_group(rows, keys).values():
        minutes = {}
        for r in group:
            minutes.setdefault(r[1], []).append(r[3])
        means = {t: stat("mean", v) for t, v in minutes.items()}
        for row in group:
            for name, (delay, days) in windows.items():
                at = row[1] - dt.timedelta(days=delay)
                half = dt.timedelta(days=days) / 2
                values = [v for t, v in means.items() if at - half < t <= at + half]
                for s in STATS:
                    wanted = stat(s, values) if at in means else None
                    assert same(found[row[0]][f"{prefix}_{name}_{s}"], wanted), (row, name, s)


def test_frame_edges(spark):
    """Left edge of a centered frame is outside, right edge inside."""
    noon = dt.datetime(2024, 3, 10, 12)
    day = dt.timedelta(days=1)
    rows = [(0, noon - day, "a", 1), (1, noon, "a", 10), (2, noon + day, "a", 100), (3, noon + 7 * day, "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    table = lags.lagged_window_stats(df, ["grp"], {"x": (7, 2)}, ("mean",), ROLES)
    assert {r.id: r.grp_x_mean for r in table.collect()}[3] == 55.0


def test_month_end_takes_the_latest_source(spark):
    days = [(0, 29, 1), (1, 30, 2), (2, 31, 3)]
    rows = [(i, dt.datetime(2024, 1, d, 8, 30, 15), "a", v) for i, d, v in days]
    rows += [(3, dt.datetime(2024, 2, 29, 8, 30, 50), "a", 9), (4, dt.datetime(2024, 2, 29, 8, 30), None, 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    table = lags.lag_stats(df, ["grp"], {"1month": "1 month"}, ROLES)
    found = {r.id: r.grp_lag_1month_raw for r in table.collect()}
    assert found == {0: None, 1: None, 2: None, 3: 3.0, 4: None}


def test_lag_averages_ties_and_knows_null_groups(spark):
    t0, t1 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 8, 6)
    rows = [(0, t0, None, 1), (1, t0, None, 4), (2, t0, "a", 100), (3, t1, None, 0), (4, t1, "a", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = lags.lag_stats(df, ["grp"], {"1week": "7 days"}, ROLES)
    assert {r.id: r.grp_lag_1week_raw for r in found.collect()}[3] == 2.5
    overall = lags.lag_stats(df, [], {"1week": "7 days"}, ROLES)
    assert {r.id: r.global_lag_1week_raw for r in overall.collect()}[4] == 35.0


def test_momentum_needs_two_means_and_guards_zero(spark):
    df = spark.createDataFrame(
        [(1, 6.0, 3.0), (2, 6.0, 0.0)], "id INT, grp_rolling_week_mean DOUBLE, grp_rolling_month_mean DOUBLE"
    )
    found = rolling.momentum_features(df, ["grp"]).collect()
    assert [r.grp_momentum_week_vs_month for r in found] == [2.0, None]
    assert rolling.momentum_features(df.drop("grp_rolling_month_mean"), ["grp"]).columns == [
        "id",
        "grp_rolling_week_mean",
    ]


def test_public_forms_keep_all_columns(spark):
    df = spark.createDataFrame(make_rows(30), SCHEMA).withColumn("extra", F.lit("x"))
    for out in (
        rolling.rolling_features(df, ["grp"], roles=ROLES),
        trend.trend_features(df, ["grp"], roles=ROLES),
        lags.lag_features(df, ["grp"], roles=ROLES),
        lags.lagged_window_features(df, ["grp"], roles=ROLES),
    ):
        assert set(df.columns) <= set(out.columns) and out.count() == 31


def test_all_pairs_of_trends(spark):
    df = spark.createDataFrame(make_rows(30), SCHEMA)
    out = trend.all_trend_features(df, ["grp"], ROLES, ((2, 7), (7, 9)), stats=("mean",))
    assert out.columns == [*df.columns, "grp_trend_2D_vs_7D_mean", "grp_trend_7D_vs_9D_mean"]
    assert out.count() == 31
