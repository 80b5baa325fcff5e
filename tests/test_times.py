"""Times with zones, days in another session zone, and rows without a time or with NaN."""

from __future__ import annotations

import pytest

from paxflow.config import Roles
from paxflow.functions import dates as D
from paxflow.operators.metrics import forecast_join
from paxflow.operators.rolling import narrow
from paxflow.operators.staffing import daily_hours
from paxflow.plans.sliding import VALUE

ROLES = Roles(time="ts", row_id="id", target="pax")


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("name", ["UTC", "Europe/Paris", "America/New_York"])
def test_zoned_times_become_utc(spark, zone, name):
    zone(name)
    texts = ["2024-10-27T00:30:00Z", "2024-10-27T01:30:00Z", "2024-03-31 02:30:00+00:00", "1969-12-31T23:59:59.5Z"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "CAST(text AS timestamp) AS ts")
    wanted = ["2024-10-27 00:30:00", "2024-10-27 01:30:00", "2024-03-31 02:30:00", "1969-12-31 23:59:59.5"]
    for column in ("ts", "text"):
        found = df.select(D.local_time(df, column).cast("string").alias("t")).collect()
        assert [r.t for r in found] == wanted


def test_zone_in_text_counts(spark):
    texts = ["2024-07-01T10:00:00+02:00", "2024-07-01 10:00:00", "2024-07-01", "2024-07-01T10:00:00-0330", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "ts string")
    found = [r.t for r in df.select(D.local_time(df, "ts").cast("string").alias("t")).collect()]
    assert found == ["2024-07-01 08:00:00", "2024-07-01 10:00:00", "2024-07-01 00:00:00", "2024-07-01 13:30:00", None, None]


def test_a_day_is_a_day_in_utc(spark, zone):
    zone("America/New_York")
    df = spark.sql("SELECT 1 AS id, TIMESTAMP'2024-01-02 02:00:00Z' AS ts, 5 AS pax")
    other = df.select("id", "ts", "pax")
    assert forecast_join(df, other, ROLES, day="2024-01-02").count() == 1
    assert forecast_join(df, other, ROLES, day="2024-01-01").count() == 0


def test_rows_without_a_time_or_with_nan(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-02 02:00:00', 5d), (2, NULL, 7d),"
        " (3, TIMESTAMP_NTZ'2024-01-02 03:00:00', double('NaN')) AS t(id, ts, pax)"
    )
    (day,) = daily_hours(df.where("id < 3"), "pax", [], ROLES).collect()
    assert day.hourly[2] == 5 and sum(day.hourly) == 5
    assert [r[VALUE] for r in narrow(df, [], ROLES).orderBy("id").collect()] == [5.0, 7.0, None]
