"""Shift-constrained staff plans from hourly passengers, for any number of days and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paxflow.config import HOURLY_RATE, PAX_PER_LANE, SHIFT_HOURS, STAFF_PER_LANE, Roles
from paxflow.functions import dates as D
from paxflow.functions.numbers import ceil_div
from paxflow.functions.text import cell, money

HOURS = 24
RULE = 90


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, v: total + v)


def daily_hours(
    df: DataFrame, pax: str, keys: list[str] = (), roles: Roles = Roles()
) -> DataFrame:
    """One row per day and key with ``pax`` as 24 hourly sums; hours without rows hold 0.

    Rows without a time belong to no day.
    """
    ts = D.local_time(df, roles.time)
    hourly = (
        df.where(ts.isNotNull())
        .select(F.to_date(ts).alias("day"), F.hour(ts).alias("_hour"), *keys, pax)
        .groupBy("day", *keys, "_hour")
        .agg(F.sum(pax).alias("_pax"))
    )
    # At most 24 entries are collected per group.
    return (
        hourly.groupBy("day", *keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("_hour", "_pax"))).alias("_by_hour"))
        .select(
            "day",
            *keys,
            F.transform(
                F.sequence(F.lit(0), F.lit(HOURS - 1)),
                lambda h: F.coalesce(F.try_element_at("_by_hour", h), F.lit(0)),
            ).alias("hourly"),
        )
    )


def staffing_plan(
    days: DataFrame,
    keys: list[str] = (),
    pax_per_lane: int = PAX_PER_LANE,
    staff_per_lane: int = STAFF_PER_LANE,
    shift: int = SHIFT_HOURS,
) -> DataFrame:
    """Hour by hour: lanes needed, staff starting and ending, staff present, lanes open.

    Whoever starts stays for ``shift`` hours. An hour that lacks staff hires the difference.
    """
    need = F.transform("hourly", lambda p: ceil_div(p, pax_per_lane))

    def hire(hired: Column, lanes: Column) -> Column:
        on_duty = _total(
            F.slice(hired, F.greatest(F.lit(1), F.size(hired) - (shift - 2)), shift - 1)
        )
        gap = F.greatest(F.lit(0), lanes * staff_per_lane - on_duty)
        return F.concat(hired, F.array(gap))

    starts = F.aggregate("lanes", F.array().cast("array<int>"), hire)
    hour = F.col("Heure")
    present = _total(
        F.slice("starts", F.greatest(F.lit(1), hour - (shift - 2)), F.least(hour + 1, F.lit(shift)))
    )
    ending = F.when(hour >= shift, F.get("starts", hour - shift)).otherwise(0)
    return (
        days.withColumn("lanes", need)
        .withColumn("starts", starts)
        .select(
            "day",
            *keys,
            "starts",
            F.posexplode(F.arrays_zip("hourly", "lanes", "starts")).alias("Heure", "now"),
        )
        .withColumn("present", present)
        .select(
            "day",
            *keys,
            "Heure",
            F.col("now.hourly").cast("long").alias("Pax"),
            F.col("now.lanes").alias("Lanes_Required"),
            F.col("now.starts").alias("Staff_Starting"),
            ending.alias("Staff_Ending"),
            F.col("present").alias("Total_Staff_Present"),
            F.floor(F.col("present") / staff_per_lane).cast("int").alias("Lanes_Open"),
        )
    )


def staffing_totals(
    plan: DataFrame,
    keys: list[str] = (),
    rate: float = HOURLY_RATE,
    pax_per_lane: int = PAX_PER_LANE,
    staff_per_lane: int = STAFF_PER_LANE,
) -> DataFrame:
    """Per day: teams mobilised, hours paid, peak staff, peak capacity, cost."""
    return plan.groupBy("day", *keys).agg(
        (F.sum("Staff_Starting") / staff_per_lane).alias("teams"),
        F.sum("Total_Staff_Present").alias("paid_hours"),
        F.max("Total_Staff_Present").alias("peak_staff"),
        (F.max("Lanes_Open") * pax_per_lane).alias("max_capacity"),
        (F.sum("Total_Staff_Present") * F.lit(float(rate))).alias("cost"),
    )


def staffing_report(plan: DataFrame, keys: list[str] = (), rate: float = HOURLY_RATE) -> DataFrame:
    """The plan as report lines: (day, keys, line_no, line), one report per day and key."""
    hour, cost = F.col("Heure"), F.col("Total_Staff_Present") * F.lit(float(rate))
    started, ended = F.col("Staff_Starting"), F.col("Staff_Ending")
    moves = F.concat_ws(
        " | ",
        F.when(started > 0, F.format_string("+ %02d SHIFT START", started)),
        F.when(ended > 0, F.format_string("- %02d SHIFT END", ended)),
    )

    def row(*parts: Column) -> Column:
        return F.concat_ws(" | ", *parts)

    def fixed(*texts: str) -> list[Column]:
        widths = (12, 6, 7, 35)
        return [cell(F.lit(t), w) for t, w in zip(texts, widths)]

    body = plan.select(
        "day",
        *keys,
        (hour + 5).alias("line_no"),
        row(
            cell(F.format_string("%02d:00-%02d:00", hour, hour + 1), 12),
            cell(F.col("Lanes_Open"), 6),
            cell(F.col("Total_Staff_Present"), 7),
            cell(F.when(moves == "", "---").otherwise(moves), 35),
            money(cost),
        ).alias("line"),
    )
    bar, rule = F.lit("=" * RULE), F.lit("-" * RULE)
    frame = [
        (0, bar),
        (1, F.lit("OPERATIONAL REPORT - WORKFORCE RESOURCE PLANNING")),
        (2, bar),
        (3, row(*fixed("TIME SLOT", "LANES", "STAFF", "HR MOVEMENTS (IN/OUT)"), F.lit("COST"))),
        (4, rule),
        (HOURS + 5, rule),
        (HOURS + 6, row(*fixed("DAILY TOTAL", "---", "---", "---"), money(F.col("_cost")))),
        (HOURS + 7, bar),
    ]
    around = (
        plan.groupBy("day", *keys)
        .agg(F.sum(cost).alias("_cost"))
        .select(
            "day",
            *keys,
            F.inline(
                F.array(*[F.struct(F.lit(n).alias("line_no"), t.alias("line")) for n, t in frame])
            ),
        )
    )
    return body.unionByName(around)
