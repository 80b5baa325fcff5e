"""Date and time expressions on zone-free timestamps.

Everything works on ``TIMESTAMP_NTZ`` parts, never through a zoned timestamp, so results do not
change with the session time zone and local hours skipped by daylight saving stay what they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EPOCH_DAY = "1970-01-01"
#: Text that ends in a zone after its time of day.
ZONED = r"[0-9]{1,2}:[0-9]{2}.*(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)$"


def local_time(df: DataFrame, name: str) -> Column:
    """The time column as a zone-free timestamp.

    Text is parsed (unreadable text becomes null); what has a zone is taken to UTC and loses it.
    """
    kind = df.schema[name].dataType.typeName()
    if kind == "timestamp_ntz":
        return F.col(name)
    if kind == "timestamp":
        return utc(F.col(name))
    if kind == "date":
        return F.col(name).cast("timestamp_ntz")
    text = F.trim(F.col(name))
    return F.when(text.rlike(ZONED), utc(text.try_cast("timestamp"))).otherwise(
        text.try_cast("timestamp_ntz")
    )


def utc(instant: Column) -> Column:
    """A zoned timestamp as the UTC clock shows it; never by way of a local clock."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def iso_day(text: Column) -> Column:
    """Date part of an ISO date-time text."""
    return F.to_date(F.substring_index(text, "T", 1))


def day_number(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit(EPOCH_DAY).cast("date")).cast("long")


def minute_number(ts: Column) -> Column:
    """Whole minutes since 1970, a plain long."""
    return day_number(ts) * 1440 + F.hour(ts) * 60 + F.minute(ts)


def micro_number(ts: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), ts)
    return minute_number(ts) * 60_000_000 + (seconds * 1_000_000).cast("long")


def floor_minute(ts: Column) -> Column:
    return ts - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), ts))


def floor_hour(ts: Column) -> Column:
    return ts - F.make_dt_interval(
        mins=F.minute(ts), secs=F.extract(F.lit("SECOND"), ts)
    )


def semester(ts: Column) -> Column:
    return F.when(F.month(ts) <= 6, 1).otherwise(2)


def hour_of_week(ts: Column) -> Column:
    return F.weekday(ts) * 24 + F.hour(ts)


def cycle(part: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = F.lit(2) * F.pi() * part / F.lit(period)
    return F.sin(angle), F.cos(angle)


def on_day(ts: Column, day: str) -> Column:
    """Row falls on a calendar day; a plain range, so it reaches the file scan."""
    start = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    return (ts >= start) & (ts < start + F.expr("INTERVAL '1' DAY"))
