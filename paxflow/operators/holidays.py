"""Public- and school-holiday flags of the place people leave from.

Holiday rules come as tables, not from network services. Periods become days, so every interval
join is an equi join. Flags are worked out once per (day, departure airport), a table bounded by
the calendar and the airports, and only then joined to the movements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paxflow.config import (
    CALENDAR_END,
    CALENDAR_START,
    CITY_DISTRICT,
    DEPARTURE,
    FRENCH_CODES,
    FRENCH_ZONES,
    HOLIDAY_WORDS,
    Roles,
)
from paxflow.functions import dates as D
from paxflow.functions.text import city_name, zone_key
from paxflow.operators.calendar import day_spine, days_between

PUBLIC, SCHOOL = "IsPublicHolidays", "IsScholarHolidays"


def with_departure(
    df: DataFrame, home: str, name: str = "AirportDeparture", roles: Roles = Roles()
) -> DataFrame:
    """Airport the passengers set out from: home for departures, else the previous airport."""
    leaving = F.col(roles.direction) == DEPARTURE
    return df.withColumn(
        name, F.when(leaving, F.lit(home)).otherwise(F.col(roles.previous_airport))
    )


def airport_codes(airports: DataFrame) -> DataFrame:
    """(code, OACI_code, country, city): three-letter codes by IATA, all others by ICAO."""
    rows = airports.where(F.coalesce("icao", F.lit("")) != "").select(
        F.explode(
            F.array(
                F.when(F.length("iata") == 3, F.col("iata")),
                F.when(F.length("icao") != 3, F.col("icao")),
            )
        ).alias("code"),
        F.struct(F.col("icao").alias("OACI_code"), "country", "city").alias("place"),
    )
    return (
        rows.where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.min("place").alias("place"))
        .select("code", "place.*")
    )


def resolve_airports(df: DataFrame, airports: DataFrame, code: str) -> DataFrame:
    """Rows with a known airport, with its ICAO code, country and city."""
    return df.join(airport_codes(airports).withColumnRenamed("code", code), code, "inner")


def unresolved_codes(df: DataFrame, airports: DataFrame, code: str) -> DataFrame:
    known = airport_codes(airports).select(F.col("code").alias(code))
    return df.select(code).distinct().join(known, code, "left_anti")


def flag_days(
    df: DataFrame, days: DataFrame, keys: list[str], name: str
) -> DataFrame:
    """1 where the row's keys are listed in ``days``, else 0."""
    listed = days.select(*keys).distinct().withColumn(name, F.lit(1))
    return df.join(listed, keys, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def with_public_holidays(
    df: DataFrame, public_holidays: DataFrame, country: str = "country", day: str = "day"
) -> DataFrame:
    """``public_holidays`` has (country, day)."""
    listed = public_holidays.select(F.col("country").alias(country), F.col("day").alias(day))
    return flag_days(df, listed, [country, day], PUBLIC)


def period_days(periods: DataFrame, key: str) -> DataFrame:
    """Distinct (key, day) covered by closed (start, end) periods."""
    return days_between(periods, "start", "end").select(key, "day").distinct()


def with_school_holidays(
    df: DataFrame, periods: DataFrame, key: str, day: str = "day"
) -> DataFrame:
    """1 where the row's day lies inside any period of its key."""
    days = period_days(periods, key).withColumnRenamed("day", day)
    return flag_days(df, days, [key, day], SCHOOL)


def zone_periods(
    records: DataFrame,
    zones=FRENCH_ZONES,
    start: str = CALENDAR_START,
    end: str = CALENDAR_END,
    words=HOLIDAY_WORDS,
) -> DataFrame:
    """School-holiday periods of the listed zones that overlap the calendar.

    ``records`` has zones, location, description, start_date, end_date, annee_scolaire, population.
    """
    wanted = F.lit(False)
    for word in words:
        wanted = wanted | F.col("description").contains(word)
    overlapping = records.where(
        wanted
        & (D.iso_day(F.col("end_date")) >= F.lit(start).cast("date"))
        & (D.iso_day(F.col("start_date")) <= F.lit(end).cast("date"))
    )
    return overlapping.select(
        F.explode(F.array_distinct(F.array("zones", "location"))).alias("zone"),
        "description",
        D.iso_day(F.col("start_date")).alias("start"),
        D.iso_day(F.col("end_date")).alias("end"),
        F.col("annee_scolaire").alias("school_year"),
        "population",
    ).where(F.col("zone").isin(list(zones)))


def zone_lookup(records: DataFrame) -> DataFrame:
    """District or zone name -> school zone, from the record that starts first."""
    zone = F.coalesce(F.nullif("zones", F.lit("")), F.col("location"))
    return (
        records.select(
            F.explode(F.array_distinct(F.array("location", "zones"))).alias("target"),
            zone.alias("_zone"),
            "start_date",
            "end_date",
        )
        .where(F.col("target").isNotNull())
        .groupBy("target")
        .agg(F.min(F.struct("start_date", "_zone", "end_date")).alias("first"))
        .select(
            "target",
            F.col("first._zone").alias("zone"),
            F.when(F.col("first.start_date") <= F.col("first.end_date"), "OUI")
            .otherwise("NON")
            .alias("is_holiday"),
        )
    )


def calendar_wide(
    spark: SparkSession,
    periods: DataFrame,
    zones=FRENCH_ZONES,
    start: str = CALENDAR_START,
    end: str = CALENDAR_END,
) -> DataFrame:
    """One row per day, one 0/1 column per zone."""
    names = [zone.replace(" ", "_") for zone in zones]
    covered = period_days(periods.withColumn("zone", zone_key(F.col("zone"))), "zone")
    marks = covered.groupBy("day").agg(
        *[F.max(F.when(F.col("zone") == n, 1)).alias(n) for n in names]
    )
    return (
        day_spine(spark, start, end)
        .join(marks, "day", "left")
        .select("day", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
    )


def calendar_long(wide: DataFrame, zone: str = "holiday_zone") -> DataFrame:
    """The wide calendar as (day, zone, flag)."""
    zones = [c for c in wide.columns if c != "day"]
    return wide.unpivot("day", zones, zone, SCHOOL)


def district(city: Column, districts: dict[str, str] = CITY_DISTRICT) -> Column:
    """District of a cleaned city name; the name itself if it is not listed."""
    listed = F.create_map(*[F.lit(text) for pair in districts.items() for text in pair])
    return F.coalesce(F.try_element_at(listed, city), city)


def with_school_zone(
    df: DataFrame, lookup: DataFrame, city: str = "city", name: str = "holiday_zone"
) -> DataFrame:
    """School zone of a city: cleaned name -> district -> zone."""
    zones = lookup.select(F.col("target").alias("_target"), F.col("zone").alias(name))
    return (
        df.withColumn("_target", district(city_name(F.col(city))))
        .join(zones, "_target", "left")
        .drop("_target")
    )


def is_french(country: Column) -> Column:
    """A missing country counts as foreign."""
    return F.coalesce(country.isin(list(FRENCH_CODES)), F.lit(False))


def country_split(df: DataFrame, country: str = "country") -> tuple[DataFrame, DataFrame]:
    french = is_french(F.col(country))
    return df.where(french), df.where(~french)


def with_country_branch(df: DataFrame, country: str = "country", name: str = "branch") -> DataFrame:
    """The two sides of :func:`country_split` in one pass, told apart by ``name``."""
    side = F.when(is_french(F.col(country)), "France").otherwise("abroad")
    return df.withColumn(name, side)


def school_flags_france(df: DataFrame, periods: DataFrame, lookup: DataFrame) -> DataFrame:
    zoned = with_school_zone(df, lookup).withColumn("zone", zone_key(F.col("holiday_zone")))
    spelled = periods.withColumn("zone", zone_key(F.col("zone")))
    return with_school_holidays(zoned, spelled, "zone").drop("zone", "holiday_zone")


def school_flags_abroad(df: DataFrame, periods: DataFrame) -> DataFrame:
    return with_school_holidays(df, periods, "country")


def holiday_flags(
    movements: DataFrame,
    airports: DataFrame,
    public_holidays: DataFrame,
    french_periods: DataFrame,
    foreign_periods: DataFrame,
    lookup: DataFrame,
    home: str,
    roles: Roles = Roles(),
) -> DataFrame:
    """(day, AirportDeparture, country, both flags), unique by day and airport.

    Movements of unknown airports have no row here.
    """
    seen = (
        with_departure(movements, home, roles=roles)
        .select(
            F.to_date(D.local_time(movements, roles.time)).alias("day"), "AirportDeparture"
        )
        .distinct()
    )
    known = with_public_holidays(
        resolve_airports(seen, airports, "AirportDeparture"), public_holidays
    )
    # One pass for both branches: a row has either a zone or a foreign country to look up.
    french = is_french(F.col("country"))
    placed = with_school_zone(known, lookup).select(
        *known.columns,
        F.when(french, zone_key(F.col("holiday_zone"))).alias("_zone"),
        F.when(~french, F.col("country")).alias("_abroad"),
    )
    zone_days = period_days(
        french_periods.withColumn("_zone", zone_key(F.col("zone"))), "_zone"
    )
    country_days = period_days(
        foreign_periods.withColumnRenamed("country", "_abroad"), "_abroad"
    )
    flagged = flag_days(placed, zone_days, ["_zone", "day"], "_in_zone")
    flagged = flag_days(flagged, country_days, ["_abroad", "day"], "_in_country")
    return flagged.select(
        "day",
        "AirportDeparture",
        "country",
        PUBLIC,
        F.greatest("_in_zone", "_in_country").alias(SCHOOL),
    )


def join_holidays(
    movements: DataFrame, flags: DataFrame, home: str, roles: Roles = Roles()
) -> DataFrame:
    """Movements of known airports with their two flags."""
    ts = D.local_time(movements, roles.time)
    return (
        with_departure(movements, home, roles=roles)
        .withColumn("day", F.to_date(ts))
        .join(flags, ["day", "AirportDeparture"], "inner")
        .drop("day", "AirportDeparture")
    )
