"""Text expressions: city names, zone names, report cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Places whose airport name needs a name of its own.
NAMED_PLACES = {"Figari": "Figari", "Pointe": "Pointe-a-Pitre", "La Rochelle": "La Rochelle"}


def city_name(raw: Column) -> Column:
    """Town that decides the school district, from an airport's city text."""
    first = F.trim(F.substring_index(raw, "/", 1))
    saintly = F.when(first.startswith("St "), F.replace(first, F.lit("St "), F.lit("Saint-")))
    word = F.substring_index(F.coalesce(saintly, first), " ", 1)
    stem = F.trim(F.substring_index(word, "-", 1))
    plain = F.when(stem == "Saint", F.trim(word)).otherwise(stem)
    named = [F.when(first.contains(part), F.lit(name)) for part, name in NAMED_PLACES.items()]
    return F.coalesce(*named, plain)


def zone_key(zone: Column) -> Column:
    """One spelling of a zone name for both sides of a join."""
    return F.replace(F.trim(zone), F.lit(" "), F.lit("_"))


def cell(value: Column, width: int) -> Column:
    """Padded to ``width``; a wider text stays whole."""
    text = value.cast("string")
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def money(value: Column) -> Column:
    """Thousands separator, two digits, at least eight wide."""
    return F.format_string("%,8.2f $", value.cast("double"))
