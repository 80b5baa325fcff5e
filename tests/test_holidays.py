"""Holiday tables from payload to flag."""

from __future__ import annotations

import datetime as dt
import json

from paxflow.config import Roles
from paxflow.functions.dates import local_time
from paxflow.functions.text import city_name
from paxflow.operators import calendar, holidays
from paxflow.sources import holidays as payloads
from pyspark.sql import functions as F


def record(zones, location, start, end, description="Vacances d'Hiver"):
    return {
        "description": description,
        "start_date": f"{start}T22:00:00+00:00",
        "end_date": f"{end}T22:00:00+00:00",
        "annee_scolaire": "2023-2024",
        "population": "-",
        "zones": zones,
        "location": location,
    }


RECORDS = [
    record("Zone A", "Lyon", "2024-02-17", "2024-03-04"),
    record("Zone A", "Grenoble", "2024-02-17", "2024-03-04"),
    record("Zone B", "Rennes", "2024-02-24", "2024-03-11"),
    record(None, "Corse", "2024-02-17", "2024-03-04"),
    record("Zone A", "Lyon", "2022-02-12", "2022-02-28"),
    record("Zone A", "Lyon", "2024-05-09", "2024-05-10", "Pont de l'Ascension"),
]


def zone_records(spark):
    text = json.dumps({"total_count": len(RECORDS), "results": RECORDS})
    return payloads.zone_records(spark.createDataFrame([(text,)], "value STRING"))


def test_city_names(spark):
    cases = {
        "Figari Sud Corse": "Figari",
        "Grande Pointe": "Pointe-a-Pitre",
        "La Rochelle / Ile de Re": "La Rochelle",
        "St Denis Gillot": "Saint-Denis",
        "Saint-Etienne Loire": "Saint-Etienne",
        "Lille/Lesquin": "Lille",
        "Clermont-Ferrand": "Clermont",
        "  Nice Cote d'Azur": "Nice",
    }
    df = spark.createDataFrame([(c,) for c in cases], "city STRING")
    found = {r.city: r.name for r in df.select("city", city_name(F.col("city")).alias("name")).collect()}
    assert found == cases


def test_zone_periods_overlap_and_words(spark):
    found = holidays.zone_periods(zone_records(spark)).collect()
    keys = sorted((r.zone, str(r.start), str(r.end)) for r in found)
    assert keys == [
        ("Corse", "2024-02-17", "2024-03-04"),
        ("Zone A", "2024-02-17", "2024-03-04"),
        ("Zone A", "2024-02-17", "2024-03-04"),
        ("Zone B", "2024-02-24", "2024-03-11"),
    ]


def test_zone_lookup(spark, tmp_path):
    lookup = holidays.zone_lookup(zone_records(spark))
    found = {r.target: r.zone for r in lookup.collect()}
    assert found["Lyon"] == "Zone A" and found["Rennes"] == "Zone B" and found["Corse"] == "Corse"
    payloads.write_zone_lookup(lookup, str(tmp_path / "zones"))
    again = payloads.read_zone_lookup(spark, str(tmp_path / "zones"))
    assert sorted(map(tuple, again.collect())) == sorted(
        (r.target, r.zone, r.is_holiday) for r in lookup.collect()
    )
    saved = tmp_path / "saved.json"
    saved.write_text(json.dumps({"Lyon": {"zone": "Zone A", "is_holiday": "OUI"}}, indent=1))
    assert payloads.read_zone_lookup(spark, str(saved)).first().zone == "Zone A"


def test_foreign_payloads(spark, tmp_path):
    good = {"startDate": "2024-07-01", "endDate": "2024-08-31T00:00:00"}
    (tmp_path / "DE.json").write_text(json.dumps([good, "text", {"startDate": "2024-01-01"}, 5]))
    (tmp_path / "ES.json").write_text(json.dumps({"holidays": [good, {"endDate": "x", "startDate": "y"}]}))
    (tmp_path / "IT.json").write_text("not json")
    found = payloads.foreign_periods(payloads.read_payloads(spark, str(tmp_path))).collect()
    assert sorted((r.country, str(r.start), str(r.end)) for r in found) == [
        ("DE", "2024-07-01", "2024-08-31"),
        ("ES", "2024-07-01", "2024-08-31"),
    ]


def test_wide_and_long_calendar(spark):
    periods = holidays.zone_periods(zone_records(spark))
    wide = holidays.calendar_wide(spark, periods, start="2024-02-01", end="2024-03-31")
    assert wide.count() == 60
    sums = wide.agg(F.sum("Zone_A").alias("a"), F.sum("Zone_B").alias("b"), F.sum("Mayotte").alias("m"))
    assert tuple(sums.first()) == (17, 17, 0)
    assert holidays.calendar_long(wide).count() == 60 * 9


def test_date_chunks(spark):
    rows = [("FR", dt.date(2020, 1, 1)), ("FR", dt.date(2026, 1, 1)), ("DE", dt.date(2024, 5, 5)), ("XX", None)]
    df = spark.createDataFrame(rows, "country STRING, day DATE")
    chunks = calendar.date_chunks(df, ["country"], "day").orderBy("country", "chunk_start").collect()
    assert [(c.country, str(c.chunk_start), str(c.chunk_end)) for c in chunks] == [
        ("DE", "2024-05-05", "2024-05-05"),
        ("FR", "2020-01-01", "2022-12-31"),
        ("FR", "2023-01-01", "2025-12-31"),
        ("FR", "2026-01-01", "2026-01-01"),
    ]


def test_flags_end_to_end(spark):
    roles = Roles()
    at = lambda m, d, h=9: dt.datetime(2024, m, d, h)
    movements = spark.createDataFrame(
        [
            (1, at(2, 20), "Départ", "CDG"),
            (2, at(2, 20, 9), "Arrivée", "LFRB"),
            (3, at(2, 20, 10), "Arrivée", "LFRB"),
            (4, at(3, 8), "Arrivée", "LFRB"),
            (5, at(7, 14), "Arrivée", "MUC"),
            (6, at(7, 14), "Arrivée", "ZZZ"),
            (7, at(7, 14), "Arrivée", None),
            (8, at(7, 14), "Départ", "MUC"),
        ],
        "IdMovement BIGINT, LTScheduledDatetime TIMESTAMP_NTZ, Direction STRING, AirportPrevious STRING",
    )
    airports = spark.createDataFrame(
        [
            ("LFLX", "LLL", "FR", "Lyon"),
            ("LFRB", "BES", "FR", "Brest / Guipavas"),
            ("EDDM", "MUC", "DE", "Munich"),
            ("", "ZZZ", "DE", "Nowhere"),
        ],
        "icao STRING, iata STRING, country STRING, city STRING",
    )
    public = spark.createDataFrame([("FR", dt.date(2024, 7, 14))] * 2, "country STRING, day DATE")
    foreign = spark.createDataFrame(
        [("DE", dt.date(2024, 7, 1), dt.date(2024, 7, 14))], "country STRING, start DATE, end DATE"
    )
    periods = holidays.zone_periods(zone_records(spark))
    flags = holidays.holiday_flags(
        movements, airports, public, periods, foreign, holidays.zone_lookup(zone_records(spark)), "LLL"
    )
    assert flags.count() == flags.select("day", "AirportDeparture").distinct().count()
    joined = holidays.join_holidays(movements, flags, "LLL", roles)
    found = {r.IdMovement: (r.country, r.IsPublicHolidays, r.IsScholarHolidays) for r in joined.collect()}
    assert found == {
        1: ("FR", 0, 1),
        2: ("FR", 0, 0),
        3: ("FR", 0, 0),
        4: ("FR", 0, 1),
        5: ("DE", 0, 1),
        8: ("FR", 1, 0),
    }
    unknown = holidays.unresolved_codes(movements, airports, "AirportPrevious").collect()
    assert {r[0] for r in unknown} == {"CDG", "ZZZ", None}


def test_missing_country_is_abroad(spark):
    df = spark.createDataFrame([("FR",), ("DE",), (None,)], "country STRING")
    france, abroad = holidays.country_split(df)
    assert france.count() == 1 and abroad.count() == 2


def test_local_time_kinds(spark):
    df = spark.sql(
        "SELECT '2024-01-01 10:00:00' AS a, 'no time' AS b, TIMESTAMP '2024-01-01 10:00:00' AS c,"
        " DATE '2024-01-01' AS d, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS e"
    )
    row = df.select(*[local_time(df, c).alias(c) for c in df.columns]).first()
    ten = dt.datetime(2024, 1, 1, 10)
    assert tuple(row) == (ten, None, ten, dt.datetime(2024, 1, 1), ten)


def test_payloads_with_white_space_and_rejects(spark):
    good = '\n\t[{"startDate": "2024-02-01T00:00", "endDate": "2024-02-09"}, {"startDate": "2024-03-01", "endDate": "2024-03-02"}]\n'
    rows = [("A", good), ("B", "{not json"), ("C", '{"other": 1}'), ("D", '{"holidays": []}')]
    table = spark.createDataFrame(rows, "country string, value string")
    assert payloads.foreign_periods(table).count() == 2
    assert {r.country for r in payloads.rejected_payloads(table).collect()} == {"B", "C"}
    french = spark.createDataFrame([("A", '\n{"results": []}'), ("B", "[]x")], "country string, value string")
    assert [r.country for r in payloads.rejected_payloads(french, french=True).collect()] == ["B"]
