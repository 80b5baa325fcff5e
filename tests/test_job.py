"""Sources, stored tables, models and the whole run."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paxflow import config
from paxflow.job import RunConfig, load_or_prepare, run
from paxflow.operators import model as M
from paxflow.sources import tables

ROLES = config.Roles()


@pytest.fixture(scope="module")
def movements(spark):
    """Sixty days of a few flights; the days to predict have no counts yet."""
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for day in range(62):
        for flight in range(8):
            ts = start + dt.timedelta(days=day, hours=6 + 2 * flight)
            pax = None if day >= 60 else 60 + 10 * flight + rng.randrange(5)
            rows.append(
                (
                    day * 8 + flight,
                    f"F{flight:03d}" if flight else None,
                    ts,
                    "Départ" if flight % 2 else "Arrivée",
                    "T1" if flight < 5 else "T2",
                    f"AC{flight % 3}",
                    f"L{flight % 2}",
                    150 + flight,
                    pax,
                    None if pax is None else flight % 3,
                )
            )
    names = [
        "IdMovement", "FlightNumberNormalized", "LTScheduledDatetime", "Direction", "SysTerminal",
        "IdAircraftType", "airlineOACICode", "NbOfSeats", "NbPaxTotal", "FarmsNbPaxPHMR",
    ]
    given = spark.createDataFrame(
        rows,
        "IdMovement BIGINT, FlightNumberNormalized STRING, LTScheduledDatetime TIMESTAMP_NTZ,"
        " Direction STRING, SysTerminal STRING, IdAircraftType STRING, airlineOACICode STRING,"
        " NbOfSeats INT, NbPaxTotal INT, FarmsNbPaxPHMR INT",
    )
    empty = spark.createDataFrame([], config.MOVEMENTS_DDL)
    kinds = {f.name: f.dataType for f in empty.schema.fields}
    return given.select(
        *[F.col(c) if c in names else F.lit(None).cast(kinds[c]).alias(c) for c in empty.columns]
    )


def test_csv_round_trip_and_projection(spark, movements, tmp_path):
    path = str(tmp_path / "csv")
    tables.write_csv(movements.orderBy("IdMovement"), path)
    back = tables.read_csv(spark, path, config.MOVEMENTS_DDL)
    assert back.count() == movements.count()
    assert back.agg(F.max("LTScheduledDatetime")).first()[0] == dt.datetime(2024, 3, 2, 20)
    parquet = str(tmp_path / "parquet")
    tables.write_parquet(movements.withColumn("unwanted", F.lit(1)), parquet)
    read = tables.read_movements(spark, parquet, newest_first=True)
    assert tuple(read.columns) == config.MOVEMENT_COLUMNS
    assert read.first().LTScheduledDatetime == dt.datetime(2024, 3, 2, 20)


def test_reuse_or_build(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    path = str(tmp_path / "table")
    assert tables.stored(spark, path) is None
    for _ in range(2):
        assert tables.reuse_or_build(spark, path, build).count() == 3
    assert built == [1]

    def broken():
        raise RuntimeError("no source")

    with pytest.raises(RuntimeError):
        tables.reuse_or_build(spark, str(tmp_path / "other"), broken)


def test_feature_count(spark, movements, tmp_path):
    passengers, reduced = load_or_prepare(spark, str(tmp_path), lambda: movements)
    added = set(passengers.columns) - set(movements.columns)
    assert len(added) == 359
    assert "FlightNumberNormalized_lag7_win6_min" in added
    assert "INT_NbOfSeats_x_global_rolling_week_mean" in added
    assert "FarmsNbPaxPHMR" not in passengers.columns and "NbPaxTotal" not in reduced.columns
    assert passengers.count() == movements.count() == reduced.count()


def test_model_is_stored_and_reused(spark, movements, tmp_path):
    rows = movements.where("NbPaxTotal IS NOT NULL").select(
        "IdMovement", "FlightNumberNormalized", "SysTerminal", "NbOfSeats", "NbPaxTotal"
    )
    path = str(tmp_path / "model")
    assert M.Forecaster.load(spark, path) is None
    settings = M.Boosting(rounds=5, depth=3, step=0.5)
    first = M.fit_or_load(path, rows, None, "NbPaxTotal", settings=settings)
    again = M.fit_or_load(path, rows.limit(0), None, "NbPaxTotal", settings=settings)
    a = M.predict(first, rows, "p").orderBy("IdMovement").collect()
    b = M.predict(again, rows, "p").orderBy("IdMovement").collect()
    assert a == b and len(a) == 480
    assert max(abs(r.p - r.NbPaxTotal) for r in a) <= 6
    unseen = rows.limit(1).withColumn("SysTerminal", F.lit("new"))
    assert M.predict(again, unseen, "p").first().p >= 0
    weights = M.top_features(again, 3).collect()
    assert len(weights) == 3 and weights[0].importance >= weights[-1].importance


def test_run(spark, movements, tmp_path):
    cfg = RunConfig(
        run_date=dt.date(2024, 3, 1),
        data_dir=str(tmp_path / "data"),
        model_dir=str(tmp_path / "models"),
        output_dir=str(tmp_path / "out"),
        boosting=M.Boosting(rounds=3, depth=3, step=0.5),
    )
    hourly, flights = run(spark, cfg, lambda: movements)
    assert flights.count() == 16
    rows = hourly.collect()
    assert len(rows) == 24 + 15
    assert [r.LTScheduledDatetime for r in rows] == sorted(r.LTScheduledDatetime for r in rows)
    assert sum(r.PredNbPaxTotal for r in rows) == sum(r.PredNbPaxTotal for r in flights.collect())
    assert list((tmp_path / "out" / "hourly_predictions_2024-03-01").glob("part-*.csv"))


def test_run_with_holidays_and_versions(spark, movements, tmp_path):
    """Older versions of rows do not count, flags are inputs, stored data sets are used again, and a rerun of a
    day leaves other days alone."""
    source = str(tmp_path / "source")
    movements = movements.withColumn("AirportPrevious", F.lit("CDG"))
    older = movements.where("IdMovement % 5 = 0").withColumns({"NbPaxTotal": F.lit(9_999), "IdADL": F.lit(0).cast("long")})
    versions = movements.withColumn("IdADL", F.lit(1).cast("long")).unionByName(older)
    versions.write.parquet(source)
    days = movements.select(F.to_date("LTScheduledDatetime").alias("day")).distinct()
    flags = days.select(
        "day",
        F.explode(F.array(F.lit("NCE"), F.lit("CDG"))).alias("AirportDeparture"),
        (F.dayofweek("day") == 1).cast("int").alias("IsPublicHolidays"),
        F.lit(0).alias("IsScholarHolidays"),
    )
    asked = []

    def ingest():
        asked.append(1)
        return spark.read.parquet(source)

    def config(day):
        return RunConfig(
            run_date=day,
            data_dir=str(tmp_path / "data"),
            model_dir=str(tmp_path / "models"),
            output_dir=str(tmp_path / "out"),
            force_train=False,
            boosting=M.Boosting(rounds=2, depth=2, step=0.5),
            flags=flags,
            home="NCE",
            newest=("IdADL",),
            sources=(source,),
            source_schema=movements.schema,
        )

    first = run(spark, config(dt.date(2024, 3, 1)), ingest)[1]
    assert first.count() == 16 and first.agg(F.max("PredNbPaxTotal")).first()[0] < 500
    run(spark, config(dt.date(2024, 2, 29)), ingest)
    run(spark, config(dt.date(2024, 3, 1)), ingest)
    assert len(asked) == 1
    stored = spark.read.parquet(str(tmp_path / "out" / "flight_predictions")).groupBy("run_date").count()
    assert {r.run_date.day: r["count"] for r in stored.collect()} == {1: 16, 29: 16}
    how = {"flags": flags, "home": "NCE", "newest": ["IdADL"], "sources": [source], "schema": movements.schema}
    passengers, reduced = load_or_prepare(spark, str(tmp_path / "data"), ingest, **how)
    assert passengers.count() == movements.count() == reduced.count() and len(asked) == 1
    assert {"IsPublicHolidays", "IsScholarHolidays"} <= set(passengers.columns) & set(reduced.columns)
    sundays, flights = 8, 8
    assert passengers.where("IsPublicHolidays = 1").count() == sundays * flights
