"""Versions that are whole or absent, sources that change, rejected lines, dated outputs, pages."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from paxflow.job import unique_rows
from paxflow.operators import model as M
from paxflow.sources import store, tables
from paxflow.sources.holidays import zone_pages


def test_a_writer_that_dies_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path)
    assert store.latest(spark, path) is None

    def broken(folder):
        spark.range(5).write.parquet(f"{folder}/table")
        raise OSError("lost")

    with pytest.raises(OSError):
        store.publish(spark, path, broken)
    assert store.latest(spark, path) is None
    first = store.publish(spark, path, lambda folder: spark.range(3).write.parquet(f"{folder}/table"))
    with pytest.raises(OSError):
        store.publish(spark, path, broken)
    assert store.latest(spark, path) == first and first.number == 1
    assert store.read_version(spark, first).count() == 3


def test_reuse_notices_what_changed(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "store")
    spark.range(4).write.parquet(source)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(source).agg(F.count("*").alias("n"))

    def again(schema=spark.range(1).schema, settings=""):
        version = store.reuse(spark, path, build, [source], schema, settings)
        return version.number, store.read_version(spark, version).first().n

    assert [again(), again()] == [(1, 4), (1, 4)]
    spark.range(2).write.mode("append").parquet(source)
    assert [again(), again()] == [(2, 6), (2, 6)]
    spark.range(6).coalesce(1).write.mode("overwrite").parquet(source)
    assert again() == (3, 6)
    assert again(settings="other") == (4, 6)
    assert again(schema=spark.createDataFrame([], "id INT").schema) == (5, 6)
    assert len(built) == 5


def test_changed_files(spark):
    day = dt.datetime(2024, 1, 1)
    schema = "file STRING, bytes LONG, modified TIMESTAMP"
    before = spark.createDataFrame([("a", 1, day), ("b", 2, day), ("c", 3, day)], schema)
    later = day + dt.timedelta(seconds=1)
    after = spark.createDataFrame([("a", 1, day), ("b", 2, later), ("d", 3, day)], schema)
    found = {r.file: r.change for r in store.changed_files(before, after).collect()}
    assert found == {"b": "rewritten", "c": "removed", "d": "added"}


def test_rejected_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,day,name\n1,2024-01-01,a\nx,2024-01-01,b\n3,never,c\n4,2024-01-04\n5,2024-01-05,"d,e"\n6,2024-01-06,f,g\n7,,\n')
    good, bad = tables.read_csv_checked(spark, str(path), "id LONG, day DATE, name STRING")
    assert [(r.id, r.name) for r in good.orderBy("id").collect()] == [(1, "a"), (5, "d,e"), (7, None)]
    lines = {r.line for r in bad.collect()}
    assert lines == {"x,2024-01-01,b", "3,never,c", "4,2024-01-04", "6,2024-01-06,f,g"}
    assert all(r.file.endswith("in.csv") for r in bad.collect())


def test_a_rerun_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path)
    days = [dt.date(2024, 3, d) for d in (1, 2)]
    for n, day in ((2, days[0]), (3, days[1]), (5, days[0])):
        tables.write_dated(spark.range(n), path, day)
    found = spark.read.parquet(path).groupBy("run_date").count().collect()
    assert {r.run_date: r["count"] for r in found} == {days[0]: 5, days[1]: 3}


def test_the_newest_version_of_a_row(spark):
    rows = [(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, None, "d"), (2, 0, "e"), (3, None, "f"), (None, 1, "g"), (None, 2, "h")]
    df = spark.createDataFrame(rows + rows, "key INT, version INT, cell STRING").repartition(3)
    found = unique_rows(df, "key", ["version"])
    assert found.columns == df.columns
    assert {(r.key, r.cell) for r in found.collect()} == {(1, "b"), (2, "e"), (3, "f"), (None, "h")}
    ties = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "key INT, version INT, cell STRING")
    one = unique_rows(ties, "key", ["version"]).collect()
    assert one == unique_rows(ties.repartition(5), "key", ["version"]).collect() and len(one) == 1


def test_a_cut_page_is_reported(spark):
    def page(total, n):
        entry = {"description": "x", "start_date": "2024-01-01", "end_date": "2024-01-02"}
        return json.dumps({"total_count": total, "results": [entry] * n})

    texts = [("A", page(3, 2)), ("A", page(3, 1)), ("B", page(3, 2)), ("C", page(2, 2)), ("C", page(2, 2)[:40])]
    texts += [("D", page(0, 0)), ("E", None), ("F", "[]"), ("G", page(2, 2)), ("G", page(2, 2))]
    records, account = zone_pages(spark.createDataFrame(texts, "zone STRING, value STRING"))
    complete = {r.zone: r.complete for r in account.collect()}
    assert complete == {"A": True, "B": False, "C": False, "D": True, "E": False, "F": False, "G": False}
    assert {r.zone: r["count"] for r in records.groupBy("zone").count().collect()} == {"A": 3, "B": 2, "C": 2, "G": 4}


SETTINGS = M.Boosting(rounds=12, depth=2, step=0.7, patience=2, max_bins=8)


@pytest.fixture(scope="module")
def sets(spark):
    kind, flight = F.col("id") % 5, F.col("id") % 40
    rows = spark.range(1200).select(
        F.col("id").alias("IdMovement"),
        F.concat(F.lit("k"), kind.cast("string")).alias("kind"),
        F.when(flight > 0, F.concat(F.lit("f"), flight.cast("string"))).alias("flight"),
        (F.col("id") % 3).alias("seats"),
        # Not in the order of the names: a split by sets is needed.
        (F.element_at(F.array(*map(F.lit, (90, 10, 70, 20, 50))), (kind + 1).cast("int")) + flight % 4).alias("NbPaxTotal"),
    )
    return rows.where("id % 4 != 0"), rows.where("id % 4 = 0")


def test_rounds_are_chosen_by_the_validation_error(spark, sets):
    train, valid = sets
    model = M.fit(train, valid, "NbPaxTotal", SETTINGS)
    told = [r.mae for r in model.errors.orderBy("round").collect()]
    assert len(told) == 12
    # By hand: the error of the first n trees, one model per n.
    rows = model.describe(valid).toPandas()
    for n in (1, 2, 7, 12):
        plain = sum(
            w * rows.features.map(tree.predict) for tree, w in zip(model.trees.trees[:n], model.trees.treeWeights)
        )
        assert abs((plain - rows.NbPaxTotal).abs().mean() - told[n - 1]) < 1e-9
    best, since = 0, 0
    for i, error in enumerate(told):
        best, since = (i, 0) if i == 0 or error < told[best] else (best, since + 1)
        if since == SETTINGS.patience:
            break
    assert model.rounds == best + 1
    found = M.predict(model, valid, "p").select("NbPaxTotal", "p").toPandas()
    assert (found.p - found.NbPaxTotal).abs().mean() < 5


@pytest.mark.parametrize(
    "errors, patience, chosen, stop",
    [([5, 4, 3], 2, 3, None), ([5, 4, 4, 4, 1], 2, 2, 4), ([1, 2, 3, 0], 2, 1, 3), ([1, 2, 3, 0], 3, 4, None), ([1, 2, 3, 4, 0], 3, 1, 4), ([1, 2, 0.5, 9, 9], 2, 3, 5), ([2, 2, 2], 9, 1, None)],
)
def test_stopping(spark, errors, patience, chosen, stop):
    rows = [(i + 1, float(e)) for i, e in enumerate(errors)]
    found = M.stopping(spark.createDataFrame(rows, "round INT, mae DOUBLE"), patience).orderBy("round").collect()
    assert {r.chosen for r in found} == {chosen}
    assert [r.round for r in found if r.stopped] == ([] if stop is None else list(range(stop, len(errors) + 1)))


def test_categories_are_nominal(spark, sets):
    train, valid = sets
    model = M.fit(train, None, "NbPaxTotal", SETTINGS)
    assert model.text == ("kind", "flight") and model.meant == ("flight",)
    index = {(r.source, r.category): r.code for r in model.index.collect()}
    assert sum(s == "flight" for s, _ in index) == 7 and {index["kind", f"k{i}"] for i in range(5)} == {1, 2, 3, 4, 5}
    kind = model.describe(train).schema["features"].metadata["ml_attr"]["attrs"]
    assert {a["name"]: a["num_vals"] for a in kind["nominal"]} == {"_in_kind": 8, "_in_flight": 8}
    tree = model.trees.trees[0].toDebugString
    assert " in {" in tree
    # One split by a set parts what no order of names or codes would.
    unseen = valid.withColumn("kind", F.lit("new")).withColumn("flight", F.lit(None).cast("string"))
    assert M.predict(model, unseen, "p").where("p IS NULL OR p < 0").count() == 0


def test_a_model_is_whole_or_absent(spark, sets, tmp_path, monkeypatch):
    train, valid = sets
    path = str(tmp_path / "model")
    model = M.fit(train, valid, "NbPaxTotal", SETTINGS)
    kind = type(model.trees)

    def lost(self):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(kind, "write", lost)
        with pytest.raises(OSError):
            model.save(path)
    assert M.Forecaster.load(spark, path) is None
    model.save(path)
    back = M.Forecaster.load(spark, path)
    assert (back.rounds, back.inputs, back.meant) == (model.rounds, model.inputs, model.meant)
    again = M.predict(back, valid, "p").orderBy("IdMovement").collect()
    assert again == M.predict(model, valid, "p").orderBy("IdMovement").collect()
    assert back.errors.count() == 12
    with monkeypatch.context() as broken:
        broken.setattr(kind, "write", lost)
        with pytest.raises(OSError):
            model.save(path)
    assert M.Forecaster.load(spark, path).rounds == model.rounds


def test_no_training_row(spark, sets):
    with pytest.raises(ValueError, match="no training row"):
        M.fit(sets[0].where("false"), None, "NbPaxTotal", SETTINGS)
