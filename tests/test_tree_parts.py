"""Trees are trained on partitions of bounded size, whatever the files their rows come from."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from paxflow.config import Roles
from paxflow.operators import model as M

ROLES = Roles(time="ts", row_id="id", target="pax", flight="flight", groups=())


def parts_of(df) -> list[int]:
    return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_stored_rows_are_dealt_evenly_and_all_of_them(spark, monkeypatch):
    monkeypatch.setattr(M, "TREE_ROWS", 100)
    rows = M.staged(spark.range(1001).selectExpr("id", "if(id < 500, NULL, 1) AS label").coalesce(1), "tree-parts")
    even = M.even_parts(rows, ["label", "id"])
    sizes = parts_of(even)
    assert len(sizes) == 11 and max(sizes) <= 110
    assert sorted(r.id for r in even.collect()) == list(range(1001))
    few = rows.limit(100)
    assert M.even_parts(few, ["id"]) is few  # a small table stays as it is
    assert M.even_parts(rows.limit(0), ["id"]).count() == 0


def test_fit_trains_on_bounded_partitions(spark, monkeypatch):
    seen = []

    class Seen(GBTRegressor):
        def fit(self, table):
            seen.append(parts_of(table))
            return super().fit(table)

    monkeypatch.setattr(M, "TREE_ROWS", 150)
    monkeypatch.setattr(M, "GBTRegressor", Seen)
    rows = spark.range(900).selectExpr("id", "concat('f', id % 9) AS flight", "CAST(id % 50 AS INT) AS seats",
                                       "CAST(if(id % 90 = 0, NULL, id % 50 + id % 9) AS INT) AS pax")
    model = M.fit(rows.coalesce(1), None, "pax", M.Boosting(rounds=2, depth=3), ROLES)
    assert sum(seen[0]) == 890 and len(seen[0]) == 6 and max(seen[0]) <= 160
    assert M.predict(model, rows, "found").where("found >= 0").count() == 900
