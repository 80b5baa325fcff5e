"""All history of a row passes through shuffles and joins as one column."""

from __future__ import annotations

import datetime

from paxflow.config import Roles
from paxflow.operators.features import add_features
from paxflow.operators.lags import history_columns, history_packed
from paxflow.operators.rolling import packed_name

ROLES = Roles(time="ts", row_id="id", target="pax", flight="flight", seats="seats", groups=("flight",))
DDL = "id LONG, ts TIMESTAMP_NTZ, flight STRING, pax INT, seats INT"


def rows(spark):
    day = datetime.datetime(2024, 1, 1)
    days = [(1, 0), (2, 7), (3, 31), (4, 400)]
    return spark.createDataFrame([(i, day + datetime.timedelta(days=d), "f", 10 * i, 2) for i, d in days], DDL)


def test_history_is_one_array_with_gaps(spark):
    packed = history_packed(rows(spark), ["flight"], ROLES)
    assert packed.columns == ["id", packed_name(["flight"], "history")]
    found = {r.id: r.asDict() for r in packed.selectExpr("id", *history_columns(["flight"])).collect()}
    # A week before row 2 is row 1, alone in its window; a month before row 3 is row 1.
    assert found[2]["flight_lag_1week_raw"] == 10 and found[2]["flight_lag7_win6_mean"] == 10
    assert found[2]["flight_lag7_win6_std"] is None and found[2]["flight_lag_1month_raw"] is None
    assert found[3]["flight_lag_1month_raw"] == 10 and found[3]["flight_lag30_win14_mean"] is None
    assert set(found[4].values()) == {4, None} and len(found) == 4


def test_joins_of_the_feature_set_carry_few_columns(spark):
    out = add_features(rows(spark), ROLES)
    plan = out._jdf.queryExecution().optimizedPlan()
    joins = [plan] if plan.nodeName() == "Join" else []
    todo = [plan]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        joins += [node] * (node.nodeName() == "Join")
    # Rows of five columns and an array each for history and rolling, overall and per flight.
    assert joins and max(j.output().size() for j in joins) <= 5 + 4 + 2
    assert out.columns[:6] == ["id", "ts", "flight", "pax", "seats", "Year"]
    assert {r.id for r in out.collect()} == {1, 2, 3, 4}
