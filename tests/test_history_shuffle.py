"""History is looked up in slices of time: what is shuffled does not grow with the number of lookups."""

from __future__ import annotations

import datetime

import pytest

from paxflow.config import Roles
from paxflow.operators import lags as L
from paxflow.operators.features import add_features

ROLES = Roles(time="ts", row_id="id", target="pax", flight="flight", seats="seats", groups=("flight",))
DDL = "id LONG, ts TIMESTAMP_NTZ, flight STRING, pax INT, seats INT"


def rows(spark):
    """Two years and a leap day, month ends, a flight without a name, a time that is missing, ties."""
    start, out = datetime.datetime(2023, 12, 20, 8), []
    for i in range(240):
        flight = [None, "a", "b"][i % 3]
        when = None if i == 50 else start + datetime.timedelta(days=i * 37 % 800, minutes=i % 2)
        out.append((i, when, flight, None if i % 11 == 0 else i * i % 97, 2))
    return spark.createDataFrame(out, DDL)


def nodes(plan):
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        found.append(node)
    return found


def test_a_minute_is_shuffled_alone_not_once_a_lookup(spark):
    plan = L.history_table(rows(spark), ["flight"], roles=ROLES)._jdf.queryExecution().optimizedPlan()
    assert not [n for n in nodes(plan) if n.nodeName() == "Join"]
    dealt = [n for n in nodes(plan) if n.nodeName() == "RepartitionByExpression"]
    assert [n.output().size() for n in dealt] == [4]  # flight, minute, value, slice


@pytest.mark.parametrize("most", [0, 10**6])
def test_features_do_not_depend_on_how_history_is_attached(spark, monkeypatch, most):
    monkeypatch.setattr(L, "BROADCAST_ROWS", most)
    df = rows(spark)
    out = add_features(df, ROLES)
    wanted = {
        r.id: r.asDict()
        for keys in ([], ["flight"])
        for r in L.history_stats(df, keys, ROLES).collect()
    }
    names = [n.split(" AS ")[1].strip("`") for n in L.history_columns(["flight"])]
    found = {r.id: r for r in out.collect()}
    assert len(found) == 240
    assert all(found[i][n] == wanted[i][n] for i in found for n in names)
    assert any(wanted[i][n] is not None for i in found for n in names)
    assert all(found[50][n] is None for n in names)
    twice = add_features(df.union(df.where("id = 7")), ROLES)  # an id that repeats, as it always was
    assert twice.where("id = 7").count() == 2 * 2 ** 4 and twice.count() == 239 + 32
    order = [c for c in out.columns if "_lag_" in c or "_win" in c]
    assert order[:5] == [f"global_lag_{n}_raw" for n in ("1year", "6months", "3months", "1month", "1week")]
