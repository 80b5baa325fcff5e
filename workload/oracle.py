"""The queries' results stated as SQL over the same tables."""

from __future__ import annotations

from paxflow.config import CITY_DISTRICT, LAGGED_WINDOWS, LAGS, MOMENTUM_PAIRS, ROLLING_ROWS
from paxflow.config import CYCLES

ORACLE: dict[str, str] = {}

#: Digits that double columns are compared by.
DIGITS = 6

STATS = {
    "mean": "avg({v})",
    "min": "min({v})",
    "max": "max({v})",
    "std": "stddev_samp({v})",
    "median": "median({v})",
}

EVENTS = """(
    SELECT event_id AS id, ts, event_type AS terminal, CAST(user_id AS VARCHAR) AS flight,
           CASE WHEN user_id % 2 = 0 THEN 'Départ' ELSE 'Arrivée' END AS direction,
           CAST(round_even(value, 0) AS INT) AS pax,
           CAST(round_even(value / 50, 0) AS INT) AS reduced
    FROM events)"""

ORDERS = """(
    SELECT o_orderkey AS id, o_orderdate AS ts, o_orderpriority AS terminal,
           CAST(o_custkey AS VARCHAR) AS flight, o_orderstatus AS direction,
           CAST(round_even(o_totalprice / 1000, 0) AS INT) AS pax,
           CAST(o_custkey % 200 + 50 AS INT) AS seats
    FROM orders)"""

PREDICTED = """(
    SELECT CAST(user_id AS VARCHAR) AS flight, ts, value,
           CAST(greatest(0.0, round_even(value * 0.9::DOUBLE + 5, 0)) AS INT) AS pred_pax,
           CAST(greatest(0.0, round_even(value / 60 - 1, 0)) AS INT) AS pred_reduced
    FROM events)"""


def r(expression: str, name: str) -> str:
    """Rounded like ``views.rounded``."""
    scale = f"1e{DIGITS}"
    return f"round_even(CAST({expression} AS DOUBLE) * {scale}, 0) / {scale} + 0.0 AS {name}"


def partition(keys: list[str]) -> str:
    return f"PARTITION BY {', '.join(keys)}" if keys else ""


def prefix(keys: list[str]) -> str:
    return "_".join(keys) or "global"


# --- calendar ---

_PARTS = {
    "Minute": "minute(ts)",
    "Hour": "hour(ts)",
    "Month": "month(ts)",
    "DayOfWeek": "(isodow(ts) - 1)",
    "Hour_Of_Week": "((isodow(ts) - 1) * 24 + hour(ts))",
}


def date_columns() -> str:
    waves = []
    for part, period in CYCLES.items():
        angle = f"2 * pi() * {_PARTS[part]} / {period}"
        waves += [r(f"sin({angle})", f"sin_{part}"), r(f"cos({angle})", f"cos_{part}")]
    return ", ".join(
        [
            "CAST(year(ts) AS INT) AS Year",
            "CAST(CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END AS INT) AS Semester",
            "CAST(quarter(ts) AS INT) AS Quarter",
            "CAST(day(ts) AS INT) AS Day",
            *waves,
        ]
    )


ORACLE["date_features"] = f"SELECT id, ts, {date_columns()} FROM {EVENTS}"

ORACLE["date_chunks"] = f"""
WITH r AS (SELECT flight, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day
           FROM {ORDERS} GROUP BY flight),
c AS (SELECT *, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1096 DAY)) AS DATE)
             AS chunk_start FROM r)
SELECT flight, first_day, last_day, chunk_start,
       least(chunk_start + 1095, last_day) AS chunk_end FROM c
"""


# --- lags and lagged windows ---


def history(view: str, keys: list[str], lags: dict, windows: dict, name: str = "h") -> list[str]:
    """CTEs ending in ``{name}``: every row of the view with its history features, unrounded."""
    on = "".join(f" AND b.{k} IS NOT DISTINCT FROM {{t}}.{k}" for k in keys)
    key_list = "".join(f"{k}, " for k in keys)
    ctes = [
        f"{name}_m AS (SELECT {key_list} date_trunc('minute', ts) AS minute, avg(pax) AS v"
        f" FROM {view} GROUP BY {key_list} date_trunc('minute', ts))"
    ]
    columns, joins = [], []
    for i, (lag, by) in enumerate(lags.items()):
        ctes.append(
            f"{name}_l{i} AS (SELECT {key_list} minute + INTERVAL {by} AS at,"
            f" max_by(v, minute) AS v FROM {name}_m GROUP BY {key_list} minute + INTERVAL {by})"
        )
        joins.append(
            f"LEFT JOIN {name}_l{i} ON b.minute = {name}_l{i}.at" + on.format(t=f"{name}_l{i}")
        )
        columns.append(f"{name}_l{i}.v AS {prefix(keys)}_lag_{lag}_raw")
    for i, (window, (delay, days)) in enumerate(windows.items()):
        half = days * 43200
        frame = (
            f"OVER ({partition(keys)} ORDER BY minute RANGE BETWEEN"
            f" INTERVAL '{half * 1_000_000 - 1} microseconds' PRECEDING AND"
            f" INTERVAL {half} SECONDS FOLLOWING)"
        )
        stats = ", ".join(f"{f.format(v='v')} {frame} AS {s}" for s, f in STATS.items())
        ctes.append(
            f"{name}_w{i} AS (SELECT {key_list} minute + INTERVAL {delay} DAY AS at, {stats}"
            f" FROM {name}_m)"
        )
        joins.append(
            f"LEFT JOIN {name}_w{i} ON b.minute = {name}_w{i}.at" + on.format(t=f"{name}_w{i}")
        )
        columns += [f"{name}_w{i}.{s} AS {prefix(keys)}_{window}_{s}" for s in STATS]
    ctes.append(
        f"{name} AS (SELECT b.id, {', '.join(columns)} FROM"
        f" (SELECT *, date_trunc('minute', ts) AS minute FROM {view}) b {' '.join(joins)})"
    )
    return ctes


def history_names(keys: list[str], lags: dict, windows: dict) -> list[str]:
    return [f"{prefix(keys)}_lag_{n}_raw" for n in lags] + [
        f"{prefix(keys)}_{w}_{s}" for w in windows for s in STATS
    ]


def history_query(view: str, keys: list[str], lags: dict, windows: dict) -> str:
    cells = ", ".join(r(c, c) for c in history_names(keys, lags, windows))
    return f"WITH {', '.join(history(view, keys, lags, windows))} SELECT id, {cells} FROM h"


WEEK = {"1week": "7 days"}
ORACLE["lag_raw_global"] = history_query(ORDERS, [], LAGS, {})
ORACLE["lag_raw_by_terminal"] = history_query(ORDERS, ["terminal"], LAGS, {})
ORACLE["lag_raw_by_minute"] = history_query(EVENTS, [], WEEK, {})
ORACLE["lagged_rolling_global"] = history_query(ORDERS, [], {}, LAGGED_WINDOWS)
ORACLE["lagged_rolling_by_terminal"] = history_query(ORDERS, ["terminal"], {}, LAGGED_WINDOWS)
ORACLE["lagged_rolling_by_minute"] = history_query(
    EVENTS, ["terminal"], {}, {"lag7_win6": (7, 6), "lag1_win2": (1, 2)}
)


# --- rolling, trend, momentum, interactions ---


def rolling(view: str, keys: list[str], stats=tuple(STATS)) -> str:
    """Every row of the view with its rolling features, unrounded."""
    cells = [
        f"{STATS[s].format(v='pax')} OVER ({partition(keys)} ORDER BY ts, id"
        f" ROWS BETWEEN {n + 1} PRECEDING AND 2 PRECEDING) AS {prefix(keys)}_rolling_{w}_{s}"
        for w, n in ROLLING_ROWS.items()
        for s in stats
    ]
    return f"SELECT id, {', '.join(cells)} FROM {view}"


def rolling_names(keys: list[str]) -> list[str]:
    return [f"{prefix(keys)}_rolling_{w}_{s}" for w in ROLLING_ROWS for s in STATS]


def rolling_query(view: str, keys: list[str]) -> str:
    cells = ", ".join(r(c, c) for c in rolling_names(keys))
    return f"SELECT id, {cells} FROM ({rolling(view, keys)})"


def momentum_cells(keys: list[str]) -> list[str]:
    p = prefix(keys)
    return [
        r(f"{p}_rolling_{a}_mean / nullif({p}_rolling_{b}_mean, 0)", f"{p}_momentum_{a}_vs_{b}")
        for a, b in MOMENTUM_PAIRS
    ]


ORACLE["rolling_global"] = rolling_query(EVENTS, [])
ORACLE["rolling_by_terminal"] = rolling_query(ORDERS, ["terminal"])
SPIKED = f"""(
    SELECT * REPLACE (CASE WHEN id % 997 = 0 THEN 1000000000 ELSE pax END AS pax) FROM {ORDERS})"""
ORACLE["rolling_spike"] = f"""
SELECT id, {", ".join(
    f"CASE WHEN terminal_rolling_{w}_max < 1000000 THEN {r(f'terminal_rolling_{w}_{s}', f'terminal_rolling_{w}_{s}').rsplit(' AS ', 1)[0]} END"
    f" AS terminal_rolling_{w}_{s}"
    for w in ROLLING_ROWS for s in ("mean", "std"))}
FROM ({rolling(SPIKED, ["terminal"])})
"""
ORACLE["rolling_by_flight"] = rolling_query(EVENTS, ["flight"])
ORACLE["shift_by_terminal"] = f"""
SELECT id, ts, terminal, pax,
       lag(pax) OVER (PARTITION BY terminal ORDER BY ts, id) AS pax_before FROM {EVENTS}
"""
ORACLE["momentum_by_terminal"] = (
    f"SELECT id, {', '.join(momentum_cells(['terminal']))}"
    f" FROM ({rolling(ORDERS, ['terminal'], ('mean',))})"
)


def trend_query(view: str, keys: list[str], short: int, long: int) -> str:
    cells = []
    for name, days in (("s", short), ("l", long)):
        frame = (
            f"OVER ({partition(keys)} ORDER BY ts RANGE BETWEEN INTERVAL {days} DAY PRECEDING"
            f" AND INTERVAL '1 microsecond' PRECEDING)"
        )
        cells += [f"{f.format(v='v')} {frame} AS {name}_{s}" for s, f in STATS.items()]
    out = [
        r(
            f"CASE WHEN l_{s} > 0 THEN s_{s} / l_{s} ELSE 1.0 END",
            f"{prefix(keys)}_trend_{short}D_vs_{long}D_{s}",
        )
        for s in STATS
    ]
    key_list = "".join(f"{k}, " for k in keys)
    return f"""
WITH b AS (SELECT id, ts, {key_list} lag(pax) OVER ({partition(keys)} ORDER BY ts, id) AS v
           FROM {view}),
w AS (SELECT id, {', '.join(cells)} FROM b)
SELECT id, {', '.join(out)} FROM w
"""


ORACLE["trend_by_terminal"] = trend_query(EVENTS, ["terminal"], 2, 7)
ORACLE["trend_global"] = trend_query(ORDERS, [], 7, 30)

ORACLE["interactions"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS seats, p_retailprice AS price_mean,
       p_size AS size_mean, l_tax AS tax_max,
       {r('l_quantity * p_retailprice', 'INT_seats_x_price_mean')},
       {r('l_quantity * p_size', 'INT_seats_x_size_mean')}
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def feature_set_query() -> str:
    ctes, cells, joins = [], [], []
    for i, keys in enumerate(([], ["terminal"], ["flight"])):
        ctes += history(ORDERS, keys, LAGS, LAGGED_WINDOWS, f"h{i}")
        ctes.append(f"r{i} AS ({rolling(ORDERS, keys)})")
        joins += [f"JOIN h{i} ON o.id = h{i}.id", f"JOIN r{i} ON o.id = r{i}.id"]
        names = history_names(keys, LAGS, LAGGED_WINDOWS) + rolling_names(keys)
        cells += [r(c, c) for c in names] + momentum_cells(keys)
        cells += [r(f"seats * {c}", f"INT_seats_x_{c}") for c in names if "_mean" in c]
    return (
        f"WITH {', '.join(ctes)} SELECT o.id, ts, terminal, flight, direction, pax, seats,"
        f" {date_columns()}, {', '.join(cells)} FROM {ORDERS} o {' '.join(joins)}"
    )


ORACLE["feature_set"] = feature_set_query()


# --- hourly totals and sums ---

ORACLE["hourly_filled"] = f"""
WITH h AS (SELECT date_trunc('hour', ts) AS hour, sum(pax) AS pax, sum(reduced) AS reduced
           FROM {EVENTS} GROUP BY 1),
s AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS ts FROM h)
SELECT s.ts, CAST(coalesce(pax, 0) AS BIGINT) AS pax, CAST(coalesce(reduced, 0) AS BIGINT) AS reduced
FROM s LEFT JOIN h ON s.ts = h.hour
"""
ORACLE["hourly_filled_by_flight"] = f"""
WITH h AS (SELECT flight, date_trunc('hour', ts) AS hour, sum(pax) AS pax FROM {EVENTS} GROUP BY 1, 2),
s AS (SELECT flight, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS ts
      FROM h GROUP BY flight)
SELECT s.ts, s.flight, CAST(coalesce(pax, 0) AS BIGINT) AS pax
FROM s LEFT JOIN h ON s.ts = h.hour AND s.flight = h.flight
"""
ORACLE["hourly_of_day"] = f"""
SELECT CAST(hour(ts) AS INT) AS Heure, CAST(sum(pax) AS BIGINT) AS pax,
       CAST(sum(reduced) AS BIGINT) AS reduced FROM {EVENTS} GROUP BY 1
"""
ORACLE["by_dims_grouping_sets"] = f"""
WITH e AS (SELECT CAST(hour(ts) AS INT) AS Heure, * FROM {EVENTS})
SELECT Heure, terminal, direction,
       concat_ws('+', CASE WHEN grouping(Heure) = 0 THEN 'Heure' END,
                      CASE WHEN grouping(terminal) = 0 THEN 'terminal' END,
                      CASE WHEN grouping(direction) = 0 THEN 'direction' END) AS level,
       CAST(sum(pax) AS BIGINT) AS pax, CAST(sum(reduced) AS BIGINT) AS reduced
FROM e GROUP BY GROUPING SETS ((Heure), (Heure, terminal), (direction), (Heure, terminal, direction))
"""


# --- forecasts against actuals ---

ORACLE["merge_predictions"] = f"""
SELECT a.flight, a.ts, a.pred_pax, b.pred_reduced
FROM {PREDICTED} a JOIN {PREDICTED} b ON a.flight = b.flight AND a.ts = b.ts
WHERE right(b.flight, 1) NOT IN ('3', '7')
"""
ORACLE["forecast_join"] = f"""
SELECT e.*, p.pred_pax FROM {EVENTS} e
LEFT JOIN (
    SELECT flight, CASE WHEN right(flight, 1) = '5' THEN ts + INTERVAL 1 SECOND ELSE ts END AS ts, pred_pax
    FROM {PREDICTED}
    UNION ALL SELECT flight, ts, pax FROM {ORDERS}
) p ON e.flight = p.flight AND e.ts = p.ts
"""
ORACLE["forecast_join_day"] = f"""
SELECT e.*, p.pred_pax FROM {EVENTS} e JOIN {PREDICTED} p ON e.flight = p.flight AND e.ts = p.ts
WHERE CAST(e.ts AS DATE) = DATE '2024-01-15'
"""
COMPARED = f"""(
    SELECT e.*, p.pred_pax, p.pred_reduced
    FROM {EVENTS} e JOIN {PREDICTED} p ON e.flight = p.flight AND e.ts = p.ts)"""
_ERRORS = ", ".join(
    [
        "count(*) AS rows",
        r("sum(pax)", "total_actual"),
        r("sum(pred_pax)", "total_predicted"),
        r("sum(pred_pax) - sum(pax)", "difference"),
        r("sum(pred_pax)::DOUBLE / nullif(sum(pax), 0) * 100", "ratio_percent"),
        r("avg(abs(pax - pred_pax))", "mae"),
        r("sqrt(avg((pax - pred_pax) * (pax - pred_pax)))", "rmse"),
        r(
            "1 - sum((pax - pred_pax) * (pax - pred_pax))::DOUBLE / nullif(var_pop(pax) * count(*), 0)",
            "r2",
        ),
    ]
)
ORACLE["metrics_global"] = f"SELECT {_ERRORS} FROM {COMPARED}"
ORACLE["metrics_by_terminal"] = f"SELECT terminal, {_ERRORS} FROM {COMPARED} GROUP BY terminal"


def level_cells(actual: str, predicted: str) -> str:
    a, p = f"sum({actual})", f"sum({predicted})"
    return ", ".join(
        [
            f"CAST({a} AS BIGINT) AS {actual}",
            f"CAST({p} AS BIGINT) AS {predicted}",
            r(f"abs({p} - {a})::DOUBLE / nullif({a}, 0)", "WAPE"),
            r(f"{p}::DOUBLE / nullif({a}, 0) * 100", "Ratio_Pred"),
        ]
    )


ORACLE["metrics_levels"] = f"""
WITH c AS (SELECT *, CAST(ts AS DATE) AS Jour, CAST(hour(ts) AS INT) AS Heure FROM {COMPARED})
SELECT Jour, Heure, concat_ws('+', CASE WHEN grouping(Jour) = 0 THEN 'Jour' END,
                                   CASE WHEN grouping(Heure) = 0 THEN 'Heure' END) AS level,
       {level_cells('pax', 'pred_pax')}
FROM c GROUP BY GROUPING SETS ((), (Jour), (Heure))
"""
ORACLE["metrics_daily"] = f"""
SELECT CAST(ts AS DATE) AS Jour, {level_cells('reduced', 'pred_reduced')} FROM {COMPARED} GROUP BY 1
"""
ORACLE["metrics_hourly"] = f"""
SELECT CAST(hour(ts) AS INT) AS Heure, {level_cells('reduced', 'pred_reduced')}
FROM {COMPARED} GROUP BY 1
"""
ORACLE["metrics_preview"] = f"""
SELECT CAST(hour(ts) AS INT) AS Heure, {level_cells('pax', 'pred_pax')}
FROM {COMPARED} GROUP BY 1 ORDER BY 1 LIMIT 5
"""
ORACLE["top_errors"] = f"""
SELECT id, flight, ts, pax, pred_pax, abs(pax - pred_pax) AS Abs_Error
FROM {COMPARED} ORDER BY abs(pax - pred_pax) DESC, id LIMIT 10
"""
ORACLE["assigned_terminals"] = f"SELECT * FROM {EVENTS} WHERE terminal <> 'error'"


# --- staffing ---


def plan(keys: list[str]) -> str:
    """CTEs ending in ``plan``."""
    extra = "".join(f"{k}, " for k in keys)
    matched = "".join(f" AND d.{k} = h.{k}" for k in keys)
    picked = "".join(f"d.{k}, " for k in keys)
    return f"""
RECURSIVE h AS (SELECT CAST(ts AS DATE) AS day, {extra} hour(ts) AS hour, sum(pax) AS pax
                FROM {EVENTS} GROUP BY ALL),
d AS (SELECT DISTINCT day, {extra} 1 AS one FROM h),
spine AS (SELECT d.day, {picked} CAST(t.hour AS INT) AS hour,
                 CAST(coalesce(h.pax, 0) AS BIGINT) AS pax
          FROM d CROSS JOIN range(24) t(hour)
          LEFT JOIN h ON d.day = h.day AND h.hour = t.hour{matched}),
packed AS (SELECT day, {extra} list(pax ORDER BY hour) AS pax,
                  list(CAST(ceil(pax / 200) AS INT) ORDER BY hour) AS lanes
           FROM spine GROUP BY ALL),
fold AS (
    SELECT day, {extra} pax, lanes, 0 AS hour, CAST([] AS INT[]) AS starts FROM packed
    UNION ALL
    SELECT day, {extra} pax, lanes, hour + 1,
           list_append(starts, CAST(greatest(0, lanes[hour + 1] * 8
               - coalesce(list_sum(starts[greatest(1, hour - 4):hour]), 0)) AS INT))
    FROM fold WHERE hour < 24),
plan AS (
    SELECT day, {extra} CAST(i AS INT) AS Heure, pax[i + 1] AS Pax, lanes[i + 1] AS Lanes_Required,
           starts[i + 1] AS Staff_Starting,
           CASE WHEN i >= 6 THEN starts[i - 5] ELSE 0 END AS Staff_Ending,
           CAST(list_sum(starts[greatest(1, i - 4):i + 1]) AS INT) AS Total_Staff_Present,
           CAST(floor(list_sum(starts[greatest(1, i - 4):i + 1]) / 8) AS INT) AS Lanes_Open
    FROM fold CROSS JOIN range(24) t(i) WHERE fold.hour = 24)
"""


ORACLE["staffing_plan"] = f"WITH {plan([])} SELECT * FROM plan"
ORACLE["staffing_plan_by_terminal"] = f"WITH {plan(['terminal'])} SELECT * FROM plan"
ORACLE["staffing_totals"] = f"""
WITH {plan([])}
SELECT day, {r('sum(Staff_Starting) / 8', 'teams')},
       CAST(sum(Total_Staff_Present) AS BIGINT) AS paid_hours,
       max(Total_Staff_Present) AS peak_staff, CAST(max(Lanes_Open) * 200 AS INT) AS max_capacity,
       {r('sum(Total_Staff_Present) * 25', 'cost')}
FROM plan GROUP BY day
"""
_THOUSANDS = "format('{{:,}}', CAST({c} AS BIGINT))"
_MONEY = (
    f"lpad({_THOUSANDS} || '.00', CAST(greatest(8, length({_THOUSANDS}) + 3) AS INT), ' ')"
    " || ' $'"
)
ORACLE["staffing_report"] = f"""
WITH {plan([])},
body AS (
    SELECT day, CAST(Heure + 5 AS INT) AS line_no, concat_ws(' | ',
        rpad(lpad(CAST(Heure AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(Heure + 1 AS VARCHAR), 2, '0')
             || ':00', 12, ' '),
        rpad(CAST(Lanes_Open AS VARCHAR), greatest(6, length(CAST(Lanes_Open AS VARCHAR)))::INT, ' '),
        rpad(CAST(Total_Staff_Present AS VARCHAR), greatest(7, length(CAST(Total_Staff_Present AS VARCHAR)))::INT, ' '),
        moves || repeat(' ', greatest(0, 35 - length(moves))),
        {_MONEY.format(c='Total_Staff_Present * 25')}) AS line
    FROM (SELECT *, CASE WHEN Staff_Starting = 0 AND Staff_Ending = 0 THEN '---' ELSE concat_ws(' | ',
              CASE WHEN Staff_Starting > 0 THEN '+ ' || printf('%02d', Staff_Starting) || ' SHIFT START' END,
              CASE WHEN Staff_Ending > 0 THEN '- ' || printf('%02d', Staff_Ending) || ' SHIFT END' END)
          END AS moves FROM plan)),
totals AS (SELECT day, sum(Total_Staff_Present) * 25 AS cost FROM plan GROUP BY day),
frame AS (
    SELECT day, unnest([
        struct_pack(line_no := 0, line := repeat('=', 90)),
        struct_pack(line_no := 1, line := 'OPERATIONAL REPORT - WORKFORCE RESOURCE PLANNING'),
        struct_pack(line_no := 2, line := repeat('=', 90)),
        struct_pack(line_no := 3, line := rpad('TIME SLOT', 12, ' ') || ' | LANES  | STAFF   | '
                    || rpad('HR MOVEMENTS (IN/OUT)', 35, ' ') || ' | COST'),
        struct_pack(line_no := 4, line := repeat('-', 90)),
        struct_pack(line_no := 29, line := repeat('-', 90)),
        struct_pack(line_no := 30, line := 'DAILY TOTAL  | ---    | ---     | '
                    || rpad('---', 35, ' ') || ' | ' || {_MONEY.format(c='cost')}),
        struct_pack(line_no := 31, line := repeat('=', 90))]) AS f FROM totals)
SELECT day, line_no, line FROM body
UNION ALL SELECT day, f.line_no, f.line FROM frame
"""


# --- holidays ---

NATION_ORDERS = """(
    SELECT o_orderkey AS id, o_orderdate AS ts,
           CASE WHEN o_orderstatus = 'F' THEN 'Départ' ELSE 'Arrivée' END AS direction,
           CASE WHEN n_nationkey % 2 = 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 3, 'N')
                ELSE lpad(CAST(n_nationkey AS VARCHAR), 4, 'X') END AS previous,
           CAST(o_orderdate AS DATE) AS day, n_name AS country
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

_PLACE = "CASE WHEN n_nationkey < 8 THEN 'FR' WHEN n_nationkey < 10 THEN 'GP' ELSE n_name END"
AIRPORTS = f"""(
    SELECT CASE WHEN n_nationkey < 23 THEN lpad(CAST(n_nationkey AS VARCHAR), 4, 'X') END AS icao,
           lpad(CAST(n_nationkey AS VARCHAR), 3, 'N') AS iata, {_PLACE} AS country,
           CASE WHEN n_nationkey < 3 THEN 'Brest / Guipavas' WHEN n_nationkey < 5 THEN 'Roissy Charles'
                WHEN n_nationkey < 8 THEN 'St Etienne' WHEN n_nationkey < 10 THEN 'Pointe a Pitre'
                ELSE n_name END AS city
    FROM nation)"""
CODES = f"""(
    SELECT iata AS code, icao AS OACI_code, country, city FROM {AIRPORTS} WHERE icao IS NOT NULL
    UNION ALL SELECT icao, icao, country, city FROM {AIRPORTS} WHERE icao IS NOT NULL)"""


def nation_holidays(country: str) -> str:
    return f"""(
    SELECT DISTINCT {country} AS country,
           make_date(y, CAST(n_nationkey % 12 + 1 AS INT), CAST(n_nationkey + 1 AS INT)) AS day
    FROM nation CROSS JOIN generate_series(1995, 2001) g(y))"""


def order_periods(key: str) -> str:
    name = "n_name" if key == "country" else "o_orderpriority"
    joins = "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    return f"""(
    SELECT {name} AS {key}, CAST(o_orderdate AS DATE) AS "start",
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT) AS "end"
    FROM orders {joins if key == "country" else ""})"""


def period_days(key: str) -> str:
    return f"""(
    SELECT DISTINCT {key}, CAST(unnest(generate_series("start", "end", INTERVAL 1 DAY)) AS DATE) AS day
    FROM {order_periods(key)})"""


ORACLE["departure_airport"] = f"""
SELECT id, direction, previous,
       CASE WHEN direction = 'Départ' THEN 'NN0' ELSE previous END AS AirportDeparture
FROM {NATION_ORDERS}
"""
ORACLE["airport_resolution"] = f"""
SELECT id, previous, OACI_code, c.country, city
FROM {NATION_ORDERS} n JOIN {CODES} c ON n.previous = c.code
"""
ORACLE["unresolved_airports"] = f"""
SELECT DISTINCT previous FROM {NATION_ORDERS} WHERE previous NOT IN (SELECT code FROM {CODES})
"""
ORACLE["public_holidays"] = f"""
SELECT id, n.day, n.country, CASE WHEN h.day IS NULL THEN 0 ELSE 1 END AS IsPublicHolidays
FROM {NATION_ORDERS} n LEFT JOIN {nation_holidays('n_name')} h
  ON n.country = h.country AND n.day = h.day
"""
ORACLE["school_days_interval"] = f"""
SELECT id, terminal, CAST(ts AS DATE) AS day,
       CASE WHEN EXISTS (SELECT 1 FROM {order_periods('terminal')} p WHERE p.terminal = o.terminal
                         AND CAST(o.ts AS DATE) BETWEEN p."start" AND p."end")
            THEN 1 ELSE 0 END AS IsScholarHolidays
FROM {ORDERS} o
"""
ORACLE["school_days_abroad"] = f"""
SELECT id, day, country,
       CASE WHEN EXISTS (SELECT 1 FROM {order_periods('country')} p WHERE p.country = o.country
                         AND o.day BETWEEN p."start" AND p."end")
            THEN 1 ELSE 0 END AS IsScholarHolidays
FROM {NATION_ORDERS} o
"""
_ZONES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SPINE = "unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))"
ORACLE["calendar_wide"] = f"""
WITH s AS (SELECT CAST({_SPINE} AS DATE) AS day), c AS (SELECT * FROM {period_days('zone')})
SELECT s.day, {', '.join(f'''max(CASE WHEN zone = '{z}' THEN 1 ELSE 0 END) AS "{z.replace(' ', '_')}"''' for z in _ZONES)}
FROM s LEFT JOIN c ON s.day = c.day GROUP BY s.day
"""
ORACLE["calendar_long"] = f"""
WITH s AS (SELECT CAST({_SPINE} AS DATE) AS day),
z AS (SELECT unnest([{', '.join(f"'{z}'" for z in _ZONES)}]) AS zone),
c AS (SELECT * FROM {period_days('zone')})
SELECT s.day, replace(z.zone, ' ', '_') AS holiday_zone,
       CASE WHEN c.day IS NULL THEN 0 ELSE 1 END AS IsScholarHolidays
FROM s CROSS JOIN z LEFT JOIN c ON c.day = s.day AND c.zone = z.zone
"""

RECORDS = """(
    SELECT CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'Zone ' || substr('ABC', CAST(o_custkey % 3 + 1 AS INT), 1)
           END AS zones, o_orderpriority AS location,
           CASE o_orderstatus WHEN 'F' THEN 'Vacances d''Hiver' WHEN 'O' THEN 'Pont de l''Ascension'
                ELSE 'Début de l''Été' END AS description,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS start_date,
           strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS end_date,
           CAST(year(o_orderdate) AS VARCHAR) AS annee_scolaire,
           lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS population
    FROM orders)"""
ORACLE["zone_periods"] = f"""
WITH n AS (
    SELECT unnest(CASE WHEN zones = location THEN [zones] ELSE [zones, location] END) AS zone,
           description, CAST(substr(start_date, 1, 10) AS DATE) AS "start",
           CAST(substr(end_date, 1, 10) AS DATE) AS "end", annee_scolaire AS school_year, population
    FROM {RECORDS} WHERE description LIKE '%Vacances%' OR description LIKE '%Été%')
SELECT * FROM n
WHERE zone IN ('Zone A', 'Zone B', 'Zone C', '1-URGENT')
  AND "end" >= DATE '1996-01-01' AND "start" <= DATE '1999-12-31'
"""
ORACLE["zone_lookup"] = f"""
WITH n AS (
    SELECT unnest([location, zones]) AS target, coalesce(nullif(zones, ''), location) AS zone,
           start_date, end_date FROM {RECORDS}),
f AS (SELECT * FROM n QUALIFY row_number() OVER (
        PARTITION BY target ORDER BY start_date, zone, end_date) = 1)
SELECT target, zone, CASE WHEN start_date <= end_date THEN 'OUI' ELSE 'NON' END AS is_holiday FROM f
"""
ORACLE["foreign_payloads"] = f"""
SELECT location AS country, CAST(substr(start_date, 1, 10) AS DATE) AS "start",
       CAST(substr(end_date, 1, 10) AS DATE) AS "end" FROM {RECORDS}
"""

CITIES = """(
    SELECT p_partkey AS id, CASE p_size % 8
        WHEN 0 THEN 'St ' || t WHEN 1 THEN t || ' / ' || p_brand WHEN 2 THEN 'Figari ' || t
        WHEN 3 THEN 'Grande Pointe-' || t WHEN 4 THEN 'La Rochelle ' || t
        WHEN 5 THEN 'Brest-Guipavas' WHEN 6 THEN '  Saint-Etienne ' || t
        ELSE replace(t, ' ', '-') END AS city
    FROM (SELECT *, array_to_string(list_transform(string_split(p_name, ' '),
                 lambda w: upper(w[1]) || lower(w[2:])), ' ') AS t FROM part))"""


def cleaned(view: str) -> str:
    return f"""(
    SELECT *, CASE WHEN a LIKE '%Figari%' THEN 'Figari' WHEN a LIKE '%Pointe%' THEN 'Pointe-a-Pitre'
                   WHEN a LIKE '%La Rochelle%' THEN 'La Rochelle'
                   WHEN trim(split_part(w, '-', 1)) = 'Saint' THEN trim(w)
                   ELSE trim(split_part(w, '-', 1)) END AS clean
    FROM (SELECT *, split_part(CASE WHEN starts_with(a, 'St ') THEN replace(a, 'St ', 'Saint-') ELSE a END,
                               ' ', 1) AS w
          FROM (SELECT *, trim(split_part(city, '/', 1)) AS a FROM {view})))"""


DISTRICTS = "(VALUES {}) AS d(city, district)".format(
    ", ".join(f"('{city}', '{district}')" for city, district in CITY_DISTRICT.items())
)
ORACLE["city_clean"] = f"SELECT id, city, clean FROM {cleaned(CITIES)}"
ORACLE["city_zone"] = f"""
SELECT c.id, c.city, z.zone AS holiday_zone FROM {cleaned(CITIES)} c
LEFT JOIN {DISTRICTS} ON c.clean = d.city
LEFT JOIN (VALUES ('Rennes', 'Zone B'), ('Poitiers', 'Zone A'), ('Lyon', 'Zone A'),
                  ('Large', 'Zone C')) AS z(target, zone) ON coalesce(d.district, c.clean) = z.target
"""
ORACLE["country_split_union"] = f"""
SELECT id, a.country AS place, direction,
       CASE WHEN a.country IN ('FR', 'LF', 'GP', 'MQ', 'RE') THEN 'France' ELSE 'abroad' END AS branch
FROM {NATION_ORDERS} n LEFT JOIN {AIRPORTS} a ON n.previous = a.iata
"""
ORACLE["school_days_france"] = f"""
WITH k AS (SELECT m.id, m.day, m.previous, c.OACI_code, c.country, c.city
           FROM {NATION_ORDERS} m JOIN {CODES} c ON m.previous = c.code
           WHERE c.country IN ('FR', 'LF', 'GP', 'MQ', 'RE')),
z AS (SELECT x.*, t.zone FROM {cleaned('k')} x LEFT JOIN {DISTRICTS} ON x.clean = d.city
      LEFT JOIN (VALUES ('Rennes', 'Zone B'), ('Lyon', 'Zone A'), ('Guadeloupe', 'Guadeloupe'))
           AS t(target, zone) ON coalesce(d.district, x.clean) = t.target),
fr AS (SELECT DISTINCT CASE WHEN zone < '3' THEN 'Zone A' ELSE 'Zone B' END AS zone, day
       FROM {period_days('zone')})
SELECT z.id, z.day, z.previous, z.OACI_code, z.country, z.city,
       CASE WHEN fr.day IS NULL THEN 0 ELSE 1 END AS IsScholarHolidays
FROM z LEFT JOIN fr ON z.zone = fr.zone AND z.day = fr.day
"""
ORACLE["holiday_flags"] = f"""
WITH m AS (SELECT id, ts, direction, previous, day,
                  CASE WHEN direction = 'Départ' THEN 'NN0' ELSE previous END AS departure
           FROM {NATION_ORDERS}),
k AS (SELECT m.*, c.country, c.city FROM m JOIN {CODES} c ON m.departure = c.code),
z AS (SELECT x.*, t.zone FROM {cleaned('k')} x LEFT JOIN {DISTRICTS} ON x.clean = d.city
      LEFT JOIN (VALUES ('Rennes', 'Zone B'), ('Lyon', 'Zone A'), ('Guadeloupe', 'Guadeloupe'))
           AS t(target, zone) ON coalesce(d.district, x.clean) = t.target),
fr AS (SELECT DISTINCT CASE WHEN zone < '3' THEN 'Zone A' ELSE 'Zone B' END AS zone, day
       FROM {period_days('zone')}),
ab AS (SELECT * FROM {period_days('country')})
SELECT z.id, z.ts, z.direction, z.previous, z.country,
       CASE WHEN p.day IS NULL THEN 0 ELSE 1 END AS IsPublicHolidays,
       CASE WHEN z.country IN ('FR', 'LF', 'GP', 'MQ', 'RE')
            THEN CASE WHEN fr.day IS NULL THEN 0 ELSE 1 END
            ELSE CASE WHEN ab.day IS NULL THEN 0 ELSE 1 END END AS IsScholarHolidays
FROM z LEFT JOIN {nation_holidays(_PLACE)} p ON z.country = p.country AND z.day = p.day
LEFT JOIN fr ON z.zone = fr.zone AND z.day = fr.day
LEFT JOIN ab ON z.country = ab.country AND z.day = ab.day
"""

# --- sets ---

ORACLE["split_summary"] = f"""
SELECT CASE WHEN ts < TIMESTAMP '1999-01-01' THEN 'train' WHEN ts < TIMESTAMP '2000-07-01' THEN 'valid'
            ELSE 'test' END AS split, count(*) AS rows, min(ts) AS first_time, max(ts) AS last_time
FROM {ORDERS} WHERE ts < TIMESTAMP '2001-08-02' GROUP BY 1
"""
ORACLE["split_rows"] = f"""
SELECT id, ts, CASE WHEN ts < TIMESTAMP '1999-01-01' THEN 'train'
                    WHEN ts < TIMESTAMP '2000-07-01' THEN 'valid'
                    WHEN ts <= TIMESTAMP '2001-08-01' THEN 'test' END AS split
FROM {ORDERS}
"""

ORACLE["target_means"] = f"""
WITH l AS (SELECT pax, unnest([
               struct_pack(source := '', category := ''),
               struct_pack(source := 'terminal', category := terminal),
               struct_pack(source := 'flight', category := flight),
               struct_pack(source := 'direction', category := direction)]) AS s FROM {ORDERS}),
o AS (SELECT avg(pax) AS overall FROM {ORDERS})
SELECT s.source AS source, s.category AS category,
       {r('(sum(pax) + 20.0::DOUBLE * any_value(overall)) / (count(*) + 20.0::DOUBLE)', 'mean')}
FROM l CROSS JOIN o GROUP BY s.source, s.category
"""

TESTED = f"FROM {ORDERS} WHERE ts >= TIMESTAMP '2000-07-01' AND ts < TIMESTAMP '2001-08-02'"
ORACLE["gbt_forecast"] = f"SELECT id, ts, pax, true AS valid {TESTED}"
REGULAR = f"""(
    SELECT id, ts, seats + [120, 0, 80, 20, 60][CAST(substr(terminal, 1, 1) AS INT)] + 5 * month(ts) + pax % 7 AS pax
    FROM {ORDERS})"""
ORACLE["forecast_quality"] = f"""
WITH m AS (SELECT avg(pax) AS mean FROM {REGULAR} WHERE ts < TIMESTAMP '1999-01-01')
SELECT count(*) AS rows, CAST(sum(pax) AS BIGINT) AS pax, {r('avg(abs(pax - mean))', 'mae_of_mean')},
       true AS forecast_is_better, true AS forecasts_differ
FROM {REGULAR} CROSS JOIN m WHERE ts >= TIMESTAMP '2000-07-01' AND ts < TIMESTAMP '2001-08-02'
"""
# The inputs: the seats, the date features, the codes of three texts and the means of one.
ORACLE["feature_importance"] = """
SELECT unnest(['seats', 'Year', 'Semester', 'Quarter', 'Day', 'sin_Minute', 'cos_Minute', 'sin_Hour', 'cos_Hour',
               'sin_Month', 'cos_Month', 'sin_DayOfWeek', 'cos_DayOfWeek', 'sin_Hour_Of_Week',
               'cos_Hour_Of_Week', 'terminal', 'flight', 'direction', 'flight_mean']) AS feature,
       true AS is_share, true AS sums_to_one
"""
ORACLE["stopping_rule"] = f"""
WITH days AS (
    SELECT terminal, CAST(ts AS DATE) AS day, CAST(sum(abs(pax - pred_pax)) AS BIGINT) AS error
    FROM {COMPARED} GROUP BY ALL
), e AS (
    SELECT terminal, error, CAST(row_number() OVER (PARTITION BY terminal ORDER BY day) AS INT) AS round FROM days
), best AS (
    SELECT a.terminal, a.round, a.error, min(b.round) AS best_round
    FROM e a JOIN e b ON a.terminal = b.terminal AND b.round <= a.round
    WHERE b.error = (SELECT min(c.error) FROM e c WHERE c.terminal = a.terminal AND c.round <= a.round)
    GROUP BY ALL
), ends AS (
    SELECT terminal, min(round) FILTER (WHERE round - best_round >= 3) AS stop, max(round) AS last
    FROM best GROUP BY terminal
)
SELECT b.terminal, b.error, b.round, b.best_round, c.best_round AS chosen,
       coalesce(b.round >= e.stop, false) AS stopped
FROM best b JOIN ends e ON b.terminal = e.terminal
JOIN best c ON c.terminal = b.terminal AND c.round = coalesce(e.stop, e.last)
"""
ORACLE["category_index"] = f"""
WITH c AS (
    SELECT 'terminal' AS source, terminal AS category, count(*) AS rows FROM {ORDERS} GROUP BY terminal
    UNION ALL SELECT 'flight', flight, count(*) FROM {ORDERS} GROUP BY flight
    UNION ALL SELECT 'direction', direction, count(*) FROM {ORDERS} GROUP BY direction)
SELECT source, category, rows,
       CAST(dense_rank() OVER (PARTITION BY source ORDER BY rows DESC, category) AS INT) AS code
FROM c WHERE category IS NOT NULL QUALIFY code < 64
"""

# --- reports, sources and stores ---


def _report_level(level: list[str], target: str) -> str:
    y, p = target, f"pred_{target}"
    hours = {"Heure": "CAST(hour(ts) AS INT)", "terminal": "terminal", "direction": "direction"}
    dims = [f"{hours[d]} AS {d}" if d in level else f"NULL AS {d}" for d in hours]
    group = f"GROUP BY {', '.join(hours[d] for d in level)}" if level else ""
    cells = [
        f"'{target}' AS target",
        "count(*) AS rows",
        r(f"sum({y})", "total_actual"),
        r(f"sum({p})", "total_predicted"),
        r(f"sum({p}) - sum({y})", "difference"),
        r(f"sum({p})::DOUBLE / nullif(sum({y}), 0) * 100", "ratio_percent"),
        r(f"abs(sum({p}) - sum({y}))::DOUBLE / nullif(sum({y}), 0)", "wape"),
        r(f"avg(abs({y} - {p}))", "mae"),
        r(f"sqrt(avg(({y} - {p}) * ({y} - {p})))", "rmse"),
        r(
            f"1 - sum(({y} - {p}) * ({y} - {p}))::DOUBLE"
            f" / nullif(sum({y} * {y})::DOUBLE - sum({y})::DOUBLE * sum({y}) / count(*), 0)",
            "r2",
        ),
    ]
    return f"SELECT '{'+'.join(level)}' AS level, {', '.join(dims + cells)} FROM {COMPARED} {group}"


ORACLE["forecast_report_sums"] = " UNION ALL ".join(
    _report_level(level, target)
    for level in (
        [], ["Heure"], ["Heure", "terminal"], ["direction"], ["Heure", "terminal", "direction"]
    )
    for target in ("pax", "reduced")
)
ORACLE["french_payloads"] = f"""
WITH p AS (
    SELECT location AS zone, CAST(population AS BIGINT) // 400 AS number, count(*) AS n FROM {RECORDS} GROUP BY ALL
), a AS (
    SELECT zone, sum(n) + CASE WHEN zone = '5-LOW' THEN 7 ELSE 0 END AS total_count,
           coalesce(sum(n) FILTER (WHERE NOT (zone = '2-HIGH' AND number = 0)), 0) AS entries, count(*) AS pages,
           count(*) FILTER (WHERE zone = '2-HIGH' AND number = 0) AS unreadable
    FROM p GROUP BY zone
)
SELECT zone, CAST(total_count AS INT) AS total_count, CAST(entries AS BIGINT) AS entries, pages, unreadable,
       total_count = entries AND unreadable = 0 AS complete FROM a
"""
ORACLE["french_records"] = f"""
SELECT location AS zone, description, start_date, end_date, annee_scolaire, population, zones, location
FROM {RECORDS} WHERE NOT (location = '2-HIGH' AND CAST(population AS BIGINT) // 400 = 0)
"""
ORACLE["csv_round_trip"] = f"""
SELECT id, CAST(ts AS DATE) AS day, terminal, pax, NULL AS line FROM {ORDERS} WHERE id % 10 NOT IN (3, 7, 9)
UNION ALL
SELECT NULL, NULL, NULL, NULL, id || ',' || strftime(ts, '%Y-%m-%d') || CASE id % 10
           WHEN 3 THEN ',' || terminal || ',x' || pax WHEN 9 THEN ',' || terminal || ',' || pax || ',more'
           ELSE '' END
FROM {ORDERS} WHERE id % 10 IN (3, 7, 9)
"""
ORACLE["dated_outputs"] = f"""
SELECT terminal, CAST(sum(pax + reduced) AS BIGINT) AS total, DATE '2024-01-15' AS run_date
FROM {EVENTS} GROUP BY terminal
UNION ALL
SELECT terminal, CAST(sum(reduced) AS BIGINT), DATE '2024-01-16' FROM {EVENTS} GROUP BY terminal
"""
ORACLE["preprocessed_rows"] = f"""
WITH n AS (
    SELECT id, ts, terminal, CASE WHEN id % 5 = 0 THEN 2 ELSE 1 END AS version,
           CASE WHEN id % 5 = 0 THEN pax + 1 ELSE pax END AS pax FROM {ORDERS}
)
SELECT id, ts, terminal, version, 'pax' AS "set", pax AS value FROM n
UNION ALL SELECT id, ts, terminal, version, 'reduced', CAST(pax % 3 AS INT) FROM n
"""
ORACLE["reused_store"] = f"""
SELECT CAST(step AS INT) AS step, CAST(CASE WHEN step > 2 THEN 2 ELSE 1 END AS BIGINT) AS version, terminal,
       CASE WHEN step > 2 THEN count(*) + count(*) FILTER (WHERE id % 2 = 0) ELSE count(*) END AS rows
FROM {ORDERS}, range(1, 5) AS s(step) GROUP BY step, terminal
"""
ORACLE["zone_lookup_file"] = ORACLE["zone_lookup"]
ORACLE["report_files"] = f"SELECT day, line FROM ({ORACLE['staffing_report']})"
ORACLE["movement_source"] = f"""
SELECT id AS IdMovement, ts AS LTScheduledDatetime, pax AS NbPaxTotal, terminal AS SysTerminal,
       CAST(NULL AS VARCHAR) AS ServiceCode FROM {ORDERS}
"""
ORACLE["run_limits"] = f"""
SELECT CASE WHEN ts < TIMESTAMP '1999-07-02' THEN 'train' WHEN ts < TIMESTAMP '2000-07-01' THEN 'valid'
            ELSE 'test' END AS split, count(*) AS rows, min(ts) AS first_time, max(ts) AS last_time
FROM {ORDERS} WHERE ts < TIMESTAMP '2000-07-31' GROUP BY 1
"""
ORACLE["text_times"] = f"""
SELECT id, CASE id % 5 WHEN 0 THEN date_trunc('day', ts) + INTERVAL '10 hours 30 minutes'
                       WHEN 1 THEN date_trunc('day', ts) + INTERVAL '8 hours 30 minutes'
                       WHEN 2 THEN date_trunc('day', ts) + INTERVAL '26 hours'
                       WHEN 3 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS ts
FROM {ORDERS}
"""
