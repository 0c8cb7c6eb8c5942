"""SQL counterpart of the registered queries, in DuckDB's dialect.

Written independently of the Spark operators: calendars come from
``generate_series`` and joins, sets from ``UNION`` and window functions. Each
statement is a final SELECT; the common tables it mentions are put in front.
"""

from __future__ import annotations

import re

from staffcast.catalog.bindings import TOKENS, VERTICALS
from staffcast.operators.report import BOARD_KPIS

_TABLES: dict[str, str] = {}


def _num(expr: str, name: str | None = None) -> str:
    """A double to 4 places, rounded from a decimal of 9 places as in `comparable`."""
    rounded = f"CAST(round(TRY_CAST(CAST({expr} AS DOUBLE) AS DECIMAL(28,9)), 4) AS DOUBLE)"
    return f"coalesce({rounded}, CAST({expr} AS DOUBLE)) + 0.0 AS {name or expr}"


def _day(expr: str, name: str | None = None) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {name or expr}"


def _int(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def _month(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def _define(name: str, body: str) -> None:
    _TABLES[name] = body


def _with(select: str) -> str:
    """Put the common tables that ``select`` needs in front of it, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _TABLES:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(_TABLES[name])
                if name not in order:
                    order.append(name)

    visit(select)
    heads = ",\n".join(f"{name} AS MATERIALIZED ({_TABLES[name]})" for name in order)
    return f"WITH {heads}\n{select}" if heads else select


# --- common tables -----------------------------------------------------------

_scope = " AND ".join(
    [f"vertical IN ({', '.join(repr(v) for v in VERTICALS)})"]
    + [f"NOT contains(upper(department_name), '{t}')" for t in TOKENS]
)
_define("t_map", """SELECT CAST(n_nationkey AS BIGINT) AS department_id, n_name AS department_name,
    r_name AS vertical FROM nation JOIN region ON n_regionkey = r_regionkey""")
_define("t_scope", f"SELECT * FROM t_map WHERE {_scope}")
_define("t_orders", """SELECT orders.*, CAST(o_orderdate AS DATE) AS day, CAST(c_nationkey AS BIGINT) AS department_id
    FROM orders JOIN customer ON o_custkey = c_custkey""")
_define("t_lines", f"""SELECT lineitem.*, CAST(l_shipdate AS DATE) AS day, {_month('l_shipdate')} AS month,
    CAST(s_nationkey AS BIGINT) AS department_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
_define("t_daily", "SELECT department_id, day, CAST(count(*) AS DOUBLE) AS tickets FROM t_orders GROUP BY ALL")
_define("t_events", """SELECT CAST(user_id % 5 AS BIGINT) AS department_id, CAST(ts AS DATE) AS day,
    CAST(count(*) AS DOUBLE) AS tickets FROM events GROUP BY ALL""")
_define("t_actuals", f"""SELECT vertical, department_id, department_name, {_month('day')} AS month,
    sum(tickets) AS actual_volume FROM t_daily JOIN t_scope USING (department_id) GROUP BY ALL""")
_define("t_solved", "SELECT department_id, month, sum(l_discount * 4) AS solved FROM t_lines GROUP BY ALL")
_define("t_solved_events", f"""SELECT department_id, {_month('day')} AS month, CAST(count(*) AS DOUBLE) AS solved
    FROM t_orders WHERE o_orderstatus = 'F' GROUP BY ALL""")
_define("t_calls", """SELECT department_id, month, CAST(count(*) AS DOUBLE) AS calls_not_indexed
    FROM t_lines WHERE l_returnflag = 'R' GROUP BY ALL""")
_define("t_calls_summed", """SELECT department_id, month, sum(l_quantity / 25) AS calls_not_indexed
    FROM t_lines WHERE l_returnflag = 'R' GROUP BY ALL""")
_define("t_repeats", f"""SELECT department_id, {_month('day')} AS month, CAST(count(*) AS DOUBLE) AS repeats_workload
    FROM t_orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL""")
_define("t_sightings", """SELECT department_id, l_orderkey, CAST(o_orderdate AS DATE) AS opened,
    CASE WHEN l_linenumber % 2 = 1 THEN month ELSE day END AS seen,
    CASE WHEN l_returnflag = 'A' AND l_linenumber > 3 THEN ' Closed ' WHEN l_returnflag = 'A' THEN 'RESOLVED'
         WHEN l_returnflag = 'R' THEN 'open' END AS status
    FROM t_lines JOIN orders ON l_orderkey = o_orderkey""")
_define("t_backlog", """SELECT department_id, seen AS month, CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS inventory
    FROM t_sightings WHERE day(seen) = 1 AND opened < seen
    AND (status IS NULL OR lower(trim(status)) NOT IN ('closed', 'resolved')) GROUP BY ALL""")


def _recent(side: str, value: str, out: str, high: float, no_volume: str, keep: str = "TRUE") -> str:
    return f"""SELECT department_id, least(greatest(coalesce(avg(rate), 0), 0), {high}) AS {out} FROM (
        SELECT *, row_number() OVER (PARTITION BY department_id ORDER BY month DESC) AS back FROM (
            SELECT department_id, month, CASE WHEN actual_volume > 0
                THEN coalesce({value}, 0) / actual_volume ELSE {no_volume} END AS rate
            FROM t_actuals LEFT JOIN {side} USING (department_id, month)) WHERE {keep})
        WHERE back <= 3 GROUP BY department_id"""


_define("t_solved_rate", _recent("t_solved", "solved", "deflection_rate_recent", 0.9, "NULL"))
_define("t_solved_rate_zero", _recent("t_solved_events", "solved", "deflection_rate_recent", 0.9, "0"))
_define("t_calls_rate", _recent(
    "t_calls", "calls_not_indexed", "calls_not_indexed_rate_recent", 5.0, "NULL", "rate < 3.0"))
_define("t_repeats_rate", _recent("t_repeats", "repeats_workload", "repeats_rate_recent", 5.0, "0"))


def _naive(source: str, tag: str) -> None:
    """Dense series, profile and naive forecast of a daily table."""
    _define(f"t_dense_{tag}", f"""SELECT g.department_id, g.day, coalesce(s.tickets, 0) AS tickets FROM (
        SELECT department_id, CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP),
            INTERVAL 1 DAY)) AS DATE) AS day FROM {source} GROUP BY department_id) g
        LEFT JOIN {source} s USING (department_id, day)""")
    _define(f"t_diff_{tag}", f"""SELECT *, tickets - lag(tickets, 7) OVER (
        PARTITION BY department_id ORDER BY day) AS lag_diff FROM t_dense_{tag}""")
    _define(f"t_profile_{tag}", f"""SELECT department_id, count(*) AS days, min(day) AS first_day, max(day) AS last_day,
        avg(tickets) AS mean_tickets, count(lag_diff) AS lag_diffs, stddev_samp(lag_diff) AS lag_sd
        FROM t_diff_{tag} GROUP BY department_id""")
    _define(f"t_week_{tag}", f"""SELECT d.department_id, d.day, d.tickets, least(p.days, 7) AS week_days,
        date_diff('day', p.last_day, d.day) + least(p.days, 7) - 1 AS place
        FROM t_dense_{tag} d JOIN t_profile_{tag} p USING (department_id) WHERE d.day > p.last_day - 7""")
    _define(f"t_naive_{tag}", f"""SELECT department_id, last_day + CAST(step AS INTEGER) AS day, tickets AS p50,
        greatest(tickets - 1.645 * sd, 0) AS p05, tickets + 1.645 * sd AS p95
        FROM (SELECT *, (step - 1) % least(days, 7) AS place FROM (SELECT *, unnest(range(1, 366)) AS step,
                  coalesce(lag_sd, greatest(1, sqrt(greatest(mean_tickets, 1)))) AS sd FROM t_profile_{tag})) p
        JOIN t_week_{tag} w USING (department_id, place)""")


_naive("t_daily", "orders")
_naive("t_events", "events")
_define("t_rollup", f"""SELECT vertical, department_id, department_name, {_month('day')} AS month, sum(p50) AS forecast_p50,
    sum(p05) AS forecast_p05, sum(p95) AS forecast_p95, count(*) AS days_covered
    FROM t_naive_orders JOIN t_scope USING (department_id) GROUP BY ALL""")
_define("t_deflected", """SELECT t_rollup.*, coalesce(deflection_rate_recent, 0) AS rate_used,
    forecast_p50 * (1 - coalesce(deflection_rate_recent, 0)) AS p50_post,
    forecast_p05 * (1 - coalesce(deflection_rate_recent, 0)) AS p05_post,
    forecast_p95 * (1 - coalesce(deflection_rate_recent, 0)) AS p95_post
    FROM t_rollup LEFT JOIN t_solved_rate USING (department_id)""")
_define("t_bias", """SELECT CAST(n_nationkey AS BIGINT) AS department_id, n_name,
    CAST((n_nationkey % 7 - 3) * 15 AS DOUBLE) AS bias_pct FROM nation WHERE n_nationkey % 3 <> 0""")
_define("t_factor", """SELECT department_id,
    CASE WHEN 1 - bias_pct / 100.0 < 0.7 THEN 0.7 WHEN 1 - bias_pct / 100.0 > 1.3 THEN 1.3
         ELSE 1 - bias_pct / 100.0 END AS factor FROM t_bias""")
_define("t_calibrated", """SELECT t_deflected.*, coalesce(factor, 1.0) AS calib_factor
    FROM t_deflected LEFT JOIN t_factor USING (department_id)""")
_define("t_backlog_dense", """SELECT g.department_id, g.month, coalesce(inventory, 0) AS inventory FROM (
    SELECT department_id, CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP),
        INTERVAL 1 MONTH)) AS DATE) AS month FROM t_backlog GROUP BY department_id) g
    LEFT JOIN t_backlog USING (department_id, month)""")
_define("t_backlog_profile", """SELECT department_id, count(*) AS months, max(month) AS last_month,
    arg_max(inventory, month) AS last_value, stddev_pop(inventory) AS spread FROM t_backlog_dense GROUP BY department_id""")
_define("t_hold", """SELECT department_id, CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS month,
    greatest(last_value, 0) AS p50, greatest(last_value - 1.645 * sd, 0) AS p05, last_value + 1.645 * sd AS p95 FROM (
    SELECT *, unnest(range(1, 13)) AS step,
        CASE WHEN months > 1 THEN spread ELSE greatest(1, sqrt(greatest(last_value, 1))) END AS sd
    FROM t_backlog_profile)""")
_define("t_agent_days", """SELECT department_id, day, month,
    nullif(count(DISTINCT l_suppkey) FILTER (l_linenumber > 1), 0) AS agents_day,
    nullif(count(*) FILTER (l_linenumber > 1), 0) AS rows_day,
    avg(l_linenumber) FILTER (l_linenumber > 1) AS target_mean_day, sum(l_quantity) AS prod_sum_day
    FROM t_lines GROUP BY ALL""")
_define("t_agents", """SELECT department_id, month, avg(agents_day) * avg(target_mean_day) AS capacity_agents,
    sum(prod_sum_day) AS productivity_agents FROM t_agent_days GROUP BY ALL""")
_define("t_hours", "SELECT department_id, month, sum(l_tax) * 6.0 AS capacity FROM t_lines GROUP BY ALL")
_define("t_wdays", """SELECT CAST(date_trunc('month', d) AS DATE) AS month,
    count(*) FILTER (isodow(d) < 6) AS working_days FROM (
    SELECT unnest(generate_series(CAST(min(month) AS TIMESTAMP),
        CAST(max(month) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM t_lines)
    GROUP BY ALL""")
_define("t_last3", """SELECT department_id, avg(capacity) AS capacity FROM (
    SELECT *, row_number() OVER (PARTITION BY department_id ORDER BY month DESC) AS back FROM t_hours)
    WHERE back <= 3 GROUP BY department_id""")


def _projection(anchor: str) -> str:
    return f"""SELECT department_id, CAST(anchor + to_months(CAST(step AS INTEGER)) AS DATE) AS month, capacity
        FROM (SELECT t_last3.*, unnest(range(1, 13)) AS step FROM t_last3), (SELECT {anchor} AS anchor)"""


_define("t_projection", _projection(
    "greatest((SELECT max(month) FROM t_actuals), (SELECT max(month) FROM t_hours))"))
_define("t_projection_actuals", _projection("(SELECT max(month) FROM t_actuals)"))
_define("t_capacity_all", """SELECT department_id, month, capacity FROM t_hours
    UNION ALL SELECT department_id, month, capacity FROM t_projection""")
_define("t_backlog_mean", """SELECT department_id, month, avg(n) AS inventory_mean FROM (
    SELECT department_id, month, day, count(*) AS n FROM t_lines GROUP BY ALL) GROUP BY ALL""")
_define("t_labels", """SELECT CAST(n_nationkey AS BIGINT) AS department_id,
    CASE WHEN n_nationkey % 5 = 0 THEN CASE WHEN n_nationkey % 2 = 0 THEN 'STL' ELSE 'SARIMAX-7' END
         WHEN n_nationkey % 4 = 0 THEN 'SARIMAX-7' WHEN n_nationkey % 4 = 1 THEN 'STL'
         WHEN n_nationkey % 4 = 2 THEN 'Prophet' END AS model
    FROM nation WHERE n_nationkey % 5 = 0 OR n_nationkey % 4 <> 3""")
_define("t_expected", """SELECT c.vertical, c.department_id, c.department_name, c.month, forecast_p50, rate_used,
    p50_post * calib_factor AS human, coalesce(calls_not_indexed_rate_recent, 0) * forecast_p50 AS calls_forecast,
    coalesce(repeats_rate_recent, 0) * forecast_p50 AS repeats_forecast,
    coalesce(b.inventory, h.p50, 0) AS inventory_final, a.actual_volume
    FROM t_calibrated c LEFT JOIN t_calls_rate USING (department_id) LEFT JOIN t_repeats_rate USING (department_id)
    LEFT JOIN t_backlog b ON b.department_id = c.department_id AND b.month = c.month
    LEFT JOIN t_hold h ON h.department_id = c.department_id AND h.month = c.month
    LEFT JOIN t_actuals a ON a.department_id = c.department_id AND a.month = c.month
    UNION ALL
    SELECT vertical, department_id, department_name, month, NULL, NULL, NULL, NULL, NULL,
        (SELECT max(inventory) FROM t_backlog k WHERE k.department_id = x.department_id AND k.month = x.month), actual_volume
    FROM t_actuals x WHERE year(month) = 2001 AND NOT EXISTS (
        SELECT 1 FROM t_rollup y WHERE y.department_id = x.department_id AND y.month = x.month)""")
_define("t_facts", """SELECT e.*, coalesce(k.calls_not_indexed, 0) AS calls_actual,
    coalesce(r.repeats_workload, 0) AS repeats_actual, m.inventory_mean,
    coalesce(g.capacity_agents, o.capacity) AS capacity,
    coalesce(g.productivity_agents, g.capacity_agents, o.capacity) AS productivity
    FROM t_expected e LEFT JOIN t_calls k USING (department_id, month)
    LEFT JOIN t_repeats r USING (department_id, month) LEFT JOIN t_backlog_mean m USING (department_id, month)
    LEFT JOIN t_agents g USING (department_id, month)
    LEFT JOIN t_capacity_all o USING (department_id, month)""")
_define("t_board_rows", """SELECT department_id, department_name, month, sum(forecast_p50) AS forecast, sum(actual_volume) AS actual_volume,
    sum(capacity) AS capacity, sum(productivity) AS productivity, avg(inventory_mean) AS inventory_mean
    FROM t_facts GROUP BY ALL""")
_define("t_small_rows", """SELECT department_id, department_name, month, actual_volume + dayofyear(month) % 5 - 2 AS forecast, actual_volume,
    actual_volume * 1.5 - 6 AS capacity, actual_volume + 1 AS productivity, actual_volume / 8 AS inventory_mean
    FROM t_actuals""")

_KPI_SQL = (
    "round_even(forecast, 0)",
    "round_even(actual_volume, 0)",
    "round_even(100 - abs(forecast - actual_volume) / nullif(actual_volume, 0) * 100, 1)",
    "capacity",
    "productivity",
    "coalesce(round_even((capacity - productivity) / nullif(capacity, 0) * 100, 0), 0)",
    "round_even(forecast - capacity, 0)",
    "round_even((forecast - actual_volume) / nullif(actual_volume, 0) * 100, 1)",
    "round_even((actual_volume - productivity) / nullif(actual_volume, 0) * 100, 1)",
    "round_even(inventory_mean, 2)",
)


def _board(rows: str, names: str) -> str:
    kpis = ", ".join(f'{expr} AS "{name}"' for expr, name in zip(_KPI_SQL, BOARD_KPIS))
    return f"""SELECT department_id, department_name, month, {kpis} FROM (
        SELECT department_id, department_name, CAST(unnest(generate_series(TIMESTAMP '2001-01-01', TIMESTAMP '2002-02-01',
            INTERVAL 1 MONTH)) AS DATE) AS month FROM (SELECT DISTINCT department_id, department_name FROM {names}))
        LEFT JOIN {rows} USING (department_id, department_name, month)"""


_define("t_board", _board("t_board_rows", "t_facts"))
_define("t_small_board", _board("t_small_rows", "t_actuals"))
_define("t_zero_rows", """SELECT department_id, department_name, month, forecast, productivity, inventory_mean,
    CASE WHEN month(month) % 2 = 0 THEN actual_volume ELSE 0 END AS actual_volume,
    CASE WHEN month(month) % 2 = 0 THEN capacity ELSE 0 END AS capacity FROM t_small_rows""")
_define("t_zero_board", _board("t_zero_rows", "t_actuals"))


def _long(board: str) -> str:
    parts = [
        f"""SELECT strftime(month, '%m-%y') AS label, department_id, department_name, '{k}' AS "KPI", CAST("{k}" AS DOUBLE) AS total
        FROM {board}""" for k in BOARD_KPIS
    ]
    return " UNION ALL ".join(parts)


_define("t_board_long", _long("t_board"))
_define("t_small_long", _long("t_small_board"))
_LABELS = [f"{m:02d}-01" for m in range(1, 13)] + ["01-02", "02-02"]

_define("t_consolidated", """SELECT * FROM t_actuals UNION ALL
    SELECT vertical, department_id, department_name, month, NULL FROM t_projection p JOIN t_scope USING (department_id)
    WHERE NOT EXISTS (SELECT 1 FROM t_actuals a WHERE a.department_id = p.department_id AND a.month = p.month)""")
_define("t_user_weeks", """SELECT user_id * 100000 + CAST(floor(date_diff('day', DATE '1970-01-05', CAST(ts AS DATE)) / 7.0) AS BIGINT)
    AS department_id, CAST(ts AS DATE) AS day, CAST(count(*) AS DOUBLE) AS tickets FROM events GROUP BY ALL""")

_define("t_tested", """SELECT CAST(unnest(generate_series(TIMESTAMP '2000-07-01', TIMESTAMP '2001-06-01', INTERVAL 1 MONTH)) AS DATE) AS month""")


def _backtested(daily: str, tag: str) -> None:
    """Naive forecasts of the tested months from the days before them, and all months of all departments."""
    _define(f"t_before{tag}", f"""SELECT month, department_id, min(day) AS first_day, max(day) AS last_day
        FROM {daily} JOIN t_tested ON day < month GROUP BY ALL""")
    _define(f"t_ahead{tag}", f"""SELECT month, department_id, horizon, last_day, last_day + CAST(step AS INTEGER) AS day,
        least(last_day - first_day + 1, 7) AS week, (step - 1) % least(last_day - first_day + 1, 7) AS place
        FROM (SELECT *, unnest(range(1, horizon + 1)) AS step FROM (
            SELECT *, date_diff('day', last_day, CAST(month + INTERVAL 1 MONTH AS DATE)) - 1 AS horizon FROM t_before{tag}))""")
    _define(f"t_naive_months{tag}", f"""SELECT a.month, a.department_id, min(horizon) AS horizon_days, sum(coalesce(d.tickets, 0)) AS forecast
        FROM t_ahead{tag} a LEFT JOIN {daily} d ON d.department_id = a.department_id
            AND d.day = a.last_day - CAST(a.week AS INTEGER) + 1 + CAST(a.place AS INTEGER)
        WHERE {_month('a.day')} = a.month GROUP BY ALL""")
    _define(f"t_naive_tested{tag}", f"""SELECT department_id, month, horizon_days, forecast, coalesce(actual, 0) AS actual,
        forecast IS NOT NULL AS has_forecast
        FROM (SELECT DISTINCT department_id FROM {daily}) CROSS JOIN t_tested
        LEFT JOIN t_naive_months{tag} USING (department_id, month)
        LEFT JOIN (SELECT department_id, {_month('day')} AS month, sum(tickets) AS actual FROM {daily} GROUP BY ALL) USING (department_id, month)""")


_define("t_thinned", """SELECT * FROM t_daily WHERE NOT (day BETWEEN DATE '2000-12-16' AND DATE '2001-02-28' AND department_id % 4 = 1)
    AND NOT (day < DATE '2000-10-01' AND department_id % 4 = 2)""")
_backtested("t_daily", "")
_backtested("t_thinned", "_thin")

_define("t_customer_labels", """SELECT CAST(c_nationkey AS BIGINT) AS department_id, c_custkey // 2 AS place,
    CASE WHEN c_nationkey % 5 = 0 OR c_custkey % 3 = 0 THEN 'STL' WHEN c_custkey % 3 = 1 THEN 'SARIMAX-7' ELSE 'Prophet' END AS model
    FROM customer""")
_define("t_label_kept", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY department_id ORDER BY place DESC, model DESC) AS back,
    count(*) OVER (PARTITION BY department_id, place) AS tied, min(model) OVER (PARTITION BY department_id, place) AS least
    FROM t_customer_labels) WHERE back = 1""")
_define("t_label_lists", """SELECT department_id, count(*) AS entries, string_agg(DISTINCT model, ', ' ORDER BY model) AS labels, max(model) AS greatest
    FROM t_customer_labels GROUP BY department_id HAVING count(DISTINCT model) > 1""")

# --- statements --------------------------------------------------------------

_FOUR_KEYS = f"vertical, department_id, department_name, {_day('month')}"
_POST = ", ".join([
    _num("forecast_p50"), _num("forecast_p05"), _num("forecast_p95"), "days_covered",
    _num("rate_used", "deflection_rate_recent"), _num("p50_post", "forecast_p50_post_deflection"),
    _num("p05_post", "forecast_p05_post_deflection"), _num("p95_post", "forecast_p95_post_deflection"),
])


def _calibrated(factor: str) -> str:
    scaled = ", ".join(_num(f"{q}_post * {factor}", f"forecast_{q}_post_deflection_cal") for q in ("p50", "p05", "p95"))
    return f"SELECT {_FOUR_KEYS}, {_POST}, {_num(factor, 'calib_factor')}, {scaled} FROM t_calibrated"


def _series(table: str, value: str, time: str = "month") -> str:
    return f"SELECT department_id, {_day(time)}, {_num(value)} FROM {table}"


_FORECAST_KPIS = "('Forecast', 'Forecast Accuracy', 'Expected Forecast vs Capacity', 'Forecast Error %')"
_FORECAST = f"department_id, {_day('day', 'date')}, {_num('p50')}, {_num('p05')}, {_num('p95')}"

_STATEMENTS: dict[str, str] = {
    "incoming_normalised": f"""SELECT {_day("CASE WHEN o_orderkey % 50 <> 0 THEN day END", "date")},
        CASE WHEN o_orderkey % 40 <> 0 AND o_orderkey % 33 <> 0 THEN department_id END AS department_id,
        CASE WHEN o_orderkey % 60 <> 0 THEN CAST(o_orderkey % 3 + 1 AS DOUBLE) END AS ticket_total FROM t_orders""",
    "default_ticket_count": f"SELECT department_id, {_day('day', 'date')}, {_num('tickets')} FROM t_events",
    "scoped_departments": "SELECT * FROM t_scope",
    "map_conflicts": """SELECT CAST(c_nationkey AS BIGINT) AS department_id, count(DISTINCT c_mktsegment) AS entries
        FROM customer GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) > 1""",
    "source_fallback": f"""SELECT {_day(_month('o_orderdate'), 'month')}, count(*) AS rows FROM orders GROUP BY ALL""",
    "absent_source": "SELECT DISTINCT department_id, CAST(0 AS DOUBLE) AS deflection_rate_recent FROM t_actuals",
    "labels_merge": "SELECT department_id, model FROM t_labels",
    "model_error_table": f"""SELECT CAST(NULL AS VARCHAR) AS vertical, department_id, n_name AS department_name,
        'STL' AS model_used, CAST(12 AS BIGINT) AS backtest_months, CAST(20 AS DOUBLE) AS mape_pct,
        CAST(20 AS DOUBLE) AS wape_pct, {_num('bias_pct')} FROM t_bias""",
    "daily_tickets": f"SELECT department_id, {_day('day', 'date')}, {_num('tickets')} FROM t_daily",
    "monthly_actuals": f"SELECT {_FOUR_KEYS}, {_num('actual_volume')} FROM t_actuals",
    "training_uplift": f"""SELECT {_FOUR_KEYS}, {_num('actual_volume + coalesce(calls_not_indexed, 0)', 'actual_volume')}
        FROM t_actuals LEFT JOIN t_calls_summed USING (department_id, month)""",
    "deflection_monthly_form": _series("t_solved", "solved"),
    "deflection_by_name": f"""SELECT department_id, {_day('month')}, {_num('sum(l_tax)', 'solved')}
        FROM t_lines JOIN t_map USING (department_id) GROUP BY department_id, t_lines.month""",
    "deflection_event_form": _series("t_solved_events", "solved"),
    "calls_monthly_quantity": _series("t_calls_summed", "calls_not_indexed"),
    "calls_monthly_by_team": _series("t_calls", "calls_not_indexed"),
    "repeats_monthly": _series("t_repeats", "repeats_workload"),
    "inherited_backlog": _series("t_backlog", "inventory"),
    "backlog_monthly_form": f"""SELECT department_id, {_day('month')}, {_num('sum(l_linenumber)', 'inventory')}
        FROM t_lines GROUP BY department_id, t_lines.month""",
    "backlog_mean_of_days": _series("t_backlog_mean", "inventory_mean"),
    "recent_deflection_rate": f"SELECT department_id, {_num('deflection_rate_recent')} FROM t_solved_rate",
    "recent_deflection_rate_zero": f"SELECT department_id, {_num('deflection_rate_recent')} FROM t_solved_rate_zero",
    "recent_calls_rate": f"SELECT department_id, {_num('calls_not_indexed_rate_recent')} FROM t_calls_rate",
    "calls_rates_kept": f"""SELECT department_id, {_day('month')}, {_num('actual_volume')},
        {_num('coalesce(calls_not_indexed, 0)', 'calls_not_indexed')},
        {_num('coalesce(calls_not_indexed, 0) / actual_volume', 'rate')}
        FROM t_actuals LEFT JOIN t_calls USING (department_id, month)
        WHERE actual_volume > 0 AND coalesce(calls_not_indexed, 0) / actual_volume < 3.0""",
    "recent_repeats_rate": f"SELECT department_id, {_num('repeats_rate_recent')} FROM t_repeats_rate",
    "dense_daily": f"SELECT department_id, {_day('day', 'date')}, {_num('tickets')} FROM t_dense_orders",
    "dense_monthly": _series("t_backlog_dense", "inventory"),
    "horizon_daily": f"""SELECT department_id, {_int('step')}, {_day('last_day + CAST(step AS INTEGER)', 'date')}
        FROM (SELECT *, unnest(range(1, 366)) AS step FROM (
            SELECT department_id, max(day) AS last_day FROM t_daily GROUP BY ALL))""",
    "horizon_monthly": f"""SELECT department_id, {_int('step')},
        {_day('last_month + to_months(CAST(step AS INTEGER))', 'month')} FROM (
        SELECT *, unnest(range(1, 13)) AS step FROM (
            SELECT department_id, max(month) AS last_month FROM t_actuals GROUP BY ALL))""",
    "daily_profile": f"""SELECT p.department_id, {_int('days')}, {_day('first_day')}, {_day('last_day')},
        {_num('mean_tickets')}, {_int('lag_diffs')}, {_num('lag_sd')},
        {_num('first_of_week')}, {_num('week_sum')}, {_day('last_day + 1', 'next_day')}
        FROM t_profile_orders p JOIN (SELECT department_id, sum(tickets) AS week_sum,
            arg_min(tickets, day) AS first_of_week FROM t_week_orders GROUP BY ALL) w USING (department_id)""",
    "backlog_profile": f"""SELECT department_id, {_int('months')}, {_day('last_month')}, {_num('last_value')},
        {_num('spread')} FROM t_backlog_profile""",
    "working_days_per_month": f"""SELECT {_day('month')}, strftime(month, '%m-%y') AS label, {_int('working_days')}
        FROM t_wdays WHERE month IN (SELECT month FROM t_lines)""",
    "seasonal_naive_daily": f"SELECT {_FORECAST} FROM t_naive_orders",
    "short_series_forecast": f"""SELECT {_FORECAST}, 'Baseline(STL)' AS engine_used, 'naive' AS path_used,
        FALSE AS engine_failed FROM t_naive_events""",
    "monthly_rollup": f"""SELECT {_FOUR_KEYS}, {_num('forecast_p50')}, {_num('forecast_p05')}, {_num('forecast_p95')},
        days_covered FROM t_rollup""",
    "quantile_violations": f"""SELECT department_id, {_day('month')}, {_num('forecast_p50')}, {_num('forecast_p05')},
        {_num('forecast_p95')} FROM (SELECT l_suppkey AS department_id, {_month('l_shipdate')} AS month,
            avg(l_quantity) AS forecast_p50, min(l_linenumber) AS forecast_p05, max(l_quantity) - 10 AS forecast_p95
            FROM lineitem GROUP BY ALL)
        WHERE forecast_p05 > forecast_p50 OR forecast_p50 > forecast_p95""",
    "stl_reconstruction": f"""SELECT department_id, count(*) AS days, {_num('sum(ln(1 + tickets))', 'log_sum')}
        FROM t_dense_orders GROUP BY department_id""",
    "engine_dispatch": f"""SELECT department_id, coalesce(model, 'Baseline(STL)') AS engine_used,
        CASE WHEN model = 'SARIMAX-7' THEN 'sarima' WHEN days >= 56 THEN 'stl' ELSE 'naive' END AS path_used,
        CAST(365 AS BIGINT) AS days, {_day('last_day + 1', 'first_day')}, {_day('last_day + 365', 'last_day')},
        CAST(0 AS BIGINT) AS low_above_middle, CAST(0 AS BIGINT) AS middle_above_high, CAST(0 AS BIGINT) AS negative
        FROM t_profile_orders LEFT JOIN t_labels USING (department_id)""",
    "backlog_hold_forecast": f"""SELECT department_id, {_day('month')}, {_num('p50')}, {_num('p05')}, {_num('p95')},
        'hold' AS path_used FROM t_hold""",
    "stl_forecast_invariants": """SELECT department_id, 'stl' AS path_used, CAST(365 AS BIGINT) AS rows,
        CAST(0 AS BIGINT) AS not_periodic, CAST(0 AS BIGINT) AS lopsided, CAST(0 AS BIGINT) AS out_of_order
        FROM t_profile_orders WHERE days >= 56""",
    "backlog_fit_invariants": """SELECT department_id, CASE WHEN date_diff('month', min(month), max(month)) >= 17
            THEN 'stl' ELSE 'hold' END AS path_used, CAST(12 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS not_periodic,
        CAST(0 AS BIGINT) AS lopsided, CAST(0 AS BIGINT) AS out_of_order FROM t_lines GROUP BY department_id""",
    "implausible_series": f"""SELECT department_id, {_day('first_day')}, {_day('last_day')}, {_int('days')} FROM (
        SELECT department_id, min(day) AS first_day, max(day) AS last_day, max(day) - min(day) + 1 AS days
        FROM t_daily GROUP BY department_id) WHERE days > 1826""",
    "naive_spread_short": f"""SELECT department_id, {_int('days')}, {_num('mean_tickets')},
        {_num('greatest(1, sqrt(greatest(mean_tickets, 1)))', 'spread')} FROM (
        SELECT department_id, max(day) - min(day) + 1 AS days, sum(tickets) / (max(day) - min(day) + 1) AS mean_tickets
        FROM t_user_weeks GROUP BY department_id)""",
    # department_id, MAPE %, WAPE %, bias %.
    "published_error_calibration": f"""SELECT department_id, department_name, {_num('mape', 'mape_pct')},
        {_num('wape', 'wape_pct')}, {_num('bias', 'bias_pct')},
        {_num('least(greatest(1 - bias / 100.0, 0.7), 1.3)', 'calib_factor')}
        FROM (VALUES (7, 29.35, 26.00, -0.40), (8, 43.80, 39.12, 12.64), (11, 27.76, 22.27, -4.06),
            (23, 31.44, 25.79, -1.79), (5, 20.88, 17.68, -2.70), (9, 17.29, 14.44, -3.07),
            (10, 28.77, 23.23, -1.12), (12, 20.88, 20.99, -5.14), (13, 27.76, 25.91, 7.36),
            (14, 26.60, 21.38, 5.29), (15, 40.03, 30.97, -9.47), (3, 18.63, 18.70, 1.28),
            (1, 24.80, 22.19, 0.58), (18, 54.89, 38.55, -7.28), (2, 28.56, 24.46, -1.36),
            (21, 42.25, 41.25, 17.26)) AS e(id, mape, wape, bias) JOIN t_map ON id = department_id""",
    "workload_identities": f"""SELECT {_day('month')}, department_name, {_num('actual_volume', 'actual')},
        {_num('calls_actual', 'calls')}, {_num('repeats_actual', 'repeats')}, {_num('capacity')}, {_num('productivity')},
        human IS NOT NULL AS has_forecast, FALSE AS parts_differ, FALSE AS gap_differs FROM t_facts""",
    "backtest_errors_naive": f"""SELECT department_id, 'naive' AS engine, count(*) FILTER (has_forecast) AS backtest_months,
        count(*) FILTER (NOT has_forecast) AS months_without_forecast,
        {_num('avg(CASE WHEN actual > 0 THEN abs(forecast - actual) / actual * 100 END)', 'mape_pct')},
        {_num('sum(abs(forecast - actual)) / nullif(sum(actual) FILTER (has_forecast), 0) * 100', 'wape_pct')},
        {_num('sum(forecast - actual) / nullif(sum(actual) FILTER (has_forecast), 0) * 100', 'bias_pct')}
        FROM t_naive_tested GROUP BY department_id""",
    "backtest_months_naive": f"""SELECT department_id, {_day('month')}, 'naive' AS engine, CASE WHEN has_forecast THEN 'naive' END AS path_used,
        {_int('horizon_days')}, {_num('forecast')}, {_num('actual')}, has_forecast FROM t_naive_tested_thin""",
    "backtest_invariants": f"""SELECT department_id, engine,
        CASE WHEN engine = 'SARIMAX-7' THEN 'sarima' ELSE 'stl' END AS path_used, count(*) AS months,
        {_num('sum(actual)', 'actual')}, {_int('sum(horizon_days)', 'horizon_days')}, CAST(0 AS BIGINT) AS impossible
        FROM t_naive_tested, (VALUES ('STL'), ('SARIMAX-7')) AS e(engine) GROUP BY department_id, engine""",
    "backtest_recommendation": """SELECT department_id, department_name, TRUE AS is_least, count(*) FILTER (has_forecast) AS backtest_months,
        count(*) FILTER (NOT has_forecast) AS months_without_forecast, TRUE AS errors_follow, TRUE AS factor_follows
        FROM t_naive_tested JOIN t_map USING (department_id) GROUP BY department_id, department_name""",
    "sarima_recursion": f"""SELECT p.department_id, {_int('days')}, CAST(365 AS BIGINT) AS steps, {_day('last_day + 1', 'first_day')},
        {_num('log_sum')}, CAST(0 AS BIGINT) AS broken, CAST(0 AS BIGINT) AS noisy, CAST(0 AS BIGINT) AS out_of_bounds, CAST(0 AS BIGINT) AS not_followed
        FROM t_profile_orders p JOIN (SELECT department_id, sum(ln(1 + tickets)) AS log_sum FROM t_dense_orders GROUP BY ALL) USING (department_id)
        WHERE days >= 35""",
    "tenure_targets": f"""SELECT a.agent_id, a.department_id, {_day('start_date')}, a.tenure_months, seniority,
        {_num('base + a.department_id % 3', 'item_target_day')}
        FROM (SELECT *, CAST(date_diff('month', start_date, DATE '2001-06-30') AS BIGINT)
                AS tenure_months FROM (
            SELECT s_suppkey AS agent_id, CAST(s_nationkey AS BIGINT) AS department_id,
                CASE WHEN s_suppkey % 7 <> 0 THEN first_day END AS start_date
            FROM supplier LEFT JOIN (SELECT l_suppkey, min(CAST(l_shipdate AS DATE)) AS first_day FROM lineitem GROUP BY ALL)
                ON s_suppkey = l_suppkey)) a
        LEFT JOIN (VALUES ('new', 1, 74, 5), ('grown', 76, 77, 8), ('senior', 78, 999, 12)) AS r(seniority, low, high, base)
        ON tenure_months BETWEEN low AND high""",
    "holiday_flags": f"""SELECT department_id, {_day('day', 'date')}, {_num('tickets')}, label AS holiday,
        CAST(label IS NOT NULL AS BIGINT) AS is_holiday FROM t_daily LEFT JOIN (VALUES (12, 24, 'Christmas Eve'),
            (12, 25, 'Christmas Day'), (12, 26, 'Boxing/St. Stephen'), (12, 31, 'New Year Eve'), (1, 1, 'New Year Day'),
            (1, 6, 'Epiphany')) AS h(m, d, label) ON month(day) = m AND day(day) = d""",
    "deflection_applied": f"SELECT {_FOUR_KEYS}, {_POST} FROM t_deflected",
    "calls_and_repeats_forecast": f"""SELECT {_FOUR_KEYS}, {_num('forecast_p50')}, {_num('forecast_p05')},
        {_num('forecast_p95')}, days_covered,
        {_num('coalesce(calls_not_indexed_rate_recent, 0)', 'calls_not_indexed_rate_recent')},
        {_num('forecast_p50 * coalesce(calls_not_indexed_rate_recent, 0)', 'calls_not_indexed_forecast')},
        {_num('coalesce(repeats_rate_recent, 0)', 'repeats_rate_recent')},
        {_num('forecast_p50 * coalesce(repeats_rate_recent, 0)', 'repeats_forecast')}
        FROM t_rollup LEFT JOIN t_calls_rate USING (department_id) LEFT JOIN t_repeats_rate USING (department_id)""",
    "backlog_final": f"""SELECT {_FOUR_KEYS}, {_num('b.inventory', 'inventory_actual')}, {_num('h.p50', 'inventory_forecast')},
        {_num('coalesce(b.inventory, h.p50, 0)', 'inventory_final')}
        FROM (SELECT *, CAST(unnest(generate_series(TIMESTAMP '2000-06-01', TIMESTAMP '2003-12-01', INTERVAL 1 MONTH))
            AS DATE) AS month FROM t_scope)
        LEFT JOIN t_backlog b USING (department_id, month) LEFT JOIN t_hold h USING (department_id, month)""",
    "bias_calibration": _calibrated("calib_factor"),
    "identity_calibration": _calibrated("1.0"),
    "calibrated_share": f"""SELECT {_num('avg(CASE WHEN calib_factor <> 1 THEN 1 ELSE 0 END)', 'calibrated_share')}
        FROM t_calibrated""",
    "agent_days_by_day": f"""SELECT department_id, {_day('day', 'date')}, agents_day, {_num('target_mean_day')},
        {_num('prod_sum_day')} FROM t_agent_days""",
    "agent_days_without_ids": f"""SELECT department_id, {_day('day', 'date')}, rows_day AS agents_day,
        {_num('target_mean_day')}, {_num('prod_sum_day')} FROM t_agent_days""",
    "agent_days_by_outer_joins": f"""SELECT department_id, {_day('day', 'date')}, agents_day, {_num('target_mean_day')},
        {_num('prod_sum_day')} FROM t_agent_days""",
    "agent_capacity": f"""SELECT department_id, {_day('month')}, {_num('capacity_agents')},
        {_num('productivity_agents')} FROM t_agents""",
    "historical_capacity_total": f"""SELECT department_id, {_day('month')}, {_num('sum(l_quantity)', 'capacity')}
        FROM t_lines GROUP BY department_id, t_lines.month""",
    "historical_capacity_wdays": f"""SELECT department_id, {_day('month')}, {_num('capacity')} FROM (
        SELECT department_id, month, sum(l_discount * working_days) AS capacity
        FROM t_lines JOIN t_wdays USING (month) GROUP BY ALL)""",
    "historical_capacity_hours": _series("t_hours", "capacity"),
    "capacity_projection": _series("t_projection", "capacity"),
    "capacity_projection_from_actuals": f"""{_series('t_hours', 'capacity')}
        UNION ALL {_series('t_projection_actuals', 'capacity')}""",
    "capacity_consolidation": f"""SELECT {_FOUR_KEYS}, {_num('actual_volume')}, {_num('capacity_agents')},
        {_num('productivity_agents')}, {_num('coalesce(productivity_agents, capacity_agents, o.capacity)', 'productivity')},
        {_num('coalesce(capacity_agents, o.capacity)', 'capacity')}
        FROM t_consolidated LEFT JOIN t_agents USING (department_id, month)
        LEFT JOIN t_capacity_all o USING (department_id, month)""",
    "capacity_consolidation_plain": f"""SELECT {_FOUR_KEYS}, {_num('actual_volume')}, {_num('capacity_agents')},
        {_num('productivity_agents')}, {_num('coalesce(capacity_agents, o.capacity)', 'productivity')},
        {_num('coalesce(capacity_agents, o.capacity)', 'capacity')}
        FROM t_consolidated LEFT JOIN t_agents USING (department_id, month)
        LEFT JOIN t_capacity_all o USING (department_id, month)""",
    "expected_volumes_calibrated": f"""SELECT {_FOUR_KEYS}, {_num('p50_post * calib_factor', 'forecast')},
        {_num('forecast_p50', 'forecast_base')}, {_num('p50_post * calib_factor', 'forecast_human_cases_cal')},
        {_num('forecast_p50 * rate_used', 'deflected_forecast')}, {_num('actual_volume')}
        FROM t_calibrated LEFT JOIN t_actuals USING (vertical, department_id, department_name, month)""",
    "history_only_months": f"""SELECT {_FOUR_KEYS}, {_num('actual_volume')} FROM t_actuals x
        WHERE year(month) = 2001 AND NOT EXISTS (
            SELECT 1 FROM t_rollup y WHERE y.department_id = x.department_id AND y.month = x.month)""",
    "department_names": "SELECT DISTINCT department_name FROM t_actuals",
    "board_keys": """SELECT c_name || '/' || c_mktsegment || ':x' AS name,
        substr('Board_' || c_name || '_' || c_mktsegment || '_x_2627', 1, 31) AS board_key FROM customer""",
    "workload_vs_capacity": f"""SELECT {_day('month', '"Month"')}, vertical AS "Vertical", department_name AS "Department_name",
        {_num('actual_volume', '"Actual Volume"')}, {_num('calls_actual', '"Calls not indexed (actual)"')},
        {_num('repeats_actual', '"Repeats (actual)"')},
        {_num('coalesce(actual_volume, 0) + calls_actual + repeats_actual',
              '"Actual Workload (Cases + calls not indexed + repeats)"')},
        {_num('forecast_p50', '"Forecast (Cases)"')},
        {_num('calls_forecast', '"Calls not indexed (forecast)"')},
        {_num('repeats_forecast', '"Repeats (forecast)"')},
        {_num('forecast_p50 * rate_used', '"Deflected forecast"')},
        {_num('human', '"Forecast after deflection (Human cases)"')},
        {_num('coalesce(inventory_final, 0)', '"Inventory"')},
        {_num('human + calls_forecast + repeats_forecast + inventory_final',
              '"Workload Forecast (Humans + calls not indexed + repeats + inventory)"')},
        {_num('capacity', '"Capacity"')}, {_num('productivity', '"Productivity"')},
        {_num('human + calls_forecast + repeats_forecast + inventory_final - capacity',
              '"Expected Workload vs Capacity"')} FROM t_facts""",
    "capacity_report": f"""SELECT {_day('month', '"Month"')}, vertical AS "Vertical", department_name AS "Department_name",
        {_num('inventory_mean', '"Inventory"')}, {_num('actual_volume', '"Actual Volume"')},
        {_num('productivity', '"Productivity"')}, {_num('actual_volume - productivity', '"Actual Volume vs Productivity"')},
        {_num('forecast_p50', '"Forecast"')}, {_num('forecast_p50 * rate_used', '"Deflected forecast"')},
        {_num('(forecast_p50 - actual_volume) / nullif(actual_volume, 0)', '"Forecast accuracy"')},
        {_num('productivity - capacity', '"Difference Capacity vs Productivity"')}, {_num('capacity', '"Capacity"')},
        {_num('forecast_p50 - capacity', '"Expected Forecast vs Capacity"')} FROM t_facts""",
    "board_kpis_long": f"""SELECT label AS "Month", department_id, department_name, "KPI", {_num('total', '"Total"')} FROM t_board_long""",
    "board_wide": "SELECT department_id, department_name, \"KPI\", " + ", ".join(
        _num(f"max(total) FILTER (label = '{m}')", f'"{m}"') for m in _LABELS
    ) + """ FROM (SELECT * FROM t_board_long UNION ALL SELECT label, department_id, department_name, 'Comments', NULL FROM t_board_long)
        GROUP BY department_id, department_name, "KPI\"""",
    "run_log": """SELECT 'departments' AS stage, count(*) AS rows FROM t_map
        UNION ALL SELECT 'daily_tickets', count(*) FROM t_daily JOIN t_scope USING (department_id)
        UNION ALL SELECT 'monthly_actuals', count(*) FROM t_actuals
        UNION ALL SELECT 'deflection', count(*) FROM t_solved
        UNION ALL SELECT 'calls', count(*) FROM t_calls
        UNION ALL SELECT 'repeats', count(*) FROM t_repeats
        UNION ALL SELECT 'backlog', count(*) FROM t_backlog
        UNION ALL SELECT 'backlog_mean', count(*) FROM t_backlog_mean
        UNION ALL SELECT 'capacity_history', count(*) FROM t_hours
        UNION ALL SELECT 'agents', count(*) FROM t_agents
        UNION ALL SELECT 'daily_forecast', count(*) FROM t_naive_orders JOIN t_scope USING (department_id)
        UNION ALL SELECT 'backlog_forecast', count(*) FROM t_hold
        UNION ALL SELECT 'label_conflicts', 0
        UNION ALL SELECT 'implausible_series', 0
        UNION ALL SELECT 'engine_failures', 0
        UNION ALL SELECT 'monthly_forecast', count(*) FROM t_rollup
        UNION ALL SELECT 'calibrated_rows', count(*) FROM t_calibrated WHERE calib_factor <> 1
        UNION ALL SELECT 'facts', count(*) FROM t_facts""",
    "board_months": f"SELECT department_id, department_name, {_day('month')}, " + ", ".join(
        _num(f'"{k}"', f'"{k}"') for k in BOARD_KPIS) + " FROM t_small_board",
    "board_months_zero_filled": f"SELECT department_id, department_name, {_day('month')}, " + ", ".join(
        _num(f'"{k}"', f'"{k}"') for k in BOARD_KPIS) + " FROM t_zero_board",
    "board_gap_text": f"""SELECT department_id, department_name, {_day('month')},
        CAST(CAST("Difference Capacity vs Productivity" AS BIGINT) AS VARCHAR) || '%' AS capacity_gap FROM t_small_board""",
    "board_folders": f"""SELECT department_id, 'Specialists of the second level ' || department_name AS department_name,
        'Board_Specialists of the second' AS board_key, CAST(11 AS BIGINT) AS kpis,
        {_num("sum(total) FILTER (label = '01-01')", 'january')}, {_num("sum(total) FILTER (label = '06-01')", 'june')}
        FROM t_small_long GROUP BY department_id, department_name""",
    "months_rewritten": f"""SELECT vertical, department_id, department_name, {_day('month')},
        {_num("CASE WHEN month = DATE '2001-03-01' THEN 2 ELSE 1 END * actual_volume", 'actual_volume')} FROM t_actuals
        WHERE month BETWEEN DATE '2001-01-01' AND DATE '2001-06-01' AND NOT (month = DATE '2001-04-01' AND vertical = '{VERTICALS[0]}')""",
    "label_conflicts": """SELECT 'sequence' AS source, department_id, entries, labels, model AS kept,
            CASE WHEN least < model THEN 'alphabet' ELSE 'sequence' END AS decided_by FROM t_label_lists JOIN t_label_kept USING (department_id)
        UNION ALL SELECT 'none', department_id, entries, labels, greatest, 'alphabet' FROM t_label_lists""",
    "labels_in_sequence": "SELECT department_id, model FROM t_label_kept",
    "monthly_rollup_fitted": f"""SELECT {_FOUR_KEYS}, days_covered, FALSE AS sums_differ, FALSE AS out_of_order FROM t_rollup""",
    "monthly_chain_fitted": f"""SELECT {_FOUR_KEYS}, days_covered, {_num('rate_used', 'deflection_rate_recent')},
        {_num('coalesce(calls_not_indexed_rate_recent, 0)', 'calls_not_indexed_rate_recent')},
        {_num('coalesce(repeats_rate_recent, 0)', 'repeats_rate_recent')}, {_num('calib_factor')}, {_num('b.inventory', 'inventory_actual')},
        h.p50 IS NOT NULL AS has_backlog_forecast, FALSE AS deflected_differs, FALSE AS calibrated_differs, FALSE AS calls_differ,
        FALSE AS repeats_differ, FALSE AS backlog_differs
        FROM t_calibrated LEFT JOIN t_calls_rate USING (department_id) LEFT JOIN t_repeats_rate USING (department_id)
        LEFT JOIN t_backlog b USING (department_id, month) LEFT JOIN t_hold h USING (department_id, month)""",
    "backlog_final_fitted": f"""SELECT {_FOUR_KEYS}, {_num('b.inventory', 'inventory_actual')},
        CASE WHEN h.p50 IS NULL THEN NULL WHEN months >= 18 THEN 'stl' ELSE 'hold' END AS path_used,
        FALSE AS forecast_differs, CASE WHEN h.p50 IS NOT NULL THEN FALSE END AS out_of_order, FALSE AS final_differs
        FROM (SELECT *, CAST(unnest(generate_series(TIMESTAMP '2000-06-01', TIMESTAMP '2003-12-01', INTERVAL 1 MONTH))
            AS DATE) AS month FROM t_scope)
        LEFT JOIN t_backlog b USING (department_id, month) LEFT JOIN t_hold h USING (department_id, month)
        LEFT JOIN t_backlog_profile USING (department_id)""",
    "capacity_report_fitted": f"""SELECT {_day('month')}, vertical, department_name, {_num('inventory_mean', 'inventory')},
        {_num('actual_volume', 'actual')}, {_num('productivity')}, {_num('actual_volume - productivity', 'actual_gap')},
        {_num('productivity - capacity', 'productivity_gap')}, {_num('capacity')}, forecast_p50 IS NOT NULL AS has_forecast,
        FALSE AS forecast_differs, FALSE AS deflected_differs, FALSE AS accuracy_differs, FALSE AS gap_differs FROM t_facts""",
    "board_kpis_fitted": f"""SELECT label, department_id, department_name, "KPI",
        {_num(f"CASE WHEN \"KPI\" NOT IN {_FORECAST_KPIS} THEN total END", 'total')}, total IS NOT NULL AS has_total, FALSE AS differs
        FROM t_board_long""",
    "board_wide_fitted": f"""SELECT department_id, department_name, "KPI", count(total) AS months,
        {_num(f"sum(total) FILTER (\"KPI\" NOT IN {_FORECAST_KPIS})", 'total')}, CAST(0 AS BIGINT) AS differ
        FROM (SELECT * FROM t_board_long UNION ALL SELECT label, department_id, department_name, 'Comments', NULL FROM t_board_long)
        GROUP BY department_id, department_name, "KPI\"""",
    "written_tables": f"""SELECT vertical, count(*) AS rows, {_num('sum(actual_volume)', 'volume')},
        CAST(1 AS BIGINT) AS tables FROM t_actuals GROUP BY vertical""",
}


# the stages have as many rows whether their values are fitted or held
_STATEMENTS["run_log_fitted"] = _STATEMENTS["run_log"]


def all_statements() -> dict[str, str]:
    return {name: _with(select) for name, select in _STATEMENTS.items()}
