"""The registered queries as plain SQL, for a check by another engine.

Written against the test tables only; a query names the views it needs and
``sql_for`` puts their definitions in front.
"""

from __future__ import annotations

import re

from churnloom import fixed

NUM = fixed.NUMERIC_FEATURES
COUNTS = [c for c in NUM if c not in ("total_amount_paid", "avg_amount_paid", "total_secs", "avg_daily_secs")]
TOTALS = [c for c in NUM if not c.startswith("avg_")]


def r6(expr: str, name: str | None = None) -> str:
    text = f"round(CAST({expr} AS DOUBLE), 6) + 0.0"
    return f"{text} AS {name}" if name else text


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def txt(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS VARCHAR) AS {name or expr}"


def num(columns: list[str]) -> str:
    return ", ".join(big(c) if c in COUNTS else r6(c, c) for c in columns)


DEMO = "CAST(city AS BIGINT) AS city, CAST(bd AS BIGINT) AS bd, gender, CAST(registered_via AS BIGINT) AS registered_via"
STAMP = "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp"

LOG_SUMS = ", ".join(f"CAST(sum(num_{p}) AS BIGINT) AS total_num_{p}" for p in ("25", "50", "75", "985", "100", "unq"))


def _log_features(where: str) -> str:
    return f"""SELECT msno, count(*) AS total_log_days, sum(total_secs) AS total_secs,
        avg(total_secs) AS avg_daily_secs, {LOG_SUMS} FROM silver_logs {where} GROUP BY msno"""


def _txn_features(where: str) -> str:
    return f"""SELECT msno, count(*) AS total_transactions, sum(actual_amount_paid) AS total_amount_paid,
        avg(actual_amount_paid) AS avg_amount_paid, max(membership_expire_date) AS latest_expire_date,
        CAST(sum(is_auto_renew) AS BIGINT) AS auto_renew_count, CAST(sum(is_cancel) AS BIGINT) AS cancel_count
        FROM silver_transactions {where} GROUP BY msno"""


def _day(expr: str) -> str:
    return f"CAST(try_strptime(CAST({expr} AS VARCHAR), '%Y%m%d') AS DATE)"


def _cumulative(delta: str) -> str:
    sums = ", ".join(
        f"coalesce(b.{c}, 0) + sum(d.{c}) OVER (PARTITION BY d.msno ORDER BY d.day ROWS UNBOUNDED PRECEDING) AS {c}"
        for c in TOTALS
    )
    return f"""SELECT *, CASE WHEN total_transactions > 0 THEN total_amount_paid / total_transactions END AS avg_amount_paid,
        CASE WHEN total_log_days > 0 THEN total_secs / total_log_days END AS avg_daily_secs,
        CAST(day AS TIMESTAMP) AS event_timestamp
      FROM (SELECT d.day, d.msno, b.city, b.bd, b.gender, b.registered_via, {sums}
            FROM {delta} d LEFT JOIN baseline b ON d.msno = b.msno)"""


def _delta(logs: str, transactions: str) -> str:
    plays = ", ".join(f"sum(num_{p}) AS total_num_{p}" for p in ("25", "50", "75", "985", "100", "unq"))
    columns = ", ".join(f"coalesce({c}, 0) AS {c}" for c in TOTALS)
    return f"""SELECT day, msno, {columns} FROM
      (SELECT day, msno, count(*) AS total_log_days, sum(total_secs) AS total_secs, {plays}
       FROM {logs} GROUP BY day, msno)
      FULL JOIN
      (SELECT day, msno, count(*) AS total_transactions, sum(actual_amount_paid) AS total_amount_paid,
              sum(is_auto_renew) AS auto_renew_count, sum(is_cancel) AS cancel_count
       FROM {transactions} GROUP BY day, msno) USING (day, msno)"""


def _long(source: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL" for c in NUM
    )




LATE = "(CAST(msno AS BIGINT) + day(day)) % 23 = 0 AND day < DATE '2024-01-30'"


def _psi(long: str) -> str:
    return f"""SELECT event_date, feature, sum((c - r) * ln(c / r)) AS psi FROM (
        SELECT event_date, feature,
          greatest(ref_count / (sum(ref_count) OVER g + 1e-6), 1e-6) AS r,
          greatest(cur_count / (sum(cur_count) OVER g + 1e-6), 1e-6) AS c
        FROM (SELECT p.event_date, p.feature, b.bin, b.ref_count, coalesce(k.n, 0) AS cur_count
              FROM (SELECT DISTINCT event_date, feature FROM {long}) p
              JOIN bins b ON b.feature = p.feature
              LEFT JOIN (SELECT event_date, l.feature, e.bin, count(*) AS n FROM {long} l
                         JOIN bins e ON e.feature = l.feature
                          AND l.value >= e.bin_low AND (l.value < e.bin_high OR (e.bin = 9 AND l.value <= e.high))
                         GROUP BY ALL) k
                ON k.event_date = p.event_date AND k.feature = p.feature AND k.bin = b.bin)
        WINDOW g AS (PARTITION BY event_date, feature))
      GROUP BY event_date, feature"""


def _ks(long: str) -> str:
    return f"""SELECT event_date, feature, max(abs(cum_ref / n_ref - cum_cur / n_cur)) AS ks_stat,
          max(n_ref) AS ref_n, max(n_cur) AS cur_n
      FROM (SELECT event_date, feature, n_ref, n_cur,
              sum(is_ref) OVER (PARTITION BY event_date, feature ORDER BY value RANGE UNBOUNDED PRECEDING) AS cum_ref,
              sum(is_cur) OVER (PARTITION BY event_date, feature ORDER BY value RANGE UNBOUNDED PRECEDING) AS cum_cur
            FROM (SELECT event_date, feature, value, 0 AS is_ref, 1 AS is_cur FROM {long}
                  UNION ALL
                  SELECT d.event_date, r.feature, r.value, 1, 0
                  FROM (SELECT DISTINCT event_date, feature FROM {long}) d
                  JOIN baseline_long r ON r.feature = d.feature)
            JOIN (SELECT feature, count(*) AS n_ref FROM baseline_long GROUP BY feature) USING (feature)
            JOIN (SELECT event_date, feature, count(*) AS n_cur FROM {long} GROUP BY ALL) USING (event_date, feature))
      GROUP BY event_date, feature"""


def _level(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'pending' WHEN {c} < 0.10 THEN 'stable' WHEN {c} < 0.25 THEN 'warning' ELSE 'critical' END"


PVALUE = """CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2.0 * list_sum(
  [(CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END) * exp(-2e0 * k * k * x * x) for k in range(1, 101)]))) END"""

BASE_WHERE = "WHERE transaction_date <= DATE '2024-01-15'"

VIEWS = {
    "members_once": """SELECT CAST(c_custkey AS VARCHAR) AS msno, c_nationkey AS city,
        CAST(floor(c_acctbal / 100) AS INT) AS bd,
        CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'male'
             WHEN c_mktsegment = 'FURNITURE' THEN 'female' END AS gender,
        CAST(c_custkey % 5 AS INT) + 3 AS registered_via,
        DATE '2015-06-01' + CAST(c_custkey % 730 AS INT) AS d, c_custkey FROM customer""",
    "members_raw": """SELECT msno, city, bd, gender, registered_via,
        year(d) * 10000 + month(d) * 100 + day(d) AS registration_init_time FROM members_once
      UNION ALL
      SELECT msno, city, bd, gender, registered_via,
        year(d) * 10000 + month(d) * 100 + day(d) FROM members_once WHERE c_custkey % 10 = 0""",
    "orders_days": """SELECT CAST(o_custkey AS VARCHAR) AS msno, CAST(o_orderdate AS DATE) AS td,
        CAST(o_orderdate AS DATE) + 30 AS ed, o_totalprice AS actual_amount_paid,
        o_totalprice AS plan_list_price,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_auto_renew,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_cancel, o_orderkey FROM orders""",
    "transactions_raw": """SELECT msno, year(td) * 10000 + month(td) * 100 + day(td) AS transaction_date,
        year(ed) * 10000 + month(ed) * 100 + day(ed) AS membership_expire_date,
        actual_amount_paid, plan_list_price, is_auto_renew, is_cancel, 1 AS version
      FROM orders_days WHERE o_orderkey % 10 <= 7
      UNION ALL
      SELECT msno, year(td) * 10000 + month(td) * 100 + day(td),
        year(ed) * 10000 + month(ed) * 100 + day(ed),
        actual_amount_paid, plan_list_price, is_auto_renew, is_cancel, 2
      FROM orders_days WHERE o_orderkey % 10 >= 7""",
    "user_logs_raw": """SELECT CAST(user_id AS VARCHAR) AS msno,
        year(ts) * 10000 + month(ts) * 100 + day(ts) AS date,
        CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS INT) AS num_25,
        CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS INT) AS num_50,
        CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS INT) AS num_75,
        CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS INT) AS num_985,
        CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS num_100,
        CAST(count(DISTINCT event_type) AS INT) AS num_unq,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_secs
      FROM events GROUP BY user_id, year(ts) * 10000 + month(ts) * 100 + day(ts)""",
    "train_raw": """SELECT CAST(doc_id AS VARCHAR) AS msno, 1 - quality AS is_churn, 1 AS src FROM labels WHERE doc_id % 2 = 0
      UNION ALL
      SELECT CAST(doc_id AS VARCHAR), CASE WHEN doc_id % 20 = 0 THEN quality ELSE 1 - quality END, 2
      FROM labels WHERE doc_id % 2 = 1 OR doc_id % 20 = 0""",
    "silver_members": f"""SELECT msno, city, CASE WHEN bd BETWEEN 1 AND 100 THEN bd END AS bd, gender, registered_via,
        {_day('registration_init_time')} AS registration_init_time
      FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY city NULLS FIRST, bd NULLS FIRST,
              gender NULLS FIRST, registered_via NULLS FIRST, registration_init_time NULLS FIRST) AS rn FROM members_raw)
      WHERE rn = 1""",
    "silver_transactions": f"""SELECT DISTINCT msno, {_day('transaction_date')} AS transaction_date,
        {_day('membership_expire_date')} AS membership_expire_date, actual_amount_paid, plan_list_price,
        is_auto_renew, is_cancel FROM transactions_raw""",
    "silver_logs": f"""SELECT DISTINCT msno, {_day('date')} AS date, num_25, num_50, num_75, num_985, num_100,
        num_unq, total_secs FROM user_logs_raw""",
    "silver_train": """SELECT msno, is_churn FROM (SELECT *, row_number() OVER
        (PARTITION BY msno ORDER BY src DESC, is_churn DESC) AS rn FROM train_raw) WHERE rn = 1""",
    "txn_features": _txn_features(""),
    "log_features": _log_features(""),
    "gold": """SELECT * FROM silver_train LEFT JOIN silver_members USING (msno)
        LEFT JOIN txn_features USING (msno) LEFT JOIN log_features USING (msno)""",
    "base_txn": _txn_features(BASE_WHERE),
    "base_log": _log_features("WHERE date <= DATE '2024-01-15'"),
    "baseline": """SELECT *, TIMESTAMP '2024-01-15' AS event_timestamp FROM silver_train
        LEFT JOIN silver_members USING (msno) LEFT JOIN base_txn USING (msno) LEFT JOIN base_log USING (msno)""",
    "day_logs": "SELECT *, date AS day FROM silver_logs WHERE date >= DATE '2024-01-16'",
    "day_txns": """SELECT CAST(user_id AS VARCHAR) AS msno, CAST(ts AS DATE) AS day, value AS actual_amount_paid,
        CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS is_auto_renew,
        CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS is_cancel
      FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) >= DATE '2024-01-16'""",
    "delta": _delta("day_logs", "day_txns"),
    "cumulative": _cumulative("delta"),
    "timely_logs": f"SELECT * FROM day_logs WHERE NOT ({LATE})",
    "timely_txns": f"SELECT * FROM day_txns WHERE NOT ({LATE})",
    "timely_delta": _delta("timely_logs", "timely_txns"),
    "timely_cumulative": _cumulative("timely_delta"),
    "stream_days": "SELECT DISTINCT day FROM (SELECT day FROM day_logs UNION ALL SELECT day FROM day_txns)",
    "latest": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY event_timestamp DESC) AS rn
        FROM cumulative) WHERE rn = 1""",
    "event_messages": """SELECT event_id, event_type, event_id % 17 = 0 AS control,
        CASE WHEN event_type = 'purchase' THEN 'transactions' WHEN event_type = 'error' THEN 'other' ELSE 'user_logs' END AS topic,
        CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS msno,
        CASE WHEN event_id % 13 <> 0 THEN CAST(ts AS DATE) END AS day FROM events""",
    "valid": """SELECT * FROM event_messages WHERE NOT control AND topic <> 'other' AND msno <> '' AND day IS NOT NULL""",
    "request_log": """SELECT event_id AS request_id, ts,
        CASE WHEN event_type IN ('view', 'click') THEN '/predict/' ELSE '/predict/batch' END AS path,
        CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status_code,
        value / 1000 AS duration_seconds,
        CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 1 + CAST(event_id % 50 AS INT) END AS batch_size
      FROM events""",
    "score_log": """SELECT event_id AS prediction_id, ts, CAST(user_id AS VARCHAR) AS msno,
        CASE WHEN event_type IN ('view', 'click') THEN '/predict/' ELSE '/predict/batch' END AS endpoint,
        (event_id * 7919 % 1000) / 999e0 AS churn_probability,
        CASE WHEN (event_id * 7919 % 1000) / 999e0 >= 0.781e0 THEN 1 ELSE 0 END AS is_churn,
        CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS fetch_status,
        value / 1000 AS fetch_seconds FROM events""",
    "labelled": """SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
        (o_orderkey * 37 % 1000 + 150 * (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)) / 1150e0 AS p FROM orders""",
    "by_score": """SELECT p AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM labelled GROUP BY p""",
    "curve": """SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
        sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
      FROM by_score""",
    "pr": """SELECT threshold, tp / (tp + fp) AS precision, tp / all_pos AS recall,
        2 * (tp / (tp + fp)) * (tp / all_pos) / (tp / (tp + fp) + tp / all_pos + 1e-9) AS f1 FROM curve""",
    "cells": """SELECT count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp,
        count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 0 AND p < 0.5) AS tn FROM labelled""",
    "feature_names": "SELECT unnest(["
    + ", ".join(f"{{'i': {i}, 'feature': '{f}'}}" for i, f in enumerate(fixed.FEATURES))
    + "], recursive := true)",
    "contributions": """SELECT CAST(c_custkey AS VARCHAR) AS msno, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_churn,
        feature, (c_custkey * (i + 3) * 31 + i * i * 17) % 201 / 250e0 - 0.4e0 AS value FROM customer, feature_names""",
    "reason_texts": "SELECT * FROM (VALUES "
    + ", ".join(f"('{f}', '{a}', '{b}')" for f, (a, b) in fixed.REASON_TEXTS.items())
    + ") t(feature, churn_text, stay_text)",
    "baseline_long": _long("baseline"),
    "current_long": _long("cumulative", "day AS event_date"),
    "timely_long": _long("timely_cumulative", "day AS event_date"),
    "ranges": """SELECT feature, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS low,
        CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS high
      FROM (SELECT feature, min(value) AS lo, max(value) AS hi FROM baseline_long GROUP BY feature)""",
    "edges": """SELECT feature, bin, low, high, low + bin * ((high - low) / 10) AS bin_low,
        low + (bin + 1) * ((high - low) / 10) AS bin_high FROM ranges, (SELECT unnest(range(10)) AS bin)""",
    "bins": """SELECT e.*, coalesce(n, 0) AS ref_count FROM edges e LEFT JOIN
        (SELECT l.feature, e.bin, count(*) AS n FROM baseline_long l JOIN edges e ON e.feature = l.feature
           AND l.value >= e.bin_low AND (l.value < e.bin_high OR (e.bin = 9 AND l.value <= e.high)) GROUP BY ALL) k
        ON k.feature = e.feature AND k.bin = e.bin""",
    "psi": _psi("current_long"),
    "ks": _ks("current_long"),
    "drift": f"""SELECT event_date, feature, psi, {_level('psi')} AS level, ks_stat, {PVALUE} AS ks_pvalue
      FROM (SELECT *, ks_stat * sqrt(CAST(ref_n AS DOUBLE) * cur_n / (ref_n + cur_n)) AS x
            FROM psi LEFT JOIN ks USING (event_date, feature))""",
    "timely_psi": _psi("timely_long"),
    "timely_ks": _ks("timely_long"),
    "summary": f"""SELECT *, {_level('max_psi')} AS level FROM (SELECT event_date, max(psi) AS max_psi,
        count(*) FILTER (level = 'warning') AS n_warning, count(*) FILTER (level = 'critical') AS n_critical,
        count(*) AS n_features FROM drift GROUP BY event_date)""",
    "medians": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, 'median' AS stat, CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE) AS value FROM baseline"
        for c in [*NUM, "bd"]
    ),
    "modes": " UNION ALL ".join(
        f"(SELECT '{c}' AS feature, 'mode' AS stat, CAST({c} AS DOUBLE) AS value FROM baseline WHERE {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        for c in ("city", "registered_via")
    ),
    "fills": "SELECT * FROM medians UNION ALL SELECT * FROM modes",
}


def _fill(c: str) -> str:
    return f"(SELECT value FROM fills WHERE feature = '{c}')"


def _imputed(policy: str, source: str = "f") -> str:
    out = [
        f"CAST(coalesce({source}.city, {_fill('city')}) AS BIGINT) AS city",
        r6(f"coalesce({source}.bd, {_fill('bd')})", "bd"),
        f"CAST(CASE {source}.gender WHEN 'male' THEN 0 WHEN 'female' THEN 1 ELSE 2 END AS BIGINT) AS gender",
        f"CAST(coalesce({source}.registered_via, {_fill('registered_via')}) AS BIGINT) AS registered_via",
    ]
    for c in NUM:
        other = _fill(c) if policy == "median" else "0"
        out.append(r6(f"coalesce(CAST({source}.{c} AS DOUBLE), {other})", c))
    return ", ".join(out)


FEATURE_ROW = f"msno, {STAMP}, {DEMO}, {num(NUM)}"
ANY_FEATURE = " OR ".join(f"f.{c} IS NOT NULL" for c in fixed.FEATURES)


STEP = fixed.SCRAPE_SECONDS
MODELS = ["Main", "Logistic Regression", "Random Forest", "Gradient Boosting", "Neural Network (MLP)"]
WINDOW_END = "strftime(w, '%Y-%m-%d %H:%M:%S') AS window_end"


def _trail(source: str, width: int) -> str:
    """Each row in every trailing window that holds it; w is when that is read."""
    return f"""(SELECT s.*, time_bucket(INTERVAL {STEP} SECOND, ts) + to_seconds({STEP} * k) AS w
      FROM {source} s, (SELECT unnest(range(1, {width // STEP + 1})) AS k))"""


def _rate(source: str, key: str | None, width: int, name: str | None = None) -> str:
    lead = f"{key} AS {name or key}, " if key else ""
    return f"""SELECT {lead}{WINDOW_END}, count(*) AS n, {r6(f'count(*) / {width}e0', 'per_second')}
      FROM {_trail(source, width)} GROUP BY ALL"""


def _share(source: str, condition: str, width: int, extra: str = "") -> str:
    return f"""SELECT {WINDOW_END}, count(*) FILTER ({condition}) AS hits, count(*) AS n,
      {r6(f'count(*) FILTER ({condition}) / count(*)', 'ratio')}{extra} FROM {_trail(source, width)} GROUP BY ALL"""


def _exact_mean(value: str) -> str:
    """Exact sum, quotient as double; a tie in the seventh place is rounded up, as a
    decimal, since a double would fall to either side."""
    quotient = f"CAST(sum(CAST({value} AS DECIMAL(28, 9))) AS DOUBLE) / count(*)"
    return f"CAST(round(CAST({quotient} AS DECIMAL(38, 14)), 6) AS DOUBLE) + 0.0 AS mean"


def _mean(source: str, value: str, key: str = "") -> str:
    return f"""SELECT {key}{WINDOW_END}, count(*) AS n, {_exact_mean(value)}
      FROM {_trail(source, 300)} GROUP BY ALL"""


def _bounds(bounds: list[float]) -> str:
    return "[" + ", ".join(f"{b}e0" for b in bounds) + ", 'infinity'::DOUBLE]"


LE = "CASE WHEN le = 'infinity'::DOUBLE THEN -1.0 ELSE round(le, 6) + 0.0 END AS le"


def _buckets(source: str, value: str, bounds: list[float], keys: str) -> str:
    return f"""SELECT {keys}, le, count(*) FILTER ({value} <= le) AS cumulative
      FROM {source}, (SELECT unnest({_bounds(bounds)}) AS le) GROUP BY ALL"""


def _quantile(q: float, source: str, value: str, bounds: list[float], key: str) -> str:
    return f"""SELECT {key}, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_end, CAST(total AS BIGINT) AS n,
        {r6("CASE WHEN le = 'infinity'::DOUBLE THEN " + str(bounds[-1]) + " ELSE low + (le - low) * (rank - below) / (cumulative - below) END", 'quantile')},
        {q} + 0.0e0 AS q
      FROM (SELECT *, lag(cumulative, 1, 0) OVER k AS below, lag(le, 1, 0.0) OVER k AS low,
              max(cumulative) OVER (PARTITION BY {key}, w) AS total, {q}e0 * max(cumulative) OVER (PARTITION BY {key}, w) AS rank
            FROM ({_buckets(_trail(source, 300), value, bounds, f'{key}, w')})
            WINDOW k AS (PARTITION BY {key}, w ORDER BY le))
      WHERE cumulative >= rank AND below < rank"""


#: Paths through the grid of both samples that stay inside the gap, row by row.
KS_EXACT = """RECURSIVE sizes AS (
        SELECT event_date, feature, ref_n AS n, cur_n AS m, CAST(round(ks_stat * ref_n * cur_n) AS BIGINT) AS gap FROM ks),
    paths AS (
        SELECT event_date, feature, n, m, gap, 0 AS i, unnest(range(0, least(m, CAST(ceil(gap / n) AS BIGINT) - 1) + 1)) AS j, 1e0 AS ways
        FROM sizes
        UNION ALL
        SELECT c.event_date, c.feature, c.n, c.m, c.gap, c.i, c.j,
            sum(coalesce(p.ways, 0e0)) OVER (PARTITION BY c.event_date, c.feature ORDER BY c.j)
        FROM (SELECT *, unnest(range(greatest(0, CAST(floor((i * m - gap) / n) AS BIGINT) + 1),
                                     least(m, CAST(ceil((i * m + gap) / n) AS BIGINT) - 1) + 1)) AS j
              FROM (SELECT DISTINCT event_date, feature, n, m, gap, i + 1 AS i FROM paths WHERE i < n)) c
        LEFT JOIN paths p ON p.event_date = c.event_date AND p.feature = c.feature AND p.j = c.j),
    exact AS (
        SELECT s.event_date, s.feature, greatest(0e0, least(1e0,
            1 - coalesce(p.ways, 0) / exp(lgamma(s.n + s.m + 1) - lgamma(s.n + 1) - lgamma(s.m + 1)))) AS ks_pvalue
        FROM sizes s LEFT JOIN paths p ON p.event_date = s.event_date AND p.feature = s.feature AND p.i = s.n AND p.j = s.m)"""


def _report_line(name: str, p: str, r: str, f: str, n: str) -> str:
    return f"SELECT '{name}' AS line, {r6(p, 'precision')}, {r6(r, 'recall')}, {r6(f, 'f1')}, CAST({n} AS BIGINT) AS support FROM cells"


P1, R1, F1 = "tp / (tp + fp)", "tp / (tp + fn)", "2 * tp / (2 * tp + fp + fn)"
P0, R0, F0 = "tn / (tn + fn)", "tn / (tn + fp)", "2 * tn / (2 * tn + fp + fn)"
N0, N1, N = "(tn + fp)", "(tp + fn)", "(tp + fp + fn + tn)"
HASHED = "to_base64(unhex(sha256(msno)))"
def _page(page: int, size: int) -> str:
    return f"""SELECT msno, total, CAST({page} AS BIGINT) AS page, CAST(greatest(1, ceil(total / {size})) AS BIGINT) AS pages
  FROM (SELECT msno, count(*) OVER () AS total, row_number() OVER (ORDER BY msno) AS rn
        FROM (SELECT DISTINCT msno FROM (SELECT day, msno FROM day_logs UNION ALL SELECT day, msno FROM day_txns)
              WHERE day = DATE '2024-01-20')) WHERE rn BETWEEN {page * size - size + 1} AND {page * size}"""


DELTA_ROW = f"{txt('day')}, msno, {num(TOTALS)}"

SQL = {
    "scan_csv": f"SELECT msno, {big('city')}, {big('bd')}, gender, {big('registered_via')}, {big('registration_init_time')} FROM members_raw",
    "scan_parquet": f"SELECT o_custkey, o_orderstatus, {r6('o_totalprice', 'o_totalprice')} FROM orders",
    "write_partitioned": f"SELECT {txt('date')}, count(*) AS row_count, {r6('sum(total_secs)', 'total_secs')} FROM silver_logs GROUP BY date",
    "stream_append": f"SELECT {txt('day', 'event_date')}, count(*) AS row_count, {big('sum(total_log_days)', 'total_log_days')} FROM cumulative GROUP BY day",
    "baseline_scan": "SELECT msno, " + DEMO + ", " + ", ".join(
        big(f"coalesce({c}, 0)", c) if c in COUNTS else r6(f"coalesce({c}, 0)", c) for c in TOTALS
    ) + " FROM baseline",
    "replay_source": """SELECT topic, CAST(day AS VARCHAR) AS day, CAST(sum(records) AS BIGINT) AS records, CAST(sum(markers) AS BIGINT) AS markers FROM (
        SELECT 'user_logs' AS topic, day, 1 AS records, 0 AS markers FROM day_logs
        UNION ALL SELECT 'transactions', day, 1, 0 FROM day_txns
        UNION ALL SELECT 'user_logs', day, 0, 1 FROM stream_days
        UNION ALL SELECT 'transactions', day, 0, 1 FROM stream_days WHERE day < DATE '2024-01-30') GROUP BY topic, day""",
    "decode_messages": f"""SELECT 'user_logs' AS topic, msno, CAST(day AS VARCHAR) AS day_text, {big('num_25')}, {big('num_unq')},
        {r6('total_secs', 'total_secs')}, CAST(NULL AS DOUBLE) AS actual_amount_paid, CAST(NULL AS BIGINT) AS is_auto_renew,
        CAST(NULL AS BIGINT) AS is_cancel FROM day_logs
      UNION ALL SELECT 'transactions', msno, CAST(day AS VARCHAR), NULL, NULL, NULL, {r6('actual_amount_paid')},
        CAST(is_auto_renew AS BIGINT), CAST(is_cancel AS BIGINT) FROM day_txns""",
    "materialize_latest": f"""SELECT {FEATURE_ROW} FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY day DESC) AS rn
        FROM cumulative WHERE day < DATE '2024-01-28') WHERE rn = 1""",
    "import_ids": "SELECT CAST(c_custkey AS VARCHAR) AS msno FROM customer WHERE c_custkey % 9 <> 0",
    "sample_keys": f"""SELECT msno FROM (SELECT DISTINCT {HASHED} AS msno FROM cumulative) ORDER BY md5(msno || '42'), msno LIMIT 5""",
    "day_slice": f"SELECT msno, {num(NUM)} FROM cumulative WHERE day = DATE '2024-01-20'",
    "parse_dates": f"""SELECT msno, {big('transaction_date', 'day_number')}, {txt(_day('transaction_date'), 'parsed')},
        {txt(_day('transaction_date + 15'), 'shifted')}, {txt(_day('transaction_date'), 'from_text')}
      FROM transactions_raw""",
    "clean_members": f"""SELECT msno, {big('city')}, CAST(CASE WHEN bd BETWEEN 1 AND 100 THEN bd END AS BIGINT) AS bd, gender,
        {big('registered_via')}, {txt(_day('registration_init_time'), 'registration_init_time')} FROM members_raw""",
    "replay_filter": f"SELECT msno, {txt('day', 'date')}, {r6('total_secs', 'total_secs')}, {big('num_unq')} FROM day_logs",
    "valid_records": f"SELECT {txt('day')}, msno, count(*) AS records FROM valid GROUP BY ALL",
    "route_topics": f"""SELECT {txt('day')}, CASE topic WHEN 'user_logs' THEN 'logs' ELSE 'transactions' END AS route,
        count(*) AS records FROM valid GROUP BY ALL""",
    "split_control": """SELECT topic, count(*) AS records, 'control' AS kind FROM event_messages
        WHERE control AND day IS NOT NULL GROUP BY topic
      UNION ALL SELECT topic, count(*), 'data' FROM valid GROUP BY topic""",
    "oot_split": f"""SELECT msno, CASE WHEN registration_init_time < DATE '2016-06-01' THEN 'train' ELSE 'test' END AS part,
        {txt('registration_init_time')}, {big('is_churn')} FROM baseline WHERE registration_init_time IS NOT NULL""",
    "feature_matrix": f"SELECT f.msno, {_imputed('zero')}, {big('is_churn')} FROM baseline f",
    "search_churned": f"""SELECT 'text' AS form, prediction_id, msno, {r6('churn_probability', 'churn_probability')} FROM score_log
        WHERE is_churn = 1 AND contains(lower(msno), '14')
      UNION ALL SELECT 'regex', prediction_id, msno, {r6('churn_probability')} FROM score_log
        WHERE is_churn = 1 AND regexp_matches(msno, '^1.*4$')""",
    "union_versions": f"""SELECT msno, {big('transaction_date')}, {big('membership_expire_date')}, {r6('actual_amount_paid', 'actual_amount_paid')},
        {r6('plan_list_price', 'plan_list_price')}, {big('is_auto_renew')}, {big('is_cancel')} FROM transactions_raw""",
    "silver_transactions": f"""SELECT msno, {txt('transaction_date')}, {txt('membership_expire_date')}, {r6('actual_amount_paid', 'actual_amount_paid')},
        {r6('plan_list_price', 'plan_list_price')}, {big('is_auto_renew')}, {big('is_cancel')} FROM silver_transactions""",
    "silver_logs": f"""SELECT msno, {txt('date')}, {", ".join(big(f"num_{p}") for p in ("25", "50", "75", "985", "100", "unq"))},
        {r6('total_secs', 'total_secs')} FROM silver_logs""",
    "silver_members": f"SELECT msno, {DEMO}, {txt('registration_init_time')} FROM silver_members",
    "silver_train": f"SELECT msno, {big('is_churn')} FROM silver_train",
    "txn_features": f"""SELECT msno, {num([c for c in NUM if c in ("total_transactions", "total_amount_paid", "avg_amount_paid", "auto_renew_count", "cancel_count")])},
        {txt('latest_expire_date')} FROM txn_features""",
    "log_features": f"SELECT msno, {num([c for c in NUM if c.startswith('total_num') or c in ('total_log_days', 'total_secs', 'avg_daily_secs')])} FROM log_features",
    "gold_features": f"SELECT msno, {big('is_churn')}, {DEMO}, {txt('registration_init_time')}, {num(NUM)}, {txt('latest_expire_date')} FROM gold",
    "gold_features_as_of": f"SELECT msno, {big('is_churn')}, {DEMO}, {txt('registration_init_time')}, {num(NUM)}, {txt('latest_expire_date')}, {STAMP} FROM baseline",
    "daily_log_delta": f"""SELECT {txt('day')}, msno, count(*) AS total_log_days, {r6('sum(total_secs)', 'total_secs')}, {LOG_SUMS},
        {r6('sum(total_secs) / count(*)', 'avg_daily_secs')} FROM day_logs GROUP BY day, msno""",
    "daily_txn_delta": f"""SELECT {txt('day')}, msno, count(*) AS total_transactions, {r6('sum(actual_amount_paid)', 'total_amount_paid')},
        {big('sum(is_auto_renew)', 'auto_renew_count')}, {big('sum(is_cancel)', 'cancel_count')},
        {r6('sum(actual_amount_paid) / count(*)', 'avg_amount_paid')} FROM day_txns GROUP BY day, msno""",
    "daily_delta": f"SELECT {DELTA_ROW} FROM delta",
    "cumulative_features": f"SELECT {FEATURE_ROW} FROM cumulative",
    "totals_after": "SELECT msno, " + DEMO + ", " + ", ".join(
        big(f"coalesce(b.{c}, 0) + coalesce(a.{c}, 0)", c) if c in COUNTS else r6(f"coalesce(b.{c}, 0) + coalesce(a.{c}, 0)", c)
        for c in TOTALS
    ) + " FROM baseline b FULL JOIN (SELECT msno, " + ", ".join(f"sum({c}) AS {c}" for c in TOTALS) + " FROM delta GROUP BY msno) a USING (msno)",
    "active_users": f"SELECT DISTINCT {txt('day')}, msno FROM (SELECT day, msno FROM day_logs UNION ALL SELECT day, msno FROM day_txns)",
    "active_user_counts": f"""SELECT {txt('day')}, count(DISTINCT msno) AS user_count
        FROM (SELECT day, msno FROM day_logs UNION ALL SELECT day, msno FROM day_txns) GROUP BY day""",
    "replay_counts": f"""SELECT {txt('day')}, CAST(sum(l) AS BIGINT) AS log_rows, CAST(sum(t) AS BIGINT) AS transaction_rows
        FROM (SELECT day, 1 AS l, 0 AS t FROM day_logs UNION ALL SELECT day, 0, 1 FROM day_txns) GROUP BY ROLLUP (day)""",
    "replay_progress": f"""SELECT count(DISTINCT day) AS dates_done, CAST(31 AS BIGINT) AS total_days,
        {r6('least(count(DISTINCT day) / 31, 1)', 'progress')} FROM day_logs""",
    "ready_days": f"SELECT {txt('day')} FROM stream_days WHERE day < DATE '2024-01-30'",
    "pending_days": f"SELECT {txt('day')} FROM stream_days WHERE day = DATE '2024-01-30'",
    "flush_once": f"SELECT {txt('day')} FROM stream_days WHERE day > DATE '2024-01-20' AND day < DATE '2024-01-30'",
    "txn_only_days": "SELECT DISTINCT CAST(transaction_date AS VARCHAR) AS day FROM silver_transactions WHERE transaction_date NOT IN (SELECT date FROM silver_logs)",
    "asof_features": f"""SELECT e.event_id, e.msno, strftime(f.event_timestamp, '%Y-%m-%d %H:%M:%S') AS feature_timestamp,
        {big('f.city', 'city')}, {big('f.total_transactions', 'total_transactions')}, {r6('f.total_secs', 'total_secs')},
        {r6('f.avg_daily_secs', 'avg_daily_secs')}
      FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS msno, ts FROM events) e
      ASOF LEFT JOIN cumulative f ON e.msno = f.msno AND e.ts >= f.event_timestamp""",
    "asof_features_ttl": f"""SELECT e.event_id, e.msno,
        CASE WHEN fresh THEN strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') END AS feature_timestamp,
        CASE WHEN fresh THEN {r6('total_secs')} END AS total_secs
      FROM (SELECT e.event_id, e.msno, f.event_timestamp, f.total_secs, e.ts <= f.event_timestamp + INTERVAL 2 DAY AS fresh
            FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS msno, ts FROM events) e
            ASOF LEFT JOIN cumulative f ON e.msno = f.msno AND e.ts >= f.event_timestamp) e""",
    "export_csv": """SELECT msno, printf('%.4f', churn_probability) AS churn_probability, CAST(is_churn AS BIGINT) AS is_churn
      FROM score_log""",
    "score_lookup": f"""SELECT c.msno, {big('f.city', 'city')}, {r6('f.total_secs', 'total_secs')}, {big('f.total_num_unq', 'total_num_unq')},
        {txt('f.day', 'feature_date')}, f.msno IS NOT NULL AS member_found
      FROM (SELECT CAST(c_custkey AS VARCHAR) AS msno FROM customer) c LEFT JOIN latest f ON f.msno = c.msno""",
    "last_seen": f"SELECT msno, {txt('max(day)', 'feature_date')} FROM cumulative GROUP BY msno",
    "impute_stats": f"SELECT feature, stat, {r6('value', 'value')} FROM fills",
    "impute_features": f"SELECT f.msno, {_imputed('zero')} FROM baseline f",
    "impute_serving": f"SELECT f.msno, {_imputed('median')} FROM baseline f",
    "cold_start": f"""SELECT c.msno, ({ANY_FEATURE}) AS member_found, {_imputed('median')}
      FROM (SELECT CAST(c_custkey AS VARCHAR) AS msno FROM customer) c LEFT JOIN latest f ON f.msno = c.msno""",
    "label_rates": f"""SELECT part, count(*) AS row_count, {r6('avg(is_churn)', 'churn_rate')} FROM (
        SELECT CASE WHEN registration_init_time < DATE '2016-06-01' THEN 'train'
                    WHEN registration_init_time >= DATE '2016-06-01' THEN 'test' ELSE 'unsplit' END AS part, is_churn FROM baseline
        UNION ALL SELECT 'all', is_churn FROM baseline) GROUP BY part""",
    "class_weight": f"""SELECT count(*) FILTER (is_churn = 0) AS negatives, count(*) FILTER (is_churn = 1) AS positives,
        {r6('count(*) FILTER (is_churn = 0) / nullif(count(*) FILTER (is_churn = 1), 0)', 'scale_pos_weight')} FROM silver_train""",
    "null_audit": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, '{stage}' AS stage FROM {source}"
        for stage, source in (("raw", "baseline"), ("filled", f"(SELECT {_imputed('zero')}, is_churn FROM baseline f)"))
        for c in [*fixed.FEATURES, "is_churn"]
    ) + " UNION ALL " + " UNION ALL ".join(
        "SELECT 'all_columns', " + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in [*fixed.FEATURES, "is_churn"])
        + f", '{stage}' FROM {source}"
        for stage, source in (("raw", "baseline"), ("filled", f"(SELECT {_imputed('zero')}, is_churn FROM baseline f)"))
    ),
    "eval_auc": f"SELECT {r6('sum(neg * (tp - pos + pos / 2)) / (max(all_pos) * max(all_neg))', 'auc_roc')} FROM curve",
    "eval_ap": f"SELECT {r6('sum(pos / all_pos * (tp / (tp + fp)))', 'auc_pr')} FROM curve",
    "eval_logloss": f"""SELECT {r6('avg(-(y * ln(q) + (1 - y) * ln(1 - q)))', 'log_loss')}
      FROM (SELECT y, greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, p)) AS q FROM labelled)""",
    "eval_confusion": f"SELECT tp, fp, fn, tn, {r6(P1, 'precision')}, {r6(R1, 'recall')}, {r6(F1, 'f1')} FROM cells",
    "pr_curve": f"SELECT {r6('threshold', 'threshold')}, {r6('precision', 'precision')}, {r6('recall', 'recall')}, {r6('f1', 'f1')} FROM pr",
    "best_threshold": f"SELECT {r6('threshold', 'best_threshold')}, {r6('f1', 'f1')} FROM pr ORDER BY pr.f1 DESC, pr.threshold LIMIT 1",
    "class_report": " UNION ALL ".join([
        _report_line("0", P0, R0, F0, N0),
        _report_line("1", P1, R1, F1, N1),
        _report_line("accuracy", *[f"(tp + tn) / {N}"] * 3, N),
        _report_line("macro avg", f"({P0} + {P1}) / 2", f"({R0} + {R1}) / 2", f"({F0} + {F1}) / 2", N),
        _report_line("weighted avg", *[f"({a} * {N0} + {b} * {N1}) / {N}" for a, b in ((P0, P1), (R0, R1), (F0, F1))], N),
    ]),
    "roc_curve": f"SELECT {r6('threshold', 'threshold')}, {r6('fp / all_neg', 'fpr')}, {r6('tp / all_pos', 'tpr')} FROM curve",
    "top_reasons": """SELECT c.msno, CAST(c.is_churn AS BIGINT) AS is_churn, coalesce(r.reasons, '') AS reasons
      FROM (SELECT DISTINCT msno, is_churn FROM contributions) c LEFT JOIN (
        SELECT msno, string_agg(CASE WHEN is_churn = 1 THEN churn_text ELSE stay_text END, ' | ' ORDER BY rn) AS reasons
        FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY value DESC, feature) AS rn FROM contributions WHERE value > 0)
        JOIN reason_texts USING (feature) WHERE rn <= 3 GROUP BY msno) r USING (msno)""",
    "shap_ranked": f"""SELECT msno, rn - 1 AS pos, feature, {r6('value', 'value')}, {r6('abs(value) / greatest(top, 0.01)', 'magnitude')}
      FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY abs(value) DESC, feature) AS rn,
              max(abs(value)) OVER (PARTITION BY msno) AS top FROM contributions) WHERE rn <= 8""",
    "threshold_label": """SELECT prediction_id, CAST(is_churn AS BIGINT) AS flag_default,
        CAST(churn_probability >= 500 / 999e0 AS BIGINT) AS flag_on_a_score FROM score_log""",
    "prediction_stats": f"""SELECT count(*) AS total_predictions, count(*) FILTER (is_churn = 1) AS churn_count,
        count(*) FILTER (is_churn = 0) AS retain_count, {r6('avg(is_churn)', 'churn_rate')} FROM score_log""",
    "batch_summary": f"""SELECT count(*) AS total_predictions, count(*) FILTER (is_churn = 1) AS churn_count,
        count(*) FILTER (is_churn = 0) AS retain_count, {r6('avg(is_churn)', 'churn_rate')},
        printf('%.1f%%', avg(is_churn) * 100) AS rate_text, avg(is_churn) > 0.15 AS flagged
      FROM score_log WHERE endpoint = '/predict/batch'""",
    "score_hist": " UNION ALL ".join(
        f"""SELECT CAST(b.bin AS BIGINT) AS bin, {r6(f'b.bin / {n}', 'low')}, {r6(f'(b.bin + 1) / {n}', 'high')}, count(s.k) AS n, CAST({n} AS BIGINT) AS bins
        FROM (SELECT unnest(range({n})) AS bin) b LEFT JOIN
          (SELECT CAST(least(floor(churn_probability * {n}), {n - 1}) AS BIGINT) AS k FROM score_log) s ON s.k = b.bin GROUP BY b.bin"""
        for n in (20, 25)
    ),
    "churn_history": f"SELECT prediction_id, msno, {r6('churn_probability', 'churn_probability')} FROM score_log WHERE is_churn = 1 ORDER BY ts DESC, prediction_id DESC LIMIT 2000",
    "churned_top": f"""SELECT prediction_id, msno, {r6('p', 'churn_probability')} FROM
        (SELECT prediction_id, msno, churn_probability AS p FROM score_log WHERE is_churn = 1)
        ORDER BY p DESC, msno, prediction_id LIMIT 500""",
    "batch_top_risks": f"""SELECT prediction_id, msno, {r6('p', 'churn_probability')} FROM
        (SELECT prediction_id, msno, churn_probability AS p FROM score_log WHERE is_churn = 1 AND endpoint = '/predict/batch')
        ORDER BY p DESC, msno, prediction_id LIMIT 8""",
    "users_page": _page(2, 20),
    "users_page_deep": _page(4, 7),
    "train_checks": " UNION ALL ".join(
        f"""SELECT '{m}' AS model, count(*) AS row_count, count(*) AS valid_count
        FROM baseline WHERE registration_init_time >= DATE '2016-06-01'"""
        for m in MODELS
    ),
    "compare_checks": " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{p}' AS part, CAST(7 AS BIGINT) AS measures, true AS in_range" for m in MODELS[1:] for p in ("train", "test")
    ),
    "importance_checks": "SELECT CAST(18 AS BIGINT) AS features, 1.0e0 AS total",
    "score_checks": """SELECT kind, c.msno, f.msno IS NOT NULL AS member_found, true AS flag_agrees, true AS few_reasons
      FROM (SELECT CAST(c_custkey AS VARCHAR) AS msno FROM customer) c
      CROSS JOIN (SELECT unnest(['batch', 'users']) AS kind) LEFT JOIN latest f ON f.msno = c.msno""",
    "shap_additivity": "SELECT count(*) AS user_count, 0.0e0 AS largest_gap FROM customer",
    "format_scores": f"""SELECT prediction_id, CASE WHEN length(m) > 22 THEN left(m, 10) || '…' || right(m, 6) ELSE m END AS short_id,
        printf('%.1f%%', churn_probability * 100) AS probability_text
      FROM (SELECT *, CASE WHEN prediction_id % 2 = 0 THEN {HASHED} ELSE msno END AS m FROM score_log)""",
    "drift_baseline": f"""SELECT feature, CAST(bin AS BIGINT) AS bin, {r6('low', 'low')}, {r6('high', 'high')}, {r6('bin_low', 'bin_low')},
        {r6('bin_high', 'bin_high')}, CAST(ref_count AS BIGINT) AS ref_count FROM bins""",
    "drift_psi": f"SELECT {txt('event_date')}, feature, {r6('psi', 'psi')} FROM psi",
    "drift_ks": f"SELECT {txt('event_date')}, feature, {r6('ks_stat', 'ks_stat')}, ref_n, cur_n FROM ks",
    "drift_ks_pvalue": f"SELECT {txt('event_date')}, feature, {r6('ks_pvalue', 'ks_pvalue')}, ks_pvalue < 0.05 AS ks_drift FROM drift",
    "drift_ks_exact": f"SELECT {txt('event_date')}, feature, {r6('ks_pvalue', 'ks_pvalue')} FROM exact",
    "create_table": f"SELECT {txt('day', 'event_date')}, count(*) AS row_count, {big('sum(total_log_days)', 'total_log_days')} FROM cumulative GROUP BY day",
    "stream_restart": f"SELECT {txt('day', 'event_date')}, count(*) AS row_count, {big('sum(total_log_days)', 'total_log_days')} FROM cumulative GROUP BY day",
    "stream_dry_run": f"""SELECT {txt('day')}, row_number() OVER (ORDER BY day) AS seq, count(*) AS user_count, CAST(0 AS BIGINT) AS published
        FROM delta GROUP BY day""",
    "counted_days": f"""SELECT {txt('day')}, count(*) AS users, {big('sum(total_log_days)', 'log_days')},
        row_number() OVER (ORDER BY day) AS seq FROM cumulative GROUP BY day""",
    "bronze_versions": " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS row_count,
            CAST(sum(CASE WHEN msno NOT LIKE '%7' THEN {number} END) AS BIGINT) AS checksum,
            count(*) FILTER (msno LIKE '%7') AS unparsable FROM {source}"""
        for name, source, number in (
            ("members", "members_raw", "registration_init_time"),
            ("transactions", "transactions_raw", "transaction_date"),
            ("user_logs", "(SELECT * FROM user_logs_raw UNION ALL SELECT * FROM user_logs_raw)", "num_25"),
            ("train", "train_raw", "is_churn"),
        )
    ),
    "rejected_rows": """SELECT topic, CASE WHEN topic = 'other' THEN 'unknown topic' WHEN day IS NULL THEN 'no day' ELSE 'no user' END AS reason,
        count(*) AS messages FROM event_messages
      WHERE topic = 'other' OR day IS NULL OR (NOT control AND msno = '') GROUP BY ALL""",
    "batch_counts": """SELECT count(*) + 2 AS messages,
        count(*) FILTER (topic <> 'other' AND day IS NOT NULL AND NOT control AND msno <> '') AS records,
        count(*) FILTER (topic = 'other' OR day IS NULL OR (NOT control AND msno = '')) AS rejected,
        count(*) FILTER (topic <> 'other' AND day IS NOT NULL AND control) + 2 AS markers, true AS adds_up
      FROM event_messages""",
    "stream_progress": f"""SELECT 'progress' AS query, CAST(sum(n) AS BIGINT) AS input_rows FROM (SELECT count(*) AS n FROM day_logs UNION ALL SELECT count(*) FROM day_txns UNION ALL SELECT 2 * count(*) - 1 FROM stream_days)""",
    "idle_stop": f"""SELECT CAST(sum(n) AS BIGINT) AS input_rows, true AS stopped FROM (SELECT count(*) AS n FROM day_logs UNION ALL SELECT count(*) FROM day_txns UNION ALL SELECT 2 * count(*) - 1 FROM stream_days)""",
    "saved_model": "SELECT count(*) AS user_count, count(*) AS same_score FROM customer",
    "run_log": f"""SELECT run_id, name, value FROM (SELECT unnest(['a', 'b']) AS run_id),
        (SELECT 'auc_roc' AS name, {r6('sum(neg * (tp - pos + pos / 2)) / (max(all_pos) * max(all_neg))', 'value')} FROM curve
         UNION ALL SELECT 'auc_pr', {r6('sum(pos / all_pos * (tp / (tp + fp)))')} FROM curve
         UNION ALL SELECT 'log_loss', {r6('avg(-(y * ln(q) + (1 - y) * ln(1 - q)))')}
           FROM (SELECT y, greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, p)) AS q FROM labelled))""",
    "event_times": """SELECT count(*) FILTER (event_id % 3 = 0) AS kept, count(*) FILTER (event_id % 3 <> 0) AS now FROM events""",
    "drift_summary": f"SELECT {txt('event_date')}, {r6('max_psi', 'max_psi')}, n_warning, n_critical, n_features, level FROM summary",
    "drift_detail": f"""SELECT {txt('event_date')}, 'done' AS status, feature, {r6('psi', 'psi')}, level, {r6('least(psi / 0.4, 1)', 'bar')},
        {r6('ks_stat', 'ks_stat')}, {r6('ks_pvalue', 'ks_pvalue')}, ks_pvalue < 0.05 AS ks_drift FROM drift WHERE event_date = DATE '2024-01-20'
      UNION ALL SELECT '2024-03-01', 'pending', NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
    "drift_overview": """SELECT count(*) AS n_dates, count(*) FILTER (level = 'warning') AS n_warning,
        count(*) FILTER (level = 'critical') AS n_critical FROM summary""",
    "stream_features": f"SELECT {FEATURE_ROW} FROM timely_cumulative",
    "stream_latest": f"""SELECT msno, {STAMP}, {big('total_transactions')}, {r6('total_secs', 'total_secs')} FROM
        (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY day DESC) AS rn FROM timely_cumulative) WHERE rn = 1""",
    "late_rows": f"""SELECT {txt('day')}, topic, count(*) AS late_rows FROM
        (SELECT day, msno, 'user_logs' AS topic FROM day_logs UNION ALL SELECT day, msno, 'transactions' FROM day_txns)
      WHERE {LATE} GROUP BY ALL""",
    "day_status": f"""SELECT {txt('day')}, row_number() OVER (ORDER BY day) AS seq, count(*) AS user_count FROM timely_delta GROUP BY day""",
    "stream_drift": f"""SELECT {txt('event_date')}, feature, {r6('psi', 'psi')}, {_level('psi')} AS level, {r6('ks_stat', 'ks_stat')}
      FROM timely_psi LEFT JOIN timely_ks USING (event_date, feature)""",
    "stream_daily": f"""SELECT {txt('CAST(ts AS DATE)', 'day_start')}, user_id, count(*) AS event_count, {r6('sum(value)', 'value_sum')}
      FROM events GROUP BY CAST(ts AS DATE), user_id""",
    "stream_prediction_stats": f"""SELECT count(*) AS total_predictions, count(*) FILTER (is_churn = 1) AS churn_count,
        count(*) FILTER (is_churn = 0) AS retain_count, {r6('avg(is_churn)', 'churn_rate')} FROM score_log""",
    "req_rate": _rate("request_log", "path", 60, "label") + " UNION ALL " + _rate("request_log", "status_code", 60, "label"),
    "error_rate": _share("request_log", "status_code LIKE '5%'", 60, ", CAST(60 AS BIGINT) AS width")
    + " UNION ALL " + _share("request_log", "status_code LIKE '5%'", 300, ", CAST(300 AS BIGINT) AS width"),
    "mean_latency": _mean("request_log", "duration_seconds"),
    "bucket_counts": f"""SELECT path, {LE}, cumulative, 'latency' AS measure FROM ({_buckets('request_log', 'duration_seconds', fixed.LATENCY_BUCKETS, 'path')})
      UNION ALL SELECT path, {LE}, cumulative, 'batch_size' FROM ({_buckets('request_log', 'batch_size', fixed.BATCH_SIZE_BUCKETS, 'path')})""",
    "hist_quantile": " UNION ALL ".join(
        _quantile(q, f"(SELECT *, {label} AS label FROM request_log)", "duration_seconds", fixed.LATENCY_BUCKETS, "label")
        for label in ("path", "status_code", "'all'")
        for q in (0.95, 0.99)
    ),
    "fetch_latency": _mean("score_log", "fetch_seconds", "fetch_status, "),
    "fetch_quantile": "SELECT fetch_status, window_end, n, quantile FROM ("
    + _quantile(0.95, "score_log", "fetch_seconds", fixed.FETCH_BUCKETS, "fetch_status")
    + ")",
    "in_flight": """SELECT path, strftime(moment, '%Y-%m-%d %H:%M:%S.%f') AS "at",
        CAST(sum(sum(change)) OVER (PARTITION BY path ORDER BY moment) AS BIGINT) AS in_flight
      FROM (SELECT path, ts AS moment, 1 AS change FROM request_log
            UNION ALL SELECT path, ts + to_microseconds(CAST(round(duration_seconds * 1000000) AS BIGINT)), -1 FROM request_log)
      GROUP BY path, moment""",
    "metric_totals": """SELECT count(*) AS requests, count(*) FILTER (status_code LIKE '5%') AS server_errors,
        count(*) FILTER (path = '/predict/') AS single_predictions, count(*) FILTER (path = '/predict/batch') AS batch_predictions,
        (SELECT count(*) FROM score_log WHERE is_churn = 1) AS churn_predictions FROM request_log""",
    "pred_rate": _rate("request_log", "CASE WHEN path = '/predict/' THEN 'single' ELSE 'batch' END", 60, "kind"),
    "rolling_churn_rate": _share("score_log", "is_churn = 1", 300),
    "class_mix": _rate("score_log", "CAST(is_churn AS BIGINT)", 300, "is_churn"),
    "prob_heatmap": f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_end, {LE}, cumulative
      FROM ({_buckets(_trail('score_log', 300), 'churn_probability', fixed.PROBABILITY_BUCKETS, 'w')})""",
    "mean_prob": _mean("score_log", "churn_probability"),
    "mean_batch": _mean("(SELECT * FROM request_log WHERE path = '/predict/batch')", "batch_size"),
    "fetch_rate": _rate("score_log", None, 60),
    "fetch_success": _share("score_log", "fetch_status = 'success'", 300),
}


def _needed(text: str) -> list[str]:
    """Views a text names, dependencies first."""
    found: list[str] = []

    def visit(sql: str) -> None:
        words = set(re.findall(r"\b(?:FROM|JOIN|,)\s*\(?\s*([a-z_0-9]+)", sql))
        for name in VIEWS:
            if name in words and name not in found:
                visit(VIEWS[name])
                found.append(name)

    visit(text)
    return found


#: Queries that give what another one gives, by another way.
SAME = {
    "overwrite_table": "silver_members",
    "offline_table": "baseline_scan",
    "encoded_fields": "decode_messages",
    "score_log_stats": "prediction_stats",
}
SQL |= {name: SQL[other] for name, other in SAME.items()}


def sql_for(name: str) -> str:
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _needed(SQL[name]))
    if name == "drift_ks_exact":
        views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _needed(VIEWS["ks"]))
        steps = KS_EXACT.removeprefix("RECURSIVE ")
        return f"WITH RECURSIVE {views},\nks AS ({VIEWS['ks']}),\n{steps}\n{SQL[name]}"
    return f"WITH {views}\n{SQL[name]}" if views else SQL[name]
