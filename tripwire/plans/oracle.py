"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Tables `events`, `nation`, ... are views over the same parquet files. The
transaction view and its enrichment are spelled out once (`TX`, `ETX`) and
prefixed to every statement.
"""
from __future__ import annotations

from tripwire.config import CITY_COUNTRY

ISO = "'%Y-%m-%dT%H:%M:%SZ'"
CLOCK = "'%H:%M:%S'"

# Transactions derived from events (same mapping as sources.tables).
TX = """
e AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
tx AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS user_id,
         't-' || lpad(CAST(event_id AS VARCHAR), greatest(7, length(CAST(event_id AS VARCHAR)))::INTEGER, '0') AS transaction_id,
         round(value * 10, 2) AS amount,
         CASE k % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' END AS currency,
         CAST(ts AS TIMESTAMP) AS ts,
         CAST(k % 30 AS VARCHAR) AS location,
         CASE k % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card'
                    WHEN 2 THEN 'paypal' WHEN 3 THEN 'crypto' END AS method,
         CAST(event_type = 'error' AS INTEGER) AS is_fraud
  FROM e)"""

# Country (left join) and EUR amount in decimal arithmetic.
ETX = """
etx AS (
  SELECT tx.*, n.n_name AS country,
         CAST(round(CAST(amount AS DECIMAL(26,8)) *
              CAST(CASE currency WHEN 'EUR' THEN 1.0 WHEN 'USD' THEN 0.92
                                 WHEN 'GBP' THEN 1.17 END AS DECIMAL(6,4)), 2) AS DOUBLE)
           AS amount_eur
  FROM tx LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = tx.location)"""


def _part(text: str) -> str:
    """A part of an alert's key: its length and itself, `-` for NULL."""
    return f"coalesce(length({text}) || ':' || {text}, '-')"


def with_tx(body: str, *extra_ctes: str) -> str:
    ctes = ",".join((TX, ETX) + extra_ctes)
    return f"WITH {ctes}\n{body}"


def _iso(expr: str) -> str:
    return f"strftime({expr}, {ISO})"


def _clock(expr: str) -> str:
    return f"strftime({expr}, {CLOCK})"


ENRICH = with_tx("""
SELECT user_id, transaction_id, amount, currency, location, method, is_fraud, country,
       amount_eur, """ + _iso("ts") + """ AS event_time
FROM etx""")

HIGH_VALUE = with_tx("""
SELECT sha256('10:high_value' || """ + _part("transaction_id") + """ || '-') AS alert_id, transaction_id, user_id,
       """ + _iso("ts") + """ AS event_time, """ + _iso("ts") + """ AS alert_time,
       'high_value' AS rule, 'medium' AS severity, amount, currency, amount_eur,
       location, country, CAST(NULL AS DOUBLE) AS p_fraud,
       'amount ' || CAST(amount_eur AS VARCHAR) || ' EUR exceeds 1000.0 threshold' AS detail,
       is_fraud
FROM etx WHERE amount_eur > 1000.0""")


def _windowed(rule: str, severity: str, width: str, having: str, detail: str,
              extra_aggs: str = "") -> str:
    bucket = f"time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01')"
    cte_w = f"""
w AS (SELECT *, {bucket} AS ws FROM etx)"""
    cte_g = f"""
g AS (SELECT user_id, ws, count(*) AS n{extra_aggs} FROM w GROUP BY user_id, ws
      HAVING {having})"""
    cte_l = """
l AS (SELECT * FROM (SELECT w.*, row_number() OVER (PARTITION BY user_id, ws
                     ORDER BY ts DESC, transaction_id DESC) AS rn FROM w) WHERE rn = 1)"""
    end = f"(g.ws + INTERVAL '{width}')"
    body = f"""
SELECT sha256('{len(rule)}:{rule}' || {_part('g.user_id')} || {_part(_iso('g.ws'))} || {_part(_iso(end))}) AS alert_id,
       l.transaction_id, g.user_id, {_iso('l.ts')} AS event_time,
       {_iso(end + " + INTERVAL '5 minutes'")} AS alert_time,
       '{rule}' AS rule, '{severity}' AS severity, l.amount, l.currency, l.amount_eur,
       l.location, l.country, CAST(NULL AS DOUBLE) AS p_fraud,
       {detail.format(start=_clock('g.ws'), end=_clock(end))} AS detail, l.is_fraud
FROM g JOIN l ON g.user_id = l.user_id AND g.ws = l.ws"""
    return with_tx(body, cte_w, cte_g, cte_l)


def velocity(width: str, min_count: int) -> str:
    return _windowed("velocity", "high", width, f"count(*) >= {min_count}",
                     "CAST(g.n AS VARCHAR) || ' transactions in window ' || {start} || '-' || {end}")


def geo_hop(width: str, min_countries: int) -> str:
    return _windowed(
        "geo_hop", "critical", width, f"count(DISTINCT country) >= {min_countries}",
        "CAST(g.nc AS VARCHAR) || ' countries in window ' || {start} || '-' || {end}"
        " || ': ' || array_to_string(g.countries, ',')",
        extra_aggs=", count(DISTINCT country) AS nc, "
                   "list_sort(list(DISTINCT country) FILTER (WHERE country IS NOT NULL)) "
                   "AS countries")


def _union(*statements: str) -> str:
    parts = [f"SELECT * FROM ({s.strip()})" for s in statements]
    return "\nUNION ALL\n".join(parts)


ORACLES: dict[str, str] = {
        "all_alerts": _union(HIGH_VALUE, velocity("1 minute", 4), geo_hop("5 minutes", 2)),
        "enrich": ENRICH,
        "high_value": HIGH_VALUE,
        "velocity_minute": velocity("1 minute", 4),
        "velocity_hour": velocity("1 hour", 2),
        "velocity_day": velocity("1 day", 4),
        "geo_hop_5min": geo_hop("5 minutes", 2),
        "geo_hop_hour": geo_hop("1 hour", 2),
}


# ------------------------------------------------------- contract and features

_FIELDS = ("user_id", "transaction_id", "amount", "currency", "timestamp", "location",
           "method", "is_fraud")
_MISSING = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {'ts' if f == 'timestamp' else f} IS NULL THEN '{f}' END" for f in _FIELDS) + ")"

MESSAGE_CHECK = with_tx(f"""
SELECT status, reason, count(*) AS n FROM (
  SELECT CASE WHEN m = '' THEN NULL ELSE 'missing:' || m END AS reason,
         CASE WHEN m = '' THEN 'ok' ELSE 'rejected' END AS status
  FROM (SELECT {_MISSING} AS m FROM tx))
GROUP BY status, reason""")

REJECT_GATE = with_tx(f"""
SELECT total, rejected, round(CASE WHEN total > 0 THEN rejected / total ELSE 0.0 END, 6)
         AS reject_rate,
       CAST((CASE WHEN total > 0 THEN rejected / total ELSE 0.0 END) <= 0.01 AS INTEGER)
         AS passed
FROM (SELECT count(*) AS total, CAST(sum(CASE WHEN {_MISSING} <> '' THEN 1 ELSE 0 END)
             AS BIGINT) AS rejected FROM tx)""")

DQ_CHECKS = with_tx(r"""
SELECT check_name, violations FROM (
 UNPIVOT (
  SELECT CAST(count(*) - count(DISTINCT transaction_id) AS BIGINT) AS duplicate_transaction_id,
    CAST(sum(CASE WHEN coalesce(NOT regexp_matches(user_id, '^u\d{4}$'), true) THEN 1 ELSE 0 END) AS BIGINT) AS user_id_pattern,
    CAST(sum(CASE WHEN coalesce(NOT regexp_matches(transaction_id, '^t-\d{7,}$'), true) THEN 1 ELSE 0 END) AS BIGINT) AS transaction_id_pattern,
    CAST(sum(CASE WHEN coalesce(currency NOT IN ('EUR', 'USD', 'GBP'), true) THEN 1 ELSE 0 END) AS BIGINT) AS currency_domain,
    CAST(sum(CASE WHEN coalesce(method NOT IN ('credit_card', 'debit_card', 'paypal', 'crypto'), true) THEN 1 ELSE 0 END) AS BIGINT) AS method_domain,
    CAST(sum(CASE WHEN coalesce(amount < 5.0 OR (amount > 5000.0 AND is_fraud <> 1), true) THEN 1 ELSE 0 END) AS BIGINT) AS amount_range,
    CAST(sum(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_timestamp,
    CAST(sum(CASE WHEN coalesce(is_fraud NOT IN (0, 1), true) THEN 1 ELSE 0 END) AS BIGINT) AS label_domain
  FROM tx)
 ON COLUMNS(*) INTO NAME check_name VALUE violations)""")

_PROFILE = """
SELECT user_id, avg(amount_eur) AS amt_mean,
       greatest(coalesce(stddev_samp(amount_eur), 1.0), 1e-6) AS amt_std,
       count(*) AS tx_count
FROM {src} GROUP BY user_id"""

USER_PROFILE = with_tx("""
SELECT user_id, round(amt_mean, 6) AS amt_mean, round(amt_std, 6) AS amt_std, tx_count
FROM (""" + _PROFILE.format(src="etx") + ")")

LABEL_RATE = with_tx("""
SELECT count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS positives,
       round(avg(CAST(is_fraud AS DOUBLE)), 6) AS positive_rate FROM tx""")

# Cut = time of the row at position floor(0.8 n) in time order.
_CUT = """
cut AS (SELECT max(ts) AS cut FROM (
  SELECT ts, row_number() OVER (ORDER BY ts) AS rn FROM etx WHERE ts IS NOT NULL) o
  WHERE rn = (SELECT CAST(floor(0.8 * count(*)) AS BIGINT) FROM etx WHERE ts IS NOT NULL))"""

SPLIT_COUNTS = with_tx(f"""
SELECT {_iso('cut.cut')} AS cut_time,
       count(*) FILTER (WHERE ts <= cut.cut) AS train_rows,
       CAST(coalesce(sum(is_fraud) FILTER (WHERE ts <= cut.cut), 0) AS BIGINT) AS train_positives,
       count(*) FILTER (WHERE ts > cut.cut) AS valid_rows,
       CAST(coalesce(sum(is_fraud) FILTER (WHERE ts > cut.cut), 0) AS BIGINT) AS valid_positives
FROM etx, cut GROUP BY cut.cut""", _CUT)

FEATURES = with_tx("""
SELECT transaction_id, round(amount_eur, 6) AS amount_eur, round(ln(1 + amount_eur), 6) AS log_amount,
       hour(ts) AS hour, dayofweek(ts) + 1 AS dayofweek,
       CAST(hour(ts) >= 22 OR hour(ts) < 6 AS INTEGER) AS is_night,
       CASE method WHEN 'credit_card' THEN 0 WHEN 'debit_card' THEN 1 WHEN 'paypal' THEN 2
                   WHEN 'crypto' THEN 3 END AS method_id,
       CASE currency WHEN 'EUR' THEN 0 WHEN 'USD' THEN 1 WHEN 'GBP' THEN 2 END AS currency_id,
       round(CASE WHEN p.amt_mean IS NULL THEN 0.0
                  ELSE (amount_eur - p.amt_mean) / greatest(p.amt_std, 1e-6) END, 6) AS amount_z,
       CAST(p.amt_mean IS NULL AS INTEGER) AS is_new_user, is_fraud
FROM etx LEFT JOIN prof p USING (user_id)""", _CUT,
    "\nprof AS (" + _PROFILE.format(src="etx WHERE ts <= (SELECT cut FROM cut)") + ")")

ORACLES.update({
    "message_check": MESSAGE_CHECK,
    "reject_gate": REJECT_GATE,
    "dq_checks": DQ_CHECKS,
    "user_profile": USER_PROFILE,
    "label_rate": LABEL_RATE,
    "split_counts": SPLIT_COUNTS,
    "features": FEATURES,
})


# ------------------------------------------------------------ alert analytics

ALL_ALERTS = ORACLES["all_alerts"]


def over_alerts(body: str, alerts_sql: str = ALL_ALERTS) -> str:
    """`body` reads the CTE `alerts`."""
    return f"WITH alerts AS (SELECT * FROM ({alerts_sql}))\n{body}"


_TS = "strptime({c}, '%Y-%m-%dT%H:%M:%SZ')"

LATEST_ALERTS = over_alerts(
    "SELECT * FROM alerts ORDER BY alert_time DESC, alert_id DESC LIMIT 200")

ALERT_RATE = over_alerts(f"""
SELECT {_iso('m')} AS newest_alert_time,
       (SELECT count(*) FROM alerts WHERE {_TS.format(c='alert_time')} >= m - INTERVAL 60 SECOND)
         AS alerts_in_window
FROM (SELECT max({_TS.format(c='alert_time')}) AS m FROM alerts)""")

COUNTS_BY_RULE = over_alerts("""
SELECT d.dimension, d.value, coalesce(c.n, 0) AS n
FROM (VALUES ('rule', 'high_value'), ('rule', 'velocity'), ('rule', 'geo_hop'),
             ('rule', 'ml_score'), ('severity', 'medium'), ('severity', 'high'),
             ('severity', 'critical')) d(dimension, value)
LEFT JOIN (SELECT 'rule' AS dimension, rule AS value, count(*) AS n FROM alerts GROUP BY rule
           UNION ALL
           SELECT 'severity', severity, count(*) FROM alerts GROUP BY severity) c
  USING (dimension, value)""")

ALERT_DEDUP = f"SELECT * FROM ({ALL_ALERTS}) UNION SELECT * FROM ({HIGH_VALUE})"

LATENCY_P95 = over_alerts(f"""
, d AS (SELECT CAST(epoch({_TS.format(c='alert_time')}) - epoch({_TS.format(c='event_time')})
                    AS BIGINT) AS delta FROM alerts),
o AS (SELECT delta, row_number() OVER (ORDER BY delta) - 1 AS i, count(*) OVER () AS n FROM d
      WHERE delta IS NOT NULL)
SELECT n, delta AS p95_seconds FROM o WHERE i = CAST(floor(0.95 * (n - 1)) AS BIGINT)""")

DUPLICATE_AUDIT = over_alerts(f"""
SELECT rule, user_id, window_start, count(*) AS n FROM (
  SELECT rule, user_id, {_iso("time_bucket(CASE rule WHEN 'velocity' THEN INTERVAL 1 MINUTE ELSE INTERVAL 5 MINUTE END, " + _TS.format(c='event_time') + ", TIMESTAMP '1970-01-01')")} AS window_start
  FROM alerts WHERE rule IN ('velocity', 'geo_hop'))
GROUP BY rule, user_id, window_start HAVING count(*) > 1""")

SILENT_RULES = over_alerts("""
SELECT r.rule, r.severity FROM (VALUES ('high_value', 'medium'), ('velocity', 'high'),
  ('geo_hop', 'critical'), ('ml_score', 'high')) r(rule, severity)
WHERE r.rule NOT IN (SELECT DISTINCT rule FROM alerts)""")

STARVATION = with_tx(f"""
SELECT query, {_iso('"at"')} AS "at", {_iso('idle_since')} AS idle_since,
       round(idle_seconds, 6) AS idle_seconds
FROM (
  SELECT query, stretch, "at", idle_since, idle_seconds,
         row_number() OVER (PARTITION BY query, stretch ORDER BY "at") AS rn
  FROM (
    SELECT *, coalesce(last_active, first_at) AS idle_since,
           (epoch_us("at") - epoch_us(coalesce(last_active, first_at))) / 1000000.0 AS idle_seconds
    FROM (
      SELECT query, "at", num_input_rows,
             last(CASE WHEN num_input_rows > 0 THEN "at" END IGNORE NULLS) OVER w AS last_active,
             min("at") OVER w AS first_at,
             sum(CASE WHEN num_input_rows > 0 THEN 1 ELSE 0 END) OVER w AS stretch
      FROM progress
      WINDOW w AS (PARTITION BY query ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))
  WHERE num_input_rows = 0 AND idle_seconds >= 259200)
WHERE rn = 1""", """
weeks AS (SELECT unnest(range((SELECT date_trunc('week', min(ts)) FROM tx)::TIMESTAMP,
    (SELECT max(ts) FROM tx)::TIMESTAMP + INTERVAL 1 MICROSECOND, INTERVAL 7 DAY)) AS monday),
parts AS (SELECT 'weekday' AS feed, monday AS since, monday + INTERVAL 5 DAY AS until FROM weeks
  UNION ALL SELECT 'weekend', monday + INTERVAL 5 DAY, monday + INTERVAL 7 DAY FROM weeks),
polled AS (SELECT * FROM parts WHERE until > (SELECT min(ts) FROM tx) AND since <= (SELECT max(ts) FROM tx)),
progress AS (
  SELECT 'alerts_' || f.feed AS query, until AS "at",
         CASE WHEN f.feed = polled.feed THEN (SELECT count(*) FROM tx WHERE ts >= since AND ts < until) ELSE 0 END AS num_input_rows
  FROM polled, (VALUES ('weekday'), ('weekend')) f(feed))""")

LABEL_RUNS = with_tx(f"""
SELECT user_id, arg_min(transaction_id, (ts, transaction_id)) AS first_transaction_id,
       {_iso('min(ts)')} AS run_start, {_iso('max(ts)')} AS run_end,
       count(*) AS run_length,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 6) AS span_seconds,
       count(DISTINCT country) AS n_countries,
       CASE WHEN count(*) = 1 THEN 'single' WHEN count(*) = 3 THEN 'hop'
            WHEN count(*) >= 5 THEN 'burst' ELSE 'other' END AS pattern
FROM (SELECT *, sum(CASE WHEN is_fraud <> 1 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, transaction_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM etx WHERE ts IS NOT NULL)
WHERE is_fraud = 1
GROUP BY user_id, run""")

# Greedy time-to-live walk per (rule, user): first alert, then the first one at
# least 600 s after the last kept one.
SUPPRESS_REPEATS = f"""
WITH RECURSIVE a AS (
  SELECT *, {_TS.format(c='event_time')} AS t,
         row_number() OVER (PARTITION BY rule, user_id
                            ORDER BY {_TS.format(c='event_time')}, alert_id) AS rn
  FROM ({HIGH_VALUE})),
nx AS (
  SELECT a.rule, a.user_id, a.rn,
         (SELECT min(b.rn) FROM a b WHERE b.rule = a.rule AND b.user_id = a.user_id
                                     AND b.t >= a.t + INTERVAL 600 SECOND) AS next_rn
  FROM a),
walk(rule, user_id, rn) AS (
  SELECT rule, user_id, 1 FROM a WHERE rn = 1
  UNION ALL
  SELECT nx.rule, nx.user_id, nx.next_rn FROM walk
  JOIN nx ON nx.rule = walk.rule AND nx.user_id = walk.user_id AND nx.rn = walk.rn
  WHERE nx.next_rn IS NOT NULL)
SELECT alert_id, transaction_id, user_id, event_time, alert_time, rule, severity, amount,
       currency, amount_eur, location, country, p_fraud, detail, is_fraud
FROM a JOIN walk USING (rule, user_id, rn)"""

ORACLES.update({
    "latest_alerts": LATEST_ALERTS,
    "alert_rate": ALERT_RATE,
    "counts_by_rule": COUNTS_BY_RULE,
    "alert_dedup": ALERT_DEDUP,
    "latency_p95": LATENCY_P95,
    "duplicate_audit": DUPLICATE_AUDIT,
    "silent_rules": SILENT_RULES,
    "starvation": STARVATION,
    "label_runs": LABEL_RUNS,
    "suppress_repeats": SUPPRESS_REPEATS,
})


# ------------------------------------- inputs on which every rule and check has work

def _dense(sql: str) -> str:
    """The statement over transactions with times 1440 times denser."""
    prefix = "WITH " + ",".join((TX, ETX))
    assert prefix in sql
    faster = ETX.replace("etx AS (", "etx0 AS (") + """,
etx AS (SELECT * REPLACE (make_timestamp(epoch_us(ts) // 1440) AS ts) FROM etx0)"""
    return sql.replace(prefix, "WITH " + ",".join((TX, faster)))


_DENSE_WINDOWED = _dense(_union(velocity("1 minute", 4), geo_hop("5 minutes", 2)))
_ONE_MORE = _dense(_union(velocity("1 minute", 6), geo_hop("5 minutes", 5)))
_AUDIT, _P95 = (sql.removeprefix(over_alerts("")) for sql in (DUPLICATE_AUDIT, LATENCY_P95))

_LARGE = HIGH_VALUE.replace(
    "FROM events)", "FROM (SELECT * REPLACE (event_id + 10000000000 AS event_id) FROM events))")

_CITIES = ", ".join(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(CITY_COUNTRY.items()))
ENRICH_CITIES = with_tx(f"""
SELECT transaction_id, CASE WHEN place = 41 THEN 'Atlantis' ELSE city END AS location, c.country
FROM (SELECT *, CAST(substr(transaction_id, 3) AS BIGINT) % 43 AS place FROM tx) t
LEFT JOIN (VALUES {_CITIES}) c(i, city, country) ON c.i = t.place""")

_KIND = "CAST(substr(transaction_id, 3) AS BIGINT) % 20"
MESSAGE_CHECK_MIXED = with_tx(f"""
SELECT CASE WHEN kind <= 2 THEN 'rejected' ELSE 'ok' END AS status,
       CASE WHEN kind <= 1 THEN 'not_json_object' WHEN kind = 2 THEN 'missing:currency' END AS reason,
       count(*) AS n
FROM (SELECT {_KIND} AS kind FROM tx) GROUP BY 1, 2""")
REJECT_GATE_MIXED = with_tx(f"""
SELECT count(*) AS total, count(*) FILTER (WHERE {_KIND} <= 2) AS rejected,
       round(count(*) FILTER (WHERE {_KIND} <= 2) / count(*), 6) AS reject_rate,
       CAST(count(*) FILTER (WHERE {_KIND} <= 2) / count(*) <= 0.01 AS INTEGER) AS passed
FROM tx""")
PARSE_MESSAGES = with_tx(f"""
SELECT user_id, transaction_id, amount, currency, location, method, is_fraud, n.n_name AS country,
       CAST(round(TRY_CAST(amount AS DECIMAL(26,8)) *
            CAST(CASE currency WHEN 'EUR' THEN 1.0 WHEN 'USD' THEN 0.92
                               WHEN 'GBP' THEN 1.17 END AS DECIMAL(6,4)), 2) AS DOUBLE) AS amount_eur,
       {_iso('ts')} AS event_time
FROM (SELECT * REPLACE (CASE WHEN {_KIND} = 4 THEN 1e19 ELSE amount END AS amount,
                        CASE WHEN {_KIND} <> 3 THEN currency END AS currency,
                        CASE WHEN {_KIND} <> 5 THEN ts END AS ts)
      FROM tx WHERE {_KIND} > 2) g LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = g.location""")

WINDOW_STARTS = with_tx(f"""
SELECT {_iso("time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01')")} AS window_start, count(*) AS n
FROM tx GROUP BY 1""")

# The walk of SUPPRESS_REPEATS with all alerts of the rule under one key.
SUPPRESS_HOT = f"""
WITH RECURSIVE a AS (
  SELECT *, {_TS.format(c='event_time')} AS t,
         row_number() OVER (ORDER BY {_TS.format(c='event_time')}, alert_id) AS rn
  FROM ({HIGH_VALUE})),
nx AS (
  SELECT a.rn, (SELECT min(b.rn) FROM a b WHERE b.t >= a.t + INTERVAL 600 SECOND) AS next_rn FROM a),
walk(rn) AS (
  SELECT rn FROM a WHERE rn = 1
  UNION ALL
  SELECT nx.next_rn FROM walk JOIN nx ON nx.rn = walk.rn WHERE nx.next_rn IS NOT NULL)
SELECT alert_id, transaction_id, user_id, event_time, alert_time, rule, severity, amount,
       currency, amount_eur, location, country, p_fraud, detail, is_fraud
FROM a JOIN walk USING (rn)"""

# A logistic formula over the nine features.
_SCORED = ("\nprof AS (" + _PROFILE.format(src="etx") + ")", """
sc AS (
  SELECT *, round(1 / (1 + exp(-(0.8 * z + 0.5 * l - 0.02 * h + 0.1 * d + 0.4 * night + 0.2 * mid
                                 - 0.3 * cid + 0.001 * amount_eur + fresh - 4.0))), 8) AS score
  FROM (SELECT etx.*, round(ln(1 + amount_eur), 6) AS l, hour(ts) AS h, dayofweek(ts) + 1 AS d,
               CAST(hour(ts) >= 22 OR hour(ts) < 6 AS INTEGER) AS night,
               CASE method WHEN 'credit_card' THEN 0 WHEN 'debit_card' THEN 1 WHEN 'paypal' THEN 2
                           WHEN 'crypto' THEN 3 END AS mid,
               CASE currency WHEN 'EUR' THEN 0 WHEN 'USD' THEN 1 WHEN 'GBP' THEN 2 END AS cid,
               round(CASE WHEN p.amt_mean IS NULL THEN 0.0
                          ELSE (amount_eur - p.amt_mean) / p.amt_std END, 6) AS z,
               CAST(p.amt_mean IS NULL AS INTEGER) AS fresh
        FROM etx LEFT JOIN prof p USING (user_id)))""")
_CURVE = _SCORED + ("""
h AS (SELECT score AS threshold, sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg FROM sc GROUP BY 1),
c0 AS (SELECT threshold, pos, CAST(sum(pos) OVER d AS BIGINT) AS tp, CAST(sum(neg) OVER d AS BIGINT) AS fp,
              sum(pos) OVER () AS total FROM h WINDOW d AS (ORDER BY threshold DESC)),
c1 AS (SELECT *, tp / (tp + fp) AS precision, CASE WHEN total > 0 THEN tp / total ELSE 0.0 END AS recall,
              CASE WHEN total > 0 THEN (tp - pos) / total ELSE 0.0 END AS prev_recall FROM c0),
curve AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                         ELSE 0.0 END AS f1 FROM c1)""",)

TAU_CURVE = with_tx("""
SELECT threshold, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(prev_recall, 6) AS prev_recall FROM curve""", *_CURVE)
PICK_TAU = with_tx("""
SELECT tau, (SELECT count(*) FROM sc WHERE score >= tau) AS at_least,
       (SELECT count(*) FROM sc WHERE score > tau) AS above
FROM (SELECT threshold AS tau FROM curve ORDER BY f1 DESC, threshold LIMIT 1)""", *_CURVE)
AVERAGE_PRECISION = with_tx("""
SELECT round(sum((recall - prev_recall) * precision), 6) AS average_precision FROM curve""", *_CURVE)
# Pairs of a positive and a negative row that the scores order right, ties half.
ROC_AUC = with_tx("""
SELECT round(sum(h.neg * (c0.tp - c0.pos + c0.pos / 2.0)) / (max(total) * sum(h.neg)), 6) AS roc_auc
FROM c0 JOIN h ON h.threshold = c0.threshold""", *_CURVE)
PR_AUC = with_tx("""
SELECT round(sum((recall - prev_recall) * (precision + coalesce(higher, precision)) / 2), 6) AS pr_auc
FROM (SELECT *, lag(precision) OVER (ORDER BY threshold DESC) AS higher FROM curve)""", *_CURVE)
CONFUSION = with_tx("""
SELECT tau, tp, fp, fn, tn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 6) AS recall
FROM (SELECT tau, count(*) FILTER (WHERE score >= tau AND is_fraud = 1) AS tp,
             count(*) FILTER (WHERE score >= tau AND is_fraud <> 1) AS fp,
             count(*) FILTER (WHERE score < tau AND is_fraud = 1) AS fn,
             count(*) FILTER (WHERE score < tau AND is_fraud <> 1) AS tn
      FROM sc, (SELECT CAST(round(0.05 * i, 2) AS DOUBLE) AS tau FROM range(1, 20) r(i)) GROUP BY tau)""", *_SCORED)


def _score_alerts(tau: float) -> str:
    return with_tx("""
SELECT sha256('8:ml_score' || """ + _part("transaction_id") + """ || '-') AS alert_id, transaction_id, user_id,
       """ + _iso("ts") + """ AS event_time, """ + _iso("ts") + """ AS alert_time, 'ml_score' AS rule,
       'high' AS severity, amount, currency, amount_eur, location, country, score AS p_fraud, is_fraud
FROM sc WHERE score > """ + str(tau), *_SCORED)


ORACLES.update({
    "alerts_dense": _dense(ALL_ALERTS),
    "velocity_dense": _dense(velocity("1 minute", 4)),
    "geo_hop_dense": _dense(geo_hop("5 minutes", 2)),
    "duplicate_audit_dense": over_alerts(_AUDIT, f"{_DENSE_WINDOWED} UNION ALL {_ONE_MORE}"),
    "latency_p95_dense": over_alerts(_P95, _DENSE_WINDOWED),
    "window_starts": WINDOW_STARTS,
    "alert_dedup_widths": _union(velocity("1 hour", 2), velocity("1 day", 2)),
    "large_ids": _LARGE,
    "enrich_cities": ENRICH_CITIES,
    "message_check_mixed": MESSAGE_CHECK_MIXED,
    "reject_gate_mixed": REJECT_GATE_MIXED,
    "parse_messages": PARSE_MESSAGES,
    "suppress_repeats_hot": SUPPRESS_HOT,
    "approx_distinct": with_tx(
        "SELECT method, count(DISTINCT transaction_id) AS n_exact, 1 AS within FROM tx GROUP BY method"),
    "tau_curve": TAU_CURVE,
    "pick_tau": PICK_TAU,
    "average_precision": AVERAGE_PRECISION,
    "roc_auc": ROC_AUC,
    "pr_auc": PR_AUC,
    "confusion": CONFUSION,
    "row_alerts_r1_r4": f"SELECT * EXCLUDE (detail) FROM ({HIGH_VALUE}) UNION ALL SELECT * FROM ({_score_alerts(0.7)})",
    "ml_alerts_formula": _score_alerts(0.5),
})


# ------------------------------------------------------- second input: orders

OTX = """
otx0 AS (
  SELECT 'u' || CAST(o_custkey AS VARCHAR) AS user_id,
         't-' || lpad(CAST(o_orderkey AS VARCHAR), greatest(7, length(CAST(o_orderkey AS VARCHAR)))::INTEGER, '0') AS transaction_id,
         o_totalprice AS amount,
         CASE o_orderkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' END AS currency,
         CAST(o_orderdate AS TIMESTAMP) AS ts,
         CAST(c.c_nationkey AS VARCHAR) AS location,
         CASE o_orderkey % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card'
                            WHEN 2 THEN 'paypal' WHEN 3 THEN 'crypto' END AS method,
         CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_fraud
  FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey),
etx AS (
  SELECT otx0.*, n.n_name AS country,
         CAST(round(CAST(amount AS DECIMAL(26,8)) *
              CAST(CASE currency WHEN 'EUR' THEN 1.0 WHEN 'USD' THEN 0.92
                                 WHEN 'GBP' THEN 1.17 END AS DECIMAL(6,4)), 2) AS DOUBLE)
           AS amount_eur
  FROM otx0 LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = otx0.location)"""


def on_orders(sql: str) -> str:
    """Re-target a statement built on the events view to the orders view."""
    prefix = "WITH " + ",".join((TX, ETX))
    assert sql.startswith(prefix)
    return "WITH " + OTX + sql[len(prefix):]


ORACLES.update({
    "orders_split_counts": on_orders(SPLIT_COUNTS),
    "orders_label_runs": on_orders(LABEL_RUNS),
    "orders_velocity_week": on_orders(velocity("7 days", 2)),
    "orders_high_value": on_orders(HIGH_VALUE.replace("1000.0", "400000.0")),
    "orders_profile": on_orders(USER_PROFILE),
})


# ------------------------------------------------------------ streaming replay

def _closed_velocity(width: str, min_count: int) -> str:
    sql = velocity(width, min_count)
    cols = ("alert_id, transaction_id, user_id, event_time, rule, severity, amount, currency, "
            "amount_eur, location, country, p_fraud, detail, is_fraud")
    closed = (f"(g.ws + INTERVAL '{width}') <= "
              "(SELECT max(ts) FROM tx) - INTERVAL '5 minutes'")
    return f"SELECT {cols} FROM ({sql} WHERE {closed})"


ORACLES["stream_velocity_day"] = _closed_velocity("1 day", 4)

def _early_velocity(width: str, min_count: int, slices: int = 4) -> str:
    """Windows at the end of the first of `slices` equal parts of the time span in which they have
    `min_count` rows: rows of later parts are left out of the window."""
    base = velocity(width, min_count)
    bucket = f"time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01')"
    cut = f"""
span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM tx WHERE ts IS NOT NULL),
sliced AS (SELECT etx.*, {bucket} AS ws, (SELECT count(*) FROM range(1, {slices}) r(k), span
             WHERE epoch_us(ts) >= (hi - lo + 1) * k // {slices} + lo) AS slice FROM etx),
first AS (SELECT user_id AS fu, ws AS fw, min(slice) AS fired FROM (
            SELECT user_id, ws, slice, count(*) OVER (PARTITION BY user_id, ws ORDER BY slice) AS n FROM sliced)
          WHERE n >= {min_count} GROUP BY 1, 2),
w AS (SELECT sliced.* FROM sliced JOIN first ON fu = user_id AND fw = ws WHERE slice <= fired)"""
    old = f"""
w AS (SELECT *, {bucket} AS ws FROM etx)"""
    assert old in base
    return "SELECT * EXCLUDE (alert_time) FROM (" + base.replace(old, cut) + ")"


ORACLES["stream_velocity_early"] = _early_velocity("1 day", 4)
ORACLES["stream_velocity_uneven"] = _early_velocity("7 hours", 3)


ORACLES["stream_row_alerts"] = f"SELECT * EXCLUDE (alert_time) FROM ({ORACLES['row_alerts_r1_r4']})"
ORACLES["stream_suppress_repeats"] = SUPPRESS_REPEATS


# Rows by the step in which their slice is read; a step's watermark is the newest earlier time less the delay.
_LATE = with_tx("""
SELECT step, 'late row' AS kind, transaction_id, 1::BIGINT AS n FROM timed WHERE we <= w
UNION ALL
SELECT marks.step, 'windows left', NULL, (SELECT count(*) FROM (SELECT DISTINCT user_id, we FROM timed t
  WHERE t.step <= marks.step AND t.we > t.w AND t.we > marks.after)) FROM marks""", """
span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM tx WHERE ts IS NOT NULL),
sliced AS (SELECT tx.*, (SELECT count(*) FROM range(1, 6) r(k), span WHERE epoch_us(ts) >= (hi - lo + 1) * k // 6 + lo) AS slice
  FROM tx WHERE ts IS NOT NULL),
stepped AS (SELECT *, CASE slice WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 4 THEN 5 WHEN 5 THEN 4 ELSE slice END::INTEGER AS step,
    time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') + INTERVAL '7 days' AS we FROM sliced),
newest AS (SELECT step, date_trunc('millisecond', max(ts)) - INTERVAL '5 minutes' AS t FROM stepped GROUP BY step),
marks AS (SELECT r.step::INTEGER AS step, (SELECT max(t) FROM newest n WHERE n.step < r.step) AS w,
    (SELECT max(t) FROM newest n WHERE n.step <= r.step) AS after FROM range(0, 6) r(step)),
timed AS (SELECT stepped.*, coalesce(w, TIMESTAMP '1970-01-01') AS w FROM stepped JOIN marks ON marks.step = stepped.step)""")
ORACLES["stream_late_rows"] = _LATE


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
