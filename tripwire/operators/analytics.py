"""Analytics over alert tables (and stream progress), as Spark jobs.

Alert times are the ISO strings of the alert shape; they are parsed back to
timestamps here.
"""
from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tripwire.config import (
    GEO_WINDOW,
    LATEST_DEFAULT,
    RATE_WINDOW_SECONDS,
    RULE_GEO_HOP,
    RULE_VELOCITY,
    RULES,
    SEVERITIES,
    SEVERITY,
    STARVATION_SECONDS,
    VELOCITY_WINDOW,
)
from tripwire.functions.columns import iso, literal_map, width_seconds
from tripwire.operators.selection import value_at_rank


def parse_iso(col: Column) -> Column:
    return F.to_timestamp(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def latest_alerts(alerts: DataFrame, n: int = LATEST_DEFAULT) -> DataFrame:
    """Newest `n` alerts, newest first; ties by alert_id.
    Planned as a distributed top-k (each partition keeps its own top n)."""
    return alerts.orderBy(F.col("alert_time").desc(), F.col("alert_id").desc()).limit(max(1, int(n)))


def alert_rate(alerts: DataFrame, window_seconds: int = RATE_WINDOW_SECONDS) -> DataFrame:
    """One row: newest alert time and the number of alerts whose alert_time is
    within `window_seconds` of it. Two passes: the newest time (one scalar,
    fetched once), then a filtered count with that time as a literal."""
    t = parse_iso(F.col("alert_time"))
    newest = alerts.agg(F.max(t).alias("m")).first()["m"]
    spark = alerts.sparkSession
    if newest is None:
        return spark.createDataFrame([(None, 0)], "newest_alert_time string, alerts_in_window long")
    since = F.lit(newest) - F.make_interval(secs=F.lit(window_seconds))
    return alerts.filter(t >= since).agg(F.count(F.lit(1)).alias("alerts_in_window")).select(
        iso(F.lit(newest).cast("timestamp")).alias("newest_alert_time"), "alerts_in_window")


def counts_by_rule_and_severity(alerts: DataFrame) -> DataFrame:
    """(dimension, value, n) for every rule and every severity, zeros included.
    One scan and one global aggregate of conditional counts (partial counts
    per task, a single tiny exchange); no join."""
    cells = [("rule", r) for r in RULES] + [("severity", s) for s in SEVERITIES]
    aggs = [F.coalesce(F.sum(F.when(F.col(dim) == val, 1).otherwise(0)), F.lit(0)).cast("long")
            .alias(f"{dim}_{i}") for i, (dim, val) in enumerate(cells)]
    wide = alerts.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(dim).alias("dimension"), F.lit(val).alias("value"),
                              F.col(f"{dim}_{i}").alias("n")) for i, (dim, val) in enumerate(cells)])
    return wide.select(F.explode(rows).alias("c")).select("c.*")


def confusion_by_tau(scored: DataFrame, taus, score_col: str = "p_fraud",
                     label_col: str = "is_fraud") -> DataFrame:
    """Confusion matrix, precision and recall at each threshold of a small grid
    (`score >= tau` predicts positive); rows without a score are skipped.
    Precision / recall are NULL when their denominator is 0.

    One pass: one conditional sum per (tau, cell) in a single aggregate, then
    the grid is unpivoted. No join with the grid."""
    taus = [float(t) for t in taus]
    s, y = F.col(score_col), F.col(label_col) == 1
    aggs = []
    for i, tau in enumerate(taus):
        pred = s >= F.lit(tau)
        for cell, cond in (("tp", pred & y), ("fp", pred & ~y), ("fn", ~pred & y),
                           ("tn", ~pred & ~y)):
            aggs.append(F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
                        .cast("long").alias(f"{cell}_{i}"))
    wide = scored.filter(s.isNotNull()).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(tau).alias("tau"),
                              *[F.col(f"{c}_{i}").alias(c) for c in ("tp", "fp", "fn", "tn")])
                     for i, tau in enumerate(taus)])
    long = wide.select(F.explode(rows).alias("r")).select("r.*")
    def ratio(a, b):
        return F.when((F.col(a) + F.col(b)) > 0,
                      F.col(a) / (F.col(a) + F.col(b))).cast(DoubleType())
    return long.select("tau", "tp", "fp", "fn", "tn",
                       ratio("tp", "fp").alias("precision"), ratio("tp", "fn").alias("recall"))


def unique_alerts(alerts: DataFrame) -> DataFrame:
    """One row per alert_id over overlapping inputs (batch): the earliest by
    alert_time, then by its other columns, however the input is partitioned."""
    rest = [c for c in alerts.columns if c != "alert_id"]
    order = ["alert_time", *[c for c in rest if c != "alert_time"]]
    first = alerts.groupBy("alert_id").agg(F.min(F.struct(*order)).alias("a"))
    return first.select("alert_id", "a.*").select(*alerts.columns)


def unique_alerts_stream(alerts: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One row per alert_id on a stream; state is kept for `delay` of event time."""
    with_t = alerts.withColumn("_event_ts", parse_iso(F.col("event_time")))
    return (with_t.withWatermark("_event_ts", delay)
            .dropDuplicatesWithinWatermark(["alert_id"]).drop("_event_ts"))


def latency_p95(alerts: DataFrame, q: float = 0.95) -> DataFrame:
    """One row: n and the q-quantile of alert_time - event_time in seconds,
    taken as element int(q * (n - 1)) of the sorted deltas; both NULL without a delta. Found by a
    sketch's bracket and a count: two reads of the alerts, no sort, no global window over them."""
    delta = (F.unix_timestamp(F.col("alert_time"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
             - F.unix_timestamp(F.col("event_time"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    value, n = value_at_rank(alerts, delta, q, lambda n: math.floor(q * (n - 1)) + 1)
    return alerts.sparkSession.createDataFrame([(n or None, value)], "n long, p95_seconds long")


def window_start_of(event_time: Column, width: str) -> Column:
    """Epoch-aligned tumbling-window start of an event time (what `window`
    gives, usable several times in one projection)."""
    w_us = width_seconds(width) * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(event_time) / F.lit(w_us)) * F.lit(w_us))


def too_late(tx: DataFrame, width: str, watermark: datetime) -> DataFrame:
    """The rows that a window query drops at this watermark: those whose window has ended by then."""
    end = F.unix_micros(window_start_of(F.col("ts"), width)) + F.lit(width_seconds(width) * 1_000_000)
    return tx.filter(end <= F.unix_micros(F.lit(watermark)))


def duplicate_window_audit(alerts: DataFrame,
                           widths: dict | None = None) -> DataFrame:
    """Windowed alerts that share (rule, user, window) - the window rebuilt from
    event_time - with their count; an empty result passes the audit."""
    widths = widths or {RULE_VELOCITY: VELOCITY_WINDOW, RULE_GEO_HOP: GEO_WINDOW}
    t = parse_iso(F.col("event_time"))
    start = None
    for rule, width in widths.items():
        w = F.when(F.col("rule") == rule, window_start_of(t, width))
        start = w if start is None else F.coalesce(start, w)
    keyed = alerts.filter(F.col("rule").isin(*widths)).select(
        "rule", "user_id", iso(start).alias("window_start"))
    return (keyed.groupBy("rule", "user_id", "window_start")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def silent_rules(alerts: DataFrame) -> DataFrame:
    """Rules with no alert at all: (rule, severity). One aggregate of per-rule
    counts over the alerts (partial counts per task), then the rules whose
    count is zero; no join, nothing broadcast."""
    counts = counts_by_rule_and_severity(alerts).filter(
        (F.col("dimension") == "rule") & (F.col("n") == 0))
    severity = literal_map(SEVERITY)
    return counts.select(F.col("value").alias("rule"), severity[F.col("value")].alias("severity"))


# -------------------------------------------------------------- starvation

def starvation_episodes(progress: DataFrame, threshold_seconds: int = STARVATION_SECONDS,
                        chunk: str = "1 day") -> DataFrame:
    """One row per starvation episode of a stream query: the first poll of an
    idle stretch at which the query has reported zero input rows for at least
    `threshold_seconds` since its last non-empty poll (or since its first poll).
    After a non-empty poll a new episode can start. Polls of one query at one time count as one.

    `progress` has (query, at, num_input_rows). Polls are cut into chunks of time. A chunk is summed up by its first poll and
    its last non-empty one; these summaries, one row per chunk, are merged in order per query, and each
    chunk then judges its own polls. So no task holds all polls of a query."""
    polls = (progress.filter(F.col("at").isNotNull()).groupBy("query", "at").agg(F.sum("num_input_rows").alias("rows"))
             .select("query", "at", (F.col("rows") > 0).alias("fed"), F.window("at", chunk).start.alias("chunk")))
    fed_at = F.when(F.col("fed"), F.col("at"))
    summary = polls.groupBy("query", "chunk").agg(F.min("at").alias("first_at"), F.max(fed_at).alias("last_fed"))
    earlier = Window.partitionBy("query").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("query").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entry = summary.select(F.col("query").alias("_q"), F.col("chunk").alias("_c"),
                           F.coalesce(F.max("last_fed").over(earlier), F.min("first_at").over(upto)).alias("since"))
    inside = Window.partitionBy("query", "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    judged = (polls.join(entry, F.col("query").eqNullSafe(F.col("_q")) & (F.col("chunk") == F.col("_c")))
              .select("query", "at", "fed", F.coalesce(F.max(fed_at).over(inside), F.col("since")).alias("idle_since")))
    idle_for = (F.unix_micros("at") - F.unix_micros("idle_since")) / F.lit(1_000_000.0)
    # A stretch is known by the poll that it counts from.
    return (judged.filter(~F.col("fed") & (idle_for >= threshold_seconds))
            .groupBy("query", "idle_since").agg(F.min("at").alias("at"))
            .select("query", iso(F.col("at")).alias("at"), iso(F.col("idle_since")).alias("idle_since"),
                    idle_for.alias("idle_seconds")))
