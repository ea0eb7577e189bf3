"""Named batch queries over the driver tables: (spark, sf_dir) -> DataFrame.

Each query runs an operator over whole tables. Outputs carry no TIMESTAMP
columns (times are ISO strings) and every computed column has a fixed alias,
so results compare one-to-one with the DuckDB oracles in `oracle.py`.
"""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.config import ALERT_COLUMNS, ALERT_SCHEMA, CITY_COUNTRY, FEATURE_ORDER, LABEL, TS
from tripwire.functions.columns import iso, literal_map
from tripwire.operators.analytics import (
    alert_rate,
    confusion_by_tau,
    counts_by_rule_and_severity,
    duplicate_window_audit,
    latency_p95,
    latest_alerts,
    parse_iso,
    silent_rules,
    starvation_episodes,
    too_late,
    unique_alerts,
    window_start_of,
)
from tripwire.operators.contract import check_messages, quality_checks, reject_summary, split_messages
from tripwire.operators.enrich import enrich
from tripwire.operators.features import (
    add_features,
    label_rate,
    split_time,
    temporal_split,
    user_profiles,
)
from tripwire.operators.model import (
    add_p_fraud,
    areas,
    average_precision,
    pick_tau,
    score_points,
    spread,
    threshold_curve,
)
from tripwire.operators.rules import (
    alert_projection,
    ml_score_rule,
    geo_hop_rule,
    high_value_rule,
    velocity_rule,
    window_alerts,
    approx_distinct,
    row_alerts,
)
from tripwire.operators.sequences import label_runs, suppress_repeats, suppress_repeats_stream
from tripwire.session import scratch_path
from tripwire.streaming.folders import Folder
from tripwire.streaming.jobs import JobSettings, alert_streams, start_alert_query
from tripwire.streaming.progress import record_progress, windows_in_state
from tripwire.streaming.sinks import ParquetSink
from tripwire.train import fit
from tripwire.sources.dimensions import city_dimension
from tripwire.sources.streams import to_messages, transaction_file_stream
from tripwire.sources.tables import (
    data_key,
    load_places,
    load_transactions,
    table,
    transactions_from_events,
    transactions_from_orders,
)

Query = Callable[[SparkSession, str], DataFrame]


def enriched_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(load_transactions(spark, sf_dir), load_places(spark, sf_dir))


def q_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = enriched_tx(spark, sf_dir)
    return e.select(*[c for c in e.columns if c != TS], iso(F.col(TS)).alias("event_time"))


def q_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_projection(high_value_rule(enriched_tx(spark, sf_dir), clock_mode="event"))


def _velocity(width: str, min_count: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return alert_projection(velocity_rule(enriched_tx(spark, sf_dir), width=width,
                                              min_count=min_count, clock_mode="event"))
    return run


def _geo_hop(width: str, min_countries: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return alert_projection(geo_hop_rule(enriched_tx(spark, sf_dir), width=width,
                                             min_countries=min_countries, clock_mode="event"))
    return run


def alerts_of(e: DataFrame) -> DataFrame:
    """R1, R2 and R3 at their default settings: two scans of the input."""
    return alert_projection(high_value_rule(e, clock_mode="event")).unionByName(
        alert_projection(window_alerts(e)))


def q_all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1, R2 and R3 over one enriched input (R4 needs scores: `ml_alerts`, `row_alerts_r1_r4`)."""
    return alerts_of(enriched_tx(spark, sf_dir))


QUERIES: dict[str, Query] = {
        "all_alerts": q_all_alerts,
        "enrich": q_enrich,
        "high_value": q_high_value,
        "velocity_minute": _velocity("1 minute", 4),
        "velocity_hour": _velocity("1 hour", 2),
        "velocity_day": _velocity("1 day", 4),
        "geo_hop_5min": _geo_hop("5 minutes", 2),
        "geo_hop_hour": _geo_hop("1 hour", 2),
}


# ------------------------------------------------------- contract and features

def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Fix the precision of computed doubles (sums and transcendental functions
    differ in the last bits between engines and partitionings)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def q_message_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = to_messages(load_transactions(spark, sf_dir))
    return (check_messages(msgs).groupBy("status", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


def q_reject_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reject_summary(check_messages(to_messages(load_transactions(spark, sf_dir)))),
                  {"reject_rate"})


def q_dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_checks(load_transactions(spark, sf_dir))


def q_user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(user_profiles(enriched_tx(spark, sf_dir)), {"amt_mean", "amt_std"})


def q_label_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(label_rate(load_transactions(spark, sf_dir)), {"positive_rate"})


def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = enriched_tx(spark, sf_dir)
    cut = split_time(load_transactions(spark, sf_dir), 0.8)   # same ts values, no join
    in_train = F.lit(False) if cut is None else F.col(TS) <= F.lit(cut)
    in_valid = F.col(TS).isNotNull() & ~in_train
    def n(cond, value=F.lit(1)):
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")
    cut_text = F.lit(None).cast("string") if cut is None else iso(F.lit(cut).cast("timestamp"))
    return e.agg(n(in_train).alias("train_rows"), n(in_train, F.col(LABEL)).alias("train_positives"),
                 n(in_valid).alias("valid_rows"), n(in_valid, F.col(LABEL)).alias("valid_positives")
                 ).select(cut_text.alias("cut_time"), "*")


def q_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = enriched_tx(spark, sf_dir)
    train, _, _ = temporal_split(e, 0.8, times=load_transactions(spark, sf_dir))
    f = add_features(e, user_profiles(train))
    return _round(f.select("transaction_id", *FEATURE_ORDER, LABEL),
                  {"amount_eur", "log_amount", "amount_z"})


QUERIES.update({
    "message_check": q_message_check,
    "reject_gate": q_reject_gate,
    "dq_checks": q_dq_checks,
    "user_profile": q_user_profile,
    "label_rate": q_label_rate,
    "split_counts": q_split_counts,
    "features": q_features,
})


# ------------------------------------------------------------ alert analytics

_ALERT_TABLES: dict[tuple, str] = {}


def event_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert table the analytics read: every rule's alerts (event clock),
    written once per application below the shared checkpoint folder,
    partitioned by rule - as the alert sink lays it out - and read back. The
    write cuts the lineage, so each analytics query scans the table instead of
    recomputing the rules, and filters on `rule` prune partitions."""
    key = data_key(spark, sf_dir, "events", "nation")
    if key not in _ALERT_TABLES:
        path = scratch_path(spark, "alert_table", uuid.uuid4().hex)
        q_all_alerts(spark, sf_dir).write.partitionBy("rule").parquet(path)
        _ALERT_TABLES[key] = path
    return spark.read.parquet(_ALERT_TABLES[key]).select(*ALERT_COLUMNS)


def q_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_alerts(event_alerts(spark, sf_dir), 200)


def q_alert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_rate(event_alerts(spark, sf_dir))


def q_counts_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_rule_and_severity(event_alerts(spark, sf_dir))


def q_alert_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The same alerts delivered twice (a replayed batch): one row per alert_id.
    overlapping = event_alerts(spark, sf_dir).unionByName(q_high_value(spark, sf_dir))
    return unique_alerts(overlapping)


def q_latency_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency_p95(event_alerts(spark, sf_dir))


def q_duplicate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_window_audit(event_alerts(spark, sf_dir))


def q_silent_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silent_rules(event_alerts(spark, sf_dir))


def q_label_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(label_runs(enriched_tx(spark, sf_dir)), {"span_seconds"})


def q_suppress_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = q_high_value(spark, sf_dir).withColumn("t", parse_iso(F.col("event_time")))
    kept = suppress_repeats(alerts, ["rule", "user_id"], time_col="t",
                            order_cols=("alert_id",))
    return alert_projection(kept)


QUERIES.update({
    "latest_alerts": q_latest_alerts,
    "alert_rate": q_alert_rate,
    "counts_by_rule": q_counts_by_rule,
    "alert_dedup": q_alert_dedup,
    "latency_p95": q_latency_p95,
    "duplicate_audit": q_duplicate_audit,
    "silent_rules": q_silent_rules,
    "label_runs": q_label_runs,
    "suppress_repeats": q_suppress_repeats,
})


# ---------------------------------------------------------------------- model

_MODELS: dict[tuple, dict] = {}


def learnable(enriched: DataFrame) -> DataFrame:
    """The transactions with a label that the features explain in part (the given label is random):
    large amounts late in the day, blurred by a hash of the id."""
    blur = F.pmod(F.xxhash64("transaction_id"), F.lit(1000)) / 500.0
    signal = F.log1p("amount_eur") + F.hour(TS) / 12.0 + blur > 7.5
    return enriched.withColumn(LABEL, F.coalesce(signal.cast("int"), F.lit(0)))


def learnable_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the model queries learn from and score, spread over the cores."""
    return learnable(enrich(spread(load_transactions(spark, sf_dir)), load_places(spark, sf_dir)))


def trained(spark: SparkSession, sf_dir: str) -> dict:
    """Train once per data set and session: temporal split, profiles from the
    train part only, boosted trees with early stopping on the valid part. The
    model and profiles are written below the shared checkpoint folder and read
    back, so later queries do not recompute the training lineage."""
    key = data_key(spark, sf_dir, "events", "nation")
    if key in _MODELS:
        return _MODELS[key]
    _MODELS[key] = fit(learnable_tx(spark, sf_dir), times=load_transactions(spark, sf_dir))
    return _MODELS[key]


def q_model_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trained(spark, sf_dir)
    m = dict(t["metrics"])
    rows = t["scored_valid"].agg(F.count(F.lit(1)).alias("valid_rows"),
                                 F.sum(LABEL).cast("long").alias("valid_positives"))
    cols = [F.lit(float(v) if v is not None else None).cast("double").alias(k)
            for k, v in m.items()]
    return rows.select("*", *cols)


def q_tau_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_curve(trained(spark, sf_dir)["scored_valid"]).drop("prev_recall")


def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with its features and `p_fraud`."""
    t = trained(spark, sf_dir)
    return add_p_fraud(add_features(learnable_tx(spark, sf_dir), t["profiles"]), t["model"])


def q_ml_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tau = float(trained(spark, sf_dir)["metrics"]["tau"])
    return alert_projection(ml_score_rule(scored_transactions(spark, sf_dir), tau, clock_mode="event"))


def q_confusion_by_tau(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = [round(0.05 * i, 2) for i in range(1, 20)]
    return confusion_by_tau(scored_transactions(spark, sf_dir), grid)


QUERIES.update({
    "model_eval": q_model_eval,
    "tau_sweep": q_tau_sweep,
    "ml_alerts": q_ml_alerts,
    "confusion_by_tau": q_confusion_by_tau,
})


# ------------------------------------- inputs on which every rule and check has work

#: Times run this many times faster, so that default windows hold several transactions.
DENSITY = 1440


def dense_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions with times compressed: a day becomes a minute."""
    faster = F.timestamp_micros(F.floor(F.unix_micros(F.col(TS)) / F.lit(DENSITY)).cast("long"))
    return enriched_tx(spark, sf_dir).withColumn(TS, faster)


def q_alerts_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_of(dense_tx(spark, sf_dir))


def q_velocity_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_projection(velocity_rule(dense_tx(spark, sf_dir), clock_mode="event"))


def q_geo_hop_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_projection(geo_hop_rule(dense_tx(spark, sf_dir), clock_mode="event"))


def q_duplicate_audit_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed alerts of which some were delivered twice (a replay at a higher threshold)."""
    e = dense_tx(spark, sf_dir)
    return duplicate_window_audit(window_alerts(e).unionByName(window_alerts(e, min_count=6, min_countries=5)))


def q_latency_p95_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency_p95(window_alerts(dense_tx(spark, sf_dir)))


def q_window_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions per rebuilt 5-minute window start."""
    start = window_start_of(F.col(TS), "5 minutes")
    return (load_transactions(spark, sf_dir).groupBy(iso(start).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_alert_dedup_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocity alerts of two widths, delivered twice: equal starts are different alerts."""
    e = enriched_tx(spark, sf_dir)
    both = [velocity_rule(e, width=w, min_count=2, clock_mode="event") for w in ("1 hour", "1 day")]
    alerts = alert_projection(both[0]).unionByName(alert_projection(both[1]))
    return unique_alerts(alerts.unionByName(alerts))


def q_large_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 alerts, one per id, with event ids beyond seven digits."""
    events = table(spark, sf_dir, "events").withColumn("event_id", F.col("event_id") + F.lit(10 ** 10))
    e = enrich(transactions_from_events(events), load_places(spark, sf_dir))
    return unique_alerts(alert_projection(high_value_rule(e, clock_mode="event")))


def q_enrich_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions at named cities, enriched from the fixed dimension; two of 43 places are unknown."""
    names = dict(enumerate(CITY_COUNTRY)) | {41: "Atlantis", 42: None}
    city = literal_map({k: v for k, v in names.items() if v})[F.substring("transaction_id", 3, 20).cast("long") % 43]
    tx = load_transactions(spark, sf_dir).withColumn("location", city)
    return enrich(tx, city_dimension(spark)).select("transaction_id", "location", "country")


def bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all transactions, some spoiled by a rule on the id: not JSON, an array, a
    missing key, a null key, an amount or a time that cannot be read. They are written, so that
    their readers read messages."""
    value = F.col("value")
    path = scratch_path(spark, "messages", uuid.uuid4().hex)
    spoiled = (to_messages(load_transactions(spark, sf_dir)).withColumn("kind", F.get_json_object("value", "$.transaction_id"))
            .withColumn("kind", F.substring("kind", 3, 20).cast("long") % 20)
            .select("key", F.when(F.col("kind") == 0, F.lit("{not json"))
                    .when(F.col("kind") == 1, F.concat(F.lit("["), value, F.lit("]")))
                    .when(F.col("kind") == 2, F.regexp_replace(value, '"currency":"[A-Z]+",', ""))
                    .when(F.col("kind") == 3, F.regexp_replace(value, '"currency":"[A-Z]+"', '"currency":null'))
                    .when(F.col("kind") == 4, F.regexp_replace(value, '"amount":[0-9.E]+', '"amount":1e19'))
                    .when(F.col("kind") == 5, F.regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"soon"'))
                    .otherwise(value).alias("value")))
    spoiled.write.parquet(path)
    return spark.read.schema(spoiled.schema).parquet(path)


def q_message_check_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (check_messages(bad_messages(spark, sf_dir)).groupBy("status", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


def q_reject_gate_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reject_summary(check_messages(bad_messages(spark, sf_dir))), {"reject_rate"})


def q_parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns of every good message, enriched: whole seconds, as the wire format has."""
    good, _ = split_messages(bad_messages(spark, sf_dir))
    e = enrich(good, load_places(spark, sf_dir))
    return e.select(*[c for c in e.columns if c != TS], iso(F.col(TS)).alias("event_time"))


def q_suppress_repeats_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All R1 alerts under one key."""
    alerts = q_high_value(spark, sf_dir).withColumn("t", parse_iso(F.col("event_time")))
    return alert_projection(suppress_repeats(alerts, ["rule"], time_col="t", order_cols=("alert_id",)))


def q_approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct transactions per method: the estimate within four standard errors of the exact count."""
    tx = load_transactions(spark, sf_dir)
    exact = tx.groupBy("method").agg(F.count_distinct("transaction_id").alias("n_exact"))
    return approx_distinct(tx, ["method"], "transaction_id").join(exact, "method").select(
        "method", "n_exact",
        (F.abs(F.col("approx_distinct") - F.col("n_exact")) <= 0.2 * F.col("n_exact")).cast("int").alias("within"))


def formula_score(f: DataFrame) -> DataFrame:
    """Add a score that SQL can state: a logistic formula of the features."""
    x = (0.8 * F.round("amount_z", 6) + 0.5 * F.round("log_amount", 6) - 0.02 * F.col("hour")
         + 0.1 * F.col("dayofweek") + 0.4 * F.col("is_night") + 0.2 * F.col("method_id")
         - 0.3 * F.col("currency_id") + 0.001 * F.col("amount_eur") + F.col("is_new_user") - 4.0)
    return f.withColumn("p_fraud", F.round(1 / (1 + F.exp(-x)), 8))


def formula_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with its features and the formula's score."""
    e = enriched_tx(spark, sf_dir)
    return formula_score(add_features(e, user_profiles(e)))


def q_tau_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(threshold_curve(formula_scores(spark, sf_dir)),
                  {"precision", "recall", "f1", "prev_recall"})


def q_pick_tau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best threshold, and how many rows score at least it and above it (R4 is strict)."""
    scored = formula_scores(spark, sf_dir)
    best = pick_tau(threshold_curve(scored))
    tau = F.lit(best.first()["tau"])
    hits = scored.agg(F.count_if(F.col("p_fraud") >= tau).alias("at_least"),
                      F.count_if(F.col("p_fraud") > tau).alias("above"))
    return _round(hits.select(tau.alias("tau"), "at_least", "above"), {"tau"}, 8)


def q_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(average_precision(threshold_curve(formula_scores(spark, sf_dir))), {"average_precision"})


def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(areas(score_points(formula_scores(spark, sf_dir))).select("roc_auc"), {"roc_auc"})


def q_pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(areas(score_points(formula_scores(spark, sf_dir))).select("pr_auc"), {"pr_auc"})


def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = [round(0.05 * i, 2) for i in range(1, 20)]
    return _round(confusion_by_tau(formula_scores(spark, sf_dir), grid), {"precision", "recall"})


def q_row_alerts_r1_r4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 and R4 from one pass; the scores are printed to four digits in the detail."""
    return alert_projection(row_alerts(formula_scores(spark, sf_dir), tau=0.7, clock_mode="event")).drop("detail")


def q_ml_alerts_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_projection(ml_score_rule(formula_scores(spark, sf_dir), 0.5, clock_mode="event")).drop("detail")


QUERIES.update({
    "alerts_dense": q_alerts_dense,
    "velocity_dense": q_velocity_dense,
    "geo_hop_dense": q_geo_hop_dense,
    "duplicate_audit_dense": q_duplicate_audit_dense,
    "latency_p95_dense": q_latency_p95_dense,
    "window_starts": q_window_starts,
    "alert_dedup_widths": q_alert_dedup_widths,
    "large_ids": q_large_ids,
    "enrich_cities": q_enrich_cities,
    "message_check_mixed": q_message_check_mixed,
    "reject_gate_mixed": q_reject_gate_mixed,
    "parse_messages": q_parse_messages,
    "suppress_repeats_hot": q_suppress_repeats_hot,
    "approx_distinct": q_approx_distinct,
    "tau_curve": q_tau_curve,
    "pick_tau": q_pick_tau,
    "average_precision": q_average_precision,
    "roc_auc": q_roc_auc,
    "pr_auc": q_pr_auc,
    "confusion": q_confusion,
    "row_alerts_r1_r4": q_row_alerts_r1_r4,
    "ml_alerts_formula": q_ml_alerts_formula,
})


# ------------------------------------------------------- second input: orders

def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions_from_orders(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    return enrich(tx, load_places(spark, sf_dir))


def q_orders_velocity_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 over orders: whole-day times, so the latest row is decided by the
    transaction-id tie-break."""
    return alert_projection(velocity_rule(enriched_orders(spark, sf_dir), width="7 days",
                                          min_count=2, clock_mode="event"))


def q_orders_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_projection(high_value_rule(enriched_orders(spark, sf_dir), threshold=400000.0,
                                            clock_mode="event"))


def q_orders_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(user_profiles(enriched_orders(spark, sf_dir)), {"amt_mean", "amt_std"})


def q_orders_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temporal split over whole-day order times: many rows tie at the cut,
    and all of them go to train."""
    e = enriched_orders(spark, sf_dir)
    cut = split_time(e, 0.8)
    in_train = F.lit(False) if cut is None else F.col(TS) <= F.lit(cut)
    in_valid = F.col(TS).isNotNull() & ~in_train
    def n(cond, value=F.lit(1)):
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")
    cut_text = F.lit(None).cast("string") if cut is None else iso(F.lit(cut).cast("timestamp"))
    return e.agg(n(in_train).alias("train_rows"), n(in_train, F.col(LABEL)).alias("train_positives"),
                 n(in_valid).alias("valid_rows"), n(in_valid, F.col(LABEL)).alias("valid_positives")
                 ).select(cut_text.alias("cut_time"), "*")


def q_orders_label_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of labelled orders per customer; same-day orders are ordered by id."""
    return _round(label_runs(enriched_orders(spark, sf_dir)), {"span_seconds"})


QUERIES.update({
    "orders_split_counts": q_orders_split_counts,
    "orders_label_runs": q_orders_label_runs,
    "orders_velocity_week": q_orders_velocity_week,
    "orders_high_value": q_orders_high_value,
    "orders_profile": q_orders_profile,
})


# ------------------------------------------------------------ streaming replay

REPLAY_SLICES = 4


def time_slices(tx: DataFrame, count: int = REPLAY_SLICES) -> list[tuple[int, int]]:
    """The span of `ts` as equal slices [since, until) in microseconds, oldest first; none without a time."""
    lo, hi = tx.agg(F.min(F.unix_micros(TS)), F.max(F.unix_micros(TS))).first()
    cuts = [] if lo is None else [(hi - lo + 1) * i // count + lo for i in range(count + 1)]
    return list(zip(cuts, cuts[1:]))


def in_slice(tx: DataFrame, since: int, until: int) -> DataFrame:
    # Bounds on the plain column, so that they reach the scan.
    return tx.filter((F.col(TS) >= F.timestamp_micros(F.lit(since))) & (F.col(TS) < F.timestamp_micros(F.lit(until))))


def replay(spark: SparkSession, tx: DataFrame, slices: list[tuple[int, int]], name: str, frame_of, settings: JobSettings,
           run: str) -> DataFrame:
    """Replay the transactions as a file stream through one alert query and read back what its sink
    wrote. A slice is one micro-batch of as many files as its rows need: it is added to the source
    folder, and the query is started again from its checkpoint until it has read all there is."""
    src, out = os.path.join(run, "in"), os.path.join(run, "out")
    for since, until in slices:
        in_slice(tx, since, until).write.mode("append").parquet(src)
        frame = frame_of(transaction_file_stream(spark, src, "parquet"))
        start_alert_query(name, frame, settings, [ParquetSink(out)]).awaitTermination()
    shape = spark.createDataFrame([], ALERT_SCHEMA)
    # Without any alert the sink has written no folder.
    return spark.read.schema(shape.schema).parquet(out) if Folder(spark, out).names() else shape


def _replay_settings(run: str, **options) -> JobSettings:
    return JobSettings(checkpoint_root=os.path.join(run, "ckpt"), trigger={"availableNow": True}, **options)


def replay_stream_alerts(spark: SparkSession, sf_dir: str, width: str = "1 day",
                         min_count: int = 4, mode: str = "final") -> DataFrame:
    """The velocity query over a replay in equal slices of time, oldest first. Each call uses
    a fresh folder below the shared checkpoint folder."""
    run = scratch_path(spark, "replay", uuid.uuid4().hex)
    tx = load_transactions(spark, sf_dir).filter(F.col(TS).isNotNull())
    settings = _replay_settings(run, mode=mode, velocity_window=width, velocity_min=min_count)
    return replay(spark, tx, time_slices(tx), "velocity",
                  lambda stream: alert_streams(stream, settings, load_places(spark, sf_dir))["velocity"], settings, run)


def q_stream_velocity_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = replay_stream_alerts(spark, sf_dir, "1 day", 4)
    return alerts.select(*[c for c in ALERT_COLUMNS if c != "alert_time"])


def q_stream_velocity_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early mode over a time-ordered replay: every window that reaches the threshold fires once,
    open or closed, with the count and the latest row of its firing time. All columns but the
    wall-clock `alert_time`."""
    alerts = replay_stream_alerts(spark, sf_dir, "1 day", 4, mode="early")
    return alerts.select(*[c for c in ALERT_COLUMNS if c != "alert_time"])


def q_stream_velocity_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early mode with windows (7 hours) of which the delay is no multiple."""
    alerts = replay_stream_alerts(spark, sf_dir, "7 hours", 3, mode="early")
    return alerts.select(*[c for c in ALERT_COLUMNS if c != "alert_time"])


def q_stream_row_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 and R4 on a stream: each micro-batch is joined to the written profiles, gets its features and
    score, and gives its alerts in one pass over the source. All columns but the wall-clock `alert_time`
    and the detail (scores are printed there)."""
    run = scratch_path(spark, "replay", uuid.uuid4().hex)
    tx = load_transactions(spark, sf_dir).filter(F.col(TS).isNotNull())
    user_profiles(enriched_tx(spark, sf_dir)).write.parquet(os.path.join(run, "profiles"))
    profiles = spark.read.parquet(os.path.join(run, "profiles"))
    settings = _replay_settings(run)
    def rows(stream):
        return alert_streams(stream, settings, load_places(spark, sf_dir),
                             scorer=lambda e: formula_score(add_features(e, profiles)), tau=0.7)["row"]
    alerts = replay(spark, tx, time_slices(tx), "row", rows, settings, run)
    return alerts.select(*[c for c in ALERT_COLUMNS if c not in ("alert_time", "detail")])


def q_stream_suppress_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 alerts of a replay, repeats within the time-to-live suppressed by state and timers per (rule, user):
    what `suppress_repeats` keeps of the table."""
    run = scratch_path(spark, "replay", uuid.uuid4().hex)
    tx = load_transactions(spark, sf_dir).filter(F.col(TS).isNotNull())
    def kept(stream):
        alerts = alert_projection(high_value_rule(enrich(stream, load_places(spark, sf_dir)), clock_mode="event"))
        return alert_projection(suppress_repeats_stream(alerts.withColumn("t", parse_iso(F.col("event_time"))), ["rule", "user_id"],
                                                        time_col="t", order_cols=("alert_id",)))
    return replay(spark, tx, time_slices(tx), "suppressed", kept, _replay_settings(run), run).select(*ALERT_COLUMNS)


#: Six slices of time, two pairs of them in the wrong order.
LATE_ORDER = (0, 2, 1, 3, 5, 4)


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly velocity windows over a replay whose slices come out of order. Per step: the rows that come too late for
    the watermark of their batch, as the progress log has it, and the windows left in the state afterwards."""
    run = scratch_path(spark, "replay", uuid.uuid4().hex)
    tx = load_transactions(spark, sf_dir).filter(F.col(TS).isNotNull())
    slices = time_slices(tx, len(LATE_ORDER))
    settings = _replay_settings(run, velocity_window="7 days", velocity_min=2)
    src, left = os.path.join(run, "in"), []
    log = record_progress(spark, os.path.join(run, "progress"), names=["alerts_velocity"])
    try:
        for k in LATE_ORDER if slices else ():
            in_slice(tx, *slices[k]).write.mode("append").parquet(src)
            frame = alert_streams(transaction_file_stream(spark, src, "parquet"), settings, load_places(spark, sf_dir))["velocity"]
            q = start_alert_query("velocity", frame, settings, [ParquetSink(os.path.join(run, "out"))])
            q.awaitTermination()
            log.wait([q])
            left.append(windows_in_state(spark, settings.checkpoint("velocity")))
        # One batch with rows per step; a slice without rows has none.
        batches = iter(log.frame(spark).filter(F.col("num_input_rows") > 0).orderBy("batch").collect())
    finally:
        spark.streams.removeListener(log)
    rows = spark.createDataFrame([(s, "windows left", None, n) for s, n in enumerate(left)],
                                 "step int, kind string, transaction_id string, n long")
    for step, k in enumerate(LATE_ORDER if slices else ()):
        part = in_slice(tx, *slices[k])
        if part.isEmpty():
            continue
        late = too_late(part, "7 days", next(batches)["watermark"])
        rows = rows.union(late.select(F.lit(step), F.lit("late row"), "transaction_id", F.lit(1).cast("long")))
    return rows


def week_parts(tx: DataFrame) -> list[tuple[str, int, int]]:
    """The span of `ts` as working weeks and weekends in order: (feed, since, until) in microseconds."""
    lo, hi = tx.agg(F.unix_micros(F.date_trunc("week", F.min(TS))), F.unix_micros(F.max(TS))).first()
    first = tx.agg(F.unix_micros(F.min(TS))).first()[0]
    day, parts = 86_400_000_000, []
    while lo is not None and lo <= hi:
        parts += [("weekday", lo, lo + 5 * day), ("weekend", lo + 5 * day, lo + 7 * day)]
        lo += 7 * day
    return [p for p in parts if p[2] > first and p[1] <= hi]


def replay_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress log of two R1 queries over feeds of the transactions: one has those of working days, one those of
    weekends. Both are polled at the end of every working week and every weekend, whether their feed has rows or not; the log
    carries that time."""
    run = scratch_path(spark, "feeds", uuid.uuid4().hex)
    tx = load_transactions(spark, sf_dir).filter(F.col(TS).isNotNull())
    parts = week_parts(tx)
    def clock(name: str, batch: int) -> str:
        return datetime.fromtimestamp(parts[batch][2] / 1e6, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    feeds = ("weekday", "weekend")
    log = record_progress(spark, os.path.join(run, "progress"), clock=clock, names=[f"alerts_{f}" for f in feeds])
    try:
        for feed, since, until in parts:
            started = []
            for name in feeds:
                src = os.path.join(run, name, "in")
                (in_slice(tx, since, until) if name == feed else tx.limit(0)).write.mode("append").parquet(src)
                stream = enrich(transaction_file_stream(spark, src, "parquet"), load_places(spark, sf_dir))
                started.append(start_alert_query(name, high_value_rule(stream, clock_mode="event"), _replay_settings(os.path.join(run, name)),
                                                 [ParquetSink(os.path.join(run, name, "out"))]))
            for q in started:
                q.awaitTermination()
            log.wait(started)
        return log.frame(spark)
    finally:
        spark.streams.removeListener(log)


#: A feed without a row for so long is starved: longer than a weekend, shorter than a working week.
FEED_STARVED_SECONDS = 3 * 86_400


def q_starvation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starved stretches of the replayed feeds, from their progress log."""
    return _round(starvation_episodes(replay_log(spark, sf_dir), FEED_STARVED_SECONDS, chunk="7 days"), {"idle_seconds"})


QUERIES["stream_row_alerts"] = q_stream_row_alerts
QUERIES["stream_suppress_repeats"] = q_stream_suppress_repeats
QUERIES["stream_late_rows"] = q_stream_late_rows
QUERIES["starvation"] = q_starvation
QUERIES["stream_velocity_day"] = q_stream_velocity_day
QUERIES["stream_velocity_early"] = q_stream_velocity_early
QUERIES["stream_velocity_uneven"] = q_stream_velocity_uneven


def queries() -> dict[str, Query]:
    return dict(QUERIES)
