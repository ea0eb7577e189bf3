"""The four alert rules, as DataFrame -> DataFrame operators.

R1 `high_value` and R4 `ml_score` are row rules; R2 `velocity` and R3
`geo_hop` are per-user tumbling event-time windows. Every rule works on batch
and streaming frames. Output rows have the 15 alert columns; windowed rules add
`window_start` (TIMESTAMP), the de-duplication key, which sinks drop.

`clock` decides `alert_time`: "wall" is the processing time (streams);
"event" is the event-time instant the alert becomes final - the event itself
for row rules, window end plus allowed lateness for windowed rules - so a batch
replay is deterministic.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.config import (
    ALERT_COLUMNS,
    GEO_MIN_COUNTRIES,
    GEO_WINDOW,
    HIGH_VALUE_EUR,
    LABEL,
    RULE_GEO_HOP,
    RULE_HIGH_VALUE,
    RULE_ML_SCORE,
    RULE_VELOCITY,
    SEVERITY,
    TS,
    VELOCITY_MIN_COUNT,
    VELOCITY_WINDOW,
    WATERMARK,
)
from tripwire.functions.columns import alert_key, clock, iso, width_seconds

def null_double() -> Column:
    return F.lit(None).cast("double")

# Fields of the representative (latest) transaction of a window.
_CARRIED = ("transaction_id", "amount", "currency", "amount_eur", "location",
            "country", TS, LABEL)


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def _row_key() -> list[Column]:
    """A transaction's id; without one its user, time and amount."""
    tid = F.col("transaction_id")
    return [tid, F.when(tid.isNull(), F.concat_ws("|", "user_id", iso(F.col(TS)), F.col("amount").cast("string")))]


def _alert_columns(*, rule: str, key: list[Column], transaction_id: Column, user_id: Column,
                   event_ts: Column, alert_ts: Column, amount: Column, currency: Column,
                   amount_eur: Column, location: Column, country: Column,
                   p_fraud: Column, detail: Column, label: Column) -> list[Column]:
    """The one alert shape, shared by every rule."""
    return [
        alert_key(F.lit(rule), *key).alias("alert_id"),
        transaction_id.alias("transaction_id"),
        user_id.alias("user_id"),
        iso(event_ts).alias("event_time"),
        iso(alert_ts).alias("alert_time"),
        F.lit(rule).alias("rule"),
        F.lit(SEVERITY[rule]).alias("severity"),
        amount.alias("amount"),
        currency.alias("currency"),
        amount_eur.alias("amount_eur"),
        location.alias("location"),
        country.alias("country"),
        p_fraud.alias("p_fraud"),
        detail.alias("detail"),
        label.alias(LABEL),
    ]


# ---------------------------------------------------------------- row rules

def _row_candidate(rule: str, hit: Column, detail: Column, p_fraud: Column) -> Column:
    return F.when(hit, F.struct(F.lit(rule).alias("rule"), detail.alias("detail"),
                                p_fraud.alias("p_fraud")))


def high_value_detail(threshold: float) -> Column:
    return F.concat(F.lit("amount "), F.col("amount_eur").cast("string"),
                    F.lit(f" EUR exceeds {threshold!r} threshold"))


def ml_score_detail(tau: float) -> Column:
    return F.concat(F.lit("p_fraud="), F.round(F.col("p_fraud"), 4).cast("string"),
                    F.lit(f" exceeds tau={tau!r}"))


def row_alerts(enriched: DataFrame, *, high_value: float | None = HIGH_VALUE_EUR,
               tau: float | None = None, clock_mode: str = "wall") -> DataFrame:
    """R1 and R4 in one pass over the input (a union of two branches would
    read a streaming source twice). A rule is off when its threshold is None;
    R4 needs a `p_fraud` column. A row can raise both alerts."""
    candidates, any_hit = [], F.lit(False)
    if high_value is not None:
        hit = F.col("amount_eur") > F.lit(high_value)
        candidates.append(_row_candidate(RULE_HIGH_VALUE, hit, high_value_detail(high_value),
                                         null_double()))
        any_hit = any_hit | F.coalesce(hit, F.lit(False))
    if tau is not None:
        hit = F.col("p_fraud") > F.lit(tau)
        candidates.append(_row_candidate(RULE_ML_SCORE, hit, ml_score_detail(tau),
                                         F.col("p_fraud")))
        any_hit = any_hit | F.coalesce(hit, F.lit(False))
    if not candidates:
        raise ValueError("no row rule enabled")
    fired = F.filter(F.array(*candidates), lambda c: c.isNotNull())
    hits = enriched.filter(any_hit).select("*", F.explode(fired).alias("hit"))
    alert_ts = F.current_timestamp() if clock_mode == "wall" else F.col(TS)
    rule_names = [c for c in (RULE_HIGH_VALUE if high_value is not None else None,
                              RULE_ML_SCORE if tau is not None else None) if c]
    if len(rule_names) == 1:
        return _shape_row(hits, rule_names[0], alert_ts)
    # Two rules: rule-specific literals are taken from the exploded struct.
    rule = F.col("hit.rule")
    cols = [
        alert_key(rule, *_row_key()).alias("alert_id"),
        F.col("transaction_id"), F.col("user_id"),
        iso(F.col(TS)).alias("event_time"), iso(alert_ts).alias("alert_time"),
        rule.alias("rule"),
        F.when(rule == RULE_HIGH_VALUE, F.lit(SEVERITY[RULE_HIGH_VALUE]))
         .otherwise(F.lit(SEVERITY[RULE_ML_SCORE])).alias("severity"),
        F.col("amount"), F.col("currency"), F.col("amount_eur"), F.col("location"),
        F.col("country"), F.col("hit.p_fraud").alias("p_fraud"),
        F.col("hit.detail").alias("detail"), F.col(LABEL),
    ]
    return hits.select(*cols)


def _shape_row(hits: DataFrame, rule: str, alert_ts: Column) -> DataFrame:
    return hits.select(*_alert_columns(
        rule=rule, key=_row_key(), transaction_id=F.col("transaction_id"),
        user_id=F.col("user_id"), event_ts=F.col(TS), alert_ts=alert_ts,
        amount=F.col("amount"), currency=F.col("currency"), amount_eur=F.col("amount_eur"),
        location=F.col("location"), country=F.col("country"),
        p_fraud=F.col("hit.p_fraud"), detail=F.col("hit.detail"), label=F.col(LABEL)))


def high_value_rule(enriched: DataFrame, threshold: float = HIGH_VALUE_EUR,
                    clock_mode: str = "wall") -> DataFrame:
    """R1: `amount_eur > threshold` (strict)."""
    return row_alerts(enriched, high_value=threshold, tau=None, clock_mode=clock_mode)


def ml_score_rule(scored: DataFrame, tau: float, clock_mode: str = "wall") -> DataFrame:
    """R4: `p_fraud > tau` (strict); needs a `p_fraud` column."""
    return row_alerts(scored, high_value=None, tau=tau, clock_mode=clock_mode)


# ----------------------------------------------------------- windowed rules

def latest_transaction() -> Column:
    """Latest row of a group as a struct. Ordered by (ts, transaction_id) so
    equal times (common at one-second resolution) pick a deterministic row."""
    return F.max_by(F.struct(*[F.col(c) for c in _CARRIED]),
                    F.struct(F.col(TS), F.col("transaction_id")))


def window_groups(enriched: DataFrame, width: str, watermark: str | None,
                  *aggs: Column) -> DataFrame:
    """Per (tumbling event-time window, user) aggregate. Epoch-aligned windows.
    Partial aggregation runs before the shuffle, so a hot user costs one
    partial row per input partition, not one task holding all its rows."""
    src = enriched.withWatermark(TS, watermark) if watermark else enriched
    return src.groupBy(F.window(F.col(TS), width).alias("window"), F.col("user_id")).agg(*aggs)


def shape_window_alerts(grouped: DataFrame, rule: str, detail: Column, width: str,
                    watermark: str | None, clock_mode: str) -> DataFrame:
    last = F.col("last_tx")
    start, end = F.col("window.start"), F.col("window.end")
    if clock_mode == "wall":
        alert_ts = F.current_timestamp()
    else:
        alert_ts = end + _interval(watermark) if watermark else end
    cols = _alert_columns(
        rule=rule, key=[F.col("user_id"), iso(start), iso(end)],
        transaction_id=last.getField("transaction_id"), user_id=F.col("user_id"),
        event_ts=last.getField(TS), alert_ts=alert_ts,
        amount=last.getField("amount"), currency=last.getField("currency"),
        amount_eur=last.getField("amount_eur"), location=last.getField("location"),
        country=last.getField("country"), p_fraud=null_double(), detail=detail,
        label=last.getField(LABEL))
    return grouped.select(*cols, start.alias("window_start"))


def velocity_detail() -> Column:
    """`<n> transactions in window HH:mm:ss-HH:mm:ss` (needs tx_count, window)."""
    return F.concat(F.col("tx_count").cast("string"), F.lit(" transactions in window "),
                    clock(F.col("window.start")), F.lit("-"), clock(F.col("window.end")))


def geo_hop_detail() -> Column:
    """`<n> countries in window HH:mm:ss-HH:mm:ss: AA,BB` (sorted countries)."""
    return F.concat(F.col("n_countries").cast("string"), F.lit(" countries in window "),
                    clock(F.col("window.start")), F.lit("-"), clock(F.col("window.end")),
                    F.lit(": "), F.array_join(F.col("countries"), ","))


def velocity_rule(enriched: DataFrame, width: str = VELOCITY_WINDOW,
                  min_count: int = VELOCITY_MIN_COUNT, watermark: str | None = WATERMARK,
                  clock_mode: str = "wall") -> DataFrame:
    """R2: at least `min_count` transactions of one user in one window. A set with one flag per group
    makes Spark hash the groups; with the latest row alone it would sort the whole input."""
    grouped = (window_groups(enriched, width, watermark,
                             F.count(F.lit(1)).alias("tx_count"),
                             F.collect_set(F.lit(True)).alias("any"),
                             latest_transaction().alias("last_tx"))
               .filter((F.col("tx_count") >= min_count) & (F.size("any") == 1)))
    return shape_window_alerts(grouped, RULE_VELOCITY, velocity_detail(), width, watermark,
                               clock_mode)


def geo_hop_rule(enriched: DataFrame, width: str = GEO_WINDOW,
                 min_countries: int = GEO_MIN_COUNTRIES, watermark: str | None = WATERMARK,
                 clock_mode: str = "wall") -> DataFrame:
    """R3: at least `min_countries` distinct known countries for one user in one
    window. Exact count: the set is collected anyway (bounded by the number of
    countries), and NULL countries do not count."""
    grouped = (window_groups(enriched, width, watermark,
                             F.array_sort(F.collect_set("country")).alias("countries"),
                             latest_transaction().alias("last_tx"))
               .withColumn("n_countries", F.size("countries"))
               .filter(F.col("n_countries") >= min_countries))
    return shape_window_alerts(grouped, RULE_GEO_HOP, geo_hop_detail(), width, watermark,
                               clock_mode)


def window_alerts(enriched: DataFrame, fine: str = VELOCITY_WINDOW, wide: str = GEO_WINDOW,
                  min_count: int = VELOCITY_MIN_COUNT, min_countries: int = GEO_MIN_COUNTRIES,
                  watermark: str | None = WATERMARK) -> DataFrame:
    """R2 on `fine` windows and R3 on `wide` ones (a whole multiple) from one scan, event clock,
    batch. One partial aggregate per (user, fine window) holds count, country set and latest row;
    the wide window rolls its few fine windows up. The set makes it an object-hash aggregate."""
    if width_seconds(wide) % width_seconds(fine):
        raise ValueError(f"{wide} is not a whole multiple of {fine}")
    stats = window_groups(enriched, fine, None, F.count(F.lit(1)).alias("tx_count"),
                          F.collect_set("country").alias("seen"), latest_transaction().alias("last_tx"))
    parts = F.struct("window", "tx_count", "last_tx", "seen")
    rolled = stats.groupBy(F.window(F.col("window.start"), wide).alias("over"), "user_id").agg(
        F.collect_list(parts).alias("parts"))
    fired = F.filter("parts", lambda p: p["tx_count"] >= min_count)
    countries = F.array_sort(F.array_distinct(F.flatten(F.transform("parts", lambda p: p["seen"]))))
    newest = F.array_max(F.transform("parts", lambda p: F.struct(
        p["last_tx"][TS].alias("t"), p["last_tx"]["transaction_id"].alias("id"), p["last_tx"].alias("row"))))
    rolled = rolled.select("user_id", "over", fired.alias("fired"), countries.alias("countries"),
                           newest["row"].alias("newest"))
    none = F.array().cast("array<string>")
    r2 = F.transform("fired", lambda p: F.struct(
        F.lit(RULE_VELOCITY).alias("rule"), p["window"].alias("window"), p["tx_count"].alias("tx_count"),
        p["last_tx"].alias("last_tx"), none.alias("countries")))
    r3 = F.when(F.size("countries") >= min_countries, F.array(F.struct(
        F.lit(RULE_GEO_HOP).alias("rule"), F.col("over").alias("window"), F.lit(0).cast("long").alias("tx_count"),
        F.col("newest").alias("last_tx"), F.col("countries")))).otherwise(F.slice(r2, 1, 0))
    hits = rolled.select("user_id", F.explode(F.concat(r2, r3)).alias("hit")).select(
        "user_id", "hit.*", F.size("hit.countries").alias("n_countries"))
    is_r2 = F.col("rule") == RULE_VELOCITY
    last, start, end = F.col("last_tx"), F.col("window.start"), F.col("window.end")
    alert_ts = end + _interval(watermark) if watermark else end
    return hits.select(
        alert_key(F.col("rule"), F.col("user_id"), iso(start), iso(end)).alias("alert_id"),
        last["transaction_id"].alias("transaction_id"), "user_id",
        iso(last[TS]).alias("event_time"), iso(alert_ts).alias("alert_time"), "rule",
        F.when(is_r2, SEVERITY[RULE_VELOCITY]).otherwise(SEVERITY[RULE_GEO_HOP]).alias("severity"),
        *[last[c].alias(c) for c in ("amount", "currency", "amount_eur", "location", "country")],
        null_double().alias("p_fraud"),
        F.when(is_r2, velocity_detail()).otherwise(geo_hop_detail()).alias("detail"),
        last[LABEL].alias(LABEL), start.alias("window_start"))


def approx_distinct(df: DataFrame, keys: list[str], col: str, rsd: float = 0.05,
                    alias: str = "approx_distinct") -> DataFrame:
    """Approximate distinct count per key (HyperLogLog++), for high-cardinality
    measures; never used for a rule threshold."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(col, rsd).alias(alias))


def alert_projection(alerts: DataFrame) -> DataFrame:
    """Exactly the 15 alert columns, in wire order."""
    return alerts.select(*ALERT_COLUMNS)
