"""Ids of any length, alert keys that cannot meet, amounts that cannot end a stream."""
import math

from helpers import frame, row, seconds, T0
from pyspark.sql import functions as F

from tripwire.operators.analytics import latest_alerts, unique_alerts
from tripwire.operators.enrich import enrich
from tripwire.operators.rules import high_value_rule, velocity_rule
from tripwire.sources.tables import transactions_from_events


def test_long_event_ids_stay_apart(spark):
    ids = [5, 1234567, 12345670, 12345671, 12345679]
    events = spark.createDataFrame([(i, T0, 1, "error", 500.0, '{"k": 0}') for i in ids],
                                   "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    tx = transactions_from_events(events)
    assert {r.transaction_id for r in tx.collect()} == {"t-0000005", "t-1234567", "t-12345670", "t-12345671", "t-12345679"}
    assert unique_alerts(high_value_rule(enrich(tx))).count() == len(ids)


def test_missing_ids_and_widths_do_not_share_a_key(spark):
    rows = [row(transaction_id=None, amount=2000.0), row(transaction_id=None, amount=3000.0)]
    assert unique_alerts(high_value_rule(enrich(frame(spark, rows)))).count() == 2
    tx = enrich(frame(spark, [row(transaction_id=f"t-{k}", ts=T0 + seconds(10 * k)) for k in range(4)]))
    minute, hour = (velocity_rule(tx, width=w) for w in ("1 minute", "1 hour"))
    assert unique_alerts(minute.select("alert_id", "alert_time").union(hour.select("alert_id", "alert_time"))).count() == 2


def test_the_earliest_of_repeated_alerts_stays(spark):
    df = spark.createDataFrame([("a", "2", 1), ("a", "1", 2), ("b", "3", 3)], "alert_id string, alert_time string, n int")
    assert {tuple(r) for r in unique_alerts(df.repartition(3)).collect()} == {("a", "1", 2), ("b", "3", 3)}


def test_amounts(spark):
    rows = [row(transaction_id=str(k), amount=a, currency=c) for k, (a, c) in enumerate(
        [(1e17, "EUR"), (1e30, "EUR"), (math.nan, "EUR"), (1086.9645, "USD"), (None, "EUR")])]
    got = {r.transaction_id: r.amount_eur for r in enrich(frame(spark, rows)).collect()}
    assert got == {"0": 1e17, "1": None, "2": None, "3": 1000.01, "4": None}


def test_latest_alerts_returns_what_is_asked(spark):
    df = spark.range(1200).select(F.col("id").cast("string").alias("alert_id"), F.lit("t").alias("alert_time"))
    assert latest_alerts(df, 1000).count() == 1000
