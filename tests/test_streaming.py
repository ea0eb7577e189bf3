"""Streaming: file source, final-mode parity with batch, early emission,
state across batches, restart from checkpoint, late rows, bad JSON."""
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwire.config import TRANSACTION_SCHEMA
from tripwire.operators.enrich import enrich
from tripwire.operators.rules import velocity_rule
from tripwire.sources.streams import transaction_file_stream
from tripwire.sources.tables import load_places, load_transactions
from tripwire.streaming.jobs import JobSettings, alert_streams, start_alert_queries
from tripwire.streaming.sinks import ParquetSink

_n = [0]


def write_json(folder, records):
    """One JSON-lines file = one micro-batch (maxFilesPerTrigger=1)."""
    os.makedirs(folder, exist_ok=True)
    _n[0] += 1
    path = os.path.join(folder, f"part-{_n[0]:05d}.json")
    with open(path, "w") as fh:
        for r in records:
            fh.write(r if isinstance(r, str) else json.dumps(r))
            fh.write("\n")
    # The file source takes files in modification-time order: make it the
    # write order (files written within one clock tick would tie).
    stamp = 1_700_000_000 + _n[0]
    os.utime(path, (stamp, stamp))


def tx(i, ts, user="u1000", amount=42.0, location="Paris", currency="EUR"):
    return {"user_id": user, "transaction_id": f"t-{i:07d}", "amount": amount,
            "currency": currency, "timestamp": ts, "location": location,
            "method": "credit_card", "is_fraud": 0}


def run_job(spark, src, root, mode, **kw):
    stream = transaction_file_stream(spark, src, "json", max_files_per_trigger=1)
    settings = JobSettings(checkpoint_root=os.path.join(root, "ckpt"), mode=mode,
                           trigger={"availableNow": True}, **kw)
    qs = start_alert_queries(stream, settings, [ParquetSink(os.path.join(root, "out"))])
    for q in qs.values():
        q.awaitTermination(120)
    return qs


def alerts(spark, root):
    path = os.path.join(root, "out")
    if not os.path.exists(path):
        return []
    return spark.read.parquet(path).collect()


def test_any_amount_and_any_time_form_keeps_every_query_running(spark, scratch):
    src = os.path.join(scratch, "in")
    forms = ["2026-01-01T10:00:00Z", "2026-01-01T11:00:00.5+01:00", "2026-01-01T10:00:01", "2026-01-01 10:00:02"]
    write_json(src, [tx(k, t, amount=2000.0) for k, t in enumerate(forms)])
    write_json(src, [tx(10, "2026-01-01T10:00:03Z", amount=1e17), tx(11, "2026-01-01T10:00:04Z", amount=1e30),
                     json.dumps(tx(12, "2026-01-01T10:00:05Z", amount=float("nan"))), tx(13, "no time", amount=2000.0),
                     "[1, 2]", "null", ""])
    write_json(src, [tx(20, "2026-01-01T10:30:00Z")])
    qs = run_job(spark, src, scratch, "final")
    assert all(q.exception() is None for q in qs.values())
    found = alerts(spark, scratch)
    assert {r["transaction_id"] for r in found if r["rule"] == "high_value"} == \
        {f"t-{k:07d}" for k in (0, 1, 2, 3, 10, 13)}
    assert [r["detail"] for r in found if r["rule"] == "velocity"] == ["7 transactions in window 10:00:00-10:01:00"]


def test_bad_json_does_not_stop_the_query(spark, scratch):
    src = os.path.join(scratch, "in")
    write_json(src, ["{not valid json at all", tx(1, "2026-01-01T10:00:00Z", amount=2000.0)])
    run_job(spark, src, scratch, "final")
    got = alerts(spark, scratch)
    assert [r["rule"] for r in got] == ["high_value"]


def test_early_emits_once_and_survives_restart(spark, scratch):
    src = os.path.join(scratch, "in")
    write_json(src, [tx(i, f"2026-01-01T10:00:{10 * i:02d}Z") for i in range(4)])
    run_job(spark, src, scratch, "early")
    first = [r for r in alerts(spark, scratch) if r["rule"] == "velocity"]
    assert len(first) == 1 and first[0]["detail"].startswith("4 transactions")
    # A fifth row in the same window, then a restart from the checkpoint.
    write_json(src, [tx(5, "2026-01-01T10:00:50Z")])
    run_job(spark, src, scratch, "early")
    write_json(src, [tx(6, "2026-01-01T10:00:55Z")])
    run_job(spark, src, scratch, "early")
    again = [r for r in alerts(spark, scratch) if r["rule"] == "velocity"]
    assert len(again) == 1


def test_geo_state_across_batches(spark, scratch):
    src = os.path.join(scratch, "in")
    write_json(src, [tx(1, "2026-01-01T10:00:00Z", location="Paris")])
    write_json(src, [tx(2, "2026-01-01T10:01:00Z", location="London")])
    run_job(spark, src, scratch, "early")
    geo = [r for r in alerts(spark, scratch) if r["rule"] == "geo_hop"]
    assert len(geo) == 1 and geo[0]["detail"].endswith(": FR,GB")


def test_final_mode_waits_for_watermark(spark, scratch):
    src = os.path.join(scratch, "in")
    write_json(src, [tx(i, f"2026-01-01T10:00:{10 * i:02d}Z") for i in range(4)])
    run_job(spark, src, scratch, "final")
    assert [r for r in alerts(spark, scratch) if r["rule"] == "velocity"] == []
    # Event time moves 10 minutes on: the window closes and is emitted once.
    write_json(src, [tx(9, "2026-01-01T10:10:00Z", user="u2000")])
    write_json(src, [tx(10, "2026-01-01T10:10:01Z", user="u2000")])
    run_job(spark, src, scratch, "final")
    vel = [r for r in alerts(spark, scratch) if r["rule"] == "velocity"]
    assert len(vel) == 1


def test_late_row_dropped_from_window_rule_but_row_rule_fires(spark, scratch):
    src = os.path.join(scratch, "in")
    write_json(src, [tx(1, "2026-01-01T11:00:00Z", user="u2000")])
    write_json(src, [tx(2, "2026-01-01T11:00:01Z", user="u2000")])
    # Far behind the watermark (10:54:01): a burst and a large amount.
    write_json(src, [tx(10 + i, f"2026-01-01T10:00:{i:02d}Z", amount=3000.0) for i in range(4)])
    write_json(src, [tx(20, "2026-01-01T11:00:02Z", user="u2000")])
    run_job(spark, src, scratch, "early")
    got = alerts(spark, scratch)
    assert [r for r in got if r["rule"] == "velocity"] == []
    assert len([r for r in got if r["rule"] == "high_value"]) == 4


def test_final_stream_equals_batch_over_closed_windows(spark, scratch):
    """Replay sf0.001 transactions in time order, several files, and compare
    with the batch rule over windows closed by the last watermark."""
    txs = load_transactions(spark, SF_SMALL)
    src = os.path.join(scratch, "in_parquet")
    (txs.withColumn("part", F.ntile(6).over(__import__("pyspark.sql").sql.Window.orderBy("ts")))
        .write.partitionBy("part").parquet(os.path.join(scratch, "staged")))
    os.makedirs(src)
    for k in range(1, 7):
        spark.read.parquet(os.path.join(scratch, "staged", f"part={k}")) \
             .select(*TRANSACTION_SCHEMA.fieldNames()).coalesce(1) \
             .write.mode("overwrite").parquet(os.path.join(scratch, "tmp", str(k)))
        for f in sorted(os.listdir(os.path.join(scratch, "tmp", str(k)))):
            if f.endswith(".parquet"):
                os.link(os.path.join(scratch, "tmp", str(k), f), os.path.join(src, f"{k:02d}-{f}"))
    stream = transaction_file_stream(spark, src, "parquet", max_files_per_trigger=1)
    places = load_places(spark, SF_SMALL)
    settings = JobSettings(checkpoint_root=os.path.join(scratch, "ckpt"), mode="final",
                           velocity_window="1 day", velocity_min=4)
    frame = alert_streams(stream, settings, places)["velocity"]
    q = (frame.writeStream.format("memory").queryName("parity_velocity").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckpt_mem"))
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    streamed = {r["alert_id"] for r in spark.sql("SELECT alert_id FROM parity_velocity").collect()}
    batch = velocity_rule(enrich(txs, places), width="1 day", min_count=4, clock_mode="event")
    max_ts = txs.agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_start") + F.expr("INTERVAL 1 DAY")
                          <= F.lit(max_ts) - F.expr("INTERVAL 5 MINUTES"))
    expected = {r["alert_id"] for r in closed.collect()}
    assert len(expected) > 0
    assert streamed == expected


def test_final_mode_restart_loses_and_repeats_nothing(spark, scratch):
    """Stop between batches, restart from the checkpoint: the alerts of the
    two runs together equal one uninterrupted run."""
    txs = load_transactions(spark, SF_SMALL).select(*TRANSACTION_SCHEMA.fieldNames())
    t_us = F.unix_micros("ts")
    cuts = txs.agg(F.percentile_approx(t_us, [0.25, 0.5, 0.75], 1000)).first()[0]
    sliced = txs.withColumn("s", sum((t_us > F.lit(c)).cast("int") for c in cuts))
    places = load_places(spark, SF_SMALL)

    def feed(folder, parts):
        for k in parts:
            sliced.filter(F.col("s") == k).drop("s").coalesce(1).write.mode("append").parquet(folder)

    def run(folder, root, out):
        stream = transaction_file_stream(spark, folder, "parquet", max_files_per_trigger=1)
        settings = JobSettings(checkpoint_root=root, mode="final", velocity_window="1 hour",
                               velocity_min=2, trigger={"availableNow": True})
        qs = start_alert_queries(stream, settings, [ParquetSink(out)], places=places)
        for q in qs.values():
            q.awaitTermination(180)

    a_in, a_out = os.path.join(scratch, "a_in"), os.path.join(scratch, "a_out")
    feed(a_in, [0, 1])
    run(a_in, os.path.join(scratch, "a_ck"), a_out)
    feed(a_in, [2, 3])
    run(a_in, os.path.join(scratch, "a_ck"), a_out)        # restart
    b_in, b_out = os.path.join(scratch, "b_in"), os.path.join(scratch, "b_out")
    feed(b_in, [0, 1, 2, 3])
    run(b_in, os.path.join(scratch, "b_ck"), b_out)        # one run
    restarted = [r["alert_id"] for r in spark.read.parquet(a_out).collect()]
    single = [r["alert_id"] for r in spark.read.parquet(b_out).collect()]
    assert len(restarted) == len(set(restarted))            # nothing repeated
    assert sorted(restarted) == sorted(single) and single   # nothing lost


def test_early_mode_with_uneven_windows_null_ids_and_restart(spark, scratch):
    """Windows of which the delay is no multiple; equal times, null ids and names with commas; the
    job stops between batches. Early mode alerts what final mode does, once, and no late row's window."""
    src = os.path.join(scratch, "in")
    rows = [tx(1, "2026-01-01T10:00:00Z"), tx(2, "2026-01-01T10:00:00Z") | {"transaction_id": None},
            tx(3, "2026-01-01T10:00:00Z") | {"transaction_id": None, "location": "London"}]
    batches = [rows, [tx(4, "2026-01-01T10:06:00Z"), tx(5, "2026-01-01T10:20:00Z", user="u2000")],
               [tx(6, "2026-01-01T10:06:30Z"), tx(7, "2026-01-01T10:20:30Z", user="u2000")],   # late
               [tx(8, "2026-01-01T12:00:00Z", user="u3000")], [tx(9, "2026-01-01T12:00:01Z", user="u3000")],
               [tx(10, "2026-01-01T14:00:00Z", user="u4000")]]                                     # closes all
    found = {}
    for mode in ("final", "early"):
        folder = os.path.join(scratch, mode)
        for k, batch in enumerate(batches):
            write_json(os.path.join(folder, "in"), batch)
            run_job(spark, os.path.join(folder, "in"), folder, mode, velocity_window="7 minutes",
                    velocity_min=2, geo_window="7 minutes")
        got = [(r["rule"], r["user_id"], r["alert_id"]) for r in alerts(spark, folder)]
        assert len(got) == len(set(got))
        found[mode] = set(got)
    assert found["early"] == found["final"]
    assert {(r, u) for r, u, _ in found["early"]} == {("velocity", "u1000"), ("geo_hop", "u1000"),
                                                       ("velocity", "u2000"), ("velocity", "u3000")}


def test_a_retried_batch_fires_the_same_alerts_again(spark, scratch):
    from datetime import datetime
    from tripwire.streaming.early import FirstFiring
    t = datetime(2026, 1, 1, 10)
    first = FirstFiring(os.path.join(scratch, "raised"), "1 minute", "5 minutes")

    def batch(*rows):
        return spark.createDataFrame(list(rows), "alert_id string, window_start timestamp")

    def fire(df, batch_id):
        fresh = first.fresh(df, batch_id)
        got = sorted(r["alert_id"] for r in fresh.collect())
        first.note(fresh, batch_id)
        return got

    assert fire(batch(("a", t)), 0) == ["a"]
    assert fire(batch(("a", t), ("b", t)), 3) == ["b"]
    assert fire(batch(("a", t), ("b", t)), 3) == ["b"]                       # retry
    assert fire(batch(("b", t), ("c", t.replace(hour=11))), 4) == ["c"]
    assert sorted(os.listdir(os.path.join(scratch, "raised"))) == ["batch=3", "batch=4"]
    kept = spark.read.parquet(os.path.join(scratch, "raised", "batch=4")).collect()
    assert [r["alert_id"] for r in kept] == ["c"]                            # closed windows leave
