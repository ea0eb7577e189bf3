"""Analytics and sequence operators against hand cases and brute force."""
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import T0, frame, row, seconds
from tripwire.config import PROGRESS_SCHEMA
from tripwire.operators.analytics import (
    alert_rate,
    confusion_by_tau,
    counts_by_rule_and_severity,
    latency_p95,
    latest_alerts,
    silent_rules,
    starvation_episodes,
)
from tripwire.operators.enrich import enrich
from tripwire.operators.model import average_precision, pick_tau, threshold_curve
from tripwire.operators.sequences import label_runs, suppress_repeats

P0 = datetime(2026, 1, 1, 12, 0, 0)


def progress(spark, counts, query="q", step=10):
    rows = [(query, i, P0 + timedelta(seconds=step * i), n, 0, None) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def test_starvation_one_episode(spark):
    out = starvation_episodes(progress(spark, [5] + [0] * 7)).collect()
    assert len(out) == 1 and out[0]["idle_seconds"] == 60.0


def test_starvation_recovers_and_recurs(spark):
    out = starvation_episodes(progress(spark, [5] + [0] * 7 + [5] + [0] * 7)).collect()
    assert len(out) == 2


def test_starvation_below_threshold(spark):
    assert starvation_episodes(progress(spark, [5] + [0] * 5)).collect() == []


def test_starvation_from_first_poll(spark):
    out = starvation_episodes(progress(spark, [0] * 7)).collect()
    assert len(out) == 1 and out[0]["idle_since"] == "2026-01-01T12:00:00Z"


def test_starvation_over_chunks_and_queries_is_the_same(spark):
    """Chunks shorter and longer than a stretch, several queries, polls at one time."""
    import random
    rng = random.Random(4)
    frames = [progress(spark, [rng.choice([0, 0, 0, 0, 0, 0, 0, 3]) for _ in range(120)], q, step) for q, step in (("a", 10), ("b", 7))]
    both = frames[0].union(frames[1]).union(frames[1].limit(5))
    want = set()
    for query in ("a", "b"):
        rows = sorted((r["at"], r["num_input_rows"]) for r in both.collect() if r["query"] == query)
        since, told = rows[0][0], None
        for at, n in rows:
            if n:
                since = at
            elif (at - since).total_seconds() >= 60 and told != since:
                told = since
                want.add((query, iso(at), iso(since), (at - since).total_seconds()))
    for chunk in ("30 seconds", "2 minutes", "1 day"):
        got = starvation_episodes(both, chunk=chunk).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert len(want) > 4


def alerts_frame(spark, rows):
    cols = ("alert_id string, transaction_id string, user_id string, event_time string, "
            "alert_time string, rule string, severity string, amount double, currency string, "
            "amount_eur double, location string, country string, p_fraud double, detail string, "
            "is_fraud int")
    return spark.createDataFrame(rows, cols)


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def make_alerts(spark, n=300, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ev = T0 + timedelta(seconds=rnd.randint(0, 3600))
        al = ev + timedelta(seconds=rnd.choice([0, 0, 1, 2, 5, 30, 400]))
        rule = rnd.choice(["high_value", "velocity", "geo_hop"])
        sev = {"high_value": "medium", "velocity": "high", "geo_hop": "critical"}[rule]
        p = rnd.random() if rnd.random() < 0.7 else None
        rows.append((f"a{i:04d}", f"t{i}", f"u{rnd.randint(1, 20)}", iso(ev), iso(al), rule, sev,
                     1.0, "EUR", 1.0, "Paris", "FR", p, "d", rnd.randint(0, 1)))
    return rows


def test_latency_p95_matches_sorted_list(spark):
    rows = make_alerts(spark)
    deltas = sorted((datetime.strptime(r[4], "%Y-%m-%dT%H:%M:%SZ")
                     - datetime.strptime(r[3], "%Y-%m-%dT%H:%M:%SZ")).total_seconds() for r in rows)
    want = deltas[int(0.95 * (len(deltas) - 1))]
    got = latency_p95(alerts_frame(spark, rows)).first()
    assert got["n"] == len(rows) and got["p95_seconds"] == want


def test_alert_rate_and_latest(spark):
    rows = make_alerts(spark)
    df = alerts_frame(spark, rows)
    times = [datetime.strptime(r[4], "%Y-%m-%dT%H:%M:%SZ") for r in rows]
    newest = max(times)
    want = sum(1 for t in times if (newest - t).total_seconds() <= 60)
    got = alert_rate(df).first()
    assert got["alerts_in_window"] == want and got["newest_alert_time"] == iso(newest)
    top = [r["alert_id"] for r in latest_alerts(df, 10).collect()]
    assert top == [r[0] for r in sorted(rows, key=lambda r: (r[4], r[0]), reverse=True)[:10]]
    assert len(latest_alerts(df, 10_000).collect()) == 300  # capped at 500, only 300 exist


def test_counts_include_zeros_and_silent_rules(spark):
    df = alerts_frame(spark, make_alerts(spark))
    got = {(r["dimension"], r["value"]): r["n"] for r in counts_by_rule_and_severity(df).collect()}
    assert got[("rule", "ml_score")] == 0 and len(got) == 7
    assert sum(v for (d, _), v in got.items() if d == "rule") == 300
    assert [r["rule"] for r in silent_rules(df).collect()] == ["ml_score"]


def test_confusion_by_tau_brute_force(spark):
    rows = make_alerts(spark)
    taus = [0.2, 0.5, 0.8]
    got = {r["tau"]: r for r in confusion_by_tau(alerts_frame(spark, rows), taus).collect()}
    for tau in taus:
        scored = [(r[12], r[14]) for r in rows if r[12] is not None]
        tp = sum(1 for p, y in scored if p >= tau and y == 1)
        fp = sum(1 for p, y in scored if p >= tau and y == 0)
        fn = sum(1 for p, y in scored if p < tau and y == 1)
        assert (got[tau]["tp"], got[tau]["fp"], got[tau]["fn"]) == (tp, fp, fn)
        assert got[tau]["precision"] == pytest.approx(tp / (tp + fp))


def test_tau_and_average_precision_brute_force(spark):
    rnd = np.random.default_rng(3)
    y = rnd.integers(0, 2, 400)
    p = np.round(np.clip(y * 0.3 + rnd.random(400) * 0.7, 0, 1), 4)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p_fraud double, is_fraud int")
    curve = threshold_curve(df)
    # brute force over distinct thresholds, descending
    best, ap, prev_r = None, 0.0, 0.0
    for t in sorted(set(p.tolist()), reverse=True):
        tp = int(((p >= t) & (y == 1)).sum()); fp = int(((p >= t) & (y == 0)).sum())
        prec, rec = tp / (tp + fp), tp / int(y.sum())
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        ap += (rec - prev_r) * prec
        prev_r = rec
        if best is None or f1 >= best[1]:
            best = (t, f1)
    got = pick_tau(curve).first()
    assert got["tau"] == pytest.approx(best[0]) and got["f1"] == pytest.approx(best[1])
    assert average_precision(curve).first()[0] == pytest.approx(ap)


def test_suppress_repeats_ttl(spark):
    rows = [("k", T0), ("k", T0 + seconds(300)), ("k", T0 + seconds(601)),
            ("k", T0 + seconds(900)), ("k", T0 + seconds(1300)), ("j", T0)]
    df = spark.createDataFrame(rows, "key string, ts timestamp")
    kept = sorted((r["key"], r["ts"]) for r in suppress_repeats(df, ["key"], ttl_seconds=600).collect())
    assert kept == [("j", T0), ("k", T0), ("k", T0 + seconds(601)), ("k", T0 + seconds(1300))]


def test_label_runs_brute_force(spark):
    rnd = random.Random(5)
    rows, t = [], T0
    for i in range(400):
        t = t + seconds(rnd.choice([0, 1, 30, 2000]))
        u = rnd.choice(["u1", "u2", "u3"])
        rows.append(row(user_id=u, transaction_id=f"t-{i:07d}", ts=t,
                        location=rnd.choice(["Paris", "London", "Atlantis"]),
                        is_fraud=1 if rnd.random() < 0.5 else 0))
    got = sorted((r["user_id"], r["first_transaction_id"], r["run_length"], r["n_countries"])
                 for r in label_runs(enrich(frame(spark, rows))).collect())
    want = []
    country = {"Paris": "FR", "London": "GB"}
    for u in ("u1", "u2", "u3"):
        mine = sorted((r for r in rows if r[0] == u), key=lambda r: (r[4], r[1]))
        run = []
        for r in mine + [None]:
            if r is not None and r[7] == 1:
                run.append(r)
                continue
            if run:
                want.append((u, run[0][1], len(run),
                             len({country[x[5]] for x in run if x[5] in country})))
            run = []
    assert got == sorted(want)


@pytest.mark.parametrize("chunk", ["5 minutes", "1 hour"])
def test_suppress_repeats_brute_force(spark, chunk):
    rnd = random.Random(11)
    rows, t = [], T0
    for i in range(600):
        t = t + seconds(rnd.choice([0, 5, 60, 200, 650, 3000]))
        rows.append((rnd.choice(["a", "b", "c"]), t, f"id{i:04d}"))
    df = spark.createDataFrame(rows, "key string, ts timestamp, id string")
    got = sorted((r["key"], r["id"]) for r in
                 suppress_repeats(df, ["key"], ttl_seconds=600, order_cols=("id",), chunk=chunk).collect())
    want = []
    for k in ("a", "b", "c"):
        last = None
        for key, ts, ident in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            if last is None or (ts - last).total_seconds() >= 600:
                want.append((key, ident))
                last = ts
    assert got == sorted(want)


def test_suppress_repeats_null_keys_empty_input_and_clashing_names(spark):
    rows = [(None, T0, 1), (None, T0 + seconds(599), 2), (None, T0 + seconds(600), 3), ("a", T0, 4),
            ("a", None, 5)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, entry int")
    assert sorted(r["entry"] for r in suppress_repeats(df, ["key"], order_cols=("entry",)).collect()) == [1, 3, 4]
    assert suppress_repeats(df.limit(0), ["key"]).collect() == []


def test_suppress_repeats_on_a_stream(spark, scratch):
    from tripwire.operators.sequences import suppress_repeats_stream
    src = f"{scratch}/in"
    schema = "key string, ts timestamp, id int"
    for k, rows in enumerate([[("k", T0, 1), ("k", T0 + seconds(300), 2), ("j", T0, 3)],
                              [("k", T0 + seconds(599), 4), ("k", T0 + seconds(600), 5), ("k", T0 + seconds(601), 6)],
                              [("k", T0 + seconds(1250), 7), ("k", T0 + seconds(1199), 8), ("j", T0 + seconds(700), 9)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (suppress_repeats_stream(stream, ["key"], order_cols=("id",)).writeStream.format("memory").queryName("suppressed")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(180)
    assert sorted(r["id"] for r in spark.table("suppressed").collect()) == [1, 3, 5, 7, 9]
