"""The alert job as a program, its options, its saved artifacts and its starvation warning."""
import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler

from conftest import ROOT
from test_streaming import tx, write_json
from tripwire.config import FEATURE_ORDER
from tripwire.job import options, sinks_of
from tripwire.operators.model import load_artifacts, save_artifacts
from tripwire.streaming.progress import StarvationWarning


def test_job_runs_from_another_folder(spark, scratch):
    """Early mode runs Python on the workers: they must find the package too."""
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    write_json(src, [tx(k, f"2026-01-01T10:00:0{k}Z", amount=2000.0 if k == 0 else 42.0) for k in range(5)])
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); from tripwire.job import main; "
            f"main(['--folder', {src!r}, '--alerts', {out!r}, '--checkpoint', {scratch + '/ckpt'!r}, "
            f"'--mode', 'early', '--once'])")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, "-c", code], cwd=scratch, env=env, timeout=300, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert {r["rule"] for r in spark.read.parquet(out).collect()} == {"high_value", "velocity"}


def test_options(monkeypatch):
    with pytest.raises(SystemExit):
        options(["--checkpoint", "c"])
    with pytest.raises(SystemExit):
        options(["--folder", "f"])
    monkeypatch.setenv("TRIPWIRE_BROKERS", "b:9092")
    got = options(["--checkpoint", "c", "--alert-topic", "a", "--alerts", "p"])
    assert (got.brokers, got.topic, got.mode) == ("b:9092", "transactions", "final")
    assert [s.name for s in sinks_of(got)] == ["parquet", "kafka"]
    assert [s.name for s in sinks_of(options(["--checkpoint", "c"]))] == ["console"]


def test_artifacts_round_trip(spark, scratch):
    rows = spark.createDataFrame([tuple(float(k * i % 7) for i in range(1, 10)) + (k % 2,) for k in range(20)],
                                 [*FEATURE_ORDER, "is_fraud"])
    model = Pipeline(stages=[VectorAssembler(inputCols=list(FEATURE_ORDER), outputCol="features"),
                             GBTClassifier(labelCol="is_fraud", maxIter=1)]).fit(rows)
    profiles = spark.createDataFrame([("u1", 5.0, 1.0, 3)], "user_id string, amt_mean double, amt_std double, tx_count long")
    save_artifacts(model, profiles, 0.65, scratch + "/a")
    again, table, tau = load_artifacts(spark, scratch + "/a")
    assert tau == 0.65 and table.collect() == profiles.collect()
    assert again.transform(rows).select("prediction").collect() == model.transform(rows).select("prediction").collect()


def test_starvation_warns_once_an_episode():
    clock, said = [0.0], []
    watch = StarvationWarning(limit=60, warn=said.append, now=lambda: clock[0])
    run = SimpleNamespace(runId="r1")
    watch.onQueryStarted(run)
    for at, rows in ((30, 0), (59, 0), (61, 0), (90, 0), (95, 5), (150, 0), (156, 0)):
        clock[0] = at
        if rows:
            watch.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(runId="r1", numInputRows=rows)))
        else:
            watch.onQueryIdle(run)
    assert len(said) == 2 and "61 s" in said[0] and "61 s" in said[1]
    watch.onQueryTerminated(run)
    watch.onQueryIdle(run)
    assert len(said) == 2


def test_settings_come_from_options_and_environment(monkeypatch):
    from tripwire.job import settings_of
    monkeypatch.setenv("TRIPWIRE_VELOCITY_MIN", "7")
    got = settings_of(options(["--folder", "f", "--checkpoint", "c", "--watermark", "2 minutes", "--geo-window", "10 minutes",
                               "--high-value", "250", "--trigger-seconds", "1.5"]))
    assert (got.velocity_min, got.watermark, got.geo_window, got.high_value) == (7, "2 minutes", "10 minutes", 250.0)
    assert got.trigger == {"processingTime": "1500 milliseconds"}
    assert settings_of(options(["--folder", "f", "--checkpoint", "c", "--once"])).trigger == {"availableNow": True}


def test_job_keeps_bad_messages_and_its_progress(spark, scratch):
    import json

    from tripwire.job import start
    from tripwire.streaming.progress import read_progress, record_progress
    src = os.path.join(scratch, "in")
    write_json(src, [tx(k, f"2026-01-01T10:00:0{k}Z", amount=300.0 * k) for k in range(4)])
    with open(os.path.join(src, "bad.json"), "w") as f:
        broken = dict(tx(9, "2026-01-01T10:00:09Z"))
        broken.pop("currency")
        f.write("{not json\n" + json.dumps(broken) + "\n")
    got = options(["--folder", src, "--checkpoint", scratch + "/ckpt", "--alerts", scratch + "/out", "--quarantine", scratch + "/bad",
                   "--high-value", "500", "--once"])
    log = record_progress(spark, scratch + "/progress", held=2)
    try:
        queries = start(spark, got)
        for q in queries:
            q.awaitTermination(180)
        log.wait(queries)
    finally:
        spark.streams.removeListener(log)
    bad = {r.value[:9]: r.reason for r in spark.read.parquet(scratch + "/bad").collect()}
    assert sorted(bad.values()) == ["missing:currency", "not_json_object"] and bad["{not json"] == "not_json_object"
    alerts = [r for r in spark.read.parquet(scratch + "/out").collect() if r.rule == "high_value"]
    assert sorted(r.amount for r in alerts) == [600.0, 900.0]
    progress = {r["query"]: r["num_input_rows"] for r in read_progress(spark, scratch + "/progress").groupBy("query")
                .agg({"num_input_rows": "sum"}).withColumnRenamed("sum(num_input_rows)", "num_input_rows").collect()}
    assert progress["quarantine"] == 6 and progress["alerts_row"] == 6
