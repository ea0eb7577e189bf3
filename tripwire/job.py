"""The alert job as a program.

    python -m tripwire.job --folder IN --checkpoint SHARED/ckpt --alerts OUT --once
    python -m tripwire.job --brokers HOST:9092 --checkpoint SHARED/ckpt --alert-topic fraud-alerts

Options may also come from the environment (TRIPWIRE_BROKERS, TRIPWIRE_TOPIC, ...); an
option given on the command line wins.
"""
from __future__ import annotations

import argparse
import os
import shutil
import tempfile
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripwire.config import (
    GEO_MIN_COUNTRIES,
    GEO_WINDOW,
    HIGH_VALUE_EUR,
    TOPIC_TRANSACTIONS,
    VELOCITY_MIN_COUNT,
    VELOCITY_WINDOW,
    WATERMARK,
)
from tripwire.operators.contract import split_messages
from tripwire.operators.model import load_artifacts, model_scorer
from tripwire.session import build_session
from tripwire.sources.streams import json_line_messages, kafka_messages, parse_transactions
from tripwire.streaming.jobs import JobSettings, start_alert_queries
from tripwire.streaming.progress import StarvationWarning, record_progress
from tripwire.streaming.sinks import AlertSink, ConsoleSink, KafkaSink, ParquetSink


def options(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripwire-alerts", description="Transactions in, alerts out.")

    def add(name: str, default: str | None = None, **more) -> None:
        variable = "TRIPWIRE_" + name.upper().replace("-", "_")
        parser.add_argument(f"--{name}", default=os.environ.get(variable, default), **more)

    add("brokers", help="Kafka brokers of source and alert topic")
    add("topic", TOPIC_TRANSACTIONS, help="topic of transactions")
    add("folder", help="folder of JSON-lines files, instead of a topic")
    add("checkpoint", help="shared folder for checkpoints")
    add("alerts", help="folder of the parquet sink")
    add("alert-topic", help="topic of the Kafka sink")
    add("artifacts", help="folder of saved model, profiles and threshold (turns on ml_score)")
    add("mode", "final", choices=("final", "early"))
    add("quarantine", help="folder of the messages that break the contract, with their reasons")
    add("progress", help="folder of the progress log (read it with streaming.progress.read_progress)")
    add("starting-offsets", "latest", help="where a new Kafka query begins")
    add("max-offsets", type=int, help="most Kafka messages of a micro-batch")
    add("trigger-seconds", type=float, help="time between micro-batches")
    add("watermark", WATERMARK, help="delay after which a row is too late for its window")
    add("high-value", HIGH_VALUE_EUR, type=float, help="EUR above which a transaction is of high value")
    add("velocity-window", VELOCITY_WINDOW)
    add("velocity-min", VELOCITY_MIN_COUNT, type=int)
    add("geo-window", GEO_WINDOW)
    add("geo-min", GEO_MIN_COUNTRIES, type=int)
    add("tau", type=float, help="score above which ml_score fires, instead of the saved threshold")
    parser.add_argument("--console", action="store_true", help="also print alerts")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    got = parser.parse_args(argv)
    if not (got.folder or got.brokers):
        parser.error("name a --folder or --brokers to read from")
    if not got.checkpoint:
        parser.error("--checkpoint is missing")
    if got.alert_topic and not got.brokers:
        parser.error("--alert-topic needs --brokers")
    return got


def sinks_of(got: argparse.Namespace) -> list[AlertSink]:
    """Every sink that the options name; the console if they name none."""
    sinks: list[AlertSink] = []
    if got.alerts:
        sinks.append(ParquetSink(got.alerts))
    if got.alert_topic:
        sinks.append(KafkaSink(got.brokers, got.alert_topic))
    if got.console or not sinks:
        sinks.append(ConsoleSink())
    return sinks


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever the job was started from."""
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tripwire-ship-"), "tripwire"), "zip",
                                  os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)


def settings_of(got: argparse.Namespace) -> JobSettings:
    more = {}
    if got.once:
        more["trigger"] = {"availableNow": True}
    elif got.trigger_seconds is not None:
        more["trigger"] = {"processingTime": f"{int(got.trigger_seconds * 1000)} milliseconds"}
    return JobSettings(got.checkpoint, got.mode, watermark=got.watermark, high_value=got.high_value,
                       velocity_window=got.velocity_window, velocity_min=got.velocity_min,
                       geo_window=got.geo_window, geo_min=got.geo_min, **more)


def start(spark: SparkSession, got: argparse.Namespace) -> list[StreamingQuery]:
    """Start every query that the options ask for: the three alert queries and, with a quarantine
    folder, one that keeps the messages which break the contract."""
    settings = settings_of(got)
    messages = (json_line_messages(spark, got.folder) if got.folder
                else kafka_messages(spark, got.brokers, got.topic, got.starting_offsets, got.max_offsets))
    queries = []
    if got.quarantine:
        transactions, bad = split_messages(messages)
        writer = (bad.withColumn("kept_at", F.current_timestamp()).writeStream.format("parquet").outputMode("append")
                  .queryName("quarantine").option("path", got.quarantine)
                  .option("checkpointLocation", settings.checkpoint("quarantine")))
        queries.append((writer.trigger(**settings.trigger) if settings.trigger else writer).start())
    else:
        transactions = parse_transactions(messages)
    scorer = tau = None
    if got.artifacts:
        model, profiles, tau = load_artifacts(spark, got.artifacts)
        scorer, tau = model_scorer(model, profiles), tau if got.tau is None else got.tau
    return queries + list(start_alert_queries(transactions, settings, sinks_of(got), scorer=scorer, tau=tau).values())


def main(argv: Sequence[str] | None = None) -> None:
    got = options(argv)
    spark = build_session("tripwire-alerts")
    ship_package(spark)
    spark.streams.addListener(StarvationWarning())
    log = record_progress(spark, got.progress) if got.progress else None
    queries = start(spark, got)
    if got.once:
        for query in queries:
            query.awaitTermination()
        if log:
            log.wait(queries)
            log.flush()
        spark.stop()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
