"""Streaming sources and message parsing.

Messages arrive as JSON text in a `value` column (Kafka) or as JSON lines in a
folder (replays and tests). Parsing is split from reading so the same parse
works on any frame with a `value` column, batch or stream.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.config import TRANSACTION_SCHEMA, TRANSACTION_WIRE_SCHEMA, TS


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str,
                   starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as a stream of `value` strings (needs the Kafka connector
    on the classpath; not bundled here)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def json_line_messages(spark: SparkSession, folder: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream of raw `value` strings."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def parse_transactions(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> typed transaction columns (engine schema, `ts`).

    Permissive: a message that is not JSON becomes a row of NULLs, which fails
    every rule filter and never stops the query. Times are read as Spark casts
    text to a timestamp: with `Z`, an offset or no zone (session zone, UTC), with `T`
    or a space. A time that cannot be read is NULL and counts as `missing_timestamp`
    in `contract.quality_checks`."""
    data = F.from_json(F.col(value_col), TRANSACTION_WIRE_SCHEMA)
    parsed = messages.select(data.alias("m")).select("m.*")
    return parsed.withColumnRenamed("timestamp", TS).select(
        *TRANSACTION_SCHEMA.fieldNames())


def transaction_file_stream(spark: SparkSession, folder: str, fmt: str = "json",
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """Transactions from a folder, one file per micro-batch at most when
    `max_files_per_trigger=1`. JSON lines are parsed permissively; parquet
    files must already hold the engine schema."""
    if fmt == "json":
        return parse_transactions(json_line_messages(spark, folder, max_files_per_trigger))
    reader = spark.readStream.format(fmt).schema(TRANSACTION_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def to_messages(tx: DataFrame) -> DataFrame:
    """Transaction rows -> JSON messages with the wire field names (the
    producer's payload), keyed by user."""
    fields = [F.col(c) if c != TS else F.date_format(TS, "yyyy-MM-dd'T'HH:mm:ss'Z'")
              .alias("timestamp") for c in TRANSACTION_SCHEMA.fieldNames()]
    return tx.select(F.col("user_id").alias("key"),
                     F.to_json(F.struct(*fields)).alias("value"))
