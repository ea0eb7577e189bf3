"""Batch sources: parquet tables and the transaction views derived from them.

No driver table holds payments, so transactions are derived from `events`
(and, as a second, larger input, from `orders`). The mapping is part of the
test contract: the DuckDB oracles in `tripwire.plans.oracle` build the same
view in SQL.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.config import CURRENCIES, LABEL, METHODS, TS
from tripwire.functions.columns import literal_map

# Number of location keys: 0..24 are nations, 25..29 are unknown places.
LOCATION_KEYS = 30


_TABLES: dict[tuple, DataFrame] = {}


def files_state(spark: SparkSession, path: str) -> tuple:
    """The files below a path with sizes and times: another state means other data."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(hadoop)))


def data_key(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """What results of this application over some tables may be kept by: it changes when a table is rewritten."""
    paths = [os.path.join(sf_dir, f"{name}.parquet") for name in names]
    return (spark.sparkContext.applicationId, *((p, files_state(spark, p)) for p in paths))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the driver data set. The DataFrame (file listing
    and footer schema) is reused within one application while the files stay the same; DataFrames are
    immutable, so sharing it between queries is safe."""
    key = data_key(spark, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return _TABLES[key]


def _pick(values, n: F.Column) -> F.Column:
    return literal_map(dict(enumerate(values)))[n % len(values)]


def _transaction_id(number: F.Column) -> F.Column:
    """`t-` and the number with at least seven digits (`lpad` alone cuts longer ones)."""
    text = number.cast("string")
    return F.concat(F.lit("t-"), F.when(F.length(text) < 7, F.lpad(text, 7, "0")).otherwise(text))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """`events` -> transaction rows in the engine schema.

    user `u<user_id>`, id `t-` + event id of at least 7 digits, amount `value * 10`,
    currency / method / location chosen by the `k` number in `props`,
    label 1 for `error` events, `ts` cast from TIMESTAMP_NTZ to TIMESTAMP
    (session zone UTC) because watermarks reject NTZ.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        _transaction_id(F.col("event_id")).alias("transaction_id"),
        F.round(F.col("value") * 10, 2).alias("amount"),
        _pick(CURRENCIES, k).alias("currency"),
        F.col("ts").cast("timestamp").alias(TS),
        (k % LOCATION_KEYS).cast("string").alias("location"),
        _pick(METHODS, k).alias("method"),
        (F.col("event_type") == "error").cast("int").alias(LABEL),
    )


def transactions_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """`orders` -> transaction rows: one order is one payment by its customer,
    placed in the customer's nation. Order dates are whole days, so equal
    times are common (exercises tie-breaking)."""
    cust = customer.select(F.col("c_custkey").alias("o_custkey"),
                           F.col("c_nationkey").cast("string").alias("location"))
    o = orders.join(cust, "o_custkey", "left")
    key = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        _transaction_id(key).alias("transaction_id"),
        F.col("o_totalprice").alias("amount"),
        _pick(CURRENCIES, key).alias("currency"),
        F.col("o_orderdate").cast("timestamp").alias(TS),
        F.col("location"),
        _pick(METHODS, key).alias("method"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias(LABEL),
    )


def places_from_nation(nation: DataFrame) -> DataFrame:
    """Location dimension for the derived transactions: key -> nation name."""
    return nation.select(F.col("n_nationkey").cast("string").alias("location"),
                         F.col("n_name").alias("country"))


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(table(spark, sf_dir, "events"))


def load_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places_from_nation(table(spark, sf_dir, "nation"))
