"""Fixed values and schemas shared by every module.

Everything a rule, a feature or a sink needs to agree on lives here, so that a
threshold or a column name is written down exactly once.
"""
from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values (must equal the reference's for identical results) --------
# Label column: ground truth, carried through, never a feature.
LABEL = "is_fraud"

# Currency and payment-method domains, in index order (index = model feature).
CURRENCIES = ("EUR", "USD", "GBP")
METHODS = ("credit_card", "debit_card", "paypal", "crypto")

# Plausible amount range of ordinary traffic (labelled rows may exceed it).
AMOUNT_MIN, AMOUNT_MAX = 5.0, 5000.0

# Fixed conversion rates to EUR.
FX_TO_EUR = {"EUR": 1.0, "USD": 0.92, "GBP": 1.17}

# Rule names and their severities.
RULE_HIGH_VALUE = "high_value"
RULE_VELOCITY = "velocity"
RULE_GEO_HOP = "geo_hop"
RULE_ML_SCORE = "ml_score"
RULES = (RULE_HIGH_VALUE, RULE_VELOCITY, RULE_GEO_HOP, RULE_ML_SCORE)
SEVERITY = {RULE_HIGH_VALUE: "medium", RULE_VELOCITY: "high",
            RULE_GEO_HOP: "critical", RULE_ML_SCORE: "high"}
SEVERITIES = ("medium", "high", "critical")

# Rule thresholds and windows.
HIGH_VALUE_EUR = 1000.0              # R1 fires on amount_eur > this (strict)
VELOCITY_WINDOW = "1 minute"         # R2 tumbling window
VELOCITY_MIN_COUNT = 4               # R2 fires on count >= this
GEO_WINDOW = "5 minutes"             # R3 tumbling window
GEO_MIN_COUNTRIES = 2                # R3 fires on distinct countries >= this
WATERMARK = "5 minutes"              # allowed lateness for R2 / R3

# Repeat suppression time-to-live, seconds.
SUPPRESS_TTL_SECONDS = 600

# Model features, in frozen order.
FEATURE_ORDER = ("amount_eur", "log_amount", "hour", "dayofweek", "is_night",
                 "method_id", "currency_id", "amount_z", "is_new_user")

# Column-name fragments that betray a label (case-insensitive).
LABEL_FRAGMENTS = ("fraud", "label", "target")

# Message gate: reject rate strictly above this fails.
MAX_REJECT_RATE = 0.01

# Ids and time stamps as produced upstream.
USER_ID_PATTERN = r"^u\d{4}$"
TRANSACTION_ID_PATTERN = r"^t-\d{7,}$"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
CLOCK_FORMAT = "HH:mm:ss"

# Default number of newest alerts to show.
LATEST_DEFAULT = 200

# Alert-rate window and starvation threshold, seconds.
RATE_WINDOW_SECONDS = 60
STARVATION_SECONDS = 60

# Micro-batch trigger of the streaming alert queries.
TRIGGER_INTERVAL = "5 seconds"

# Kafka topics.
TOPIC_TRANSACTIONS = "transactions"
TOPIC_ALERTS = "fraud-alerts"

# City -> ISO-2 country.
CITY_COUNTRY = {
    "Paris": "FR", "Lyon": "FR", "Marseille": "FR",
    "London": "GB", "Manchester": "GB",
    "Berlin": "DE", "Munich": "DE", "Hamburg": "DE",
    "Madrid": "ES", "Barcelona": "ES",
    "Rome": "IT", "Milan": "IT",
    "Amsterdam": "NL", "Rotterdam": "NL",
    "Brussels": "BE",
    "Zurich": "CH", "Geneva": "CH",
    "Vienna": "AT",
    "Lisbon": "PT", "Porto": "PT",
    "Dublin": "IE",
    "Warsaw": "PL", "Krakow": "PL",
    "Prague": "CZ",
    "Budapest": "HU",
    "Stockholm": "SE",
    "Oslo": "NO",
    "Copenhagen": "DK",
    "Helsinki": "FI",
    "Athens": "GR",
    "New York": "US", "Los Angeles": "US", "Chicago": "US",
    "Toronto": "CA", "Vancouver": "CA",
    "Mexico City": "MX",
    "Sao Paulo": "BR",
    "Tokyo": "JP",
    "Singapore": "SG",
    "Sydney": "AU",
    "Dubai": "AE",
}
# --- end of fixed values -----------------------------------------------------

# Inside the engine the event-time column is called `ts` (a nested field named
# `timestamp` does not resolve once a watermark is set); the wire name is kept
# for JSON messages.
TS = "ts"

# Wire schema of one transaction message (JSON).
TRANSACTION_WIRE_SCHEMA = StructType([
    StructField("user_id", StringType()),
    StructField("transaction_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("location", StringType()),
    StructField("method", StringType()),
    StructField(LABEL, IntegerType()),
])
REQUIRED_KEYS = tuple(TRANSACTION_WIRE_SCHEMA.fieldNames())

# Engine schema of a transaction (wire schema with `ts`).
TRANSACTION_SCHEMA = StructType([
    StructField("user_id", StringType()),
    StructField("transaction_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField(TS, TimestampType()),
    StructField("location", StringType()),
    StructField("method", StringType()),
    StructField(LABEL, IntegerType()),
])

# Alert wire shape: 15 columns, in this order.
ALERT_SCHEMA = StructType([
    StructField("alert_id", StringType(), False),
    StructField("transaction_id", StringType()),
    StructField("user_id", StringType()),
    StructField("event_time", StringType()),
    StructField("alert_time", StringType()),
    StructField("rule", StringType(), False),
    StructField("severity", StringType(), False),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("amount_eur", DoubleType()),
    StructField("location", StringType()),
    StructField("country", StringType()),
    StructField("p_fraud", DoubleType()),
    StructField("detail", StringType()),
    StructField(LABEL, IntegerType()),
])
ALERT_COLUMNS = tuple(ALERT_SCHEMA.fieldNames())

# User profile table.
PROFILE_SCHEMA = StructType([
    StructField("user_id", StringType()),
    StructField("amt_mean", DoubleType()),
    StructField("amt_std", DoubleType()),
    StructField("tx_count", LongType()),
])

# Stream progress records (one per query and poll).
PROGRESS_SCHEMA = StructType([
    StructField("query", StringType()),
    StructField("batch", LongType()),
    StructField("at", TimestampType()),
    StructField("num_input_rows", LongType()),
    StructField("rows_dropped", LongType()),
    StructField("watermark", TimestampType()),
])
