"""tripwire: suspicious-payment alerts and alert analytics on Spark.

Transactions are parsed and checked against a fixed schema, enriched with a
country and an EUR amount, and checked by row rules and event-time window
rules; alerts go to files or Kafka with restart-safe state, and batch jobs
compute profiles, a model, thresholds and analytics over alerts.
"""

__version__ = "0.1.0"
