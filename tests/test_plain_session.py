"""Registered queries on a session that was built elsewhere, with Spark's own defaults."""
import os
from datetime import datetime, timedelta

import __spark_entry__ as entry
from tripwire.session import BASE_CONF

STORE = "spark.sql.streaming.stateStore.providerClass"


def test_suppression_stream_brings_its_state_store(spark, scratch):
    start = datetime(2024, 1, 1)
    # Users 1 and 2 pay 2000 every 40 minutes, user 3 little.
    rows = [(i, start + timedelta(minutes=40 * i), i % 3 + 1, "view", 200.0 if i % 3 < 2 else 1.0, '{"k": 0}') for i in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(os.path.join(scratch, "events.parquet"))
    spark.createDataFrame([(0, "A")], "n_nationkey int, n_name string").write.parquet(os.path.join(scratch, "nation.parquet"))
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        kept = {r.alert_id for r in entry.queries()["stream_suppress_repeats"](spark, scratch).collect()}
        assert kept and kept == {r.alert_id for r in entry.queries()["suppress_repeats"](spark, scratch).collect()}
    finally:
        spark.conf.set(STORE, BASE_CONF[STORE])
