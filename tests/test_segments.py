"""Operators that cut keys into ranges, chunks and batches: however the cuts fall, the result is that of one pass."""
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwire.operators import selection
from tripwire.operators.sequences import first_at_least, label_runs, places_on_walks, suppress_repeats

T0 = datetime(2026, 1, 1)


@pytest.fixture()
def cut_up(spark):
    """Many partitions that stay apart, and Arrow batches of a few rows."""
    keys = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.execution.arrow.maxRecordsPerBatch": "5"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def runs_of(rows):
    out = []
    for user in sorted({r[0] for r in rows if r[0] is not None}):
        run = []
        for r in [*sorted((r for r in rows if r[0] == user), key=lambda r: (r[2], r[1])), (user, None, None, None, 0)]:
            if r[4] == 1:
                run.append(r)
            elif run:
                out.append((user, run[0][1], len(run), len({x[3] for x in run} - {None}), (run[-1][2] - run[0][2]).total_seconds()))
                run = []
    return sorted(out)


@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.0])
def test_label_runs_over_ranges(spark, cut_up, share):
    """Runs that span whole ranges, meet their ends, or stand at a user's border."""
    rng = random.Random(int(share * 10))
    rows = [(rng.choice(["u1", "u1", "u1", "u2", "u3"]), f"t{k:04d}", T0 + timedelta(seconds=rng.randrange(150)),
             rng.choice([None, "DE", "FR"]), int(rng.random() < share)) for k in range(300)]
    rows += [(None, "t9", T0, "DE", 1)]
    got = label_runs(spark.createDataFrame(rows, "user_id string, transaction_id string, ts timestamp, country string, is_fraud int"))
    assert sorted((r.user_id, r.first_transaction_id, r.run_length, r.n_countries, r.span_seconds) for r in got.collect()) == runs_of(rows)


def kept_of(rows, ttl):
    out, last = [], {}
    for key, t, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if key not in last or (t - last[key]).total_seconds() >= ttl:
            last[key] = t
            out.append(i)
    return sorted(out)


@pytest.mark.parametrize("chunk", ["2 minutes", "1 hour", "1 day"])
def test_suppression_over_chunks_and_batches(spark, cut_up, chunk):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", None]), T0 + timedelta(seconds=rng.randrange(20_000)), k) for k in range(400)]
    frame = spark.createDataFrame(rows, "key string, ts timestamp, id int")
    got = suppress_repeats(frame, ["key"], ttl_seconds=100, order_cols=("id",), chunk=chunk)
    assert sorted(r.id for r in got.collect()) == kept_of(rows, 100)


def test_walks_against_steps():
    rng = np.random.default_rng(2)
    group = np.sort(rng.integers(0, 6, 200))
    t = np.concatenate([np.sort(rng.integers(0, 500, (group == g).sum())) for g in range(6)])
    after = first_at_least(group, t, group, t + 40)
    for i in range(200):
        later = [j for j in range(200) if group[j] == group[i] and t[j] >= t[i] + 40]
        assert after[i] == (min(later) if later else 200)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    on = set()
    for at in starts:
        while at < 200:
            on.add(int(at))
            at = after[at]
    assert set(np.flatnonzero(places_on_walks(after, starts)).tolist()) == on


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_value_at_rank_is_exact(spark, monkeypatch, accuracy):
    """Also when the bracket is wide and its inside is searched in many small steps."""
    monkeypatch.setattr(selection, "SORTED_VALUES", 3)
    monkeypatch.setattr(selection, "BUCKETS", 4)
    rng = random.Random(8)
    values = [rng.choice([rng.randrange(-10 ** 12, 10 ** 12), 7, -3]) for _ in range(900)] + [None] * 20
    frame = spark.createDataFrame([(v,) for v in values], "x long").repartition(5)
    known = sorted(v for v in values if v is not None)
    for q in (0.0, 0.001, 0.31, 0.5, 0.95, 1.0):
        rank = max(1, int(q * len(known)))
        got = selection.value_at_rank(frame, F.col("x"), q, lambda n: max(1, int(q * n)), accuracy)
        assert got == (known[rank - 1], len(known))
    assert selection.value_at_rank(frame, F.col("x"), 0.5, lambda n: 0) == (None, len(known))
    assert selection.value_at_rank(frame.limit(0), F.col("x"), 0.5, lambda n: 1) == (None, 0)


def test_bracket_that_misses_is_opened(spark):
    """A rank far from the named fraction is still found."""
    frame = spark.range(1000).withColumnRenamed("id", "x")
    assert selection.value_at_rank(frame, F.col("x"), 0.1, lambda n: 900) == (899, 1000)
