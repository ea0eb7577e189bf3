"""Property tests: R2 / R3 on random small inputs against a direct Python
computation of the same tumbling windows."""
from collections import defaultdict
from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import frame, row
from tripwire.config import CITY_COUNTRY
from tripwire.operators.enrich import enrich
from tripwire.operators.rules import geo_hop_rule, velocity_rule

BASE = datetime(2026, 1, 1, 10, 0, 0)
EPOCH = datetime(1970, 1, 1)
CITIES = ["Paris", "Lyon", "London", "Berlin", "Atlantis"]

records = st.lists(
    st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.integers(0, 900),
              st.sampled_from(CITIES)),
    min_size=1, max_size=40)


def window_of(ts, seconds):
    return (ts - EPOCH) // timedelta(seconds=seconds)


def brute(recs, seconds, measure, threshold):
    groups = defaultdict(list)
    for i, (user, off, city) in enumerate(recs):
        ts = BASE + timedelta(seconds=off)
        groups[(user, window_of(ts, seconds))].append((ts, f"t-{i:07d}", city))
    out = {}
    for (user, w), rows in groups.items():
        value = measure(rows)
        if value >= threshold:
            latest = max(rows, key=lambda r: (r[0], r[1]))
            start = EPOCH + timedelta(seconds=w * seconds)
            out[(user, start)] = (value, latest[1])
    return out


def spark_out(df):
    return {(r["user_id"], r["window_start"].replace(tzinfo=None) if r["window_start"].tzinfo is None
             else r["window_start"].astimezone(timezone.utc).replace(tzinfo=None)):
            (int(r["detail"].split()[0]), r["transaction_id"]) for r in df.collect()}


def to_frame(spark, recs):
    return enrich(frame(spark, [row(user_id=u, transaction_id=f"t-{i:07d}",
                                    ts=BASE + timedelta(seconds=off), location=c)
                                for i, (u, off, c) in enumerate(recs)]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_velocity_matches_brute_force(spark, recs):
    got = spark_out(velocity_rule(to_frame(spark, recs), width="1 minute", min_count=2))
    assert got == brute(recs, 60, len, 2)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_geo_hop_matches_brute_force(spark, recs):
    def countries(rows):
        return len({CITY_COUNTRY[c] for _, _, c in rows if c in CITY_COUNTRY})
    got = spark_out(geo_hop_rule(to_frame(spark, recs), width="5 minutes", min_countries=2))
    assert got == brute(recs, 300, countries, 2)
