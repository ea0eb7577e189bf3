"""Boundary cases of the four rules (batch)."""
import pytest
from pyspark.sql import functions as F

from helpers import T0, frame, row, seconds
from tripwire.config import ALERT_COLUMNS, RULE_GEO_HOP, RULE_HIGH_VALUE, RULE_ML_SCORE, RULE_VELOCITY
from tripwire.operators.enrich import enrich
from tripwire.operators.rules import (
    alert_projection,
    geo_hop_rule,
    high_value_rule,
    ml_score_rule,
    row_alerts,
    velocity_rule,
)


def hv(spark, rows):
    return high_value_rule(enrich(frame(spark, rows))).collect()


@pytest.mark.parametrize("amount,currency,expected", [
    (1000.01, "EUR", 1), (999.99, "EUR", 0), (1000.00, "EUR", 0), (1200.00, "USD", 1),
    (900.00, "GBP", 1), (854.70, "GBP", 0)])
def test_high_value_boundaries(spark, amount, currency, expected):
    assert len(hv(spark, [row(amount=amount, currency=currency)])) == expected


def test_high_value_converted_amount_and_shape(spark):
    out = hv(spark, [row(amount=1200.0, currency="USD")])
    assert out[0]["amount_eur"] == pytest.approx(1104.0, abs=1e-9)
    assert out[0]["rule"] == RULE_HIGH_VALUE and out[0]["severity"] == "medium"
    assert out[0]["detail"] == "amount 1104.0 EUR exceeds 1000.0 threshold"
    assert out[0]["p_fraud"] is None and out[0]["country"] == "FR"
    assert out[0]["event_time"] == "2026-01-01T10:00:00Z"
    assert tuple(alert_projection(high_value_rule(enrich(frame(spark, [row()])))).columns) == ALERT_COLUMNS


def test_unknown_currency_gives_null_eur_and_no_alert(spark):
    e = enrich(frame(spark, [row(amount=5000.0, currency="JPY")])).collect()
    assert e[0]["amount_eur"] is None
    assert hv(spark, [row(amount=5000.0, currency="JPY")]) == []


def test_alert_id_is_deterministic(spark):
    a = hv(spark, [row(amount=2000.0)])[0]["alert_id"]
    b = hv(spark, [row(amount=2000.0)])[0]["alert_id"]
    assert a == b and len(a) == 64


def vel(spark, rows, **kw):
    return velocity_rule(enrich(frame(spark, rows)), **kw).collect()


def test_velocity_four_in_window_fires(spark):
    rows = [row(transaction_id=f"t-{i:07d}", ts=T0 + seconds(15 * i)) for i in range(4)]
    out = vel(spark, rows)
    assert len(out) == 1 and out[0]["rule"] == RULE_VELOCITY and out[0]["severity"] == "high"
    assert out[0]["detail"] == "4 transactions in window 10:00:00-10:01:00"
    assert out[0]["transaction_id"] == "t-0000003"


def test_velocity_three_does_not_fire(spark):
    rows = [row(transaction_id=f"t-{i:07d}", ts=T0 + seconds(15 * i)) for i in range(3)]
    assert vel(spark, rows) == []


def test_velocity_over_window_edge_does_not_fire(spark):
    base = T0 + seconds(11 * 60 + 30)
    rows = [row(transaction_id=f"t-{i:07d}", ts=base + seconds(s)) for i, s in enumerate((0, 20, 40, 61))]
    assert vel(spark, rows) == []


def test_velocity_two_users_two_each(spark):
    rows = [row(user_id=u, transaction_id=f"t-{u}{i}", ts=T0 + seconds(10 * i))
            for u in ("u1000", "u2000") for i in range(2)]
    assert vel(spark, rows) == []


def test_velocity_ties_pick_largest_transaction_id(spark):
    rows = [row(transaction_id=f"t-000000{i}", ts=T0) for i in (3, 9, 1, 5)]
    out = vel(spark, rows)
    assert out[0]["transaction_id"] == "t-0000009"


def test_velocity_parameters(spark):
    rows = [row(transaction_id=f"t-{i:07d}", ts=T0 + seconds(600 * i)) for i in range(2)]
    assert len(vel(spark, rows, width="1 hour", min_count=2)) == 1


def geo(spark, rows):
    return geo_hop_rule(enrich(frame(spark, rows))).collect()


def test_geo_hop_three_countries(spark):
    rows = [row(transaction_id=f"t-{i:07d}", location=c, ts=T0 + seconds(90 * i))
            for i, c in enumerate(("Paris", "London", "Berlin"))]
    out = geo(spark, rows)
    assert len(out) == 1 and out[0]["severity"] == "critical"
    assert out[0]["detail"] == "3 countries in window 10:00:00-10:05:00: DE,FR,GB"


def test_geo_hop_same_country(spark):
    rows = [row(transaction_id="t-1", location="Paris"),
            row(transaction_id="t-2", location="Lyon", ts=T0 + seconds(60))]
    assert geo(spark, rows) == []


def test_geo_hop_over_window_edge(spark):
    rows = [row(transaction_id="t-1", location="Paris", ts=T0 + seconds(180)),
            row(transaction_id="t-2", location="London", ts=T0 + seconds(540))]
    assert geo(spark, rows) == []


def test_geo_hop_unknown_city_does_not_count(spark):
    rows = [row(transaction_id="t-1", location="Paris"),
            row(transaction_id="t-2", location="Atlantis", ts=T0 + seconds(60))]
    assert geo(spark, rows) == []


def scored(spark, p_values):
    rows = [row(transaction_id=f"t-{i:07d}") for i in range(len(p_values))]
    e = enrich(frame(spark, rows))
    mapping = F.create_map(*[x for i, p in enumerate(p_values)
                             for x in (F.lit(f"t-{i:07d}"), F.lit(p))])
    return e.withColumn("p_fraud", mapping[F.col("transaction_id")])


@pytest.mark.parametrize("p,expected", [(0.85, 1), (0.80, 0), (0.79, 0)])
def test_ml_score_boundaries(spark, p, expected):
    out = ml_score_rule(scored(spark, [p]), tau=0.80).collect()
    assert len(out) == expected
    if expected:
        assert out[0]["rule"] == RULE_ML_SCORE
        assert out[0]["detail"] == "p_fraud=0.85 exceeds tau=0.8"


def test_one_pass_row_rules_emit_both(spark):
    df = scored(spark, [0.9]).withColumn("amount_eur", F.lit(5000.0))
    out = row_alerts(df, tau=0.5).collect()
    assert sorted(r["rule"] for r in out) == [RULE_HIGH_VALUE, RULE_ML_SCORE]
    assert {r["rule"]: r["severity"] for r in out} == {RULE_HIGH_VALUE: "medium", RULE_ML_SCORE: "high"}


def test_label_does_not_matter(spark):
    rows0 = [row(transaction_id=f"t-{i:07d}", ts=T0 + seconds(5 * i), amount=2000.0) for i in range(4)]
    rows1 = [r[:-1] + (1,) for r in rows0]
    for rule in (high_value_rule, velocity_rule, geo_hop_rule):
        assert (len(rule(enrich(frame(spark, rows0))).collect())
                == len(rule(enrich(frame(spark, rows1))).collect()))


def test_unknown_city_row_kept(spark):
    out = enrich(frame(spark, [row(location="Atlantis")])).collect()
    assert len(out) == 1 and out[0]["country"] is None
