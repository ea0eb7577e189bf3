"""Message contract, reject gate, label-leak guard, data-quality checks."""
import json

import pytest

from helpers import frame, row
from tripwire.operators.contract import (
    RejectRateError,
    check_messages,
    enforce_reject_gate,
    quality_checks,
    reject_summary,
    split_messages,
)
from tripwire.operators.enrich import LabelLeakError, check_no_label_leak

GOOD = {"user_id": "u1000", "transaction_id": "t-0000001", "amount": 42.0, "currency": "EUR",
        "timestamp": "2026-01-01T10:00:00Z", "location": "Paris", "method": "credit_card",
        "is_fraud": 0}


def msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_reasons(spark):
    missing = dict(GOOD)
    del missing["amount"], missing["method"]
    with_null = dict(GOOD, location=None)
    values = ["{not valid json at all", "[1, 2]", json.dumps(missing), json.dumps(with_null),
              json.dumps(GOOD), ""]
    out = {r["value"]: (r["status"], r["reason"]) for r in check_messages(msgs(spark, values)).collect()}
    assert out["{not valid json at all"] == ("rejected", "not_json_object")
    assert out["[1, 2]"] == ("rejected", "not_json_object")
    assert out[json.dumps(missing)] == ("rejected", "missing:amount,method")
    assert out[json.dumps(with_null)] == ("ok", None)
    assert out[json.dumps(GOOD)] == ("ok", None)
    assert out[""] == ("rejected", "not_json_object")


def test_split_parses_good_rows(spark):
    good, bad = split_messages(msgs(spark, [json.dumps(GOOD), "oops"]))
    g = good.collect()
    assert len(g) == 1 and g[0]["transaction_id"] == "t-0000001" and g[0]["ts"] is not None
    assert [r["reason"] for r in bad.collect()] == ["not_json_object"]


def test_reject_gate_limit_is_strict(spark):
    values = [json.dumps(GOOD)] * 99 + ["bad"]
    row_ = enforce_reject_gate(check_messages(msgs(spark, values)))
    assert row_["rejected"] == 1 and row_["passed"] == 1
    with pytest.raises(RejectRateError):
        enforce_reject_gate(check_messages(msgs(spark, [json.dumps(GOOD)] * 98 + ["bad"] * 2)))
    empty = reject_summary(check_messages(msgs(spark, []))).first()
    assert empty["total"] == 0 and empty["passed"] == 1


def test_label_leak_guard():
    check_no_label_leak(["amount", "is_fraud"])
    for bad in (["fraud_score"], ["Label"], ["my_target"]):
        with pytest.raises(LabelLeakError):
            check_no_label_leak(bad)


def test_quality_checks(spark):
    rows = [row(), row(), row(user_id="x1", transaction_id="bad", currency="JPY", method="cash",
                           amount=2.0),
            row(transaction_id="t-0000009", amount=9000.0, is_fraud=1),
            row(transaction_id="t-0000008", amount=9000.0, is_fraud=0)]
    got = {r["check_name"]: r["violations"] for r in quality_checks(frame(spark, rows)).collect()}
    assert got == {"duplicate_transaction_id": 1, "user_id_pattern": 1,
                   "transaction_id_pattern": 1, "currency_domain": 1, "method_domain": 1,
                   "amount_range": 2, "missing_timestamp": 0, "label_domain": 0}
