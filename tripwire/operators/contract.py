"""Message and data-quality contracts.

- `check_messages`: every raw JSON message gets a status; bad ones (not JSON,
  not an object, a required key missing) carry a reason. Works on streams.
- `reject_summary` / `enforce_reject_gate`: reject rate over a batch, and a
  gate that fails when it is strictly above the limit.
- `quality_checks`: one violation count per data-quality rule, one scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.config import (
    AMOUNT_MAX,
    AMOUNT_MIN,
    CURRENCIES,
    LABEL,
    MAX_REJECT_RATE,
    METHODS,
    REQUIRED_KEYS,
    TRANSACTION_ID_PATTERN,
    TS,
    USER_ID_PATTERN,
)
from tripwire.sources.streams import parse_transactions


class RejectRateError(RuntimeError):
    """More messages were rejected than the gate allows."""


def check_messages(messages: DataFrame, value_col: str = "value",
                   required: tuple[str, ...] = REQUIRED_KEYS) -> DataFrame:
    """Add `status` ('ok' / 'rejected') and `reason` (NULL when ok,
    'not_json_object', or 'missing:<k1,k2>'). A key present with a null value
    counts as present."""
    keys = F.json_object_keys(F.col(value_col))
    missing = F.array_except(F.array(*[F.lit(k) for k in required]),
                             F.coalesce(keys, F.array().cast("array<string>")))
    reason = (F.when(keys.isNull(), F.lit("not_json_object"))
               .when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ","))))
    return messages.select("*", reason.alias("reason")).withColumn(
        "status", F.when(F.col("reason").isNull(), F.lit("ok")).otherwise(F.lit("rejected")))


def split_messages(messages: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed transactions of good messages, bad messages with reason)."""
    checked = check_messages(messages, value_col)
    good = parse_transactions(checked.filter(F.col("status") == "ok"), value_col)
    bad = checked.filter(F.col("status") == "rejected").select(value_col, "reason")
    return good, bad


def reject_summary(checked: DataFrame, limit: float = MAX_REJECT_RATE) -> DataFrame:
    """One row: total, rejected, reject_rate, passed (1 when rate <= limit)."""
    total = F.count(F.lit(1))
    rejected = F.sum(F.when(F.col("status") == "rejected", 1).otherwise(0))
    out = checked.agg(total.alias("total"), F.coalesce(rejected, F.lit(0)).cast("long")
                      .alias("rejected"))
    rate = F.when(F.col("total") > 0, F.col("rejected") / F.col("total")).otherwise(F.lit(0.0))
    return out.select("total", "rejected", rate.alias("reject_rate"),
                      (rate <= F.lit(limit)).cast("int").alias("passed"))


def enforce_reject_gate(checked: DataFrame, limit: float = MAX_REJECT_RATE) -> dict:
    """Raise RejectRateError when the reject rate is strictly above `limit`;
    otherwise return the one summary row as a dict."""
    row = reject_summary(checked, limit).first().asDict()
    if not row["passed"]:
        raise RejectRateError(
            f"reject rate {row['rejected']}/{row['total']} exceeds {limit:.0%}")
    return row


def quality_checks(tx: DataFrame) -> DataFrame:
    """One row per check: (check_name, violations). One scan of `tx`; the unique-id
    check is an exact distinct count (a shuffle on transaction_id)."""
    def bad(cond):
        return F.sum(F.when(F.coalesce(cond, F.lit(True)), 1).otherwise(0))

    amount = F.col("amount")
    checks = {
        "duplicate_transaction_id": F.count(F.lit(1)) - F.count_distinct("transaction_id"),
        "user_id_pattern": bad(~F.col("user_id").rlike(USER_ID_PATTERN)),
        "transaction_id_pattern": bad(~F.col("transaction_id").rlike(TRANSACTION_ID_PATTERN)),
        "currency_domain": bad(~F.col("currency").isin(*CURRENCIES)),
        "method_domain": bad(~F.col("method").isin(*METHODS)),
        "amount_range": bad((amount < AMOUNT_MIN)
                            | ((amount > AMOUNT_MAX) & (F.col(LABEL) != 1))),
        "missing_timestamp": bad(F.col(TS).isNull()),
        "label_domain": bad(~F.col(LABEL).isin(0, 1)),
    }
    wide = tx.agg(*[F.coalesce(expr, F.lit(0)).cast("long").alias(name)
                    for name, expr in checks.items()])
    stack = ", ".join(f"'{name}', `{name}`" for name in checks)
    return wide.selectExpr(f"stack({len(checks)}, {stack}) AS (check_name, violations)")
