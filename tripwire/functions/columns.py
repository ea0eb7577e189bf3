"""Column expressions shared by operators. All built-in Spark functions, so they
stay inside whole-stage code generation."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwire.config import CLOCK_FORMAT, CURRENCIES, FX_TO_EUR, ISO_FORMAT, METHODS


def iso(col: Column) -> Column:
    """Timestamp -> `yyyy-MM-ddTHH:mm:ssZ` (session zone is UTC)."""
    return F.date_format(col, ISO_FORMAT)


def clock(col: Column) -> Column:
    """Timestamp -> `HH:mm:ss`."""
    return F.date_format(col, CLOCK_FORMAT)


def literal_map(pairs: Mapping) -> Column:
    """A constant MAP column; a missing key looks up to NULL."""
    flat = [F.lit(x) for kv in pairs.items() for x in kv]
    return F.create_map(*flat)


def fx_rate(currency: Column) -> Column:
    """Rate to EUR as DECIMAL(6,4); NULL for an unknown currency."""
    rates = F.create_map(*[x for code, rate in FX_TO_EUR.items()
                           for x in (F.lit(code), F.lit(rate).cast("decimal(6,4)"))])
    return rates[currency]


def amount_in_eur(amount: Column, currency: Column) -> Column:
    """Amount in EUR to two decimals. Decimal arithmetic, so the result does not
    depend on binary rounding of the double product; rounded once, returned as
    DOUBLE. NaN and amounts of 10^18 or more are NULL: one message never ends a stream."""
    product = amount.try_cast("decimal(26,8)") * fx_rate(currency)
    return F.round(product, 2).cast("double")


def index_of(values: Sequence[str], col: Column) -> Column:
    """Position of `col` in `values` as INT; NULL when absent."""
    return literal_map({v: i for i, v in enumerate(values)})[col].cast("int")


def method_index(col: Column) -> Column:
    return index_of(METHODS, col)


def currency_index(col: Column) -> Column:
    return index_of(CURRENCIES, col)


def alert_key(*parts: Column) -> Column:
    """Deterministic alert id: SHA-256 hex of the key parts, so a retried batch
    produces the same id and sinks can be idempotent. Every part carries its length and
    a NULL has a sign of its own, so different keys never give one text."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-"))
                             for p in parts]), 256)


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def width_seconds(width: str) -> int:
    """'5 minutes' -> 300."""
    number, unit = width.split()
    return int(number) * _UNIT_SECONDS[unit.lower().rstrip("s")]
