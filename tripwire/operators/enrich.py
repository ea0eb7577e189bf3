"""Country lookup and EUR amount (needed before any rule runs)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.config import LABEL, LABEL_FRAGMENTS
from tripwire.functions.columns import amount_in_eur
from tripwire.sources.dimensions import city_dimension

class LabelLeakError(ValueError):
    """A label-shaped column would reach the model."""


def label_like(columns) -> dict[str, str]:
    """Columns whose names hold a fragment that betrays a label, with the fragment."""
    found = {}
    for name in columns:
        fragment = next((f for f in LABEL_FRAGMENTS if f in name.lower()), None)
        if fragment:
            found[name] = fragment
    return found


def check_no_label_leak(columns, allowed: tuple[str, ...] = (LABEL,)) -> None:
    """Raise unless every label-like column is one of `allowed`."""
    suspects = {c: f for c, f in label_like(columns).items() if c not in allowed}
    if suspects:
        report = ", ".join(f"{c} (holds '{f}')" for c, f in sorted(suspects.items()))
        raise LabelLeakError(f"columns that could carry the label: {report}")


#: A dimension is broadcast when its rows take at most so many bytes.
DIMENSION_BYTES = 8 * 2 ** 20


def one_row_per_place(places: DataFrame) -> DataFrame:
    """(location, country) with each location once: its smallest country. One look at the dimension says
    whether it has to be grouped at all and whether its measured bytes allow a broadcast; places without
    a location match nothing and go."""
    known = places.select("location", "country").filter(F.col("location").isNotNull())
    rows, distinct, size = known.agg(F.count(F.lit(1)), F.count_distinct("location"),
                                     F.coalesce(F.sum(F.octet_length("location") + F.coalesce(F.octet_length("country"), F.lit(0))),
                                                F.lit(0))).first()
    dim = known if rows == distinct else known.groupBy("location").agg(F.min("country").alias("country"))
    return F.broadcast(dim) if size + 32 * rows <= DIMENSION_BYTES else dim


def enrich(tx: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Add `country` (left join on `location`: unknown place keeps the row with
    NULL) and `amount_eur` (NULL for an unknown currency). Row count and order
    of columns are kept; the two new columns come last. A location that `places`
    holds more than once has the smallest of its countries."""
    dim = one_row_per_place(city_dimension(tx.sparkSession) if places is None else places)
    out = (tx.join(dim, on="location", how="left")
             .select(*tx.columns, "country",
                     amount_in_eur(F.col("amount"), F.col("currency")).alias("amount_eur")))
    check_no_label_leak(out.columns)
    return out
