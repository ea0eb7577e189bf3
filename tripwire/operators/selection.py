"""Exact selection by rank: the value at a position of the sorted order, without a sort of the
input and without one task that sees a value per row.

A mergeable quantile sketch (Spark's `percentile_approx`) brackets the value in the first read. The second read
counts the values below the bracket and, by value, those inside. Only the inside, a few
ten-thousandths of the rows, is looked at further, in steps of one aggregate each. A bracket that misses
the rank (the sketch's bound says it cannot) is opened to the whole range.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.session import scratch_path
from tripwire.streaming.folders import Folder

#: The sketch's rank error is at most 1 / ACCURACY of the rows.
ACCURACY = 10_000
#: So many distinct values are sorted in one task; more are cut into BUCKETS ranges first.
SORTED_VALUES, BUCKETS = 50_000, 1000


def value_at_rank(df: DataFrame, value: Column, fraction: float, rank_of: Callable[[int], int],
                  accuracy: int = ACCURACY) -> tuple[int | None, int]:
    """The `rank_of(n)`-th smallest (from 1) of the n non-null values of an integer column, and n; `fraction` says
    about where that rank lies. (None, n) for a rank outside 1..n. Two reads of `df`."""
    values = df.select(value.cast("long").alias("v")).filter(F.col("v").isNotNull())
    around = [max(fraction - 2 / accuracy, 0.0), min(fraction + 2 / accuracy, 1.0)]
    n, least, most, bracket = values.agg(F.count("v"), F.min("v"), F.max("v"),
                                         F.percentile_approx("v", around, accuracy)).first()
    rank = rank_of(n) if n else 0
    if not 1 <= rank <= n:
        return None, n
    lo = least if around[0] == 0 else bracket[0]
    hi = most if around[1] == 1 else bracket[1]
    found = _inside(values, lo, hi, rank)
    return (found if found is not None else _inside(values, least, most, rank)), n


def _inside(values: DataFrame, lo: int, hi: int, rank: int) -> int | None:
    """The value of this rank if it lies in [lo, hi]."""
    spark = values.sparkSession
    folder = scratch_path(spark, "ranks")
    name = uuid.uuid4().hex
    (values.filter(F.col("v") <= F.lit(hi)).groupBy(F.when(F.col("v") >= F.lit(lo), F.col("v")).alias("v"))
     .agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{folder}/{name}"))
    try:
        counted = spark.read.schema("v long, n long").parquet(f"{folder}/{name}")
        below, inside, distinct = counted.agg(F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)),
                                              F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)),
                                              F.count("v")).first()
        rank -= below
        if not 1 <= rank <= inside:
            return None
        part = counted.filter(F.col("v").isNotNull())
        while distinct > SORTED_VALUES:
            step = (hi - lo) // BUCKETS + 1
            ranges = (part.groupBy(F.floor((F.col("v") - F.lit(lo)) / F.lit(step)).cast("long").alias("k"))
                      .agg(F.sum("n").alias("n"), F.count("v").alias("d")).collect())  # at most BUCKETS + 1 rows
            for r in sorted(ranges):
                if rank <= r.n:
                    break
                rank -= r.n
            lo, distinct = lo + r.k * step, r.d
            hi = min(hi, lo + step - 1)
            part = part.filter((F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi)))
        upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return part.withColumn("upto", F.sum("n").over(upto)).filter(F.col("upto") >= rank).agg(F.min("v")).first()[0]
    finally:
        Folder(spark, folder).remove(name)
