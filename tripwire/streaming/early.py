"""Early emission of windowed alerts (R2 / R3): one alert per (rule, user, window), in the first
micro-batch in which the window passes its rule, while the window is still open.

The rule is Spark's own window aggregate in update mode: a batch brings the windows that it
changed and that pass. `FirstFiring` holds them against the alerts that earlier batches raised,
and lets the new ones through. Late rows are the aggregate's matter, so early and final mode
count the same rows for every width and delay.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.functions.columns import width_seconds
from tripwire.streaming.folders import Folder

_RAISED = "alert_id string, window_start timestamp"


@dataclass(frozen=True)
class FirstFiring:
    """The alerts raised for windows that can still change, one snapshot per micro-batch below
    `folder`. A batch reads the newest snapshot of an earlier batch and writes its own before
    any sink is reached; a retried batch therefore sees what it saw the first time, and fires the
    same alerts. A snapshot is as large as the passing open windows are many; older ones
    than the last are removed."""
    folder: str
    width: str
    delay: str

    def fresh(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The alerts of `batch` (with `window_start`) that no earlier batch raised."""
        spark = batch.sparkSession
        before = self._before(spark, batch_id)
        if before is None:
            return batch
        raised = spark.read.schema(_RAISED).parquet(f"{self.folder}/batch={before}")
        return batch.join(raised.select("alert_id"), "alert_id", "left_anti").select(*batch.columns)

    def note(self, fresh: DataFrame, batch_id: int) -> None:
        """Write the snapshot after `fresh`. A window has closed for the next batch when the
        delay before the newest window's start, which the watermark has then passed, is its end or later."""
        spark = fresh.sparkSession
        raised = fresh.select("alert_id", "window_start")
        before = self._before(spark, batch_id)
        if before is not None:
            raised = raised.unionByName(spark.read.schema(_RAISED).parquet(f"{self.folder}/batch={before}"))
        newest = raised.agg(F.max("window_start")).first()[0]
        open_for = F.make_interval(secs=F.lit(width_seconds(self.width) + width_seconds(self.delay)))
        still_open = raised.where(F.col("window_start") + open_for > F.lit(newest).cast("timestamp"))
        still_open.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")
        for old in self._batches(spark):
            if before is not None and old < before:
                Folder(spark, self.folder).remove(f"batch={old}")

    def _batches(self, spark: SparkSession) -> list[int]:
        return [int(n.removeprefix("batch=")) for n in Folder(spark, self.folder).names()]

    def _before(self, spark: SparkSession, batch_id: int) -> int | None:
        return max((b for b in self._batches(spark) if b < batch_id), default=None)
