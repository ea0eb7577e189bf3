"""The streaming alert job: transactions -> enrich -> three queries.

- Q1 row rules (R1, and R4 when a scorer and tau are given), one pass, append.
- Q2 velocity (R2) and Q3 geo hop (R3), per mode:
  * "final": window aggregate in append mode; each window once, when the
    watermark passes its end. Deterministic; equals the batch result over
    closed windows.
  * "early": the same aggregate in update mode; each window once, in the first
    micro-batch that passes the rule (lower latency, restart-safe).
Each query has its own checkpoint folder under one root.
"""
from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tripwire.config import (
    GEO_MIN_COUNTRIES,
    GEO_WINDOW,
    HIGH_VALUE_EUR,
    TRIGGER_INTERVAL,
    VELOCITY_MIN_COUNT,
    VELOCITY_WINDOW,
    WATERMARK,
)
from tripwire.operators.enrich import enrich
from tripwire.operators.rules import geo_hop_rule, row_alerts, velocity_rule
from tripwire.streaming.early import FirstFiring
from tripwire.streaming.sinks import AlertSink, Delivery

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class JobSettings:
    checkpoint_root: str
    mode: str = "final"                       # "final" or "early"
    # Micro-batch trigger; {"availableNow": True} replays what is there and stops.
    trigger: dict | None = field(default_factory=lambda: {"processingTime": TRIGGER_INTERVAL})
    high_value: float = HIGH_VALUE_EUR
    velocity_window: str = VELOCITY_WINDOW
    velocity_min: int = VELOCITY_MIN_COUNT
    geo_window: str = GEO_WINDOW
    geo_min: int = GEO_MIN_COUNTRIES
    watermark: str = WATERMARK

    def __post_init__(self):
        if self.mode not in ("final", "early"):
            raise ValueError(f"unknown mode {self.mode!r}")

    def checkpoint(self, name: str) -> str:
        return os.path.join(self.checkpoint_root, name)


def alert_streams(transactions: DataFrame, settings: JobSettings,
                  places: DataFrame | None = None, scorer: Scorer | None = None,
                  tau: float | None = None) -> dict[str, DataFrame]:
    """The three alert frames (not started). The windowed ones are written in append mode
    (final) or in update mode through `FirstFiring` (early)."""
    enriched = enrich(transactions, places)
    scored = scorer(enriched) if scorer is not None and tau is not None else enriched
    rows = row_alerts(scored, high_value=settings.high_value,
                      tau=tau if scorer is not None else None, clock_mode="wall")
    velocity = velocity_rule(enriched, settings.velocity_window, settings.velocity_min,
                             settings.watermark, clock_mode="wall")
    geo = geo_hop_rule(enriched, settings.geo_window, settings.geo_min, settings.watermark, clock_mode="wall")
    return {"row": rows, "velocity": velocity, "geo": geo}


def start_alert_query(name: str, frame: DataFrame, settings: JobSettings,
                      sinks: Sequence[AlertSink]) -> StreamingQuery:
    """Start one of the three queries in its mode, delivering to every sink. Delivery notes and
    raised alerts lie beside the checkpoint, so they live and die with it."""
    widths = {"velocity": settings.velocity_window, "geo": settings.geo_window}
    early = settings.mode == "early" and name in widths
    first = FirstFiring(settings.checkpoint(f"raised/{name}"), widths[name], settings.watermark) if early else None
    writer = (frame.writeStream
              .foreachBatch(Delivery(sinks, name, settings.checkpoint(f"delivered/{name}"), first))
              .outputMode("update" if early else "append").queryName(f"alerts_{name}")
              .option("checkpointLocation", settings.checkpoint(name)))
    if settings.trigger:
        writer = writer.trigger(**settings.trigger)
    return writer.start()


def start_alert_queries(transactions: DataFrame, settings: JobSettings,
                        sinks: Sequence[AlertSink], places: DataFrame | None = None,
                        scorer: Scorer | None = None,
                        tau: float | None = None) -> dict[str, StreamingQuery]:
    """Start Q1-Q3, each with its own checkpoint."""
    frames = alert_streams(transactions, settings, places, scorer, tau)
    return {name: start_alert_query(name, frame, settings, sinks) for name, frame in frames.items()}
