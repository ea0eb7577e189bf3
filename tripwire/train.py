"""The training program: what the alert job loads for `ml_score`.

    python -m tripwire.train --transactions IN.parquet --artifacts SHARED/model

Reads labelled transactions (parquet, or JSON lines as the stream has them), splits them by time, builds the
profiles from the earlier part only, trains with early stopping on the later part, prints the
metrics and writes model, profiles and threshold in one folder.
"""
from __future__ import annotations

import argparse
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripwire.config import LABEL, TS
from tripwire.job import ship_package
from tripwire.operators.enrich import enrich
from tripwire.operators.features import add_features, label_rate, temporal_split, user_profiles
from tripwire.operators.model import add_p_fraud, evaluate, load_model, save_artifacts, save_model, spread, train_model
from tripwire.session import build_session, scratch_path
from tripwire.sources.streams import parse_transactions

#: Share of the rows, in time order, that the model learns from.
TRAIN_FRACTION = 0.8


def fit(enriched: DataFrame, times: DataFrame | None = None, train_fraction: float = TRAIN_FRACTION, **options) -> dict:
    """Train on the earlier part and judge on the later one: model, profiles, cut, scored_valid, metrics. Profiles, model and
    scores are written below the shared folder and read back, so that nothing is computed twice."""
    spark = enriched.sparkSession
    run = scratch_path(spark, "training", uuid.uuid4().hex)
    train, valid, cut = temporal_split(enriched, train_fraction, times=times)
    user_profiles(train).write.parquet(f"{run}/profiles")
    profiles = spark.read.parquet(f"{run}/profiles")
    save_model(train_model(add_features(train, profiles), add_features(valid, profiles), **options), f"{run}/model")
    model = load_model(f"{run}/model")
    add_p_fraud(add_features(valid, profiles), model).write.parquet(f"{run}/scored")
    scored = spark.read.parquet(f"{run}/scored")
    return {"model": model, "profiles": profiles, "cut": cut, "scored_valid": scored, "metrics": evaluate(scored)}


def read_labelled(spark: SparkSession, path: str, form: str, places: DataFrame | None = None) -> DataFrame:
    raw = (spark.read.parquet(path) if form == "parquet"
           else parse_transactions(spark.read.text(path)))
    return enrich(spread(raw.filter(raw[TS].isNotNull() & raw[LABEL].isNotNull())), places)


def options(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripwire-train", description="Labelled transactions in, model out.")
    parser.add_argument("--transactions", default=os.environ.get("TRIPWIRE_TRANSACTIONS"), help="labelled transactions")
    parser.add_argument("--format", default="parquet", choices=("parquet", "json"))
    parser.add_argument("--artifacts", default=os.environ.get("TRIPWIRE_ARTIFACTS"), help="folder for model, profiles and threshold")
    parser.add_argument("--rounds", type=int, default=300, help="most boosting rounds")
    got = parser.parse_args(argv)
    if not (got.transactions and got.artifacts):
        parser.error("--transactions and --artifacts are needed")
    return got


def main(argv: Sequence[str] | None = None) -> dict:
    got = options(argv)
    spark = build_session("tripwire-train")
    ship_package(spark)
    enriched = read_labelled(spark, got.transactions, got.format)
    rate = label_rate(enriched).first()
    found = fit(enriched, max_iter=got.rounds)
    save_artifacts(found["model"], found["profiles"], found["metrics"]["tau"], got.artifacts)
    print(f"rows={rate.rows} positive_rate={rate.positive_rate:.4f} trees={found['model'].stages[-1].getNumTrees} "
          + " ".join(f"{k}={v:.4f}" for k, v in found["metrics"].items() if v is not None))
    return found["metrics"]


if __name__ == "__main__":
    main()
