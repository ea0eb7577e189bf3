"""Model: feature-order guard, scoring batch and stream frames."""
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler

from conftest import SF_SMALL
from tripwire.operators.features import add_features, temporal_split, user_profiles
from tripwire.operators.model import (
    FeatureOrderError,
    add_p_fraud,
    check_feature_order,
    load_model,
    save_model,
    train_model,
)
from tripwire.plans.catalog import enriched_tx


@pytest.fixture(scope="module")
def fitted(spark):
    e = enriched_tx(spark, SF_SMALL)
    train, valid, _ = temporal_split(e)
    prof = user_profiles(train)
    model = train_model(add_features(train, prof), add_features(valid, prof), max_iter=10)
    return model, prof, add_features(valid, prof)


def test_scores_are_probabilities(fitted):
    model, _, valid = fitted
    ps = [r["p_fraud"] for r in add_p_fraud(valid, model).select("p_fraud").collect()]
    assert ps and all(0.0 <= p <= 1.0 for p in ps)


def test_feature_order_guard(fitted):
    model, _, _ = fitted
    check_feature_order(model)
    stages = list(model.stages)
    wrong = VectorAssembler(inputCols=list(reversed(stages[0].getInputCols())), outputCol="features")
    with pytest.raises(FeatureOrderError):
        check_feature_order(PipelineModel(stages=[wrong] + stages[1:]))


def test_save_load_and_score_stream(spark, fitted, scratch):
    model, prof, valid = fitted
    path = os.path.join(scratch, "model")
    save_model(model, path)
    loaded = load_model(path)
    src = os.path.join(scratch, "in")
    enriched_cols = [c for c in valid.columns if c not in
                     ("log_amount", "hour", "dayofweek", "is_night", "method_id", "currency_id",
                      "amount_z", "is_new_user")]
    valid.select(*enriched_cols).write.parquet(src)
    stream = spark.readStream.schema(valid.select(*enriched_cols).schema).parquet(src)
    scored = add_p_fraud(add_features(stream, prof), loaded)
    q = (scored.writeStream.format("memory").queryName("scored_stream")
         .option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.sql("SELECT count(*) FROM scored_stream WHERE p_fraud IS NOT NULL").first()[0] > 0


def test_streaming_row_rules_with_model(spark, fitted, scratch):
    """Q1 of the streaming job: R1 and R4 in one pass over a stream, scored
    by the model with a static profile table."""
    from tripwire.operators.model import model_scorer
    from tripwire.sources.streams import transaction_file_stream
    from tripwire.streaming.jobs import JobSettings, alert_streams
    from tripwire.sources.tables import load_places
    model, prof, valid = fitted
    src = os.path.join(scratch, "in")
    valid.select("user_id", "transaction_id", "amount", "currency", "ts", "location", "method",
                 "is_fraud").write.parquet(src)
    stream = transaction_file_stream(spark, src, "parquet")
    settings = JobSettings(checkpoint_root=os.path.join(scratch, "ck"), high_value=500.0)
    rows = alert_streams(stream, settings, load_places(spark, SF_SMALL),
                         scorer=model_scorer(model, prof), tau=0.0)["row"]
    q = (rows.writeStream.format("memory").queryName("q1_model")
         .option("checkpointLocation", os.path.join(scratch, "ck_mem"))
         .trigger(availableNow=True).start())
    q.awaitTermination(180)
    got = spark.sql("SELECT rule, count(*) AS n FROM q1_model GROUP BY rule").collect()
    by_rule = {r["rule"]: r["n"] for r in got}
    assert by_rule.get("ml_score", 0) > 0 and by_rule.get("high_value", 0) > 0



def test_rows_with_missing_features_are_scored(spark, fitted):
    from pyspark.sql import functions as F
    model, _, valid = fitted
    broken = valid.limit(5).withColumn("amount_eur", F.lit(None).cast("double")) \
                  .withColumn("log_amount", F.lit(None).cast("double"))
    out = add_p_fraud(broken.unionByName(valid.limit(5)), model).collect()
    assert len(out) == 10
    assert all(r["p_fraud"] is not None for r in out)
    assert sum(1 for r in out if r["amount_eur"] is None and r["log_amount"] is None) == 5


def test_registered_model_queries_score_every_transaction(spark):
    from tripwire.plans import catalog
    tau = catalog.trained(spark, SF_SMALL)["metrics"]["tau"]
    scored = catalog.scored_transactions(spark, SF_SMALL)
    all_rows = catalog.enriched_tx(spark, SF_SMALL).count()
    assert scored.count() == all_rows
    fired = {r["transaction_id"] for r in scored.where(scored["p_fraud"] > tau).collect()}
    assert {r["transaction_id"] for r in catalog.queries()["ml_alerts"](spark, SF_SMALL).collect()} == fired
    for r in catalog.queries()["confusion_by_tau"](spark, SF_SMALL).collect():
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == all_rows


def test_training_goes_on_while_the_label_can_be_learned(spark):
    """A label that the features explain in part: more trees than up to the first round without gain, a ranking no
    worse than theirs and far above the base rate."""
    from tripwire.operators.model import evaluate, prefix_precisions
    from tripwire.plans.catalog import learnable
    train, valid, _ = temporal_split(learnable(enriched_tx(spark, SF_SMALL)))
    prof = user_profiles(train)
    t, v = add_features(train, prof), add_features(valid, prof)
    model = train_model(t, v, max_iter=40)
    found = prefix_precisions(model, v)
    first_dip = next((k for k in range(1, len(found)) if found[k] <= found[k - 1]), len(found))
    assert model.stages[-1].getNumTrees == len(found) > first_dip
    assert found[-1] == max(found) >= found[first_dip - 1]
    scored = add_p_fraud(v, model)
    base = scored.agg({"is_fraud": "avg"}).first()[0]
    assert evaluate(scored)["average_precision"] > min(0.9, 1.5 * base)


def test_patience_waits_for_a_later_better_round():
    from tripwire.operators.model import best_prefix
    assert best_prefix([0.1, 0.3, 0.2, 0.25, 0.4, 0.1], patience=3) == (5, False)
    assert best_prefix([0.1, 0.3, 0.2, 0.25, 0.2, 0.9], patience=3) == (2, True)
    assert best_prefix([0.5] * 31, patience=30) == (1, True) and best_prefix([0.5] * 30, patience=30) == (1, False)


def test_prefix_precisions_are_those_of_the_first_trees(spark):
    """Every prefix judged in one pass against a model of that many trees, scored and ranked whole."""
    from tripwire.operators.model import prefix_precisions
    from tripwire.plans.catalog import learnable
    e = learnable(enriched_tx(spark, SF_SMALL))
    train, valid, _ = temporal_split(e)
    prof = user_profiles(train)
    t, v = add_features(train, prof), add_features(valid, prof).persist()
    whole = train_model(t, None, max_iter=6)
    got = prefix_precisions(whole, v)
    assert len(got) == 6
    for k in (1, 4, 6):
        rows = add_p_fraud(v, train_model(t, None, max_iter=k)).select("p_fraud", "is_fraud").collect()
        cell = lambda p: min(int(p * 4096), 4095)
        tp = fp = 0
        ap, total = 0.0, sum(r.is_fraud for r in rows)
        for c in sorted({cell(r.p_fraud) for r in rows}, reverse=True):
            pos = sum(r.is_fraud for r in rows if cell(r.p_fraud) == c)
            tp, fp = tp + pos, fp + sum(1 - r.is_fraud for r in rows if cell(r.p_fraud) == c)
            ap += pos * tp / (tp + fp) / total
        assert abs(ap - got[k - 1]) < 1e-9
    v.unpersist()


def test_areas_with_ties_and_missing_classes(spark):
    from tripwire.operators.model import areas, score_points
    import random
    rng = random.Random(1)
    rows = [(round(rng.random(), 1), int(rng.random() < 0.4)) for _ in range(200)]
    got = areas(score_points(spark.createDataFrame(rows, "p_fraud double, is_fraud int"))).first()
    pos, neg = ([s for s, y in rows if y == v] for v in (1, 0))
    won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert abs(got.roc_auc - won / (len(pos) * len(neg))) < 1e-12
    points, tp, fp = [], 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp, fp = tp + pos.count(s), fp + neg.count(s)
        points.append((tp / len(pos), tp / (tp + fp)))
    points.insert(0, (0.0, points[0][1]))
    want = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert abs(got.pr_auc - want) < 1e-12
    one = spark.createDataFrame([(0.5, 1), (None, 0)], "p_fraud double, is_fraud int")
    assert areas(score_points(one)).first().roc_auc is None
    assert tuple(areas(score_points(one.limit(0))).first()) == (None, None)


def test_training_program_writes_what_the_job_loads(spark, scratch, monkeypatch):
    from tripwire import train
    from tripwire.operators.model import load_artifacts
    from tripwire.plans.catalog import learnable
    from tripwire.sources.tables import load_transactions
    learnable(enriched_tx(spark, SF_SMALL)).select(*load_transactions(spark, SF_SMALL).columns).write.parquet(f"{scratch}/tx")
    monkeypatch.setattr(train, "ship_package", lambda s: None)
    metrics = train.main(["--transactions", f"{scratch}/tx", "--artifacts", f"{scratch}/model", "--rounds", "5"])
    model, profiles, tau = load_artifacts(spark, f"{scratch}/model")
    assert tau == metrics["tau"] and profiles.count() > 0 and metrics["average_precision"] > 0.5
    assert 1 <= model.stages[-1].getNumTrees <= 5


def _payments(spark, n):
    """Own rows with the features of `FEATURE_ORDER` and a label that two of them explain in part."""
    from pyspark.sql import functions as F
    from tripwire.config import FEATURE_ORDER, LABEL
    def noise(k):
        return F.pmod(F.xxhash64(F.col("id"), F.lit(k)), F.lit(10_000)) / 10_000.0
    rows = spark.range(0, n, 1, 1).withColumns({c: F.floor(20 * noise(k)).cast("double") for k, c in enumerate(FEATURE_ORDER)})
    signal = F.col(FEATURE_ORDER[0]) + F.col(FEATURE_ORDER[2]) + 12 * noise(99) > 28
    return rows.withColumn(LABEL, signal.cast("int"))


def test_training_fits_once_and_keeps_the_first_trees(spark, scratch, monkeypatch):
    """The rounds after the best one are cut off, not fitted anew; what is left is the model of so many rounds."""
    from tripwire.operators import model as m
    train, valid = _payments(spark, 900), _payments(spark, 1500).where("id >= 900")
    fits, boosted = [], m._boosted
    monkeypatch.setattr(m, "_boosted", lambda data, rounds, *a: fits.append(rounds) or boosted(data, rounds, *a))
    monkeypatch.setattr(m, "best_prefix", lambda found, patience: (3, True))
    got = m.train_model(train, valid, max_iter=7)
    assert fits == [7] and got.stages[-1].getNumTrees == 3
    save_model(got, os.path.join(scratch, "m"))
    short = m.train_model(train, None, max_iter=3)
    def scores(fitted):
        return {r.id: r.p_fraud for r in add_p_fraud(valid, fitted).collect()}
    want = scores(short)
    assert scores(got) == want == scores(load_model(os.path.join(scratch, "m")))


def test_rows_of_one_file_are_spread_over_the_cores(spark, scratch):
    from tripwire.operators import model as m
    m_rows, cores = m.ROWS_A_TASK, spark.sparkContext.defaultParallelism
    spark.range(0, 2 * m_rows * cores, 1, 1).write.parquet(f"{scratch}/one")
    one = spark.read.parquet(f"{scratch}/one").coalesce(1)
    assert m.spread(one).rdd.getNumPartitions() == cores > 1
    assert m.spread(one).agg({"id": "sum"}).first()[0] == one.agg({"id": "sum"}).first()[0]
    assert m.spread(one.limit(100)).rdd.getNumPartitions() == 1


def test_few_rows_try_fewer_rounds_first(spark, monkeypatch):
    """Only a run that has not waited long enough is followed by all rounds; many rows get all rounds at once."""
    from tripwire.operators import model as m
    train, valid = _payments(spark, 300), _payments(spark, 500).where("id >= 300")
    fits, boosted = [], m._boosted
    monkeypatch.setattr(m, "_boosted", lambda data, rounds, *a: fits.append(rounds) or boosted(data, rounds, *a))
    monkeypatch.setattr(m, "FIRST_ROUNDS", 2)
    for waits, rows, want in (([True], 1000, [2]), ([False, True], 1000, [2, 4]), ([True], 100, [4])):
        fits.clear()
        answers = iter(waits)
        monkeypatch.setattr(m, "ROWS_A_TASK", rows)
        monkeypatch.setattr(m, "best_prefix", lambda found, patience: (1, next(answers)))
        assert m.train_model(train, valid, max_iter=4).stages[-1].getNumTrees == 1 and fits == want
