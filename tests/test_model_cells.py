"""Training and scoring by cells: the rows that agree in every bin, as one weighted row."""
import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tripwire.config import FEATURE_ORDER, LABEL
from tripwire.operators import model as m


def _rows(spark, n, copies=1):
    """Own rows: features of few and of many values, some missing, and a label that two of them explain in part."""
    def noise(k):
        return F.pmod(F.xxhash64(F.col("id"), F.lit(k)), F.lit(10_000)) / 10_000.0
    many = {0, 7}
    rows = spark.range(0, n, 1, 2).withColumns({
        c: noise(k) * 100 if k in many else F.floor((k + 1) * noise(k)).cast("int") for k, c in enumerate(FEATURE_ORDER)})
    rows = rows.withColumn(LABEL, (F.col(FEATURE_ORDER[0]) / 10 + F.col(FEATURE_ORDER[2]) + 6 * noise(99) > 8).cast("int"))
    rows = rows.withColumn(FEATURE_ORDER[0], F.when(F.col("id") % 50 > 0, F.col(FEATURE_ORDER[0])))
    return rows.crossJoin(spark.range(copies).select(F.col("id").alias("copy")))


def _row_by_row(rows, model):
    own = model.transform(m._complete(rows)).select("id", vector_to_array("probability")[1].alias("p"))
    return {r.id: r.p for r in own.collect()}


def test_trees_of_cells_are_those_of_all_rows(spark, monkeypatch):
    """Both ways over cells against MLlib on the rows themselves."""
    rows = _rows(spark, 1500).persist()
    plain = Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURE_ORDER), outputCol="features", handleInvalid="keep"),
        GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=8, maxDepth=5, stepSize=0.05, seed=42, lossType="logistic"),
    ]).fit(m._complete(rows).withColumn(LABEL, F.col(LABEL).cast("double")))
    want = _row_by_row(rows, plain)
    for at_once in (m.CELLS_A_TASK, 0):
        monkeypatch.setattr(m, "CELLS_A_TASK", at_once)
        got = m.train_model(rows, None, max_iter=8)
        assert got.stages[-1].getNumTrees == 8
        found = _row_by_row(rows, got)
        assert max(abs(found[k] - want[k]) for k in want) < 1e-9
    rows.unpersist()


def test_equal_rows_are_trained_on_once(spark, monkeypatch):
    """Rounds look at no more rows if every row comes forty times; the trees are the same."""
    seen, boosted = [], m._boosted
    monkeypatch.setattr(m, "_boosted", lambda data, *a: seen.append(data.count()) or boosted(data, *a))
    once, often = (m.train_model(_rows(spark, 200, copies), None, max_iter=3) for copies in (1, 40))
    assert seen[0] == seen[1] <= 200
    rows = _rows(spark, 200)
    a, b = _row_by_row(rows, once), _row_by_row(rows, often)
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_a_batch_is_scored_as_row_by_row(spark):
    """Values at a threshold, missing and odd ones and repeated rows; every row comes back as it was."""
    rows = _rows(spark, 600)
    model = m.train_model(rows, None, max_iter=5)
    at = m.thresholds_of(model)[0][0]
    few = rows.where("id < 40").withColumn(FEATURE_ORDER[0], F.when(F.col("id") % 4 == 0, F.lit(at)).when(F.col("id") % 4 == 1, F.lit(math.nan))
                                           .when(F.col("id") % 4 == 2, F.lit(math.inf)).otherwise(F.col(FEATURE_ORDER[0])))
    want = _row_by_row(few, model)
    got = m.add_p_fraud(few.unionByName(few), model)
    assert got.columns == [*few.columns, "p_fraud"]
    found = got.collect()
    assert len(found) == 80 and max(abs(r.p_fraud - want[r.id]) for r in found) < 1e-12
    deep = m.WORD
    try:
        m.WORD = 1      # the trees have more leaves: MLlib scores row by row
        assert {r.id: r.p_fraud for r in m.add_p_fraud(few, model).collect()} == want
    finally:
        m.WORD = deep
    assert sorted(str(r[FEATURE_ORDER[0]]) for r in found) == sorted(2 * [str(r[FEATURE_ORDER[0]]) for r in few.collect()])


@pytest.mark.parametrize("rows", (900, 12_000))
def test_cuts_of_every_value_or_of_ranks(spark, rows):
    """Few values are cut between all of them, many into bins of about equal numbers."""
    data = m._complete(_rows(spark, rows)).select(*FEATURE_ORDER, LABEL).persist()
    cuts = m.bin_cuts(data, rows)
    assert cuts[2] == [0.5, 1.5] and cuts[1] == [0.5] and len(cuts[7]) == 31
    placed, key = m.with_cells(data, cuts)
    assert len(key) == 1 and placed.columns == [*data.columns, *key]
    sizes = [r.n for r in data.groupBy(sum((F.col(FEATURE_ORDER[7]) > c).cast("int") for c in cuts[7])).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 32 and max(sizes) < 1.5 * rows / 32
    data.unpersist()
