"""Fraud model (R4): train, check, score, evaluate, pick the threshold.

MLlib gradient-boosted trees on the nine features. Training and scoring use
the same feature function (`features.add_features`). Trees see a feature only as the bin it falls in, so
training and the choice of the best round work on cells: the rows that agree in every bin, as one weighted row.
Threshold tuning and average precision work on the exact distinct scores, summed range by range.
"""
from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterable, Iterator
from typing import Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tripwire.config import FEATURE_ORDER, LABEL
from tripwire.operators.enrich import check_no_label_leak


class FeatureOrderError(ValueError):
    """The model was trained on other features, or in another order."""


def _complete(df: DataFrame) -> DataFrame:
    """Every row, with missing features (unknown currency, method or time) set to a value below
    every real one, which a tree can split off; a missing deviation is none (0)."""
    below = {c: -1.0 for c in ("amount_eur", "log_amount")} | {"amount_z": 0.0}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(below.get(c, -1))) for c in FEATURE_ORDER})


#: Boosting rounds without a better validation result after which training counts as stopped.
PATIENCE = 30
#: Rounds that are tried first on few rows (ROWS_A_TASK), which are soon learnt by heart.
FIRST_ROUNDS = 120
#: Bins of the score in which a prefix's average precision is taken.
PREFIX_BINS = 4096


#: Rows that are worth a task of their own to the model.
ROWS_A_TASK = 25_000


def spread(rows: DataFrame) -> DataFrame:
    """The rows over all cores, if they are many: a table of one file is one task, and each of hundreds of trees looks at every row.
    Rows that already lie in as many parts, and small tables, stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = min(cores, -(-rows.count() // ROWS_A_TASK))
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


#: Bins of a feature; the trees split between two of them.
BINS = 32
#: Values of a feature that its bins are cut by: all of so many rows, evenly spaced order statistics of more.
RANKS = 10_000
#: Cells that one task grows all trees from.
CELLS_A_TASK = 2 ** 20
#: A key of cells holds the bins of features up to this product of their numbers.
KEY_SIZE = 2 ** 62


def stride_cuts(values: Iterable[float], counts: Iterable[int] | None = None) -> list[float]:
    """Where MLlib cuts a feature with these values: between all of them if they are few, otherwise where the count
    below comes closest to a multiple of the rows of a bin."""
    values = np.array(list(values), float)
    counts = np.ones(len(values), int) if counts is None else np.array(list(counts))
    fits = np.isfinite(values)
    values, at = np.unique(values[fits], return_inverse=True)
    counts = np.bincount(at, counts[fits], len(values))
    middles = [(float(a) + float(b)) / 2 for a, b in zip(values, values[1:])]
    rows = int(counts.sum())
    splits = min(BINS, rows) - 1
    if len(middles) <= splits:
        return middles
    cuts, target, below = [], rows / (splits + 1), 0
    for middle, n, more in zip(middles, counts, counts[1:]):
        below += int(n)
        if abs(below - target) < abs(below + int(more) - target):
            cuts.append(middle)
            target += rows / (splits + 1)
    return cuts


def bin_cuts(data: DataFrame, rows: int) -> list[list[float]]:
    """Per feature, the cuts between its bins, from all rows. Codes (whole numbers) and features of up to RANKS rows are cut by every value and its
    count, as MLlib does; of other features, quantile sketches give RANKS order statistics (MLlib draws so many rows)."""
    codes = [f.name for f in data.schema if f.name in FEATURE_ORDER and isinstance(f.dataType, IntegralType)]
    found: dict[str, list[float]] = {}
    if rows <= RANKS:
        whole = data.agg(*[F.collect_list(F.col(c).cast("double")).alias(c) for c in FEATURE_ORDER]).first()
        return [stride_cuts(whole[c] or ()) for c in FEATURE_ORDER]
    if codes:
        counted = data.groupBy(*codes).agg(F.count(F.lit(1)).alias("n"))
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in codes])).alias("f")
        values: dict[str, list] = {c: [] for c in codes}
        for r in counted.select(each, "n").groupBy("f.name", "f.value").agg(F.sum("n").alias("n")).collect():
            values[r.name].append((r.value, r.n))
        found = {c: stride_cuts(*zip(*v)) for c, v in values.items()}
    rest = [c for c in FEATURE_ORDER if c not in codes]
    if rest:
        shares = F.split(F.lit(",".join(repr((k + 0.5) / RANKS) for k in range(RANKS))), ",").cast("array<double>")
        ranked = data.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, RANKS).alias(c) for c in rest]).first()
        found |= {c: stride_cuts(ranked[c] or ()) for c in rest}
    return [found[c] for c in FEATURE_ORDER]


def _keys(cuts: list[list[float]]) -> list[list[tuple[int, int]]]:
    """The features of each key column, with what their bins are multiplied by."""
    keys, held = [], KEY_SIZE
    for k, own in enumerate(cuts):
        if held * (len(own) + 1) > KEY_SIZE:
            keys.append([])
            held = 1
        keys[-1].append((k, held))
        held *= len(own) + 1
    return keys


def with_cells(rows: DataFrame, cuts: list[list[float]]) -> tuple[DataFrame, list[str]]:
    """The rows with the cell that their (complete) features fall in, as columns of numbers, and the names of these.
    A value equal to a cut lies below it, as in a tree."""
    cut = [k for k, own in enumerate(cuts) if own]
    bins = {k: F.least(F.col(f"_bin{k}"), F.lit(len(cuts[k]))).cast("long") for k in cut}   # NaN lies above all cuts
    placed = rows.withColumns({f"_value{k}": F.col(FEATURE_ORDER[k]).cast("double") for k in cut})
    if cut:
        placed = Bucketizer(inputCols=[f"_value{k}" for k in cut], outputCols=[f"_bin{k}" for k in cut], handleInvalid="keep", splitsArray=[
            [-math.inf, *(math.nextafter(c, math.inf) for c in cuts[k]), math.inf] for k in cut]).transform(placed)
    cells = {f"_cell{n}": sum((bins[k] * F.lit(by).cast("long") for k, by in key if k in bins), F.lit(0).cast("long"))
             for n, key in enumerate(_keys(cuts))}
    return placed.select(*rows.columns, *[c.alias(name) for name, c in cells.items()]), list(cells)


def of_cells(cells: DataFrame, cuts: list[list[float]], values: list[list[float]], *others: str) -> DataFrame:
    """Cells as rows of features: values[k][j] stands for bin j of feature k."""
    found = {}
    for n, key in enumerate(_keys(cuts)):
        for k, by in key:
            at = F.expr(f"CAST(_cell{n} DIV {by}L % {len(cuts[k]) + 1}L AS INT)")
            found[FEATURE_ORDER[k]] = F.array(*[F.lit(float(v)) for v in values[k]])[at]
    return cells.select(*[found[c].alias(c) for c in FEATURE_ORDER], *others)


def grow_trees(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, sizes: list[int], rounds: int, max_depth: int,
               step_size: float) -> Iterator[list[tuple]]:
    """MLlib's boosting on cells: bins[k] has the bin of feature k, `label` is -1 or 1. Per round a regression tree on the residuals of
    the logistic loss, level by level, each split the one with the largest gain in variance over all features and bins (the first of equal ones).
    A tree's nodes: (feature or -1, last bin on the left, left, right, weight, sum, sum of squares)."""
    margin, wide = np.zeros(len(label)), max(sizes)
    for turn in range(rounds):
        goal = 4 * label / (1 + np.exp(2 * label * margin)) if turn else label.astype(float)
        total, square = weight * goal, weight * goal * goal
        nodes, found = [[-1, 0, 0, 0, weight.sum(), total.sum(), square.sum()]], np.zeros(len(label), np.int64)
        level, rows, at = [0], np.arange(len(label)), np.zeros(len(label), np.int64)
        for depth in range(max_depth):
            if not level:
                break
            n = len(level)
            w, s = (np.array([nodes[k][c] for k in level]) for c in (4, 5))
            best, feature, cut = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64)
            own, heavy, much = bins[:, rows], weight[rows], total[rows]
            for f, size in enumerate(sizes):
                if size < 2:
                    continue
                cell = at * wide + own[f]
                left_w, left_s = (np.bincount(cell, v, n * wide).reshape(n, wide)[:, :size].cumsum(1)[:, :-1] for v in (heavy, much))
                right_w, right_s = w[:, None] - left_w, s[:, None] - left_s
                some = (left_w > 0.5) & (right_w > 0.5)     # cells weigh at least 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(some, (left_s ** 2 / left_w + right_s ** 2 / right_w - (s * s / w)[:, None]) / w[:, None], 0.0)
                first = gain.argmax(1)
                better = gain[np.arange(n), first] > best
                best[better], feature[better], cut[better] = gain[np.arange(n), first][better], f, first[better]
            # Rows of nodes that stay leaves are done; the others go on to a child each.
            going = feature[at] >= 0
            rows, at, own = rows[going], at[going], own[:, going]
            at = 2 * at + (own[feature[at], np.arange(len(rows))] > cut[at])
            sums = [np.bincount(at, v[rows], 2 * n) for v in (weight, total, square)]
            following, place = [], np.full(2 * n, -1)
            for k in np.nonzero(feature >= 0)[0]:
                nodes[level[k]][:4] = int(feature[k]), int(cut[k]), len(nodes), len(nodes) + 1
                for child in (2 * k, 2 * k + 1):
                    cw, cs, cq = (float(v[child]) for v in sums)
                    if cq / cw - (cs / cw) ** 2 > 2 ** -52:
                        place[child] = len(following)
                        following.append(len(nodes))
                    found[rows[at == child]] = len(nodes)
                    nodes.append([-1, 0, 0, 0, cw, cs, cq])
            on = place[at] >= 0
            rows, at, level = rows[on], place[at[on]], following
        margin += (step_size if turn else 1.0) * np.array([v[5] / v[4] for v in nodes])[found]
        yield [tuple(v) for v in nodes]


def _grown(cells: DataFrame, sizes: list[int], keys: list[list[tuple[int, int]]], rounds: int, max_depth: int, step_size: float) -> list[list[tuple]]:
    """The trees' nodes, from one task that holds the cells: a few bytes per feature and cell."""
    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [([(c.to_numpy() // by % sizes[k]).astype(np.uint16) for c, key in zip(b.columns, keys) for k, by in key],
                 2.0 * b.column(b.num_columns - 2).to_numpy(zero_copy_only=False) - 1, b.column(b.num_columns - 1).to_numpy()) for b in batches if b.num_rows]
        if not held:
            return
        bins = np.stack([np.concatenate([h[0][k] for h in held]) for k in range(len(sizes))])
        label, weight = (np.concatenate([h[c] for h in held]) for c in (1, 2))
        if not np.isin(label, (-1.0, 1.0)).all():
            raise ValueError(f"{LABEL} has values other than 0 and 1")
        order = np.lexsort([label, *bins])      # sums do not depend on how the cells came
        for tree, nodes in enumerate(grow_trees(bins[:, order], label[order], weight[order], sizes, rounds, max_depth, step_size)):
            columns = [list(c) for c in zip(*nodes)]
            yield pa.record_batch([pa.array([tree] * len(nodes), pa.int32()), pa.array(range(len(nodes)), pa.int32()),
                                   *(pa.array(c, pa.int32()) for c in columns[:4]), *(pa.array(c, pa.float64()) for c in columns[4:])],
                                  names=["tree", "node", "feature", "cut", "left", "right", "w", "s", "q"])

    rows = cells.coalesce(1).mapInArrow(grow, "tree int, node int, feature int, cut int, left int, right int, w double, s double, q double").collect()
    trees: dict[int, list[tuple]] = {}
    for r in sorted(rows, key=lambda r: (r.tree, r.node)):
        trees.setdefault(r.tree, []).append(tuple(r)[2:])
    return [trees[t] for t in sorted(trees)]


def _as_mllib(trees: list[list[tuple]], cuts: list[list[float]], estimator: GBTClassifier, assembler: VectorAssembler) -> PipelineModel:
    """Grown trees as MLlib's model over the features."""
    gateway = SparkSession.active().sparkContext._gateway
    ml, old = gateway.jvm.org.apache.spark.ml, gateway.jvm.org.apache.spark.mllib
    leaf, inner, split, tree_of = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
    numbers = np.array([(w, s, q, w) for nodes in trees for *_, w, s, q in nodes], ">f8")
    stats = gateway.new_array(gateway.jvm.double, numbers.size)
    gateway.jvm.java.nio.ByteBuffer.wrap(bytearray(numbers.tobytes())).asDoubleBuffer().get(stats)
    calculator = old.tree.impurity.VarianceAggregator().getCalculator
    made, first = [], 0
    for t, nodes in enumerate(trees):
        done: list = [None] * len(nodes)
        for k in range(len(nodes) - 1, -1, -1):     # children come after their parent
            f, cut, left, right, w, s, q = nodes[k]
            spread_of = max(0.0, q / w - (s / w) ** 2)
            own = calculator(stats, 4 * (first + k))
            if f < 0:
                done[k] = leaf(s / w, spread_of, own)
            else:
                wl, wr = nodes[left][4], nodes[right][4]
                gain = (nodes[left][5] ** 2 / wl + nodes[right][5] ** 2 / wr - s * s / w) / w
                done[k] = inner(s / w, spread_of, gain, done[left], done[right], split(f, cuts[f][cut]), own)
        made.append(tree_of(f"{estimator.uid}_{t}", done[0], len(cuts)))
        first += len(nodes)
    return _of_trees(assembler, estimator, made, [1.0] + [estimator.getStepSize()] * (len(made) - 1))


def _boosted(cells: DataFrame, rounds: int, max_depth: int, step_size: float, seed: int, cuts: list[list[float]]) -> PipelineModel:
    """Trees over cells (key columns, label, weight). Up to CELLS_A_TASK cells they are grown in one task, which spares the five Spark jobs that MLlib
    starts for each tree; more cells go to MLlib's own trainer, as weighted rows of bin numbers. MLlib cuts between all
    bins: with so many allowed, it looks at every cell."""
    count = cells.count()
    assembler = VectorAssembler(inputCols=list(FEATURE_ORDER), outputCol="features", handleInvalid="keep")
    estimator = GBTClassifier(featuresCol="features", labelCol=LABEL, weightCol="weight", maxIter=rounds, maxDepth=max_depth, stepSize=step_size,
                              maxBins=max(BINS, math.isqrt(count) + 1), seed=seed, lossType="logistic")
    if 0 < count <= CELLS_A_TASK:
        return _as_mllib(_grown(cells, [len(own) + 1 for own in cuts], _keys(cuts), rounds, max_depth, step_size), cuts, estimator, assembler)
    numbers = [[float(j) for j in range(len(own) + 1)] for own in cuts]
    return with_thresholds(Pipeline(stages=[assembler, estimator]).fit(spread(of_cells(cells, cuts, numbers, LABEL, "weight"))), cuts)


def thresholds_of(model: PipelineModel) -> list[list[float]]:
    """Per feature, the values that the model's trees split at, in order."""
    found: list[set[float]] = [set() for _ in FEATURE_ORDER]
    for tree in model.stages[-1].trees:
        for k, at in re.findall(r"If \(feature (\d+) <= ([^)\s]+)\)", tree.toDebugString):
            found[int(k)].add(float(at))
    return [sorted(own) for own in found]


def upper_ends(cuts: list[list[float]]) -> list[list[float]]:
    """A value of each bin."""
    return [[*own, math.nextafter(own[-1], math.inf)] if own else [0.0] for own in cuts]


def labelled_cells(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """(features, pos, neg): the rows with and without the label in each cell, each feature by the upper end of its bin."""
    placed, key = with_cells(_complete(rows), cuts)
    y = F.coalesce(F.col(LABEL).cast("double") == 1, F.lit(False))
    return of_cells(placed.groupBy(*key).agg(F.sum(y.cast("long")).alias("pos"), F.sum((~y).cast("long")).alias("neg")),
                    cuts, upper_ends(cuts), "pos", "neg")


def prefix_precisions(model: PipelineModel, valid: DataFrame) -> list[float]:
    """Average precision on `valid` of the first 1, 2, ... trees. Rows between the same thresholds of
    the model reach the same leaf of every tree, so one row for each such cell is judged."""
    return _prefix_precisions(model, labelled_cells(valid, thresholds_of(model)))


def _prefix_precisions(model: PipelineModel, cells: DataFrame) -> list[float]:
    """The same on `labelled_cells`, from one pass: each cell's leaf in every tree gives the running sums of all prefixes,
    which are counted into PREFIX_BINS bins of the probability (rows of one bin tie). A row per prefix reaches the driver."""
    boosted = model.stages[-1]
    leaves = [np.array([float(v) for v in re.findall(r"Predict: (\S+)", t.toDebugString)]) for t in boosted.trees]
    weights, trees = list(boosted.treeWeights), len(boosted.trees)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, neg = (np.zeros((trees, PREFIX_BINS)) for _ in range(2))   # counts, exact up to 2^53
        for b in batches:
            if b.num_rows == 0:
                continue
            at = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, trees).astype(np.int64)
            with_label, without, margin = b.column(1).to_numpy(), b.column(2).to_numpy(), np.zeros(b.num_rows)
            for t in range(trees):
                margin += weights[t] * leaves[t][at[:, t]]
                cell = np.minimum(PREFIX_BINS / (1 + np.exp(-2 * margin)), PREFIX_BINS - 1).astype(np.int64)
                pos[t] += np.bincount(cell, with_label, minlength=PREFIX_BINS)
                neg[t] += np.bincount(cell, without, minlength=PREFIX_BINS)
        tree, cell = np.nonzero(pos + neg)
        yield pa.record_batch([pa.array(tree, pa.int64()), pa.array(cell, pa.int64()), pa.array(pos[tree, cell].astype(np.int64)),
                               pa.array(neg[tree, cell].astype(np.int64))], names=["tree", "cell", "pos", "neg"])

    boosted = boosted.copy().setLeafCol("leaf")
    placed = PipelineModel(model.stages[:-1] + [boosted]).transform(cells)
    cells = (placed.select(vector_to_array("leaf").alias("leaf"), "pos", "neg")
             .mapInArrow(count, "tree long, cell long, pos long, neg long")
             .groupBy("tree", "cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    down = Window.partitionBy("tree").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tp = F.sum("pos").over(down)
    part = cells.withColumn("gain", F.col("pos") * tp / (tp + F.sum("neg").over(down)))
    found = part.groupBy("tree").agg((F.sum("gain") / F.sum("pos")).alias("ap")).collect()
    by_tree = {r.tree: r.ap for r in found}
    return [by_tree.get(t) or 0.0 for t in range(trees)]


def best_prefix(precisions: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """How many trees to keep (the first best, as a run that stops after `patience` rounds without a better
    one would find it), and whether such a run has stopped within the list."""
    best, at = -1.0, 0
    for k, ap in enumerate(precisions, 1):
        if ap > best:
            best, at = ap, k
        elif k - at >= patience:
            return at, True
    return at, False


def _of_trees(assembler, settings, trees: list, weights: list[float]) -> PipelineModel:
    """The model of these (Java) trees, with the parameters of an estimator or model."""
    gateway = SparkSession.active().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    held = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    by = gateway.new_array(gateway.jvm.double, len(trees))
    for k, (tree, weight) in enumerate(zip(trees, weights)):
        held[k], by[k] = tree, float(weight)
    made = GBTClassificationModel(ml.classification.GBTClassificationModel(settings.uid, held, by))
    return PipelineModel([assembler, settings._copyValues(made)])


def first_trees(model: PipelineModel, keep: int) -> PipelineModel:
    """The model as it was after `keep` boosting rounds: a round's tree depends on the rounds before it alone."""
    *before, boosted = model.stages
    if keep >= len(boosted.trees):
        return model
    return _of_trees(before[0], boosted, [t._java_obj for t in boosted.trees[:keep]], boosted.treeWeights)


def with_thresholds(model: PipelineModel, cuts: list[list[float]]) -> PipelineModel:
    """A model over the numbers of bins as one over the features: a split after bin j is one at cut j."""
    ml = SparkSession.active().sparkContext._jvm.org.apache.spark.ml
    inner, split, tree_of = ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel

    def over_features(node):
        if node.subtreeDepth() == 0:
            return node
        k, at = node.split().featureIndex(), node.split().threshold()
        return inner(node.prediction(), node.impurity(), node.gain(), over_features(node.leftChild()),
                     over_features(node.rightChild()), split(k, cuts[k][math.floor(at)]), node.impurityStats())

    assembler, boosted = model.stages
    trees = [tree_of(t._java_obj.uid(), over_features(t._java_obj.rootNode()), t.numFeatures) for t in boosted.trees]
    return _of_trees(assembler, boosted, trees, boosted.treeWeights)


def train_model(train_features: DataFrame, valid_features: DataFrame | None = None,
                max_iter: int = 300, max_depth: int = 5, step_size: float = 0.05,
                seed: int = 42, patience: int = PATIENCE) -> PipelineModel:
    """Boosted trees: depth 5 (up to 32 leaves), learning rate 0.05, up to 300
    rounds; with a validation frame, the rounds end when the validation rows' average precision has
    not risen for `patience` rounds, and the trees up to the best round are kept. No row is left out. No class weights.

    Every round looks at the training rows five times. They are counted once into cells, the rows that fall into the same bins
    of all features with the same label: MLlib's trees cannot tell them apart, so a cell with the weight of its rows stands for them.

    MLlib cannot go on with a fitted model, so all rounds are fitted at once (few rows: FIRST_ROUNDS, and all only if that run has not
    waited long enough); every prefix is judged in one pass, and the trees after the best one are cut off. The first trees
    do not depend on the number of rounds, so neither does what is kept."""
    check_no_label_leak(FEATURE_ORDER, allowed=())
    cols = list(FEATURE_ORDER) + [LABEL]
    data = _complete(train_features).select(*cols).withColumn(LABEL, F.col(LABEL).cast("double")).persist()
    held = [data]
    try:
        rows = data.count()
        cuts = bin_cuts(data, rows)
        placed, key = with_cells(data, cuts)
        cells = placed.groupBy(*key, LABEL).agg(F.count(F.lit(1)).cast("double").alias("weight")).persist()
        held.append(cells)
        if valid_features is None or valid_features.filter(F.col(LABEL) == 1).isEmpty():
            return _boosted(cells, max_iter, max_depth, step_size, seed, cuts)
        judged = labelled_cells(valid_features, cuts).persist()
        held.append(judged)
        first = FIRST_ROUNDS if rows <= ROWS_A_TASK else max_iter
        for rounds in sorted({min(first, max_iter), max_iter}):
            model = _boosted(cells, rounds, max_depth, step_size, seed, cuts)
            keep, waited = best_prefix(_prefix_precisions(model, judged), patience)
            if waited:
                break
        return first_trees(model, keep)
    finally:
        for df in held:
            df.unpersist()


def check_feature_order(model: PipelineModel) -> None:
    """Refuse a model whose assembler is not FEATURE_ORDER, in order."""
    assemblers = [s for s in model.stages if isinstance(s, VectorAssembler)]
    got = tuple(assemblers[0].getInputCols()) if assemblers else ()
    if got != FEATURE_ORDER:
        raise FeatureOrderError(f"model features {got} != {FEATURE_ORDER}")


#: Leaves of a tree that a cell's leaf is found among by one word of bits, and scores that a task keeps.
WORD, SCORES_HELD = 64, 2 ** 18


def leaf_words(model: PipelineModel, cuts: list[list[float]]) -> list[tuple[dict[int, np.ndarray], np.ndarray]] | None:
    """Per tree: for each feature it splits on, a word for each bin, with a bit for each leaf that the bin lets a row reach; and the leaves' weighted
    values. The words of a row's bins have one bit in common, its leaf. None if a tree has more leaves than a word has bits."""
    trees = []
    for tree, weight in zip(model.stages[-1].trees, model.stages[-1].treeWeights):
        lines = re.findall(r"If \(feature (\d+) <= ([^)\s]+)\)|Predict: (\S+)", tree.toDebugString)
        words: dict[int, list[int]] = {}
        values: list[float] = []

        def read() -> int:
            """The leaves of the subtree that comes next."""
            feature, at, value = lines.pop(0)
            if value:
                values.append(weight * float(value))
                return 1 << (len(values) - 1)
            k, j = int(feature), bisect.bisect_left(cuts[int(feature)], float(at))
            left = read()
            right = read()
            own = words.setdefault(k, [-1] * (len(cuts[k]) + 1))
            for b in range(len(own)):
                own[b] &= ~(right if b <= j else left)
            return left | right

        whole = read()
        if len(values) > WORD:
            return None
        trees.append(({k: np.array([w & whole for w in own], np.uint64) for k, own in words.items()}, np.array(values)))
    return trees


def add_p_fraud(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Score rows (batch or stream): `p_fraud` = probability of class 1. Every input row is
    kept and scored; missing features are filled for the model only.

    Rows between the same thresholds of the model reach the same leaves. A task gets the rows' cells alone and runs each new
    cell through the trees once. Trees of more than WORD leaves are left to MLlib, row by row."""
    check_feature_order(model)
    own = {c: f"_own_{c}" for c in FEATURE_ORDER}
    filled = _complete(features.withColumns({name: F.col(c) for c, name in own.items()}))
    back = [F.col(own[c]).alias(c) if c in own else F.col(c) for c in features.columns]
    cuts = thresholds_of(model)
    trees = leaf_words(model, cuts)
    if trees is None:
        return model.transform(filled).select(*back, vector_to_array(F.col("probability")).getItem(1).alias("p_fraud"))
    keys = _keys(cuts)

    def scores(columns: list[np.ndarray]) -> np.ndarray:
        bins = {k: column // by % (len(cuts[k]) + 1) for column, key in zip(columns, keys) for k, by in key}
        margin = np.zeros(len(columns[0]))
        for words, values in trees:
            reached = [word[bins[k]] for k, word in words.items()]
            margin += values[np.frexp(np.bitwise_and.reduce(reached).astype(float))[1] - 1] if reached else values[0]
        return 1 / (1 + np.exp(-2 * margin))

    @F.pandas_udf("double")
    def p_fraud(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        known, found = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            columns = [c.to_numpy() for c in ([batch] if isinstance(batch, pd.Series) else batch)]
            if len(columns) > 1:
                yield pd.Series(scores(columns))
                continue
            cells, at = np.unique(columns[0], return_inverse=True)
            fresh = np.setdiff1d(cells, known, assume_unique=True)
            if len(known) + len(fresh) > SCORES_HELD:
                known, found, fresh = known[:0], found[:0], cells
            if len(fresh):
                known, found = np.concatenate([known, fresh]), np.concatenate([found, scores([fresh])])
                order = known.argsort()
                known, found = known[order], found[order]
            yield pd.Series(found[np.searchsorted(known, cells)][at])

    placed, key = with_cells(filled, cuts)
    return placed.withColumn("_p", p_fraud(*key)).select(*back, F.col("_p").alias("p_fraud"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    model = PipelineModel.load(path)
    check_feature_order(model)
    return model


def save_artifacts(model: PipelineModel, profiles: DataFrame, tau: float, path: str) -> None:
    """What scoring needs, in one folder: model, profiles and threshold."""
    save_model(model, f"{path}/model")
    profiles.write.mode("overwrite").parquet(f"{path}/profiles")
    one = profiles.sparkSession.range(1).select(F.lit(float(tau)).alias("tau"))
    one.write.mode("overwrite").parquet(f"{path}/tau")


def load_artifacts(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame, float]:
    return (load_model(f"{path}/model"), spark.read.parquet(f"{path}/profiles"),
            spark.read.parquet(f"{path}/tau").first()["tau"])


# ---------------------------------------------------------------- evaluation

def score_histogram(scored: DataFrame, score_col: str = "p_fraud",
                    label_col: str = LABEL) -> DataFrame:
    """(distinct score, positives, negatives), scores as they are."""
    return (scored.filter(F.col(score_col).isNotNull())
            .groupBy(F.col(score_col).alias("threshold"))
            .agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).cast("long").alias("neg")))


def _range_number(score: Column, cuts: list[float]) -> Column:
    """How many of the sorted cuts lie below the score, by binary search in one expression."""
    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(score > F.lit(cuts[mid]), between(mid + 1, hi)).otherwise(between(lo, mid))
    return between(0, len(cuts))


def score_points(scored: DataFrame, score_col: str = "p_fraud", label_col: str = LABEL) -> DataFrame:
    """Per distinct score (threshold): pos and neg of it, tp and fp at or above it, P and N in all.

    The running sums are taken in two levels, so that no task orders all scores: score ranges
    cut at approximate quantiles (as many as there are shuffle partitions), one row of totals
    per range, and a running sum inside each range. `scored` is read twice."""
    spark = scored.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    probs = [k / parts for k in range(1, parts)]
    cuts = sorted(set((scored.agg(F.percentile_approx(score_col, probs, 10_000)).first()[0] or []) if probs else []))
    hist = score_histogram(scored, score_col, label_col).withColumn("part", _range_number(F.col("threshold"), [float(c) for c in cuts]))
    higher = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = hist.groupBy("part").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    ranges = ranges.select("part", F.coalesce(F.sum("rp").over(higher), F.lit(0)).alias("tp0"),
                           F.coalesce(F.sum("rn").over(higher), F.lit(0)).alias("fp0"),
                           F.sum("rp").over(Window.partitionBy()).alias("P"), F.sum("rn").over(Window.partitionBy()).alias("N"))
    down = Window.partitionBy("part").orderBy(F.col("threshold").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (hist.join(ranges, "part")
            .select("threshold", "pos", "neg", (F.col("tp0") + F.sum("pos").over(down)).cast("long").alias("tp"),
                    (F.col("fp0") + F.sum("neg").over(down)).cast("long").alias("fp"), "P", "N"))


def threshold_curve(scored: DataFrame, score_col: str = "p_fraud",
                    label_col: str = LABEL) -> DataFrame:
    """Per distinct score: tp, fp (score >= threshold), precision, recall, f1
    (0 when precision + recall = 0), and the previous (next higher) threshold's recall."""
    c = score_points(scored, score_col, label_col)
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    def recall(tp):
        return F.when(F.col("P") > 0, tp / F.col("P")).otherwise(F.lit(0.0))
    c = (c.withColumn("precision", precision).withColumn("recall", recall(F.col("tp")))
          .withColumn("prev_recall", recall(F.col("tp") - F.col("pos"))))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return c.withColumn("f1", f1).select("threshold", "tp", "fp", "precision", "recall", "f1", "prev_recall")


def areas(points: DataFrame) -> DataFrame:
    """One row: roc_auc and pr_auc from `score_points`; NULL where a class is missing.

    ROC: the chance that a positive row scores above a negative one, ties half - a rank sum, exact in decimals. PR: trapezoids over
    recall between neighbouring thresholds; left of the highest one its own precision holds. Both are sums over
    rows that carry their running totals: no task orders the scores."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    won = F.sum((wide("neg") * (2 * wide("tp") - wide("pos"))).cast("decimal(38,0)"))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before_tp, before_all = F.col("tp") - F.col("pos"), F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    left = F.when(before_all > 0, before_tp / F.when(before_all > 0, before_all)).otherwise(precision)
    area = F.sum(F.col("pos") * (precision + left) / 2)
    p, n = F.max("P"), F.max("N")
    return points.agg(F.when((p > 0) & (n > 0), won.cast("double") / (2.0 * p * n)).alias("roc_auc"),
                      F.when(p > 0, area / p).alias("pr_auc"))


def pick_tau(curve: DataFrame) -> DataFrame:
    """One row: the threshold with the highest F1 (lowest threshold on ties)."""
    best = curve.agg(F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                              F.struct(F.col("f1"), -F.col("threshold"))).alias("b"))
    return best.select(F.col("b.threshold").alias("tau"), "b.precision", "b.recall", "b.f1")


def average_precision(curve: DataFrame) -> DataFrame:
    """One row: step-wise area under the precision-recall curve,
    sum of (recall_k - recall_{k-1}) * precision_k over descending thresholds."""
    return curve.agg(F.sum((F.col("recall") - F.col("prev_recall")) * F.col("precision"))
                     .alias("average_precision"))


def evaluate(scored: DataFrame, score_col: str = "p_fraud", label_col: str = LABEL) -> dict:
    """PR-AUC (trapezoid) and ROC-AUC, plus step-wise average
    precision and the F1-best threshold."""
    curve = threshold_curve(scored, score_col, label_col)
    area = areas(score_points(scored, score_col, label_col)).first()
    return {"pr_auc_trapezoid": area.pr_auc, "roc_auc": area.roc_auc, "average_precision": average_precision(curve).first()[0],
            **pick_tau(curve).first().asDict()}


def model_scorer(model: PipelineModel, profiles: DataFrame):
    """Scorer for the streaming job (R4): enriched rows -> rows with the nine
    features and `p_fraud`. Profiles are a static table joined to the stream."""
    from tripwire.operators.features import add_features
    check_feature_order(model)

    def score(enriched: DataFrame) -> DataFrame:
        return add_p_fraud(add_features(enriched, profiles), model)
    return score
