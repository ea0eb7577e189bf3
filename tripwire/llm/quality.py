"""Quality classifier by co-training of two views.

View "text": what the characters and words of a document look like. View "metadata":
length, layout in lines, language and source. Each view has its own logistic
regression. In every round each classifier labels the unlabelled rows it is surest of
and hands them to the other one; the classifiers are fitted again. On labelled rows set
aside, each view is calibrated (Platt) and the two calibrated log odds are combined by
a logistic regression; every document gets the combined score.

Fitting uses at most FIT_ROWS labelled rows, chosen by a hash of the id (a bounded
sample, the only one), and all unlabelled rows: each round reads them for the confidence
limits and once per Newton step, and sums over partitions reach the driver. Features and scores
cover every document and its whole text.

Defined results: null or empty text has all text features 0. Null language, source and length
are values of their own. Null ids score as others. Repeated rows score alike. Without labels of
both kinds every score is 1 (nothing is known against a document). An empty table gives
an empty table. Only the named columns are read.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.llm.common import beside, broadcast_if_small, drop_path, free_name, position, scratch, stored

FIT_ROWS = 20_000
ROUNDS = 4
TAKEN = 0.05               # share of the unlabelled rows handed over by a view and round
SURE = 0.95                # least probability of a pseudo-label
BUCKETS = 16               # hashed sources
STEPS = 10                 # most Newton steps of a round
SUM_GROUPS = 32            # groups of partial sums that are added up first
BINS, BIN = 600, 0.1       # of the log odds above SURE, for the confidence limits

TEXT_FEATURES = ("symbols", "capitals", "digits", "exclamations", "bars", "word_variety",
                 "word_length", "line_variety", "empty", "rare_letters")
META_FEATURES = ("log_chars", "log_lines", "line_chars", "no_chars",
                 "lang_en", "lang_de", "lang_fr", "lang_es", "lang_other",
                 *(f"source_{k}" for k in range(BUCKETS)))

_ASCII = bytes(range(128))
_SYMBOLS = bytes(c for c in _ASCII if chr(c) in "*#$%&@^~=+<>{}[]\\/_")
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_VIEW = pa.list_(pa.float32())
_FEATURES = pa.schema([("doc_id", pa.int64()), ("text_view", _VIEW), ("meta_view", _VIEW)])


def text_view(text: str | None) -> list[float]:
    """Shares of characters, words and lines; all in 0 to 1 or small numbers."""
    if not text or not text.strip():
        return [0.0] * 8 + [1.0, 0.0]
    data = text.encode("utf-8", "surrogatepass")
    n = len(data)
    def share(chars: bytes) -> float:
        return (n - len(data.translate(None, chars))) / n
    words, lines = text.split(), text.split("\n")
    capitals = share(_CAPITALS) if text.isascii() else sum(map(str.isupper, text)) / len(text)
    # Variety falls with length by itself: compare distinct words with a root of the count.
    return [share(_SYMBOLS), capitals, share(_DIGITS), share(b"!"), share(b"|"),
            math.log(len(set(words)) + 1) / math.log(len(words) + 2),
            min(n / len(words), 40) / 10, len(set(lines)) / len(lines), 0.0,
            share(b"qxzjQXZJ")]


def meta_view(text: str | None, lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    size, lines = max(n_chars or 0, 0), (text or "").count("\n") + 1
    tongue = [0.0] * 5
    tongue[("en", "de", "fr", "es").index(lang) if lang in ("en", "de", "fr", "es") else 4] = 1.0
    origin = [0.0] * BUCKETS
    origin[zlib.crc32((source or "").encode()) % BUCKETS] = 1.0
    return [math.log1p(size) / 10, math.log(lines) / 5, min(size / lines, 5000) / 1000,
            float(n_chars is None), *tongue, *origin]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), *_views(*(b.column(i).to_pylist() for i in range(1, 5)))],
                                         schema=_FEATURES)


def _views(texts: list, langs: list, sources: list, sizes: list) -> list[pa.Array]:
    return [pa.array(map(text_view, texts), _VIEW), pa.array(map(meta_view, texts, langs, sources, sizes), _VIEW)]


def with_features(documents: DataFrame, name: str) -> DataFrame:
    """Every row of `documents` with its features in a struct of that name."""
    at = position(documents, "text")
    def make():
        def of(b: pa.RecordBatch) -> pa.Array:
            meta = b.column(b.num_columns - 1).flatten()
            views = _views(b.column(at).to_pylist(), *(c.to_pylist() for c in meta))
            return pa.StructArray.from_arrays(views, names=["text_view", "meta_view"])
        return of
    meta = F.struct(*_meta(documents))
    kind = T.StructType([T.StructField(c, T.ArrayType(T.FloatType())) for c in ("text_view", "meta_view")])
    given = free_name(documents, f"{name}_of")
    return beside(documents.withColumn(given, meta), name, kind, make).drop(given)


def _meta(d: DataFrame) -> list[F.Column]:
    return [d["lang"].cast("string").alias("lang"), d["source"].cast("string").alias("source"),
            d["n_chars"].cast("long").alias("n_chars")]


class Logistic:
    """Ridge logistic regression on standardised columns, by Newton steps."""

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, mean=None, scale=None) -> Logistic:
        self.mean, self.scale = (x.mean(0), x.std(0) + 1e-3) if mean is None else (mean, scale)
        self.w = np.zeros(x.shape[1] + 1)
        for _ in range(30):
            if self.step(self.sums(x, y, weight)) < 1e-6:
                break
        return self

    def sums(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Gradient and Hessian of some rows, in one array: sums of parts are those of the whole."""
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
        return np.r_[z.T @ (weight * (y - p)), ((z * (weight * p * (1 - p))[:, None]).T @ z).ravel()]

    def step(self, sums: np.ndarray) -> float:
        """One Newton step; its size."""
        n = len(self.w)
        ridge = np.full(n, 1.0)
        ridge[0] = 1e-3
        step = np.linalg.solve(sums[n:].reshape(n, n) + np.diag(ridge), sums[:n] - ridge * self.w)
        self.w = self.w + step
        return float(np.abs(step).max())

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.w[0] + (x - self.mean) / self.scale @ self.w[1:]

    def line(self) -> tuple[float, list[float]]:
        """Intercept and coefficients for unscaled columns."""
        c = self.w[1:] / self.scale
        return float(self.w[0] - c @ self.mean), [float(v) for v in c]


class Pool:
    """All unlabelled rows: two columns of features."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def sum(self, of, size: int) -> np.ndarray:
        """The sum of of(views) over batches of rows: a partial sum per task, added up on the cluster in two
        levels, always in the same order. One pass is one job, and one row reaches the driver."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for b in batches:
                if b.num_rows:
                    total += of([b.column(k).flatten().to_numpy(zero_copy_only=False).astype(float)
                                 .reshape(b.num_rows, -1) for k in (0, 1)])
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = sorted((p, s) for b in batches for p, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            if parts:
                total = np.sum([np.frombuffer(s) for _, s in parts], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([parts[0][0]]), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])
        shape = "part long, sums binary"
        sums = self.rows.mapInArrow(run, shape).repartition(SUM_GROUPS, "part").mapInArrow(add, shape) \
            .repartition(1).mapInArrow(add, shape).first()
        return np.zeros(size) if sums is None else np.frombuffer(sums["sums"]).copy()


def _moments(views: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[len(views[0])], *(m for v in views for m in (v.sum(0), (v ** 2).sum(0)))])


def handed_over(rounds: list[tuple], views: list[np.ndarray]) -> list[np.ndarray]:
    """The pseudo-labels that each view has got in the rounds so far, nan for none. A round is the
    lines of both classifiers and, for each, the least log odds for 1 and for 0."""
    got = [np.full(len(views[0]), np.nan) for _ in views]
    for lines, limits in rounds:
        for k in (0, 1):
            z, g = lines[k][0] + views[k] @ np.array(lines[k][1]), got[1 - k]
            free = np.isnan(g)
            g[free & (z >= limits[k][0])] = 1.0
            g[free & (z <= -limits[k][1])] = 0.0
    return got


_LEAST = math.log(SURE / (1 - SURE))


def _confident(rounds: list[tuple], lines: list[tuple]):
    """Unlabelled rows by log odds above SURE: for each view those for 1, then those for 0."""
    def of(views: list[np.ndarray]) -> np.ndarray:
        got, parts = handed_over(rounds, views), []
        for k in (0, 1):
            z = (lines[k][0] + views[k] @ np.array(lines[k][1]))[np.isnan(got[1 - k])]
            for odds in (z, -z):
                at = np.minimum((odds[odds >= _LEAST] - _LEAST) / BIN, BINS - 1).astype(int)
                parts.append(np.bincount(at, minlength=BINS))
        return np.concatenate(parts).astype(float)
    return of


def _limit(counts: np.ndarray, want: float) -> tuple[float, float]:
    """(log odds, rows): the surest rows, up to `want`; at least the surest bin that has any."""
    above = np.cumsum(counts[::-1])[::-1]
    if not above[0]:
        return math.inf, 0.0
    bins = np.flatnonzero(above <= want)
    first = int(bins[0]) if len(bins) and above[bins[0]] else int(np.flatnonzero(counts)[-1])
    return _LEAST + BIN * first, float(above[first])


def _steps(rounds: list[tuple], models: list[Logistic], weights: list[float]):
    def of(views: list[np.ndarray]) -> np.ndarray:
        got, parts = handed_over(rounds, views), []
        for model, v, g, weight in zip(models, views, got, weights):
            has = ~np.isnan(g)
            parts.append(model.sums(v[has], g[has], np.full(int(has.sum()), weight)))
        return np.concatenate(parts)
    return of


def co_train(views: list[np.ndarray], label: np.ndarray, pool: Pool, rounds: int = ROUNDS) -> list[Logistic]:
    """Two classifiers that exchange their surest pseudo-labels over all unlabelled rows, each
    row handed over once to each view. A pseudo-label weighs half as much as a true
    one, or less: together they weigh at most half as much as the true ones."""
    known = _moments(views)
    every = pool.sum(_moments, len(known))
    n, total, at, models = every[0], known + every, 1, []
    for v in views:
        d = v.shape[1]
        mean, square = total[at:at + d] / total[0], total[at + d:at + 2 * d] / total[0]
        scale = np.sqrt(np.maximum(square - mean ** 2, 0)) + 1e-3
        models.append(Logistic().fit(v, label, np.ones(len(label)), mean, scale))
        at += 2 * d
    done: list[tuple] = []
    has = [0.0, 0.0]
    for _ in range(rounds if n else 0):
        lines = [m.line() for m in models]
        counts = pool.sum(_confident(done, lines), 4 * BINS).reshape(2, 2, BINS)
        limits, fresh = [], 0.0
        for k in (0, 1):
            found = [_limit(counts[k][j], max(1.0, TAKEN * n * share))
                     for j, share in enumerate((label.mean(), 1 - label.mean()))]
            limits.append((found[0][0], found[1][0]))
            has[1 - k] += found[0][1] + found[1][1]
            fresh += found[0][1] + found[1][1]
        if not fresh:
            break
        done.append((lines, limits))
        weights = [0.5 * min(1.0, len(label) / h) if h else 0.0 for h in has]
        sizes = [len(m.w) + len(m.w) ** 2 for m in models]
        for _ in range(STEPS):
            parts = np.split(pool.sum(_steps(done, models, weights), sum(sizes)), [sizes[0]])
            moved = [m.step(part + m.sums(v, label, np.ones(len(label))))
                     for m, v, part in zip(models, views, parts)]
            if max(moved) < 1e-3:
                break
    return models


def fit_model(views: list[np.ndarray], label: np.ndarray, pool: Pool) -> dict | None:
    """Calibrated and combined model as plain numbers, or None without both labels."""
    aside = np.arange(len(label)) % 4 == 0
    if min((label[~aside] == v).sum() for v in (0, 1)) < 2 or min((label[aside] == v).sum() for v in (0, 1)) < 2:
        return None
    models = co_train([v[~aside] for v in views], label[~aside], pool)
    odds = []
    lines = []
    y = label[aside]
    for model, v in zip(models, views):
        platt = Logistic().fit(model.logit(v[aside])[:, None], y, np.ones(len(y)))
        a, (b,) = platt.line()
        c0, c = model.line()
        lines.append((a + b * c0, [b * x for x in c]))
        odds.append(lines[-1][0] + v[aside] @ np.array(lines[-1][1]))
    mix0, mix = Logistic().fit(np.column_stack(odds), y, np.ones(len(y))).line()
    return {"text": lines[0], "meta": lines[1], "mix": (mix0, mix)}


def _linear(view: F.Column, line: tuple[float, list[float]]) -> F.Column:
    total = F.lit(line[0])
    for k, c in enumerate(line[1]):
        total = total + F.lit(c) * view[k]
    return total


def score_quality(documents: DataFrame, labels: DataFrame, holdout: bool = False, judged: str | None = None) -> DataFrame:
    """doc_id, score (1: good), predicted, and the calibrated probability of each view, for
    every document; with `judged`, every row of `documents` as it is with a struct of score, predicted and these
    probabilities in a new column of that name. With `holdout`, labels of rows with crc32(doc_id) mod 5 = 0 are left out.

    One map pass makes the features of all documents (about 40 numbers a row, written);
    the model is fitted on a sample of labelled and all unlabelled rows; scores are column expressions. With
    `judged` the features are made again beside the rows by the pass that reads the result, so that texts are
    neither written nor shuffled; the written features go once the model is fitted."""
    d, folder = documents, scratch(documents.sparkSession, "quality")
    features = stored(d.select(d["doc_id"].cast("long").alias("doc_id"), d["text"], *_meta(d))
                      .mapInArrow(_features, "doc_id long, text_view array<float>, meta_view array<float>"), "features", folder)
    marks = (labels.select(labels["doc_id"].cast("long").alias("doc_id"),
                           labels["quality"].cast("int").alias("label"))
             .where("label IN (0, 1) AND doc_id IS NOT NULL"))
    if holdout:
        marks = marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    marks = broadcast_if_small(marks.groupBy("doc_id").agg(F.min("label").alias("label")), 32)
    by_hash = F.xxhash64("doc_id")
    known = (features.join(marks, "doc_id").withColumn("key", by_hash)
             .orderBy("key", "doc_id").limit(FIT_ROWS).collect())
    def matrices(rows):
        return [np.array([r[v] for r in rows], float).reshape(len(rows), len(names))
                for v, names in (("text_view", TEXT_FEATURES), ("meta_view", META_FEATURES))]
    model = None
    if known:
        pool = features.where("doc_id IS NOT NULL").join(marks, "doc_id", "left_anti").select("text_view", "meta_view") \
            .union(features.where("doc_id IS NULL").select("text_view", "meta_view"))
        model = fit_model(matrices(known), np.array([r.label for r in known], float),
                          Pool(stored(pool, "pool", folder)))
    if judged is not None:
        drop_path(d.sparkSession, folder)
    if model is None:
        one = F.lit(1.0)
        ones = [one.alias("score"), F.lit(1).alias("predicted"), one.alias("p_text"), one.alias("p_meta")]
        return features.select("doc_id", *ones) if judged is None else d.withColumn(judged, F.struct(*ones))
    def odds(view):
        return [_linear(view("text_view"), model["text"]).alias("t"), _linear(view("meta_view"), model["meta"]).alias("m")]
    def sigmoid(c):
        return 1 / (1 + F.exp(-c))
    def found(t, m):
        mix0, (wt, wm) = model["mix"]
        score = sigmoid(F.lit(mix0) + F.lit(wt) * t + F.lit(wm) * m)
        return [score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
                sigmoid(t).alias("p_text"), sigmoid(m).alias("p_meta")]
    if judged is None:
        return features.select("doc_id", *odds(F.col)).select("doc_id", *found(F.col("t"), F.col("m")))
    own = F.col(judged)
    return with_features(d, judged).withColumn(judged, F.struct(*odds(lambda view: own[view]))) \
        .withColumn(judged, F.struct(*found(own["t"], own["m"])))
