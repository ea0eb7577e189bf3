"""Language identification with a convolutional network over bytes.

A window of WINDOW bytes passes through an embedding of bytes, filters of several widths with ReLU, the
maximum over all places per filter, and a softmax over the languages. The network is trained in
numpy on the driver on a bounded sample of labelled texts; its weights (some KB) go to all
tasks, which read every text whole, as windows of fixed length in batches of fixed size.

A filter of width w over an embedding is a sum of w table rows: the response of byte b at offset o is the row b
of one 256-row table per offset. The forward pass looks rows up; the backward pass touches
only the places where a maximum stands.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.common import batches_of, broadcast_if_small

#: Bytes of a window; consecutive windows share the widest filter's reach, so no place is lost between two.
WINDOW = 256
#: Filter widths in bytes and filters of each width; numbers of a byte's embedding.
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4, 5), 16, 8
#: Training: at most so many texts per language, windows per text (spread over the whole text), passes,
#: (but at least so many steps on few windows), windows a step, step size, weight decay.
TEXTS_PER_LANG, WINDOWS_PER_TEXT, EPOCHS, STEPS, BATCH, RATE, DECAY = 1500, 2, 12, 400, 64, 0.004, 1e-4
SEED = 12
#: Windows that are scored at once.
SCORED = 512

_STRIDE = WINDOW - (max(WIDTHS) - 1)
_OUT = pa.schema([("row", pa.int64()), ("best", pa.int32()), ("score", pa.float64())])


# --- the network -------------------------------------------------------------------------

class ByteCnn:
    """Weights and passes of the network. Byte 0 also pads short windows; its embedding stays zero."""

    def __init__(self, classes: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.w = {"E": rng.normal(0, 0.5, (256, EMBEDDING)), "S": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes)),
                  "c": np.zeros(classes)}
        for k in WIDTHS:
            self.w[f"F{k}"] = rng.normal(0, 1 / np.sqrt(k * EMBEDDING), (k, EMBEDDING, FILTERS))
            self.w[f"b{k}"] = np.zeros(FILTERS)
        self.w["E"][0] = 0

    def _responses(self, windows: np.ndarray, width: int, tables: list[np.ndarray]) -> np.ndarray:
        """(windows, places, filters) responses before ReLU."""
        places = windows.shape[1] - width + 1
        out = tables[0][windows[:, :places]]
        for o in range(1, width):
            out += tables[o][windows[:, o:o + places]]
        return out

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Per width and offset: the response of every byte (the bias in the first)."""
        found = {}
        for k in WIDTHS:
            t = [(self.w["E"] @ self.w[f"F{k}"][o]).astype(np.float32) for o in range(k)]
            t[0] = t[0] + self.w[f"b{k}"].astype(np.float32)
            found[k] = t
        return found

    def pooled(self, windows: np.ndarray, tables, places: bool = False):
        """Maxima over places after ReLU; with `places` also where they stand."""
        tops, where = [], []
        for k in WIDTHS:
            r = self._responses(windows, k, tables[k])
            if places:
                at = r.argmax(axis=1)
                where.append(at)
                r = np.take_along_axis(r, at[:, None, :], 1)[:, 0]
            else:
                r = r.max(axis=1)
            tops.append(np.maximum(r, 0))
        return (np.concatenate(tops, 1), where) if places else np.concatenate(tops, 1)

    def logits(self, windows: np.ndarray, tables) -> np.ndarray:
        return self.pooled(windows, tables) @ self.w["S"].astype(np.float32) + self.w["c"].astype(np.float32)

    def gradients(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[dict, float]:
        """Gradients of the weighted mean cross entropy, and its value."""
        top, where = self.pooled(windows, self.tables(), True)
        p = softmax(top @ self.w["S"] + self.w["c"])
        rows = np.arange(len(labels))
        share = weights / weights.sum()
        loss = float(-(share * np.log(p[rows, labels] + 1e-12)).sum())
        d = p * share[:, None]
        d[rows, labels] -= share
        g = {"S": top.T @ d, "c": d.sum(0), "E": np.zeros_like(self.w["E"])}
        back = (d @ self.w["S"].T) * (top > 0)
        for j, k in enumerate(WIDTHS):
            db = back[:, j * FILTERS:(j + 1) * FILTERS]
            g[f"b{k}"], g[f"F{k}"] = db.sum(0), np.zeros_like(self.w[f"F{k}"])
            for o in range(k):
                read = windows[rows[:, None], where[j] + o]  # (windows, filters): the byte behind each maximum
                e = self.w["E"][read]
                g[f"F{k}"][o] = np.einsum("nfe,nf->ef", e, db)
                np.add.at(g["E"], read, db[:, :, None] * self.w[f"F{k}"][o].T[None])
        g["E"][0] = 0
        return g, loss


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, classes: int, epochs: int = EPOCHS, seed: int = SEED) -> ByteCnn:
    """Adam over shuffled batches; every language has the same total weight, whatever its share of the sample."""
    net, rng = ByteCnn(classes, seed), np.random.default_rng(seed)
    counts = np.bincount(labels, minlength=classes)
    weight = 1 / np.maximum(counts, 1)[labels]
    first, second = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    a_pass = -(-len(labels) // BATCH)
    epochs = max(epochs, -(-STEPS // a_pass))
    steps, total = 0, epochs * a_pass
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), BATCH):
            at, steps = order[lo:lo + BATCH], steps + 1
            g, _ = net.gradients(windows[at], labels[at], weight[at])
            rate = RATE * (1 - steps / (total + 1)) * np.sqrt(1 - 0.999 ** steps) / (1 - 0.9 ** steps)
            for k, v in net.w.items():
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                v -= rate * (first[k] / (np.sqrt(second[k]) + 1e-8) + DECAY * v)
            net.w["E"][0] = 0
    return net


# --- windows -----------------------------------------------------------------------------

def windows_of(text: bytes) -> np.ndarray:
    """The whole text as (count, WINDOW) bytes; the last window is padded with zero bytes."""
    count = 1 if len(text) <= WINDOW else 1 + -(-(len(text) - WINDOW) // _STRIDE)
    row = np.zeros((count - 1) * _STRIDE + WINDOW, np.uint8)
    row[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(row, WINDOW)[::_STRIDE]


def _predict_rows(net_of_task, classes: int):
    """(row, text) -> row, best class (-1 for null), its probability: mean log-probabilities of all windows of a text, weighted by their
    bytes. Windows of many texts are scored together, SCORED at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: ByteCnn = net_of_task.value
        tables = net.tables()

        def rows():
            for batch in batches:
                held, owners, weights = [], [], []
                sums, mass = np.zeros((batch.num_rows, classes)), np.zeros(batch.num_rows)

                def score():
                    x = net.logits(np.concatenate(held), tables).astype(np.float64)
                    x -= x.max(axis=1, keepdims=True)
                    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
                    w, to = np.concatenate(weights), np.concatenate(owners)
                    np.add.at(sums, to, x * w[:, None])
                    np.add.at(mass, to, w)
                    held.clear(), owners.clear(), weights.clear()

                waiting = 0
                blank = batch.column(1).is_null().to_pylist()
                for k, text in enumerate(batch.column(1).cast(pa.binary())):
                    text = text.as_py()
                    if text is None:
                        continue
                    found = windows_of(text)
                    w = np.full(len(found), float(WINDOW))
                    w[-1] = max(len(text) - (len(found) - 1) * _STRIDE, 1)
                    for lo in range(0, len(found), SCORED):
                        part = found[lo:lo + SCORED]
                        held.append(part), owners.append(np.full(len(part), k)), weights.append(w[lo:lo + SCORED])
                        waiting += len(part)
                        if waiting >= SCORED:
                            score()
                            waiting = 0
                if held:
                    score()
                p = softmax(sums / np.maximum(mass, 1)[:, None])
                best = np.where(blank, -1, p.argmax(axis=1))
                yield from zip(batch.column(0).to_pylist(), best.tolist(), np.where(blank, 0.0, p.max(axis=1)).tolist())
        return batches_of(rows(), _OUT, max_rows=10_000)
    return run


# --- the operator ------------------------------------------------------------------------

def held_out_rows(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a document may not be learned from; rows without an id are never learned from either."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def training_sample(docs: DataFrame, texts_per_lang: int = TEXTS_PER_LANG) -> DataFrame:
    """At most `texts_per_lang` distinct texts per language, drawn by a hash of the text, so that copies count once; of each text
    WINDOWS_PER_TEXT stretches of WINDOW characters, spread over the whole text."""
    known = (docs.where(F.col("doc_id").isNotNull() & ~held_out_rows(F.col("doc_id")) & F.col("lang").isNotNull() & has_letter(F.col("text")))
             .select("lang", "text").withColumn("key", F.xxhash64("text")))
    size = F.length("text")
    spread = [F.substring(F.col("text"), (F.lit(1) + F.floor(F.greatest(size - WINDOW, F.lit(0)) * (j + 0.5) / WINDOWS_PER_TEXT)).cast("int"), F.lit(WINDOW))
              for j in range(WINDOWS_PER_TEXT)]
    # First a share by hash from the number of distinct texts, about twice what is wanted, then the exact number.
    # The counts, a row per language, go to the texts: only drawn ones are shuffled.
    counts = broadcast_if_small(known.groupBy("lang").agg(F.approx_count_distinct("key").alias("texts")), 64)
    share = F.least(F.lit(1.0), F.lit(2.0 * texts_per_lang + 100) / F.col("texts"))
    drawn = (known.join(counts, "lang").where(F.pmod("key", F.lit(1 << 30)) < share * (1 << 30))
             .select("lang", "key", F.array(*spread).alias("parts")).dropDuplicates(["lang", "key"]))
    w = Window.partitionBy("lang").orderBy("key")
    return (drawn.withColumn("k", F.row_number().over(w)).where(F.col("k") <= texts_per_lang)
            .select("lang", "key", "parts"))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit_languages(docs: DataFrame, texts_per_lang: int = TEXTS_PER_LANG) -> tuple[ByteCnn | None, list[str]]:
    """The trained network and the languages it knows, in order; (None, []) without labelled texts."""
    rows = training_sample(docs, texts_per_lang).orderBy("lang", "key").collect()  # bounded by the parameter
    langs = sorted({r.lang for r in rows})
    if not langs:
        return None, []
    place, windows, labels = {v: k for k, v in enumerate(langs)}, [], []
    for r in rows:
        for part in dict.fromkeys(p for p in r.parts if p):
            windows.append(windows_of(part.encode())[0])
            labels.append(place[r.lang])
    return train(np.array(windows), np.array(labels), len(langs)), langs


def identify_languages(docs: DataFrame, texts_per_lang: int = TEXTS_PER_LANG) -> DataFrame:
    """Documents (doc_id, text, lang) -> doc_id, held_out, lang_pred, score, one row per row.

    Learns from text and lang of rows whose crc32(doc_id as text) mod 4 is not 2, at most `texts_per_lang` distinct texts per
    language; predicts every row from its whole text alone. `und` with score 0 if the text is null or
    without a letter, or if nothing could be learned. A null doc_id is not held out and not learned from; a null lang is not
    learned from; repeated rows and copies of a text get the same prediction; other columns play no part."""
    net, langs = fit_languages(docs, texts_per_lang)
    spark = docs.sparkSession
    out = ["doc_id", held_out_rows(F.col("doc_id")).alias("held_out")]
    if net is None:
        return docs.select(*out, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(net)
    named = F.array(*map(F.lit, langs))
    scored = (docs.select(F.col("doc_id").cast("long").alias("row"), F.when(has_letter(F.col("text")), F.col("text")).alias("text"))
              .mapInArrow(_predict_rows(shared, len(langs)), "row long, best int, score double"))
    return scored.select(F.col("row").alias("doc_id"), held_out_rows(F.col("row")).alias("held_out"),
                         F.when(F.col("best") >= 0, F.get(named, F.col("best"))).otherwise("und").alias("lang_pred"), "score")
