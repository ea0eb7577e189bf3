"""Exact top-k by inner product: ball trees and branch and bound.

Vectors are dealt by a hash of the id to shards of about SHARD_ROWS; a shard becomes one
row: its vectors in the order of a ball tree's leaves, and the tree (centre, radius,
smallest id of each node). Queries are packed into blocks of BLOCK_QUERIES. First every
block searches one shard, which gives each query a k-th score; then it searches all other
shards, starting from that score. In a shard, nodes wait in a heap ordered by the
largest upper bound (q . centre + |q| * radius) among the block's queries; a
node is left out for every query whose current k-th result it cannot beat. Per query
and shard k rows go on to the last merge.

Scores are exact integers: components are floor(SCALE * x); products are summed in
doubles where the sizes prove the sums exact, otherwise in Python integers.

Defined results: null vectors and vectors with null or non-finite components take no part.
Vectors of different lengths have no inner product and do not meet. Rows that repeat an id
count once (the largest vector); a query never meets its own id. Null ids take no
part. Fewer candidates than k give fewer rows; an empty table gives none. Equal scores
are ordered by id. Only the named columns are read.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.common import broadcast_if_small, stored

SCALE = 64
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
LEAF_ROWS = 64

_PACKED = "dim int, shard int, ids binary, vectors binary"
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_LIMIT = 2.0 ** 53


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as integers; null where a component is null
    or not finite. Finite components beyond 64-bit integers are an error: no score of theirs could be told."""
    parts = embedding.cast("array<double>")
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    def whole(x):
        scaled = x * scale
        return F.when(F.abs(scaled) < 2.0 ** 62, F.floor(scaled).cast("long")).otherwise(
            F.raise_error(F.lit("a vector component is too large for a 64-bit score")).cast("long"))
    return F.when(embedding.isNotNull() & fine & (F.size(embedding) > 0), F.transform(parts, whole))


def _pack(df: DataFrame, group: list[str]) -> DataFrame:
    """(dim, shard) groups -> ids and vectors as binary columns, sorted by id."""
    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             "vectors": [np.stack(pdf["v"].to_list()).astype(np.int64).tobytes()]})
    return df.groupBy(*group).applyInPandas(pack, _PACKED)


class BallTree:
    """Nodes in arrays: split at the median of the projection on the line between two
    far points; leaves are ranges of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order, self.children, spans = np.arange(len(ids)), [], []
        x = vectors.astype(np.float64)

        def build(lo: int, hi: int) -> int:
            node = len(spans)
            spans.append((lo, hi))
            self.children.append(None)
            if hi - lo > LEAF_ROWS:
                rows = order[lo:hi]
                p = x[rows]
                a = p[np.argmax(((p - p.mean(0)) ** 2).sum(1))]
                b = p[np.argmax(((p - a) ** 2).sum(1))]
                if (a != b).any():
                    order[lo:hi] = rows[np.argsort(p @ (b - a), kind="stable")]
                mid = (lo + hi) // 2
                self.children[node] = (build(lo, mid), build(mid, hi))
            return node
        build(0, len(ids))
        self.ids, self.vectors, self.spans = ids[order], vectors[order], spans
        parts = [x[order[lo:hi]] for lo, hi in spans]
        self.centre = np.stack([p.mean(0) for p in parts])
        self.radius = np.array([np.sqrt(((p - c) ** 2).sum(1).max()) for p, c in zip(parts, self.centre)])
        self.least_id = np.array([self.ids[lo:hi].min() for lo, hi in spans])


def search(tree: BallTree, query_ids: np.ndarray, queries: np.ndarray, k: int,
           score: np.ndarray, ids: np.ndarray) -> None:
    """Improve score and ids (queries x k, best first; unused places hold the least integer
    and the largest id) by the tree's vectors."""
    q = queries.astype(np.float64)
    exact = np.abs(q).max(initial=0) * np.abs(tree.vectors.astype(np.float64)).max(initial=0) * q.shape[1] < _LIMIT
    left, right = (q, tree.vectors.astype(np.float64)) if exact else (queries.astype(object), tree.vectors.astype(object))
    norm = np.sqrt((q ** 2).sum(1))

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        b = q[rows] @ tree.centre[node] + norm[rows] * tree.radius[node]
        return b + np.abs(b) * 1e-9 + 1e-6          # rounding never lowers a bound

    def open_rows(node: int, rows: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Queries whose k-th result a vector of the node could beat."""
        kth = score[rows, -1]
        return (b >= kth) & ((np.floor(b) > kth) | (tree.least_id[node] < ids[rows, -1]))

    everyone = np.arange(len(query_ids))
    first = bound(0, everyone)
    heap = [(-first.max(initial=-np.inf), 0, everyone, first)]
    while heap:
        _, node, rows, b = heapq.heappop(heap)
        keep = open_rows(node, rows, b)             # the k-th scores may have risen since
        rows = rows[keep]
        if not len(rows):
            continue
        if tree.children[node] is not None:
            for child in tree.children[node]:
                b = bound(child, rows)
                keep = open_rows(child, rows, b)
                if keep.any():
                    heapq.heappush(heap, (-b[keep].max(), child, rows[keep], b[keep]))
            continue
        lo, hi = tree.spans[node]
        found = left[rows] @ right[lo:hi].T
        names = np.broadcast_to(tree.ids[lo:hi], found.shape)
        own = names == query_ids[rows][:, None]
        found[own] = 0              # no result, and its square may be too large
        found = found.astype(np.int64)
        better = ((found > score[rows, -1:]) | (found == score[rows, -1:]) & (names < ids[rows, -1:])) & ~own
        changed = better.any(1)
        rows = rows[changed]
        s = np.concatenate([score[rows], np.where(own[changed], np.iinfo(np.int64).min, found[changed])], 1)
        n = np.concatenate([ids[rows], np.where(own[changed], np.iinfo(np.int64).max, names[changed])], 1)
        by_id = np.argsort(n, axis=1, kind="stable")
        s, n = np.take_along_axis(s, by_id, 1), np.take_along_axis(n, by_id, 1)
        best = np.argsort(-s.astype(np.float64) if exact else ~s, axis=1, kind="stable")[:, :k]
        score[rows], ids[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(n, best, 1)


def _search_pairs(k: int):
    """Rows (shard's ids and vectors, block's ids, vectors and k-th results) -> found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, of = None, None
        for b in batches:
            for r in range(b.num_rows):
                dim, shard = b.column("dim")[r].as_py(), b.column("shard")[r].as_py()
                if of != (dim, shard):
                    ids = np.frombuffer(b.column("ids")[r].as_py(), np.int64)
                    tree = BallTree(ids, np.frombuffer(b.column("vectors")[r].as_py(), np.int64).reshape(len(ids), dim))
                    of = (dim, shard)
                names = np.frombuffer(b.column("query_ids")[r].as_py(), np.int64)
                queries = np.frombuffer(b.column("queries")[r].as_py(), np.int64).reshape(len(names), dim)
                score = np.full((len(names), k), np.iinfo(np.int64).min)
                best = np.full((len(names), k), np.iinfo(np.int64).max)
                kth = b.column("kth_scores")[r].as_py()
                if kth is not None:             # the shared k-th result: ties still compete
                    score[:, -1] = np.frombuffer(kth, np.int64)
                    best[:, -1] = np.frombuffer(b.column("kth_ids")[r].as_py(), np.int64)
                    score[:, :-1], best[:, :-1] = score[:, -1:], best[:, -1:]
                    limit = (score[:, -1].copy(), best[:, -1].copy())
                search(tree, names, queries, k, score, best)
                fresh = best != np.iinfo(np.int64).max
                if kth is not None:             # what stands for the known k-th is known elsewhere
                    fresh &= ~((score == limit[0][:, None]) & (best == limit[1][:, None]))
                at, place = np.nonzero(fresh)
                yield pa.RecordBatch.from_arrays([pa.array(names[at]), pa.array(best[at, place]),
                                                  pa.array(score[at, place])], schema=_FOUND)
    return run


def _kth_of_blocks(k: int):
    """One block's queries and their results so far -> the block with its k-th results."""
    def run(key, blocks: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return pd.DataFrame(columns=["dim", "block", "home", "query_ids", "queries", "kth_scores", "kth_ids"])
        names = np.frombuffer(blocks["query_ids"].iloc[0], np.int64)
        score = np.full(len(names), np.iinfo(np.int64).min)
        ids = np.full(len(names), np.iinfo(np.int64).max)
        f = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        f = f[f.groupby("query_id").cumcount() == k - 1]
        at = np.searchsorted(names, f["query_id"].to_numpy(np.int64))
        score[at], ids[at] = f["score"].to_numpy(np.int64), f["vec_id"].to_numpy(np.int64)
        return blocks.assign(kth_scores=score.tobytes(), kth_ids=ids.tobytes())[
            ["dim", "block", "home", "query_ids", "queries", "kth_scores", "kth_ids"]]
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = SCALE,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each query row."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), quantised(vectors[vector_col], scale).alias("v"),
                          is_query.alias("q")).where("v IS NOT NULL AND vec_id IS NOT NULL") \
        .groupBy("vec_id").agg(F.max("v").alias("v"), F.max("q").alias("q"))
    rows = stored(rows.withColumn("dim", F.size("v")), "balls")
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"),
                                    F.ceil(F.sum(F.col("q").cast("int")) / BLOCK_QUERIES).cast("int").alias("blocks"))
    sizes = broadcast_if_small(sizes, 16)    # one row per vector length
    rows = rows.join(sizes, "dim")
    def dealt(salt, n):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.greatest(F.col(n), F.lit(1))).cast("int")
    shards = stored(_pack(rows.select("dim", dealt(1, "shards").alias("shard"), "vec_id", "v"), ["dim", "shard"]), "shards")
    blocks = _pack(rows.where("q").select("dim", dealt(2, "blocks").alias("shard"), "vec_id", "v"), ["dim", "shard"]) \
        .select("dim", F.col("shard").alias("block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")) \
        .join(sizes, "dim") \
        .withColumn("home", F.pmod("block", "shards").cast("int"))
    blocks = stored(blocks, "blocks")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    def searched(pairs):
        meet = pairs.join(shards, ["dim", "shard"]).select(
            "dim", "shard", "ids", "vectors", "query_ids", "queries", "kth_scores", "kth_ids")
        return meet.mapInArrow(_search_pairs(k), "query_id long, vec_id long, score long")
    none = F.lit(None).cast("binary")
    first = stored(searched(blocks.select("dim", F.col("home").alias("shard"), "query_ids", "queries",
                                          none.alias("kth_scores"), none.alias("kth_ids"))), "ball-first")
    places = rows.where("q").select("dim", dealt(2, "blocks").alias("block"), F.col("vec_id").alias("query_id"))
    known = blocks.drop("shards", "blocks").groupBy("dim", "block").cogroup(
        first.join(places, "query_id").groupBy("dim", "block")).applyInPandas(
        _kth_of_blocks(k), "dim int, block int, home int, query_ids binary, queries binary, "
                           "kth_scores binary, kth_ids binary")
    others = known.join(sizes, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "home", "query_ids", "queries",
        "kth_scores", "kth_ids").where("shard <> home")
    found = first.union(searched(others.repartition(parts, "dim", "shard")))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")


#: DuckDB SQL of the digest query (components as doubles, times 64, rounded down).
ORACLE_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM (SELECT * FROM e WHERE vec_id % 20 = 0) q JOIN e c ON c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
