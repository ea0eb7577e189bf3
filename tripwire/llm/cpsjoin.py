"""MinHash near-duplicates: chosen-path set similarity join.

A document is the set of its word shingles (64-bit hashes). Documents with equal sets form
one class, pre-aggregated, and only one member of a class goes on.

Join. POSITIONS minwise tokens are computed for each class. In every one of several
independent trees, a node chooses one position (sometimes two, SECOND of the time) by its
own seeded hash and branches its documents by their tokens there. A node
with at most NODE_ROWS documents is compared exhaustively on 256-bit sketches; a larger
one branches on, up to `depth` times. A pair of similarity s stays together in one
branching with probability about s * (1 + SECOND), so that few trees suffice: their number
follows from the target recall at the threshold (`trees_for`).
Nodes that stay large hold documents that are alike: they are compared with
a pivot first, and only what is unlike the pivot meets the rest, in blocks.

Confirmation. Candidate links form clusters (connected components); the full sets of
their members are built from the whole texts again and every link is confirmed on
them. Clusters up to CLUSTER_ROWS are solved in one task each, larger ones again by
pivot and blocks. Links inside one component need not be listed: only spanning links leave a task.
Two documents are linked when 100 * intersection >= 100 * threshold * union.

Defined results: null or empty text, or one without words, has the empty set and is linked
with nothing; fewer words than a shingle: the whole sequence is the one shingle. Rows with a null
id have component null and are kept. Repeated rows are in one class; rows that repeat an id with
other texts are judged by their own text. An empty table gives an empty table. Only the named
columns are read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import stored
from tripwire.llm.components import connected_components

POSITIONS = 128
SECOND = 0.25              # share of nodes that branch at two positions
NODE_ROWS = 48             # documents compared exhaustively in one node
BLOCK_ROWS = 1024          # documents of a block of a large node or cluster
CLUSTER_ROWS = 1024
CLUSTER_SHINGLES = 2_000_000
SLACK = 4.5                # standard deviations that a sketch may miss the threshold by
DEPTH = 6
RECALL = 0.99999

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)]


# ------------------------------------------------------------ sets and sketches

def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text. Words are
    what stands between space, tab, LF, VT, FF and CR; A-Z are lower-cased."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else ()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = (out ^ h[k:len(h) - n + 1 + k]) * _MIX[0]
            out ^= out >> np.uint64(29)
        out = out * _MIX[1]
        out ^= out >> np.uint64(32)
    return np.unique(out)


@lru_cache(1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240601)
    return (rng.integers(0, 2 ** 31, POSITIONS, np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 2 ** 32, POSITIONS, np.uint32))


def minwise_tokens(shingles: np.ndarray) -> np.ndarray:
    """The least token of a set under each of POSITIONS orders."""
    a, b = _permutations()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(POSITIONS, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(0, len(x), 2048):
            part = a[:, None] * x[None, k:k + 2048]
            part += b[:, None]
            np.minimum(least, part.min(axis=1), out=least)
    return least


def sketch(tokens: np.ndarray) -> bytes:
    """Two bits of every minwise token: 32 bytes."""
    with np.errstate(over="ignore"):
        two = ((tokens * np.uint32(2654435761)) >> np.uint32(30)).astype(np.uint64)
    return np.bitwise_or.reduce(two.reshape(4, 32) << np.arange(0, 64, 2, dtype=np.uint64), axis=1).tobytes()


_SET_ROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()),
                      ("tokens", pa.binary()), ("sketch", pa.binary())])


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, width)
                t = minwise_tokens(s) if len(s) else None
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None,
                             t.tobytes() if len(s) else None, sketch(t) if len(s) else None))
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array(c, f.type) for c, f in zip(cols, list(_SET_ROW)[1:])],
                schema=_SET_ROW)
    return run


# ------------------------------------------------------------ comparing groups

def most_mismatches(threshold: float) -> int:
    """Sketch positions that may differ for a pair at the threshold."""
    same = threshold + (1 - threshold) / 4
    return int(POSITIONS * (1 - same + SLACK * math.sqrt(same * (1 - same) / POSITIONS)))


def trees_for(recall: float, threshold: float, depth: int) -> int:
    """Trees that find a pair at the threshold with this probability."""
    p = 1.0
    for _ in range(depth):
        x = threshold * p
        p = (1 - SECOND) * x + SECOND * (1 - (1 - x) ** 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def similar_pairs(sketches: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                  most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i < j) of one group each whose sketches (n x 4 words) nearly agree.
    Groups of one size are compared together, at one distance of rows at a time."""
    low = np.uint64(0x5555555555555555)
    left, right = [], []
    for m in np.unique(sizes):
        rows = starts[sizes == m][:, None] + np.arange(m)
        for block in np.array_split(rows, max(1, rows.size // 60_000)):
            s = sketches[block]
            for d in range(1, m):
                x = s[:, :-d] ^ s[:, d:]
                far = np.bitwise_count((x | x >> np.uint64(1)) & low).sum(axis=2, dtype=np.int32)
                g, k = np.nonzero(far <= most)
                left.append(block[g, k])
                right.append(block[g, k + d])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if np.array_equal(root, before):
            return root


def _whole_groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """Batches sorted by an integer column, re-cut so that no value spans two of them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(column).to_numpy()
        first = int(np.searchsorted(keys != keys[-1], False)) if keys[0] == keys[-1] else \
            int(np.flatnonzero(keys != keys[-1])[-1]) + 1
        same = held and held[-1].column(column)[-1].as_py() == keys[0]
        if first == 0 and same:
            held.append(b)
            continue
        if held and not same:
            yield pa.Table.from_batches(held)
            held = []
        if first:
            yield pa.Table.from_batches([*held, b.slice(0, first)])
            held = []
        held.append(b.slice(first))
    if held:
        yield pa.Table.from_batches(held)


def _words(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4)


_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _group_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return starts, np.diff(np.r_[starts, len(keys)])


def _compare_nodes(most: int):
    """(node, vertex, sketch) sorted by node -> spanning links of similar documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, 0):
            starts, sizes = _group_bounds(t.column(0).to_numpy())
            vertex = t.column(1).to_numpy()
            left, right = similar_pairs(_words(t.column(2)), starts, sizes, most)
            root = _roots(len(vertex), left, right)
            rows = np.flatnonzero(vertex[root] != vertex)
            yield pa.RecordBatch.from_arrays([pa.array(vertex[rows]), pa.array(vertex[root[rows]])],
                                             schema=_EDGE)
    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirm_groups(most: int, percent: int):
    """(group, vertex, sketch, shingles) sorted by group -> spanning confirmed links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, 0):
            starts, sizes = _group_bounds(t.column(0).to_numpy())
            vertex = t.column(1).to_numpy()
            left, right = similar_pairs(_words(t.column(2)), starts, sizes, most)
            root = list(range(len(vertex)))
            sets: dict[int, np.ndarray] = {}

            def top(k):
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            def shingles(k):
                if k not in sets:
                    sets[k] = np.frombuffer(t.column(3)[k].as_py(), np.uint64)
                return sets[k]

            order = np.lexsort((right, left))
            us, vs = [], []
            for i, j in zip(left[order].tolist(), right[order].tolist()):
                a, b = top(i), top(j)
                if a != b and _linked(shingles(i), shingles(j), percent):
                    root[max(a, b)] = min(a, b)
                    us.append(vertex[i])
                    vs.append(vertex[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())],
                                             schema=_EDGE)
    return run


def _confirm_pivot(percent: int):
    """(vertex, shingles, pivot, the pivot's shingles) -> is the vertex linked to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [_linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                  for x, y in zip(b.column("shingles"), b.column("pivot_shingles"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("grp"), b.column("vertex"), b.column("pivot"), pa.array(ok, pa.bool_())],
                names=["grp", "vertex", "pivot", "linked"])
    return run


# ------------------------------------------------------------ the trees

def _children(rows: DataFrame) -> DataFrame:
    """(node, vertex, tokens) -> (node, vertex) one level down."""
    def position(salt: int):
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(POSITIONS)).cast("int")
    two = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1000)) < int(SECOND * 1000)
    at = F.explode(F.when(two, F.array_distinct(F.array(position(1), position(2))))
                   .otherwise(F.array(position(1))))
    return rows.select("node", "vertex", "tokens", at.alias("at")).select(
        F.xxhash64("node", "at", F.expr("substring(tokens, 4 * at + 1, 4)")).alias("node"), "vertex")


def _leaves(classes: DataFrame, trees: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """(small nodes, nodes that stay large) as (node, vertex, size)."""
    roots = classes.select("vertex", "tokens", F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("tree")) \
        .select(F.xxhash64("tree", F.lit("tree")).alias("node"), "vertex", "tokens")
    level, small = _children(roots), []
    for at in range(depth):
        sizes = level.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        sized = stored(level.join(sizes, "node"), "cps-level")
        small.append(sized.where(F.col("size") <= NODE_ROWS))
        large = sized.where(F.col("size") > NODE_ROWS)
        if at == depth - 1 or large.limit(1).count() == 0:
            break
        level = _children(large.select("node", "vertex").join(classes.select("vertex", "tokens"), "vertex"))
    out = small[0]
    for df in small[1:]:
        out = out.union(df)
    return out, large


def _mismatches(a: str, b: str) -> F.Column:
    """Differing positions of two sketches, as a column expression."""
    def words(c):
        return [F.conv(F.hex(F.expr(f"substring({c}, {8 * k + 1}, 8)")), 16, -10).cast("long") for k in range(4)]
    total = F.lit(0)
    for x, y in zip(words(a), words(b)):
        x = x.bitwiseXOR(y)
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1))
                                    .bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _blocks(rows: DataFrame, rest: DataFrame, key: str) -> DataFrame:
    """Groups in which every row of `rest` (key, vertex) meets every row of its key in
    `rows`: both are dealt into blocks by a hash, and each pair of blocks is one group."""
    count = rest.groupBy(key).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("nr"))
    whole = rows.groupBy(key).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("nb"))
    sizes = count.join(whole, key)
    others = rows.columns
    def block(n):
        return F.pmod(F.xxhash64("vertex", F.lit(n)), F.col(n)).cast("int")
    def dealt(df, own, other):
        return df.join(sizes, key).select(
            *others, block(own).alias(own + "_at"),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other + "_at"))
    body = dealt(rows, "nb", "nr")
    extra = dealt(rows.join(rest, [key, "vertex"], "left_semi"), "nr", "nb")
    both = body.select(*others, "nb_at", "nr_at").union(extra.select(*others, "nb_at", "nr_at"))
    return both.withColumn(key, F.xxhash64(key, "nb_at", "nr_at")).drop("nb_at", "nr_at")


def _by_group(df: DataFrame, key: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


def _candidate_links(classes: DataFrame, trees: int, depth: int, most: int) -> DataFrame:
    small, large = _leaves(classes, trees, depth)
    short = classes.select("vertex", "sketch")
    def compare(nodes):
        return _by_group(nodes.select("node", "vertex", "sketch"), "node") \
            .mapInArrow(_compare_nodes(most), "u long, v long")
    links = compare(small.join(short, "vertex"))
    if large.limit(1).count():
        rows = stored(large.select("node", "vertex").join(short, "vertex"), "cps-large")
        pivots = rows.groupBy("node").agg(F.min(F.struct(F.xxhash64("vertex"), "vertex", "sketch")).alias("p"))
        near = rows.join(pivots, "node").select(
            "node", "vertex", F.col("p.vertex").alias("pivot"), F.col("sketch"),
            F.col("p.sketch").alias("pivot_sketch")) \
            .select("node", "vertex", "pivot", (_mismatches("sketch", "pivot_sketch") <= most).alias("near"))
        near = stored(near, "cps-pivot")
        links = links.union(near.where("near").select(F.col("vertex").alias("u"), F.col("pivot").alias("v")))
        rest = near.where("NOT near").select("node", "vertex")
        links = links.union(compare(_blocks(rows.select("node", "vertex", "sketch"), rest, "node")))
    return links


# ------------------------------------------------------------ confirmation

_CONTENT = pa.schema([("vertex", pa.int64()), ("key", pa.binary()), ("shingles", pa.binary())])


def _rebuild(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                sets = [shingle_set(x, width).tobytes() for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(xxhash.xxh3_128_digest, sets), pa.binary()),
                     pa.array(sets, pa.binary())], schema=_CONTENT)
    return run


def _confirmed_links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, width: int,
                     most: int, percent: int) -> DataFrame:
    members = stored(classes.select("vertex", "key", "first_id", "n_shingles", "sketch")
                     .join(clusters.select("vertex", F.col("root").alias("grp")), "vertex"), "cps-members")
    texts = docs.join(members.select("vertex", F.col("first_id").alias("doc_id")), "doc_id") \
        .select("vertex", "doc_id", "text")
    sets = texts.mapInArrow(_rebuild(width), "vertex long, key binary, shingles binary")
    full = members.select("grp", "vertex", "key", "sketch", "n_shingles").join(
        sets.dropDuplicates(["vertex", "key"]), ["vertex", "key"]).select("grp", "vertex", "sketch", "shingles", "n_shingles")
    full = stored(full, "cps-sets")
    sizes = members.groupBy("grp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    is_small = (F.col("n") <= CLUSTER_ROWS) & (F.col("total") <= CLUSTER_SHINGLES)
    columns = ["grp", "vertex", "sketch", "shingles"]
    def confirm(df):
        return _by_group(df.select(*columns), "grp").mapInArrow(_confirm_groups(most, percent), "u long, v long")
    links = confirm(full.join(sizes.where(~is_small).select("grp"), "grp", "left_anti"))
    if sizes.where(~is_small).limit(1).count():
        big = stored(full.join(sizes.where(~is_small).select("grp"), "grp", "left_semi").select(*columns), "cps-big")
        chosen = big.groupBy("grp").agg(F.min(F.struct(F.xxhash64("vertex"), "vertex")).alias("p")) \
            .select("grp", F.col("p.vertex").alias("vertex"))
        pivots = big.join(chosen, ["grp", "vertex"]).select(
            "grp", F.col("vertex").alias("pivot"), F.col("shingles").alias("pivot_shingles"))
        near = stored(big.join(pivots, "grp").select("grp", "vertex", "shingles", "pivot", "pivot_shingles")
                      .mapInArrow(_confirm_pivot(percent), "grp long, vertex long, pivot long, linked boolean"),
                      "cps-big-pivot")
        links = links.union(near.where("linked").select(F.col("vertex").alias("u"), F.col("pivot").alias("v")))
        links = links.union(confirm(_blocks(big, near.where("NOT linked").select("grp", "vertex"), "grp")))
    return links


def near_duplicates(documents: DataFrame, width: int = 5, threshold: float = 0.8,
                    recall: float = RECALL, depth: int = DEPTH) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that can be reached by links)
    and kept (is it the component's own) for every row."""
    percent, most = round(100 * threshold), most_mismatches(threshold)
    docs = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"])
    described = stored(docs.mapInArrow(
        _describe(width), "doc_id long, n_shingles long, key binary, tokens binary, sketch binary"), "cps-docs")
    classes = described.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("key").agg(
        F.min(F.struct("doc_id", "n_shingles", "tokens", "sketch")).alias("m")).select(
        F.xxhash64("key").alias("vertex"), "key", F.col("m.doc_id").alias("first_id"), "m.n_shingles",
        "m.tokens", "m.sketch")
    classes = stored(classes, "cps-classes")
    links = _candidate_links(classes, trees_for(recall, threshold, depth), depth, most)
    clusters = connected_components(links)
    links = _confirmed_links(docs, classes, clusters, width, most, percent)
    found = connected_components(links)
    names = classes.select("vertex", "key", "first_id").join(found, "vertex", "left") \
        .withColumn("root", F.coalesce("root", "vertex"))
    least = found.join(classes.select("vertex", "first_id"), "vertex") \
        .groupBy("root").agg(F.min("first_id").alias("least"))
    names = names.join(least, "root", "left").select(
        "key", F.coalesce("least", "first_id").alias("component"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return described.select("doc_id", "n_shingles", "key").join(names, "key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
