"""Ranked lexical search with hashed max-sketches.

The index holds a sketch per document: an array of small numbers into which every term's
frequency is folded at two hashed places, the larger one staying. A term's impact grows with its frequency, so
the maxima of frequencies are the maxima of impacts, whatever the collection's statistics turn
out to be. The lesser of a term's two places bounds its frequency from above; a sum over a query's terms
bounds the document's score. A sketch has a width in proportion to the document's distinct terms.

A search of a block of queries goes over the index three times, each time in one job:
1. exact document frequencies of the queries' terms;
2. bounds of all documents for all queries from the sketches alone; the documents of the
   highest bounds of each query are scored exactly, and the k-th of these scores is a threshold that no
   result can lie below;
3. every document whose bound reaches a query's threshold is scored exactly, in each group in descending
   order of bounds; thresholds rise with the scores found, and what lies below them is skipped.

Nothing is left out: a document is skipped for a query only where its bound is below k exact scores.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.common import batches_of, stored

#: Places of a sketch per distinct term (rounded up to a power of two), and the fewest.
PLACES_PER_TERM, LEAST_PLACES = 8, 64
#: A place holds a frequency up to 254; 255 stands for any larger one.
TOP = 255
#: A block of queries has at most so many items and bytes of text.
BLOCK_ITEMS, BLOCK_BYTES = 1000, 8 * 2 ** 20
#: Documents whose bounds are held at once.
GROUP = 1024
#: Impacts lie below this number.
SCALE = 1_000_000

# Letters and digits of ASCII and all other characters make terms; A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

INDEX_SCHEMA = "doc_id long, text string, n long, sketch binary"
_INDEX_ARROW = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n", pa.int64()), ("sketch", pa.binary())])
_DF_ARROW = pa.schema([("term", pa.string()), ("df", pa.int64())])
_HIT_SCHEMA = "item int, doc_id long, score long"
_HIT_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
_SEED_SCHEMA = "item int, row string, bound long"
_SEED_ARROW = pa.schema([("item", pa.int32()), ("row", pa.string()), ("bound", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_TABLE).split()


# --- sketches ----------------------------------------------------------------------------

def _places(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in a sketch of `width` (a power of two) places."""
    mask = np.uint64(width - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _hashes(terms: Iterable[bytes], count: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, count)


def sketch_of(terms: Counter) -> bytes:
    """Fold term frequencies into a max-sketch."""
    width = LEAST_PLACES
    while width < PLACES_PER_TERM * len(terms):
        width *= 2
    tf = np.minimum(np.fromiter(terms.values(), np.int64, len(terms)), TOP).astype(np.uint8)
    a, b = _places(_hashes(terms, len(terms)), width)
    sketch = np.zeros(width, np.uint8)
    if tf.max() == 1:
        sketch[a] = sketch[b] = 1
    else:
        np.maximum.at(sketch, a, tf)
        np.maximum.at(sketch, b, tf)
    return sketch.tobytes()


def _index_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for doc_id, text in zip(ids, texts):
                text = text.as_py()
                terms = terms_of(text)
                if terms:
                    yield doc_id.as_py(), text.decode(), len(terms), sketch_of(Counter(terms))
    return batches_of(rows(), _INDEX_ARROW)


def build_index(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) -> the written index: one row per document with a term, with the
    text for exact scores. It does not depend on queries."""
    index = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).where("text <> ''")
             .mapInArrow(_index_rows, INDEX_SCHEMA))
    # The file and the place in it name an index row for good.
    return (stored(index, "sketches")
            .select("*", F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias("row")))


# --- queries -----------------------------------------------------------------------------

class _Block:
    """Some queries, the weights of their terms and the numbers of the collection. `N` documents
    with `L` terms; `df` by term."""

    def __init__(self, items: list[bytes], df: dict[bytes, int], N: int, L: int):
        wanted = [sorted(set(terms_of(x))) for x in items]
        # Items without any term of the collection can have no result.
        wanted = [[t for t in ts if t in df] for ts in wanted]
        self.vocabulary = {t: k for k, t in enumerate(sorted({t for ts in wanted for t in ts}))}
        self.weights = np.array([math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) for t in self.vocabulary], np.int64)
        self.hashes = _hashes(self.vocabulary, len(self.vocabulary))
        self.items = np.array([k for k, ts in enumerate(wanted) if ts], np.int32)
        lists = [[self.vocabulary[t] for t in ts] for ts in wanted if ts]
        self.terms = np.array([t for ts in lists for t in ts], np.int64)
        self.starts = np.cumsum([0] + [len(ts) for ts in lists[:-1]]) if lists else np.zeros(0, np.int64)
        self.N, self.L = N, L
        self._at: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def norm(self, n: int) -> int:
        return 50 + 50 * n * self.N // self.L

    def _sums(self, tf: np.ndarray, n: int, top: bool) -> np.ndarray:
        impact = 1000 * SCALE * tf // (1000 * tf + 20 * self.norm(n))
        if top:
            impact[tf == TOP] = SCALE
        return np.add.reduceat((impact * self.weights)[self.terms], self.starts)

    def bounds(self, sketch: bytes, n: int) -> np.ndarray:
        """No item's score of the document is above its bound."""
        cells = np.frombuffer(sketch, np.uint8)
        at = self._at.get(len(cells))
        if at is None:
            at = self._at[len(cells)] = _places(self.hashes, len(cells))
        return self._sums(np.minimum(cells[at[0]], cells[at[1]]).astype(np.int64), n, True)

    def scores(self, text: bytes, n: int) -> np.ndarray:
        """Every item's exact score of the document."""
        tf = np.zeros(len(self.vocabulary), np.int64)
        known = self.vocabulary
        for term, count in Counter(terms_of(text)).items():
            k = known.get(term)
            if k is not None:
                tf[k] = count
        return self._sums(tf, n, False)


def _frequency_rows(vocabulary):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, known = Counter(), vocabulary.value
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                found.update(known.intersection(terms_of(text.as_py())))
        if found:
            yield pa.record_batch([pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())],
                                  schema=_DF_ARROW)
    return run


def _seed_rows(block, k: int):
    """Per task and item the k highest bounds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: _Block = block.value
        best = np.zeros((0, len(b.items)), np.int64)  # columns: items
        rows = np.zeros((0, len(b.items)), object)

        def merge(bounds, names):
            nonlocal best, rows
            names = np.broadcast_to(np.array(names, object)[:, None], (len(names), len(b.items)))
            best, rows = np.vstack((best, np.array(bounds))), np.vstack((rows, names))
            if len(best) > k:
                top = np.argpartition(-best, k - 1, axis=0)[:k]
                best, rows = np.take_along_axis(best, top, 0), np.take_along_axis(rows, top, 0)

        for batch in batches:
            for lo in range(0, batch.num_rows, GROUP):
                part = batch.slice(lo, GROUP)
                merge([b.bounds(s.as_py(), n.as_py()) for s, n in zip(part.column(2), part.column(1))],
                      part.column(0).to_pylist())
        out = ((int(b.items[i]), rows[r, i], int(best[r, i])) for i in range(len(b.items)) for r in range(len(best))
               if best[r, i] > 0)
        yield from batches_of(out, _SEED_ARROW, max_rows=20_000)
    return run


def _seed_scores(block):
    """Exact scores of (doc_id, text, n, items) rows for their items."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: _Block = block.value
        place = {int(x): i for i, x in enumerate(b.items)}

        def rows():
            for batch in batches:
                for doc_id, text, n, items in zip(*(batch.column(c).to_pylist() for c in range(4))):
                    scores = b.scores(text.encode(), n)
                    for x in items:
                        yield x, doc_id, int(scores[place[x]])
        return batches_of(rows(), _HIT_ARROW, max_rows=20_000)
    return run


class _Best:
    """A task's best documents per item, starting from thresholds that hold for the whole collection."""

    def __init__(self, items: int, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.held: list[list[tuple[int, float, int | None]]] = [[] for _ in range(items)]

    def offer(self, doc_id: int | None, scores: np.ndarray) -> None:
        for i in np.flatnonzero((scores >= self.floors) & (scores > 0)).tolist():
            held = self.held[i]
            held.append((-int(scores[i]), math.inf if doc_id is None else doc_id, doc_id))
            if len(held) >= 2 * self.k:
                self._cut(i)

    def _cut(self, i: int) -> None:
        self.held[i].sort(key=lambda x: x[:2])
        del self.held[i][self.k:]
        self.floors[i] = max(self.floors[i], -self.held[i][-1][0])

    def rows(self, items: np.ndarray) -> Iterator[tuple]:
        for i, held in enumerate(self.held):
            for score, _, doc_id in sorted(held, key=lambda x: x[:2])[:self.k]:
                yield int(items[i]), doc_id, -score


def _exact_rows(block, floors, k: int):
    """Bounds first; documents that may reach a threshold are scored in descending order of how far
    their bounds pass it, and thresholds rise meanwhile."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: _Block = block.value
        best = _Best(len(b.items), k, floors.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, GROUP):
                part = batch.slice(lo, GROUP)
                ids, texts, ns, sketches = (part.column(c) for c in range(4))
                lengths = ns.to_pylist()
                bounds = np.array([b.bounds(s.as_py(), n) for s, n in zip(sketches, lengths)])
                slack = (bounds / np.maximum(best.floors, 1)).max(axis=1)
                for r in np.argsort(-slack, kind="stable").tolist():
                    if slack[r] < 1 - 1e-9:
                        break
                    if ((bounds[r] >= best.floors) & (bounds[r] > 0)).any():
                        best.offer(ids[r].as_py(), b.scores(texts[r].as_py().encode(), lengths[r]))
        yield from batches_of(best.rows(b.items), _HIT_ARROW, max_rows=20_000)
    return run


def _top(hits: DataFrame, k: int, by: str, tie: str) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc(by), F.col(tie).asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search_block(index: DataFrame, items: list[bytes], N: int, L: int, k: int) -> DataFrame:
    """One block of queries against the whole index -> item (place in the block), rank, doc_id, score."""
    spark = index.sparkSession
    share = spark.sparkContext.broadcast
    vocabulary = share({t for x in items for t in terms_of(x)})
    df = (index.select("text").mapInArrow(_frequency_rows(vocabulary), "term string, df long")
          .groupBy("term").agg(F.sum("df").alias("df")))
    # At most the terms of one block.
    block = _Block(items, {r.term.encode(): r.df for r in df.toLocalIterator()}, N, L)
    if len(block.items) == 0:
        return spark.createDataFrame([], "item int, rank int, doc_id long, score long")
    shared = share(block)
    seeds = _top(index.select("row", "n", "sketch").mapInArrow(_seed_rows(shared, k), _SEED_SCHEMA), k, "bound", "row")
    # At most k rows per item of the block: small by construction.
    by_row = F.broadcast(stored(seeds.groupBy("row").agg(F.collect_list("item").alias("items")), "seeds"))
    seeded = index.select("row", "doc_id", "text", "n").join(by_row, "row").select("doc_id", "text", "n", "items")
    kth = _top(seeded.mapInArrow(_seed_scores(shared), _HIT_SCHEMA), k, "score", "doc_id").where(F.col("rank") == k)
    floors = np.zeros(len(block.items), np.int64)
    place = {int(x): i for i, x in enumerate(block.items)}
    for r in kth.select("item", "score").toLocalIterator():
        floors[place[r.item]] = r.score
    hits = index.select("doc_id", "text", "n", "sketch").mapInArrow(_exact_rows(shared, share(floors), k), _HIT_SCHEMA)
    return _top(hits, k, "score", "doc_id").select("item", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """Documents (doc_id, text) and queries (item_id, text) -> item_id, rank, doc_id, score: each
    query's k highest scores above 0, equal ones by ascending doc_id.

    Terms are runs of ASCII letters and digits and characters beyond ASCII, A-Z lower-cased. N documents have a term, L
    terms in all; a term in df documents weighs floor(1000 ln((2N + 2) / (2 df + 1))); with n terms in a document,
    m = 50 + (50 n N) div L, and tf occurrences score the weight times (10^9 tf) div (1000 tf + 20 m).

    Null and empty texts have no term: such documents are in no result, such queries have none. Repeated document rows are
    documents of their own; a null doc_id stands after equal scores. Query rows equal in id and text are one query. Empty
    tables give no rows; other columns play no part."""
    spark = docs.sparkSession
    out_schema = "item_id long, rank int, doc_id long, score long"
    index = build_index(docs)
    N, L = index.agg(F.count("*"), F.sum("n")).first()
    wanted = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("text <> ''").distinct()
    count, size = wanted.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not N or not count:
        return spark.createDataFrame([], out_schema)
    # Blocks by hash; a block of two to three times the mean size still is small.
    blocks = max(-(-count // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = None
    for b in range(blocks):
        rows = wanted.where(F.col("block") == b).orderBy("item_id", "text").collect()
        if not rows:
            continue
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(rows)], "item int, item_id long")
        part = (search_block(index, [r.text.encode() for r in rows], N, L, k)
                .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        if blocks > 1:
            part = stored(part, "ranked")
        found = part if found is None else found.union(part)
    return found


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS x, doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
docs AS (SELECT x, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
c AS (SELECT count(*) AS N_, sum(n)::BIGINT AS L_ FROM docs),
tf AS (SELECT x, term, count(*) AS tf FROM (SELECT x, unnest(ts) AS term FROM docs) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * N_ + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, N_),
q AS (SELECT DISTINCT item_id, text FROM benchmark),
i AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM q),
s AS (SELECT i.item_id, i.text, docs.x, docs.doc_id,
    sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * docs.n * N_) // L_))))::BIGINT AS score
  FROM i JOIN tf ON tf.term = i.term JOIN w ON w.term = i.term JOIN docs ON docs.x = tf.x, c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, x) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""
