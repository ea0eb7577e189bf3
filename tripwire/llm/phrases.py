"""Phrase collocation mining over a corpus, counted in HAT-tries.

Phrases of one to four words are counted in three passes over the whole texts: words, pairs,
then triples and quadruples. A pass counts only phrases whose shorter parts (words, then pairs)
may have reached the least count: their hashes are in a Bloom filter of bounded size that goes to every task.
A false hit of the filter costs one row and changes no count; a phrase that reaches the least count
has no part below it, so none is missed.

In a task each language has a shallow HAT-trie over ids: hash containers (phrase -> count) lie over ranges
of the first word's id. A container that grows too large is cut in two; one that holds a
single first word bursts into a node over the next word. When a task holds too many entries, whole subtrees,
largest first, leave as runs sorted by phrase. (The first and second unit of a triple or
quadruple are pairs of words.) The runs are written to the shared folder, dealt to partitions by their first
two words, so that a very common first word spreads over many, and merged there in one sorted sweep.

Ids are local to a task; rows between tasks carry the words themselves.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwire.llm.common import drop_path, scratch, stored

#: A task keeps about so many trie entries, and per language so many words or pairs and so many that were held back (a
#: group of texts more).
MAX_ENTRIES = 800_000
MAX_UNITS, MAX_MISSES = 300_000, 100_000
#: A container of more entries bursts.
BURST = 16_384
#: Texts are cut to word ids in groups of about so many bytes; runs go out in batches of so many rows.
GROUP_BYTES = 3 * 2 ** 20
RUN_ROWS = 50_000
#: Shares in which a language's candidates are ranked first.
SHARES = 16
#: Bits of the Bloom filter per phrase, its probes, and its largest size in bits (32 MB).
BITS_PER_PHRASE, PROBES, MAX_BITS = 16, 4, 2 ** 28

# Signs that end a piece become one sign, which no word can hold; tabs become spaces.
_ENDS = b".,;:!?\n\v\f\r"
_TABLE = bytes(ord(".") if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))

RUN_SCHEMA = "lang string, phrase string, f long"
_RUN_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])


# --- the filter of frequent phrases ------------------------------------------------------

def _seed(lang: str) -> int:
    return xxhash.xxh32_intdigest(lang.encode())


def word_hash(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def chained(hashes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word, from both hashes (uint64, modulo 2^64)."""
    return hashes * np.uint64(0x9E3779B97F4A7C15) + following


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(phrases, PROBES) positions in a filter of `bits` (a power of two) positions."""
    x = hashes ^ (hashes >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    step = (x >> np.uint64(33)) | np.uint64(1)
    return ((x[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


class BloomFilter:
    """Bits as bytes; `holds` says for each hash whether its phrase may be in the set."""

    def __init__(self, bits: int, data: bytes):
        self.bits, self.data = bits, np.frombuffer(data, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = probes(hashes, self.bits)
        return ((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def frequent_filter(phrases: DataFrame) -> tuple[int, bytes]:
    """(lang, phrase) rows -> a Bloom filter of their hashes.

    Its size follows the number of phrases up to MAX_BITS; the positions are folded into
    bitmaps of 4 KB in the cluster, and only those reach the driver."""
    spark = phrases.sparkSession
    count = phrases.count()
    bits = 2 ** 15
    while bits < min(count * BITS_PER_PHRASE, MAX_BITS):
        bits *= 2

    def positions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed, h = _seed(lang), None
                for word in phrase.encode().split(b" "):
                    w = word_hash(word, seed)
                    h = w if h is None else (h * 0x9E3779B97F4A7C15 + w) % 2 ** 64
                hashes.append(h)
            at = probes(np.array(hashes, np.uint64), bits).ravel() + 1
            yield pa.record_batch([pa.array(at, pa.int64())], names=["p"])

    rows = (phrases.select("lang", "phrase").mapInArrow(positions, "p long")
            .groupBy(F.bitmap_bucket_number("p").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("b")))
    data = bytearray(max(bits // 8, 4096))
    for r in rows.toLocalIterator():
        data[(r.k - 1) * 4096:r.k * 4096] = bytes(r.b)
    return bits, bytes(data)


# --- the trie ----------------------------------------------------------------------------

#: A key is a first unit, a second one (31 bits each) and whether the second is a pair of words.
_FIRST, _SECOND = 32, 1


class _Node:
    """A trie node: its containers (Counter: key -> count) and nodes lie over ranges of one unit's
    ids, in order; `lows` holds each child's lowest key. All keys are whole ones."""

    def __init__(self, shift: int, low: int, first: Counter):
        self.shift, self.lows, self.children = shift, [low], [first]


class HatTrie:
    """Counts of keys. It begins as one hash container over all first units. A container that grows past
    `burst` entries is cut in two at a unit; one that holds a single first unit bursts into a
    node over the second unit."""

    def __init__(self, burst: int = BURST):
        self.root, self.entries, self.burst = _Node(_FIRST, 0, Counter()), 0, burst

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self._put(self.root, np.sort(keys))

    def _put(self, node: _Node, keys: np.ndarray) -> None:
        cuts = [*np.searchsorted(keys, np.array(node.lows, np.int64)).tolist(), len(keys)]
        for k in range(len(node.lows) - 1, -1, -1):  # from the end: a cut child does not move the others
            if cuts[k] == cuts[k + 1]:
                continue
            child, part = node.children[k], keys[cuts[k]:cuts[k + 1]]
            if isinstance(child, _Node):
                self._put(child, part)
                continue
            self.entries -= len(child)
            child.update(part.tolist())
            self.entries += len(child)
            self._cut(node, k)

    def _cut(self, node: _Node, k: int) -> None:
        container = node.children[k]
        if len(container) <= self.burst:
            return
        units = np.sort(np.fromiter(container, np.int64, len(container)) >> node.shift)
        if units[0] == units[-1]:
            if node.shift == _FIRST:
                child = node.children[k] = _Node(_SECOND, int(units[0]) << _FIRST, container)
                self._cut(child, 0)
            return
        middle = units[len(units) // 2]
        if middle == units[0]:
            middle = units[np.searchsorted(units, middle, "right")]
        low = int(middle) << node.shift
        node.children[k] = Counter({key: n for key, n in container.items() if key < low})
        node.children.insert(k + 1, Counter({key: n for key, n in container.items() if key >= low}))
        node.lows.insert(k + 1, low)
        self._cut(node, k + 1)
        self._cut(node, k)

    def _size(self, child) -> int:
        return sum(map(self._size, child.children)) if isinstance(child, _Node) else len(child)

    def _containers(self, child) -> Iterator[Counter]:
        if isinstance(child, _Node):
            for c in child.children:
                yield from self._containers(c)
        else:
            yield child

    def take_subtrees(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take whole subtrees below the root out, largest first, until at most `keep` entries
        stay: keys and counts."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, k in sorted(((self._size(c), k) for k, c in enumerate(self.root.children)), reverse=True):
            if self.entries <= keep:
                break
            for c in self._containers(self.root.children[k]):
                keys.append(np.fromiter(c.keys(), np.int64, len(c)))
                counts.append(np.fromiter(c.values(), np.int64, len(c)))
            self.root.children[k] = Counter()
            self.entries -= size
        return np.concatenate(keys), np.concatenate(counts)


class _Units(dict):
    """Words or pairs of words of one language in one task -> ids from 1, or 0 for those that the filter
    holds back. Of the latter at most MAX_MISSES are remembered, others are looked up again."""

    def __init__(self, bloom: BloomFilter):
        super().__init__()
        self.bloom, self.names, self.hashes = bloom, [None], np.zeros(1, np.uint64)

    def ids(self, keys: list, hashes_of) -> np.ndarray:
        """Ids of distinct keys; `hashes_of` gives the hashes of the keys at some places."""
        ids = np.fromiter(map(self.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(ids < 0)
        if len(new):
            hashes = hashes_of(new)
            held = self.bloom.holds(hashes)
            ids[new] = 0
            ids[new[held]] = np.arange(len(self.names), len(self.names) + int(held.sum()))
            self.names.extend(keys[k] for k in new[held].tolist())
            self.hashes = np.concatenate((self.hashes, hashes[held]))
            self.update((keys[k], n) for k, n in zip(new[held].tolist(), ids[new[held]].tolist()))
            room = max(MAX_MISSES - (len(self) - len(self.names) + 1), 0)
            self.update((keys[k], 0) for k in new[~held][:room].tolist())
        return ids


def _encoded(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Texts as one row of places in a list of distinct tokens; `.` ends pieces and texts, b"" is no token."""
    row = (b".".join(texts) + b".").translate(_TABLE).replace(b".", b" . ")
    tokens = pc.split_pattern(pa.array([row], pa.large_binary()), b" ").flatten().dictionary_encode()
    codes, words = tokens.indices.to_numpy(), tokens.dictionary.to_pylist()
    if b"" in words:
        codes = codes[codes != words.index(b"")]
    return codes, words


class _Counting:
    """One task's trie and units of one language: texts go in, sorted runs come out."""

    def __init__(self, lang: str, words: BloomFilter, pairs: BloomFilter | None):
        self.lang, self.seed = lang, _seed(lang)
        self.trie, self.words, self.pairs = HatTrie(), _Units(words), _Units(pairs) if pairs else None

    def add(self, texts: list[bytes]) -> None:
        """Count the pairs of words in the texts, or with a filter of pairs the triples and quadruples."""
        codes, spelt = _encoded(texts)
        known = self.words.ids(spelt, lambda at: np.array([word_hash(spelt[k], self.seed) for k in at.tolist()], np.uint64))
        for k in (b"", b"."):
            if k in spelt:
                known[spelt.index(k)] = 0
        ids = np.concatenate((known[codes], np.zeros(3, np.int64)))
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        keys = ids[at] << _FIRST | ids[at + 1] << _SECOND
        if self.pairs is None:
            self.trie.add(keys)
            return
        distinct, place = np.unique(keys, return_inverse=True)
        pairs = np.zeros(len(ids) + 2, np.int64)  # the pair that starts at a word
        pairs[at] = self.pairs.ids(distinct.tolist(), lambda new: chained(
            self.words.hashes[distinct[new] >> _FIRST], self.words.hashes[(distinct[new] & (2 ** 32 - 1)) >> _SECOND]))[place]
        three = np.flatnonzero((pairs[:-1] > 0) & (pairs[1:] > 0))
        self.trie.add(pairs[three] << _FIRST | ids[three + 2] << _SECOND)
        four = three[pairs[three + 2] > 0]
        self.trie.add(pairs[four] << _FIRST | pairs[four + 2] << _SECOND | 1)

    def crowded(self) -> bool:
        """Whether the words or pairs take too much room; the object must then go."""
        return max(len(self.words.names), len(self.pairs.names) if self.pairs else 0) > MAX_UNITS

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Subtrees as a run sorted by phrase."""
        keys, counts = self.trie.take_subtrees(keep)
        if len(keys) == 0:
            return
        words = pa.array(self.words.names, pa.binary()).cast(pa.string())
        first, second, flag = keys >> _FIRST, (keys & (2 ** 32 - 1)) >> _SECOND, keys & 1 > 0
        # Phrases are ordered by the ranks of their words; only the distinct words are compared as text.
        rank = np.empty(len(words), np.int64)
        rank[pc.sort_indices(words, null_placement="at_start").to_numpy()] = np.arange(len(words))
        if self.pairs is None:
            order = np.lexsort((rank[second], rank[first]))
            columns = [[(words, first[order]), (words, second[order])]]
            back = None
        else:
            two = np.array([0, *self.pairs.names[1:]], np.int64)
            one, other = two >> _FIRST, (two & (2 ** 32 - 1)) >> _SECOND
            pairs = pc.binary_join_element_wise(words.take(pa.array(one)), words.take(pa.array(other)), " ")
            third = np.where(flag, one[np.where(flag, second, 0)], second)
            fourth = np.where(flag, rank[other[np.where(flag, second, 0)]], -1)
            order = np.lexsort((fourth, rank[third], rank[other[first]], rank[one[first]]))
            kinds = flag[order]
            columns = [[(pairs, first[order][f]), (then, second[order][f])] for f, then in ((~kinds, words), (kinds, pairs))]
            back = np.empty(len(order), np.int64)   # where each phrase stands in both kinds put together
            back[np.concatenate((np.flatnonzero(~kinds), np.flatnonzero(kinds)))] = np.arange(len(order))
        made = [pc.binary_join_element_wise(*(spelt.take(pa.array(at)) for spelt, at in c), " ") for c in columns]
        phrases = made[0] if back is None else pa.concat_arrays(made).take(pa.array(back))
        totals = pa.array(counts[order])
        for lo in range(0, len(phrases), RUN_ROWS):
            part = phrases[lo:lo + RUN_ROWS]
            yield pa.record_batch([pa.array([self.lang] * len(part), pa.string()), part, totals[lo:lo + RUN_ROWS]], schema=_RUN_ARROW)


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, texts) groups of at most about GROUP_BYTES (one text may be longer)."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
        text = text.as_py()
        held.setdefault(lang, []).append(text)
        sizes[lang] += len(text)
        if sizes[lang] >= GROUP_BYTES:
            yield lang, held.pop(lang)
            del sizes[lang]
    yield from held.items()


def _word_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of single words: one hash container per language, spilled as sorted runs."""
    counts: dict[str, Counter] = {}

    def spill() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            words = pa.array(list(found), pa.binary()).cast(pa.string())
            n, order = pa.array(list(found.values()), pa.int64()), pc.sort_indices(words)
            for lo in range(0, len(order), RUN_ROWS):
                part = order[lo:lo + RUN_ROWS]
                yield pa.record_batch([pa.array([lang] * len(part), pa.string()), words.take(part), n.take(part)],
                                      schema=_RUN_ARROW)
        counts.clear()

    for batch in batches:
        for lang, texts in _grouped(batch):
            found = counts.setdefault(lang, Counter())
            codes, words = _encoded(texts)
            totals = dict(zip(words, np.bincount(codes, minlength=len(words)).tolist()))
            for k in (b"", b"."):
                totals.pop(k, None)
            found.update(totals)
            if sum(map(len, counts.values())) > MAX_ENTRIES:
                yield from spill()
    yield from spill()


def _phrase_runs(words, pairs=None):
    """mapInArrow function that counts pairs of words, or triples and quadruples with a filter of
    pairs; words and pairs are broadcast filters (bits, bytes)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = BloomFilter(*words.value), BloomFilter(*pairs.value) if pairs else None
        tasks: dict[str, _Counting] = {}
        for batch in batches:
            for lang, texts in _grouped(batch):
                if lang not in tasks:
                    tasks[lang] = _Counting(lang, *filters)
                tasks[lang].add(texts)
                if tasks[lang].crowded():
                    yield from tasks.pop(lang).spill(0)
                if sum(t.trie.entries for t in tasks.values()) > MAX_ENTRIES:
                    for t in tasks.values():
                        yield from t.spill(t.trie.entries // 4)
        for t in tasks.values():
            yield from t.spill(0)
    return run


def _merge_sorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (phrase, lang) -> one row per pair with the sum of the counts. Only the last
    pair of a batch waits for the next one."""
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lang, phrase = batch.column(0), batch.column(1)
        n = batch.column(2).to_numpy()
        new = np.ones(len(n), bool)
        new[1:] = (pc.not_equal(lang[1:], lang[:-1]).to_numpy(zero_copy_only=False)
                   | pc.not_equal(phrase[1:], phrase[:-1]).to_numpy(zero_copy_only=False))
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(n, starts)
        langs, phrases = lang.take(pa.array(starts)), phrase.take(pa.array(starts))
        if last is not None:
            if (langs[0].as_py(), phrases[0].as_py()) == last[:2]:
                sums[0] += last[2]
            else:
                yield pa.record_batch([pa.array([v], t) for v, t in zip(last, _RUN_ARROW.types)], schema=_RUN_ARROW)
        last = (langs[-1].as_py(), phrases[-1].as_py(), int(sums[-1]))
        if len(starts) > 1:
            yield pa.record_batch([langs[:-1], phrases[:-1], pa.array(sums[:-1])], schema=_RUN_ARROW)
    if last is not None:
        yield pa.record_batch([pa.array([v], t) for v, t in zip(last, _RUN_ARROW.types)], schema=_RUN_ARROW)


def merged(runs: DataFrame, least: int, name: str) -> DataFrame:
    """Sorted runs -> (lang, phrase, f) with f >= least, one row per phrase, written.

    The runs are written first: a lost executor costs no recount. They are dealt by language and first two words,
    sorted, merged in one sweep per partition, and deleted. (After two common words stand at most as many
    different common ones as the language has, once per task.)"""
    spark = runs.sparkSession
    path = scratch(spark, "runs")
    # Sorted phrases share their beginnings, which this encoding stores once; a dictionary would be built for nothing.
    (runs.write.option("parquet.enable.dictionary#phrase", "false").option("parquet.writer.version", "PARQUET_2_0").parquet(path))
    written = spark.read.schema(RUN_SCHEMA).parquet(path)
    # The phrase first: Spark sorts by the first bytes of the first column before it compares rows.
    counted = stored(written.repartition("lang", F.substring_index("phrase", " ", 2)).sortWithinPartitions("phrase", "lang")
                     .mapInArrow(_merge_sorted, RUN_SCHEMA).where(F.col("f") >= least), name)
    drop_path(spark, path)
    return counted


# --- the operator ------------------------------------------------------------------------

def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Documents -> (lang, n) and (lang, phrase, f) for every phrase of one to four words
    with f >= least."""
    spark: SparkSession = docs.sparkSession
    # Texts without content count nothing; a language without a name is `und`.
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").alias("text")).where("text <> ''")
    words = merged(texts.mapInArrow(_word_runs, RUN_SCHEMA), 1, "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = [words.where(F.col("f") >= least)]
    filters = [spark.sparkContext.broadcast(frequent_filter(found[0]))]
    for name in ("pairs", "longer"):
        found.append(merged(texts.mapInArrow(_phrase_runs(*filters), RUN_SCHEMA), least, name))
        if name == "pairs":
            filters.append(spark.sparkContext.broadcast(frequent_filter(found[-1])))
    return totals, found[0].union(found[1]).union(found[2])


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, absorb: int = 80) -> DataFrame:
    """Documents (text, lang) -> lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases.

    Texts lose A-Z capitals, fall into pieces at `.,;:!?` and line ends, and into words at spaces and tabs. A candidate is a
    phrase of two to four words that occurs a >= least times. A cut after its first k words has
    l occurrences of the first part, r of the rest, and the score floor(2000000 a / (l + r)); the lowest
    cut counts, ties to the smallest k. A candidate goes if it lies inside a longer candidate with
    100 f >= absorb a. Order: score and a descending, phrase ascending by bytes. The score is a decimal
    division, exact beyond 64 bits.

    Null and empty texts have no words; a null language is `und`; repeated rows count each time; a text
    without a break is one piece; no documents give no rows; other columns play no part."""
    totals, counts = phrase_counts(docs, least)
    words = F.split("phrase", " ")
    parts = counts.select("lang", "phrase", "f", words.alias("w"), F.size(words).alias("k"))
    candidates = parts.where("k >= 2")

    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = (candidates.select("lang", "phrase", "w", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .select("lang", "phrase", "a", "cut", part(1, F.col("cut")).alias("head"),
                    part(F.col("cut") + 1, F.size("w") - F.col("cut")).alias("tail")))
    side = lambda key, name: counts.select("lang", F.col("phrase").alias(key), F.col("f").alias(name))
    scored = (cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"])
              .withColumn("score", F.expr("(2000000 * cast(a AS decimal(20, 0))) div (cast(l AS decimal(20, 0)) + r)")))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.min("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    inside = (candidates.where("k >= 3")
              .select("lang", "f", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
              .select("lang", "f", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
              .groupBy("lang", part(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("f").alias("longer")))
    kept = (lowest.join(inside, ["lang", "phrase"], "left")
            .where(F.expr(f"longer IS NULL OR 100 * cast(longer AS decimal(20, 0)) < {int(absorb)} * cast(a AS decimal(20, 0))")))
    # First within SHARES shares of a language, so that at most SHARES * top rows of it meet in one task.
    by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    best = (kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*by))).where(F.col("rank") <= top))
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")).where(F.col("rank") <= top)
            .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents WHERE text <> ''),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
q AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM q),
g AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM s),
c AS (SELECT lang, w[i:i + k - 1] AS ws, k, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
o AS (SELECT lang, ws, k, f, array_to_string(ws, ' ') AS phrase FROM c WHERE f >= 30),
cand AS (SELECT * FROM o WHERE k >= 2),
cut AS (SELECT lang, ws, k, f, phrase, unnest(range(1, k)) AS x FROM cand),
sc AS (SELECT cut.lang, cut.phrase, cut.f AS a, x, hl.f AS l, hr.f AS r,
    ((2000000::HUGEINT * cut.f) // (hl.f + hr.f))::BIGINT AS score
  FROM cut JOIN o hl ON hl.lang = cut.lang AND hl.phrase = array_to_string(cut.ws[1:x], ' ')
  JOIN o hr ON hr.lang = cut.lang AND hr.phrase = array_to_string(cut.ws[x + 1:cut.k], ' ')),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, x) = 1),
sub AS (SELECT lang, f, ws, k, unnest(range(2, k)) AS m FROM cand WHERE k >= 3),
sub2 AS (SELECT lang, f, ws, m, unnest(range(1, k - m + 2)) AS b FROM sub),
big AS (SELECT lang, array_to_string(ws[b:b + m - 1], ' ') AS phrase, max(f) AS longer FROM sub2 GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN big USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT r.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
