"""Toxicity scores: misspelled lexicon terms in context.

1. Lexicon. Words and word stems (prefixes of at least four characters) are counted by
   labelled documents, toxic and clean. All terms that are far more frequent in toxic ones
   than chance allows are candidates; going from the most frequent down, a candidate
   is kept if it explains LEAST_NEW distinct toxic texts in which fewer than two kept terms
   occur. (Copies of one document make all its words look toxic; they explain nothing new.)
2. Matching. The lexicon is a trie; its intersection with the Levenshtein automata
   of all its terms is walked as one deterministic automaton, whose states (sets of
   trie node and number of edits) are made when first met. Terms of five or more
   characters allow one edit, of nine or more two. Spellings that labelled clean
   documents use are ordinary words, no misspellings.
3. Context. Every hit weighs 1 (exact) or MISSPELLED; inside quotation marks it is a
   report rather than abuse and weighs QUOTED as much; other hits within WINDOW words
   raise it. The sum of a text is its mass; a logistic curve fitted on labelled rows
   turns it into a score.

Labels are read only from rows whose crc32(doc_id as text) mod 5 is not 0. The curve is
fitted on at most FIT_ROWS such rows (bounded sample, by hash); all labelled rows count
for the lexicon. Lang, source, id and label are never inputs of a score.

Defined results: null or empty text has mass 0 and gets the curve's score at 0. Null ids
score as others and have held_out null. Repeated rows score alike. Labelled rows with a null label
are ignored. Without usable labels the lexicon is empty and every score is 0. An empty table gives
an empty table. Only the named columns are read.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.llm.common import batches_of, beside, broadcast_if_small, free_name, position, stored

MIN_STEM = 4
MAX_STEM = 10
LEAST_NEW = 3              # distinct toxic texts that a term has to explain anew
TERMS_HELD = 200_000       # candidates that tasks hold as a set; more are joined
PAIRS_HELD = 2_000_000     # (text, term) pairs that the driver selects from; more in rounds
ORDINARY_HELD = 200_000    # ordinary spellings that tasks hold as a set; more are joined
FIT_ROWS = 20_000          # labelled rows (by hash) that the curve is fitted on
CHANCE = 1e-6              # of a term to be as toxic as it is by luck
WINDOW = 8
QUOTE_REACH = 40           # words between two quotation marks that count as a quotation
MISSPELLED = 0.6
QUOTED = 0.3
WORDS_KEPT = 300_000       # words a Python worker remembers as no hit

_WORD = re.compile(r"[^\W_]+")
_WORD_OR_QUOTE = re.compile(r"[^\W_]+|[\"“”„«»‹›]")
_QUOTES = frozenset("\"“”„«»‹›")
WHOLE = "$"                # marks a term that is a whole word; others are stems

_TERM = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
_PAIR = pa.schema([("doc", pa.int64()), ("term", pa.string())])
_MASS = pa.schema([("doc_id", pa.int64()), ("mass", pa.float64())])


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


# ---------------------------------------------------------------- matching

class LexiconAutomaton:
    """Trie of terms with up to 0, 1 or 2 edits by length, as a lazy automaton."""

    def __init__(self, terms: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[str, int]]] = [[]]
        for term in terms:
            node, text = 0, term.rstrip(WHOLE)
            for c in text:
                node = self.next[node].setdefault(c, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                    self.ends.append([])
            self.ends[node].append((term, self.edits(text)))
        self.most = max((e for found in self.ends for _, e in found), default=0)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state(self._closed({(0, 0)}))

    @staticmethod
    def edits(text: str) -> int:
        return 2 if len(text) >= 9 else 1 if len(text) >= 5 else 0

    def _closed(self, states: set) -> frozenset:
        """With every state reached by leaving out characters of a term."""
        todo = list(states)
        while todo:
            node, e = todo.pop()
            if e < self.most:
                for child in self.next[node].values():
                    if (child, e + 1) not in states:
                        states.add((child, e + 1))
                        todo.append((child, e + 1))
        least: dict[int, int] = {}
        for node, e in states:
            least[node] = min(e, least.get(node, e))
        return frozenset(least.items())

    def _state(self, states: frozenset) -> int:
        if states not in self.states:
            self.states[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
        return self.states[states]

    def _move(self, state: int, c: str) -> int:
        found: set = set()
        for node, e in self.sets[state]:
            if c in self.next[node]:
                found.add((self.next[node][c], e))
            if e < self.most:
                found.add((node, e + 1))
                found.update((child, e + 1) for child in self.next[node].values())
        to = self._state(self._closed(found)) if found else -1
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[str, int, str] | None:
        """(term, edits, matched spelling) of the best term: fewest edits, then longest."""
        state, best = self.start, None
        for k, c in enumerate(word, 1):
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                break
            for node, e in self.sets[state]:
                for term, allowed in self.ends[node]:
                    if e <= allowed and (k == len(word) or not term.endswith(WHOLE)):
                        key = (e, -len(term), term)
                        if best is None or key < best[0]:
                            best = (key, word[:k])
        return (best[0][2], best[0][0], best[1]) if best else None


class Matcher:
    """Finds the hits of a text; remembers words that are none."""

    def __init__(self, terms: Iterable[str], ordinary: Iterable[str] = ()):
        self.automaton = LexiconAutomaton(terms)
        self.ordinary = frozenset(ordinary)
        self.seen: set[str] = set()
        self.found: dict[str, tuple[str, int, str]] = {}

    def hits(self, text: str | None) -> dict[str, tuple[str, int, str]]:
        """The words of a text that are terms."""
        if not text:
            return {}
        words = set(_WORD.findall(text.lower()))
        new = words - self.seen
        if new:
            if len(self.seen) > WORDS_KEPT:
                self.seen = set(self.found)
            for w in new:
                hit = self.automaton.match(w)
                if hit and not (hit[1] and (w in self.ordinary or hit[2] in self.ordinary)):
                    self.found[w] = hit
            self.seen |= new
        if len(self.found) > WORDS_KEPT:
            self.found, self.seen = {}, set()
            return self.hits(text)
        return {w: self.found[w] for w in words & self.found.keys()}

    def places(self, text: str | None) -> tuple[list[tuple[int, str, str | None]], list[tuple[int, int]]]:
        """(word position, word, matched part of a misspelling) of the hits, and the quotations."""
        hits = self.hits(text)
        if not hits:
            return [], []
        place, at, marks = 0, [], []
        for token in _WORD_OR_QUOTE.findall(text.lower()):
            if token in _QUOTES:
                marks.append(place)
            else:
                if token in hits:
                    at.append((place, token, hits[token][2] if hits[token][1] else None))
                place += 1
        return at, quotations(marks)

    def mass(self, text: str | None) -> float:
        at, spans = self.places(text)
        return context_mass([(k, 1.0 if part is None else MISSPELLED) for k, _, part in at], spans)


def quotations(marks: list[int]) -> list[tuple[int, int]]:
    """Word ranges between an opening and a closing quotation mark not too far off."""
    spans, k = [], 0
    while k + 1 < len(marks):
        if marks[k + 1] - marks[k] <= QUOTE_REACH:
            spans.append((marks[k], marks[k + 1]))
            k += 2
        else:
            k += 1
    return spans


def context_mass(hits: list[tuple[int, float]], spans: list[tuple[int, int]]) -> float:
    """Sum of the hits' weights in their windows (hits ascend by word position)."""
    total, first, last, span = 0.0, 0, 0, 0
    for k, (at, weight) in enumerate(hits):
        while hits[first][0] < at - WINDOW:
            first += 1
        last = max(last, k)
        while last + 1 < len(hits) and hits[last + 1][0] <= at + WINDOW:
            last += 1
        while span < len(spans) and spans[span][1] <= at:
            span += 1
        quoted = span < len(spans) and spans[span][0] <= at
        total += weight * (QUOTED if quoted else 1.0) * (1 + 0.25 * min(3, last - first))
    return total


# ---------------------------------------------------------------- learning

def _terms_of(text: str | None) -> set[str]:
    words = set(_WORD.findall(text.lower())) if text else set()
    stems = {w[:k] for w in words for k in range(MIN_STEM, min(len(w), MAX_STEM + 1))}
    return stems | {w + WHOLE for w in words}


def _counted(batches: Iterator[pa.RecordBatch], found_in) -> Iterator[pa.RecordBatch]:
    """(text, label) -> partial counts of texts by what `found_in` finds in them."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    def flush():
        rows = [(t, counts[1][t], counts[0][t]) for t in counts[0].keys() | counts[1].keys()]
        for k in range(0, len(rows), 20_000):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[k:k + 20_000]), _TERM)],
                                  schema=_TERM)
        counts[0].clear()
        counts[1].clear()
    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            counts[toxic].update(found_in(text))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield from flush()
    yield from flush()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _counted(batches, _terms_of)


def _log_tail(k: int, n: int, p: float) -> float:
    """log P(at least k of n) for chance p, bounded by the Chernoff bound."""
    q = k / n
    if q <= p:
        return 0.0
    return -n * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0))


def _rank(term: str, toxic: int, clean: int) -> tuple:
    """The order of the selection; ORDER is the same as a column."""
    return -toxic, clean, -len(term), term


ORDER = "struct(-toxic, clean, -length(term), term)"


def _select(candidates: list[tuple], where: dict[str, list]) -> list[str]:
    """Kept terms: from the most frequent down, if they explain documents anew. `where` has
    the documents of each candidate (term, toxic, clean, and True if it is kept already)."""
    kept: list[str] = []
    wholes: set[str] = set()
    starts: set[str] = set()
    covered: Counter = Counter()
    for term, _, _, sure in sorted(candidates, key=lambda c: _rank(*c[:3])):
        plain = term.rstrip(WHOLE)
        at = where.get(term, ())
        if not sure and (plain in starts or any(plain[:k] in wholes for k in range(1, len(plain) + 1))
                         or sum(covered[k] < 2 for k in at) < LEAST_NEW):
            continue
        kept.append(term)
        wholes.add(plain)
        starts.update(plain[:k] for k in range(1, len(plain) + 1))
        covered.update(at)
    return kept


def _without_equal_stems(terms: DataFrame) -> DataFrame:
    """Without stems that are in the same texts as a longer term that they begin: the selection
    would come to the longer one first and decide on both alike."""
    plain = F.rtrim("term", F.lit(WHOLE))
    size = F.length(plain)
    shorter = terms.select(plain.substr(F.lit(1), F.least(size - 1, F.lit(MAX_STEM))).alias("term"), "toxic", "clean")
    return terms.join(shorter.where(F.length("term") >= MIN_STEM).distinct(), ["term", "toxic", "clean"], "left_anti")


def _present(terms: frozenset | None):
    """(text, key) -> (doc, term) of the given terms, or of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for text, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    found = _terms_of(text)
                    yield from ((key, t) for t in (found if terms is None else found & terms))
        return batches_of(rows(), _PAIR, max_rows=20_000)
    return run


def _cover(candidates: DataFrame, pairs: DataFrame) -> list[str]:
    """What `_select` keeps of (term, toxic, clean), with the documents of (doc, term).

    Rounds decide every term whose fate does not hang on undecided ones before it: it is
    kept if LEAST_NEW documents stay open to it even if all of those are kept, and goes
    if fewer are open though none is. Each round decides the first open term at least. What
    is left goes to the driver once its count proves it small; the result is the same."""
    terms = candidates.withColumn("kept", F.lit(None).cast("boolean"))
    related = None
    while True:
        open_docs = pairs.join(terms.where("kept IS NULL"), "term", "left_semi").select("doc").distinct()
        live = stored(pairs.join(terms.where("kept IS NULL OR kept").select("term"), "term", "left_semi")
                      .join(open_docs, "doc", "left_semi"), "toxic-live")
        left = terms.where("kept IS NULL OR kept")
        if live.count() <= PAIRS_HELD:
            where: dict[str, list] = {}
            for r in live.toLocalIterator():
                where.setdefault(r["term"], []).append(r["doc"])
            return _select([(r.term, r.toxic, r.clean, bool(r.kept)) for r in left.toLocalIterator()], where)
        if related is None:
            related = stored(_related(candidates), "toxic-related")
        terms, pairs = stored(_decided(terms, live, related), "toxic-terms"), live


def _related(candidates: DataFrame) -> DataFrame:
    """(earlier, later) terms of which one begins the other."""
    t = candidates.select("term", F.rtrim("term", F.lit(WHOLE)).alias("plain"), F.expr(ORDER).alias("at"))
    starts = t.select(F.col("term").alias("long"), F.col("at").alias("long_at"), F.explode(F.transform(
        F.sequence(F.lit(1), F.length("plain")), lambda k: F.col("plain").substr(F.lit(1), k))).alias("plain"))
    both = starts.join(t, "plain").where("term <> long")
    first = F.col("at") < F.col("long_at")
    return both.select(F.when(first, F.col("term")).otherwise(F.col("long")).alias("earlier"),
                       F.when(first, F.col("long")).otherwise(F.col("term")).alias("later")).distinct()


def _decided(terms: DataFrame, live: DataFrame, related: DataFrame) -> DataFrame:
    before = Window.partitionBy("doc").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    seen = live.join(terms.withColumn("at", F.expr(ORDER)), "term").select(
        "term", "kept", F.count("kept").over(before).alias("least"), F.count("*").over(before).alias("most"))
    news = seen.where("kept IS NULL").groupBy("term").agg(
        F.count_if(F.col("most") < 2).alias("sure"), F.count_if(F.col("least") < 2).alias("may"))
    met = related.join(terms.select(F.col("term").alias("earlier"), "kept"), "earlier").groupBy(
        F.col("later").alias("term")).agg(F.count_if("kept").alias("blocked"),
                                          F.count_if(F.col("kept").isNull()).alias("unsure"))
    blocked, unsure, sure, may = (F.coalesce(c, F.lit(0)) for c in ("blocked", "unsure", "sure", "may"))
    fate = F.when(F.col("kept").isNotNull(), F.col("kept")).when((blocked > 0) | (may < LEAST_NEW), False) \
        .when((unsure == 0) & (sure >= LEAST_NEW), True)
    return terms.join(news, "term", "left").join(met, "term", "left").select("term", "toxic", "clean", fate.alias("kept"))


def _spellings(terms: list[str]):
    """Labelled documents by misspelling (the word itself and the matched part)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        return _counted(batches, lambda text: {x for w, h in matcher.hits(text).items() if h[1] for x in (w, h[2])})
    return run


def learn_lexicon(labelled: DataFrame) -> tuple[list[str], DataFrame | None]:
    """(terms, all ordinary spellings as a table) from (text, label 0 or 1). All terms that are no chance are
    candidates, in a written table; the selection counts equal toxic texts once. The
    lexicon reaches the driver; counts and texts do not."""
    rows = labelled.select("text", "label")
    total = dict(rows.groupBy("label").count().collect())
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        return [], None
    base = n1 / (n1 + n0)
    terms = (rows.mapInArrow(_count_terms, "term string, toxic long, clean long")
             .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where("toxic >= 4 AND toxic >= 9 * clean"))
    # Strength: Chernoff exponent of the term's share of toxic documents.
    n, q = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    rest = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - base))).otherwise(0.0)
    strong = stored(terms.where(n * (q * F.log(q / base) + rest) > -math.log(CHANCE)), "toxic-strong")
    candidates = stored(_without_equal_stems(strong), "toxic-candidates")
    held = candidates.select("term").limit(TERMS_HELD + 1).collect()
    if not held:
        return [], None
    toxic = rows.where("label = 1").groupBy(F.sha2("text", 256).alias("digest")) \
        .agg(F.first("text").alias("text")).select("text", F.xxhash64("digest").alias("key"))
    if len(held) <= TERMS_HELD:
        pairs = toxic.mapInArrow(_present(frozenset(r.term for r in held)), "doc long, term string")
    else:
        pairs = toxic.mapInArrow(_present(None), "doc long, term string").join(candidates, "term", "left_semi")
    kept = _cover(candidates, stored(pairs, "toxic-pairs"))
    if not kept:
        return [], None
    ordinary = (rows.mapInArrow(_spellings(kept), "term string, toxic long, clean long")
                .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
                .where("clean > 0 AND 9 * clean > toxic").select("term"))
    return kept, stored(ordinary, "toxic-ordinary")


def _masses(terms: list[str], ordinary: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms, ordinary)
        for b in batches:
            mass = [matcher.mass(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(mass, pa.float64())], schema=_MASS)
    return run


_HITS = pa.schema([("doc_id", pa.int64()),
                   ("hits", pa.list_(pa.struct([("place", pa.int32()), ("word", pa.string()), ("part", pa.string())]))),
                   ("spans", pa.list_(pa.list_(pa.int32())))])
_HITS_DDL = "doc_id long, hits array<struct<place: int, word: string, part: string>>, spans array<array<int>>"


def _all_hits(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        def rows():
            for b in batches:
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    at, spans = matcher.places(text)
                    yield doc_id, [dict(zip(("place", "word", "part"), h)) for h in at], [list(x) for x in spans]
        return batches_of(rows(), _HITS)
    return run


def _rest_masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        mass = []
        for hits, spans, gone in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
            left = [(h["place"], 1.0 if h["part"] is None else MISSPELLED) for h in hits
                    if h["place"] not in (gone or ())]
            mass.append(context_mass(left, [tuple(x) for x in spans]))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(mass, pa.float64())], schema=_MASS)


def _held(ordinary: DataFrame | None) -> list[str] | None:
    """The ordinary spellings, or None if they are too many for a task."""
    held = [] if ordinary is None else ordinary.limit(ORDINARY_HELD + 1).collect()
    return [r.term for r in held] if len(held) <= ORDINARY_HELD else None


def masses_of(docs: DataFrame, terms: list[str], ordinary: DataFrame | None) -> DataFrame:
    """doc_id, mass of every row. Ordinary spellings are held by the tasks when their count
    proves them small; otherwise hits are written and the ordinary ones found by joins."""
    held = _held(ordinary)
    if held is not None:
        return docs.mapInArrow(_masses(terms, held), "doc_id long, mass double")
    hits = stored(docs.mapInArrow(_all_hits(terms), _HITS_DDL)
                  .withColumn("row", F.monotonically_increasing_id()), "toxic-hits")
    misspelt = hits.select("row", F.inline("hits")).where("part IS NOT NULL")
    gone = misspelt.join(ordinary.withColumnRenamed("term", "word"), "word", "left_semi").select("row", "place").union(
        misspelt.join(ordinary.withColumnRenamed("term", "part"), "part", "left_semi").select("row", "place"))
    gone = gone.groupBy("row").agg(F.collect_set("place").alias("gone"))
    return hits.join(gone, "row", "left").select("doc_id", "hits", "spans", "gone") \
        .mapInArrow(_rest_masses, "doc_id long, mass double")


def with_masses(documents: DataFrame, terms: list[str], ordinary: DataFrame | None, name: str) -> DataFrame:
    """Every row of `documents` with its mass in a column of that name. Only ordinary spellings too many
    for a task cost a copy of the rows and a join with their masses."""
    held, at = _held(ordinary), position(documents, "text")
    if held is None:
        key = free_name(documents, "row")
        keyed = stored(documents.withColumn(key, F.monotonically_increasing_id()), "toxic-keyed")
        found = masses_of(keyed.select(F.col(key).alias("doc_id"), "text"), terms, ordinary)
        return keyed.join(found.select(F.col("doc_id").alias(key), F.col("mass").alias(name)), key).select(
            *documents.columns, name)

    def make():
        matcher = Matcher(terms, held)
        return lambda b: pa.array([matcher.mass(x) for x in b.column(at).to_pylist()], pa.float64())
    return beside(documents, name, T.DoubleType(), make)


def fit_curve(mass: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on log(1 + mass), by Newton steps with a small
    ridge; intercept and slope."""
    if not len(label) or label.min() == label.max():
        return (-20.0, 0.0) if not len(label) or label.max() == 0 else (20.0, 0.0)
    x = np.stack([np.ones(len(mass)), np.log1p(mass)], 1)
    w, ridge = np.zeros(2), np.array([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge),
                               x.T @ (label - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _first_masses(labelled: DataFrame, terms: list[str], ordinary: DataFrame | None) -> DataFrame:
    """doc_id, mass of the labelled rows that the curve is fitted on, read anew: those up to the FIT_ROWS-th hash."""
    key = F.xxhash64("doc_id").alias("key")
    last = labelled.select(key).orderBy("key").limit(FIT_ROWS).agg(F.max("key")).first()[0]
    return masses_of(labelled.where(key <= F.lit(last)).select("doc_id", "text"), terms, ordinary)


def score_toxicity(documents: DataFrame, labels: DataFrame, judged: str | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; with `judged`, every row of `documents` as it is
    with a struct of held_out, score and predicted in a new column of that name.

    The labels meet the documents in one join (broadcast when their row count proves
    them small). Masses of all documents are computed in one map pass and written, a
    few bytes a row; the curve is then a column expression over them. With `judged` they are not written:
    the curve's rows get theirs first, and the pass that reads the result computes the masses beside the
    rows, so that texts are neither written nor shuffled (each further read computes them again)."""
    docs = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"])
    marks = (labels.select(labels["doc_id"].cast("long").alias("doc_id"),
                           labels["toxic"].cast("int").alias("label"))
             .where("label IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    marks = broadcast_if_small(marks, 32)
    labelled = docs.join(marks, "doc_id")
    terms, ordinary = learn_lexicon(labelled.select("text", "label"))
    if judged is None:
        masses = known = stored(masses_of(docs, terms, ordinary), "toxic-mass")
    else:
        known = _first_masses(labelled, terms, ordinary)
    sample = (known.join(marks, "doc_id").withColumn("key", F.xxhash64("doc_id"))
              .orderBy("key").limit(FIT_ROWS).select("mass", "label").collect())
    a, b = fit_curve(np.array([r.mass for r in sample]), np.array([r.label for r in sample], float))
    def found(doc_id, mass):
        score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.log1p(mass)))) if terms else F.lit(0.0)
        return [held_out(doc_id).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")]
    if judged is None:
        return masses.select("doc_id", *found(F.col("doc_id"), F.col("mass")))
    return with_masses(documents, terms, ordinary, judged).withColumn(
        judged, F.struct(*found(F.col("doc_id").cast("long"), F.col(judged))))
