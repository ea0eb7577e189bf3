"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces.

Tree. A paragraph is a line. Sections are runs of paragraphs that end, independently of
position, after a paragraph whose hash is divisible by SECTION (so an insertion moves no
later border). A paragraph is cut into pieces of about three words, at borders
that depend on the text alone (signs and certain last letters; long runs without
any: by a hash of the word). Leaves are hashes of pieces; every node is the hash of its children, and the
root also covers the exact text, so roots are equal only for equal texts.

A fingerprint is text: the root, then the tree (sections separated by `;`, paragraphs by
`,`, a paragraph being its leaves of LEAF_DIGITS hex digits). Comparing two of them goes
down only branches that differ: equal roots, then equal sections, then equal
paragraphs, then leaves. Likeness is the share of leaves below equal branches (Dice);
`differing_paragraphs` locates the edits.

Defined results: null = empty text; its tree has no leaves; two empty texts are alike (1), an
empty and another one are not (0).
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm.common import batches_of

SECTION = 4
PIECE_CHARS = 120
LEAF_DIGITS = 6
RUNS_PER_PARTITION = 4     # runs of ids for each shuffle partition
MOST_RUNS = 20_000         # keeps the borders small; a run is streamed, whatever its size

# White space after a sign or after one of these letters ends a piece: about every third word.
_PIECES = re.compile(r"(?<=[.!?;:,|cfiloruxCFILORUX&%*。！？；，、])\s+|(?<=[。！？；])")


def _pieces(paragraph: str) -> list[str]:
    out = []
    for piece in _PIECES.split(paragraph):
        if len(piece) <= PIECE_CHARS:
            out.append(piece)
            continue
        held = size = 0
        words = piece.split(" ")
        for k, word in enumerate(words):
            size += len(word) + 1
            # About every 16th word ends a piece; a single word is never cut.
            if zlib.crc32(word.encode("utf-8", "surrogatepass")) % 16 == 0 or size > 8 * PIECE_CHARS:
                out.append(" ".join(words[held:k + 1]))
                held, size = k + 1, 0
        if held < len(words):
            out.append(" ".join(words[held:]))
    return out


def _leaf(piece: str) -> str:
    return f"{zlib.crc32(piece.encode('utf-8', 'surrogatepass')) >> (32 - 4 * LEAF_DIGITS):0{LEAF_DIGITS}x}"


def fingerprint(text: str | None) -> str:
    """Root and tree of a text."""
    text = text or ""
    body = _paragraph_tree(text)
    root = hashlib.sha256(hashlib.sha256(body.encode()).digest()
                          + hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()).hexdigest()[:32]
    return f"{root}:{body}"


def _paragraph_tree(text: str) -> str:
    if not text:
        return ""
    sections, current = [], []
    for paragraph in text.split("\n"):
        node = "".join(map(_leaf, _pieces(paragraph))) if paragraph else ""
        current.append(node)
        if zlib.crc32(node.encode()) % SECTION == 0:
            sections.append(",".join(current))
            current = []
    if current:
        sections.append(",".join(current))
    return ";".join(sections)


def _leaves(node: str) -> list[str]:
    return [node[k:k + LEAF_DIGITS] for k in range(0, len(node), LEAF_DIGITS)]


def _unmatched(a: list[str], b: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Equal branches (as often as both have them), and the others of each side."""
    ca, cb = Counter(a), Counter(b)
    return list((ca & cb).elements()), list((ca - cb).elements()), list((cb - ca).elements())


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 only for equal roots."""
    root_a, tree_a = a.split(":", 1)
    root_b, tree_b = b.split(":", 1)
    if root_a == root_b:
        return 1.0
    if not tree_a or not tree_b:
        return 0.0
    def count(nodes):
        return sum(map(len, nodes)) / LEAF_DIGITS - sum(n.count(",") for n in nodes) / LEAF_DIGITS
    sections_a, sections_b = tree_a.split(";"), tree_b.split(";")
    total = count(sections_a) + count(sections_b)
    same, rest_a, rest_b = _unmatched(sections_a, sections_b)
    common = count(same)
    same, rest_a, rest_b = _unmatched([p for s in rest_a for p in s.split(",")],
                                      [p for s in rest_b for p in s.split(",")])
    common += count(same)
    same, _, _ = _unmatched([x for p in rest_a for x in _leaves(p)], [x for p in rest_b for x in _leaves(p)])
    common += len(same)
    return min(2 * common / total, 1 - 1e-9) if total else 0.0


def differing_paragraphs(a: str, b: str) -> tuple[list[int], list[int]]:
    """Positions of the paragraphs of each text that the other has not (edits)."""
    sides = [[p for s in x.split(":", 1)[1].split(";") for p in s.split(",")] for x in (a, b)]
    _, only_a, only_b = _unmatched(*sides)
    out = []
    for side, only in zip(sides, (only_a, only_b)):
        left, places = Counter(only), []
        for k, p in enumerate(side):
            if left[p]:
                left[p] -= 1
                places.append(k)
        out.append(places)
    return out[0], out[1]


def edit(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the start of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, guest, doc_id, text) in order -> fingerprints; a guest only serves as the
    next document of the last one of a bucket."""
    def rows():
        last = None                              # (bucket, doc_id, text, fingerprint)
        for b in batches:
            for bucket, guest, doc_id, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                if last and (last[0] != bucket or bucket < 0):
                    yield _result(last, None)
                    last = None
                if guest and last is None:       # only the first guest is the next one
                    continue
                item = (bucket, doc_id, text or "", fingerprint(text))
                if last:
                    yield _result(last, item)
                last = None if guest else item
        if last:
            yield _result(last, None)
    return batches_of(rows(), _OUT)


def _result(item, following):
    _, doc_id, text, own = item
    edited = edit(text, following[2]) if following else text
    mark = fingerprint(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, mark,
            likeness(own, mark), likeness(own, following[3]) if following else 1.0)


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, for each row.

    The next document is the one that follows by id (rows that repeat an id follow each other
    by the text's digest; the last one is followed by the first). Texts are shuffled once: ids are
    cut into runs by approximate quantiles, each run is streamed in
    order, and the first document of a run visits the run before it as well.
    Rows with a null id have no place in the order: their edited text is their text,
    near_next is 1. One document alone follows itself. An empty table gives an empty table."""
    spark = documents.sparkSession
    docs = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Two numbers per run reach the driver: its border and its first id.
    runs = min(parts * RUNS_PER_PARTITION, MOST_RUNS)
    share = [k / runs for k in range(1, runs)]
    cuts = docs.select(F.percentile_approx("doc_id", share, 20 * runs)).first()[0] if share else None
    borders = spark.sparkContext.broadcast(np.unique(np.array(cuts or [], np.int64)))

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders.value, ids.to_numpy(np.int64)).astype(np.int32))

    known = docs.where("doc_id IS NOT NULL").withColumn("bucket", run_of("doc_id"))
    firsts = {r["bucket"]: r["first"] for r in
              known.groupBy("bucket").agg(F.min("doc_id").alias("first")).collect()}
    order = sorted(firsts)
    visits = spark.sparkContext.broadcast({firsts[b]: order[k - 1] for k, b in enumerate(order)})

    @F.pandas_udf("int")
    def host_of(ids: pd.Series) -> pd.Series:
        return ids.map(visits.value).astype("Int32")

    visit = F.array(F.struct("bucket", F.lit(False).alias("guest")),
                    F.struct(host_of("doc_id").alias("bucket"), F.lit(True).alias("guest")))
    placed = known.withColumn("to", F.explode(visit)).where("to.bucket IS NOT NULL") \
        .select("to.bucket", "to.guest", "doc_id", "text")
    lone = docs.where("doc_id IS NULL").select(
        (-1 - F.pmod(F.xxhash64("text"), F.lit(runs))).cast("int").alias("bucket"),
        F.lit(False).alias("guest"), "doc_id", "text")
    return (placed.union(lone).repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "guest", "doc_id", F.sha1(F.coalesce("text", F.lit(""))))
            .mapInArrow(_walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                               "edited_fingerprint string, near_edited double, near_next double"))
