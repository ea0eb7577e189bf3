"""Exact SentencePiece BPE encoding by backtracking, and decoding.

Text is cut where no piece can reach across (before a run of word-start marks, around
line feeds, and in long parts between characters that stand together in no piece); each part is encoded
on its own:
an Aho-Corasick pass gives the longest piece from every position; pieces are then
placed greedily, a piece is accepted if it is compatible with the one before it, and
otherwise the next shorter prefix piece is tried. Two adjacent pieces are compatible if
merging them again, side by side, joins nothing across the border between them. A
bitfield remembers positions from which encoding failed. A sequence whose adjacent
pairs are all compatible is the one that the merge rules produce.

Characters that are no piece become their UTF-8 bytes' pieces (byte fallback).

Defined results: null or empty text encodes to the begin and end ids alone and decodes
to the empty text. Repeated rows and null ids pass through; an empty table gives an
empty table; only the named columns are read. Very long texts are encoded whole: work
grows with the length, also in text without spaces.
"""
from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripwire.llm.common import batches_of

MARK = "▁"                 # SentencePiece's sign for a space
WORDS_KEPT = 200_000            # encoded words remembered by a Python worker, twice
LONG_PART = 256                 # characters of a part that is looked through for further cuts
PAIRS_KEPT = 400_000            # compatibility answers remembered by a Python worker

_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of one protobuf message: (number, integer or bytes)."""
    def varint(i):
        value = shift = 0
        while True:
            b = data[i]
            value |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return value, i
    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            size, i = {1: lambda: (8, i), 5: lambda: (4, i), 2: lambda: varint(i)}[key & 7]()
            value, i = data[i:i + size], i + size
        yield key >> 3, value


class PieceCodec:
    """Encoder and decoder for one BPE model file with byte fallback."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self._check(model_file)
        n = sp.get_piece_size()
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
                                             or sp.is_unused(i))]
        self._rank = {pieces[i]: (-sp.get_score(i), i) for i in plain}
        self._byte = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self._bytes = [pieces[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in self._byte.items():
            self._bytes[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                self._bytes[i] = b""
        self._bytes[self.unknown] = " ⁇ ".encode()
        self._silent = {i for i in range(n) if sp.is_control(i)}
        self._byte_ids = set(self._byte.values())

        # Pieces that their own merges produce; only these occur in an encoding. Of each,
        # the two parts of its last merge.
        halves = {t: self._merge(t) for t in self._rank}
        able = {t: self._rank[t][1] for t, h in halves.items() if "".join(h) == t and len(h) < 3
                and (len(t) == 1 or h[0] + h[1] in self._rank)}
        self._left = {i: self._edge(t, halves, 0) for t, i in able.items()}
        self._right = {i: self._edge(t, halves, -1) for t, i in able.items()}
        self._text = {i: t for t, i in able.items()}
        self._length = [0] * n
        self._shorter = [-1] * n                # longest proper prefix that is a piece
        self._trie = ahocorasick.Automaton()
        for t, i in able.items():
            self._length[i] = len(t)
            self._shorter[i] = next((able[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in able), -1)
            self._trie.add_word(t, i)
        self._trie.make_automaton()
        self._letters = {t for t in able if len(t) == 1}

        # A text may be cut between two characters that stand together in no piece.
        self._joined = {t[k:k + 2] for t in able for k in range(len(t) - 1)}
        self._by_word = not any(re.search(f"[^{MARK}]{MARK}|\n", t) for t in able)
        self._spaced = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self._new: dict[str, bytes] = {}        # words after one space, and those before them
        self._old: dict[str, bytes] = {}
        # Signs that no piece joins to a letter or digit before them.
        joined = {j[1] for j in self._joined if j[0].isalnum()}
        self._signs = {t: self._ids([i]) for t, i in able.items()
                       if len(t) == 1 and not t.isalnum() and t != MARK and t not in joined}
        self._pairs: dict[int, bool] = {}
        self._feed = self._ids([self._byte[10]])
        self._start = np.zeros(n, np.int64)     # decoding: all pieces' bytes in one array
        self._sizes = np.array([len(b) for b in self._bytes], np.int64)
        self._start[1:] = np.cumsum(self._sizes)[:-1]
        self._flat = np.frombuffer(b"".join(self._bytes), np.uint8)

    @staticmethod
    def _ids(ids: Sequence[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    @staticmethod
    def _check(model_file: str) -> None:
        with open(model_file, "rb") as f:
            top = {k: v for k, v in _message(f.read()) if k in (2, 3)}
        trainer, normal = dict(_message(top[2])), dict(_message(top[3]))
        if trainer.get(3) != 2 or not trainer.get(35):
            raise ValueError("only BPE models with byte fallback are supported")
        if normal.get(2) or normal.get(4, 1) or not normal.get(3, 1) or not normal.get(5, 1):
            raise ValueError("only identity normalisation with a dummy prefix is supported")

    def _merge(self, text: str) -> list[str]:
        """Merge from single characters, best rank first, leftmost among equals, until
        two parts (or more, if no merge is left) remain."""
        parts, rank = list(text), self._rank
        while len(parts) > 2:
            best, at = min((rank[t][0] if (t := parts[k] + parts[k + 1]) in rank else np.inf, k)
                           for k in range(len(parts) - 1))
            if best == np.inf:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, piece: str, halves: dict[str, list[str]], side: int) -> list[tuple]:
        """The parts that stand at one end of a piece while it is merged, from the whole
        down to a character: (text, rank at which it is made, rank of the merge that
        takes it into the next larger one)."""
        out, taken = [], np.inf
        while True:
            made = self._rank[piece][0] if len(piece) > 1 else -1
            out.append((piece, made, taken))
            if len(piece) == 1:
                return out
            piece, taken = halves[piece][side], made

    def _compatible(self, left: int, right: int) -> bool:
        """Merge the two pieces again beside each other: no part at the end of the left
        one may join a part at the start of the right one that is there at the same time,
        before either is taken into its own piece. Of two merges of equal rank the left
        one comes first."""
        if len(self._pairs) >= PAIRS_KEPT:
            self._pairs.clear()
        rank, found = self._rank, True
        for a, made_a, taken_a in self._right[left]:
            for b, made_b, taken_b in self._left[right]:
                if made_a < taken_b and made_b < taken_a and (r := rank.get(a + b)) \
                        and r[0] < taken_a and r[0] <= taken_b:
                    found = False
        self._pairs[left << 32 | right] = found
        return found

    def _place(self, text: str) -> list[int]:
        """Pieces of a text whose characters all are pieces."""
        size, length, shorter, pairs = len(text), self._length, self._shorter, self._pairs
        longest = [0] * size
        for end, piece in self._trie.iter(text):
            longest[end - length[piece] + 1] = piece    # ends ascend: the longest comes last
        failed = bytearray((size >> 3) + 1)     # a bit per position: encoding from it fails
        at, piece, last = 0, longest[0], -1
        placed: list[int] = []
        while True:
            end = at + length[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or (
                    ok if (ok := pairs.get(last << 32 | piece)) is not None
                    else self._compatible(last, piece))):
                placed.append(piece)
                if end == size:
                    return placed
                at, last, piece = end, piece, longest[end]
            elif shorter[piece] >= 0:
                piece = shorter[piece]
            else:                               # nothing fits here: take the last piece back
                failed[at >> 3] |= 1 << (at & 7)
                piece = placed.pop()
                at -= length[piece]
                last = placed[-1] if placed else -1

    def _part(self, text: str) -> bytes:
        """Ids of a text between two cuts. A long one is cut again between characters that
        stand together in no piece: no merge can reach across."""
        if len(text) > LONG_PART:
            joined = self._joined
            cuts = [0, *(k for k in range(1, len(text)) if text[k - 1:k + 1] not in joined), len(text)]
            if len(cuts) > 2:
                return b"".join(self._placed(text[a:b]) for a, b in zip(cuts, cuts[1:]))
        return self._placed(text)

    def _placed(self, text: str) -> bytes:
        if self._letters.issuperset(text):
            return self._ids(self._place(text))
        return self._split(text)

    def _word(self, word: str) -> bytes:
        """Ids of a word after one space. A sign at its end is cut off where that is
        allowed, so that one remembered word serves all signs after it."""
        sign = self._signs.get(word[-1:])
        if sign is not None and word[-2:-1].isalnum():
            stem = word[:-1]
            return (self._new.get(stem) or self._word(stem)) + sign
        found = self._old.get(word)
        if found is None:
            found = self._part(MARK + word)
        if len(word) <= 64:
            if len(self._new) >= WORDS_KEPT:
                self._old, self._new = self._new, {}
            self._new[word] = found
        return found

    def _split(self, text: str) -> bytes:
        """A text with characters that are no piece: these become bytes."""
        letters, ids, k = self._letters, [], 0
        while k < len(text):
            end = k
            while end < len(text) and text[end] in letters:
                end += 1
            if end > k:
                ids += self._place(text[k:end])
                k = end
            else:
                ids += [self._byte[b] for b in text[k].encode()]
                k += 1
        return self._ids(ids)

    def encode(self, text: str | None) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        out = [self._ids([self.begin])]
        if text and not self._by_word:
            out.append(self._split(MARK + text.replace(" ", MARK)))
        elif text:
            part = self._part
            for k, line in enumerate((MARK + text.replace(" ", MARK)).split("\n")):
                if k:
                    out.append(self._feed)
                if MARK + MARK in line or line.endswith(MARK):
                    out += map(part, self._spaced(line))
                    continue
                head, *words = line.split(MARK)
                if head:
                    out.append(part(head))
                found = list(map(self._new.get, words))
                if None in found:
                    found = [self._word(w) if f is None else f for w, f in zip(words, found)]
                out += found
        out.append(self._ids([self.end]))
        return b"".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ids: marks become spaces, the prefix's space goes, byte pieces
        are joined to characters (bytes that form none become U+FFFD)."""
        table, ids = self._bytes, np.asarray(ids, np.int64)
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        data = self._flat[np.arange(ends[-1] if len(ends) else 0)
                          + np.repeat(self._start[ids] - ends + sizes, sizes)].tobytes()
        first = next((i for i in map(int, ids) if i not in self._silent), None)
        skip = first is not None and first not in self._byte_ids and first != self.unknown \
            and table[first].startswith(b" ")
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text, run = "", bytearray()
            for i in [*ids.tolist(), None]:
                if i in self._byte_ids:
                    run += table[i]
                    continue
                text += _bytes_text(bytes(run))
                run.clear()
                text += table[i].decode() if i is not None else ""
        return text[1:] if skip else text


def _bytes_text(run: bytes) -> str:
    """Characters of a run of bytes; every byte that starts none is U+FFFD."""
    out, k = "", 0
    while k < len(run):
        for n in (1, 2, 3, 4):
            try:
                out += run[k:k + n].decode()
                k += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out += "�"
            k += 1
    return out


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """The codec of a model file, built once in a Python process."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


def encode_texts(df: DataFrame, model_file: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and the decoded text of
    every row. One map pass; the model file must be readable on the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_file)
        def rows():
            for b in batches:
                for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = c.encode(text)
                    yield k, ids, c.decode(np.frombuffer(ids, "<u4"))
        return batches_of(rows(), _ENCODED)
    return (df.select(df[id_col].cast("long"), df[text_col])
            .mapInArrow(run, "doc_id long, ids binary, decoded string"))


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                      ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_digests(df: DataFrame, model_file: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every row:
    as `encode_texts`, digested where they are made."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_file)
        def rows():
            for b in batches:
                for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = c.encode(text)
                    decoded = c.decode(np.frombuffer(ids, "<u4"))
                    yield (k, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                           hashlib.sha256(decoded.encode()).hexdigest())
        return batches_of(rows(), _DIGESTS)
    return (df.select(df[id_col].cast("long"), df[text_col])
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
