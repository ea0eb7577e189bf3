"""Ranked search, language identification and phrase mining against brute force."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tripwire.llm import bytecnn, maxsketch, phrases
from tripwire.llm.common import load

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, term string, df long, item int, score double, row string, " \
       "sketch binary, phrase string, f long, key long, n long, best int"
BIG = " ".join(f"w{k % 997}x{k % 31}" for k in range(40_000))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "x", 1, 2, 0.5, "r", b"k", "p", 3, 4, 5, 6) for i, t, lang in rows], DOCS)


EDGE = [(1, "Alpha beta, gamma beta.", "en"), (2, "alpha BETA gamma\tbeta", "en"), (3, None, "en"), (4, "", None), (5, "  \n ", "fr"),
        (6, "one", None), (6, "one", None), (7, BIG, "en"), (8, BIG + " tail", "en"), (None, "alpha beta gamma", "en"),
        (9, "Äpfel é٣ alpha-beta_gamma", "de"), (10, "spam " * 400 + "alpha", "en"), (11, "x\x00y\x1cz a\x0bb 12.5", None)]


# --- ranked search -----------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def ranked(rows, items, k):
    found = [(i, Counter(TERM.findall(lowered(t)))) for i, t, *_ in rows]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    N, L, df = len(found), sum(n for *_, n in found), Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        ts = set(TERM.findall(lowered(text)))
        scored = []
        for i, c, n in found:
            m = 50 + 50 * n * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in ts if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def searched(spark, rows, items, k):
    queries = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, maxsketch.ranked_search(docs(spark, rows), queries, k).collect()), key=str)


def test_search_edge_cases(spark):
    items = [(1, "alpha, Beta alpha"), (2, None), (3, ""), (4, "unknown words"), (5, "spam tail w1x1 é٣"), (5, "one"), (5, "one"), (6, "ONE x y z b")]
    for k in (2, 50):
        assert searched(spark, EDGE, items, k) == ranked(EDGE, items, k)
    assert searched(spark, EDGE, [], 5) == [] and searched(spark, [], items, 5) == []
    assert searched(spark, [(1, None, "en"), (2, " .", "en")], items, 5) == []


def test_search_whole_table(spark, monkeypatch):
    rows = [tuple(r) for r in load(spark, SF, "documents").select("doc_id", "text", "lang").collect()]
    items = [tuple(r) for r in load(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = ranked(rows, items, 7)
    assert searched(spark, rows, items, 7) == want
    monkeypatch.setattr(maxsketch, "BLOCK_ITEMS", 6)  # several blocks of queries
    assert searched(spark, rows, items, 7) == want


def test_bounds_hold_and_skip():
    """A bound is never below a score, and narrow enough to rule most documents out."""
    rng = np.random.default_rng(1)
    texts = [" ".join(f"t{min(int(x), 3000)}" for x in rng.zipf(1.3, rng.integers(1, 400))).encode() for _ in range(400)]
    found = [maxsketch.terms_of(t) for t in texts]
    df = Counter(t for f in found for t in set(f))
    items = [texts[k][:60] for k in range(0, 400, 40)]
    block = maxsketch._Block(items, dict(df), len(found), sum(map(len, found)))
    above = 0
    for text, f in zip(texts, found):
        bound, score = block.bounds(maxsketch.sketch_of(Counter(f)), len(f)), block.scores(text, len(f))
        assert (bound >= score).all()
        above += (bound > score).sum()
    assert above < 0.5 * len(texts) * len(block.items)
    heavy = maxsketch.sketch_of(Counter({b"t1": 100_000, b"t2": 254}))
    assert (block.bounds(heavy, 100_254) >= block.scores(b"t1 " * 100_000 + b"t2 " * 254, 100_254)).all()


# --- phrases -----------------------------------------------------------------------------

def mined(rows, least, top, absorb=80):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = Counter()
        for q, a in cand.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    covered[q[i:i + k]] = max(covered[q[i:i + k]], a)
        scored = []
        for p, a in cand.items():
            if 100 * covered[p] >= absorb * a:
                continue
            s, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), l, r))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def found_phrases(spark, rows, least, top):
    got = phrases.collocations(docs(spark, rows), least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def test_phrases_edge_cases(spark):
    for least, top in ((2, 2000), (30, 3)):
        assert found_phrases(spark, EDGE, least, top) == mined(EDGE, least, top)
    assert found_phrases(spark, [], 2, 10) == []
    assert found_phrases(spark, [(1, None, "en"), (2, " . ", None)], 2, 10) == []


def test_phrases_whole_table(spark):
    rows = [tuple(r) for r in load(spark, SF, "documents").select("doc_id", "text", "lang").collect()]
    assert found_phrases(spark, rows, 4, 300) == mined(rows, 4, 300)


class Shared:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("entries, units, burst, group", [(10 ** 6, 10 ** 6, 16, 10 ** 6), (50, 10 ** 6, 4, 300), (10 ** 6, 20, 8, 200)])
def test_spilled_runs_merge_to_exact_counts(monkeypatch, entries, units, burst, group):
    """Small limits: containers burst, subtrees are spilled, word lists start again; counts stay."""
    for name, value in (("MAX_ENTRIES", entries), ("MAX_UNITS", units), ("GROUP_BYTES", group), ("RUN_ROWS", 7)):
        monkeypatch.setattr(phrases, name, value)
    monkeypatch.setattr(phrases.HatTrie.__init__, "__defaults__", (burst,))
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{min(int(x), 60)}" + "." * int(rng.random() < 0.05) for x in rng.zipf(1.4, 50)) for _ in range(80)]
    langs = [("a", "b", "a")[k % 3] for k in range(80)]
    batch = pa.record_batch([pa.array(langs), pa.array(texts)], names=["lang", "text"])
    batches = [batch.slice(k, 16) for k in range(0, 80, 16)]
    everything = Shared((2 ** 15, b"\xff" * 4096))
    want = defaultdict(Counter)
    for lang, text in zip(langs, texts):
        for piece in text.split("."):
            words = piece.split()
            for k in range(1, 5):
                want[k].update((lang, " ".join(words[i:i + k])) for i in range(len(words) - k + 1))
    for run, sizes in ((phrases._word_runs, (1,)), (phrases._phrase_runs(everything), (2,)), (phrases._phrase_runs(everything, everything), (3, 4))):
        rows = pa.Table.from_batches(list(run(batches)), phrases._RUN_ARROW).sort_by([("phrase", "ascending"), ("lang", "ascending")])
        out = pa.Table.from_batches(list(phrases._merge_sorted(rows.to_batches(max_chunksize=5))), phrases._RUN_ARROW).to_pylist()
        assert len(out) == len({(r["lang"], r["phrase"]) for r in out})
        assert {(r["lang"], r["phrase"]): r["f"] for r in out} == sum((want[k] for k in sizes), Counter())


def test_filter_holds_every_phrase(spark):
    rows = [("en", f"a{k} b{k}") for k in range(3000)] + [("fr", "x"), ("fr", "é y")]
    bits, data = phrases.frequent_filter(spark.createDataFrame(rows, "lang string, phrase string"))
    bloom = phrases.BloomFilter(bits, data)

    def hashed(lang, phrase):
        hs = [np.array([phrases.word_hash(w.encode(), phrases._seed(lang))], np.uint64) for w in phrase.split(" ")]
        return hs[0] if len(hs) == 1 else phrases.chained(hs[0], hs[1])
    assert all(bloom.holds(hashed(*r))[0] for r in rows)
    assert sum(bloom.holds(hashed("en", f"b{k} a{k}"))[0] for k in range(3000)) < 60


# --- language ----------------------------------------------------------------------------

def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = bytecnn.ByteCnn(3)
    x, y, w = rng.integers(1, 256, (6, 40)).astype(np.uint8), rng.integers(0, 3, 6), rng.random(6)
    g, _ = net.gradients(x, y, w)
    for name in net.w:
        flat, gf = net.w[name].reshape(-1), g[name].reshape(-1)
        for k in np.argsort(-np.abs(gf))[:3]:
            old, eps = flat[k], 1e-2
            flat[k] = old + eps
            up = net.gradients(x, y, w)[1]
            flat[k] = old - eps
            down = net.gradients(x, y, w)[1]
            flat[k] = old
            assert abs((up - down) / (2 * eps) - gf[k]) < 0.05 * abs(gf[k]) + 1e-4, name


def test_windows_cover_the_whole_text():
    for n in (1, 255, 256, 257, 508, 509, 5000):
        text = bytes(np.random.default_rng(n).integers(1, 256, n).astype(np.uint8))
        rows = bytecnn.windows_of(text)
        grams = {text[i:i + 5] for i in range(max(n - 4, 1))}
        assert rows.shape[1] == bytecnn.WINDOW
        assert grams <= {r.tobytes()[i:i + min(5, n)] for r in rows for i in range(bytecnn.WINDOW - 4)}


def test_languages_of_held_out_documents(spark):
    table = load(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in bytecnn.identify_languages(table).collect()}
    truth = {r.doc_id: (r.lang, r.text) for r in table.collect()}
    assert set(got) == set(truth)
    right = total = 0
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in truth[i][1] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.held_out and truth[i][0] is not None:
            total += 1
            right += r.lang_pred == truth[i][0]
    assert right >= 0.95 * total > 100


def test_language_edge_cases(spark):
    rows = EDGE + [(20 + k, "the cat and the house " * 3, "en") for k in range(9)] + [(40 + k, "der Hund und das Haus " * 3, "de") for k in range(9)]
    got = bytecnn.identify_languages(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.held_out, r.lang_pred, round(r.score, 4)))
    assert all(by_id[i] == {(zlib.crc32(str(i).encode()) % 4 == 2, "und", 0.0)} for i in (3, 4, 5))
    assert all(len(v) == 1 for v in by_id.values())
    assert {p for i in range(20, 29) for _, p, _ in by_id[i]} == {"en"} and {p for i in range(40, 49) for _, p, _ in by_id[i]} == {"de"}
    assert bytecnn.identify_languages(docs(spark, [])).collect() == []
    unlabelled = bytecnn.identify_languages(docs(spark, [(1, "some words", None), (None, "text", "en")])).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_training_sample_is_bounded_and_learns_no_held_out_row(spark):
    rows = [(k, f"word{k % 50} text number {k % 50}", "en") for k in range(400)] + [(1000 + k, f"nur gehalten {k}", "de") for k in range(40)
                                                                                   if zlib.crc32(str(1000 + k).encode()) % 4 == 2]
    sample = bytecnn.training_sample(docs(spark, rows), 20).collect()
    assert len(sample) == 20 and {r.lang for r in sample} == {"en"}
    assert len({r.parts[0] for r in sample}) == 20
