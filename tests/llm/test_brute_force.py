"""Operators on the smallest tables against plain computations."""
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripwire.llm import cpsjoin, html_template, merkle, quality, queries, toxicity
from tripwire.llm.balltree import BallTree, search
from tripwire.llm.common import load
from tripwire.llm.components import connected_components
from tripwire.llm.piece_codec import codec

SF = "/root/testdata/sf0.01"


def components(rows, width, percent=80):
    """Smallest id of each document's component by comparing all sets."""
    ids, sets = [], []
    for i, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(
            c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        n = min(width, len(words))
        ids.append(i)
        sets.append({tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if words else set())
    root = list(range(len(ids)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    seen = defaultdict(list)
    for k, s in enumerate(sets):
        common = Counter(j for x in s for j in seen[x])
        for j, m in common.items():
            if 100 * m >= percent * (len(s) + len(sets[j]) - m):
                a, b = sorted((top(j), top(k)))
                root[b] = a
        for x in s:
            seen[x].append(k)
    least = {}
    for k, i in enumerate(ids):
        least[top(k)] = min(i, least.get(top(k), i))
    return {i: least[top(k)] for k, i in enumerate(ids)}, {i: len(s) for i, s in zip(ids, sets)}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    docs = load(spark, SF, "documents")
    got = cpsjoin.near_duplicates(docs, width).collect()
    want, sizes = components([(r.doc_id, r.text) for r in docs.collect()], width)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_nodes_and_clusters(spark, monkeypatch):
    """Near copies of one text beyond all node, block and cluster sizes, with strangers among them."""
    for name, value in (("NODE_ROWS", 6), ("BLOCK_ROWS", 8), ("CLUSTER_ROWS", 10)):
        monkeypatch.setattr(cpsjoin, name, value)
    rng = random.Random(4)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 7, 12])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = cpsjoin.near_duplicates(df, 2, depth=2).collect()
    assert {r.doc_id: r.component_id for r in got} == components(rows, 2)[0]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.vertex: r.root for r in connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_codec_equals_the_library():
    import sentencepiece
    path = queries.tokenizer_path()
    c, sp = codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    pieces = list(c._text.values())
    for k in range(6000):
        text = "".join(rng.choice("aabcdehilnorst   \n\t▁é<>/|.,0🙂日\x00") for _ in range(rng.randint(0, 30))) if k % 2 \
            else "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))).replace("▁", " ")
        ids = np.frombuffer(c.encode(text), "<u4").tolist()
        assert ids == sp.encode(text, add_bos=True, add_eos=True) and c.decode(ids) == sp.decode(ids), repr(text)


def test_html_equals_a_plain_reading(spark):
    pages = {r.page_id: r.html for r in load(spark, SF, "pages").collect()}
    for r in queries.op1_html_extraction(spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_html_without_an_article_loses_what_its_host_repeats(spark):
    def page(k):
        return (k, f"http://h.org/{k}", f"<body><div><b>Welcome to our site</b></div><div class=cookie-notice>Yes?</div>"
                f"<div><p>Story {k} is long.</p><p>It ends {k * 7}.</p></div><div id=comments><p>I agree {k}</p></div></body>")
    df = spark.createDataFrame([page(k) for k in range(9)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.main_texts(df).collect()}
    assert got == {k: f"Story {k} is long.\nIt ends {k * 7}." for k in range(9)}


def test_fingerprints_follow_the_contract(spark):
    rows = sorted((r.doc_id, r.text) for r in load(spark, SF, "documents").collect())
    got = {r.doc_id: r for r in queries.op2_document_fingerprints(spark, SF).collect()}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        edited = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        r = got[i]
        assert r.n_chars == len(text) and r.fingerprint == merkle.fingerprint(text)
        assert r.edited_fingerprint == merkle.fingerprint(edited)
        assert (r.near_edited == 1) == (edited == text)
    a, b = merkle.fingerprint("one line.\nsecond line.\nthird"), merkle.fingerprint("one line.\nother words.\nthird")
    assert merkle.differing_paragraphs(a, b) == ([1], [1])


def test_ball_tree_search_with_ties_and_large_numbers():
    rng = np.random.default_rng(3)
    for scale in (3, 2 ** 40):
        v = rng.integers(-2, 3, (300, 5)) * scale
        v[:120] = v[0]
        ids = rng.permutation(300).astype(np.int64)
        score, best = np.full((40, 7), np.iinfo(np.int64).min), np.full((40, 7), np.iinfo(np.int64).max)
        if scale > 3:
            v = v % 2 ** 30
        search(BallTree(ids, v), ids[:40], v[:40], 7, score, best)
        for k in range(40):
            want = sorted((-int(sum(int(a) * int(b) for a, b in zip(v[k], v[j]))), int(ids[j])) for j in range(300) if j != k)[:7]
            assert [(-int(s), int(i)) for s, i in zip(score[k], best[k])] == want


def test_toxicity_on_held_out_rows(spark):
    labels = load(spark, "/root/testdata/sf0.1", "labels")
    found = toxicity.score_toxicity(load(spark, "/root/testdata/sf0.1", "documents"), labels)
    n = {(r.toxic, r.predicted): r["count"] for r in found.where("held_out").join(labels, "doc_id")
         .groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.005 * n[0, 0]


def test_misspellings_and_quotations():
    m = toxicity.Matcher(["idiot$", "moron$", "vequ"], ["oron"])
    assert set(m.hits("An IDIOT, an id1ot, an oron and a vequeur; idiotic")) == {"idiot", "id1ot", "vequeur"}
    assert m.mass("you idiot") > m.mass('he wrote "you idiot" once') > 0
    assert m.mass("idiot moron") > m.mass("idiot" + " word" * 20 + " moron")


def test_quality_on_held_out_rows(spark):
    labels = load(spark, "/root/testdata/sf0.1", "labels")
    found = quality.score_quality(load(spark, "/root/testdata/sf0.1", "documents"), labels, holdout=True)
    aside = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    n = {(r.quality, r.predicted): r["count"] for r in found.where(aside).join(labels, "doc_id")
         .groupBy("quality", "predicted").count().collect()}
    assert n[0, 0] >= 0.95 * (n[0, 0] + n.get((0, 1), 0)) and n.get((1, 0), 0) <= 0.01 * n[1, 1]


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    out, texts = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in out.collect()} if k else {r.doc_id for r in docs.collect()}
        out = stage(spark, out, SF)
        texts[name] = (before, {r.doc_id for r in out.collect()})
        assert texts[name][1] <= before
    known = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    gone = texts["toxicity"][0] - texts["toxicity"][1]
    assert not [i for i in gone if known.get(i, (1, 1))[1] == 0]
    poor = texts["quality classifier"][0] - texts["quality classifier"][1]
    assert not [i for i in poor if known.get(i, (0, 0))[0] == 1]
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in texts["near-duplicates"][0]]
    least, _ = components(rows, 5)
    assert texts["near-duplicates"][1] == set(least.values())
    assert texts["mixing"][1] == texts["encoding"][1]
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == texts["encoding"][1]
