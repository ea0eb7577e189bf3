"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripwire.llm import balltree, cpsjoin, html_template, merkle, mixing, piece_codec, quality, toxicity, url_trie, warc
from tripwire.llm.queries import URL_RULES, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, epoch int, " \
       "vertex long, key string, tokens string, kept boolean, bucket int"
PAGES = "page_id long, url string, html string, host string, verdict string, content string, text string, token long"
LABELS = "doc_id long, quality int, toxic int"
BIG = " ".join(f"w{k % 9973}x{k}" for k in range(60_000))


def doc(i, text, lang="en", source="src1"):
    return (i, text, lang, source, None if text is None else len(text), 0.5, 1, 2, "k", "t", True, 3)


def docs(spark, empty=False):
    rows = [doc(1, "Alpha beta gamma delta epsilon zeta."), doc(2, "alpha BETA gamma\tdelta epsilon zeta."), doc(3, None),
            doc(4, ""), doc(5, "  \n "), doc(6, "one"), doc(6, "one"), doc(7, BIG), doc(8, BIG + " tail"),
            doc(None, "Alpha beta gamma delta epsilon zeta."), doc(None, None, None, None),
            doc(9, "ein Wort.\nzwei Worte", None, None), doc(9, "another text under the same id", "en", None)]
    return spark.createDataFrame([] if empty else rows, DOCS)


def labels(spark, empty=False):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (6, 1, 0), (6, 1, 0), (7, 0, 1), (99, 1, 0)]
    return spark.createDataFrame([] if empty else rows, LABELS)


def pages(spark, empty=False):
    page = "<html><body><nav>Menu</nav><article><h1>T &amp; x</h1><p>a\n b<p>c</article></body></html>"
    big = f"<article><p>{BIG}</p></article>"
    rows = [(1, "http://A.example.org/es/x?q", page), (2, None, None), (3, "no scheme", ""), (4, "http://h.com", big),
            (5, "http://h.com/fr/", big), (5, "http://h.com/fr/", big), (None, "x://\r\nb", page), (6, "ftp://org", "<p")]
    return spark.createDataFrame([] if empty else [(*r, "h", "v", "c", "t", 1) for r in rows], PAGES)


def test_url_filter(spark):
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_trie.judge_urls(pages(spark), URL_RULES).collect()}
    assert got == {(1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "", "", None, "allow"),
                   (3, "", "", None, "allow"), (4, "h.com", "", None, "allow"), (5, "h.com", "/fr/", "com/fr/", "allow"),
                   (None, "\r\nb", "", None, "allow"), (6, "org", "", None, "allow")}
    assert url_trie.judge_urls(pages(spark, True), URL_RULES).collect() == []


def test_url_rules_in_parts_give_the_same(spark, monkeypatch):
    whole = sorted(map(str, url_trie.judge_urls(pages(spark), URL_RULES).collect()))
    monkeypatch.setattr(url_trie, "RULES_PER_TRIE", 2)
    assert sorted(map(str, url_trie.judge_urls(pages(spark), URL_RULES).collect())) == whole


def test_warc(spark):
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                 for r in warc.archive_pages(pages(spark)).collect())
    want = []
    for r in pages(spark).collect():
        data = (r.html or "").encode()
        want.append((r.page_id or 0, len(data), hashlib.sha1(data).hexdigest()))
    assert sorted(want) == [g[:3] for g in got]
    # 4, 5 and 5 have one large payload: one of the two fives is the response.
    assert sorted(g[3:] for g in got if g[0] in (4, 5)) == sorted(
        [("revisit", 5), ("revisit", 5), ("response", None)], key=str) or \
        [g[3] for g in got if g[0] in (4, 5)].count("response") == 1
    assert all(g[3:] == ("response", None) for g in got if g[0] not in (4, 5))
    assert warc.archive_pages(pages(spark, True)).collect() == []


def test_html(spark):
    got = {(r.page_id, r.text, r.n_chars) for r in html_template.main_texts(pages(spark)).collect()}
    text = "T & x\na b\nc"
    assert got == {(1, text, len(text)), (None, text, len(text)), (2, "", 0), (3, "", 0), (4, BIG, len(BIG)),
                   (5, BIG, len(BIG)), (6, "<p", 2)}
    assert html_template.main_texts(pages(spark, True)).collect() == []


def test_fingerprints(spark):
    got = merkle.fingerprint_documents(docs(spark)).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got if r.doc_id in (1, 3, 4, 8)}
    assert by[3].fingerprint == by[4].fingerprint == merkle.fingerprint("")
    first = "Alpha beta gamma delta epsilon zeta."
    assert by[1].edited_sha256 == hashlib.sha256((first[:18] + "alpha BETA gamma\t"+"d").encode()).hexdigest()
    assert merkle.fingerprint_documents(docs(spark, True)).collect() == []
    one = merkle.fingerprint_documents(docs(spark).where("doc_id = 1")).collect()[0]
    assert one.edited_sha256 == hashlib.sha256((first[:18] + first[:18]).encode()).hexdigest() and one.near_next == 1


def test_near_duplicates(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in cpsjoin.near_duplicates(docs(spark), 2).collect()}
    assert {g for g in got if g[0] in (1, 2, 3, 4, 5, 6)} == {
        (1, 5, 1, True), (2, 5, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True)}
    assert {(g[0], g[2], g[3]) for g in got if g[0] in (7, 8)} == {(7, 7, True), (8, 7, False)}
    assert all(g[2] is None and g[3] for g in got if g[0] is None)
    assert {g[2:] for g in got if g[0] == 9} == {(9, True)}
    assert cpsjoin.near_duplicates(docs(spark, True)).collect() == []


def test_codec(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    rows = piece_codec.encode_digests(docs(spark), tokenizer_path()).collect()
    want = sorted(len(sp.encode(r.text or "")) + 2 for r in docs(spark).collect())
    assert sorted(r.n_tokens for r in rows) == want
    assert piece_codec.encode_texts(docs(spark, True), tokenizer_path()).collect() == []


@pytest.mark.parametrize("no_docs,no_labels", [(False, False), (False, True), (True, False), (True, True)])
def test_classifiers(spark, no_docs, no_labels):
    for score in (toxicity.score_toxicity, quality.score_quality):
        rows = score(docs(spark, no_docs), labels(spark, no_labels)).collect()
        assert len(rows) == (0 if no_docs else 13)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_mixing(spark):
    rows = mixing.mix_sources(docs(spark), budget_share=2.0, epochs=2).collect()
    assert sorted((r.doc_id or 0) for r in rows) == sorted([d.doc_id or 0 for d in docs(spark).collect()] * 2)
    assert mixing.mix_sources(docs(spark, True)).collect() == []
    assert {r.source for r in rows} == {"src1", None}


def test_top_k(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, [1.0]), (7, [-1.0, 0.01]), (None, [1.0, 1.0]), (20, [1.0, 2.0]), (8, [])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, dim int, rank int")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in
           balltree.top_k(df, F.col("vec_id") % 20 == 0, k=2).orderBy("query_id", "rank").collect()]
    s = 64 * 64 + 128 * 128
    assert got == [(0, 1, 1, s), (0, 2, 20, s), (20, 1, 0, s), (20, 2, 1, s)]
    assert balltree.top_k(df.where("false"), F.col("vec_id") % 20 == 0).collect() == []


def test_pipeline_stages(spark, tmp_path):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    table = docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (table, table.where("false")):
        out = frame
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, out, str(tmp_path))
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == frame.columns
        out.collect()
