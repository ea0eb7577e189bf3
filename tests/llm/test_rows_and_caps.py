"""No row, word or vector is lost to a cap, and the pipeline judges rows, not ids."""
import numpy as np
import pytest

import corpus_pipeline
from tripwire.llm import balltree, quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
A = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
B = "one two three four five six seven eight nine ten"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def test_near_duplicates_keep_one_row_of_each_group(spark):
    rows = [(3, B), (5, A), (5, B), (9, A), (None, A), (None, B + " x"), (None, None), (4, "")]
    kept = corpus_pipeline.near_dedup(spark, docs(spark, rows), "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, B), (5, A), (None, None), (4, "")], key=str)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_and_poor_rows_go_with_or_without_an_id(spark, tmp_path):
    rude = ["you filthyword {} idiotword {}", "such filthyword of idiotword {} and {}", "idiotword {} with {} filthyword"]
    rows = [(k, (rude[k % 3] if k % 2 else "the house {} and the garden {}").format(f"w{k}", f"v{k % 7}")) for k in range(400)]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(400)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    extra = [(None, "filthyword idiotword again filthyword"), (None, "a garden and a house"), (7000, "filthyword idiotword filthyword"),
             (7000, "the quiet house")]
    left = corpus_pipeline.toxicity(spark, docs(spark, rows + extra), str(tmp_path))
    got = {(r.doc_id, r.text) for r in left.collect()}
    assert {(None, "a garden and a house"), (7000, "the quiet house")} <= got
    assert not got & {extra[0], extra[2]} and sum(i is not None and i < 400 for i, _ in got) == 200


def test_long_words_and_numbers_are_learned_from():
    assert toxicity._terms_of("x" * 45) == {"x" * k for k in range(4, 11)} | {"x" * 45 + toxicity.WHOLE}
    assert "1488" + toxicity.WHOLE in toxicity._terms_of("1488")




def test_vectors_of_every_length_are_searched(spark):
    rows = [(k, [float((k * 7 + j) % 5 - 2) for j in range(1 + k % 6)]) for k in range(60)]
    rows += [(100, [2.0 ** 40, 1.0]), (101, [None, 1.0]), (102, [float("inf")]), (103, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in balltree.top_k(frame, F.col("vec_id") % 20 == 0, k=3).collect()}
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for q in [i for i in whole if i % 20 == 0]:
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        want |= {(q, r): (i, -s) for r, (s, i) in enumerate(best[:3], 1)}
    assert got == want
    with pytest.raises(Exception, match="too large"):
        spark.createDataFrame([(0, [2.0 ** 60])], "vec_id long, embedding array<double>").select(balltree.quantised(F.col("embedding"))).collect()


def test_sums_are_one_row_however_many_partitions(spark):
    rows = [([float(k), 1.0], [float(k % 3)]) for k in range(200)]
    jobs = []
    for parts in (2, 16):
        pool = quality.Pool(spark.createDataFrame(rows, "a array<float>, b array<float>").repartition(parts))
        spark.sparkContext.setJobGroup(f"sum{parts}", "sum")
        got = pool.sum(lambda views: np.array([views[0].sum(), views[1].sum()]), 2)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sum{parts}")))
        assert got.tolist() == [sum(range(200)) + 200.0, float(sum(k % 3 for k in range(200)))]
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs[0] == jobs[1]
    empty = quality.Pool(spark.createDataFrame([], "a array<float>, b array<float>"))
    assert empty.sum(lambda views: np.ones(2), 2).tolist() == [0.0, 0.0]


def test_archives_with_large_pages_and_decisions_in_shares(spark, monkeypatch, tmp_path):
    """Files are bounded by bytes; what to leave out is told in parts; nothing is lost either way."""
    import hashlib

    from tripwire.llm import warc
    rows = [(k, f"http://h/{k}", ("x" * (50 if k % 5 else 3000)) + str(k % 4)) for k in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    def listed():
        return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                      for r in warc.archive_pages(frame, min_bytes=20).collect())
    want = []
    for k, _, page in rows:
        newest = max(j for j, _, other in rows if other == page)
        want.append((k, len(page), hashlib.sha1(page.encode()).hexdigest(), "response" if k == newest else "revisit",
                     None if k == newest else newest))
    assert listed() == sorted(want)
    monkeypatch.setattr(warc, "FILE_BYTES", 4000 * 100)
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 64)
    assert [c[2] for c in warc.size_classes(3001)] == [4000, 133] and listed() == sorted(want)
    warc.write_archives(frame.where("page_id < 10"), str(tmp_path / "a"))
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 10


def test_long_text_without_spaces_is_encoded_in_linear_time():
    import random
    import time

    import sentencepiece

    from tripwire.llm.piece_codec import PieceCodec
    from tripwire.llm.queries import tokenizer_path
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    codec, rng = PieceCodec(tokenizer_path()), random.Random(2)
    took = []
    for letters in ("abcdefghijklmnopqrstuvwxyz", "的一是不了人我在有他这中大来上国", "aä€𝄞.1"):
        for size in (40_000, 160_000):
            text = "".join(rng.choices(letters, k=size))
            at = time.perf_counter()
            got = codec.encode(text)
            took.append(time.perf_counter() - at)
            assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert all(b < 8 * a + 0.2 for a, b in zip(took[::2], took[1::2]))
