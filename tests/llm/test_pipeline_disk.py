"""The pipeline's first stages neither write nor shuffle the texts that they keep."""
import glob
import os

import pytest

import corpus_pipeline
from tripwire.llm import quality, toxicity
from tripwire.llm.common import scratch

RUDE = ["you filthyword {} idiotword {}", "such filthyword of idiotword {} and {}", "idiotword {} with {} filthyword"]
POOR = "*** {} $$$ {} ||| ### !!! @@@"


@pytest.fixture()
def tables(spark, tmp_path):
    """400 labelled rows, kind, rude or poor, and some without an id, with a repeated one, or come twice."""
    def text(k):
        return (RUDE[k % 3] if k % 4 == 1 else POOR if k % 4 == 2 else "the house {} and the garden {}").format(f"w{k}", f"v{k % 7}")
    rows = [(k, text(k), "en", "s", len(text(k))) for k in range(400)] + [
        (None, text(1), "en", None, None), (None, text(3), None, "s", 5), (7000, text(5), "en", "s", 9), (7000, text(7), "en", "s", 9),
        (8000, text(11), "de", "s", 9), (8000, text(11), "de", "s", 9), (None, None, None, None, None), (9000, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 4 != 2), int(k % 4 == 1)) for k in range(400)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def _columns_written(spark, before):
    new = {p for p in glob.glob(f"{_root(spark)}/**/*.parquet", recursive=True)} - before
    return {c for p in new for c in spark.read.parquet(p).columns}


def _root(spark):
    return os.path.dirname(scratch(spark, "x")).removeprefix("file:")


def _all(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("stage", [corpus_pipeline.toxicity, corpus_pipeline.quality])
def test_texts_are_neither_written_nor_shuffled(spark, tables, stage):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before = set(glob.glob(f"{_root(spark)}/**/*.parquet", recursive=True))
    out = stage(spark, docs, tables)
    assert "text" not in _columns_written(spark, before)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Join" not in plan
    assert 0 < out.count() < docs.count()


def test_rows_are_judged_as_by_the_scores(spark, tables, monkeypatch):
    """The same scores whether they come by id or beside the rows, in any way that ordinary spellings are looked up."""
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    for score in (toxicity.score_toxicity, quality.score_quality):
        by_id = score(docs, labels)
        beside = score(docs, labels, judged="found")
        assert beside.columns == [*docs.columns, "found"]
        assert _all(beside.drop("found")) == _all(docs)
        assert _all(beside.select("doc_id", "found.*")) == _all(by_id)
    want = _all(toxicity.score_toxicity(docs, labels, judged="found"))
    learned = toxicity.learn_lexicon
    many = spark.createDataFrame([("qqqqq",), ("zzzzz",)], "term string")
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda rows: (learned(rows)[0], many))
    monkeypatch.setattr(toxicity, "ORDINARY_HELD", 1)
    assert _all(toxicity.score_toxicity(docs, labels, judged="found")) == want


def test_run_leaves_one_stage(spark, tables):
    before = set(os.listdir(_root(spark))) if os.path.isdir(_root(spark)) else set()
    out = corpus_pipeline.run(spark, tables)
    assert out.count() > 0
    assert sum(n.startswith("stage") for n in set(os.listdir(_root(spark))) - before) == 1
