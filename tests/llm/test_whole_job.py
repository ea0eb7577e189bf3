"""Results that do not depend on how much of the input a bound lets through."""
import random

import numpy as np

from tripwire.llm import quality, toxicity
from tripwire.llm.common import load

LABELLED = "text string, label int"


def test_many_near_copies_do_not_push_terms_out_of_the_lexicon(spark):
    rare = " ".join(f"qw{k:04d}rare" for k in range(700))
    rows = [(f"{rare} copy{k}", 1) for k in range(60)] \
        + [(f"you zorgface number{k} of them", 1) for k in range(12)] \
        + [(f"a kind letter about subject{k} and you", 0) for k in range(300)]
    terms, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, LABELLED))
    assert any("zorgface".startswith(t.rstrip("$")) for t in terms)


def test_copies_of_a_text_explain_it_once(spark):
    rows = [("alphaword betaword gammaword", 1)] * 50 + [(f"kind letter{k}", 0) for k in range(300)]
    assert toxicity.learn_lexicon(spark.createDataFrame(rows, LABELLED))[0] == []


def test_lexicon_from_joined_rounds_is_that_of_the_driver(spark, monkeypatch):
    rng = random.Random(5)
    bad = ["idiot", "idiots", "moron", "vequ", "vequeur", "schwein", "schweine", "trottel", "clown", "foul"]
    rows = [(" ".join(rng.sample(bad, rng.choice((1, 2, 3))) + [f"n{k}"]), 1) for k in range(90)] \
        + [(f"kind letter{k}", 0) for k in range(400)]
    labelled = spark.createDataFrame(rows, LABELLED)
    want = toxicity.learn_lexicon(labelled)
    assert len(want[0]) >= 4
    monkeypatch.setattr(toxicity, "PAIRS_HELD", 0)
    monkeypatch.setattr(toxicity, "TERMS_HELD", 1)
    assert sorted(toxicity.learn_lexicon(labelled)[0]) == sorted(want[0])


def test_every_ordinary_spelling_is_kept(spark):
    letters = "bcefhjkpqrstuvwxyz"
    near = [f"m{a}l{b}gnoid" for a in letters for b in letters] + [f"ma{a}i{b}noid" for a in letters for b in letters] \
        + [f"mali{a}n{b}id" for a in letters for b in letters] + [f"malig{a}o{b}d" for a in letters for b in letters] \
        + [f"{a}a{b}ignoid" for a in letters for b in letters] + [f"mal{a}g{b}oid" for a in letters for b in letters] \
        + [f"{a}aligno{b}d" for a in letters for b in letters] + [f"m{a}ligno{b}d" for a in letters for b in letters] \
        + [f"ma{a}igno{b}d" for a in letters for b in letters] + [f"mal{a}gno{b}d" for a in letters for b in letters] \
        + [f"{a}ali{b}noid" for a in letters for b in letters] + [f"m{a}lig{b}oid" for a in letters for b in letters] \
        + [f"ma{a}ig{b}oid" for a in letters for b in letters] + [f"{a}alig{b}oid" for a in letters for b in letters]
    rows = [(f"you malignoid {k}", 1) for k in range(40)] + [(f"you kind {w}", 0) for w in near]
    terms, ordinary = toxicity.learn_lexicon(spark.createDataFrame(rows, LABELLED))
    assert len(toxicity.Matcher(terms).hits(" ".join(near))) > 4000
    assert not toxicity.Matcher(terms, [r.term for r in ordinary.collect()]).hits(" ".join(near))


def test_joined_ordinary_spellings_give_the_same_masses(spark, monkeypatch):
    texts = ["you idiot, an id1ot and an idixt", 'he wrote "you idiot" and idixt', "idixt", None, "", "moron moran idixts"]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (0, texts[1])], "doc_id long, text string")
    ordinary = spark.createDataFrame([("idixt",), ("moran",)], "term string")
    def masses():
        return sorted((r.doc_id is None, r.doc_id or 0, r.mass)
                      for r in toxicity.masses_of(docs, ["idiot", "moron$"], ordinary).collect())
    want = masses()
    monkeypatch.setattr(toxicity, "ORDINARY_HELD", 1)
    assert masses() == want and any(m for _, _, m in want)


def test_cover_reads_all_toxic_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "COVER_ROWS", 10, raising=False)
    rows = [(f"you filthmonger {k}" if k % 10 == 0 else f"you rotface {k}", 1) for k in range(200)] \
        + [(f"you kind letter {k}", 0) for k in range(800)]
    terms, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, LABELLED))
    assert {"filthmonger$", "rotface$"} <= set(terms)


def test_co_training_reads_all_unlabelled_rows(spark, monkeypatch):
    docs, labels = (load(spark, "/root/testdata/sf0.01", x) for x in ("documents", "labels"))
    def scores():
        return [r.score for r in quality.score_quality(docs, labels).orderBy("doc_id").collect()]
    want = scores()
    monkeypatch.setattr(quality, "POOL_ROWS", 5, raising=False)
    assert np.allclose(scores(), want, atol=1e-9)


def test_pool_sums_are_those_of_all_rows(spark):
    rng = np.random.default_rng(3)
    x = [rng.normal(size=(500, 2)).round(3), rng.normal(size=(500, 3)).round(3)]
    pool = quality.Pool(spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(*x)],
                                              "a array<double>, b array<double>").repartition(7))
    assert np.allclose(pool.sum(quality._moments, 11), quality._moments(x))
    done = [([(0.0, [4.0, 0.0]), (0.0, [0.0, 4.0, 0.0])], [(3.5, 4.0), (3.5, 4.0)])]
    got = quality.handed_over(done, x)
    assert (got[1] == 1).sum() == (4 * x[0][:, 0] >= 3.5).sum() and (got[0] == 0).sum() == (4 * x[1][:, 1] <= -4).sum()
    model = quality.Logistic().fit(x[0], (x[0][:, 0] > 0).astype(float), np.ones(500))
    other = quality.Logistic().fit(x[1], (x[1][:, 1] > 0).astype(float), np.ones(500))
    of = quality._steps(done, [model, other], [0.5, 0.5])
    assert np.allclose(pool.sum(of, 9 + 3 + 16 + 4), of(x))
