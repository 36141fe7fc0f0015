"""PU learning against its definitions: prior, risk, calibration, odd rows."""

import numpy as np
import pytest
from crewload.llm import quality

DOC = "doc_id long, text string, quality int, x string, score double"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 0, "x", 0.5) for i, t in texts], DOC)


def mixture(prior, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.random(n) < prior
    x = rng.normal(0, 1, (n, 6)) + np.where(y, 2.0, -2.0)[:, None] * (np.arange(6) < 3)
    return rng.normal(0, 1, (n // 3, 6)) + 2.0 * (np.arange(6) < 3), x, y


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.85])
def test_prior_and_probabilities_without_negatives(prior):
    positive, web, y = mixture(prior)
    found = quality.estimate_prior(positive, web)
    assert abs(found - prior) < 0.06
    model = quality.fit_pu(positive, web, found)
    quality.calibrate(model, positive, web, found)
    score = model.score(web)
    assert ((score >= 0.5) == y).mean() > 0.97 and abs(score.mean() - found) < 0.02


def test_calibration_minimises_the_pu_risk():
    positive, web, _ = mixture(0.6, 900, 1)
    model = quality.fit_pu(positive, web, 0.6)
    quality.calibrate(model, positive, web, 0.6)

    def risk(slope, shift):
        s = slope * model.raw(web) + shift
        scaled = slope * model.raw(web).std()
        return np.logaddexp(0, s).mean() - 0.6 * (slope * model.raw(positive) + shift).mean() + 5e-4 * scaled**2

    least = risk(model.slope, model.shift)
    around = [risk(model.slope * a, model.shift + b) for a in (0.8, 0.95, 1, 1.05, 1.25) for b in (-0.5, -0.1, 0, 0.1, 0.5)]
    assert least <= min(around) + 1e-6


def test_too_few_rows_still_give_a_model():
    assert quality.estimate_prior(np.zeros((1, 3)), np.zeros((9, 3))) == 0.5
    assert 0.05 <= quality.estimate_prior(np.zeros((4, 3)), np.zeros((4, 3))) <= 0.95  # all ties


def test_odd_rows(spark):
    long = "alpha beta gamma. " * 30_000
    good = [(i, " ".join("lorem ipsum dolor sit amet elit".split()[(i + k) % 6] for k in range(40)) + ".") for i in range(80)]
    junk = [(100 + i, "## $$ %% " * (20 + i)) for i in range(80)]
    docs = docs_of(spark, [*good, *junk, (900, None), (901, ""), (902, long), (902, long), (None, "lorem ipsum")])
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + junk[:20]] + [(0, 0), (None, 1), (1, None), (5, 7)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert len(got) == 165 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.held_out for r in got}[None] is False
    same = [r.score for r in got if r.doc_id == 902]
    assert same[0] == same[1]
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in got if r.score >= quality.THRESHOLD} == {r.doc_id for r in kept.collect()}
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, none) is None and quality.keep_quality(docs, None).count() == 165
    assert quality.score_quality(docs_of(spark, []), model).collect() == []
