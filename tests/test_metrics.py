"""Metrics on small hand-made tables against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import comparison, evaluation as E, survival, timeline_features as S


@pytest.fixture(scope="module")
def preds(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("ab"), rng.randrange(0, 2), rng.randrange(1, 40) / 41, float(rng.randrange(1, 4)), i % 30) for i in range(200)]
    return rows, spark.createDataFrame(rows, "row_id int, grp string, labels int, pred_probs double, weights double, person_id int")


def auc(rows, w=lambda r: 1.0):
    pos, neg = [r for r in rows if r[2]], [r for r in rows if not r[2]]
    hits = sum(w(p) * w(n) * ((p[3] > n[3]) + 0.5 * (p[3] == n[3])) for p in pos for n in neg)
    return hits / sum(w(p) * w(n) for p in pos for n in neg)


def test_auc(preds):
    rows, df = preds
    got = {r.grp: r.auc for r in E.ranking_metrics(df, ["grp"], "weights").collect()}
    for g in "ab":
        assert got[g] == pytest.approx(auc([r for r in rows if r[1] == g], lambda r: r[4]))


def test_one_class_is_filled(preds):
    _, df = preds
    assert E.ranking_metrics(df.where("labels = 1"), []).first().auc == -1.0


def test_average_precision(preds):
    rows, df = preds
    total, recall, out = sum(r[2] for r in rows), 0.0, 0.0
    for s in sorted({r[3] for r in rows}, reverse=True):
        above = [r for r in rows if r[3] >= s]
        tp = sum(r[2] for r in above)
        out += (tp / total - recall) * tp / len(above)
        recall = tp / total
    assert E.ranking_metrics(df, []).first().auprc == pytest.approx(out)


def test_exact_quantiles(preds):
    import numpy as np

    rows, df = preds
    got = E.exact_quantiles(df, ["grp"], "pred_probs", [0.0, 0.1, 0.5, 0.93, 1.0]).collect()
    for r in got:
        assert list(r.edges) == pytest.approx(list(np.quantile([x[3] for x in rows if x[1] == r.grp], [0.0, 0.1, 0.5, 0.93, 1.0])))


def test_logistic_fit_solves_the_score_equations(preds):
    rows, df = preds
    fit = E.logistic_fit(df, [], "weights").first()
    x = lambda p: math.log(p / (1 - p))
    p = lambda r: 1 / (1 + math.exp(-(fit.a + fit.b * x(r[3]))))
    assert sum(r[4] * (r[2] - p(r)) for r in rows) == pytest.approx(0, abs=1e-6)
    assert sum(r[4] * (r[2] - p(r)) * x(r[3]) for r in rows) == pytest.approx(0, abs=1e-6)


def test_bootstrap_draws_keep_the_size(preds):
    rows, df = preds
    draws = E.boot_counts(df, 7, ["grp"])
    sizes = {r.grp: r.n for r in df.select("grp", "person_id").distinct().groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in draws.groupBy("boot_id", "grp").agg(F.sum("draws").alias("n")).collect():
        assert r.n == sizes[r.grp]


def test_bootstrap_curve_interval_is_ordered(preds):
    _, df = preds
    for r in E.bootstrap_calibration_curve(df, 4, [], ["grp"], points=5).collect():
        assert 0 < r.CI_lower <= r.CI_med <= r.CI_upper < 1


def test_earth_movers(preds):
    rows, df = preds
    got = {r.grp: r.emd for r in E.earth_movers(df, "grp").collect()}
    points = sorted({r[3] for r in rows})
    for g in "ab":
        own = [r[3] for r in rows if r[1] == g]
        every = [r[3] for r in rows]
        cdf = lambda xs, v: sum(x <= v for x in xs) / len(xs)
        want = sum(abs(cdf(own, a) - cdf(every, a)) * (b - a) for a, b in zip(points, points[1:]))
        assert got[g] == pytest.approx(want)


def test_noninferiority_ties_count_half(spark):
    diffs = spark.createDataFrame([(0, -0.05), (1, -0.05), (2, 0.1), (3, 0.2)], "boot_id int, diff double")
    control = spark.createDataFrame([("t", 1.0)], "task string, control double")
    assert comparison.noninferiority(diffs, control, 0.05).first().p_value == pytest.approx(0.5)


def test_survival_curve(spark):
    hazards = spark.createDataFrame([(1, 0, 0.0), (1, 1, 0.0), (1, 2, 0.0)], "row_id int, bin int, logit double")
    got = [r.survival for r in survival.survival_curve(hazards).orderBy("bin").collect()]
    assert got == pytest.approx([0.5, 0.25, 0.125])


def test_clean_text(spark):
    words = {"NEG": "negative", "Reactive": "positive", "See Note": "", "TNP/x": "", "<5.0": "<5", "<x": "<x", "Cloudy": "cloudy"}
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert {r.w: r.c for r in df.select("w", S.clean_text(F.col("w")).alias("c")).collect()} == words
