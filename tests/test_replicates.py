"""Replicate vectors and recalibration fits against loops, and the plans behind them."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_timeline_counts import made_rows
from wardflow.operators import evaluation as E, replicates as V

SCHEMA = "row_id int, grp string, labels int, pred_probs double, weights double, person_id int"


@pytest.fixture(scope="module")
def preds(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("ab"), rng.randrange(0, 2), rng.randrange(1, 40) / 41, float(rng.randrange(1, 4)), i % 90) for i in range(400)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_vectors_hold_the_draws(spark, preds):
    df = preds[1]
    for strata in (["grp"], []):
        want = {(*[r[s] for s in strata], r.person_id, r.boot_id): r.draws for r in E.boot_counts(df, 9, strata).collect()}
        got = {(*[r[s] for s in strata], r.person_id, b): n for r in V.draw_vectors(df, 9, strata).collect() for b, n in enumerate(r.draws) if n}
        assert got == want


def test_draws_over_several_blocks(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("person_id"))
    got = V.draw_vectors(df, 3).collect()
    assert np.sum([r.draws for r in got], axis=0).tolist() == [3000] * 3
    assert {(r.person_id, b): n for r in got for b, n in enumerate(r.draws) if n} == {(r.person_id, r.boot_id): r.draws for r in E.boot_counts(df, 3).collect()}


def test_metrics_match_weighted_rows(preds):
    df = preds[1]
    rows = V.with_draws(df, 12, ["grp"])
    got = {(r.grp, r.metric, r.boot_id): r.performance for r in V.replicate_metrics(rows, ["grp"], 12, "weights").collect()}
    want = {(r.grp, r.metric, r.boot_id): r.performance for r in E.evaluate(E.resampled(df, 12, ["grp"], "weights"), ["grp", "boot_id"], "boot_weight", V.METRICS).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert V.replicate_metrics(rows.where("labels = 1"), [], 12, metrics=("auc",)).first().performance == -1.0
    assert V.replicate_metrics(rows.limit(0), ["grp"], 12).count() == 0


def test_rows_do_not_grow_with_replicates(preds):
    df = preds[1]
    most = {n: made_rows(V.replicate_metrics(V.with_draws(df, n, ["grp"]), ["grp"], n, "weights", ("auc",)).groupBy("grp", "metric").agg(F.avg("performance")))[0] for n in (5, 40)}
    # Only the result has a row per replicate.
    assert most[40] <= max(most[5], 2 * 40)


def plain_fit(x, w, y):
    a = b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a + b * x)))
        g, h = w * (y - p), w * p * (1 - p)
        m = np.array([[h.sum(), (h * x).sum()], [(h * x).sum(), (h * x * x).sum()]])
        da, db = np.linalg.solve(m, [g.sum(), (g * x).sum()])
        a, b = a + da, b + db
    return a, b


def test_four_transforms_in_one_loop(preds):
    rows, df = preds
    names = (None, "log", "logit", "c_log_log")
    got = {(r.grp, r.transform): r for r in E.logistic_fits(df, ["grp"], "weights", names).collect()}
    assert len(got) == 8 and all(r.converged and r.status == "converged" for r in got.values())
    turn = {"raw": lambda s: s, "log": np.log, "logit": lambda s: np.log(s / (1 - s)), "c_log_log": lambda s: np.log(-np.log(1 - s))}
    for (g, n), r in got.items():
        own = np.array([(turn[n](x[3]), x[4], x[2]) for x in rows if x[1] == g])
        assert (r.a, r.b) == pytest.approx(plain_fit(*own.T), abs=1e-7)


def test_fits_without_a_finite_optimum_are_reported(spark, preds):
    rng = random.Random(3)
    noise = [("fine", rng.randrange(2), rng.uniform(.1, .9)) for _ in range(80)]
    apart = [("apart", int(p > .5), p) for p in (.1, .2, .3, .4, .6, .7, .8)]
    touching = [("touching", y, p) for y, p in ((0, .2), (0, .5), (1, .5), (1, .8))]
    level = [("level", i % 3 == 0, .3) for i in range(12)]
    nearly = [("nearly", i % 3 == 0, .3 + 1e-9 * (i % 2)) for i in range(12)]
    one = [("one", 1, p) for p in (.2, .4, .6)]
    rows = [(g, int(y), p) for g, y, p in noise + apart + touching + level + nearly + one]
    got = {r.grp: r for r in E.logistic_fits(spark.createDataFrame(rows, "grp string, labels int, pred_probs double"), ["grp"]).collect()}
    assert {g: r.status for g, r in got.items()} == {
        "fine": "converged", "apart": "separable", "touching": "separable", "level": "constant", "nearly": "constant", "one": "separable"}
    assert got["level"].b == 0 and 1 / (1 + math.exp(-got["level"].a)) == pytest.approx(1 / 3)
    shown = E.absolute_calibration_error(spark.createDataFrame(rows, "grp string, labels int, pred_probs double"), ["grp"])
    assert {r.grp for r in shown.collect() if r.converged} == {"fine"}


def test_a_step_that_overshoots_is_halved(spark):
    # Undamped steps from 0 diverge here: few rows far out on one side.
    rows = [("g", 1, 1 - 1e-12)] * 1 + [("g", 0, 1e-9)] * 200 + [("g", 0, .999)] * 2 + [("g", 1, .001)] * 2
    r = E.logistic_fits(spark.createDataFrame(rows, "grp string, labels int, pred_probs double"), ["grp"]).first()
    x = lambda p: math.log(p / (1 - p))
    p = lambda s: 1 / (1 + math.exp(-(r.a + r.b * x(s))))
    assert r.converged
    assert sum(y - p(s) for _, y, s in rows) == pytest.approx(0, abs=1e-6) and sum((y - p(s)) * x(s) for _, y, s in rows) == pytest.approx(0, abs=1e-5)


def test_curves_count_their_replicates(spark, preds):
    got = E.bootstrap_calibration_curve(preds[1], 6, ["grp"], ["grp"], "weights", points=3).collect()
    assert len(got) == 6 and all(r.n_converged == 6 and 0 < r.CI_lower <= r.CI_med <= r.CI_upper < 1 for r in got)


def test_no_cartesian_product(spark, preds):
    df = preds[1]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (E.evaluate_groups(df, [], "grp", "weights"), E.cross_auc(df, "grp"), E.expected_calibration_error(df, quantile=True), E.earth_movers(df, "grp"), E.one_versus_all(df, "grp")):
            assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_earth_movers_with_gaps_between_own_scores(spark):
    rng = random.Random(8)
    rows = [("a", 0, round(rng.uniform(.3, .6), 2)) for _ in range(300)] + [("b", 0, s) for s in (.05, .1, .95)] + [("c", 1, .45)]
    got = {r.grp: r.emd for r in E.earth_movers(spark.createDataFrame(rows, "grp string, labels int, pred_probs double"), "grp").collect()}
    points = sorted({r[2] for r in rows})
    cdf = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    for g in "abc":
        own, every = [r[2] for r in rows if r[0] == g], [r[2] for r in rows]
        assert got[g] == pytest.approx(sum(abs(cdf(own, x) - cdf(every, x)) * (y - x) for x, y in zip(points, points[1:])))
