import numpy as np
import pytest

from tests.conftest import SMALL
from wardflow.llm import mixing as mx, queries


def plain_rates(n, p, wanted):
    """Least squares over nonnegative rates by many plain projected steps from 1."""
    r, gram = np.ones(len(n)), (p * n[:, None]).T @ p
    scale = 1 / np.diag(gram)
    step = 1 / np.linalg.eigvalsh(np.sqrt(scale)[:, None] * gram * np.sqrt(scale)).max()
    for _ in range(400):
        r = np.maximum(0, r - step * p @ (scale * ((n * r) @ p - wanted)))
    return r


def test_query_meets_targets(spark):
    got = queries.QUERIES["op7_soft_mixing"](spark, SMALL).collect()
    assert len(got) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    n = np.array([r.n_tokens for r in got], float)
    p = np.array([[r.p_good, r.p_low, r.p_toxic] for r in got])
    rate = np.array([r.rate for r in got])
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
    weight = np.array([mx.TARGETS[d] for d in mx.DOMAINS])
    wanted = weight * (n @ p)[0] / weight[0]
    reached = (n * rate) @ p
    assert np.abs(reached - wanted).max() < 0.02 * wanted.sum()
    assert np.abs(rate - plain_rates(n, p, wanted)).max() < 0.05
    assert all(abs(r.copies - r.rate) < 1 for r in got)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "word " * 50000, 5), (None, "a b", 5), (4, "x y", 5), (4, "x y", 5)], "doc_id long, text string, rate int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = mx.mix(docs, none).collect()
    assert len(got) == 6 and all(r.rate == pytest.approx(1) and r.p_good == 1 for r in got)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (3, 1, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id, r.domain) for r in mx.domain_of(labels).collect()} == {(4, "low"), (3, "good")}
    assert mx.mix(docs, labels).count() == 6 and mx.mix(docs.limit(0), labels).count() == 0
    kept = mx.keep(docs, none)
    assert kept.columns == docs.columns and kept.count() == 6


def test_targets_out_of_reach_end_with_a_status(spark):
    rows = spark.createDataFrame([(10, [1.0, 0.0, 0.0])] * 5 + [(10, [0.5, 0.5, 0.0])] * 5, "n_tokens long, p array<double>")
    done = mx.fit(rows, {"good": 0.01, "low": 0.98, "toxic": 0.01})
    n, p = np.full(10, 10.0), np.array([[1.0, 0, 0]] * 5 + [[0.5, 0.5, 0]] * 5)
    assert done.status == "unreachable" and done.wanted[2] == 0
    want = (n * plain_rates(n, p[:, :2], np.array(done.wanted[:2]))) @ p[:, :2]
    assert np.abs(want - done.reached[:2]).max() < 0.01 * sum(done.wanted)
    assert mx.fit(rows, {"good": 0.5, "low": 0.4, "toxic": 0.1}, most_steps=1).status == "unfinished"
    assert mx.fit(rows, {"good": 0.75, "low": 0.25, "toxic": 0.0}).status == "met"


def test_few_labels_still_tell_the_domains_apart(spark):
    docs = spark.createDataFrame([(i, "buy now cheap pills" if i % 4 == 0 else f"the quiet river ran past house {i % 7}", "x") for i in range(80)], "doc_id long, text string, fit_status string")
    labels = spark.createDataFrame([(0, 0, 0), (4, 0, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in mx.mix(docs, labels, {"good": 0.9, "low": 0.09, "toxic": 0.01}).collect()}
    assert all((r.p_low > 0.5) == (i % 4 == 0) for i, r in got.items())
    n, p, rate = (np.array([f(r) for r in got.values()]) for f in (lambda r: r.n_tokens, lambda r: r.p_low, lambda r: r.rate))
    assert (n * p * rate).sum() < 0.5 * (n * p).sum()
