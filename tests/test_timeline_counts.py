"""Counts up to label days: against loops, and without pairs of label days and events."""

import random
from bisect import bisect_right
from datetime import date, timedelta

import pytest

from wardflow.operators import timeline_features as S

START = date(1950, 1, 1)


def made_rows(df):
    """Largest number of rows that any operator of the executed plan put out."""
    df.write.format("noop").mode("overwrite").save()
    plan, most, seen = df._jdf.queryExecution().executedPlan(), 0, 0
    rows = df.collect()
    stack = [plan]
    while stack:
        node = stack.pop()
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            most, seen = max(most, metrics.apply("numOutputRows").value()), seen + 1
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    assert seen > 5
    return most, rows


def tables(spark, labels, events):
    points = spark.createDataFrame([(p, i, START + timedelta(d)) for p, i, d in labels], "person_id long, day_index long, day date")
    counted = spark.createDataFrame([(p, c, START + timedelta(d), n) for p, c, d, n in events], "person_id long, concept_id string, at date, n long")
    return points, counted


@pytest.mark.parametrize("bins,strictly", [(None, False), (None, True), ([90, 365, None], False), ([30, None], True)])
def test_counts_match_loops(spark, bins, strictly):
    rng = random.Random(5)
    labels = [(p, i, d) for p in range(8) for i, d in enumerate(sorted(rng.sample(range(900), 25)))]
    events = [(p, c, d, rng.randint(1, 3)) for p in range(1, 9) for c in "abc" for d in rng.sample(range(900), rng.choice([0, 1, 40]))]
    ends = S.bins_before(bins, strictly)
    got = {(r.person_id, r.day_index, r.concept_id, r.bin): r.n for r in S.counts_before(*tables(spark, labels, events), ends).collect()}
    want = {}
    for p, i, at in labels:
        for q, c, d, n in events:
            if p == q and d <= at + ends[0]:
                b = max(k for k, e in enumerate(ends) if d <= at + e)
                want[p, i, c, b] = want.get((p, i, c, b), 0) + n
    assert got == want


def test_one_person_with_many_labels_and_events(spark):
    rng = random.Random(6)
    labels = [(1, i, d) for i, d in enumerate(sorted(rng.sample(range(20_000), 5_000)))]
    events = [(1, f"c{k}", d, 1) for k in range(6) for d in rng.sample(range(20_000), 16_667)]
    most, got = made_rows(S.counts_before(*tables(spark, labels, events), [0]))
    assert most <= len(events) + len(labels) + len(got)
    days = {f"c{k}": sorted(d for _, c, d, _ in events if c == f"c{k}") for k in range(6)}
    at = {i: d for _, i, d in labels}
    assert all(r.n == bisect_right(days[r.concept_id], at[r.day_index]) for r in got)
    assert len(got) == sum(d >= days[c][0] for c in days for d in at.values())
