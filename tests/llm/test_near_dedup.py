import random
import re
from collections import Counter

import numpy as np

from tests.conftest import SMALL
from wardflow.llm import near_dedup as nd, queries, textscan as ts


def bag(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def like(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 1.0


def plain_classes(rows):
    """Classes by comparing all pairs that share a run."""
    bags = {i: bag(t) for i, t in rows}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for i, b in bags.items():
        for run in b or [()]:
            by.setdefault(run, []).append(i)
    pairs = {(a, b) for ids in by.values() for k, a in enumerate(ids) for b in ids[k + 1:]}
    for a, b in pairs:
        if like(bags[a], bags[b]) >= 0.8:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in bags}


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(3):
        a = {i: int(rng.integers(1, 40)) for i in range(50)}
        b = {i: a.get(i, 0) if rng.random() < 0.7 else int(rng.integers(1, 40)) for i in range(10, 60)}
        b = {i: w for i, w in b.items() if w}
        key = ts.mix(np.array([*a, *b], np.uint64) + np.uint64(99))
        sig = nd.signatures(np.array([0] * len(a) + [1] * len(b)), key, np.array([*a.values(), *b.values()]), 2, 8000)
        want = like(Counter(a), Counter(b))
        assert abs((sig[0] == sig[1]).mean() - want) < 4.5 * (want * (1 - want) / 8000) ** 0.5
    assert not nd.signatures(np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0, int), 2).any()


def test_query_over_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in queries.QUERIES["op8_bag_minhash"](spark, SMALL).collect()}
    assert got == plain_classes(rows)


def test_large_groups_chains_and_edge_rows(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=200)
    rows = [(i, " ".join(base)) for i in range(30)]
    for i in range(30, 130):  # near copies: a few words changed
        w = list(base)
        for k in rng.sample(range(200), 2):
            w[k] = rng.choice(words)
        rows.append((i, " ".join(w)))
    for i in range(130, 170):  # a chain: each is near its neighbours only
        base = base[4:] + rng.choices(words, k=4)
        rows.append((i, " ".join(base)))
    again = " ".join(rng.choices(words, k=3))
    rows += [(200, again), (201, again), (202, None), (203, ""), (204, " \n"), (205, "one two three four"), (206, "same " * 400), (207, "same " * 420), (208, "same " * 90000)]
    extra = rows + [(206, "same " * 400), (None, again), (None, "no other like this one here")]
    df = spark.createDataFrame([(*r, "x", 1) for r in extra], "doc_id long, text string, node string, n int")
    got = nd.classes(df).collect()
    assert len(got) == len(extra)
    want = plain_classes(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert Counter(r.class_id for r in got if r.doc_id is None) == Counter([200, None])
    kept = nd.one_of_each(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*set(want.values()), None, None])
    assert nd.classes(df.limit(0)).count() == 0 and nd.one_of_each(df.limit(0)).count() == 0


def test_one_of_each_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3), (2, "a b c d e f", 1, 2, 3), (None, "x", 1, 2, 3)], "doc_id long, text string, _name int, `class name` int, class_id int")
    got = nd.one_of_each(docs)
    assert got.columns == docs.columns and sorted(r.doc_id or 0 for r in got.collect()) == [0, 1]


def test_removal_deals_rows_alike_at_every_size(spark):
    docs = spark.createDataFrame([(i, "a b c d e f" if i < 3 else f"text {i}") for i in range(8)], "doc_id long, text string")
    kept = nd.one_of_each(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5, 6, 7]


def test_search_of_leaders_takes_few_rounds(spark, monkeypatch):
    rng = random.Random(21)
    words = [f"v{i}" for i in range(2000)]
    base, rows = rng.choices(words, k=150), []
    for i in range(160):
        w = list(base)
        for k in rng.sample(range(150), rng.choice((1, 2, 3, 4, 6))):
            w[k] = rng.choice(words)
        rows.append((i, " ".join(w)))
    rounds, plain = [], nd.joined
    monkeypatch.setattr(nd, "joined", lambda labels, edges: rounds.append(1) or plain(labels, edges))
    got = {r.doc_id: r.class_id for r in nd.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_classes(rows) and 0 < len(rounds) <= 2


def test_copies_around_the_threshold(spark):
    rng = random.Random(21)
    words = [f"v{i}" for i in range(2000)]
    base, rows = rng.choices(words, k=150), []
    for i in range(160):  # each copy is near the original, two copies are seldom near each other
        w = list(base)
        for k in rng.sample(range(150), rng.choice((1, 2, 3, 4, 6))):
            w[k] = rng.choice(words)
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame([*rows, *[(i, t) for i, t in rows[:3]], (7, "another text of one id")], "doc_id long, text string")
    bags = {i: bag(t) for i, t in rows}
    got = {r.doc_id: r.class_id for r in nd.classes(df).collect()}
    want = plain_classes(rows)
    assert len(set(want.values())) > 10 and {i: got[i] for i in want if i != 7} == {i: want[i] for i in want if i != 7}
    # The bound by parts is never under what two texts share, and close to it.
    signed = {r.doc_id: r.parts for r in nd.signed_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for a, b in [rng.sample(range(160), 2) for _ in range(300)]:
        most = sum(min(x, y) for x, y in zip(signed[a], signed[b]))
        assert sum(signed[a]) == sum(bags[a].values()) and most >= sum((bags[a] & bags[b]).values())


def test_classes_grow_by_new_edges_only(spark):
    rng = random.Random(4)
    ids = [rng.randrange(10**9) for _ in range(60)]
    edge = lambda n: [(rng.choice(ids), rng.choice(ids)) for _ in range(n)]
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    old, more = edge(25), edge(12)
    grown = nd.joined(nd.components(frame(old)), frame(more))
    want = {r.node: r.label for r in nd.components(frame(old + more)).collect()}
    got = {r.node: r.label for r in grown.collect()}
    # Only links of a node to itself are left out: it names its class without a row.
    assert {k: got.get(k, k) for k in want} == want and all(want[k] == v for k, v in got.items())
    assert {r.node: r.label for r in nd.joined(grown, frame([])).collect()} == got


def test_pairs_meet_only_rows_they_name(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 5)], "a long, b long")
    rows = spark.createDataFrame([(i, f"t{i}") for i in (1, 2, 2, 3, None)], "node long, text string")
    assert sorted(map(tuple, nd.named_in(rows, "node", pairs).collect())) == [(1, "t1"), (2, "t2"), (2, "t2")]
