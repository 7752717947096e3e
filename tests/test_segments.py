"""Split windows against plain Python, with one key that holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardflow.functions import segments as S

BASE = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for key, n in ((1, 400), (2, 60), (3, 5)):
        for minute in sorted(rng.sample(range(0, 40 * 24 * 60), n)):
            out.append((key, BASE + timedelta(minutes=minute), rng.choice([-1, 0, 1, 2]), rng.random() if rng.random() < 0.4 else None))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, at timestamp_ntz, step int, v double")


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


def test_running_sum(frame, rows):
    want = {}
    for k, group in by_key(rows).items():
        total = 0
        for r in group:
            total += r[2]
            want[k, r[1]] = total
    assert {(r.k, r.at): r.total for r in S.running_sum(frame, ["k"], "at", "step", "total").collect()} == want


def test_next_row(frame, rows):
    want = {}
    for k, group in by_key(rows).items():
        for r, n in zip(group, group[1:] + [None]):
            want[k, r[1]] = n and n[1]
    assert {(r.k, r.at): r.after for r in S.next_row(frame, ["k"], ["at"], "at", {"after": "at"}).collect()} == want


def test_carry_last(frame, rows):
    want = {}
    for k, group in by_key(rows).items():
        held = None
        for r in group:
            held = r[3] if r[3] is not None else held
            want[k, r[1]] = held
    assert {(r.k, r.at): r.held for r in S.carry_last(frame, ["k"], ["at"], "at", "v", "held").collect()} == want


@pytest.mark.parametrize("closed", ["both", "left", "right"])
def test_window_join(spark, frame, rows, closed):
    rng = random.Random(9)
    spans = [(k, a := BASE + timedelta(hours=rng.randrange(0, 900)), a + timedelta(hours=rng.randrange(0, 300))) for k in (1, 2, 3) for _ in range(8)]
    windows = spark.createDataFrame(spans, "k int, lo timestamp_ntz, hi timestamp_ntz")
    got = S.window_join(windows, frame, ["k"], "lo", "hi", "at", days=3, closed=closed)
    left = (lambda a, b: a <= b) if closed in ("both", "left") else (lambda a, b: a < b)
    right = (lambda a, b: a <= b) if closed in ("both", "right") else (lambda a, b: a < b)
    want = sorted((k, a, b, r[1]) for k, a, b in spans for r in rows if r[0] == k and left(a, r[1]) and right(r[1], b))
    assert sorted((r.k, r.lo, r.hi, r.at) for r in got.collect()) == want


def test_overlap_join(spark):
    rng = random.Random(3)
    day = lambda: BASE.date() + timedelta(days=rng.randrange(0, 200))
    spans = lambda n: [(rng.choice([1, 1, 1, 2]), a := day(), a + timedelta(days=rng.randrange(0, 90))) for _ in range(n)]
    left, right = spans(30), spans(30)
    a = spark.createDataFrame(left, "k int, a date, b date")
    b = spark.createDataFrame(right, "k int, c date, d date")
    want = sorted((k, x, y, c, d) for k, x, y in left for j, c, d in right if j == k and x <= d and c <= y)
    got = S.overlap_join(a, b, ["k"], ("a", "b"), ("c", "d"), days=7)
    assert sorted((r.k, r.a, r.b, r.c, r.d) for r in got.collect()) == want


def test_dense_index(spark):
    words = [f"w{(i * 7919) % 1000:04d}" for i in range(500)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(7).distinct()
    got = {r.w: r.i for r in S.dense_index(df, ["w"], "i").collect()}
    assert got == {w: i for i, w in enumerate(sorted(set(words)))}


def test_value_order(spark):
    rng = random.Random(2)
    data = [(k, rng.randrange(0, 300) / 7, rng.randrange(1, 4)) for k, n in (("a", 900), ("b", 20)) for _ in range(n)]
    df = spark.createDataFrame(data, "k string, v double, n int")
    got = {(r.k, r.v): (r.n, r.upto) for r in S.value_order(df, ["k"], "v", {"upto": "n"}, buckets=8).collect()}
    want = {}
    for k in ("a", "b"):
        total = 0
        for v in sorted({r[1] for r in data if r[0] == k}):
            n = sum(r[2] for r in data if r[0] == k and r[1] == v)
            total += n
            want[k, v] = (n, total)
    assert got == want


def test_hash_rank_is_a_permutation(spark):
    from wardflow.functions.hashing import key_hash

    got = [r["rank"] for r in S.hash_rank(spark.range(1000).withColumnRenamed("id", "p"), [], key_hash("p", seed=3)).collect()]
    assert sorted(got) == list(range(1000))


def test_sha256_modulo(spark):
    import hashlib

    from wardflow.functions.hashing import little_endian, sha256_mod

    seed = 42
    data = F.concat(little_endian(F.lit(seed), 8), little_endian(F.col("id"), 8))
    got = {r.id: r.m for r in spark.range(200).select("id", sha256_mod(data, F.lit(7)).alias("m")).collect()}
    digest = lambda i: int.from_bytes(hashlib.sha256(seed.to_bytes(8, "little") + i.to_bytes(8, "little")).digest(), "little")
    assert got == {i: digest(i) % 7 for i in range(200)}


def test_shared_folder_is_the_named_one(spark):
    assert S.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    out = S.durable(spark.range(5))
    assert out.count() == 5 and spark.conf.get("spark.checkpoint.dir") in out.inputFiles()[0]
