"""Values at ranks, lab dictionaries, number text and chains of single parents."""

import random

from pyspark.sql import functions as F

from wardflow.functions import segments as G
from wardflow.operators import concepts as K, timeline_features as S


def test_values_at_ranks_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(G, "LEAST_BUCKETS", 7)
    rng = random.Random(1)
    rows = [(c, float(rng.choice([rng.randrange(40), rng.random() * 1000]))) for c, n in (("hot", 30_000), ("few", 3), ("one", 1)) for _ in range(n)]
    got = G.values_at_ranks(spark.createDataFrame(rows, "code string, v double"), "code", "v", lambda n: F.array(F.lit(0), F.floor(n / 3), n - 1, n + 5)).collect()
    for c in ("hot", "few", "one"):
        values = sorted(v for k, v in rows if k == c)
        want = {0: values[0], len(values) // 3: values[len(values) // 3], len(values) - 1: values[-1]}
        assert {r: x.v for x in got if x.code == c for r in x.ranks} == want


def test_ranges_use_all_values(spark):
    rng = random.Random(2)
    rows = [("a", rng.random()) for _ in range(25_000)] + [("b", float(i % 3)) for i in range(900)] + [("c", 1.0)] * 10 + [("d", None)]
    got = {r.code: r.ranges for r in S.numeric_ranges(spark.createDataFrame(rows, "code string, numeric_value double"), 1000).collect()}
    values = sorted(v for c, v in rows if c == "a")
    assert set(got) == {"a"} and got["a"] == [values[25_000 * i // 10] for i in range(1, 10)]
    b = S.numeric_ranges(spark.createDataFrame(rows, "code string, numeric_value double"), 100).where("code = 'b'").first()
    assert b.ranges == [1.0]


def test_numbers_have_six_digits(spark):
    cases = {
        "<0.123456789": "<0.123457", "<12345678": "<1.23457e+07", "<5.0": "<5", "<100": "<100", "<123456": "<123456", "<1234567": "<1.23457e+06",
        "<0.00012345678": "<0.000123457", "<0.0000123": "<1.23e-05", "<-2.50": "<-2.5", "<0": "<0", "<999999.7": "<1e+06", "<.5": "<0.5",
    }
    df = spark.createDataFrame([(c,) for c in cases], "w string")
    assert {r.w: r.c for r in df.select("w", S.clean_text(F.col("w")).alias("c")).collect()} == cases


EDGE = "code string, parent string, vocabulary string"


def recovered(spark, edges, mapped, unmapped):
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "code string")
    return {r.code: r.recovered for r in K.recover_unmapped(one(unmapped), spark.createDataFrame(edges, EDGE), one(mapped)).collect()}


def test_a_code_has_one_parent(spark):
    edges = [("x", "p1", "SNOMED"), ("x", "p2", "SNOMED"), ("y", "p1", "ICD10CM"), ("y", "long", "ICD10CM"), ("z", "p1", "SNOMED"), ("z", "p1", "SNOMED"),
             ("w", "zz", "ICD10CM"), ("w", "aa", "ICD10CM"), ("v", "x", "SNOMED"), (None, "p1", "SNOMED"), ("u", None, "SNOMED")]
    # Two parents outside ICD10CM give nothing, nor does a chain through such a code; ICD10CM takes the longest, then the smallest.
    assert recovered(spark, edges, ["p1", "long", "aa"], ["x", "y", "z", "w", "v", "u", "none"]) == {"y": "long", "z": "p1", "w": "aa"}
    assert recovered(spark, edges, ["p1", "zz"], ["y", "w"]) == {}


def test_long_chains_and_cycles(spark):
    chain = [(f"n{i}", f"n{i + 1}", "SNOMED") for i in range(700)]
    cycle = [("c0", "c1", "SNOMED"), ("c1", "c2", "SNOMED"), ("c2", "c0", "SNOMED"), ("tail", "c0", "SNOMED")]
    got = recovered(spark, chain + cycle, ["n700", "n350"], [f"n{i}" for i in range(700)] + ["c0", "tail"])
    assert got == {f"n{i}": "n350" if i < 350 else "n700" for i in range(700)}
    assert recovered(spark, [], ["a"], ["b"]) == {}
