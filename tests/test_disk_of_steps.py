"""What intermediate steps leave on disk: shuffle files of writes, passes over persons, orders without a shuffle."""

import os
import time

from pyspark.sql import functions as F

from wardflow.functions import segments as seg
from wardflow.functions.hashing import key_hash
from wardflow.operators import labelers as B, ontology as G, timeline as T, timeline_features as S
from wardflow.sources import writers


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_writes_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(5000).select((F.col("id") % 97).alias("person_id"), "id")
    seg.durable(rows.groupBy("person_id").agg(F.max("id").alias("m")).repartition(3))
    seg.bucketed(rows, "person_id", 4)
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_passes_give_the_rows_of_one_step_in_buckets(spark):
    rows = seg.durable(spark.range(3000).select(F.when(F.col("id") % 50 > 0, F.col("id") % 50).alias("person_id"), (F.col("id") % 7).alias("c")))
    step = lambda part: part.groupBy("person_id", "c").agg(F.count(F.lit(1)).alias("n"))
    found = seg.in_passes(rows, "person_id", step, buckets=8, passes=3)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, step(rows).collect()), key=str)
    assert seg.place_of(found, "person_id") == 8 and "Exchange" not in plan(found.groupBy("person_id", "c").count())


def test_rows_from_a_rank_equal_ranked_rows(spark):
    rows = spark.range(9000).withColumnRenamed("id", "k")
    ranked = seg.hash_rank(rows, [], key_hash("k", seed=3))
    for first in (0, 1, 4321, 8999, 9000, -5):
        one = spark.createDataFrame([(first,)], "rank bigint")
        got = sorted(r.k for r in seg.from_rank(rows, key_hash("k", seed=3), one).collect())
        assert got == sorted(r.k for r in ranked.where(F.col("rank") >= first).collect())


def held(spark):
    rows = [(p, 100 * d, f"v/{c}", None, None) for p in range(1, 9) for d in range(1, 5) for c in range(d)]
    events = spark.createDataFrame(rows, "person_id long, age int, code string, numeric_value double, text_value string").withColumn("day", F.date_add(F.lit("2000-01-01").cast("date"), F.col("age")))
    return spark.table(seg.bucketed(events, "person_id", 8))


def test_counts_up_to_a_day_are_ordered_without_a_shuffle(spark):
    events = held(spark)
    days = spark.table(seg.bucketed(T.day_table(events), "person_id", 8))
    counted = S.counted_codes(events, G.is_recorded(["v"]))
    points = S.beside(days.select("person_id", "day_index", "day", "age"), days)
    found = S.count_features(points, counted, S.count_vocabulary(counted))
    assert "Exchange hashpartitioning(person_id" not in plan(found)
    want = sorted((p, i, c, float(sum(c < d for d in range(1, i + 2)))) for p in range(1, 9) for i in range(4) for c in range(i + 1))
    assert sorted(map(tuple, found.collect())) == want


def test_codes_given_by_a_test_or_a_table_count_alike(spark):
    events, recorded = held(spark), spark.createDataFrame([(f"v/{c}",) for c in range(4)], "code string")
    edges = spark.createDataFrame([("v/0", "r"), ("v/1", "r"), ("v/2", "s")], "code string, parent string")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    for closure in (None, G.closure(edges)):
        assert rows(S.counted_codes(events, recorded, closure)) == rows(S.counted_codes(events, G.is_recorded(["v"]), closure))
    codes = S.day_codes(events, G.is_recorded(["v"]), G.closure(edges))
    assert rows(codes) == rows(S.day_codes(events, recorded, G.closure(edges)))
    assert seg.place_of(codes, "person_id") == 8


def test_days_of_a_code_stay_in_buckets(spark):
    events = held(spark)
    days = spark.table(seg.bucketed(T.day_table(events), "person_id", 8))
    marked = B.code_days(events, spark.createDataFrame([("v/2",)], "code string"))
    assert seg.place_of(marked, "person_id") == 8
    with seg.writing(spark, co_located=True):
        assert "Exchange hashpartitioning" not in plan(B.fixed_horizon(days, marked, 150))


def test_drug_classes_walk_from_the_classes_only(spark, monkeypatch):
    starts = []
    monkeypatch.setattr(G, "closure", lambda edges, nodes, walk=G.closure: starts.append(sorted(r.code for r in nodes.collect())) or walk(edges, nodes))
    frame = spark.createDataFrame
    relations = frame([("b", "a", "has_form"), ("c", "b", "has_part"), ("a", "c", "has_part"), ("z", "a", "other")], "child string, parent string, relation string")
    atoms = frame([("a", "RXNORM", "a"), ("c", "ATC", "C1"), ("z", "ATC", "Z1")], "concept string, vocabulary string, code string")
    found = G.drug_classes(frame([("a", "NDC", "n1"), ("b", "NDC", "n2"), ("x", "NDC", "n3")], "concept string, vocabulary string, code string"), relations, atoms)
    assert sorted(map(tuple, found.collect())) == [("NDC", "n1", "ATC/C1"), ("NDC", "n2", "ATC/C1"), ("RxNorm", "a", "ATC/C1")]
    assert starts == [["c", "z"]]


def test_timeline_json_is_compressed(spark, tmp_path):
    path = str(tmp_path / "json")
    names = spark.createDataFrame([("v/0", "zero")], "code string, definition string")
    writers.write_timeline_json(T.timeline_json(T.day_records(held(spark)), names), path)
    assert all(f.endswith(".json.gz") for f in os.listdir(path) if f.startswith("part-"))
    assert spark.read.json(path).count() == 32
