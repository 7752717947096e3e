"""Fitted state, stored tables, row maps and sparse models."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.functions.segments import shared_folder
from wardflow.operators import fitted, models as L, splits as P, survival as V, timeline as T
from wardflow.sources import store as W, writers

EVENT = "person_id bigint, day date, age int, code string, numeric_value double, text_value string"


def events(spark, patients, shift=0.0):
    from datetime import date, timedelta

    rng = random.Random(4)
    rows = [(p, date(2000, 1, 1) + timedelta(d), d, c, rng.random() + (shift if p >= 50 else 0.0), None) for p in range(patients) for d in range(4) for c in ("lab/a", "lab/b")]
    return spark.createDataFrame(rows, EVENT)


def test_state_is_learnt_from_training_patients_and_reloaded(spark):
    rows = events(spark, 100, shift=1000.0)
    points = rows.where("age = 3").select("person_id", F.lit(3).alias("day_index"), "day", "age").distinct()
    recorded = spark.createDataFrame([("lab/a",)], "code string")
    train = spark.range(50).select(F.col("id").alias("person_id"))
    state = fitted.fit(rows, points, recorded, train, num_bins=4)
    assert state.bins.agg(F.max("low")).first()[0] < 1.0  # nothing of the others, whose values are over 1,000
    path = f"{shared_folder(spark)}/state-test"
    state.save(path)
    again = fitted.load(spark.newSession(), path)
    assert sorted(map(tuple, again.bins.collect()), key=repr) == sorted(map(tuple, state.bins.collect()), key=repr)
    assert again.about.first().patients == 50 and {r.code for r in again.dictionary.collect()} == {"lab/a"}
    coded = again.encode(rows.select("person_id", "day", "code"))
    assert coded.columns == ["person_id", "day", "code_id"] and coded.count() == 400
    assert again.decode(coded).select("code").distinct().first().code == "lab/a"
    assert again.value_counts(points, rows).where("person_id >= 50").agg(F.sum("value")).first()[0] == 200
    with pytest.raises(Exception):
        state.save(path)


def test_state_of_another_format_is_refused(spark, monkeypatch):
    rows = events(spark, 3)
    points = rows.where("age = 3").select("person_id", F.lit(3).alias("day_index"), "day", "age").distinct()
    nobody = spark.createDataFrame([], "person_id bigint")
    state = fitted.fit(rows, points, spark.createDataFrame([("lab/a",)], "code string"), nobody)
    assert state.bins.count() == 0 and state.about.first().patients == 0
    path = f"{shared_folder(spark)}/state-other"
    state.save(path)
    monkeypatch.setattr(fitted, "FORMAT", 2)
    with pytest.raises(ValueError):
        fitted.load(spark, path)


def buckets_read(df) -> str:
    """What the plan says of the buckets, which it shows where a scan is not turned into a plain one (it prunes files alike)."""
    spark, name = df.sparkSession, "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(name, "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(name)
    return plan[plan.index("SelectedBucketsCount"):].split("\n")[0].split(",")[0]


def test_timeline_store_reads_the_buckets_it_needs(spark):
    rows = events(spark, 40)
    edges = spark.createDataFrame([("lab/a", "lab")], "code string, parent string")
    W.TimelineStore.create("shelf", rows, edges, buckets=16)
    store = W.TimelineStore.open(spark, "shelf")
    one = store.inspect(patient_id=7)
    assert {(r.person_id, r.patient_id) for r in one.collect()} == {(7, 7)} and "1 out of 16" in buckets_read(one)
    few = store.patients([3, 11], "2000-01-02", "2000-01-04")
    assert few.count() == 8 and "out of 16" in buckets_read(few) and "16 out of 16" not in buckets_read(few)
    assert store.patients_with(["lab/b"]).count() == 40 and "1 out of 16" in buckets_read(store.patients_with(["lab/b"]))
    # Ids are dealt to the stored buckets; the events themselves are not shuffled.
    people = spark.range(0, 40, 5).select(F.col("id").alias("person_id"))
    assert store.of(people).count() == 64
    kept = store.subset("shelf_kept", people)
    assert kept.part("events").count() == 64 and kept.part("dictionary").count() == 2 and kept.part("ontology").count() == 1
    assert store.inspect(person_id=999).count() == 0
    with pytest.raises(ValueError):
        W.TimelineStore.open(spark, "nothing")


def test_a_table_is_replaced_whole(spark):
    W.replace_table(spark.range(3), "swap")
    before = spark.table("swap")
    with pytest.raises(Exception):
        W.replace_table(spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), "swap")
    assert spark.table("swap").count() == 3
    W.replace_table(spark.createDataFrame([("2020-02-03", None), (None, 1)], "d string, k int"), "swap", dates=["d"])
    assert dict(spark.table("swap").dtypes) == {"d": "date", "k": "int"} and spark.table("swap").count() == 2
    assert before.count() == 3  # readers of the version before go on


def test_a_date_before_the_timeline_is_an_error(spark):
    days = events(spark, 1).select("person_id", "day", F.col("age").alias("day_index")).distinct()
    asked = spark.createDataFrame([(0, "1999-12-31")], "person_id bigint, date string").withColumn("date", F.to_date("date"))
    assert T.day_index_of(days, asked).first().day_index is None
    with pytest.raises(Exception, match="no timeline day"):
        T.day_index_of(days, asked, required=True).collect()


def test_row_maps_number_each_split(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["test", "val", "1", "2"]), f"{rng.choice([2000, 2001, 2002])}-05-05") for i in range(200)]
    df = spark.createDataFrame(rows, "prediction_id bigint, fold_id string, d string").withColumn("admit_date", F.to_date("d"))
    years = {"train": (2000, 2001), "val": (2002, 2002), "test": (2002, 2002)}
    got = P.split_rows(df, years)
    path = f"{shared_folder(spark)}/maps"
    writers.write_row_maps(got, path)
    for name, (a, b) in years.items():
        want = sorted(i for i, f, d in rows if (f if f in ("test", "val") else "train") == name and a <= int(d[:4]) <= b)
        back = sorted((r.row_idx, r.prediction_id) for r in writers.read_row_map(spark, path, name).collect())
        assert back == list(enumerate(want))
    triples = spark.createDataFrame([(0, 5, 2.0), (1, 5, 1.0)], "features_row_id bigint, col_id bigint, value double")
    places = spark.createDataFrame([(want[0], 0), (10_000, 1)], "row_id bigint, features_row_id bigint")
    assert [tuple(r) for r in P.split_matrix(triples, places, got).collect()] == [("test", 0, 5, 2.0)]


def test_quartiles_by_group(spark):
    rows = [("a", float(i), None if i % 2 else 1.0) for i in range(11)] + [("b", 4.0, None)]
    got = {(r.g, r.variable): (r.n, r.q25, r.median, r.q75) for r in P.group_quartiles(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], ["x", "y"]).collect()}
    assert got == {("a", "x"): (11, 2.5, 5.0, 7.5), ("a", "y"): (6, 1.0, 1.0, 1.0), ("b", "x"): (1, 4.0, 4.0, 4.0)}


def test_unique_edges(spark):
    rows = spark.createDataFrame([(i, float(t), int(e)) for i, (t, e) in enumerate([(3, 1), (5, 1), (5, 0), (4, 0), (1, 0), (9, 0)])], "i int, t double, event int")
    got = {r.i: r.time_bin for r in V.time_bin_unique(rows, rows.where("event = 1"), "t").collect()}
    assert got == {0: 1, 1: 2, 2: 2, 3: 1, 4: 0, 5: 2}  # edges 0, 3, 5


def test_cells_of_sparse_and_dense_vectors(spark):
    from pyspark.ml.linalg import Vectors

    wide = 2_000_000_000  # an array of as many columns cannot be formed
    rows = [(0, Vectors.sparse(wide, [(3, 1.5), (wide - 1, -2.0), (7, 0.0)])), (1, Vectors.dense([0.0, 4.0, 0.0])), (2, Vectors.sparse(5, []))]
    got = spark.createDataFrame(rows, ["k", "v"]).select("k", F.inline(L.cells("v"))).collect()
    assert sorted(map(tuple, got)) == [(0, 3, 1.5), (0, wide - 1, -2.0), (1, 1, 4.0)]


def test_sparse_models(spark):
    rng = np.random.default_rng(3)
    cells = [(i, int(c), float(rng.integers(1, 3))) for i in range(300) for c in rng.choice(400, 4, replace=False)]
    labels = [(i, int(sum(c < 150 for k, c, _ in cells if k == i) >= 2), i % 3) for i in range(300)]
    triples = spark.createDataFrame(cells, "k bigint, column bigint, value double")
    rows = L.assemble(triples, 400, ["k"]).join(spark.createDataFrame(labels, "k bigint, labels int, part int"), "k")
    vectors = {r.k: r.features for r in rows.collect()}
    assert all(type(v).__name__ == "SparseVector" and v.size == 400 for v in vectors.values())
    assert all(vectors[k][c] == v for k, c, v in cells)
    train, val = rows.where("part < 2"), rows.where("part = 2")
    scored = L.logistic_grid(train, val, strengths=[1e-6, 0.1])
    own = triples.join(train.select("k"), "k")
    assert [L.gradient(m, train, own, ["k"], s["regParam"]) < 1e-5 for _, s, m in scored] == [True, True]
    assert L.best(scored)[1]["regParam"] == pytest.approx(1 / (0.1 * 200)) and L.best(scored)[0] < 0.69
    assert len(L.LOGISTIC_C) == 7 and len(L.BOOSTING_GRID["stepSize"]) * len(L.BOOSTING_GRID["maxDepth"]) == 8


def test_gradients_of_all_points_in_one_pass(spark, monkeypatch):
    """Against the dense formula; no row per column comes to the driver."""
    rng = np.random.default_rng(4)
    dense = rng.integers(0, 3, (60, 90)) * (rng.random((60, 90)) < 0.1)
    dense[:, 88:] = 0  # columns without a cell
    y = rng.integers(0, 2, 60)
    triples = spark.createDataFrame([(int(i), int(c), float(dense[i, c])) for i, c in zip(*np.nonzero(dense))] + [(99, 89, 5.0)], "k bigint, column bigint, value double")
    rows = L.assemble(triples, 90, ["k"]).join(spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "k bigint, labels int"), "k")
    held = [r.k for r in rows.select("k").collect()]
    models = [L.LogisticRegression(labelCol="labels", regParam=reg, maxIter=steps).fit(rows) for reg, steps in ((0.3, 2), (0.01, 50))]
    sizes, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: sizes.append(len(out := collect(df))) or out)
    found = L.gradients(models, rows, triples, ["k"], [0.3, 0.01])
    own = [L.gradient(m, rows, triples, ["k"], reg) for m, reg in zip(models, (0.3, 0.01))]
    assert max(sizes, default=0) <= 1
    x, y = dense[held], y[held]
    for got, alone, model, reg in zip(found, own, models, (0.3, 0.01)):
        w = model.coefficients.toArray()
        r = 1 / (1 + np.exp(-(x @ w + model.intercept))) - y
        wanted = max(abs(r.mean()), np.abs(x.T @ r / len(y) + reg * w).max())
        assert got == pytest.approx(wanted, abs=1e-9) and alone == pytest.approx(wanted, abs=1e-9)
