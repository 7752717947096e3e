"""Golden rows: admission rollup, readmission, patient timeline, drug classes, row-set equality."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardflow.operators import cohorts, comparison, concepts, labelers, ontology, outcomes, splits, timeline, timeline_features, timeline_features as features
from wardflow.functions.segments import literal_rows


def stamp(*parts):
    return datetime(*parts)


def test_admission_rollup(spark):
    visits = {0: [(1, 2), (3, 6)], 1: [(1, 3), (3, 6), (10, 10)], 2: [(1, 2), (3, 6), (1, 10)], 3: [(1, 2), (7, 6)], 4: [(1, 2)], 5: [(1, 1)]}
    expected = {0: [(1, 2), (3, 6)], 1: [(1, 6)], 2: [(1, 10)], 3: [(1, 2)], 4: [(1, 2)]}
    rows = [(p, stamp(2018, 1, a), stamp(2018, 1, b)) for p, spans in visits.items() for a, b in spans]
    df = spark.createDataFrame(rows, "person_id bigint, visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz")
    got = {}
    for r in cohorts.admission_rollup(df).collect():
        got.setdefault(r.person_id, []).append((r.admit_date.day, r.discharge_date.day))
    assert {p: sorted(v) for p, v in got.items()} == expected


def test_readmission(spark):
    d = lambda y, m, dd: stamp(y, m, dd)
    stays = {
        0: [(d(2018, 1, 1), d(2018, 1, 8)), (d(2018, 1, 28), d(2018, 2, 10))],
        1: [(d(2018, 1, 1), d(2018, 1, 8)), (d(2018, 2, 15), d(2018, 2, 19))],
        2: [(d(2018, 1, 1), d(2018, 2, 10))],
        3: [(d(2018, 1, 1), d(2018, 1, 8)), (d(2018, 1, 28), d(2018, 2, 10)), (d(2018, 2, 15), d(2018, 2, 20))],
        4: [(d(2018, 1, 1), d(2018, 1, 8)), (d(2019, 1, 28), d(2019, 2, 10))],
    }
    rows = [(p, a, b) for p, spans in stays.items() for a, b in spans]
    df = spark.createDataFrame(rows, "person_id bigint, admit_date timestamp_ntz, discharge_date timestamp_ntz")
    got = {}
    for r in outcomes.readmission(df).orderBy("person_id", "admit_date").collect():
        got.setdefault(r.person_id, []).append(r.readmission_30)
    assert got == {0: [1, 0], 1: [0, 0], 2: [0], 3: [1, 1, 0], 4: [0, 0]}


@pytest.fixture(scope="module")
def patient(spark):
    days = [(0, date(1994, 2, 9)), (1095 + 1, date(1997, 2, 9)), (2191, date(2000, 2, 9))]
    bare = {0: ["c0", "c4", "c12"], 1: ["c0", "c34", "c129"], 2: ["c0", "c34", "c129"]}
    start = days[0][1]
    rows = [(234123, day, (day - start).days, c, None, None) for i, (_, day) in enumerate(days) for c in bare[i]]
    rows += [(234123, days[1][1], (days[1][1] - start).days, "c909", 0.0, None), (234123, days[2][1], (days[2][1] - start).days, "c909", 2.0, None)]
    events = spark.createDataFrame(rows, "person_id bigint, day date, age int, code string, numeric_value double, text_value string")
    return events, timeline.day_table(events)


def test_value_above(patient):
    events, days = patient
    got = sorted((r.day_index, r.label) for r in labelers.value_above(events, days, "c909", 1).collect())
    assert got == [(0, 0), (1, 1)]


def test_age_standardised(patient, spark):
    _, days = patient
    points = days.where("day_index in (0, 2)")
    got = [r.value for r in features.age_feature(points, features.age_statistics(points)).orderBy("day_index").collect()]
    assert got == pytest.approx([-0.70710678, 0.70710678])


def test_counts_up_to_day(patient, spark):
    events, days = patient
    recorded = events.select("code").distinct()
    counted = features.counted_codes(events, recorded)
    vocabulary = features.count_vocabulary(counted)
    got = features.count_features(days.where("day_index = 1"), counted, vocabulary).collect()
    assert sorted((r["value"] for r in got), reverse=True) == [2, 1, 1, 1, 1]
    binned = features.count_features(days.where("day_index = 2"), counted, vocabulary, [730, None]).collect()
    assert all(r["value"] >= 1 for r in binned)
    with pytest.raises(ValueError):
        features.bins_before([730])


def test_combined_matrix_is_side_by_side(patient):
    events, days = patient
    points = days.where("day_index in (0, 2)")
    a, b = features.icd10_era(points), features.constant(points, 7.0)
    got = sorted((r["day_index"], r["column"], r["value"]) for r in features.combine([(a, 1), (b, 1)]).collect())
    assert got == [(0, 0, 0.0), (0, 1, 7.0), (2, 0, 0.0), (2, 1, 7.0)]


def test_drug_classes(spark):
    attributes = literal_rows(spark, [("1", "NDC", "00009028052"), ("2", "HCPCS", "J1644")], "concept string, vocabulary string, code string")
    relations = literal_rows(spark, [("10", "1", "has_ingredient"), ("11", "10", "has_form"), ("20", "2", "has_ingredients"), ("99", "2", "unrelated")],
                             "child string, parent string, relation string")
    atoms = literal_rows(spark, [("10", "ATC", "D07AA01"), ("11", "ATC", "D10AA02"), ("11", "ATC", "H02AB04"), ("20", "ATC", "B01AB01"),
                                 ("20", "ATC", "C05BA03"), ("20", "ATC", "S01XA14"), ("99", "ATC", "X00")], "concept string, vocabulary string, code string")
    got = {}
    for r in ontology.drug_classes(attributes, relations, atoms).collect():
        got.setdefault((r.vocabulary, r.code), []).append(r.atc)
    assert sorted(got["NDC", "00009028052"]) == ["ATC/D07AA01", "ATC/D10AA02", "ATC/H02AB04"]
    assert sorted(got["HCPCS", "J1644"]) == ["ATC/B01AB01", "ATC/C05BA03", "ATC/S01XA14"]


def test_split_keeps_rows(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") % 40).alias("person_id"), (F.col("id") % 2).alias("outcome"))
    got = splits.patient_split(df, test_frac=0.25, nfold=3, seed=1)
    assert sorted((r.row_id, r.outcome) for r in got.collect()) == [(i, i % 2) for i in range(100)]
    people = got.select("person_id", "fold_id").distinct().groupBy("fold_id").count().collect()
    assert {r.fold_id: r["count"] for r in people} == {"test": 10, "1": 10, "2": 10, "3": 10}


def test_row_set_equality(spark):
    a = literal_rows(spark, [(1, "x"), (2, "y")], "k int, v string")
    assert comparison.same_rows(a, a.orderBy(F.desc("k")))
    assert not comparison.same_rows(a, literal_rows(spark, [(1, "x")], "k int, v string"))


def test_hierarchy_of_any_depth_and_cycles(spark):
    edges = literal_rows(spark, [(f"n{i}", f"n{(i + 1) % 12}") for i in range(12)], "code string, parent string")
    assert ontology.closure(edges).count() == 144
    chain = literal_rows(spark, [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(24)] + [("x", "y"), ("y", "x")], "code string, parent string")
    unmapped = literal_rows(spark, [("c00",), ("c23",), ("x",)], "code string")
    got = concepts.recover_unmapped(unmapped, chain, literal_rows(spark, [("c24",)], "code string")).collect()
    assert {(r.code, r.recovered) for r in got} == {("c00", "c24"), ("c23", "c24")}


def test_long_texts_are_not_cut(spark):
    df = literal_rows(spark, [("<" + "0" * 150 + "5",)], "v string")
    assert df.select(timeline_features.clean_text(F.col("v")).alias("v")).first().v == "<5"
    row = literal_rows(spark, [(1, "s", "A" * 33, "00000")], "line_no int, source string, target string, flags string")
    assert timeline.crosswalk(row).first().target == "AAA." + "A" * 30
