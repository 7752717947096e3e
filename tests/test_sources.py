"""Round trips through files and tables, and small operator checks."""

import pytest
from pyspark.sql import functions as F

from wardflow.functions.segments import literal_rows
from wardflow.operators import labelers, outcomes, sepsis, timeline
from wardflow.sources import readers, writers


def test_refuse_or_overwrite(spark, tmp_path):
    df = spark.range(3)
    writers.write_parquet(df, f"{tmp_path}/a")
    with pytest.raises(Exception):
        writers.write_parquet(df, f"{tmp_path}/a")
    writers.write_parquet(spark.range(5), f"{tmp_path}/a", overwrite=True)
    assert spark.read.parquet(f"{tmp_path}/a").count() == 5


def test_load_with_dates(spark):
    df = literal_rows(spark, [(1, "2020-02-03")], "k int, d string")
    writers.load_with_dates(df, "dated_rows", ["d"])
    assert dict(spark.table("dated_rows").dtypes)["d"] == "date"
    spark.sql("drop table dated_rows")


def test_bucketed_code_index(spark):
    index = literal_rows(spark, [("a", 1), ("b", 2), ("a", 3)], "code string, person_id bigint")
    writers.write_code_index(index, "code_index_rows", 4)
    assert {r.person_id for r in timeline.patients_with(spark.table("code_index_rows"), ["a"]).collect()} == {1, 3}
    spark.sql("drop table code_index_rows")


def test_headerless_file_with_and_without_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("person_id,code\n1,a\n")
    (tmp_path / "y.csv").write_text("2,b\n")
    got = readers.headerless(spark, str(tmp_path), "person_id bigint, code string")
    assert sorted((r.person_id, r.code) for r in got.collect()) == [(1, "a"), (2, "b")]


def test_label_file_round_trip(spark, tmp_path):
    labels = literal_rows(spark, [(1, 3, 1), (1, 5, 0), (2, 0, 1)], "person_id bigint, day_index int, label int")
    writers.write_labels(labels, f"{tmp_path}/labels")
    got = sorted((r.person_id, r.day_index, r.label) for r in writers.read_labels(spark, f"{tmp_path}/labels").collect())
    assert got == [(1, 3, 1.0), (1, 5, 0.0), (2, 0, 1.0)]


def test_invalid_day_index_is_an_error(spark):
    days = literal_rows(spark, [(1, 0)], "person_id bigint, day_index int")
    bad = literal_rows(spark, [(1, 4, 1)], "person_id bigint, day_index int, label int")
    with pytest.raises(Exception):
        labelers.check_day_indices(bad, days).collect()


def test_unknown_label_is_an_error(spark):
    with pytest.raises(KeyError):
        outcomes.LabelSet().compose(spark.range(1), include=["nothing"])


def test_crosswalk_rules(spark):
    rows = literal_rows(spark, [
        (1, "0010", "A001", "10000"), (2, "0010", "A009", "10000"), (3, "0020", "B10", "11000"),
        (4, "0030", "C100", "10111"), (5, "0030", "C200", "10112"), (6, "0030", "C300", "10112"), (7, "0030", "C900", "10122"),
    ], "line_no bigint, source string, target string, flags string")
    got = sorted((r.source, r.target) for r in timeline.crosswalk(rows).collect())
    assert got == [("0010", "A00.1"), ("0030", "C10.0"), ("0030", "C30.0")]


def test_crosswalk_file_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0010   A001 10000\n0010   A009 10000\n0040  D5   10000\n")
    got = sorted((r.source, r.target) for r in timeline.crosswalk(readers.crosswalk_file(spark, str(tmp_path))).collect())
    assert got == [("0010", "A00.1"), ("0040", "D5")]


def test_score_bands_by_age(spark):
    base = literal_rows(spark, [(240, 1.3), (30, 1.3), (0, 1.3)], "age_in_months int, max_creatinine double")
    for name in ("min_platelet", "max_bilirubin", "max_dopamine_days", "max_dobutamine_days", "max_epinephrine_days", "max_norepinephrine_days",
                 "min_map", "count_vent_mode", "min_pao2fio2_ratio", "min_spo2fio2_ratio", "min_gcs", "min_urine_daily", "max_lactate"):
        base = base.withColumn(name, F.lit(None).cast("double"))
    assert {r.age_in_months: r.crea_sofa for r in sepsis.scores(base).collect()} == {240: 1, 30: 2, 0: 3}
