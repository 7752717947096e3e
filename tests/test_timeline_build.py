"""The timeline build: rows, buckets, and no shuffle of its events afterwards."""

import datetime as dt
from types import SimpleNamespace

from wardflow.operators import timeline as T

D = dt.date


def relations(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    t = SimpleNamespace(spark=spark)
    t.concept = frame([(1, "A", "x"), (2, "A", "x"), (3, "B", "y"), (8, "Gender", "M"), (9, "Visit", "IP"), (10, "LOINC", "k")], "concept_id long, vocabulary_id string, concept_code string")
    t.person = frame([(1, dt.datetime(1980, 5, 1), 1980, 5, 1, 8, 0, 3), (2, None, None, None, None, 8, 0, 0), (3, dt.datetime(1990, 1, 1), 1990, 1, 1, 8, 0, 0)],
                     "person_id long, birth_datetime timestamp, year_of_birth int, month_of_birth int, day_of_birth int, gender_concept_id int, ethnicity_concept_id int, race_concept_id int")
    rows = {
        "drug_exposure": [(1, D(2000, 1, 1), 1), (1, D(2000, 1, 1), 2), (4, D(2000, 1, 1), 1)],
        "condition_occurrence": [(1, D(2000, 1, 1), 1), (1, D(1970, 1, 1), 8), (2, D(2001, 2, 3), 0)],
        "procedure_occurrence": [(1, None, 3), (2, D(2001, 2, 3), 77)],
        "device_exposure": [(None, D(2000, 1, 1), 1)],
        "observation": [(2, D(2001, 2, 3), 3)],
    }
    for table, day, concept in T.CODED_TABLES:
        setattr(t, table, frame(rows[table], f"person_id long, {day} date, {concept} int"))
    t.visit_occurrence = frame([(1, D(2000, 1, 1), D(2000, 1, 4), 9)], "person_id long, visit_start_date date, visit_end_date date, visit_concept_id int")
    t.measurement = frame([(1, D(2000, 1, 2), 10, 4.5, ""), (1, D(2000, 1, 2), 10, 4.5, "POS")],
                          "person_id long, measurement_date date, measurement_concept_id int, value_as_number double, value_source_value string")
    t.death = frame([(2, D(2002, 1, 1))], "person_id long, death_date date")
    return t


def test_rows_of_the_build(spark):
    birth, other = D(1980, 5, 1), D(1900, 1, 1)
    age = lambda d, b=birth: (d - b).days
    found = sorted(map(tuple, T.build(relations(spark)).collect()), key=str)
    assert found == sorted([
        (1, D(2000, 1, 1), age(D(2000, 1, 1)), "A/x", None, None),
        (1, D(2000, 1, 1), age(D(2000, 1, 1)), "Visit/IP", 3.0, None),
        (1, D(2000, 1, 2), age(D(2000, 1, 2)), "LOINC/k", 4.5, None),
        (1, D(2000, 1, 2), age(D(2000, 1, 2)), "LOINC/k", None, "POS"),
        (1, birth, 0, "B/y", None, None),  # no day; also the race
        (1, birth, 0, "Gender/M", None, None),  # a fact before birth; also the gender
        (2, D(2001, 2, 3), age(D(2001, 2, 3), other), "B/y", None, None),
        (2, D(2002, 1, 1), age(D(2002, 1, 1), other), T.DEATH_CODE, None, None),
        (2, other, 0, "Gender/M", None, None),
    ], key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_and_records_need_no_shuffle(spark):
    events = T.build(relations(spark))
    assert "Exchange" not in plan(T.day_table(events))
    assert "Exchange" not in plan(T.year_records(T.day_records(events)))
