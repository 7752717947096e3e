"""Suspected infections against all pairs, and concept sets that do not deal the measurements by concept."""

import datetime as dt
import random

from wardflow.operators import sepsis as Z

DAY = dt.timedelta(days=1)
START = dt.datetime(2000, 1, 1)


def relations(spark):
    rng = random.Random(5)
    at = lambda: START + dt.timedelta(hours=rng.randrange(24 * 60))
    stays = [(p, START + dt.timedelta(days=20 * k, hours=rng.randrange(24)), START + dt.timedelta(days=20 * k + rng.randrange(1, 12), hours=5)) for p in range(12) for k in range(3)]
    cultures = [(rng.randrange(13), rng.choice([1, 2, 3]), at()) for _ in range(300)] + [(None, 1, START), (1, None, START), (2, 1, None)]
    drugs = [(rng.randrange(13), rng.choice([5, 6]), at()) for _ in range(300)] + [(1, 5, None)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    return (
        stays, cultures, drugs, frame(stays, "person_id long, admit_date timestamp_ntz, discharge_date timestamp_ntz"),
        frame([(*m, 1.0, 8840) for m in cultures], "person_id long, measurement_concept_id long, measurement_datetime timestamp_ntz, value_as_number double, unit_concept_id long"),
        frame(drugs, "person_id long, drug_concept_id long, drug_exposure_start_datetime timestamp_ntz"),
        frame([(Z.CULTURES, 1), (Z.CULTURES, 2), (Z.CULTURES, 2), (Z.ANTIBIOTICS, 5)], "ancestor_concept_id long, descendant_concept_id long"),
        frame([(p, dt.datetime(1980, 5, 1)) for p in range(11)], "person_id long, birth_datetime timestamp_ntz"))


def test_suspected_infections_are_those_of_all_pairs(spark):
    stays, cultures, drugs, admissions, measurement, exposure, ancestors, person = relations(spark)
    wanted = set()
    for p, admit, leave in stays:
        inside = lambda t: t is not None and admit - DAY <= dt.datetime.combine(t.date(), dt.time()) <= leave
        pairs = [(c, a) for q, k, c in cultures if q == p and k in (1, 2) and inside(c) for r, d, a in drugs if r == p and d == 5 and inside(a)
                 and -1 <= (a.date() - c.date()).days <= 3]
        if pairs:
            c, a = min(c for c, _ in pairs), min(a for _, a in pairs)
            wanted.add((p, admit, leave, c, a, min(c, a)))
    found = Z.suspected_infection(admissions, measurement, exposure, ancestors, person)
    rows = found.select("person_id", "admit_datetime", "discharge_datetime", "min_bc", "min_systemic_abx", "sepsis_index_date").collect()
    assert len(rows) == len(wanted) > 3 and set(map(tuple, rows)) == wanted


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_concepts_do_not_deal_the_measurements(spark):
    _, _, _, admissions, measurement, exposure, ancestors, person = relations(spark)
    concept = spark.createDataFrame([(i, None) for ids in Z.SETS.values() for i in ids], "concept_id long, invalid_reason string")
    for found in (Z.component_values(measurement, concept, ancestors), Z.suspected_infection(admissions, measurement, exposure, ancestors, person)):
        assert "hashpartitioning(measurement_concept_id" not in plan(found) and "hashpartitioning(drug_concept_id" not in plan(found)
