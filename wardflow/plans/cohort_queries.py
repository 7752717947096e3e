"""Queries of the cohort operators and of the plain outcome labels."""

from pyspark.sql import functions as F

from ..functions.hashing import key_hash
from ..operators import cohorts as C, outcomes as O
from .registry import cte, query

cte("inp", """SELECT v.person_id, visit_concept_id, visit_start_datetime, visit_end_datetime FROM visit_occurrence v
  WHERE visit_concept_id IN (9201, 262) AND visit_end_datetime > visit_start_datetime
  AND v.person_id IN (SELECT person_id FROM person)""")
cte("adm", """SELECT person_id, min(s) AS admit_date, max(e) AS discharge_date FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY person_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM (
   SELECT person_id, visit_start_datetime AS s, visit_end_datetime AS e,
    CASE WHEN visit_start_datetime <= max(visit_end_datetime) OVER (PARTITION BY person_id ORDER BY visit_start_datetime, visit_end_datetime
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM inp) q1) q2
  GROUP BY person_id, isl""")
cte("adm_age", """SELECT a.*, CAST(year(admit_date) - year(birth_datetime) AS INT) AS age_in_years FROM adm a JOIN person p USING (person_id)""")
HASH60 = "CAST('0x' || substr(md5({k}), 1, 15) AS BIGINT)"
cte("adm_key", """SELECT *, CAST(person_id AS VARCHAR) || '|' || strftime(admit_date, '%Y-%m-%d %H:%M:%S') || '|' || strftime(discharge_date, '%Y-%m-%d %H:%M:%S') AS k FROM adm_age""")
cte("outp", """SELECT q.person_id, q.visit_occurrence_id, q.visit_start_date, q.birth_datetime, q.age_in_years,
   o.observation_period_start_date, o.observation_period_end_date,
   date_diff('day', o.observation_period_start_date, q.visit_start_date) / 365.25 AS years_since_start,
   date_diff('day', q.visit_start_date, o.observation_period_end_date) / 365.25 AS years_until_end
  FROM (SELECT v.person_id, visit_occurrence_id, visit_start_date, birth_datetime,
     date_diff('day', CAST(birth_datetime AS DATE), visit_start_date) / 365.25 AS age_in_years
     FROM visit_occurrence v JOIN person p USING (person_id) WHERE visit_concept_id IN (9202, 581477)) q
  JOIN observation_period o USING (person_id)
  WHERE age_in_years >= 18 AND visit_start_date <= DATE '2019-12-31' AND observation_period_end_date <= DATE '2021-12-31'
   AND date_diff('day', o.observation_period_start_date, q.visit_start_date) / 365.25 >= 1
   AND date_diff('day', q.visit_start_date, o.observation_period_end_date) >= 0""")
cte("icu", """SELECT * FROM (SELECT d.person_id, d.visit_occurrence_id, d.visit_detail_id, v.visit_start_datetime + INTERVAL '24' HOUR AS index_datetime,
   date_diff('day', CAST(p.birth_datetime AS DATE), CAST(v.visit_start_datetime + INTERVAL '24' HOUR AS DATE)) / 365.25 AS age_in_years,
   date_diff('hour', v.visit_start_datetime, v.visit_end_datetime) AS los_hospital_hours,
   date_diff('hour', d.visit_start_datetime, d.visit_end_datetime) AS los_icu_hours,
   CAST(date_diff('hour', d.visit_start_datetime, d.visit_end_datetime) > 72 AS INT) AS los_icu_3days,
   CAST(date_diff('hour', d.visit_start_datetime, d.visit_end_datetime) > 168 AS INT) AS los_icu_7days,
   CAST(v.discharge_to_concept_id = 4216643 AS INT) AS mortality_hospital, CAST(d.discharge_to_concept_id = 4216643 AS INT) AS mortality_icu,
   date_diff('hour', v.visit_start_datetime + INTERVAL '24' HOUR, d.visit_end_datetime) AS left_hours,
   row_number() OVER (PARTITION BY d.person_id ORDER BY d.visit_start_datetime, d.visit_detail_id) AS rn
   FROM visit_detail d LEFT JOIN visit_occurrence v USING (visit_occurrence_id) JOIN person p ON p.person_id = d.person_id) q
  WHERE rn = 1 AND age_in_years BETWEEN 15 AND 89 AND los_icu_hours BETWEEN 12 AND 240 AND left_hours >= 6""")


def build_admissions(t):
    return C.admission_rollup(C.inpatient_visits(t.visit_occurrence, t.person))


def adm(t):
    """Admissions as a stored table: labels, features and splits all start from it."""
    return t.stored("admissions", build_admissions)


def adm_age(t):
    return O.age_groups(adm(t), t.person).drop("age_group")


def outpatients(t):
    return C.outpatient_index(t.visit_occurrence, t.person, t.observation_period, max_index_date="2019-12-31")


def icu(t):
    return C.icu_stays(t.visit_detail, t.visit_occurrence, t.person)


ADM_KEY = ["person_id", "admit_date", "discharge_date"]


@query("coh_01_inpatient_base", "SELECT * FROM inp WHERE date_diff('hour', visit_start_datetime, visit_end_datetime) > 24")
def _(t):
    return C.inpatient_visits(t.visit_occurrence, t.person, min_stay_hour=24)


@query("coh_02_admission_rollup", "SELECT * FROM adm")
def _(t):
    return build_admissions(t)


@query("coh_03_one_admission_per_person", f"""SELECT person_id, admit_date, discharge_date, age_in_years, {HASH60.format(k='k')} AS prediction_id
  FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY md5(k), admit_date) AS rn FROM adm_key) q WHERE rn = 1""")
def _(t):
    return C.one_per_person(adm_age(t), ADM_KEY)


@query("coh_04_eligible", "SELECT * FROM adm_age WHERE age_in_years >= 18 AND year(admit_date) >= 1997")
def _(t):
    return C.eligible(adm_age(t), 18.0, "year(admit_date) >= 1997")


@query("coh_05_sepsis_admissions", f"""SELECT q.person_id, admit_date, discharge_date, p.birth_datetime, g.concept_name AS gender_name, r.concept_name AS race_name,
  e.concept_name AS ethnicity_name, age_in_years, CASE WHEN age_in_years <= 18 THEN 0 ELSE 1 END AS adult_at_admission, {HASH60.format(k='k')} AS prediction_id
  FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY md5(k), admit_date) AS rn FROM adm_key) q JOIN person p USING (person_id)
  LEFT JOIN concept g ON g.concept_id = gender_concept_id LEFT JOIN concept r ON r.concept_id = race_concept_id
  LEFT JOIN concept e ON e.concept_id = ethnicity_concept_id WHERE rn = 1""")
def _(t):
    return C.sepsis_admissions(adm(t), t.person, t.concept)


@query("coh_06_outpatient_index", "SELECT * FROM outp")
def _(t):
    return outpatients(t)


@query("coh_07_icu_first_stay", "SELECT * EXCLUDE (rn, left_hours) FROM icu")
def _(t):
    return icu(t)


@query("coh_08_one_visit_per_person", f"""SELECT * EXCLUDE (rn, k), {HASH60.format(k='k')} AS prediction_id FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY md5(k)) AS rn
  FROM (SELECT *, CAST(person_id AS VARCHAR) || '|' || CAST(visit_occurrence_id AS VARCHAR) AS k FROM outp) a) b WHERE rn = 1""")
def _(t):
    return C.one_per_person(outpatients(t), ["person_id", "visit_occurrence_id"])


@query("coh_09_horizon_presets", """SELECT h.horizon, count(*) AS n_index, min(visit_start_date) AS first_index, max(h.days) AS event_followup_days FROM outp
  JOIN (VALUES ('1yr', DATE '2019-12-31', 365.25), ('5yr', DATE '2015-12-31', 1826.25), ('10yr', DATE '2010-12-31', 3652.5)) h(horizon, last_day, days)
  ON visit_start_date <= h.last_day GROUP BY h.horizon""")
def _(t):
    frames = []
    for name, preset in C.HORIZONS.items():
        index = C.outpatient_index(t.visit_occurrence, t.person, t.observation_period, max_index_date=preset["max_index_date"])
        frames.append(index.agg(
            F.lit(name).alias("horizon"), F.count(F.lit(1)).alias("n_index"), F.min("visit_start_date").alias("first_index"),
            F.lit(preset["event_followup_days"]).alias("event_followup_days"),
        ))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


AGE_DAYS = "date_diff('day', CAST(birth_datetime AS DATE), CAST(admit_date AS DATE))"
cte("adm_stage", f"""SELECT a.person_id, admit_date, discharge_date, {AGE_DAYS} AS age_days,
  CASE WHEN {AGE_DAYS} BETWEEN 0 AND 27 THEN 'term neonatal' WHEN {AGE_DAYS} BETWEEN 28 AND 365 THEN 'infancy'
   WHEN {AGE_DAYS} BETWEEN 366 AND 730 THEN 'toddler' WHEN {AGE_DAYS} BETWEEN 731 AND 1825 THEN 'early childhood'
   WHEN {AGE_DAYS} BETWEEN 1826 AND 4015 THEN 'middle childhood' WHEN {AGE_DAYS} BETWEEN 4016 AND 6570 THEN 'early adolescence'
   WHEN {AGE_DAYS} BETWEEN 6571 AND 7665 THEN 'late adolescence' WHEN {AGE_DAYS} > 7665 THEN 'non-pediatric' ELSE 'unknown' END AS pediatric_age_group,
  CASE WHEN {AGE_DAYS} < 0 THEN 'unknown' WHEN {AGE_DAYS} <= 17*365 THEN '[0,18)' WHEN {AGE_DAYS} <= 29*365 THEN '[18,30)'
   WHEN {AGE_DAYS} <= 39*365 THEN '[30,40)' WHEN {AGE_DAYS} <= 49*365 THEN '[40,50)' WHEN {AGE_DAYS} <= 59*365 THEN '[50,60)'
   WHEN {AGE_DAYS} <= 69*365 THEN '[60,70)' WHEN {AGE_DAYS} <= 79*365 THEN '[70,80)' WHEN {AGE_DAYS} <= 89*365 THEN '[80,90)' ELSE '[90,)' END AS age_group
  FROM adm a LEFT JOIN person p USING (person_id)""")


@query("coh_10_adult_flag", """SELECT s.person_id, s.admit_date, s.discharge_date, a.age_in_years, s.age_days, s.pediatric_age_group, s.age_group,
  CASE WHEN a.age_in_years < 18 THEN 0 ELSE 1 END AS adult_at_admission FROM adm_stage s JOIN adm_age a USING (person_id, admit_date)
  WHERE s.pediatric_age_group <> 'term neonatal'""")
def _(t):
    return C.adult_flag(O.age_day_groups(adm_age(t), t.person))


@query("coh_11_constrained_training", """WITH f AS (SELECT person_id, CASE WHEN person_id % 10 < 8 THEN 'train' ELSE 'val' END AS fold_id FROM person WHERE person_id % 10 < 9),
  r AS (SELECT *, row_number() OVER (PARTITION BY fold_id ORDER BY md5('0|' || CAST(person_id AS VARCHAR))) - 1 AS rk, count(*) OVER (PARTITION BY fold_id) AS n FROM f)
  SELECT person_id, fold_id, CAST(p AS INT) AS percent, CAST(rk < floor(n * p / 100) AS INT) AS constrain FROM r, range(5, 100, 5) x(p)""")
def _(t):
    m = F.col("person_id") % 10
    cohort = t.person.select("person_id", F.when(m < 8, "train").when(m < 9, "val").otherwise("test").alias("fold_id"))
    return C.constrained_training(cohort)


# ---- outcome labels -------------------------------------------------------

cte("adm_death", "SELECT a.*, d.death_date FROM adm a LEFT JOIN death d USING (person_id)")


@query("out_01_end_of_day", """SELECT *, CAST(CAST(admit_date AS DATE) AS TIMESTAMP) + INTERVAL '1439' MINUTE AS admit_date_midnight,
  CAST(CAST(discharge_date AS DATE) AS TIMESTAMP) + INTERVAL '1439' MINUTE AS discharge_date_midnight FROM adm""")
def _(t):
    return O.end_of_days(adm(t))


@query("out_02_hospital_mortality", """SELECT *, CASE WHEN death_date BETWEEN CAST(admit_date AS DATE) AND CAST(discharge_date AS DATE) THEN 1 ELSE 0 END AS hospital_mortality,
  CASE WHEN CAST(death_date AS TIMESTAMP) BETWEEN admit_date AND discharge_date THEN 1 ELSE 0 END AS hospital_mortality_ts FROM adm_death""")
def _(t):
    a = O.hospital_mortality(adm(t), t.death)
    legacy = O.hospital_mortality(adm(t), t.death, compare_timestamps=True)
    return a.join(legacy.select(*O.WINDOW, F.col("hospital_mortality").alias("hospital_mortality_ts")), O.WINDOW)


@query("out_03_month_mortality", """SELECT person_id, admit_date, discharge_date, CASE WHEN date_trunc('month', death_date) = date_trunc('month', discharge_date) THEN 1 ELSE 0 END AS month_mortality FROM adm_death""")
def _(t):
    return O.month_mortality(adm(t), t.death)


@query("out_04_length_of_stay", """SELECT *, date_diff('day', CAST(admit_date AS DATE), CAST(discharge_date AS DATE)) AS los_days,
  CAST(date_diff('day', CAST(admit_date AS DATE), CAST(discharge_date AS DATE)) >= 7 AS INT) AS los_7 FROM adm""")
def _(t):
    return O.length_of_stay(adm(t))


cte("adm_readm", """SELECT person_id, admit_date, discharge_date, CASE WHEN w BETWEEN 0 AND 30 THEN 1 ELSE 0 END AS readmission_30, w AS readmission_window FROM (
  SELECT *, date_diff('day', CAST(discharge_date AS DATE), CAST(lead(admit_date) OVER (PARTITION BY person_id ORDER BY admit_date) AS DATE)) AS w FROM adm) q""")


@query("out_05_readmission", "SELECT * FROM adm_readm")
def _(t):
    return O.readmission(build_admissions(t))


@query("out_06_icu_admission", """WITH d AS (SELECT a.person_id, a.admit_date, min(v.visit_detail_start_datetime) AS icu_start_datetime FROM adm a JOIN visit_detail v
   ON v.person_id = a.person_id AND v.visit_detail_start_datetime BETWEEN a.admit_date AND a.discharge_date
   AND v.visit_detail_start_datetime > a.admit_date + INTERVAL '2' HOUR
   AND visit_detail_source_value IN ('J4|J4|J4|', 'CVICU|CVICU|Cardiovascular Intensive Care|', 'PICU|PICU|Pediatric Intensive Care|') GROUP BY 1, 2)
  SELECT a.*, CASE WHEN icu_start_datetime IS NULL THEN 0 ELSE 1 END AS icu_admission, icu_start_datetime FROM adm a LEFT JOIN d USING (person_id, admit_date)""")
def _(t):
    return O.icu_admission(adm(t), t.visit_detail, min_stay_hour=2)


BANDS = "CASE WHEN {a} >= 30 AND {a} < 45 THEN '[30-45)' WHEN {a} >= 45 AND {a} < 55 THEN '[45-55)' WHEN {a} >= 55 AND {a} < 65 THEN '[55-65)' WHEN {a} >= 65 AND {a} < 75 THEN '[65-75)' WHEN {a} >= 75 AND {a} < 91 THEN '[75-91)' WHEN {a} >= {f} AND {a} < 30 THEN '[{f}-30)' ELSE '{b}' END"
cte("adm_band", f"SELECT *, {BANDS.format(a='age_in_years', f=18, b='<18')} AS age_group FROM adm_age")


@query("out_07_age_bands", f"""SELECT 'admission' AS cohort, person_id, age_in_years, age_group FROM adm_band
  UNION ALL SELECT 'icu', person_id, age_in_years, {BANDS.format(a='age_in_years', f=15, b='other')} FROM icu""")
def _(t):
    a = O.age_groups(adm(t), t.person).select(F.lit("admission").alias("cohort"), "person_id", F.col("age_in_years").cast("double"), "age_group")
    return a.unionByName(O.age_groups(icu(t), t.person, icu_variant=True).select(F.lit("icu").alias("cohort"), "person_id", "age_in_years", "age_group"))


@query("out_08_age_day_groups", "SELECT * FROM adm_stage")
def _(t):
    return O.age_day_groups(adm(t), t.person)


cte("demo", """SELECT DISTINCT p.person_id,
  CASE WHEN e.concept_name = 'Hispanic or Latino' THEN e.concept_name WHEN r.concept_name IN ('Native Hawaiian or Other Pacific Islander', 'American Indian or Alaska Native', 'No matching concept') THEN 'Other' ELSE r.concept_name END AS race_eth,
  CASE WHEN e.concept_name = 'Hispanic or Latino' THEN e.concept_name WHEN r.concept_name = 'No matching concept' THEN 'Other' ELSE r.concept_name END AS race_eth_raw,
  g.concept_name AS gender_concept_name FROM person p JOIN concept g ON g.concept_id = p.gender_concept_id
  JOIN concept r ON r.concept_id = p.race_concept_id JOIN concept e ON e.concept_id = p.ethnicity_concept_id""")


@query("out_09_demographics", "SELECT * FROM demo WHERE person_id IN (SELECT person_id FROM adm)")
def _(t):
    return O.demographics(adm(t), t.person, t.concept)


@query("out_09_sex_and_race", """SELECT a.*, g.concept_name AS sex, r.concept_name AS race FROM adm a LEFT JOIN person p USING (person_id)
  LEFT JOIN concept g ON g.concept_id = p.gender_concept_id LEFT JOIN concept r ON r.concept_id = p.race_concept_id""")
def _(t):
    return O.sex_and_race(adm(t), t.person, t.concept)


@query("out_10_race_rollup", """SELECT i.person_id, CASE WHEN p.race_concept_id IN (SELECT descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id = 8527) THEN 'White' ELSE 'Other' END AS race_eth,
  g.concept_name AS gender_concept_name FROM (SELECT DISTINCT person_id FROM icu) i JOIN person p USING (person_id) JOIN concept g ON g.concept_id = p.gender_concept_id""")
def _(t):
    return O.race_rollup(icu(t), t.person, t.concept, t.concept_ancestor)


@query("out_11_intersections", """SELECT a.*, race_eth, race_eth_raw, gender_concept_name, race_eth || '_' || gender_concept_name AS race_eth_gender, race_eth || '_' || age_group AS race_eth_age_group,
  gender_concept_name || '_' || age_group AS gender_age_group, race_eth || '_' || gender_concept_name || '_' || age_group AS race_eth_gender_age_group
  FROM adm_band a JOIN demo USING (person_id)""")
def _(t):
    cohort = adm(t)
    return O.intersections(O.age_groups(cohort, t.person).join(O.demographics(cohort, t.person, t.concept), "person_id"))


def standard_labels(t) -> O.LabelSet:
    return (
        O.LabelSet()
        .add("mortality", "death inside the window", lambda c: O.hospital_mortality(c, t.death))
        .add("los_7", "stay of at least seven days", O.length_of_stay)
        .add("readmission_30", "readmission within 30 days", O.readmission)
        .add("month_mortality", "death in the month of discharge", lambda c: O.month_mortality(c, t.death))
        .add("icu_admission", "transfer to intensive care", lambda c: O.icu_admission(c, t.visit_detail))
    )


@query("out_12_composed_labels", """SELECT r.*, CASE WHEN d.death_date BETWEEN CAST(admit_date AS DATE) AND CAST(discharge_date AS DATE) THEN 1 ELSE 0 END AS hospital_mortality, d.death_date,
  date_diff('day', CAST(admit_date AS DATE), CAST(discharge_date AS DATE)) AS los_days, CAST(date_diff('day', CAST(admit_date AS DATE), CAST(discharge_date AS DATE)) >= 7 AS INT) AS los_7
  FROM adm_readm r LEFT JOIN death d USING (person_id)""")
def _(t):
    return standard_labels(t).compose(adm(t), exclude=("month_mortality", "icu_admission"))
