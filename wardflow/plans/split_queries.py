"""Queries of the splits, task tables and cohort summaries."""

from pyspark.sql import functions as F

from ..operators import cohorts as C, outcomes as O, splits as P
from .cohort_queries import adm
from .label_queries import cardiovascular, outcome_demo
from .labeler_queries import ed
from .registry import cte, query
from .sepsis_queries import infection

rank = lambda seed, src="adm": f"(SELECT person_id, row_number() OVER (ORDER BY md5('{seed}|' || CAST(person_id AS VARCHAR))) - 1 AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT person_id FROM {src}) z)"
cte("fold", f"SELECT person_id, CASE WHEN rk < floor(n * 0.15) THEN 'test' WHEN rk < floor(n * 0.15) + floor(n * 0.15) THEN 'val' ELSE CAST((rk - 2 * floor(n * 0.15)) % 5 + 1 AS VARCHAR) END AS f FROM {rank(1)} q")
cte("fold2", "SELECT person_id, CASE WHEN f LIKE '%.%' THEN split_part(f, '.', 1) ELSE f END AS fold_id FROM fold")


@query("spl_01_patient_split", f"SELECT a.*, CASE WHEN rk < floor(n * 0.1) THEN 'test' ELSE CAST(CAST((rk - floor(n * 0.1)) AS BIGINT) % 10 + 1 AS VARCHAR) END AS fold_id FROM adm a JOIN {rank(657)} q USING (person_id)")
def _(t):
    return P.patient_split(adm(t))


@query("spl_02_patient_split_eval", f"SELECT a.*, CASE WHEN rk < floor(n * 0.1) THEN 'test' WHEN rk < floor(n * 0.1) + floor(n * 0.2) THEN 'eval' ELSE CAST(CAST((rk - floor(n * 0.1) - floor(n * 0.2)) AS BIGINT) % 5 + 1 AS VARCHAR) END AS fold_id FROM adm a JOIN {rank(9)} q USING (person_id)")
def _(t):
    return P.patient_split(adm(t), nfold=5, seed=9, eval_frac=0.2)


@query("spl_03_repeated_splits", " UNION ALL ".join(f"SELECT {i} AS split, {i} AS seed, person_id, CASE WHEN rk < floor(n * 0.7) THEN 'train' ELSE 'test' END AS part FROM {rank(i, 'person')} q" for i in range(10)))
def _(t):
    return P.repeated_splits(t.person)


@query("spl_04_read_split", f"SELECT person_id FROM {rank(3, 'person')} q WHERE rk >= floor(n * 0.7)")
def _(t):
    return P.read_split(P.repeated_splits(t.person), 3, "test")


CUTS = {"train": ("1995-01-01", "1998-12-31"), "val": ("1999-01-01", "1999-12-31"), "test": ("2000-01-01", "2001-12-31")}
CUT_SQL = "CASE " + " ".join(f"WHEN CAST({{d}} AS DATE) BETWEEN DATE '{a}' AND DATE '{b}' THEN '{n}'" for n, (a, b) in CUTS.items()) + " END"


@query("spl_04_time_split", f"SELECT *, {CUT_SQL.format(d='admit_date')} AS fold_id FROM adm")
def _(t):
    return P.time_split(adm(t), "admit_date", CUTS)


cte("tasks_in", f"""SELECT r.*, d.death_date, CASE WHEN d.death_date BETWEEN CAST(r.admit_date AS DATE) AND CAST(r.discharge_date AS DATE) THEN 1 ELSE 0 END AS hospital_mortality,
  CAST(CAST(r.admit_date AS DATE) AS TIMESTAMP) + INTERVAL '1439' MINUTE AS mid, CAST(date_diff('day', CAST(r.admit_date AS DATE), CAST(r.discharge_date AS DATE)) >= 7 AS INT) AS los_7,
  s.sepsis_index_date, CASE WHEN s.person_id IS NULL THEN 0 ELSE 1 END AS sepsis, {CUT_SQL.format(d='r.admit_date')} AS fold_id
  FROM adm_readm r LEFT JOIN death d USING (person_id) LEFT JOIN susp s ON s.person_id = r.person_id AND s.admit_datetime = r.admit_date""")
BASE = "coalesce(CAST(death_date AS TIMESTAMP) <= mid, FALSE) OR discharge_date <= mid"
OUTS = {"hospital_mortality": BASE, "los_7": BASE, "readmission_30": f"{BASE} OR hospital_mortality = 1 OR coalesce(readmission_window = 0, FALSE)", "sepsis": f"{BASE} OR coalesce(sepsis_index_date <= mid, FALSE)"}
cte("tasks", " UNION ALL ".join(f"SELECT person_id, admit_date, discharge_date, '{n}' AS task, CASE WHEN {c} THEN 'ignore' ELSE fold_id END AS task_fold_id, CASE WHEN NOT ({c}) THEN CAST({n} AS DOUBLE) END AS label FROM tasks_in" for n, c in OUTS.items()))


def task_cohort(t):
    base = adm(t)
    found = infection(t).select("person_id", F.col("admit_datetime").alias("admit_date"), "sepsis_index_date", F.lit(1).alias("sepsis"))
    out = O.length_of_stay(O.hospital_mortality(O.readmission(O.end_of_days(base)), t.death)).join(found, ["person_id", "admit_date"], "left")
    return P.time_split(out.withColumn("sepsis", F.coalesce("sepsis", F.lit(0))), "admit_date", CUTS)


def long_tasks(t):
    return P.task_exclusions(task_cohort(t), {"hospital_mortality": None, "los_7": None, "readmission_30": None, "sepsis": "sepsis_index_date"})


@query("spl_05_task_exclusions", "SELECT * FROM tasks")
def _(t):
    return long_tasks(t)


@query("spl_05_wide_tasks", "SELECT person_id, admit_date, discharge_date, " + ", ".join(f"max(label) FILTER (WHERE task = '{n}') AS {n}, max(task_fold_id) FILTER (WHERE task = '{n}') AS {n}_fold_id" for n in OUTS) + " FROM tasks GROUP BY 1, 2, 3")
def _(t):
    return P.wide_tasks(long_tasks(t), list(OUTS))


cte("taskd", f"""SELECT t.*, CASE WHEN task LIKE 'readmission%' THEN CAST(discharge_date AS DATE) ELSE CAST(admit_date AS DATE) END AS date, CASE WHEN task_fold_id IN ('test', 'val') THEN task_fold_id ELSE 'train' END AS fold FROM tasks t WHERE task_fold_id <> 'ignore'""")
cte("taskin", "SELECT t.*, a.age_in_years FROM taskd t JOIN adm_age a USING (person_id, admit_date) WHERE " + " OR ".join(f"(fold = '{n}' AND date BETWEEN DATE '{a}' AND DATE '{b}')" for n, (a, b) in CUTS.items()))


@query("spl_06_task_tables", """SELECT p.population, task, fold, t.person_id, date, (SELECT max(day_index) FROM tld d WHERE d.person_id = t.person_id AND d.day <= t.date) AS day_index, label
  FROM taskin t JOIN (VALUES ('mix'), ('ad'), ('ped')) p(population) ON p.population = 'mix' OR (p.population = 'ad') = (age_in_years >= 18)""")
def _(t):
    adult = O.age_groups(adm(t), t.person).withColumn("adult_at_admission", (F.col("age_in_years") >= 18).cast("int"))
    return P.task_tables(long_tasks(t), ed(t)[1], CUTS, adult)


cte("prein", f"SELECT person_id, p.population, max(CASE WHEN {CUT_SQL.format(d='s.admit_date')} IN ('val', 'test') THEN 1 ELSE 0 END) AS held FROM adm_stage s JOIN adm_age a USING (person_id, admit_date) JOIN (VALUES ('mix'), ('ad'), ('ped')) p(population) ON p.population = 'mix' OR (p.population = 'ad') = (age_in_years >= 18) WHERE pediatric_age_group <> 'term neonatal' GROUP BY 1, 2")


@query("spl_07_pretraining_lists", """SELECT population, person_id, 'exclude' AS part FROM prein WHERE held = 1 UNION ALL SELECT population, person_id, CASE WHEN rk < floor(n * 0.2) THEN 'val' ELSE 'train' END FROM (
  SELECT *, row_number() OVER (PARTITION BY population ORDER BY md5('0|' || CAST(person_id AS VARCHAR))) - 1 AS rk, count(*) OVER (PARTITION BY population) AS n FROM prein WHERE held = 0) q""")
def _(t):
    staged = O.age_day_groups(O.age_groups(adm(t), t.person).drop("age_group"), t.person)
    return P.pretraining_lists(P.time_split(C.adult_flag(staged), "admit_date", CUTS))


@query("spl_08_task_features", "SELECT a.* FROM adm_age a WHERE (person_id, admit_date) IN (SELECT (person_id, admit_date) FROM tasks WHERE task = 'readmission_30' AND task_fold_id <> 'ignore')")
def _(t):
    return P.task_features(O.age_groups(adm(t), t.person).drop("age_group"), long_tasks(t), "readmission_30", ["person_id", "admit_date"])


@query("spl_09_phases", f"""WITH b AS (SELECT *, {CUT_SQL.format(d='admit_date')} AS fold_id FROM adm_band), c AS (SELECT age_group, count(*) AS g FROM b WHERE fold_id = 'train' GROUP BY 1)
  SELECT b.*, CASE WHEN fold_id IN ('test', 'val') THEN fold_id ELSE 'train' END AS phase, i.group_id, (SELECT sum(g) FROM c) / g AS group_weight FROM b
  JOIN (SELECT age_group, row_number() OVER (ORDER BY age_group) - 1 AS group_id FROM (SELECT DISTINCT age_group FROM b) z) i USING (age_group) LEFT JOIN c USING (age_group)""")
def _(t):
    return P.phases(P.time_split(O.age_groups(adm(t), t.person), "admit_date", CUTS), "age_group", "val")


@query("spl_10_person_splitter", f"""SELECT a.row_id, CAST(CASE WHEN rk < floor(n * 0.3) THEN -1 WHEN rk < floor(n * 0.3) + floor(round(n * 0.1, 6)) THEN 0 ELSE CAST(rk - floor(n * 0.3) - floor(round(n * 0.1, 6)) AS BIGINT) % 3 + 1 END AS INT) AS "index" FROM predictions a JOIN {rank(4, 'predictions')} q USING (person_id)""")
def _(t):
    return P.person_splitter(t.predictions.withColumnRenamed("labels", "outcome"), 0.3, 0.6, 3, 4)


@query("spl_11_split_summary", """SELECT task, task_fold_id, age_group, count(*) AS n, avg(label) AS prevalence, 100.0 * count(*) / max(tn) AS percent FROM (SELECT t.*, b.age_group, count(*) OVER (PARTITION BY task) AS tn FROM tasks t JOIN adm_band b USING (person_id, admit_date)) q GROUP BY 1, 2, 3""")
def _(t):
    ages = O.age_groups(adm(t), t.person).select("person_id", "admit_date", "age_group")
    return P.split_summary(long_tasks(t).join(ages, ["person_id", "admit_date"]), ["age_group"])


@query("spl_11_group_quartiles", """SELECT fold_id, age_group, variable, count(v) AS n, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.75) AS q75 FROM (SELECT fold_id, age_group, unnest(['age_in_years', 'stay_days']) AS variable,
  unnest([CAST(age_in_years AS DOUBLE), CAST(date_diff('day', CAST(admit_date AS DATE), CAST(discharge_date AS DATE)) AS DOUBLE)]) AS v FROM (SELECT *, """ + CUT_SQL.format(d="admit_date") + """ AS fold_id FROM adm_band) q) z WHERE v IS NOT NULL AND fold_id IS NOT NULL GROUP BY 1, 2, 3""")
def _(t):
    rows = P.time_split(O.age_groups(adm(t), t.person), "admit_date", CUTS).withColumn("stay_days", F.datediff("discharge_date", "admit_date"))
    return P.group_quartiles(rows, ["fold_id", "age_group"], ["age_in_years", "stay_days"])


@query("spl_12_incidence_tables", """SELECT age_group, race_eth, gender_concept_name, avg(ascvd_binary) AS incidence, count(*) AS n, 3 - grouping(age_group) - grouping(race_eth) - grouping(gender_concept_name) AS ways,
  grouping(age_group, race_eth, gender_concept_name) AS combination FROM cvd_demo GROUP BY CUBE (age_group, race_eth, gender_concept_name) HAVING grouping(age_group, race_eth, gender_concept_name) < 7""")
def _(t):
    return P.incidence_tables(outcome_demo(t), "ascvd_binary", ["age_group", "race_eth", "gender_concept_name"])


@query("spl_13_profile_counts", "SELECT visit_concept_id, discharge_to_concept_id, count(*) AS n FROM visit_occurrence GROUP BY 1, 2")
def _(t):
    return P.profile_counts(t.visit_occurrence, ["visit_concept_id", "discharge_to_concept_id"])
