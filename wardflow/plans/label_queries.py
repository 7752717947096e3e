"""Queries of the laboratory, diagnosis, concept and cardiovascular-outcome operators."""

from pyspark.sql import functions as F

from ..operators import concepts as K, diagnoses as D, labs as L, outcomes
from .cohort_queries import adm, outpatients
from .registry import cte, query


def ids(values) -> str:
    return ", ".join(str(v) for v in values)


def expanded(values) -> str:
    v = ids(values)
    return f"""(SELECT concept_id FROM concept WHERE concept_id IN ({v}) UNION SELECT descendant_concept_id FROM concept_ancestor a
      JOIN concept c ON c.concept_id = a.descendant_concept_id WHERE ancestor_concept_id IN ({v}) AND invalid_reason IS NULL)"""


def value_sql(spec: L.LabSpec) -> str:
    def conv(name):
        return "CASE unit_concept_id " + " ".join(f"WHEN {u} THEN {name} {r}" for u, r in spec.units.items()) + " END"
    return f"""SELECT person_id, measurement_datetime, {conv('value_as_number')} AS value, {conv('range_low')} AS range_low, {conv('range_high')} AS range_high
      FROM measurement WHERE unit_concept_id IN ({ids(spec.units)}) AND measurement_concept_id IN {expanded(spec.concepts)}"""


def label_sql(label, levels, low, extreme, limits, source, tests=None) -> str:
    """One window function per level and outer joins, unlike the one-pass Spark form."""
    tests = tests or {n: f"value {op} {x}" for n, (op, x) in levels.items()}
    if limits:
        tests = {**tests, "abnormal": "value < range_low" if low else "value > range_high"}
    parts = [f"inside AS (SELECT a.admit_date, a.discharge_date, v.* FROM adm a JOIN ({source}) v ON a.person_id = v.person_id AND measurement_datetime BETWEEN admit_date AND discharge_date)"]
    order = "measurement_datetime, value" + (", range_low, range_high" if limits else "")
    cols, joins = [], []
    for n, test in tests.items():
        parts.append(f"f_{n} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id, admit_date, discharge_date ORDER BY {order}) AS rn FROM inside WHERE {test}) q WHERE rn = 1)")
        cols.append(f"f_{n}.value AS {label}_{n}_measurement, f_{n}.measurement_datetime AS {label}_{n}_measurement_datetime, CASE WHEN f_{n}.rn = 1 THEN 1 END AS {label}_{n}_label")
        joins.append(f"LEFT JOIN f_{n} USING (person_id, admit_date, discharge_date)")
    if limits:
        cols.append(f"f_abnormal.{'range_low' if low else 'range_high'} AS {label}_abnormal_threshold")
    return f"""WITH {', '.join(parts)} SELECT m.person_id, m.admit_date, m.discharge_date, m.x AS {label}_{extreme}, {', '.join(cols)}
      FROM (SELECT person_id, admit_date, discharge_date, {'min' if low else 'max'}(value) AS x FROM inside GROUP BY 1, 2, 3) m {' '.join(joins)}"""


def register_lab(number: int, spec: L.LabSpec):
    @query(f"labq_{number:02d}_{spec.label}", label_sql(spec.label, spec.levels, spec.low, spec.extreme, True, value_sql(spec)))
    def _(t):
        return L.lab_label(adm(t), t.measurement, t.concept, t.concept_ancestor, spec)


for _n, _s in ((1, L.HYPERKALEMIA), (2, L.HYPOGLYCEMIA), (4, L.HYPONATREMIA), (5, L.ANEMIA), (7, L.THROMBOCYTOPENIA)):
    register_lab(_n, _s)

cte("admmid", """SELECT DISTINCT person_id, CAST(CAST(admit_date AS DATE) AS TIMESTAMP) + INTERVAL '1439' MINUTE AS admit_date, CAST(CAST(discharge_date AS DATE) AS TIMESTAMP) + INTERVAL '1439' MINUTE AS discharge_date FROM adm""")


@query("labq_00_any_window", "SELECT * RENAME (admit_date AS admit_date_midnight, discharge_date AS discharge_date_midnight) FROM (" + label_sql(
    L.HYPONATREMIA.label, L.HYPONATREMIA.levels, True, L.HYPONATREMIA.extreme, True, value_sql(L.HYPONATREMIA)).replace("FROM adm a JOIN", "FROM admmid a JOIN").replace(
    "measurement_datetime BETWEEN admit_date AND discharge_date", "measurement_datetime > admit_date AND measurement_datetime <= discharge_date") + ") w")
def _(t):
    return L.lab_label(outcomes.end_of_days(adm(t)), t.measurement, t.concept, t.concept_ancestor, L.HYPONATREMIA, closed="right",
                       start="admit_date_midnight", end="discharge_date_midnight")


AGE = "date_diff('day', CAST(birth_datetime AS DATE), CAST(admit_date AS DATE))"
NORM = f"""CASE WHEN {AGE} BETWEEN 0 AND 14 THEN 0.92 WHEN {AGE} BETWEEN 15 AND 729 THEN 0.36 WHEN {AGE} BETWEEN 730 AND 1824 THEN 0.43
  WHEN {AGE} BETWEEN 1825 AND 4379 THEN 0.61 WHEN {AGE} BETWEEN 4380 AND 5474 THEN 0.81 WHEN {AGE} BETWEEN 5475 AND 6934 THEN 0.84
  WHEN {AGE} >= 6935 AND gender_concept_id = 8532 THEN 1.1 WHEN {AGE} >= 6935 AND gender_concept_id <> 8532 THEN 1.2 END"""
cte("crea_umol", value_sql(L.KIDNEY_INJURY))
cte("crea_mgdl", f"""SELECT person_id, measurement_datetime, CASE unit_concept_id WHEN 8749 THEN value_as_number * 0.0113122 WHEN 8837 THEN value_as_number * 0.001 ELSE value_as_number END AS value
  FROM measurement WHERE unit_concept_id IN (8749, 8840, 8837) AND measurement_concept_id IN {expanded(L.KIDNEY_INJURY.concepts)}""")


def baseline_sql(source: str, divisor: str) -> str:
    return f"""SELECT a.person_id, a.admit_date, a.discharge_date, COALESCE(r.low, CAST({NORM} AS DOUBLE) / {divisor}) AS baseline
      FROM adm a LEFT JOIN person p USING (person_id) LEFT JOIN (SELECT a.person_id, a.admit_date, a.discharge_date, min(value) AS low FROM adm a JOIN {source} v
        ON a.person_id = v.person_id AND measurement_datetime >= admit_date - INTERVAL '90' DAY AND measurement_datetime < admit_date GROUP BY 1, 2, 3) r
      USING (person_id, admit_date, discharge_date) WHERE a.person_id IN (SELECT person_id FROM {source})"""


cte("base_umol", baseline_sql("crea_umol", "0.0113122"))
cte("base_mgdl", baseline_sql("crea_mgdl", "1.0"))


@query("labq_03_aki_lab", label_sql("aki_lab", {}, False, "max_creatinine", True, "SELECT v.*, b.baseline, b.admit_date AS b_admit FROM crea_umol v JOIN base_umol b ON b.person_id = v.person_id",
    {"aki1": "(value / baseline >= 1.5 OR value - baseline >= 26.52)", "aki2": "value / baseline >= 2.0", "aki3": "(value / baseline >= 3.0 OR value - baseline >= 353.6)"})
    .replace("BETWEEN admit_date AND discharge_date)", "BETWEEN admit_date AND discharge_date AND b_admit = admit_date)"))
def _(t):
    return L.kidney_injury_label(adm(t), t.measurement, t.concept, t.concept_ancestor, t.person)


cte("wbc_v", "SELECT DISTINCT person_id, measurement_datetime, value_as_number AS wbc FROM measurement WHERE measurement_concept_id = 3010813 AND unit_concept_id IN (8848, 8961)")
cte("band_v", """SELECT DISTINCT m.person_id, m.measurement_datetime, CASE WHEN m.measurement_concept_id = 3035839 AND value_as_number <= 100 THEN value_as_number / 100 * wbc
  WHEN m.measurement_concept_id = 3018199 AND unit_concept_id = 8784 THEN value_as_number / 1000 END AS bands
  FROM measurement m LEFT JOIN wbc_v w ON w.person_id = m.person_id AND w.measurement_datetime = m.measurement_datetime WHERE m.measurement_concept_id IN (3035839, 3018199)""")
cte("neut_v", f"""SELECT DISTINCT m.person_id, m.measurement_datetime, CASE WHEN unit_concept_id = 8554 AND value_as_number <= 100 THEN value_as_number / 100 * wbc
  WHEN unit_concept_id = 8554 THEN NULL WHEN unit_concept_id = 8784 THEN value_as_number / 1000 ELSE value_as_number END AS neut
  FROM measurement m LEFT JOIN wbc_v w ON w.person_id = m.person_id AND w.measurement_datetime = m.measurement_datetime
  WHERE unit_concept_id IN (8848, 8554, 8784, 8961) AND m.measurement_concept_id IN {expanded((37045722, 37049637))}""")
cte("cells_v", """SELECT DISTINCT person_id, measurement_datetime, CASE WHEN neut IS NOT NULL OR bands IS NOT NULL THEN coalesce(neut, 0) + coalesce(bands, 0) ELSE wbc END AS value
  FROM neut_v FULL JOIN band_v USING (person_id, measurement_datetime) FULL JOIN wbc_v USING (person_id, measurement_datetime)
  WHERE neut IS NOT NULL OR bands IS NOT NULL OR wbc IS NOT NULL""")


@query("labq_06_neutropenia_lab", label_sql("neutropenia_lab", L.NEUTROPENIA_LEVELS, True, "min_neutrophils", False, "SELECT * FROM cells_v"))
def _(t):
    return L.neutropenia_label(adm(t), t.measurement, t.concept, t.concept_ancestor)


@query("labq_08_creatinine_baseline", "SELECT * FROM base_umol")
def _(t):
    values = L.lab_values(t.measurement, K.expand(t.concept, t.concept_ancestor, L.KIDNEY_INJURY.concepts), L.KIDNEY_INJURY.units)
    return L.creatinine_baseline(adm(t), values, t.person, L.MGDL_PER_UMOL)


def _first_open(source, test, name):
    return f"""{name} AS (SELECT person_id, admit_date, min(struct_pack(t := measurement_datetime, v := value)) AS f FROM adm a JOIN {source} v USING (person_id)
      WHERE measurement_datetime > a.admit_date AND measurement_datetime <= a.discharge_date AND ({test}) GROUP BY 1, 2)"""


cte("glu_mgdl", f"""SELECT person_id, measurement_datetime, CASE WHEN unit_concept_id = 8753 THEN value_as_number * 18 ELSE value_as_number END AS value FROM measurement
  WHERE unit_concept_id IN (8840, 9028, 8753) AND measurement_concept_id IN {expanded((4144235, 1002597))}""")
cte("crea_based", "SELECT v.*, b.admit_date AS b_admit, baseline FROM crea_mgdl v JOIN base_mgdl b USING (person_id)")
_extremes = lambda source, fn, name: f"""{name} AS (SELECT person_id, admit_date, {fn}(value) AS x FROM adm a JOIN {source} v USING (person_id)
  WHERE measurement_datetime > a.admit_date AND measurement_datetime <= a.discharge_date GROUP BY 1, 2)"""


@query("labq_09_admission_labs", "WITH " + ", ".join([
    _first_open("crea_based", "b_admit = a.admit_date AND (value / baseline >= 1.5 OR value - baseline >= 0.3)", "k1"),
    _first_open("crea_based", "b_admit = a.admit_date AND value / baseline >= 2.0", "k2"),
    _first_open("glu_mgdl", "value <= 60", "g1"), _first_open("cells_v", "value < 0.5", "n5"), _first_open("cells_v", "value < 1.0", "n10"),
    _extremes("crea_mgdl", "max", "kx"), _extremes("glu_mgdl", "min", "gx"), _extremes("cells_v", "min", "nx")]) + """
  SELECT a.person_id, a.admit_date, a.discharge_date, b.baseline AS aki_base_creatinine, kx.x AS aki_max_creatinine, k1.f.v AS aki1_creatinine, k1.f.t AS aki1_creatinine_time,
   k2.f.v AS aki2_creatinine, k2.f.t AS aki2_creatinine_time, gx.x AS hg_min_glucose, g1.f.v AS hg_glucose, g1.f.t AS hg_glucose_time, nx.x AS np_min_neutrophils,
   n5.f.v AS np_500_neutrophils, n5.f.t AS np_500_neutrophils_time, n10.f.v AS np_1000_neutrophils, n10.f.t AS np_1000_neutrophils_time,
   CAST(k1.f.v IS NOT NULL AS INT) AS aki1_label, CAST(k2.f.v IS NOT NULL AS INT) AS aki2_label, CAST(g1.f.v IS NOT NULL AS INT) AS hg_label,
   CAST(n5.f.v IS NOT NULL AS INT) AS np_500_label, CAST(n10.f.v IS NOT NULL AS INT) AS np_1000_label
  FROM adm a LEFT JOIN base_mgdl b USING (person_id, admit_date) LEFT JOIN kx USING (person_id, admit_date) LEFT JOIN k1 USING (person_id, admit_date)
  LEFT JOIN k2 USING (person_id, admit_date) LEFT JOIN gx USING (person_id, admit_date) LEFT JOIN g1 USING (person_id, admit_date)
  LEFT JOIN nx USING (person_id, admit_date) LEFT JOIN n5 USING (person_id, admit_date) LEFT JOIN n10 USING (person_id, admit_date)""")
def _(t):
    return L.admission_labs(adm(t), t.measurement, t.concept, t.concept_ancestor, t.person)


def dx_sql(names) -> str:
    parts = [f"""d_{n} AS (SELECT a.person_id, a.admit_date, min(condition_start_datetime) AS at FROM adm a JOIN condition_occurrence c ON c.person_id = a.person_id
      AND condition_start_datetime BETWEEN admit_date AND discharge_date WHERE condition_concept_id IN {expanded(D.DIAGNOSES[n])} GROUP BY 1, 2)""" for n in names]
    cols = [f"d_{n}.at AS {n}_start_datetime, CASE WHEN d_{n}.at IS NULL THEN 0 ELSE 1 END AS {n}_label" for n in names]
    return f"WITH {', '.join(parts)} SELECT a.*, {', '.join(cols)} FROM adm a " + " ".join(f"LEFT JOIN d_{n} USING (person_id, admit_date)" for n in names)


@query("dxq_00_one_diagnosis_label", dx_sql(["anemia_dx"]))
def _(t):
    return D.diagnosis_labels(adm(t), t.condition_occurrence, t.concept, t.concept_ancestor, {"anemia_dx": D.DIAGNOSES["anemia_dx"]})


@query("dxq_01_all_diagnosis_labels", dx_sql(list(D.DIAGNOSES)))
def _(t):
    return D.diagnosis_labels(adm(t), t.condition_occurrence, t.concept, t.concept_ancestor)


@query("con_01_concept_expansion", " UNION ALL ".join(f"SELECT '{n}' AS set_name, concept_id FROM {expanded(v)} x" for n, v in D.DIAGNOSES.items()))
def _(t):
    return K.expand_sets(t.concept, t.concept_ancestor, D.DIAGNOSES)


SOURCE_SQL = {
    "cardiovascular": "vocabulary_id = 'ICD9CM' AND (left(concept_code, 3) IN ('410','411','413','414','430','431','432','433','434','436','428') OR concept_code = '427.31')",
    "mi_stroke": "vocabulary_id = 'ICD9CM' AND (left(concept_code, 3) IN ('410','430','431','432','436') OR (left(concept_code, 3) IN ('433','434') AND NOT regexp_matches(concept_code, '^43[34]\\..0$')))",
    "coronary": "vocabulary_id = 'ICD9CM' AND left(concept_code, 3) IN ('411','413','414')",
    "statin": f"vocabulary_id = 'ATC' AND concept_code IN ({', '.join(repr(c) for c in K.STATINS)})",
}
for _name, _where in SOURCE_SQL.items():
    cte(f"src_{_name}", f"""SELECT DISTINCT concept_id_2 AS concept_id FROM concept_relationship WHERE relationship_id = 'Maps to' AND concept_id_1 IN (SELECT concept_id FROM concept WHERE {_where})""")
    cte(f"roll_{_name}", f"""SELECT concept_id FROM src_{_name} UNION SELECT descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id IN (SELECT concept_id FROM src_{_name})""")


@query("con_02_source_rollup", " UNION ALL ".join(f"SELECT '{n}' AS set_name, concept_id FROM roll_{n}" for n in SOURCE_SQL))
def _(t):
    return K.source_rollups(t.concept, t.concept_relationship, t.concept_ancestor, K.source_predicates())


# Parent edges over parts: p -> p/3 and p -> p/7, codes of the vocabulary that may list several; codes divisible by 11 are mapped.
cte("par_edges", """SELECT 'C/' || CAST(p_partkey AS VARCHAR) AS code, 'C/' || CAST(CAST(floor(p_partkey / k) AS BIGINT) AS VARCHAR) AS parent, 'ICD10CM' AS vocabulary
  FROM part, (VALUES (3), (7)) v(k) WHERE p_partkey > 0""")
cte("one_parent", """SELECT code, parent FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY length(parent) DESC, parent) AS k, count(*) OVER (PARTITION BY code) AS n FROM (SELECT DISTINCT * FROM par_edges) q) z
  WHERE k = 1 AND (n = 1 OR vocabulary = 'ICD10CM')""")


@query("con_03_recover_unmapped", """WITH RECURSIVE walk AS (
   SELECT code, parent AS node FROM one_parent WHERE CAST(substr(code, 3) AS BIGINT) % 11 <> 0
   UNION SELECT w.code, e.parent FROM walk w JOIN one_parent e ON e.code = w.node WHERE CAST(substr(w.node, 3) AS BIGINT) % 11 <> 0)
  SELECT code, node AS recovered FROM walk WHERE CAST(substr(node, 3) AS BIGINT) % 11 = 0""")
def _(t):
    number = lambda c: F.substring(c, 3, 20).cast("bigint")
    part, key = t.part, F.col("p_partkey")
    code = lambda n: F.concat(F.lit("C/"), n.cast("string"))
    up = F.array(*[code(F.floor(key / k)) for k in (3, 7)])
    edges = part.where(key > 0).select(code(key).alias("code"), F.explode(up).alias("parent"), F.lit(K.MANY_PARENTS).alias("vocabulary"))
    codes = part.select(code(key).alias("code"))
    return K.recover_unmapped(codes.where(number("code") % 11 != 0), edges, codes.where(number("code") % 11 == 0))


H = 1826.25
cte("cvd_raw", """SELECT o.*,
   CAST(EXISTS (SELECT 1 FROM condition_occurrence c WHERE c.person_id = o.person_id AND c.condition_start_date < o.visit_start_date AND condition_concept_id IN (SELECT concept_id FROM roll_cardiovascular)) AS INT) AS has_cvd_history,
   CAST(EXISTS (SELECT 1 FROM drug_exposure d WHERE d.person_id = o.person_id AND drug_exposure_start_date < o.visit_start_date AND drug_concept_id IN (SELECT concept_id FROM roll_statin)) AS INT) AS has_statin_history,
   (SELECT min(drug_exposure_start_date) FROM drug_exposure d WHERE d.person_id = o.person_id AND drug_exposure_start_date >= o.visit_start_date AND drug_concept_id IN (SELECT concept_id FROM roll_statin)) AS statin_censoring_date,
   (SELECT min(condition_start_date) FROM cvd_events c WHERE c.person_id = o.person_id AND condition_start_date > o.visit_start_date) AS outcome_date, x.death_date
  FROM outp o LEFT JOIN death x USING (person_id)""")
cte("chd_days", """SELECT DISTINCT person_id, condition_start_date FROM condition_occurrence c JOIN death d USING (person_id)
  WHERE condition_concept_id IN (SELECT concept_id FROM roll_coronary) AND date_diff('day', condition_start_date, death_date) BETWEEN 1 AND 365""")
cte("cvd_events", "SELECT person_id, condition_start_date FROM condition_occurrence WHERE condition_concept_id IN (SELECT concept_id FROM roll_mi_stroke) UNION SELECT * FROM chd_days")
cte("cvd_ends", """SELECT *, least(coalesce(death_date, observation_period_end_date), observation_period_end_date) AS endpoint_censoring_date,
  least(coalesce(death_date, observation_period_end_date), coalesce(statin_censoring_date, observation_period_end_date), observation_period_end_date) AS censoring_date FROM cvd_raw""")
cte("cvd_days", """SELECT *, date_diff('day', visit_start_date, outcome_date) AS days_until_outcome, date_diff('day', visit_start_date, censoring_date) AS days_until_censoring,
  date_diff('day', visit_start_date, endpoint_censoring_date) AS days_until_endpoint_censoring FROM cvd_ends""")
cte("cvd", f"""SELECT * EXCLUDE (visit_start_date), visit_start_date AS index_date,
  CASE WHEN days_until_outcome IS NULL OR days_until_outcome > days_until_censoring THEN days_until_censoring ELSE days_until_outcome END AS days_until_event,
  CASE WHEN days_until_outcome <= days_until_censoring THEN 1 ELSE 0 END AS event_indicator,
  CASE WHEN days_until_outcome IS NULL OR days_until_outcome > days_until_endpoint_censoring THEN days_until_endpoint_censoring ELSE days_until_outcome END AS days_until_endpoint_censored_event,
  CASE WHEN days_until_outcome <= days_until_endpoint_censoring THEN 1 ELSE 0 END AS endpoint_censored_event_indicator,
  CAST(days_until_censoring < {H} AND (days_until_outcome IS NULL OR days_until_censoring < days_until_outcome) AS INT) AS censored_binary,
  CAST(days_until_endpoint_censoring < {H} AND (days_until_outcome IS NULL OR days_until_endpoint_censoring < days_until_outcome) AS INT) AS endpoint_censored_binary,
  CASE WHEN days_until_outcome BETWEEN 0 AND {H} AND days_until_outcome < days_until_censoring THEN 1 WHEN coalesce(days_until_outcome, days_until_censoring) > {H} AND days_until_censoring > {H} THEN 0 END AS ascvd_binary,
  CASE WHEN days_until_outcome BETWEEN 0 AND {H} AND days_until_outcome < days_until_endpoint_censoring THEN 1 WHEN coalesce(days_until_outcome, days_until_endpoint_censoring) > {H} AND days_until_endpoint_censoring > {H} THEN 0 END AS ascvd_binary_endpoint_censored
  FROM cvd_days""")


def cardiovascular(t):
    return D.cardiovascular_outcome(outpatients(t), t.condition_occurrence, t.drug_exposure, t.death, t.concept,
                                    t.concept_relationship, t.concept_ancestor, event_followup_days=H)


@query("out_13_cardiovascular_outcome", "SELECT * FROM cvd")
def _(t):
    return cardiovascular(t)


@query("out_14_coronary_death", "SELECT person_id, condition_start_date AS day FROM chd_days")
def _(t):
    concepts = K.source_rollup(t.concept, t.concept_relationship, t.concept_ancestor, K.source_predicates()["coronary"])
    return D.coronary_death_days(t.condition_occurrence, concepts, t.death)


cte("cvd_demo", """SELECT c.person_id, index_date, age_in_years, ascvd_binary, race_eth, gender_concept_name,
  CASE WHEN age_in_years < 30 AND age_in_years >= 18 THEN '[18-30)' WHEN age_in_years >= 30 AND age_in_years < 45 THEN '[30-45)' WHEN age_in_years >= 45 AND age_in_years < 55 THEN '[45-55)'
   WHEN age_in_years >= 55 AND age_in_years < 65 THEN '[55-65)' WHEN age_in_years >= 65 AND age_in_years < 75 THEN '[65-75)' WHEN age_in_years >= 75 AND age_in_years < 91 THEN '[75-91)' ELSE '<18' END AS age_group
  FROM cvd c LEFT JOIN demo USING (person_id) WHERE gender_concept_name <> 'No matching concept'""")


def outcome_demo(t):
    return D.outcome_demographics(cardiovascular(t), t.person, t.concept).select(
        "person_id", "index_date", "age_in_years", "ascvd_binary", "race_eth", "gender_concept_name", "age_group")


@query("out_15_outcome_demographics", "SELECT * FROM cvd_demo")
def _(t):
    return outcome_demo(t)
