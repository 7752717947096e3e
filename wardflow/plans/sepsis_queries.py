"""Queries of the sepsis components, scores and label."""

from pyspark.sql import functions as F

from ..operators import sepsis as Z
from .cohort_queries import adm, build_admissions
from .label_queries import expanded
from .registry import cte, query

J = lambda col, source: f"list_filter(from_json(json_extract({col}, '$.values'), '[{{\"source\":\"VARCHAR\",\"value\":\"VARCHAR\"}}]'), lambda v: v.source = '{source}')[1].value"
N = "observation_concept_id = 2000006253"
cte("sheet", f"""SELECT observation_id, o.person_id, observation_datetime,
  CASE WHEN {N} THEN {J("CASE WHEN " + N + " THEN observation_source_value END", "ip_flt_data.display_name")} ELSE observation_source_value END AS source_display_name,
  CASE WHEN {N} THEN {J("CASE WHEN " + N + " THEN value_as_string END", "ip_flo_gp_data.disp_name")} ELSE c.concept_name END AS display_name,
  CASE WHEN {N} THEN {J("CASE WHEN " + N + " THEN value_as_string END", "ip_flwsht_meas.meas_value")} ELSE coalesce(value_as_string, CAST(value_as_number AS VARCHAR)) END AS meas_value,
  CASE WHEN {N} THEN {J("CASE WHEN " + N + " THEN value_as_string END", "ip_flo_gp_data.units")} ELSE unit_source_value END AS unit_value
  FROM observation o LEFT JOIN concept c ON c.concept_id = o.observation_source_concept_id""")
cte("susp_pairs", """SELECT a.person_id, a.admit_date AS admit_datetime, a.discharge_date AS discharge_datetime, m.measurement_datetime AS bc, d.drug_exposure_start_datetime AS abx
  FROM adm a JOIN (SELECT person_id, measurement_datetime FROM measurement WHERE measurement_concept_id IN (SELECT descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id = 4107893)) m
   ON m.person_id = a.person_id AND CAST(CAST(m.measurement_datetime AS DATE) AS TIMESTAMP) >= a.admit_date - INTERVAL '1' DAY AND CAST(CAST(m.measurement_datetime AS DATE) AS TIMESTAMP) <= a.discharge_date
  JOIN (SELECT person_id, drug_exposure_start_datetime FROM drug_exposure WHERE drug_concept_id IN (SELECT descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id = 21602796)) d
   ON d.person_id = a.person_id AND CAST(CAST(d.drug_exposure_start_datetime AS DATE) AS TIMESTAMP) >= a.admit_date - INTERVAL '1' DAY AND CAST(CAST(d.drug_exposure_start_datetime AS DATE) AS TIMESTAMP) <= a.discharge_date
   AND date_diff('day', CAST(d.drug_exposure_start_datetime AS DATE), CAST(m.measurement_datetime AS DATE)) BETWEEN -3 AND 1""")
cte("susp", """SELECT q.person_id, (year(admit_datetime) - year(birth_datetime)) * 12 + month(admit_datetime) - month(birth_datetime) AS age_in_months, CAST(admit_datetime AS DATE) AS admit_date, admit_datetime,
  CAST(discharge_datetime AS DATE) AS discharge_date, discharge_datetime, min_bc, min_systemic_abx, least(min_bc, min_systemic_abx) AS sepsis_index_date
  FROM (SELECT person_id, admit_datetime, discharge_datetime, min(bc) AS min_bc, min(abx) AS min_systemic_abx FROM susp_pairs GROUP BY 1, 2, 3) q LEFT JOIN person USING (person_id)""")
cte("per", """SELECT s.*, period, CAST(sepsis_index_date AS DATE) + CAST(lo AS INT) AS lo, CAST(sepsis_index_date AS DATE) + CAST(hi AS INT) AS hi, CAST(sepsis_index_date AS DATE) + CAST(dlo AS INT) AS dlo, CAST(sepsis_index_date AS DATE) + CAST(dhi AS INT) AS dhi
  FROM susp s, (VALUES ('current', -1, 2, -2, 1), ('prior', -10, -3, -10, -3)) v(period, lo, hi, dlo, dhi)""")
VALUE = {
    "platelet": "CASE WHEN value_as_number > 0 THEN value_as_number END",
    "creatinine": "CASE WHEN value_as_number > 0 THEN CASE unit_concept_id WHEN 8749 THEN value_as_number / 0.0113122 WHEN 8837 THEN value_as_number / 1000 ELSE value_as_number END END",
    "bilirubin": "CASE WHEN value_as_number > 0 THEN value_as_number END",
    "lactate": "CASE WHEN value_as_number > 0 THEN CASE unit_concept_id WHEN 8840 THEN value_as_number * 9.0 WHEN 8837 THEN value_as_number / 0.001 * 9.0 ELSE value_as_number END END",
}
_pick = lambda fn, n, extra="": f"{fn}(CASE WHEN measurement_concept_id IN {expanded(Z.SETS[n])} THEN {VALUE[n]} END)"
cte("mper", "SELECT p.person_id, p.admit_datetime, p.discharge_datetime, p.period, m.* EXCLUDE (person_id) FROM per p JOIN measurement m ON m.person_id = p.person_id AND m.measurement_date BETWEEN p.lo AND p.hi")
cte("ext", f"""SELECT person_id, admit_datetime, period, {_pick('min', 'platelet')} AS min_platelet, {_pick('max', 'creatinine')} AS max_creatinine,
  min(CASE WHEN measurement_concept_id = 3032652 AND value_as_number BETWEEN 3 AND 15 THEN value_as_number END) AS min_gcs, {_pick('max', 'bilirubin')} AS max_bilirubin, {_pick('max', 'lactate')} AS max_lactate,
  min(CASE WHEN measurement_concept_id = 3027598 AND value_as_number >= 10 THEN value_as_number END) AS min_map FROM mper GROUP BY 1, 2, 3""")
cte("sper", "SELECT p.person_id, p.admit_datetime, p.period, s.* EXCLUDE (person_id) FROM per p JOIN sheet s ON s.person_id = p.person_id AND CAST(s.observation_datetime AS DATE) BETWEEN p.lo AND p.hi")
cte("vent", "SELECT person_id, admit_datetime, period, count(*) AS count_vent_mode FROM sper WHERE upper(display_name) IN ('VENT MODE', 'VENTILATION MODE') AND meas_value NOT IN ('STANDBY', 'MONITOR') GROUP BY 1, 2, 3")
cte("fio2", """SELECT person_id, admit_datetime, period, ts, CASE WHEN v > 1 THEN v / 100 ELSE v END AS fio2 FROM (SELECT person_id, admit_datetime, period, observation_datetime AS ts, TRY_CAST(meas_value AS DOUBLE) AS v FROM sper
  WHERE upper(display_name) = 'FIO2 (%)' OR (upper(display_name) = 'FIO2 %' AND upper(source_display_name) = 'RN CLINICAL SCREENING')) q WHERE CASE WHEN v > 1 THEN v / 100 ELSE v END BETWEEN 0.21 AND 1.0""")
cte("pao2", "SELECT person_id, admit_datetime, period, measurement_datetime AS ts, value_as_number AS o FROM mper WHERE measurement_concept_id = 3027801 AND value_as_number IS NOT NULL")
cte("spo2", """SELECT person_id, admit_datetime, period, observation_datetime AS ts, TRY_CAST(meas_value AS DOUBLE) AS o FROM sper WHERE upper(display_name) = 'OXYGEN SATURATION' AND upper(source_display_name) = 'SPO2' AND TRY_CAST(meas_value AS DOUBLE) > 0 AND TRY_CAST(meas_value AS DOUBLE) <= 100""")


def ratio_sql(source: str, out: str) -> str:
    return f"""SELECT person_id, admit_datetime, period, min(o / fio2) AS {out} FROM (SELECT x.*, f.fio2, rank() OVER (PARTITION BY x.person_id, x.admit_datetime, x.period, x.ts ORDER BY f.ts DESC) AS rk, date_diff('minute', f.ts, x.ts) AS mins
      FROM {source} x JOIN fio2 f USING (person_id, admit_datetime, period) WHERE f.ts <= x.ts) q WHERE rk = 1 AND mins <= 1440 GROUP BY 1, 2, 3"""


cte("pf", ratio_sql("pao2", "min_pao2fio2_ratio"))
cte("sf", ratio_sql("spo2", "min_spo2fio2_ratio"))
cte("vaso", "SELECT p.person_id, p.admit_datetime, p.period, " + ", ".join(
    f"max(CASE WHEN a.ancestor_concept_id = {c} THEN date_diff('day', CAST(d.drug_exposure_start_datetime AS DATE), CAST(d.drug_exposure_end_datetime AS DATE)) + 1 END) AS max_{n}_days" for n, c in Z.VASOPRESSORS.items()) + """
  FROM per p JOIN drug_exposure d ON d.person_id = p.person_id AND CAST(d.drug_exposure_start_datetime AS DATE) <= p.dhi AND CAST(d.drug_exposure_end_datetime AS DATE) >= p.dlo
  JOIN concept_ancestor a ON a.descendant_concept_id = d.drug_concept_id WHERE a.ancestor_concept_id IN (21600284, 21600287, 21600303, 21600283) GROUP BY 1, 2, 3""")
cte("chart", "SELECT person_id, CAST(observation_datetime AS DATE) AS d, hour(min(observation_datetime)) AS h0, hour(max(observation_datetime)) AS h1 FROM sheet WHERE observation_datetime <> date_trunc('day', observation_datetime) GROUP BY 1, 2")
cte("uday", "SELECT person_id, admit_datetime, discharge_datetime, period, measurement_date AS d, sum(value_as_number) AS vol FROM mper WHERE measurement_concept_id = 45876241 AND value_as_number >= 0 GROUP BY 1, 2, 3, 4, 5")
cte("urine", """SELECT u.person_id, u.admit_datetime, u.period, min(v) AS min_urine_daily FROM (
  SELECT *, vol AS v FROM uday WHERE d <> CAST(admit_datetime AS DATE) AND d <> CAST(discharge_datetime AS DATE)
  UNION ALL SELECT u.*, vol * 24 / (24 - h0) FROM uday u LEFT JOIN chart c ON c.person_id = u.person_id AND c.d = CAST(admit_datetime AS DATE) WHERE u.d = CAST(admit_datetime AS DATE)
  UNION ALL SELECT u.*, vol * 24 / CASE WHEN h1 = 0 THEN 1 ELSE h1 END FROM uday u LEFT JOIN chart c ON c.person_id = u.person_id AND c.d = CAST(discharge_datetime AS DATE) WHERE u.d = CAST(discharge_datetime AS DATE)) u GROUP BY 1, 2, 3""")
cte("comp", """SELECT p.person_id, p.admit_datetime, p.period, age_in_months, admit_date, sepsis_index_date, * EXCLUDE (person_id, admit_datetime, period, age_in_months, admit_date, sepsis_index_date, lo, hi, dlo, dhi, discharge_date, discharge_datetime, min_bc, min_systemic_abx)
  FROM per p LEFT JOIN ext USING (person_id, admit_datetime, period) LEFT JOIN vent USING (person_id, admit_datetime, period) LEFT JOIN vaso USING (person_id, admit_datetime, period) LEFT JOIN pf USING (person_id, admit_datetime, period)
  LEFT JOIN sf USING (person_id, admit_datetime, period) LEFT JOIN urine USING (person_id, admit_datetime, period)""")
_crea = lambda c: f"CASE WHEN max_creatinine >= {c[0]} THEN 4 WHEN max_creatinine >= {c[1]} THEN 3 WHEN max_creatinine >= {c[2]} THEN 2 WHEN max_creatinine >= {c[3]} THEN 1 ELSE 0 END"
_vaso = lambda lim: f"CASE WHEN max_epinephrine_days IS NOT NULL OR max_norepinephrine_days IS NOT NULL THEN 3 WHEN max_dopamine_days IS NOT NULL OR max_dobutamine_days IS NOT NULL THEN 2 WHEN min_map < {lim} THEN 1 ELSE 0 END"
_banded = lambda f, i: "CASE " + " ".join((f"WHEN age_in_months >= {b[0]} THEN {f(b[i])}" if b[0] is not None else f"ELSE {f(b[i])}") for b in Z.AGE_BANDS) + " END"
_resp = lambda r, a, b, c, d: f"CASE WHEN count_vent_mode IS NOT NULL AND {r} < {a} THEN 4 WHEN count_vent_mode IS NOT NULL AND {r} < {b} THEN 3 WHEN {r} < {c} THEN 2 WHEN {r} < {d} THEN 1 ELSE 0 END"
P_, S_ = _resp("min_pao2fio2_ratio", 100, 200, 300, 400), _resp("min_spo2fio2_ratio", 148, 221, 264, 292)
cte("sofa", f"""SELECT *, CASE WHEN min_platelet < 20 THEN 4 WHEN min_platelet < 50 THEN 3 WHEN min_platelet < 100 THEN 2 WHEN min_platelet < 150 THEN 1 ELSE 0 END AS plat_sofa,
  CASE WHEN max_bilirubin >= 12 THEN 4 WHEN max_bilirubin >= 6 THEN 3 WHEN max_bilirubin >= 2 THEN 2 WHEN max_bilirubin >= 1.2 THEN 1 ELSE 0 END AS bili_sofa, {_banded(_crea, 1)} AS crea_sofa, {_banded(_vaso, 2)} AS cv_sofa,
  {P_} AS pao2_resp_sofa, {S_} AS spo2_resp_sofa, greatest({P_}, {S_}) AS resp_sofa,
  CASE WHEN min_gcs < 6 THEN 4 WHEN min_gcs < 10 THEN 3 WHEN min_gcs < 13 THEN 2 WHEN min_gcs < 15 THEN 1 ELSE 0 END AS gcs_sofa, CASE WHEN min_urine_daily < 200 THEN 4 WHEN min_urine_daily < 500 THEN 3 ELSE 0 END AS urine_sofa,
  CASE WHEN coalesce(max_epinephrine_days, max_norepinephrine_days, max_dopamine_days, max_dobutamine_days) IS NOT NULL THEN 1 ELSE 0 END AS vaso_shock, CASE WHEN min_map < 65 THEN 1 ELSE 0 END AS map_shock, CASE WHEN max_lactate > 2 THEN 1 ELSE 0 END AS lact_shock FROM comp""")
_sum = lambda a: "(" + " + ".join(f"{a}.{o}" for o in Z.ORGANS) + ")"
_shk = lambda a: "(" + " + ".join(f"{a}.{o}" for o in Z.SHOCKS) + ")"
_yes = lambda c: f"CASE WHEN {c} THEN 'Yes' ELSE 'No' END"
cte("sdiff", "SELECT c.person_id, c.admit_datetime, c.admit_date, c.sepsis_index_date, " + ", ".join(f"c.{o}, p.{o} AS {o}_prior" for o in [*Z.ORGANS, *Z.SHOCKS]) + f""",
  {_sum('c')} AS sofa_score, {_sum('p')} AS sofa_score_prior, {_shk('c')} AS shock_score, {_shk('p')} AS shock_score_prior, {_sum('c')} - {_sum('p')} AS sofa_score_diff,
  {_yes(_sum('c') + ' >= 2')} AS sofa_current, {_yes(_sum('p') + ' >= 2')} AS sofa_prior, {_yes(_sum('c') + ' - ' + _sum('p') + ' >= 2')} AS sofa_diff, {_yes(_shk('c') + ' = 2')} AS shock, {_yes(_shk('p') + ' = 2')} AS shock_prior,
  {_yes(_shk('c') + ' - ' + _shk('p') + ' = 2')} AS shock_diff, """ + ", ".join(f"CAST(c.{o} >= 2 AS INT) AS {o}_gt2, CAST(p.{o} >= 2 AS INT) AS {o}_prior_gt2, CAST(c.{o} - p.{o} >= 2 AS INT) AS {o}_gt2_diff" for o in Z.ORGANS)
  + ", " + ", ".join(f"CAST(c.{s} - p.{s} = 1 AS INT) AS {s}_diff" for s in Z.SHOCKS) + " FROM sofa c JOIN sofa p ON p.person_id = c.person_id AND p.admit_datetime = c.admit_datetime AND p.period = 'prior' WHERE c.period = 'current'")


def sheets(t):
    return t.stored("flowsheets", lambda t: Z.flowsheets(t.observation, t.concept))


def infection(t):
    """Suspected infections; read by every component, so written once."""
    return t.stored("infection", lambda t: Z.suspected_infection(adm(t), t.measurement, t.drug_exposure, t.concept_ancestor, t.person))


def values(t):
    return Z.component_values(t.measurement, t.concept, t.concept_ancestor)


@query("sep_01_flowsheets", "SELECT s.*, v.visit_occurrence_id FROM sheet s LEFT JOIN visit_occurrence v ON v.person_id = s.person_id AND s.observation_datetime BETWEEN v.visit_start_datetime AND v.visit_end_datetime")
def _(t):
    return Z.flowsheets(t.observation, t.concept, t.visit_occurrence)


@query("sep_02_suspected_infection", "SELECT * FROM susp")
def _(t):
    return Z.suspected_infection(adm(t), t.measurement, t.drug_exposure, t.concept_ancestor, t.person)


@query("sep_03_periods", "SELECT person_id, admit_datetime, discharge_datetime, period, lo, hi FROM per")
def _(t):
    return Z.periods(infection(t))


@query("sep_04_component_extremes", "SELECT * FROM ext WHERE coalesce(min_platelet, max_creatinine, min_gcs, max_bilirubin, max_lactate, min_map) IS NOT NULL")
def _(t):
    return Z.component_extremes(infection(t), values(t))


@query("sep_05_ventilation", "SELECT * FROM vent")
def _(t):
    return Z.ventilation(infection(t), sheets(t))


@query("sep_06_pao2_fio2", "SELECT * FROM pf")
def _(t):
    return Z.oxygen_ratio(infection(t), values(t).where("component = 'pao2'"), Z.inspired_oxygen(sheets(t)), "min_pao2fio2_ratio")


@query("sep_07_spo2_fio2", "SELECT * FROM sf")
def _(t):
    return Z.oxygen_ratio(infection(t), Z.oxygen_saturation(sheets(t)), Z.inspired_oxygen(sheets(t)), "min_spo2fio2_ratio")


@query("sep_08_vasopressor_days", "SELECT * FROM vaso")
def _(t):
    return Z.vasopressor_days(infection(t), t.drug_exposure, t.concept_ancestor)


@query("sep_09_urine_output", "SELECT * FROM urine")
def _(t):
    return Z.urine_output(infection(t), values(t), sheets(t))


@query("sep_10_scores", "SELECT * FROM sofa")
def _(t):
    return Z.scores(Z.components(t, infection(t), sheets(t)))


@query("sep_11_score_differences", "SELECT * FROM sdiff")
def _(t):
    return Z.differences(Z.scores(Z.components(t, infection(t), sheets(t))))


LABEL = "SELECT a.*, sepsis_index_date, CASE WHEN sofa_diff = 'Yes' THEN 1 ELSE 0 END AS sepsis FROM adm a LEFT JOIN sdiff d ON d.person_id = a.person_id AND d.admit_datetime = a.admit_date"


@query("sep_12_sepsis_label", LABEL)
def _(t):
    scored = t.stored("sofa", lambda t: Z.scores(Z.components(t, infection(t), sheets(t))))
    return Z.sepsis_label(adm(t), Z.differences(scored))


@query("sep_13_end_to_end", LABEL)
def _(t):
    from ..functions.segments import durable

    admissions = durable(build_admissions(t))
    found = durable(Z.suspected_infection(admissions, t.measurement, t.drug_exposure, t.concept_ancestor, t.person))
    charted = durable(Z.flowsheets(t.observation, t.concept))
    scored = durable(Z.scores(Z.components(t, found, charted)))
    return Z.sepsis_label(admissions, Z.differences(scored))
