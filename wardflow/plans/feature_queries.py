"""Queries of the windowed feature operators."""

from pyspark.sql import functions as F

from ..operators import cohorts as C, features as X
from .cohort_queries import ADM_KEY, HASH60, adm, adm_age
from .registry import cte, query

DAY_BINS = [-365, -180, -90, -30, 0]
HOUR_BINS = [-48, -24, 0, 24, 72]
cte("samp", f"""SELECT person_id, admit_date, age_in_years, {HASH60.format(k='k')} AS row_id
  FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY md5(k), admit_date) AS rn FROM adm_key) q WHERE rn = 1""")
cte("std", "SELECT concept_id FROM concept WHERE standard_concept = 'S'")
cte("day_bins", "SELECT * FROM (VALUES (-36500, -1), (-365, -181), (-180, -91), (-90, -31), (-30, -1)) v(l, r)")
cte("hour_bins", "SELECT * FROM (VALUES (-48, -24), (-24, 0), (0, 24), (24, 72)) v(l, r)")
HEAD = "row_id, person_id, index_date, concept_id, analysis_id, time_bin, concept_id || '_' || time_bin || '_' || analysis_id AS feature_id, concept_count"


def cohort(t):
    """One admission per person as (row_id, person_id, index_date)."""
    picked = C.one_per_person(adm_age(t), ADM_KEY)
    return picked.select(F.col("prediction_id").alias("row_id"), "person_id", F.col("admit_date").alias("index_date"), "age_in_years")


def day_sql(source: str, analysis: str, bins: str = "day_bins") -> str:
    """``source`` yields person_id, concept_id (text) and a day ``dt``."""
    return f"""SELECT {HEAD} FROM (SELECT row_id, s.person_id, CAST(admit_date AS DATE) AS index_date, concept_id, '{analysis}' AS analysis_id,
      'bin_' || l || '_' || r AS time_bin, count(*) AS concept_count FROM samp s JOIN ({source}) e ON e.person_id = s.person_id
      JOIN {bins} ON e.dt BETWEEN CAST(admit_date AS DATE) + CAST(l AS INT) AND CAST(admit_date AS DATE) + CAST(r AS INT) GROUP BY ALL) q"""


def hour_sql(source: str, analysis: str) -> str:
    return f"""SELECT {HEAD} FROM (SELECT row_id, s.person_id, admit_date AS index_date, concept_id, '{analysis}' AS analysis_id,
      'bin_' || l || '_' || r AS time_bin, count(*) AS concept_count FROM samp s JOIN ({source}) e ON e.person_id = s.person_id
      JOIN hour_bins ON e.ts BETWEEN admit_date + l * INTERVAL '1' HOUR AND admit_date + r * INTERVAL '1' HOUR
      WHERE e.ts <> CAST(e.dt AS TIMESTAMP) GROUP BY ALL) q"""


def source_sql(a: str) -> str:
    s = X.SOURCES[a]
    return f"SELECT person_id, CAST({s.concept} AS VARCHAR) AS concept_id, {s.date} AS dt, {s.datetime} AS ts FROM {s.table} WHERE {s.concept} IN (SELECT concept_id FROM std)"


def delayed_sql(a: str) -> str:
    s = X.SOURCES[a]
    return f"SELECT x.person_id, CAST({s.concept} AS VARCHAR) AS concept_id, v.visit_end_date AS dt FROM {s.table} x JOIN visit_occurrence v USING (visit_occurrence_id) WHERE {s.concept} IN (SELECT concept_id FROM std)"


def note_sql(delayed=False) -> str:
    day = "v.visit_end_date" if delayed else "n.note_date"
    return f"""SELECT n.person_id, CAST(note_nlp_concept_id AS VARCHAR) || '_' || term_exists AS concept_id, {day} AS dt, n.note_datetime AS ts FROM note n JOIN note_nlp USING (note_id)
      {'JOIN visit_occurrence v USING (visit_occurrence_id)' if delayed else ''} WHERE note_nlp_concept_id IN (SELECT concept_id FROM std)"""


RANGE_SQL = """SELECT person_id, CAST(measurement_concept_id AS VARCHAR) || '_' || CASE WHEN value_as_number > range_high THEN 'abnormal_high' WHEN value_as_number < range_low THEN 'abnormal_low' ELSE 'normal' END AS concept_id,
  measurement_date AS dt, measurement_datetime AS ts FROM measurement WHERE value_as_number IS NOT NULL AND measurement_concept_id IN (SELECT concept_id FROM std)"""


def featurizer(t):
    return X.Featurizer(t, cohort(t), DAY_BINS, HOUR_BINS)


def one(t, analysis):
    return featurizer(t).featurize([analysis])[analysis]


@query("ftq_00_time_bins", "SELECT l AS bin_left, r AS bin_right, count(*) AS n_rows FROM samp, day_bins GROUP BY l, r")
def _(t):
    rows = F.array(*[F.struct(F.lit(a).alias("bin_left"), F.lit(b).alias("bin_right")) for a, b in X.time_bins(DAY_BINS)])
    return cohort(t).select(F.inline(rows)).groupBy("bin_left", "bin_right").agg(F.count(F.lit(1)).alias("n_rows"))


@query("ftq_01_concept_counts", day_sql(source_sql("drug_exposure"), "drug_exposure"))
def _(t):
    return one(t, "drug_exposure")


@query("ftq_02_delayed_counts", day_sql(delayed_sql("condition_occurrence"), "condition_occurrence_delayed"))
def _(t):
    return one(t, "condition_occurrence_delayed")


@query("ftq_03_hourly_counts", hour_sql(source_sql("measurement"), "measurement_dt"))
def _(t):
    return one(t, "measurement_dt")


def _all(names):
    def run(t):
        found = featurizer(t).featurize(names)
        return X.union_all(list(found.values()))
    return run


DAILY = list(X.SOURCES)
query("ftq_04_daily_counts", " UNION ALL ".join(day_sql(source_sql(a), a) for a in DAILY))(_all(DAILY))
query("ftq_05_delayed_all", " UNION ALL ".join(day_sql(delayed_sql(a), f"{a}_delayed") for a in X.DELAYED))(_all([f"{a}_delayed" for a in X.DELAYED]))
query("ftq_06_hourly_all", " UNION ALL ".join(hour_sql(source_sql(a), f"{a}_dt") for a in DAILY))(_all([f"{a}_dt" for a in DAILY]))


@query("ftq_07_note_concepts", day_sql(note_sql(), "note_nlp") + " UNION ALL " + day_sql(note_sql(True), "note_nlp_delayed"))
def _(t):
    return _all(["note_nlp", "note_nlp_delayed"])(t)


@query("ftq_07_note_concepts_hourly", hour_sql(note_sql(), "note_nlp_dt"))
def _(t):
    return one(t, "note_nlp_dt")


@query("ftq_08_measurement_range", day_sql(RANGE_SQL, "measurement_range"))
def _(t):
    return one(t, "measurement_range")


@query("ftq_08_measurement_range_hourly", hour_sql(RANGE_SQL, "measurement_range_dt"))
def _(t):
    return one(t, "measurement_range_dt")


QUANT = "quantile_disc(v, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])"


def bin_sql(analysis: str, hourly: bool) -> str:
    when = ("m.measurement_datetime BETWEEN admit_date + l * INTERVAL '1' HOUR AND admit_date + r * INTERVAL '1' HOUR AND measurement_datetime <> CAST(measurement_date AS TIMESTAMP)"
            if hourly else "m.measurement_date BETWEEN CAST(admit_date AS DATE) + CAST(l AS INT) AND CAST(admit_date AS DATE) + CAST(r AS INT)")
    index = "admit_date" if hourly else "CAST(admit_date AS DATE)"
    return f"""WITH h AS (SELECT row_id, s.person_id, {index} AS index_date, m.measurement_concept_id AS mid, value_as_number AS v, 'bin_' || l || '_' || r AS time_bin
      FROM samp s JOIN measurement m ON m.person_id = s.person_id JOIN {'hour_bins' if hourly else 'day_bins'} ON {when}
      WHERE value_as_number IS NOT NULL AND measurement_concept_id IN (SELECT concept_id FROM std)),
     e AS (SELECT mid, time_bin, i, q[i] AS lo, q[i + 1] AS hi FROM (SELECT mid, time_bin, {QUANT} AS q FROM h GROUP BY 1, 2) x, (VALUES (1), (2), (3), (4), (5)) n(i)),
     b AS (SELECT h.row_id, h.person_id, h.index_date, h.time_bin, h.mid || '_bin_' || i || '_' || CAST(round(lo, 4) AS VARCHAR) || '_' || CAST(round(hi, 4) AS VARCHAR) AS concept_id, '{analysis}' AS analysis_id
      FROM h JOIN e ON h.mid = e.mid AND h.time_bin = e.time_bin AND v BETWEEN lo AND hi)
     SELECT {HEAD} FROM (SELECT *, count(*) AS concept_count FROM b GROUP BY ALL) q"""


@query("ftq_09_value_bins", bin_sql("measurement_bin", False))
def _(t):
    return one(t, "measurement_bin")


@query("ftq_09_value_bins_hourly", bin_sql("measurement_bin_dt", True))
def _(t):
    return one(t, "measurement_bin_dt")


def static_sql(column: str, analysis: str) -> str:
    return f"""SELECT row_id, person_id, CAST(admit_date AS DATE) AS index_date, CAST({column} AS VARCHAR) AS concept_id, '{analysis}' AS analysis_id, 'static' AS time_bin,
      CAST({column} AS VARCHAR) || '_{analysis}' AS feature_id, 1 AS concept_count FROM samp JOIN person USING (person_id)"""


STATIC_SQL = " UNION ALL ".join(static_sql(f"{p}_concept_id", p) for p in ("gender", "race", "ethnicity"))
AGE_SQL = static_sql("('age_group_' || CAST(CAST(floor((year(admit_date) - year(birth_datetime)) / 5) AS BIGINT) AS VARCHAR))", "age_group")
query("ftq_10_static", STATIC_SQL)(_all(["gender", "race", "ethnicity"]))
query("ftq_11_age_group", AGE_SQL)(_all(["age_group"]))

CHOSEN = ["drug_exposure", "measurement_range", "gender", "age_group"]
cte("feat", " UNION ALL ".join([day_sql(source_sql("drug_exposure"), "drug_exposure"), day_sql(RANGE_SQL, "measurement_range"), static_sql("gender_concept_id", "gender"), AGE_SQL]))


def chosen(t):
    return list(featurizer(t).featurize(CHOSEN).values())


@query("ftq_12_subset_of_analyses", f"SELECT {HEAD} FROM feat WHERE analysis_id <> 'gender'".replace("concept_id || '_' || time_bin || '_' || analysis_id AS feature_id", "feature_id"))
def _(t):
    return X.union_all(list(featurizer(t).featurize(CHOSEN, exclude=("gender",)).values()))


@query("ftq_13_merged_binary", "SELECT row_id, person_id, feature_id, CAST(concept_count > 0 AS BIGINT) AS concept_count FROM feat")
def _(t):
    return X.merge_features(chosen(t), binary=True)


cte("vocab", "SELECT feature_id, row_number() OVER (ORDER BY feature_id) - 1 AS col_id FROM (SELECT DISTINCT feature_id FROM feat) q")
cte("rowmap", "SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS features_row_id FROM (SELECT DISTINCT row_id FROM feat) q")
cte("trip", "SELECT features_row_id, col_id, sum(concept_count) AS value FROM feat JOIN vocab USING (feature_id) JOIN rowmap USING (row_id) GROUP BY 1, 2")


@query("ftq_14_vocabulary", "SELECT * FROM vocab")
def _(t):
    return X.vocabulary(X.merge_features(chosen(t)))


@query("ftq_15_sparse_matrix", "SELECT * FROM trip")
def _(t):
    return X.sparse_matrix(X.merge_features(chosen(t)))[0]


def vis_sql(concept: str, analysis: str) -> str:
    return day_sql(f"SELECT person_id, {concept} AS concept_id, visit_start_date AS dt FROM visit_occurrence", analysis, "(VALUES (-365, -1), (-180, -1), (-30, -1)) rb(l, r)")


@query("ftq_16_preset_visit_counts", vis_sql("'visit'", "visit_count") + " UNION ALL " + vis_sql("CAST(visit_concept_id AS VARCHAR)", "visit_concept_count"))
def _(t):
    bins = [X.PRESET_WINDOWS[w] for w in ("long", "medium", "short")]
    people = cohort(t)
    return X.visit_counts(people, t.visit_occurrence, bins, False).unionByName(X.visit_counts(people, t.visit_occurrence, bins, True))


@query("ftq_16_preset_drug_group_era", day_sql("SELECT person_id, CAST(ancestor_concept_id AS VARCHAR) AS concept_id, drug_exposure_start_date AS dt FROM drug_exposure JOIN (SELECT DISTINCT * FROM concept_ancestor) a ON drug_concept_id = descendant_concept_id WHERE drug_concept_id IN (SELECT concept_id FROM std)",
       "drug_group_era", "(VALUES (-36500, -1), (-365, -1), (-180, -1), (-30, -1)) rb(l, r)"))
def _(t):
    return X.preset_features(t, cohort(t), "drug_group_era")


# ---- all presets -----------------------------------------------------------------

ERAS = {"condition_group_era": ("condition_occurrence", "condition_concept_id", "condition_start_date"), "drug_group_era": ("drug_exposure", "drug_concept_id", "drug_exposure_start_date")}


def preset_sql(name: str) -> str:
    parts = []
    for analysis, windows in X.PRESETS[name].items():
        bins = "(VALUES " + ", ".join(f"({X.PRESET_WINDOWS[w][0]}, {X.PRESET_WINDOWS[w][1]})" for w in windows) + ") rb(l, r)"
        if analysis == "age_group":
            parts += [AGE_SQL, static_sql("year(admit_date)", "index_year"), static_sql("month(admit_date)", "index_month")]
        elif not windows:
            parts.append(static_sql(f"{analysis}_concept_id", analysis))
        elif analysis == "visit_count":
            parts.append(vis_sql("'visit'", analysis))
        elif analysis == "visit_concept_count":
            parts.append(vis_sql("CAST(visit_concept_id AS VARCHAR)", analysis))
        elif analysis == "measurement_range":
            parts.append(day_sql(RANGE_SQL, analysis, bins))
        elif analysis in ERAS:
            table, concept, day = ERAS[analysis]
            parts.append(day_sql(f"SELECT person_id, CAST(ancestor_concept_id AS VARCHAR) AS concept_id, {day} AS dt FROM {table} JOIN (SELECT DISTINCT * FROM concept_ancestor) a ON {concept} = descendant_concept_id WHERE {concept} IN (SELECT concept_id FROM std)", analysis, bins))
        else:
            parts.append(day_sql(source_sql(analysis), analysis, bins))
    return " UNION ALL ".join(parts)


for _preset in X.PRESETS:
    if _preset != "drug_group_era":  # above
        query(f"ftq_16_preset_{_preset}", preset_sql(_preset))(lambda t, p=_preset: X.preset_features(t, cohort(t), p))


cte("row_groups", "SELECT features_row_id, CASE WHEN age_in_years >= 18 THEN 1 ELSE 0 END AS adult FROM rowmap JOIN samp USING (row_id)")
cte("usage", """SELECT v.feature_id, v.col_id, CASE WHEN a = 1 AND c = 1 THEN 'both' WHEN a = 1 THEN 'adult_only' WHEN c = 1 THEN 'pediatric_only' ELSE 'neither' END AS usage
  FROM vocab v LEFT JOIN (SELECT col_id, max(adult) AS a, max(1 - adult) AS c FROM trip JOIN row_groups USING (features_row_id) GROUP BY 1) q USING (col_id)""")


def matrix(t):
    people = cohort(t)
    features = X.merge_features(list(X.Featurizer(t, people, DAY_BINS).featurize(CHOSEN).values()))
    triples, rows, vocab = X.sparse_matrix(features)
    groups = rows.join(people, "row_id").select("features_row_id", (F.col("age_in_years") >= 18).cast("int").alias("adult"))
    return triples, groups, vocab


@query("ftq_17_usage_by_population", "SELECT * FROM usage")
def _(t):
    triples, groups, vocab = matrix(t)
    return X.usage_by_population(triples, groups, vocab)


@query("ftq_18_pruned_columns", "SELECT features_row_id, new_id AS col_id, value FROM trip JOIN (SELECT col_id, row_number() OVER (ORDER BY col_id) - 1 AS new_id FROM usage WHERE usage = 'both') k USING (col_id)")
def _(t):
    triples, groups, vocab = matrix(t)
    keep = X.usage_by_population(triples, groups, vocab).where(F.col("usage") == "both")
    return X.renumber(triples, keep)[0]


@query("ftq_19_mapped_to_population", """SELECT features_row_id, new_id AS col_id, value FROM trip JOIN (SELECT col_id, row_number() OVER (ORDER BY col_id) - 1 AS new_id
  FROM (SELECT DISTINCT col_id FROM trip JOIN row_groups USING (features_row_id) WHERE adult = 0) z) k USING (col_id)""")
def _(t):
    triples, groups, _vocab = matrix(t)
    children = triples.join(groups.where(F.col("adult") == 0), "features_row_id", "left_semi")
    return X.renumber(triples, children)[0]
