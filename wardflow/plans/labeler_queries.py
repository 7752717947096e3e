"""Queries of the patient-day labelers."""

from pyspark.sql import functions as F

from ..functions.segments import bucket_count, bucketed, buckets_of, durable
from ..operators import labelers as B, timeline as T
from .registry import cte, query

# Code sets over the part hierarchy, by p_partkey % 40.
SETS = {"set_a": (3, 7), "set_b": (11, 19), "set_c": (23, 29, 31)}
for _n, _m in SETS.items():
    cte(_n, f"SELECT p_brand || '/' || CAST(p_partkey AS VARCHAR) AS code FROM part WHERE p_partkey % 40 IN {_m}")


def code_set(t, name):
    return t.part.where((F.col("p_partkey") % 40).isin(*SETS[name])).select(F.concat_ws("/", "p_brand", F.col("p_partkey").cast("string")).alias("code"))


def ed(t):
    """Timeline events and day table; both are stored tables, as a timeline is built once and read often."""
    events = t.stored("timeline", T.build, written=True)
    return events, t.stored("timeline_days", lambda t: t.spark.table(bucketed(T.day_table(events), "person_id", bucket_count(t.visit_occurrence))), written=True)


def fixed_sql(event_days: str, horizon: int, extra: str = "") -> str:
    """Label by a correlated look-ahead, unlike the window of the Spark form."""
    return f"""SELECT person_id, day_index, label FROM (SELECT d.person_id, d.day_index, CASE WHEN EXISTS (SELECT 1 FROM ({event_days}) e WHERE e.person_id = d.person_id AND e.age > d.age AND e.age <= d.age + {horizon}) THEN 1
      WHEN last_age - age >= {horizon} THEN 0 END AS label FROM tld d) q WHERE label IS NOT NULL {extra}"""


def days_of(name: str) -> str:
    return f"SELECT DISTINCT person_id, age FROM tl WHERE code IN (SELECT code FROM {name})"


cte("lab_a", fixed_sql(days_of("set_a"), 200))


def lab_a(t):
    events, days = ed(t)
    build = lambda t: t.spark.table(bucketed(B.code_label(days, events, code_set(t, "set_a"), 200), "person_id", buckets_of(days)))
    return days, t.stored("labels_a", build, written=True)


@query("tlb_01_fixed_horizon", fixed_sql(days_of("set_b"), 365))
def _(t):
    events, days = ed(t)
    return B.fixed_horizon(days, B.code_days(events, code_set(t, "set_b")), 365)


@query("tlb_02_infinite_horizon", f"""SELECT d.person_id, day_index, CASE WHEN f IS NULL THEN 0 ELSE 1 END AS label FROM tld d LEFT JOIN (SELECT person_id, min(age) AS f FROM ({days_of('set_b')}) e GROUP BY 1) x USING (person_id) WHERE f IS NULL OR age < f""")
def _(t):
    events, days = ed(t)
    return B.infinite_horizon(days, B.code_days(events, code_set(t, "set_b")))


LE = "||".join(f"substr(h, {i}, 2)" for i in (15, 13, 11, 9, 7, 5, 3, 1))


@query("tlb_03_one_random_label", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY day_index) - 1 AS k, count(*) OVER (PARTITION BY person_id) AS n FROM lab_a),
  p AS (SELECT DISTINCT person_id, n, sha256(unhex('2A00000000000000' || {LE})) AS dg FROM (SELECT person_id, n, lpad(to_hex(person_id), 16, '0') AS h FROM r) z),
  m AS (SELECT person_id, list_reduce(list_transform(range(31, -1, -1), lambda i: CAST('0x' || substr(dg, CAST(i * 2 + 1 AS BIGINT), 2) AS BIGINT)), lambda a, b: ((a % n) * 256 + b)) % n AS pick FROM p)
  SELECT person_id, day_index, label FROM r JOIN m USING (person_id) WHERE k = pick""")
def _(t):
    return durable(B.one_random_label(lab_a(t)[1], 42), co_located=True)


@query("tlb_04_year_of_history", "SELECT l.* FROM lab_a l JOIN tld d USING (person_id, day_index) JOIN (SELECT person_id, age AS a2 FROM tld WHERE day_index = 1) s USING (person_id) WHERE d.age >= a2 + 365")
def _(t):
    days, labels = lab_a(t)
    return B.year_of_history(labels, days)


@query("tlb_05_restricted", "SELECT l.* FROM lab_a l JOIN tld d USING (person_id, day_index) WHERE d.day >= DATE '1997-01-01' AND d.age >= 6574.5 AND person_id IN (SELECT person_id FROM death)")
def _(t):
    days, labels = lab_a(t)
    return B.restrict(labels, days, "1997-01-01", t.death, B.ADULT_AGE_DAYS)


@query("tlb_06_code_label", "SELECT * FROM lab_a")
def _(t):
    return lab_a(t)[1]


@query("tlb_07_forced_prevalence", """WITH n AS (SELECT sum(label) AS p, sum(1 - label) AS n FROM lab_a), z AS (SELECT *, row_number() OVER (ORDER BY md5('5|' || CAST(person_id AS VARCHAR) || '|' || CAST(day_index AS VARCHAR))) - 1 AS rk FROM lab_a WHERE label = 0)
  SELECT * FROM lab_a WHERE label = 1 UNION ALL SELECT person_id, day_index, label FROM z, n WHERE p / (p + n) >= 0.4 OR rk >= floor(n - p * (1 - 0.4) / 0.4)""")
def _(t):
    return B.force_prevalence(lab_a(t)[1], 0.4, 5)


@query("tlb_08_label_arrays", "SELECT person_id, list(day_index ORDER BY day_index) AS day_indices, list(label ORDER BY day_index) AS labels FROM lab_a GROUP BY 1")
def _(t):
    days, labels = lab_a(t)
    pair = F.sort_array(F.collect_list(F.struct("day_index", "label")))
    return B.check_day_indices(labels, days).groupBy("person_id").agg(pair.alias("p")).select(
        "person_id", F.col("p.day_index").alias("day_indices"), F.col("p.label").alias("labels"))


@query("tlb_09_typed_labels", """SELECT kind, count(*) AS n, sum(CASE WHEN kind = 'binary' AND label > 0 THEN 1 ELSE 0 END) AS n_positive, CAST(sum(CASE WHEN kind = 'numeric' THEN label END) AS DOUBLE) AS total,
  count(*) AS n_single FROM (SELECT label, (['binary', 'numeric', 'survival', 'categorical'])[1 + day_index % 4] AS kind FROM lab_a) q GROUP BY 1""")
def _(t):
    kind = F.element_at(F.array(*[F.lit(k) for k in ("binary", "numeric", "survival", "categorical")]), (F.col("day_index") % 4 + 1).cast("int"))
    typed = lab_a(t)[1].select(kind.alias("kind"), B.typed_label(kind, F.col("label"), F.col("label") == 1).alias("l"))
    return typed.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col("l.is_positive").cast("int"), F.lit(0))).alias("n_positive"),
        F.sum("l.numeric_value").alias("total"), F.sum((B.set_members(F.col("l")) == 1).cast("int")).alias("n_single"))


cte("tadm", """SELECT person_id, min(age) AS start_age, max(e) AS end_age FROM (SELECT *, sum(f) OVER (PARTITION BY person_id ORDER BY age, e) AS isl FROM (
   SELECT *, CASE WHEN age <= max(e) OVER (PARTITION BY person_id ORDER BY age, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f
   FROM (SELECT person_id, age, age + CAST(floor(max(numeric_value)) AS INT) AS e FROM tl WHERE code = 'Visit/IP' GROUP BY 1, 2) a) b) c GROUP BY person_id, isl""")
cte("tadm_d", "SELECT a.*, d.day_index FROM tadm a JOIN tld d ON d.person_id = a.person_id AND d.age = a.start_age")


@query("tlb_10_admissions", "SELECT * FROM tadm")
def _(t):
    return B.admissions(ed(t)[0])


@query("tlb_11_value_above", "SELECT tl.person_id, day_index - 1 AS day_index, CAST(numeric_value > 20 AS INT) AS label FROM tl JOIN tld USING (person_id, age) WHERE code = 'LOINC/2823-3' AND numeric_value IS NOT NULL AND day_index > 0")
def _(t):
    events, days = ed(t)
    return B.value_above(events, days, "LOINC/2823-3", 20)


@query("tlb_12_mortality", fixed_sql("SELECT person_id, age FROM tl WHERE code LIKE 'Death Type/%'", 180))
def _(t):
    events, days = ed(t)
    return B.mortality(days, events)


@query("tlb_13_male_at_admission", "SELECT a.person_id, a.day_index, CASE WHEN EXISTS (SELECT 1 FROM tl x JOIN tld y USING (person_id, age) WHERE x.person_id = a.person_id AND y.day_index = 0 AND x.code = 'Gender/M') THEN 1 ELSE 0 END AS label FROM tadm_d a")
def _(t):
    events, days = ed(t)
    return B.male_at_admission(days, events)


@query("tlb_14_overdose", fixed_sql(days_of("set_b"), 90, "AND (person_id, day_index) IN (SELECT (person_id, day_index) FROM tld JOIN tl USING (person_id, age) WHERE code IN (SELECT code FROM set_a))"))
def _(t):
    events, days = ed(t)
    return durable(B.overdose(days, events, code_set(t, "set_b"), code_set(t, "set_a")), co_located=True)


@query("tlb_15_ever", f"""SELECT d.person_id, day_index, CASE WHEN f IS NULL THEN 0 ELSE 1 END AS label FROM tld d LEFT JOIN (SELECT person_id, min(age) AS f FROM ({days_of('set_c')}) e GROUP BY 1) x USING (person_id) WHERE f IS NULL OR age < f""")
def _(t):
    events, days = ed(t)
    return B.ever(days, events, code_set(t, "set_c"))


@query("tlb_16_inpatient_mortality", """SELECT a.person_id, day_index - 1 AS day_index, CASE WHEN dt <= end_age THEN 1 ELSE 0 END AS label FROM tadm_d a LEFT JOIN (SELECT person_id, min(age) AS dt FROM tl WHERE code LIKE 'Death Type/%' GROUP BY 1) x USING (person_id)
  WHERE day_index > 0 AND (dt IS NULL OR dt >= start_age)""")
def _(t):
    events, days = ed(t)
    return B.inpatient_mortality(days, events)


@query("tlb_17_readmission", """WITH RECURSIVE f AS (SELECT a.person_id, row_number() OVER (PARTITION BY a.person_id ORDER BY start_age) AS k, (SELECT min(day_index) FROM tld d WHERE d.person_id = a.person_id AND d.age >= a.end_age) AS f FROM tadm a),
  p AS (SELECT person_id, k, f AS used FROM f WHERE k = 1 AND f IS NOT NULL UNION ALL SELECT f.person_id, f.k, greatest(f.f, p.used + 1) FROM p JOIN f ON f.person_id = p.person_id AND f.k = p.k + 1 WHERE f.f IS NOT NULL)
  """ + fixed_sql("SELECT person_id, start_age AS age FROM tadm", 30, "AND (person_id, day_index) IN (SELECT (person_id, used) FROM p)"))
def _(t):
    events, days = ed(t)
    return B.readmission(days, events)


@query("tlb_18_long_admission", "SELECT person_id, day_index - 1 AS day_index, CAST(end_age - start_age >= 7 AS INT) AS label FROM tadm_d WHERE day_index > 0")
def _(t):
    events, days = ed(t)
    return B.long_admission(days, events)


cte("loinc_tests", "SELECT DISTINCT code FROM tl WHERE code IN ('LOINC/2345-7', 'LOINC/2703-7')")


def tests(t):
    return t.concept.where(F.col("concept_code").isin("2345-7", "2703-7") & (F.col("vocabulary_id") == "LOINC")).select(F.concat_ws("/", "vocabulary_id", "concept_code").alias("code"))


@query("tlb_19_first_test_result", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY age, code, text_value) AS rn FROM tl JOIN tld USING (person_id, age) WHERE text_value IN ('POS R', 'POS A', 'POS N') AND day_index > 0 AND code IN (SELECT code FROM loinc_tests))
  SELECT person_id, day_index - 1 AS day_index, CAST(text_value = 'POS R' AS INT) AS label FROM r WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM tl x WHERE x.person_id = r.person_id AND x.age < r.age AND x.code IN (SELECT code FROM set_a))""")
def _(t):
    events, days = ed(t)
    return B.first_test_result(days, events, tests(t), code_set(t, "set_a"), ["POS R"], ["POS A", "POS N"])


cte("hb_tests", "SELECT DISTINCT code FROM tl WHERE code IN ('LOINC/2823-3', 'LOINC/2160-0', 'LOINC/718-7', 'LOINC/26507-4')")


@query("tlb_20_high_value_sequence", """WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY age, code, value) AS rn FROM (
   SELECT person_id, age, day_index, code, numeric_value AS value FROM tl JOIN tld USING (person_id, age) WHERE numeric_value IS NOT NULL AND code IN (SELECT code FROM hb_tests) AND day_index > 0
   UNION ALL SELECT DISTINCT person_id, age, day_index, '', NULL FROM tl JOIN tld USING (person_id, age) WHERE code IN (SELECT code FROM set_c) AND day_index > 0) u),
  w AS (SELECT person_id, 0 AS rn, CAST(NULL AS BIGINT) AS lst, FALSE AS neg, CAST(NULL AS BIGINT) AS stp, CAST(NULL AS BIGINT) AS d, CAST(NULL AS INT) AS label FROM (SELECT DISTINCT person_id FROM s) z
   UNION ALL SELECT s.person_id, CAST(s.rn AS INT), CASE WHEN fire THEN age ELSE lst END, neg OR coalesce(live AND value <= 30, FALSE), CASE WHEN stp IS NULL AND (value IS NULL OR value > 30) THEN age ELSE stp END,
     CASE WHEN fire THEN day_index - 1 END, CASE WHEN fire THEN CAST(value > 30 AS INT) END
    FROM (SELECT s.*, w.lst, w.neg, w.stp, (w.stp IS NULL OR s.age <= w.stp) AS live, coalesce((w.stp IS NULL OR s.age <= w.stp) AND s.value IS NOT NULL AND w.neg AND (w.lst IS NULL OR s.age - w.lst > 180), FALSE) AS fire FROM w JOIN s ON s.person_id = w.person_id AND s.rn = w.rn + 1) s)
  SELECT person_id, d AS day_index, label FROM w WHERE d IS NOT NULL""")
def _(t):
    events, days = ed(t)
    codes = t.concept.where(F.col("concept_code").isin("2823-3", "2160-0", "718-7", "26507-4") & (F.col("vocabulary_id") == "LOINC"))
    return B.high_hba1c(days, events, codes.select(F.concat_ws("/", "vocabulary_id", "concept_code").alias("code")), code_set(t, "set_c"), limit=30)


@query("tlb_21_treatment_choice", """WITH b AS (SELECT person_id, age, code FROM tl WHERE numeric_value IS NULL AND text_value IS NULL),
  d AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY age, code) AS rn FROM b WHERE code IN (SELECT code FROM set_a) OR code IN (SELECT code FROM set_b)),
  x AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY age, code) AS rn FROM b WHERE code IN (SELECT code FROM set_c))
  SELECT d.person_id, day_index - 1 AS day_index, CASE WHEN d.code IN (SELECT code FROM set_a) THEN 1 ELSE 0 END AS label FROM d JOIN x USING (person_id) JOIN tld t ON t.person_id = d.person_id AND t.age = d.age
  WHERE d.rn = 1 AND x.rn = 1 AND day_index > 0 AND (x.age < d.age OR (x.age = d.age AND x.code <= d.code))""")
def _(t):
    events, days = ed(t)
    return B.treatment_choice(days, events, code_set(t, "set_c"), code_set(t, "set_a"), code_set(t, "set_b"))


@query("tlb_22_next_year_category", f"""WITH RECURSIVE fe AS (SELECT person_id, min(age) AS f FROM ({days_of('set_a')}) e GROUP BY 1),
  o AS (SELECT d.person_id, age, day_index FROM tld d LEFT JOIN fe USING (person_id) WHERE day_index > 0 AND (f IS NULL OR age < f)),
  g AS (SELECT person_id, min(age) AS age, 0 AS pos FROM o GROUP BY 1 UNION ALL SELECT person_id, nxt, pos + 1 FROM (SELECT g.person_id, g.pos, (SELECT min(o.age) FROM o WHERE o.person_id = g.person_id AND o.age >= g.age + 365) AS nxt FROM g) z WHERE nxt IS NOT NULL)
  """ + fixed_sql(days_of("set_a"), 365, "AND (person_id, day_index) IN (SELECT (g.person_id, tld.day_index) FROM g JOIN tld ON tld.person_id = g.person_id AND tld.age = g.age WHERE pos > 0)"))
def _(t):
    events, days = ed(t)
    return B.next_year_category(days, events, code_set(t, "set_a"))


@query("tlb_23_possible_patients", """SELECT DISTINCT person_id FROM tl WHERE code IN (SELECT code FROM set_a) AND person_id IN (SELECT person_id FROM tl WHERE code IN (SELECT code FROM set_b UNION SELECT code FROM set_c))""")
def _(t):
    index = T.code_index(ed(t)[0])
    return B.possible_patients(index, [code_set(t, "set_a")], [code_set(t, "set_b"), code_set(t, "set_c")])
