"""Queries of the timeline, code-mapping and ontology operators."""

import uuid

from pyspark.sql import functions as F

from ..operators import ontology as G, timeline as T
from ..sources.store import TimelineStore
from .registry import cte, query

cte("cc", "SELECT concept_id, vocabulary_id || '/' || concept_code AS code FROM concept")
cte("births", "SELECT person_id, CAST(birth_datetime AS DATE) AS birth_date FROM person")
cte("coded", " UNION ALL ".join(f"SELECT person_id, {d} AS day, CAST({c} AS BIGINT) AS concept_id FROM {n} WHERE {c} <> 0" for n, d, c in T.CODED_TABLES))
cte("visval", "SELECT person_id, visit_start_date AS day, CAST(visit_concept_id AS BIGINT) AS concept_id, CAST(date_diff('day', visit_start_date, visit_end_date) AS DOUBLE) AS numeric_value FROM visit_occurrence")
cte("measval", """SELECT person_id, day, concept_id, TRY_CAST(v AS DOUBLE) AS numeric_value, CASE WHEN TRY_CAST(v AS DOUBLE) IS NULL THEN v END AS text_value FROM (
  SELECT person_id, measurement_date AS day, CAST(measurement_concept_id AS BIGINT) AS concept_id, coalesce(nullif(value_source_value, ''), CAST(value_as_number AS VARCHAR)) AS v FROM measurement) q""")
cte("democ", "SELECT person_id, birth_date AS day, CAST(c AS BIGINT) AS concept_id FROM (SELECT person_id, unnest([gender_concept_id, ethnicity_concept_id, race_concept_id]) AS c FROM person) q JOIN births USING (person_id)")
cte("tl_facts", """SELECT person_id, day, code, numeric_value, text_value FROM (SELECT person_id, day, concept_id, NULL::DOUBLE AS numeric_value, NULL::VARCHAR AS text_value FROM coded
   UNION ALL SELECT person_id, day, concept_id, numeric_value, NULL FROM visval UNION ALL SELECT person_id, day, concept_id, numeric_value, text_value FROM measval) q JOIN cc USING (concept_id)
  UNION ALL SELECT person_id, death_date, 'Death Type/OMOP generated', NULL, NULL FROM death""")
cte("tl", """SELECT DISTINCT person_id, greatest(day, birth_date) AS day, greatest(date_diff('day', birth_date, day), 0) AS age, code, numeric_value, text_value FROM (
   SELECT * FROM tl_facts UNION ALL SELECT person_id, day, code, NULL, NULL FROM democ JOIN cc USING (concept_id)) q JOIN births USING (person_id)
  WHERE person_id IN (SELECT person_id FROM tl_facts)""")
cte("tld", """SELECT person_id, day, age, row_number() OVER (PARTITION BY person_id ORDER BY day) - 1 AS day_index, max(age) OVER (PARTITION BY person_id) AS last_age,
  count(*) OVER (PARTITION BY person_id) AS n_days FROM (SELECT DISTINCT person_id, day, age FROM tl) q""")


def timeline(t):
    """The built timeline as a stored table."""
    return t.stored("timeline", T.build, written=True)


def closure(t):
    return t.stored("closure", lambda t: G.closure(t.code_edges))


@query("tml_01_demographic_codes", "SELECT * FROM democ")
def _(t):
    return T.demographic_codes(t.person)


@query("tml_02_coded_events", "SELECT * FROM coded")
def _(t):
    return T.coded_events(t)


@query("tml_03_visit_values", "SELECT * FROM visval")
def _(t):
    return T.visit_values(t.visit_occurrence)


@query("tml_04_measurement_values", "SELECT * FROM measval")
def _(t):
    return T.measurement_values(t.measurement)


@query("tml_05_merged_timeline", "SELECT * FROM tl")
def _(t):
    return T.build(t)


@query("tml_06_day_records", """SELECT person_id, day, age, coalesce(list(DISTINCT code ORDER BY code) FILTER (WHERE numeric_value IS NULL AND text_value IS NULL), []) AS observations,
  count(DISTINCT code || ':' || coalesce(CAST(numeric_value AS VARCHAR), '') || ':' || coalesce(text_value, '')) FILTER (WHERE numeric_value IS NOT NULL OR text_value IS NOT NULL) AS n_valued FROM tl GROUP BY 1, 2, 3""")
def _(t):
    return T.day_records(timeline(t)).select("person_id", "day", "age", "observations", F.size("valued_observations").alias("n_valued"))


# Mapping: brand codes of the first ten brands go to one or two targets.
cte("mapping", """SELECT p_brand || '/' || CAST(p_partkey AS VARCHAR) AS code, 'ATC/' || CAST(p_partkey % 97 AS VARCHAR) AS target FROM part WHERE p_size % 4 <> 0
  UNION ALL SELECT p_brand || '/' || CAST(p_partkey AS VARCHAR), 'ATC/X' || CAST(p_partkey % 89 AS VARCHAR) FROM part WHERE p_size % 4 = 1""")
MAPPED = [f"Brand#{i}" for i in range(1, 11)]
KEPT = ["LOINC", "Visit", "Gender", "Race", "Ethnicity", "Death Type"] + [f"Brand#{i}" for i in range(11, 21)]


@query("tml_07_normalised_codes", f"""SELECT e.person_id, e.day, m.target AS code FROM tl e JOIN mapping m USING (code) WHERE split_part(code, '/', 1) IN ({', '.join(repr(v) for v in MAPPED)})
  UNION ALL SELECT person_id, day, code FROM tl WHERE split_part(code, '/', 1) IN ({', '.join(repr(v) for v in KEPT)})""")
def _(t):
    p = t.part
    code = F.concat_ws("/", "p_brand", F.col("p_partkey").cast("string"))
    one = p.where(F.col("p_size") % 4 != 0).select(code.alias("code"), F.concat(F.lit("ATC/"), (F.col("p_partkey") % 97).cast("string")).alias("target"))
    two = p.where(F.col("p_size") % 4 == 1).select(code.alias("code"), F.concat(F.lit("ATC/X"), (F.col("p_partkey") % 89).cast("string")).alias("target"))
    return T.normalise_codes(timeline(t), one.unionByName(two), MAPPED, kept=KEPT).select("person_id", "day", "code")


cte("gem", """SELECT p_partkey AS line_no, CAST(4000 + p_partkey % 700 AS VARCHAR) AS source, 'E' || CAST(10 + p_partkey % 90 AS VARCHAR) || CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS target,
  '1' || CASE WHEN p_size % 10 = 9 THEN '1' ELSE '0' END || CASE WHEN p_size % 2 = 0 THEN '1' ELSE '0' END || CAST(1 + p_size % 5 % 2 AS VARCHAR) || CAST(1 + p_partkey % 3 AS VARCHAR) AS flags FROM part""")
cte("gem_k", """SELECT line_no, source, CASE WHEN length(target) > 3 THEN left(target, 3) || '.' || substr(target, 4) ELSE target END AS target, flags[3] = '1' AS combo, flags[4] AS scen, flags[5] AS choice FROM gem WHERE flags[2] <> '1'""")


@query("tml_08_crosswalk", """WITH c AS (SELECT source, choice, arg_max(target, line_no) AS target, min(line_no) AS fl FROM gem_k WHERE combo AND scen = '1' GROUP BY 1, 2),
  s AS (SELECT source, arg_min(target, line_no) AS target, min(line_no) AS ln FROM gem_k WHERE NOT combo GROUP BY 1)
  SELECT source, target FROM c UNION ALL SELECT source, target FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source = s.source AND (choice = '1' OR fl < ln))
   AND coalesce((SELECT min(fl) FROM c WHERE c.source = s.source), ln + 1) > ln""")
def _(t):
    size, key = F.col("p_size"), F.col("p_partkey")
    digit = lambda c: c.cast("string")
    rows = t.part.select(
        key.alias("line_no"), (4000 + key % 700).cast("string").alias("source"),
        F.concat(F.lit("E"), digit(10 + key % 90), F.when(size % 3 == 0, "").otherwise(digit(size))).alias("target"),
        F.concat(F.lit("1"), F.when(size % 10 == 9, "1").otherwise("0"), F.when(size % 2 == 0, "1").otherwise("0"),
                 digit(1 + size % 5 % 2), digit(1 + key % 3)).alias("flags"),
    )
    return T.crosswalk(rows)


# Drug graph over parts: node n has ingredient n/2 and form n/5; codes with n % 9 = 0 are classified.
@query("tml_09_drug_classes", """WITH RECURSIVE e AS (SELECT p_partkey AS c, CAST(floor(p_partkey / k) AS BIGINT) AS p FROM part, (VALUES (2), (5)) v(k) WHERE p_partkey > 0),
  r AS (SELECT p_partkey AS c, p_partkey AS p FROM part UNION SELECT r.c, e.p FROM r JOIN e ON e.c = r.p)
  SELECT DISTINCT vocabulary, code, 'ATC/A' || CAST(p AS VARCHAR) AS atc FROM r JOIN (SELECT p_partkey AS n, CASE WHEN p_partkey % 2 = 0 THEN 'NDC' ELSE 'HCPCS' END AS vocabulary, 'c' || CAST(p_partkey AS VARCHAR) AS code FROM part
    UNION ALL SELECT p_partkey, 'RxNorm', CAST(p_partkey AS VARCHAR) FROM part) a ON a.n = r.c WHERE p % 9 = 0""")
def _(t):
    key = F.col("p_partkey")
    text = lambda c: c.cast("bigint").cast("string")
    parts = t.part.select("p_partkey")
    attributes = parts.select(text(key).alias("concept"), F.when(key % 2 == 0, "NDC").otherwise("HCPCS").alias("vocabulary"), F.concat(F.lit("c"), text(key)).alias("code"))
    links = F.array(*[F.struct(text(F.floor(key / k)).alias("child"), F.lit(r).alias("relation")) for k, r in ((2, "has_ingredient"), (5, "has_form"))])
    relations = parts.where(key > 0).select(text(key).alias("parent"), F.inline(links))
    rx = parts.select(text(key).alias("concept"), F.lit("RXNORM").alias("vocabulary"), text(key).alias("code"))
    atc = parts.where(key % 9 == 0).select(text(key).alias("concept"), F.lit("ATC").alias("vocabulary"), F.concat(F.lit("A"), text(key)).alias("code"))
    return G.drug_classes(attributes, relations, rx.unionByName(atc))


cte("claims", "SELECT person_id, CAST(ship_date AS DATE) AS day, CAST(pk % 500 AS VARCHAR) AS code1, CASE WHEN ln % 2 = 0 THEN CAST(pk % 77 AS VARCHAR) ELSE '' END AS code2 FROM lines")
cte("claim_map", "SELECT CAST(p_partkey AS VARCHAR) AS source, 'ICD10CM/M' || CAST(p_partkey % 50 AS VARCHAR) AS target FROM part WHERE p_partkey % 3 <> 0")


@query("tml_10_claim_events", """WITH l AS (SELECT DISTINCT person_id, day, code FROM (SELECT person_id, day, code1 AS code FROM claims UNION ALL SELECT person_id, day, code2 FROM claims) q WHERE code <> ''),
  hit AS (SELECT code, target, row_number() OVER (PARTITION BY code ORDER BY a) AS rn FROM (SELECT DISTINCT code FROM l) c, (VALUES (0, ''), (1, '0'), (2, '9'), (3, '1')) v(a, s) JOIN claim_map m ON m.source = code || s)
  SELECT DISTINCT person_id, day, target AS code FROM l JOIN hit USING (code) WHERE rn = 1""")
def _(t):
    lines = t.lines.select(
        "person_id", F.col("ship_date").cast("date").alias("day"), (F.col("pk") % 500).cast("string").alias("code1"),
        F.when(F.col("ln") % 2 == 0, (F.col("pk") % 77).cast("string")).otherwise("").alias("code2"))
    key = F.col("p_partkey")
    mapping = t.part.where(key % 3 != 0).select(key.cast("string").alias("source"), F.concat(F.lit("ICD10CM/M"), (key % 50).cast("string")).alias("target"))
    return T.claim_events(lines, mapping)


@query("tml_11_code_dictionary", "SELECT code, n, row_number() OVER (ORDER BY n DESC, code) - 1 AS code_id FROM (SELECT code, count(*) AS n FROM tl GROUP BY 1) q")
def _(t):
    return T.code_dictionary(timeline(t))


@query("tml_12_dated_read", "SELECT * FROM tl WHERE day >= DATE '1996-01-01' AND day < DATE '1999-07-01' AND person_id IN (SELECT person_id FROM death)")
def _(t):
    return T.read_patients(timeline(t), t.death, "1996-01-01", "1999-07-01")


@query("tml_13_patients_with_codes", "SELECT DISTINCT person_id FROM tl WHERE code IN ('LOINC/2823-3', 'LOINC/777-3')")
def _(t):
    return T.patients_with(T.code_index(timeline(t)), ["LOINC/2823-3", "LOINC/777-3"])


@query("tml_14_random_subset", """SELECT person_id FROM (SELECT person_id, row_number() OVER (ORDER BY md5('11|' || CAST(person_id AS VARCHAR))) AS rn, count(*) OVER () AS n FROM person) q WHERE rn <= floor(n * 0.3)""")
def _(t):
    return T.random_subset(t.person, 0.3, 11)


@query("tml_15_dense_ids", "SELECT person_id, row_number() OVER (ORDER BY person_id) - 1 AS patient_id FROM (SELECT DISTINCT person_id FROM visit_occurrence) q")
def _(t):
    return T.dense_ids(t.visit_occurrence)


@query("tml_16_day_index_of_dates", """SELECT v.person_id, v.day AS date, max(d.day_index) AS day_index FROM (SELECT DISTINCT person_id, CAST(note_date AS DATE) AS day FROM note) v
  LEFT JOIN tld d ON d.person_id = v.person_id AND d.day <= v.day GROUP BY 1, 2""")
def _(t):
    days = T.day_table(timeline(t))
    return T.day_index_of(days, t.note.select("person_id", F.col("note_date").alias("date")))


@query("tml_17_inspect_patient", "SELECT tl.*, i.patient_id FROM tl JOIN (SELECT person_id, row_number() OVER (ORDER BY person_id) - 1 AS patient_id FROM (SELECT DISTINCT person_id FROM tl) q) i USING (person_id) WHERE patient_id = 7")
def _(t):
    events = timeline(t)
    return T.inspect(events, T.dense_ids(events), patient_id=7)


@query("tml_18_year_records", "SELECT person_id, year(day) AS year, count(DISTINCT day) AS n_days, min(age) AS first_age, max(age) AS last_age FROM tl GROUP BY 1, 2")
def _(t):
    records = T.year_records(T.day_records(timeline(t)))
    return records.select("person_id", "year", F.size("days").alias("n_days"), F.col("days")[0]["age"].alias("first_age"), F.element_at("days", -1)["age"].alias("last_age"))


def store(t):
    """The timeline as a stored set, written once per session and reopened by name."""
    def build(t):
        name = f"timeline_{uuid.uuid4().hex}"
        TimelineStore.create(name, timeline(t), t.code_edges)
        return t.spark.createDataFrame([(name,)], "name string")
    return TimelineStore.open(t.spark, t.stored("timeline_store", build).first().name)


KEPT_SQL = "SELECT * FROM tl WHERE person_id IN (SELECT person_id FROM death)"


@query("tml_18_timeline_store", f"""WITH d AS (SELECT code, row_number() OVER (ORDER BY count(*) DESC, code) - 1 AS code_id FROM tl GROUP BY 1)
  SELECT person_id, day, age, code, code_id, numeric_value, text_value FROM ({KEPT_SQL}) k JOIN d USING (code)""")
def _(t):
    """A set of given patients that keeps the dictionary of the set it was taken from, reopened."""
    kept = store(t).subset(f"kept_{uuid.uuid4().hex}", t.death)
    again = TimelineStore.open(t.spark, kept.name)
    return again.part("events").join(again.part("dictionary").select("code", "code_id"), "code").select("person_id", "day", "age", "code", "code_id", "numeric_value", "text_value")


@query("tml_12_stored_read", "SELECT * FROM tl WHERE day >= DATE '1996-01-01' AND day < DATE '1999-07-01' AND person_id IN (7, 14, 70)")
def _(t):
    return store(t).patients([7, 14, 70], "1996-01-01", "1999-07-01")


@query("tml_13_stored_patients", "SELECT DISTINCT person_id FROM tl WHERE code IN ('LOINC/2823-3', 'LOINC/777-3')")
def _(t):
    return store(t).patients_with(["LOINC/2823-3", "LOINC/777-3"])


@query("tml_17_stored_patient", "SELECT tl.*, i.patient_id FROM tl JOIN (SELECT person_id, row_number() OVER (ORDER BY person_id) - 1 AS patient_id FROM (SELECT DISTINCT person_id FROM tl) q) i USING (person_id) WHERE patient_id = 7")
def _(t):
    return store(t).inspect(patient_id=7)


@query("tml_16_required_day_index", """SELECT v.person_id, v.day AS date, max(d.day_index) AS day_index FROM (SELECT DISTINCT person_id, visit_end_date AS day FROM visit_occurrence) v
  JOIN tld d ON d.person_id = v.person_id AND d.day <= v.day GROUP BY 1, 2""")
def _(t):
    days = T.day_table(timeline(t))
    asked = t.visit_occurrence.select("person_id", F.col("visit_end_date").alias("date")).join(days.groupBy("person_id").agg(F.min("day").alias("_first")), "person_id").where("_first <= date")
    return T.day_index_of(days, asked.select("person_id", "date"), required=True)


# ---- ontology --------------------------------------------------------------

cte("clos", """SELECT DISTINCT code, ancestor FROM (WITH RECURSIVE w AS (SELECT code, code AS ancestor FROM (SELECT code FROM code_edges UNION SELECT parent FROM code_edges) n
  UNION SELECT w.code, e.parent FROM w JOIN code_edges e ON e.code = w.ancestor) SELECT * FROM w) z""")
cte("used_codes", "SELECT DISTINCT code FROM tl")


@query("ont_01_subwords", """SELECT c.code, c.ancestor FROM clos c WHERE c.code IN (SELECT code FROM used_codes) AND c.code IN (SELECT code FROM code_edges)
  UNION ALL SELECT code, 'NO_MAP/' || code FROM used_codes WHERE code NOT IN (SELECT code FROM code_edges)""")
def _(t):
    return G.subwords(timeline(t).select("code"), t.code_edges, t.code_edges.select("code").distinct())


@query("ont_02_all_parents", "SELECT code, ancestor FROM clos WHERE code <> ancestor")
def _(t):
    return G.all_parents(closure(t))


@query("ont_02_children", "SELECT DISTINCT parent AS code, code AS child FROM code_edges")
def _(t):
    return G.children(t.code_edges)


@query("ont_02_words_under", "SELECT DISTINCT code FROM clos WHERE ancestor IN ('TOP/1', 'SIZE/3')")
def _(t):
    return G.words_under(closure(t), ["TOP/1", "SIZE/3"])


@query("ont_02_roots", "SELECT DISTINCT parent AS code FROM code_edges WHERE parent NOT IN (SELECT code FROM code_edges)")
def _(t):
    return G.roots(t.code_edges)


@query("ont_03_recorded_date_codes", "SELECT code FROM used_codes WHERE split_part(code, '/', 1) IN ('ATC', 'CPT4', 'DRG', 'Gender', 'HCPCS', 'ICD10CM', 'ICD10PCS', 'LOINC')")
def _(t):
    return G.recorded_date_codes(timeline(t).select("code"))


@query("ont_04_definitions", "SELECT u.code, n.definition FROM used_codes u LEFT JOIN (SELECT vocabulary_id || '/' || concept_code AS code, min(concept_name) AS definition FROM concept GROUP BY 1) n USING (code)")
def _(t):
    names = T.concept_codes(t.concept).join(t.concept.select("concept_id", "concept_name"), "concept_id")
    return G.with_definitions(timeline(t).select("code").distinct(), names.groupBy("code").agg(F.min("concept_name").alias("definition")))


@query("ont_05_zip_hierarchy", """SELECT DISTINCT code, parent FROM (SELECT unnest(['ZIP_5/' || z, 'ZIP_3/' || left(z, 3), 'ZIP_1/' || left(z, 1)]) AS code, unnest(['ZIP_3/' || left(z, 3), 'ZIP_1/' || left(z, 1), 'ZIP_0/root']) AS parent
  FROM (SELECT lpad(CAST((c_custkey * 7919) % 100000 AS VARCHAR), 5, '0') AS z FROM customer) q) x""")
def _(t):
    return G.zip_hierarchy(t.customer.select(F.lpad(((F.col("c_custkey") * 7919) % 100000).cast("string"), 5, "0").alias("zip")))


@query("ont_06_atom_parents", """WITH atk AS (SELECT 'A' || CAST(p_partkey AS VARCHAR) AS atom FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') AND p_size % 2 = 0),
  syn AS (SELECT 'A' || CAST(p_partkey AS VARCHAR) AS atom, 'A' || CAST(p_partkey - p_partkey % 5 AS VARCHAR) AS pref FROM part WHERE p_partkey % 5 = 1),
  rel AS (SELECT 'A' || CAST(p_partkey AS VARCHAR) AS atom, 'A' || CAST(CAST(floor(p_partkey / 2) AS BIGINT) AS VARCHAR) AS parent FROM part),
  al AS (SELECT coalesce(s1.pref, rel.atom) AS atom, coalesce(s2.pref, parent) AS parent_atom FROM rel LEFT JOIN syn s1 ON s1.atom = rel.atom LEFT JOIN syn s2 ON s2.atom = parent
   UNION ALL SELECT atom, 'A0' FROM atk)
  SELECT DISTINCT atom, parent_atom FROM al WHERE atom IN (SELECT atom FROM atk) AND parent_atom IN (SELECT atom FROM atk UNION SELECT 'A0') AND atom IN (SELECT atom FROM atk UNION SELECT 'A0') AND atom <> parent_atom""")
def _(t):
    key = F.col("p_partkey")
    name = lambda c: F.concat(F.lit("A"), c.cast("bigint").cast("string"))
    atoms = t.part.select(name(key).alias("atom"), F.col("p_brand").alias("vocabulary"), key.cast("string").alias("code"), (F.col("p_size") % 2).cast("string").alias("term_type"))
    kept = G.atom_codes(atoms, [f"Brand#{i}" for i in range(1, 6)], ["0"])
    synonyms = t.part.where(key % 5 == 1).select(name(key).alias("atom"), name(key - key % 5).alias("preferred"))
    relations = t.part.select(name(key).alias("atom"), name(F.floor(key / 2)).alias("parent_atom"))
    root = kept.select("atom", F.lit("A0").alias("parent_atom"))
    known = kept.select("atom").unionByName(t.part.where(key == 0).select(name(key).alias("atom"))).distinct()
    return G.atom_parents(relations, synonyms, known, root).join(kept.select("atom"), "atom", "left_semi")
