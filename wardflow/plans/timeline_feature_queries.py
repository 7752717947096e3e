"""Queries of the timeline features and sequence summaries."""

import uuid

from pyspark.sql import functions as F

from ..functions.segments import durable, shared_folder
from ..operators import fitted as I, labelers as B, ontology as G, timeline_features as S
from .labeler_queries import code_set, ed
from .registry import cte, query

RECORDED = [f"Brand#{i}" for i in range(1, 26)] + ["LOINC", "Gender"]
IN_REC = ", ".join(repr(r) for r in RECORDED)
cte("labs", "SELECT person_id, day_index - 1 AS day_index, CAST(end_age - start_age >= 7 AS INT) AS label FROM tadm_d WHERE day_index > 0")
cte("pts", "SELECT l.*, d.day, d.age FROM labs l JOIN tld d USING (person_id, day_index)")
cte("rec", f"SELECT DISTINCT code FROM tl WHERE split_part(code, '/', 1) IN ({IN_REC})")
cte("cnt", "SELECT person_id, code, day, age FROM tl WHERE numeric_value IS NULL AND text_value IS NULL AND code IN (SELECT code FROM rec)")
cte("cvoc", "SELECT code, row_number() OVER (ORDER BY code) - 1 AS code_column FROM (SELECT DISTINCT code FROM cnt) q")


def closure_of(t):
    return t.stored("closure", lambda t: G.closure(t.code_edges))


def setup(t):
    events, days = ed(t)
    labels = B.long_admission(days, events)
    points = S.beside(S.label_days(labels, days), days)
    recorded = G.recorded_date_codes(events.select("code"), RECORDED)
    return events, days, labels, points, recorded


def size_of(vocabulary):
    return vocabulary.agg(F.count(F.lit(1)).alias("_size"))


@query("tft_01_combined_matrix", """WITH st AS (SELECT avg(age) AS m, stddev_samp(age) AS s FROM pts), n AS (SELECT count(*) AS k FROM cvoc)
  SELECT person_id, day_index, 0 AS "column", round((age - m) / s, 6) AS value FROM pts, st UNION ALL SELECT person_id, day_index, 1, CAST(year(day) >= 2016 AS DOUBLE) FROM pts
  UNION ALL SELECT p.person_id, p.day_index, 2 + code_column, count(*) FROM pts p JOIN cnt c ON c.person_id = p.person_id AND c.day <= p.day JOIN cvoc USING (code) GROUP BY 1, 2, 3
  UNION ALL SELECT person_id, day_index, 2 + k, 3.5 FROM pts, n""")
def _(t):
    events, _, _, points, _ = setup(t)
    counted = S.counted_codes(events, G.is_recorded(RECORDED))
    vocabulary = S.count_vocabulary(counted)
    age = S.age_feature(points, S.age_statistics(points)).withColumn("value", F.round("value", 6))
    return S.combine([(age, 1), (S.icd10_era(points), 1), (S.count_features(points, counted, vocabulary), size_of(vocabulary)), (S.constant(points, 3.5), 1)])


@query("tft_02_age", 'SELECT person_id, day_index, 0 AS "column", round((age - (SELECT avg(age) FROM pts)) / (SELECT stddev_samp(age) FROM pts), 6) AS value FROM pts')
def _(t):
    points = setup(t)[3]
    return S.age_feature(points, S.age_statistics(points)).withColumn("value", F.round("value", 6))


@query("tft_03_icd10_era", 'SELECT person_id, day_index, 0 AS "column", CAST(year(day) >= 2016 AS DOUBLE) AS value FROM pts')
def _(t):
    return S.icd10_era(setup(t)[3])


@query("tft_04_counts_rolled_up", """WITH r AS (SELECT person_id, day, ancestor AS code, count(*) AS n FROM cnt JOIN clos USING (code) GROUP BY 1, 2, 3), v AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS c FROM (SELECT DISTINCT code FROM r) q)
  SELECT p.person_id, p.day_index, v.c AS "column", CAST(sum(n) AS DOUBLE) AS value FROM pts p JOIN r ON r.person_id = p.person_id AND r.day <= p.day JOIN v USING (code) GROUP BY 1, 2, 3""")
def _(t):
    events, _, _, points, _ = setup(t)
    counted = S.counted_codes(events, G.is_recorded(RECORDED), closure_of(t))
    return S.count_features(points, counted, S.count_vocabulary(counted))


@query("tft_05_counts_in_time_bins", """SELECT p.person_id, p.day_index, code_column + b * (SELECT count(*) FROM cvoc) AS "column", CAST(count(*) AS DOUBLE) AS value FROM (SELECT p.person_id, p.day_index, code,
   CASE WHEN date_diff('day', c.day, p.day) <= 90 THEN 0 WHEN date_diff('day', c.day, p.day) <= 365 THEN 1 ELSE 2 END AS b FROM pts p JOIN cnt c ON c.person_id = p.person_id AND c.day <= p.day) p JOIN cvoc USING (code) GROUP BY 1, 2, 3""")
def _(t):
    events, _, _, points, _ = setup(t)
    counted = S.counted_codes(events, G.is_recorded(RECORDED))
    return S.count_features(points, counted, S.count_vocabulary(counted), [90, 365, None])


@query("tft_06_binary", """SELECT DISTINCT p.person_id, p.day_index, code_column AS "column", 1.0::DOUBLE AS value FROM pts p JOIN cnt c ON c.person_id = p.person_id AND c.day <= p.day JOIN cvoc USING (code)""")
def _(t):
    events, _, _, points, _ = setup(t)
    counted = S.counted_codes(events, G.is_recorded(RECORDED))
    return S.count_features(points, counted, S.count_vocabulary(counted), binary=True)


@query("tft_07_label_derived", 'SELECT person_id, day_index, 0 AS "column", CAST(label AS DOUBLE) AS value FROM labs UNION ALL SELECT person_id, day_index, 1, 2.0 FROM labs')
def _(t):
    _, _, labels, points, _ = setup(t)
    return S.combine([(S.from_values(points, labels.withColumnRenamed("label", "value")), 1), (S.constant(points, 2.0), 1)])


cte("nv", "SELECT person_id, code, day, numeric_value AS v FROM tl WHERE numeric_value IS NOT NULL AND code IN (SELECT code FROM rec)")
# State is learnt from training patients only.
cte("trainp", """SELECT person_id FROM (SELECT person_id, CAST(list_reduce(list_transform(range(0, 32), lambda i: CAST('0x' || substr(dg, CAST(i * 2 + 1 AS BIGINT), 2) AS BIGINT)), lambda a, b: (a * 256 + b) % 10) % 10 AS INT) AS d
  FROM (SELECT person_id, sha256('97|' || CAST(person_id AS VARCHAR)) AS dg FROM person) q) z WHERE d <> 9""")
cte("nvt", "SELECT * FROM nv WHERE person_id IN (SELECT person_id FROM trainp)")
cte("nedge", """SELECT code, list_prepend(-1e300, list(v ORDER BY i)) AS e FROM (SELECT s.code, i, s.v FROM (SELECT code, v, row_number() OVER (PARTITION BY code ORDER BY v) - 1 AS rk, count(*) OVER (PARTITION BY code) AS n FROM nvt) s
  JOIN range(1, 5) x(i) ON rk = CAST(round_even((n - 1) * i / 5, 0) AS BIGINT)) q GROUP BY 1""")
cte("nslot", "SELECT code, e, len(list_filter(e, lambda x: x <= v)) AS slot, count(*) AS n FROM nvt JOIN nedge USING (code) GROUP BY 1, 2, 3")
cte("nfold", """SELECT code, e, 1 AS i, CASE WHEN c >= 60 THEN 0 ELSE c END AS carry, CASE WHEN c >= 60 THEN NULL ELSE e[1] END AS low, CASE WHEN c >= 60 THEN [e[1]] ELSE []::DOUBLE[] END AS o
  FROM (SELECT x.code, x.e, coalesce(s.n, 0) AS c FROM nedge x LEFT JOIN nslot s ON s.code = x.code AND s.slot = 1) q""")


@query("tft_08_numeric_bins", """WITH RECURSIVE f AS (SELECT code, e, i, carry, low, o FROM nfold UNION ALL SELECT code, e, i + 1, CASE WHEN c >= 60 THEN 0 ELSE c END, CASE WHEN c >= 60 THEN NULL ELSE coalesce(low, e[i + 1]) END,
    CASE WHEN c >= 60 THEN list_append(o, coalesce(low, e[i + 1])) ELSE o END FROM (SELECT f.*, coalesce(s.n, 0) + f.carry AS c FROM f LEFT JOIN nslot s ON s.code = f.code AND s.slot = f.i + 1 WHERE f.i < len(f.e)) z),
  b AS (SELECT code, j, o[j] AS low, o[j + 1] AS high FROM (SELECT code, o, unnest(range(1, len(o) + 1)) AS j FROM f WHERE i = len(e)) q),
  c AS (SELECT *, row_number() OVER (ORDER BY code, j) - 1 AS col FROM b)
  SELECT p.person_id, p.day_index, c.col AS "column", CAST(count(*) AS DOUBLE) AS value FROM pts p JOIN nv ON nv.person_id = p.person_id AND nv.day <= p.day JOIN c ON c.code = nv.code AND v >= low AND (high IS NULL OR v < high) GROUP BY 1, 2, 3""")
def _(t):
    events, _, _, points, _ = setup(t)
    return reloaded(t).value_counts(points, events)


def reloaded(t):
    """State learnt from the training patients, saved and read back."""
    def build(t):
        events, _, _, points, recorded = setup(t)
        path = f"{shared_folder(t.spark)}/state-{uuid.uuid4().hex}"
        I.fit(events, points, recorded, t.person.where(S.is_train(F.col("person_id"), 97)), num_bins=5, min_per_bin=60).save(path)
        return t.spark.createDataFrame([(path,)], "path string")
    return I.load(t.spark, t.stored("fitted_state", build).first().path)


@query("tft_09_encode_decode", """WITH k AS (SELECT code, row_number() OVER (ORDER BY count(*) DESC, code) - 1 AS code_id FROM tl WHERE code IN (SELECT code FROM rec) AND person_id IN (SELECT person_id FROM trainp) GROUP BY 1)
  SELECT person_id, day, code_id FROM tl JOIN k USING (code)""")
def _(t):
    return reloaded(t).encode(ed(t)[0].select("person_id", "day", "code"))


@query("tft_09_reloaded_statistics", """SELECT p.person_id, p.day_index, round((age - m) / s, 6) AS value FROM pts p, (SELECT avg(age) AS m, stddev_samp(age) AS s FROM pts WHERE person_id IN (SELECT person_id FROM trainp)) q""")
def _(t):
    return reloaded(t).ages(setup(t)[3]).select("person_id", "day_index", F.round("value", 6).alias("value"))


@query("tft_10_online_statistics", "SELECT round(avg(age), 6) AS mean, round(var_samp(age), 4) AS variance, round(stddev_samp(age), 6) AS deviation FROM pts")
def _(t):
    return S.age_statistics(setup(t)[3]).select(F.round("mean", 6).alias("mean"), F.round("variance", 4).alias("variance"), F.round("deviation", 6).alias("deviation"))


cte("ipd", """SELECT d.person_id, d.day_index, d.day, CASE WHEN dt - d.age <= 180 THEN 1 WHEN last_age - d.age >= 180 THEN 0 END AS label FROM tld d LEFT JOIN (SELECT person_id, min(age) AS dt FROM tl WHERE code LIKE 'Death Type/%' GROUP BY 1) x USING (person_id)
  WHERE day_index >= 2 AND (dt IS NULL OR dt > d.age) AND EXISTS (SELECT 1 FROM tadm a WHERE a.person_id = d.person_id AND d.age BETWEEN start_age AND end_age)""")


@query("tft_11_inpatient_days", """SELECT p.person_id, p.day_index, label, code, count(*) AS value FROM ipd p JOIN cnt c ON c.person_id = p.person_id AND c.day < p.day WHERE label IS NOT NULL
  AND code IN (SELECT code FROM cnt GROUP BY 1 HAVING count(DISTINCT person_id) > 25) GROUP BY 1, 2, 3, 4""")
def _(t):
    events, days = ed(t)
    points, counts = S.inpatient_day_rows(events, days, B.admissions(events), G.is_recorded(RECORDED), min_patients=25)
    return durable(counts.join(points.select("person_id", "day_index", "label"), ["person_id", "day_index"]), co_located=True)


# ---- sequence summaries ----------------------------------------------------

TRAIN, VAL = ("1996-01-01", "1999-01-01"), ("1999-01-01", "2000-06-01")
cte("lens", """SELECT person_id, CASE WHEN tl_ >= 3 AND ti > 0 THEN tl_ END AS train_length, CASE WHEN vl >= 3 AND vi > 0 THEN vl END AS val_length FROM (SELECT person_id, count(*) FILTER (WHERE day < DATE '1999-01-01') AS tl_,
  count(*) FILTER (WHERE day >= DATE '1996-01-01' AND day < DATE '1999-01-01') AS ti, count(*) FILTER (WHERE day < DATE '2000-06-01') AS vl, count(*) FILTER (WHERE day >= DATE '1999-01-01' AND day < DATE '2000-06-01') AS vi FROM tld GROUP BY 1) q""")
cte("pcode", """SELECT c.ancestor AS code, count(DISTINCT person_id) AS n_patients FROM tl JOIN clos c USING (code) WHERE day < DATE '1999-01-01' AND code IN (SELECT code FROM rec)
  AND person_id IN (SELECT person_id FROM lens WHERE train_length IS NOT NULL) GROUP BY 1""")
cte("stt", """SELECT avg(age) AS age_mean, stddev_samp(age) AS age_std, avg(ln(1 + age)) AS age_log_mean, stddev_samp(ln(1 + age)) AS age_log_std, avg(gap) AS delta_mean, stddev_samp(gap) AS delta_std, avg(ln(1 + gap)) AS delta_log_mean, stddev_samp(ln(1 + gap)) AS delta_log_std
  FROM (SELECT *, age - coalesce(lag(age) OVER (PARTITION BY person_id ORDER BY age), 0) AS gap FROM tld) q WHERE day < DATE '1999-01-01' AND age > 0""")
cte("vcode", """SELECT code, n_patients, row_number() OVER (ORDER BY n_patients DESC, code) - 1 AS valid_index FROM pcode p WHERE n_patients >= 30 AND code <> 'ROOT/0' AND code IN (SELECT code FROM clos WHERE ancestor = 'ROOT/0')
  AND EXISTS (SELECT 1 FROM code_edges e JOIN code_edges s ON s.parent = e.parent AND s.code <> e.code JOIN pcode q ON q.code = s.code WHERE e.code = p.code AND q.n_patients >= 30)""")
cte("dcode", "SELECT DISTINCT person_id, age, ancestor AS code FROM tl JOIN clos USING (code) WHERE code IN (SELECT code FROM rec)")


def sequence(t):
    events, days = ed(t)
    recorded = G.recorded_date_codes(events.select("code"), RECORDED)
    closure = closure_of(t)
    lengths = S.window_lengths(days, TRAIN, VAL).where("train_length is not null")
    counts = t.stored("patients_per_code", lambda t: S.patients_per_code(events, recorded, closure, lengths, TRAIN[1]))
    return events, days, recorded, closure, counts


@query("seq_01_window_lengths", "SELECT * FROM lens WHERE train_length IS NOT NULL OR val_length IS NOT NULL")
def _(t):
    return S.window_lengths(ed(t)[1], TRAIN, VAL)


@query("seq_01_patients_per_code", "SELECT * FROM pcode")
def _(t):
    return sequence(t)[4]


STT = ["age_mean", "age_std", "age_log_mean", "age_log_std", "delta_mean", "delta_std", "delta_log_mean", "delta_log_std"]


@query("seq_01_age_gap_statistics", "SELECT " + ", ".join(f"round({c}, 5) AS {c}" for c in STT) + " FROM stt")
def _(t):
    return S.age_gap_statistics(ed(t)[1], TRAIN[1]).select(*[F.round(c, 5).alias(c) for c in STT])


@query("seq_02_valid_codes", "SELECT * FROM vcode")
def _(t):
    _, _, _, closure, counts = sequence(t)
    return S.valid_codes(counts, t.code_edges, closure, "ROOT/0", 30)


@query("seq_03_chosen_patients", """WITH b AS (SELECT DISTINCT person_id FROM visit_occurrence WHERE person_id IN (SELECT person_id FROM measurement) AND person_id NOT IN (SELECT person_id FROM death))
  SELECT person_id FROM (SELECT *, row_number() OVER (ORDER BY md5('3|' || CAST(person_id AS VARCHAR))) - 1 AS rk, count(*) OVER () AS n FROM b) q WHERE rk >= floor(n * 0.2)""")
def _(t):
    return S.choose_patients(t.visit_occurrence, t.measurement, t.death, 0.2, 3)


@query("seq_04_frequency_table", "SELECT f AS at_least, sum(CAST(n_patients >= f AS BIGINT)) AS n_codes FROM pcode, (VALUES (10), (25), (50), (100), (1000)) v(f) GROUP BY 1")
def _(t):
    return S.frequency_table(sequence(t)[4])


Z = lambda v, s: f"CASE WHEN age = 0 THEN 0.0 ELSE round(({v} - {s}_mean) / {s}_std, 5) + 0.0 END"


@query("seq_05_day_rows", f"""SELECT d.person_id, day_index, coalesce(codes, []) AS codes, {Z('age', 'age')} AS age_z, {Z('ln(1 + age)', 'age_log')} AS log_age_z, {Z('gap', 'delta')} AS gap_z, {Z('ln(1 + gap)', 'delta_log')} AS log_gap_z, CAST(age = 0 AS INT) AS is_birth
  FROM (SELECT *, age - coalesce(lag(age) OVER (PARTITION BY person_id ORDER BY age), 0) AS gap FROM tld) d LEFT JOIN (SELECT person_id, age, list(valid_index ORDER BY valid_index) AS codes FROM dcode JOIN vcode USING (code) GROUP BY 1, 2) c USING (person_id, age), stt""")
def _(t):
    events, days, _, closure, counts = sequence(t)
    valid = S.valid_codes(counts, t.code_edges, closure, "ROOT/0", 30)
    rows = durable(S.day_rows(days, S.day_codes(events, G.is_recorded(RECORDED), closure, valid), valid, S.age_gap_statistics(days, TRAIN[1])), co_located=True)
    return rows.select("person_id", "day_index", "codes", *[(F.round(c, 5) + 0.0).alias(c) for c in ("age_z", "log_age_z", "gap_z", "log_gap_z")], "is_birth")


@query("seq_06_next_day_targets", """WITH neg AS (SELECT DISTINCT d.person_id, d.age, e.code FROM dcode d JOIN code_edges e ON e.parent = d.code WHERE NOT EXISTS (SELECT 1 FROM dcode x WHERE x.person_id = d.person_id AND x.age = d.age AND x.code = e.code)),
  b AS (SELECT *, 1 AS target FROM dcode UNION ALL SELECT *, 0 FROM neg)
  SELECT b.person_id, day_index - 1 AS day_index, target, count(*) AS n_codes, sum(valid_index) AS index_sum, sum(CASE WHEN f < b.age THEN 1 ELSE 0 END) AS n_seen FROM b JOIN vcode USING (code) JOIN tld USING (person_id, age)
  LEFT JOIN (SELECT person_id, code, min(age) AS f FROM dcode GROUP BY 1, 2) s ON s.person_id = b.person_id AND s.code = b.code WHERE day_index > 0 GROUP BY 1, 2, 3""")
def _(t):
    events, days, _, closure, counts = sequence(t)
    valid = S.valid_codes(counts, t.code_edges, closure, "ROOT/0", 30)
    targets = S.next_day_targets(days, S.day_codes(events, G.is_recorded(RECORDED), closure, valid, "left"), t.code_edges, valid)
    return targets.groupBy("person_id", "day_index", "target").agg(
        F.count(F.lit(1)).alias("n_codes"), F.sum("valid_index").alias("index_sum"), F.sum("seen").alias("n_seen"))


@query("seq_07_leaf_codes", """SELECT code, row_number() OVER (ORDER BY code) - 1 AS leaf_index FROM vcode v WHERE (split_part(code, '/', 1) IN ('GRP', 'TOP') AND NOT EXISTS (SELECT 1 FROM code_edges e JOIN vcode w ON w.code = e.code WHERE e.parent = v.code))
  OR (code LIKE 'SIZE/%' AND length(split_part(code, '/', 2)) = 1)""")
def _(t):
    _, _, _, closure, counts = sequence(t)
    valid = S.valid_codes(counts, t.code_edges, closure, "ROOT/0", 30)
    return S.leaf_codes(valid, t.code_edges, ["GRP", "TOP"], ["SIZE"], 1)


@query("seq_07_next_day_codes", "SELECT person_id, day_index - 1 AS day_index, list(code ORDER BY code) AS codes FROM dcode JOIN tld USING (person_id, age) WHERE day_index > 0 GROUP BY 1, 2")
def _(t):
    events, days = ed(t)
    codes = S.day_codes(events, G.is_recorded(RECORDED), closure_of(t))
    return durable(codes.join(days, ["person_id", "age"]).where("day_index > 0").groupBy("person_id", (F.col("day_index") - 1).alias("day_index")).agg(
        F.sort_array(F.collect_set("code")).alias("codes")), co_located=True)


@query("seq_08_entropy_candidates", """SELECT e.parent, e.code, round(CASE WHEN c.n_patients = p.n_patients THEN 0 ELSE p.n_patients * (c.n_patients / p.n_patients * ln(c.n_patients / p.n_patients) + (1 - c.n_patients / p.n_patients) * ln(1 - c.n_patients / p.n_patients)) END, 5) AS entropy
  FROM (SELECT DISTINCT code, parent FROM code_edges) e JOIN pcode c ON c.code = e.code JOIN pcode p ON p.code = e.parent WHERE c.n_patients >= 20 AND e.parent IN (SELECT code FROM clos WHERE ancestor = 'TOP/1')""")
def _(t):
    _, _, _, closure, counts = sequence(t)
    return S.entropy_candidates(counts, t.code_edges, closure, "TOP/1", 20).withColumn("entropy", F.round("entropy", 5))


@query("seq_09_numeric_ranges", """WITH s AS (SELECT code, numeric_value AS v, row_number() OVER (PARTITION BY code ORDER BY numeric_value) - 1 AS rk, count(*) OVER (PARTITION BY code) AS n FROM tl WHERE numeric_value IS NOT NULL),
  k AS (SELECT DISTINCT code, n, CAST(floor(least(n, 10000) / 100) AS BIGINT) AS k FROM s WHERE floor(least(n, 10000) / 100) > 1),
  p AS (SELECT DISTINCT code, i, CASE WHEN i = k THEN n - 1 ELSE CAST(floor(n * i / k) AS BIGINT) END AS pos FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM k) z),
  d AS (SELECT DISTINCT code, v FROM s JOIN p USING (code) WHERE rk = pos), l AS (SELECT code, list(v ORDER BY v) AS v FROM d GROUP BY 1)
  SELECT code, v[2:len(v) - 1] AS ranges FROM l WHERE len(v) > 2""")
def _(t):
    return S.numeric_ranges(ed(t)[0], split_size=100)


@query("seq_09_text_values", """WITH c AS (SELECT code, lower(text_value) AS text, count(*) AS n FROM tl WHERE text_value IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 10) SELECT * FROM c WHERE code IN (SELECT code FROM c GROUP BY 1 HAVING count(*) > 1)""")
def _(t):
    return S.text_values(ed(t)[0], at_least=10)


@query("seq_10_hash_split", """SELECT person_id, CAST(list_reduce(list_transform(range(0, 32), lambda i: CAST('0x' || substr(dg, CAST(i * 2 + 1 AS BIGINT), 2) AS BIGINT)), lambda a, b: (a * 256 + b) % 10) % 10 <> 9 AS INT) AS is_train
  FROM (SELECT person_id, sha256('97|' || CAST(person_id AS VARCHAR)) AS dg FROM person) q""")
def _(t):
    return t.person.select("person_id", S.is_train(F.col("person_id"), 97).cast("int").alias("is_train"))
