"""Queries that write through a sink and read back through a source, and the model jobs.

Files go to the shared folder for intermediate tables.
"""

import uuid

from pyspark.sql import functions as F

from ..functions.hashing import sha256_mod
from ..functions.segments import attach, durable, literal_rows, shared_folder, union_all
from ..operators import evaluation as E, features as X, models as L, ontology as G, splits as P, timeline as T, timeline_features as S
from ..sources import readers, store, writers
from .cohort_queries import adm
from .feature_queries import chosen, cohort, day_sql, one, source_sql
from .labeler_queries import ed, lab_a
from .registry import cte, query
from .timeline_feature_queries import RECORDED, setup


def place(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


#: Identifying columns of every clinical relation.
IDENTITY = {
    "person": ["person_id", "gender_concept_id", "year_of_birth"], "visit_occurrence": ["visit_occurrence_id", "person_id", "visit_start_date"],
    "visit_detail": ["visit_detail_id", "person_id"], "condition_occurrence": ["person_id", "condition_concept_id", "condition_start_date"],
    "procedure_occurrence": ["person_id", "procedure_concept_id", "procedure_date"], "drug_exposure": ["person_id", "drug_concept_id", "drug_exposure_start_date"],
    "device_exposure": ["person_id", "device_concept_id", "device_exposure_start_date"], "measurement": ["person_id", "measurement_concept_id", "measurement_date"],
    "observation": ["observation_id", "person_id", "observation_date"], "note": ["note_id", "person_id", "note_date"], "note_nlp": ["note_nlp_id", "note_id", "term_exists"],
    "death": ["person_id", "death_date"], "observation_period": ["person_id", "observation_period_start_date"], "concept": ["concept_id", "vocabulary_id"],
    "concept_ancestor": ["ancestor_concept_id", "descendant_concept_id"], "concept_relationship": ["concept_id_1", "concept_id_2", "relationship_id"],
}
identity_sql = lambda n, cols: f"SELECT '{n}' AS relation, concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)}) AS identity, count(*) AS n FROM {n} GROUP BY 1, 2"


@query("src_01_clinical_tables", " UNION ALL ".join(identity_sql(n, cols) for n, cols in IDENTITY.items()))
def _(t):
    """All relations, stored in the catalogue and read back from it."""
    prefix = f"clinical_{uuid.uuid4().hex}"
    for n in IDENTITY:
        store.replace_table(getattr(t, n), f"{prefix}_{n}", dates=[c for c in IDENTITY[n] if c.endswith("_date")])
    found = readers.clinical_tables(t.spark, names=[f"{prefix}_{n}" for n in IDENTITY])
    key = lambda cols: F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    frames = [found[f"{prefix}_{n}"].groupBy(F.lit(n).alias("relation"), key(cols).alias("identity")).agg(F.count(F.lit(1)).alias("n")) for n, cols in IDENTITY.items()]
    return union_all(frames)


@query("src_02_delimited_files", "SELECT visit_occurrence_id, person_id, visit_concept_id FROM visit_occurrence")
def _(t):
    path = place(t, "delimited")
    t.visit_occurrence.write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(path)
    schema = "visit_occurrence_id bigint, person_id bigint, visit_concept_id int, visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz, visit_start_date date, visit_end_date date, discharge_to_concept_id int"
    return readers.delimited(t.spark, path, ["visit_occurrence_id", "person_id", "visit_concept_id"], "\t", schema=schema)


@query("src_03_headerless_files", "SELECT person_id, death_date FROM death")
def _(t):
    path = place(t, "vendor")
    t.death.write.option("header", True).csv(f"{path}/with_header")
    return readers.headerless(t.spark, f"{path}/with_header", "person_id bigint, death_date date")


@query("src_04_pipe_release", "SELECT CAST(p_partkey AS VARCHAR) AS concept, p_brand AS vocabulary, p_name AS name FROM part")
def _(t):
    path = place(t, "release")
    t.part.select(F.concat_ws("|", F.col("p_partkey").cast("string"), F.lit(""), "p_brand", "p_name", F.lit("")).alias("value")).write.text(path)
    return readers.pipe_release(t.spark, path, {"concept": 0, "vocabulary": 2, "name": 3})


@query("src_05_crosswalk_file", "SELECT source, target, flags, count(*) AS n FROM gem GROUP BY 1, 2, 3")
def _(t):
    path = place(t, "crosswalk")
    key, size = F.col("p_partkey"), F.col("p_size")
    digit = lambda c: c.cast("string")
    target = F.concat(F.lit("E"), digit(10 + key % 90), F.when(size % 3 == 0, "").otherwise(digit(size)))
    flags = F.concat(F.lit("1"), F.when(size % 10 == 9, "1").otherwise("0"), F.when(size % 2 == 0, "1").otherwise("0"), digit(1 + size % 5 % 2), digit(1 + key % 3))
    t.part.select(F.concat_ws("   ", digit(4000 + key % 700), target, flags).alias("value")).write.text(path)
    return readers.crosswalk_file(t.spark, path).groupBy("source", "target", "flags").agg(F.count(F.lit(1)).alias("n"))


@query("snk_01_parquet", "SELECT * FROM adm")
def _(t):
    path = place(t, "admissions")
    writers.write_parquet(adm(t), path)
    return t.spark.read.parquet(path)


@query("snk_02_named_result", "SELECT * FROM death")
def _(t):
    writers.replace_table(t.death, "wardflow_death_view", view=True)
    return t.spark.table("wardflow_death_view")


@query("snk_02_stored_table", "SELECT person_id, death_date FROM death")
def _(t):
    """A stored table that replaces one of another shape under the same name."""
    name = f"deaths_{uuid.uuid4().hex}"
    store.replace_table(t.person.select("person_id"), name)
    store.replace_table(t.death, name)
    return t.spark.table(name).select("person_id", "death_date")


@query("snk_04_dated_table", "SELECT observation_period_start_date AS start_date, observation_period_end_date AS end_date, person_id FROM observation_period")
def _(t):
    """Dates that arrive as text become DATE columns of the stored table."""
    name = f"periods_{uuid.uuid4().hex}"
    text = lambda c: F.col(c).cast("string")
    rows = t.observation_period.select("person_id", text("observation_period_start_date").alias("start_date"), text("observation_period_end_date").alias("end_date"))
    store.replace_table(rows, name, dates=["start_date", "end_date"])
    return t.spark.table(name)


@query("snk_03_csv_features", day_sql(source_sql("drug_exposure"), "drug_exposure"))
def _(t):
    source, target = place(t, "csv"), place(t, "parquet")
    writers.write_features_csv(one(t, "drug_exposure"), source)
    schema = "row_id bigint, person_id bigint, index_date date, concept_id string, feature_id string, concept_count bigint, analysis_id string, time_bin string"
    writers.csv_features_to_parquet(t.spark, source, target, schema)
    return t.spark.read.parquet(target)


@query("snk_05_label_file", "SELECT person_id, 'binary' AS labeler_type, day_index, CAST(label AS DOUBLE) AS label FROM lab_a")
def _(t):
    path = place(t, "labels")
    writers.write_labels(lab_a(t)[1], path)
    return readers_labels(t, path)


def readers_labels(t, path):
    return writers.read_labels(t.spark, path)


@query("snk_06_timeline_json", "SELECT person_id, day, count(DISTINCT code) FILTER (WHERE numeric_value IS NULL AND text_value IS NULL) AS n_codes FROM tl GROUP BY 1, 2")
def _(t):
    path = place(t, "json")
    names = T.concept_codes(t.concept).join(t.concept.select("concept_id", F.col("concept_name").alias("definition")), "concept_id")
    definitions = names.groupBy("code").agg(F.min("definition").alias("definition"))
    writers.write_timeline_json(T.timeline_json(T.day_records(ed(t)[0]), definitions), path)
    shape = "struct<observations:array<struct<code:string,definition:string>>>"
    rows = t.spark.read.schema("person_id bigint, day date, record string").json(path)
    return rows.select("person_id", "day", F.greatest(F.size(F.from_json("record", shape)["observations"]), F.lit(0)).alias("n_codes"))


@query("snk_07_split_lists", "SELECT person_id, CASE WHEN rk < floor(n * 0.7) THEN 'train' ELSE 'test' END AS split FROM (SELECT person_id, row_number() OVER (ORDER BY md5('0|' || CAST(person_id AS VARCHAR))) - 1 AS rk, count(*) OVER () AS n FROM person) q")
def _(t):
    path = place(t, "lists")
    writers.write_split_lists(P.repeated_splits(t.person, seeds=(0,)).select("person_id", F.col("part").alias("split")), path)
    return t.spark.read.option("header", True).schema("person_id bigint, split string").csv(path)


# ---- rows and columns by split --------------------------------------------------

YEARS = {"train": (1992, 1996), "val": (1997, 1997), "test": (1998, 1999)}
cte("split_rows", f"""SELECT split, row_number() OVER (PARTITION BY split ORDER BY row_id) - 1 AS row_idx, row_id AS prediction_id FROM (SELECT row_id, year(admit_date) AS y, CASE WHEN fold_id IN ('test', 'val') THEN fold_id ELSE 'train' END AS split
  FROM samp JOIN fold2 USING (person_id)) q WHERE """ + " OR ".join(f"(split = '{n}' AND y BETWEEN {a} AND {b})" for n, (a, b) in YEARS.items()))


def row_numbers(t):
    """Row numbers of the sampled admissions by the folds of their persons and the year of admission."""
    people = cohort(t).withColumnRenamed("row_id", "prediction_id").withColumnRenamed("index_date", "admit_date")
    folds = P.patient_split(adm(t), test_frac=0.15, nfold=5, seed=1, eval_frac=0.15).select("person_id", F.regexp_replace("fold_id", "eval", "val").alias("fold_id")).distinct()
    return P.split_rows(people.join(folds, "person_id"), YEARS)


@query("snk_07_row_maps", "SELECT * FROM split_rows")
def _(t):
    """Row maps by split, written as CSV and read back."""
    path = place(t, "rowmaps")
    writers.write_row_maps(row_numbers(t), path)
    return union_all([writers.read_row_map(t.spark, path, n) for n in YEARS])


@query("ftq_18_split_matrix", "SELECT split, row_idx, col_id, value FROM trip JOIN rowmap USING (features_row_id) JOIN split_rows ON prediction_id = row_id")
def _(t):
    """The sparse matrix by split, with the row numbers of the row maps."""
    triples, rows, _ = X.sparse_matrix(X.merge_features(chosen(t)))
    return P.split_matrix(triples, rows, row_numbers(t))


# ---- model jobs: long admissions from the age and code counts before them --------

cte("mdl_part", """SELECT person_id, CASE WHEN d < 7 THEN 'train' WHEN d < 9 THEN 'val' ELSE 'test' END AS part FROM (SELECT person_id, CAST(list_reduce(list_transform(range(0, 32), lambda i: CAST('0x' || substr(dg, CAST(i * 2 + 1 AS BIGINT), 2) AS BIGINT)), lambda a, b: (a * 256 + b) % 10) % 10 AS INT) AS d
  FROM (SELECT person_id, sha256('44|' || CAST(person_id AS VARCHAR)) AS dg FROM person) q) z""")
cte("mdl_cells", "SELECT person_id, day_index, code, count(*) AS n FROM (SELECT p.person_id, p.day_index, c.code FROM pts p JOIN cnt c ON c.person_id = p.person_id AND c.day <= p.day) q GROUP BY 1, 2, 3")


def model_rows(t):
    """(train, val, test, triples, columns): sparse rows over age and every counted code, split by hashed person."""
    events, days, labels, points, _ = setup(t)
    counted = S.counted_codes(events, G.is_recorded(RECORDED))
    vocabulary = durable(S.count_vocabulary(counted))
    age = S.age_feature(points, S.age_statistics(points))
    size = vocabulary.count()
    triples = S.beside(S.combine([(age, 1), (S.count_features(points, counted, vocabulary), size)]), days)
    keys = ["person_id", "day_index"]
    digit = sha256_mod(F.concat_ws("|", F.lit("44"), F.col("person_id").cast("string")).cast("binary"), 10, little=False)
    # The cells meet the one label of their day where they lie, so no vector is shuffled.
    marked = S.beside(labels.withColumnRenamed("label", "labels").withColumn("_d", digit), days)
    rows = L.assemble(triples.join(marked, keys), size + 1, [*keys, "labels", "_d"])
    part = lambda cond: rows.where(cond).drop("_d")
    return part("_d < 7"), part("_d >= 7 AND _d < 9"), part("_d = 9"), triples, size + 1


MATRIX_SQL = """SELECT part, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive, (SELECT count(*) + 1 FROM cvoc) AS n_columns FROM pts JOIN mdl_part USING (person_id) GROUP BY 1"""


def matrix_facts(parts: dict, size: int):
    frames = [rows.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum("labels").cast("bigint").alias("n_positive"), F.lit(size).cast("bigint").alias("n_columns")) for n, rows in parts.items()]
    return union_all(frames)


@query("mdl_01_design_matrix", "SELECT person_id, day_index, 1 + code_column AS \"column\", n AS value FROM mdl_cells JOIN cvoc USING (code)")
def _(t):
    """The code cells of the sparse design matrix, read back out of its vectors."""
    train, val, test, _, size = model_rows(t)
    rows = train.unionByName(val).unionByName(test)
    cells = rows.select("person_id", "day_index", F.inline(L.cells("features")))
    return cells.where("column > 0").select("person_id", "day_index", F.col("column").cast("bigint").alias("column"), F.col("value").cast("bigint").alias("value"))


POINTS_SQL = lambda n: f"SELECT point, (SELECT n_rows FROM ({MATRIX_SQL}) m WHERE part = 'val') AS n_val, TRUE AS finite_loss, TRUE AS settled FROM range(0, {n}) r(point)"


@query("mdl_01_logistic_grid", POINTS_SQL(len(L.LOGISTIC_C)))
def _(t):
    """Every regularisation point: whether its validation loss is a number and its gradient 0."""
    train, val, _, triples, _ = model_rows(t)
    scored = L.logistic_grid(train, val, stored=True)
    strengths = [s["regParam"] for _, s, _ in scored]
    steepest = dict(zip(strengths, L.gradients([m for _, _, m in scored], train, triples, ["person_id", "day_index"], strengths)))
    return grid_report(t, scored, val, lambda s, m: steepest[s["regParam"]] < 1e-5)


@query("mdl_02_boosted_trees", POINTS_SQL(8))
def _(t):
    """Every boosting point: whether its validation loss is a number and it has all its trees."""
    train, val, _, _, _ = model_rows(t)
    return grid_report(t, L.boosting_grid(train, val), val, lambda s, m: m.getNumTrees == L.BOOSTING_ROUNDS)


def grid_report(t, scored, val, settled):
    n = val.count()
    rows = [(i, n, str(bool(0 < loss < 100)), str(bool(settled(s, m)))) for i, (loss, s, m) in enumerate(scored)]
    return literal_rows(t.spark, rows, "point bigint, n_val bigint, finite_loss boolean, settled boolean")


@query("mdl_03_scored_test_set", "SELECT person_id, day_index, label AS labels, TRUE AS is_probability FROM pts JOIN mdl_part USING (person_id) WHERE part = 'test'")
def _(t):
    """The test rows scored by the best point of the whole logistic grid."""
    train, val, test, _, _ = model_rows(t)
    scored = L.score(L.best(L.logistic_grid(train, val, stored=True))[2], test)
    return scored.select("person_id", "day_index", "labels", F.col("pred_probs").between(0, 1).alias("is_probability"))


@query("mdl_03_test_metrics", f"SELECT n_rows, n_positive, n_columns, TRUE AS all_metrics FROM ({MATRIX_SQL}) m WHERE part = 'test'")
def _(t):
    """All metrics of the chosen model on the test rows."""
    train, val, test, _, size = model_rows(t)
    found = L.evaluate_test(L.best(L.logistic_grid(train, val, stored=True))[2], test).agg(F.count("performance").alias("_n"))
    facts = matrix_facts({"test": test}, size).drop("part")
    return attach(facts, found).select("n_rows", "n_positive", "n_columns", (F.col("_n") == len(E.METRICS)).alias("all_metrics"))
