"""Repeatable patient splits, task tables, group weights and cohort summaries.

Every split ranks distinct persons by a seeded hash; ranks are cut into even
hash buckets, so no step sorts all persons in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import key_hash
from ..functions.segments import attach, dense_index, durable, hash_rank, union_all
from .evaluation import exact_quantiles
from .timeline import day_index_of

SPLIT_SEEDS = tuple(range(10))


def person_ranks(df: DataFrame, seed: int, person: str = "person_id") -> DataFrame:
    """(person, rank, total) of distinct persons in seeded hash order."""
    people = df.select(person).distinct()
    total = people.agg(F.count(F.lit(1)).alias("total"))
    return attach(hash_rank(people, [], key_hash(person, seed=seed)), total)


def patient_split(df: DataFrame, test_frac: float = 0.1, nfold: int = 10, seed: int = 657, eval_frac: float = 0.0) -> DataFrame:
    """Adds ``fold_id``: test, optionally eval, and folds 1..n dealt in turn."""
    if not 0.0 < test_frac < 1.0 or not 0.0 <= eval_frac < 1.0:
        raise ValueError("fractions must lie between 0 and 1")
    ranks = person_ranks(df, seed)
    test, ev = F.floor(F.col("total") * test_frac), F.floor(F.col("total") * eval_frac)
    rank = F.col("rank")
    fold = F.when(rank < test, "test").when(rank < test + ev, "eval").otherwise(((rank - test - ev) % nfold + 1).cast("string"))
    return df.join(ranks.select("person_id", fold.alias("fold_id")), "person_id")


def repeated_splits(df: DataFrame, train_frac: float = 0.7, seeds=SPLIT_SEEDS) -> DataFrame:
    """(split, seed, person_id, part): several train/test splits with their seeds kept."""
    numbered = F.array(*[F.struct(F.lit(i).alias("split"), F.lit(seed).alias("seed")) for i, seed in enumerate(seeds)])
    people = df.select("person_id").distinct()
    total = people.agg(F.count(F.lit(1)).alias("total"))
    # One pass: a person is ranked once per split, the seed leading its hashed text.
    ranked = attach(hash_rank(people.select("person_id", F.inline(numbered)), ["split"], key_hash("seed", "person_id")), total)
    part = F.when(F.col("rank") < F.floor(F.col("total") * train_frac), "train").otherwise("test")
    return ranked.select("split", "seed", "person_id", part.alias("part"))


def read_split(splits: DataFrame, split: int | None = None, part: str = "train") -> DataFrame:
    chosen = splits.where(F.col("part") == part)
    return (chosen if split is None else chosen.where(F.col("split") == split)).select("person_id")


def time_split(df: DataFrame, day: str, cuts: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows by calendar windows, ends included."""
    part = None
    for name, (a, b) in cuts.items():
        hit = F.col(day).cast("date").between(F.lit(a).cast("date"), F.lit(b).cast("date"))
        part = F.when(hit, name) if part is None else part.when(hit, name)
    return df.withColumn("fold_id", part).where(F.col("fold_id").isNotNull())


def task_exclusions(df: DataFrame, tasks: dict[str, str | None]) -> DataFrame:
    """Long task rows (.., task, fold_id, label); excluded rows get ``ignore`` and a null label.

    ``tasks`` maps a label column to the time column whose value before the
    first midnight excludes the row (or None).
    """
    midnight = F.col("admit_date_midnight")
    early = F.coalesce(F.col("death_date").cast("timestamp_ntz") <= midnight, F.lit(False)) | (F.col("discharge_date") <= midnight)
    structs = []
    for task, at in tasks.items():
        out, label = early, F.col(task).cast("double")
        if task.startswith("readmission"):
            out = out | (F.col("hospital_mortality") == 1) | F.coalesce(F.col("readmission_window") == 0, F.lit(False))
        elif at is not None:
            out, label = out | F.coalesce(F.col(at) <= midnight, F.lit(False)), F.coalesce(label, F.lit(0.0))
        structs.append(F.struct(F.lit(task).alias("task"), F.when(out, "ignore").otherwise(F.col("fold_id")).alias("task_fold_id"),
                                F.when(~out, label).alias("label")))
    return df.select("person_id", "admit_date", "discharge_date", F.inline(F.array(*structs)))


def wide_tasks(long: DataFrame, tasks: list[str]) -> DataFrame:
    """One row per admission with ``<task>`` and ``<task>_fold_id`` columns."""
    one = lambda n, t: F.max(F.when(F.col("task") == t, F.col(n)))
    aggregates = [a for t in tasks for a in (one("label", t).alias(t), one("task_fold_id", t).alias(f"{t}_fold_id"))]
    return long.groupBy("person_id", "admit_date", "discharge_date").agg(*aggregates)


def task_tables(long: DataFrame, days: DataFrame, windows: dict[str, tuple[str, str]], adult: DataFrame) -> DataFrame:
    """Task rows of each population and fold inside its date window, with the timeline day index.

    Readmission is predicted at discharge, all other tasks at admission.
    """
    date = F.when(F.col("task").startswith("readmission"), F.col("discharge_date")).otherwise(F.col("admit_date")).cast("date")
    fold = F.when(F.col("task_fold_id").isin("test", "val"), F.col("task_fold_id")).otherwise("train")
    kept = long.where("task_fold_id <> 'ignore'").withColumn("date", date).withColumn("fold", fold)
    inside = reduce(lambda a, b: a | b, [(F.col("fold") == f) & F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date"))
                                         for f, (a, b) in windows.items()])
    kept = kept.where(inside).join(adult.select("person_id", "admit_date", "adult_at_admission"), ["person_id", "admit_date"])
    kept = kept.join(day_index_of(days, kept.select("person_id", "date")), ["person_id", "date"])
    population = F.explode(F.array(F.lit("mix"), F.when(F.col("adult_at_admission") == 1, "ad").otherwise("ped")))
    return kept.select(population.alias("population"), "task", "fold", "person_id", "date", "day_index", "label")


def pretraining_lists(cohort: DataFrame, seed: int = 0, val_frac: float = 0.2) -> DataFrame:
    """(population, person_id, part): val and test persons excluded; the rest 80/20 train and val."""
    population = F.explode(F.array(F.lit("mix"), F.when(F.col("adult_at_admission") == 1, "ad").otherwise("ped"))).alias("population")
    held = F.max(F.col("fold_id").isin("val", "test").cast("int")).alias("held")
    people = cohort.where(F.col("pediatric_age_group") != "term neonatal").select(population, "person_id", "fold_id").groupBy("population", "person_id").agg(held)
    inside = people.where("held = 0").select("population", "person_id")
    sizes = inside.groupBy("population").agg(F.count(F.lit(1)).alias("_n"))
    ranked = hash_rank(inside, ["population"], key_hash("person_id", seed=seed)).join(F.broadcast(sizes), "population")
    part = F.when(F.col("rank") < F.floor(F.col("_n") * val_frac), "val").otherwise("train")
    out = people.where("held = 1").select("population", "person_id", F.lit("exclude").alias("part"))
    return out.unionByName(ranked.select("population", "person_id", part.alias("part")))


def task_features(features: DataFrame, long: DataFrame, task: str, key: list[str]) -> DataFrame:
    """Shared feature rows that a task does not ignore."""
    rows = long.where((F.col("task") == task) & (F.col("task_fold_id") != "ignore")).select(*key)
    return features.join(rows, key, "left_semi")


def phases(df: DataFrame, group: str, val_fold: str, test_folds=("test",)) -> DataFrame:
    """Phase from the fold, dense group code by sorted category, and inverse-frequency weights from train rows."""
    phase = F.when(F.col("fold_id").isin(*test_folds), "test").when(F.col("fold_id") == val_fold, "val").otherwise("train")
    out = df.withColumn("phase", phase)
    codes = dense_index(out.select(group).distinct(), [group], "group_id")
    train = out.where("phase = 'train'")
    counts = train.groupBy(group).agg(F.count(F.lit(1)).alias("_g"))
    total = train.agg(F.count(F.lit(1)).alias("_n"))
    weights = attach(counts, total).select(group, (F.col("_n") / F.col("_g")).alias("group_weight"))
    return out.join(codes, group).join(weights, group, "left")


def person_splitter(df: DataFrame, test: float = 0.3, train: float | None = None, nfold: int = 3, seed: int = 0,
                    outcome: str = "outcome", min_outcomes: int = 10) -> DataFrame:
    """(row_id, index): -1 test, 0 leftover, 1..n folds; too few outcomes are an error."""
    if nfold < 1 or not 0 < test < 1:
        raise ValueError("nfold must be at least 1 and test between 0 and 1")
    train = 1 - test if train is None else train
    if train + test > 1:
        raise ValueError("train + test must not exceed 1")
    ranks = person_ranks(df, seed)
    outcomes = df.agg(F.sum((F.col(outcome) > 0).cast("int")).alias("_o"), F.count_distinct(outcome).alias("_k"))
    n_test = F.floor(F.col("total") * test)
    n_left = F.floor(F.round(F.col("total") * max(0.0, 1 - train - test), 6))
    index = F.when(F.col("rank") < n_test, -1).when(F.col("rank") < n_test + n_left, 0).otherwise((F.col("rank") - n_test - n_left) % nfold + 1)
    few = (F.col("_o") < min_outcomes) | (F.col("_k") < 2) | (F.floor(F.col("_o") * test / nfold) == 0)
    checked = F.when(few, F.raise_error(F.lit("too few outcomes for the split"))).otherwise(index)
    return df.join(attach(ranks, outcomes).select("person_id", checked.cast("int").alias("index")), "person_id").select("row_id", "index")


def split_summary(long: DataFrame, groups: list[str]) -> DataFrame:
    """Rows, share of all rows and prevalence per task, fold and group."""
    totals = long.groupBy("task").agg(F.count(F.lit(1)).alias("_n"))
    return (
        long.groupBy("task", "task_fold_id", *groups).agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("prevalence"))
        .join(totals, "task").withColumn("percent", 100 * F.col("n") / F.col("_n")).drop("_n")
    )


def incidence_tables(df: DataFrame, outcome: str, groups: list[str]) -> DataFrame:
    """Outcome rate over every one-, two- and three-way combination of the groups, in one pass."""
    level = sum((1 - F.grouping(g) for g in groups), F.lit(0))
    return (
        df.cube(*groups).agg(F.avg(outcome).alias("incidence"), F.count(F.lit(1)).alias("n"), level.alias("ways"), F.grouping_id().alias("combination"))
        .where(F.col("ways").between(1, 3))
    )


def profile_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def split_rows(cohort: DataFrame, years: dict[str, tuple[int, int]], row: str = "prediction_id", at: str = "admit_date") -> DataFrame:
    """(split, row_idx, row): rows of each fold inside its admission years, numbered from 0 within their split.

    ``years`` maps test, val and train to first and last admission year; every fold but
    test and val trains.  Rows are numbered over all splits by range partitions with
    offsets, and each split starts again at its first number: one row per split.
    """
    split = F.when(F.col("fold_id").isin("test", "val"), F.col("fold_id")).otherwise("train")
    year = F.year(at)
    inside = reduce(lambda a, b: a | b, [(split == n) & year.between(*span) for n, span in years.items()])
    kept = cohort.where(inside & F.col("fold_id").isNotNull()).select(split.alias("split"), row)
    numbered = durable(dense_index(kept, ["split", row], "_at"))
    starts = numbered.groupBy("split").agg(F.min("_at").alias("_start"))
    return numbered.join(starts, "split").select("split", (F.col("_at") - F.col("_start")).alias("row_idx"), row)


def split_matrix(triples: DataFrame, rows: DataFrame, row_map: DataFrame, row: str = "prediction_id", feature_row: str = "row_id") -> DataFrame:
    """(split, row_idx, col_id, value): a matrix's triples by the row numbers of ``split_rows``."""
    numbers = row_map.join(rows.select(F.col(feature_row).alias(row), "features_row_id"), row)
    return triples.join(numbers.select("split", "row_idx", "features_row_id"), "features_row_id").select("split", "row_idx", "col_id", "value")


def group_quartiles(df: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """(groups, variable, n, median, q25, q75), exact, over each group's known values."""
    long = df.select(*groups, F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value")) for v in values]))).where("value IS NOT NULL")
    keys = [*groups, "variable"]
    edges = exact_quantiles(long, keys, "value", [0.25, 0.5, 0.75])
    return edges.join(long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys).select(
        *keys, "n", F.col("edges")[1].alias("median"), F.col("edges")[0].alias("q25"), F.col("edges")[2].alias("q75"))
