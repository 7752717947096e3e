"""Statistical comparison of models over tasks, and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import hash_int
from ..functions.segments import attach, dense_index, durable
from . import evaluation as E, replicates


def align(treatment: DataFrame, control: DataFrame, labels: DataFrame) -> DataFrame:
    """Long tables (prediction_id, task, value) to (prediction_id, task, labels, treatment, control), common rows only."""
    return (
        labels.where(F.col("labels").isNotNull())
        .join(treatment.select("prediction_id", "task", F.col("value").alias("treatment")), ["prediction_id", "task"])
        .join(control.select("prediction_id", "task", F.col("value").alias("control")), ["prediction_id", "task"])
        .where(F.col("treatment").isNotNull() & F.col("control").isNotNull())
    )


def task_scores(aligned: DataFrame, strata: list[str] = (), weight: str | None = None) -> DataFrame:
    """AUC of both models per task."""
    arms = F.array(*[F.struct(F.lit(n).alias("arm"), F.col(n).alias("pred_probs")) for n in ("treatment", "control")])
    rows = aligned.select(*aligned.columns, F.inline(arms))
    auc = E.ranking_metrics(rows, [*strata, "task", "arm"], weight)
    one = lambda a: F.max(F.when(F.col("arm") == a, F.col("auc"))).alias(a)
    return auc.groupBy(*strata, "task").agg(one("treatment"), one("control"))


def task_draws(tasks: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """(boot_id, task, times): tasks drawn with replacement per replicate."""
    indexed = dense_index(tasks.select("task").distinct(), ["task"], "_i")
    total = indexed.agg(F.count(F.lit(1)).alias("_n"))
    draws = attach(indexed, total).withColumn("boot_id", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1)))).select(
        "boot_id", (hash_int(F.lit("task"), "boot_id", "_i", seed=seed) % F.col("_n")).alias("_i"))
    return draws.groupBy("boot_id", "_i").agg(F.count(F.lit(1)).alias("times")).join(indexed, "_i").drop("_i")


def multi_bootstrap(aligned: DataFrame, n_boot: int, seed: int = 444) -> DataFrame:
    """(boot_id, diff): mean AUC difference over drawn tasks on drawn rows; draws are arrays, so rows do not grow with replicates."""
    rows = replicates.with_draws(aligned, n_boot, unit="prediction_id", seed=seed)
    arms = F.array(*[F.struct(F.lit(n).alias("arm"), F.col(n).alias("pred_probs")) for n in ("treatment", "control")])
    auc = replicates.replicate_metrics(rows.select("task", "labels", "draws", F.inline(arms)), ["task", "arm"], n_boot, metrics=("auc",))
    one = lambda a: F.max(F.when(F.col("arm") == a, F.col("performance"))).alias(a)
    scores = auc.groupBy("boot_id", "task").agg(one("treatment"), one("control"))
    drawn = scores.join(task_draws(aligned, n_boot, seed), ["boot_id", "task"])
    gap = (F.col("treatment") - F.col("control")) * F.col("times")
    return drawn.groupBy("boot_id").agg((F.sum(gap) / F.sum("times")).alias("diff"))


def task_bootstrap(treatment_scores: DataFrame, control_scores: DataFrame, n_boot: int, seed: int = 444) -> DataFrame:
    """(boot_id, diff) when both models have different test sets: only tasks are drawn."""
    both = treatment_scores.select("task", "treatment").join(control_scores.select("task", "control"), "task")
    drawn = task_draws(both, n_boot, seed).join(both, "task")
    return drawn.groupBy("boot_id").agg((F.sum((F.col("treatment") - F.col("control")) * F.col("times")) / F.sum("times")).alias("diff"))


def _summary(diffs: DataFrame, crossing) -> DataFrame:
    p = F.avg(crossing)
    ends = F.percentile("diff", F.array(F.lit(0.025), F.lit(0.975)))
    out = diffs.agg(p.alias("_p"), F.avg("diff").alias("mean_diff"), ends.alias("_e"))
    return out.select((2 * F.least(F.col("_p"), 1 - F.col("_p"))).alias("p_value"), "mean_diff",
                      F.col("_e")[0].alias("CI_lower"), F.col("_e")[1].alias("CI_upper"))


def superiority(diffs: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """Two-sided p-value from the share of differences on the wrong side of zero."""
    wrong = F.col("diff") <= 0 if higher_is_better else F.col("diff") >= 0
    return _summary(diffs, wrong.cast("double"))


def noninferiority(diffs: DataFrame, control_scores: DataFrame, margin: float = 0.05, higher_is_better: bool = True) -> DataFrame:
    """As superiority, against minus the margin times the control mean; ties count half."""
    mean = control_scores.agg(F.avg("control").alias("_m"))
    limit = -margin * F.col("_m")
    worse = F.col("diff") < limit if higher_is_better else F.col("diff") > limit
    share = F.when(worse, 1.0).when(F.col("diff") == limit, 0.5).otherwise(0.0)
    return _summary(attach(diffs, mean), share)


def collate(spark, path: str, schema: str) -> DataFrame:
    """Result files under ``tag=value`` folders as one table, tags as columns."""
    return spark.read.option("header", True).schema(schema).option("basePath", path).csv(path)


def wide_predictions(long: DataFrame, tasks: list[str]) -> DataFrame:
    """One row per prediction with a column per task; missing tasks stay null."""
    return long.groupBy("prediction_id").pivot("task", tasks).agg(F.first("value"))


def result_table(results: DataFrame, keys: list[str], value: str = "performance") -> DataFrame:
    """Mean, median and quartiles per metric and model."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return results.groupBy(*keys).agg(F.avg(value).alias("mean"), q.alias("_q")).select(
        *keys, "mean", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q75"))


def row_set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of either table that the other lacks, with the side they come from."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.select(*a.columns).subtract(a).withColumn("side", F.lit("right")))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return row_set_difference(a, b).isEmpty()
