"""Discrete-time survival: bins, survival curves from hazards, loss."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.segments import attach, value_order
from .evaluation import exact_quantiles


def time_edges(events: DataFrame, time: str, num_quantiles: int) -> DataFrame:
    """One row with the sorted, distinct edges: event-time quantiles, 0 in front, infinity last."""
    edges = exact_quantiles(events, [], time, [i / num_quantiles for i in range(num_quantiles + 1)])
    full = F.concat(F.array(F.lit(0.0)), F.col("edges"), F.array(F.lit(float("inf"))))
    return edges.select(F.array_sort(F.array_distinct(full)).alias("edges"))


def time_bin(df: DataFrame, time: str, edges: DataFrame, out: str = "time_bin") -> DataFrame:
    """Left-closed bin index of a time."""
    return attach(df, edges).withColumn(out, F.size(F.filter("edges", lambda e: e <= F.col(time))) - 1).drop("edges")


def time_bin_unique(df: DataFrame, events: DataFrame, time: str, out: str = "time_bin") -> DataFrame:
    """Left-closed bin index of a time, every distinct event time being an edge and 0 in front.

    Edges and times are put in one order with a running count of edges, so the
    edges, as many as there are event times, are never held in one array.
    """
    first = events.agg(F.min(time).alias("_m")).where("_m <> 0").select(F.lit(0.0).cast(events.schema[time].dataType).alias(time))
    edges = events.select(time).where(F.col(time).isNotNull()).distinct().unionByName(first).distinct()
    marks = edges.withColumn("_n", F.lit(1).cast("bigint")).unionByName(df.select(time).distinct().withColumn("_n", F.lit(0).cast("bigint")))
    ordered = value_order(marks, [], time, {"_upto": "_n"}).select(time, F.col("_upto").alias("_upto"))
    return df.join(ordered, time).withColumn(out, (F.col("_upto") - 1).cast("int")).drop("_upto")


def survival_curve(hazards: DataFrame, row: str = "row_id") -> DataFrame:
    """Survival per (row, bin) from hazard logits; bins per row are few."""
    upto = Window.partitionBy(row).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    log_stay = -F.log1p(F.exp(F.col("logit")))
    return hazards.withColumn("survival", F.exp(F.sum(log_stay).over(upto)))


def survival_at(curve: DataFrame, times: DataFrame, row: str = "row_id") -> DataFrame:
    """Survival in the bin of each row's own time."""
    return curve.join(times.select(row, F.col("time_bin").alias("bin")), [row, "bin"]).select(row, "survival")


def discrete_time_loss(hazards: DataFrame, times: DataFrame, row: str = "row_id") -> DataFrame:
    """Mean over rows of the cross entropy summed over bins up to the label bin."""
    z = F.col("logit")
    target = ((F.col("bin") == F.col("time_bin")) & (F.col("event") == 1)).cast("double")
    bce = F.greatest(z, F.lit(0.0)) - z * target + F.log1p(F.exp(-F.abs(z)))
    rows = hazards.join(times.select(row, "time_bin", "event"), row).where(F.col("bin") <= F.col("time_bin"))
    return rows.groupBy(row).agg(F.sum(bce).alias("_loss")).agg(F.avg("_loss").alias("loss"))
