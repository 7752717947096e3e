"""Ordered and interval work on keys that may hold a large share of all rows.

A window over a person's raw rows would put a hot person into one task.  The
helpers here split every key by calendar day (or by a coarser time bucket):
the fine step runs per (key, day), only one row per (key, day) goes on to the
step over the whole key.  A life has fewer than 60,000 days, so that step has a
fixed size bound whatever the number of rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .timeunits import col, epoch_day


def running_sum(df: DataFrame, keys: list[str], ts: str, value: str, out: str) -> DataFrame:
    """Running total of ``value`` by time; ``ts`` must be unique per key."""
    cut = df.withColumn("_day", F.col(ts).cast("date"))
    inner = Window.partitionBy(*keys, "_day").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        cut.groupBy(*keys, "_day")
        .agg(F.sum(value).alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(outer), F.lit(0)))
        .drop("_total")
    )
    return (
        cut.withColumn("_within", F.sum(value).over(inner))
        .join(days, [*keys, "_day"])
        .withColumn(out, F.col("_within") + F.col("_before"))
        .drop("_day", "_within", "_before")
    )


def next_row(df: DataFrame, keys: list[str], order: list[str], ts: str, cols: dict[str, str]) -> DataFrame:
    """Value of the following row by ``order`` (its first column is ``ts``)."""
    cut = df.withColumn("_day", F.col(ts).cast("date"))
    inner = Window.partitionBy(*keys, "_day").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy("_day")
    days = (
        cut.groupBy(*keys, "_day")
        .agg(F.min(F.struct(*order, *[F.col(c).alias(f"_v_{n}") for n, c in cols.items()])).alias("_first"))
        .withColumn("_next_day", F.lead("_first").over(outer))
        .drop("_first")
    )
    step = cut.withColumn("_has", F.lead(F.lit(1)).over(inner))
    for name, source in cols.items():
        step = step.withColumn(f"_in_{name}", F.lead(source).over(inner))
    step = step.join(days, [*keys, "_day"])
    for name in cols:
        step = step.withColumn(
            name,
            F.when(F.col("_has").isNotNull(), F.col(f"_in_{name}")).otherwise(F.col("_next_day")[f"_v_{name}"]),
        )
    return step.drop("_day", "_has", "_next_day", *[f"_in_{n}" for n in cols])


def carry_last(df: DataFrame, keys: list[str], order: list[str], ts: str, value: str, out: str) -> DataFrame:
    """Last non-null ``value`` at or before each row (as-of, backward)."""
    cut = df.withColumn("_day", F.col(ts).cast("date"))
    inner = Window.partitionBy(*keys, "_day").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    held = F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v")))
    days = (
        cut.groupBy(*keys, "_day")
        .agg(F.max(held).alias("_end"))
        .withColumn("_carried", F.last(F.col("_end")["_v"], ignorenulls=True).over(outer))
        .drop("_end")
    )
    return (
        cut.withColumn("_in", F.last(value, ignorenulls=True).over(inner))
        .join(days, [*keys, "_day"])
        .withColumn(out, F.coalesce(F.col("_in"), F.col("_carried")))
        .drop("_day", "_in", "_carried")
    )


def first_per(df: DataFrame, keys: list[str], order: list, keep: list[str] | None = None) -> DataFrame:
    """One whole row per key, the smallest by ``order``; no sort, map-side combined."""
    rest = [c for c in (keep or df.columns) if c not in keys]
    ranked = [col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked, *rest)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in rest])


def window_join(
    windows: DataFrame,
    events: DataFrame,
    on: list[str],
    start,
    end,
    at: str,
    days: int = 32,
    closed: str = "both",
) -> DataFrame:
    """Events inside windows, joined on (key, time bucket).

    A window is repeated once per bucket it covers, an event sits in one
    bucket, so a key's rows are spread over its buckets and only windows near
    an event are compared with it.
    """
    lo, hi, point = col(start), col(end), F.col(at)
    first = F.floor(epoch_day(lo) / days)
    last = F.floor(epoch_day(hi) / days)
    left = windows.where(lo <= hi).withColumn("_bucket", F.explode(F.sequence(first, last)))
    right = events.withColumn("_bucket", F.floor(epoch_day(at) / days))
    above = point >= lo if closed in ("both", "left") else point > lo
    below = point <= hi if closed in ("both", "right") else point < hi
    return left.join(right, [*on, "_bucket"]).where(above & below).drop("_bucket")


def overlap_join(
    left: DataFrame, right: DataFrame, on: list[str], left_span: tuple, right_span: tuple, days: int = 32
) -> DataFrame:
    """Pairs of overlapping closed day spans, each pair once.

    Both sides are repeated over their buckets; a pair is kept only in the
    first bucket the two spans share.
    """
    ls, le = (col(c) for c in left_span)
    rs, re = (col(c) for c in right_span)
    bucket = lambda c: F.floor(epoch_day(c) / days)
    a = left.where(ls <= le).withColumn("_bucket", F.explode(F.sequence(bucket(ls), bucket(le))))
    b = right.where(rs <= re).withColumn("_bucket", F.explode(F.sequence(bucket(rs), bucket(re))))
    same = F.col("_bucket") == F.greatest(bucket(ls), bucket(rs))
    return a.join(b, [*on, "_bucket"]).where(same & (ls <= re) & (rs <= le)).drop("_bucket")


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the one named in ``spark.checkpoint.dir``.

    A temporary folder is chosen only in local mode with nothing set (tests).
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if "local" not in _FOLDERS:
        _FOLDERS["local"] = tempfile.mkdtemp(prefix="wardflow-")
    return _FOLDERS["local"]


_FOLDERS: dict[str, str] = {}


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the time of a write; ``__`` stands for the dots of a name."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def writing(spark: SparkSession, co_located: bool = False):
    """Settings of a write of an intermediate table: its shuffle files go when it has ended, as nothing reads them again.

    ``co_located``: rows that lie in buckets of one key are also joined on that key and
    others where they are; a key's rows then stay in the task of its bucket.
    """
    more = {"spark__sql__requireAllClusterKeysForCoPartition": "false"} if co_located else {}
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", **more)


def durable(df: DataFrame, co_located: bool = False) -> DataFrame:
    """Cut lineage: write the rows as a Parquet table in the shared folder and read it back.

    Unlike a cached or local copy the table survives lost executors, and unlike
    an RDD checkpoint it keeps column pruning and size statistics.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with writing(spark, co_located):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a bucket's leading table, and the bounds of the number of buckets.
BUCKET_ROWS, LEAST_FILES, MOST_FILES = 20_000, 8, 1024


def bucket_count(leading: DataFrame) -> int:
    """Number of buckets for tables that grow with ``leading``."""
    return min(MOST_FILES, max(LEAST_FILES, leading.count() // BUCKET_ROWS))


def bucketed(df: DataFrame, key: str, buckets: int, table: str | None = None) -> str:
    """Write rows dealt by a hash of ``key`` to a table, a new one or one to append to, and return its name.

    Groupings and windows that hold the key read it without a shuffle.
    """
    table = table or f"bucketed_{uuid.uuid4().hex}"
    path = f"{shared_folder(df.sparkSession)}/{table}"
    with writing(df.sparkSession, co_located=True):
        df.repartition(buckets, key).write.bucketBy(buckets, key).format("parquet").option("compression", "zstd").option("path", path).mode("append").saveAsTable(table)
    return table


#: Buckets of a pass, and the most passes.
PASS_BUCKETS, MOST_PASSES = 8, 16


def place_of(df: DataFrame, key: str) -> int | None:
    """Number of buckets of a written table that lies in buckets of ``key``; None of all other rows."""
    plan = df._jdf.queryExecution().sparkPlan()
    there = plan.outputPartitioning()
    return there.numPartitions() if plan.getClass().getSimpleName() == "FileSourceScanExec" and there.toString().startswith(f"hashpartitioning({key}#") else None


def buckets_of(df: DataFrame, key: str = "person_id") -> int:
    """Number of buckets of a table in buckets of ``key``, else the one for a table of this size."""
    return place_of(df, key) or bucket_count(df)


def in_passes(df: DataFrame, key: str, step: Callable[[DataFrame], DataFrame], buckets: int | None = None, passes: int | None = None, table: str | None = None) -> DataFrame:
    """``step`` of all rows, a group of keys after the other, written in buckets of ``key``.

    ``step`` must not bring rows of several keys together.  Every pass reads ``df``, which
    is to be a written table, and shuffles its share of the rows only; its shuffle files
    go when it has ended, so the disk in use is that of one pass and the result.
    """
    buckets = buckets or buckets_of(df, key)
    passes = passes or max(1, min(MOST_PASSES, buckets // PASS_BUCKETS))
    group = F.pmod(F.hash(key), F.lit(buckets)) % passes
    table = table or f"bucketed_{uuid.uuid4().hex}"
    for g in range(passes):
        bucketed(step(df if passes == 1 else df.where(group == g)), key, buckets, table)
    return df.sparkSession.table(table)


def dense_index(df: DataFrame, order: list, out: str, start: int = 0) -> DataFrame:
    """Number rows by a global order without a one-task window.

    Range-sort, write the sorted rows with their partition number, count per
    partition, add the counts of the earlier partitions.  The offsets table has
    one row per shuffle partition, which bounds the broadcast.
    """
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    ordered = durable(
        ordered.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
            "_pos", F.col("_mid").bitwiseAND((1 << 33) - 1)
        )
    )
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
        .drop("_n")
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_pos") + F.col("_off") + start).cast("bigint"))
        .drop("_mid", "_part", "_pos", "_off")
    )


def bucket_prefix(df: DataFrame, keys: list[str], bucket: str, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Running sums over an order, split by an explicit bucket column.

    ``bucket`` must not decrease along ``order``; rows of one key are spread
    over its buckets and only bucket totals meet in one task.
    """
    inner = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    for n in sums:
        totals = totals.withColumn(f"_b_{n}", F.coalesce(F.sum(f"_t_{n}").over(outer), F.lit(0)))
    totals = totals.drop(*[f"_t_{n}" for n in sums])
    out = df
    for n, c in sums.items():
        out = out.withColumn(f"_w_{n}", F.sum(c).over(inner))
    out = out.join(totals, [*keys, bucket])
    for n in sums:
        out = out.withColumn(n, F.col(f"_w_{n}") + F.col(f"_b_{n}"))
    return out.drop(*[f"_w_{n}" for n in sums], *[f"_b_{n}" for n in sums])


#: Distinct values that a value bucket is to hold, and the bounds of their number.
BUCKET_VALUES, LEAST_BUCKETS, MOST_BUCKETS = 50_000, 16, 4096


def value_order(df: DataFrame, keys: list[str], value: str, sums: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Distinct values per key with running sums in ascending value order.

    Rows are first summed per (key, value) and written.  Approximate quantiles of each
    key then cut its values into ordered buckets, their number taken from the counted
    values, so a key with many distinct values is spread over many window groups; the
    sums themselves are exact.  ``sums`` maps a new running column to a summed one; the
    per-value sums keep the source names.
    """
    sources = list(dict.fromkeys(sums.values()))
    distinct = durable(df.groupBy(*keys, value).agg(*[F.sum(c).alias(c) for c in sources]))
    buckets = buckets or min(MOST_BUCKETS, max(LEAST_BUCKETS, distinct.count() // BUCKET_VALUES))
    points = F.percentile_approx(value, [i / buckets for i in range(1, buckets)], 20 * buckets).alias("_cuts")
    # Without keys there is one row of cuts.
    cut = distinct.join(distinct.groupBy(*keys).agg(points), keys) if keys else attach(distinct, distinct.agg(points))
    cut = cut.withColumn("_vb", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    return bucket_prefix(cut, keys, "_vb", [value], sums).drop("_vb")


def values_at_ranks(df: DataFrame, key: str | list[str], value: str, ranks, copies: str | None = None) -> DataFrame:
    """(key, value, ranks, total): the values at wanted 0-based ranks of each key's rows, exact and over all of them.

    ``ranks`` turns the column of a key's number of rows into an array; ``copies`` names a
    column that says how often a row counts.  Counted distinct values are cut into
    ordered buckets by approximate quantiles; bucket counts say which buckets hold a
    wanted rank, and only those are put in order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    distinct = durable(df.groupBy(*keys, value).agg((F.sum(copies) if copies else F.count(F.lit(1))).alias("_n")))
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, distinct.count() // BUCKET_VALUES))
    cuts = distinct.groupBy(*keys).agg(F.percentile_approx(value, [i / buckets for i in range(1, buckets)], 20 * buckets).alias("_cuts"))
    cut = durable(distinct.join(cuts, keys).withColumn("_vb", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts"))
    order = Window.partitionBy(*keys).orderBy("_vb").rowsBetween(Window.unboundedPreceding, -1)  # at most ``buckets`` rows a key
    sizes = cut.groupBy(*keys, "_vb").agg(F.sum("_n").alias("_size")).withColumn("_before", F.coalesce(F.sum("_size").over(order), F.lit(0)))
    sizes = durable(sizes)
    totals = sizes.groupBy(*keys).agg(F.sum("_size").alias("total"))
    within = lambda lo, hi: (lambda r: (r >= lo) & (r < hi))
    wanted = sizes.join(totals, keys).withColumn("_r", F.filter(ranks(F.col("total")), within(F.col("_before"), F.col("_before") + F.col("_size")))).where(F.size("_r") > 0)
    inner = Window.partitionBy(*keys, "_vb").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before") + F.sum("_n").over(inner)
    held = cut.join(wanted.select(*keys, "_vb", "_before", "_r", "total"), [*keys, "_vb"]).withColumn("_upto", upto)
    found = held.withColumn("ranks", F.filter("_r", within(F.col("_upto") - F.col("_n"), F.col("_upto"))))
    return found.where(F.size("ranks") > 0).select(*keys, value, "ranks", "total")


def hash_rank(df: DataFrame, keys: list[str], hashed: Column, out: str = "rank") -> DataFrame:
    """0-based rank by a hex hash within ``keys``, split by the hash head.

    md5 text is uniform, so its first three digits cut every key (or the whole
    table) into 4,096 even buckets; only the bucket counts meet in one task.
    """
    cut = df.withColumn("_h", hashed).withColumn("_hb", F.substring("_h", 1, 3)).withColumn("_one", F.lit(1))
    ranked = bucket_prefix(cut, keys, "_hb", ["_h"], {"_cum": "_one"})
    return ranked.withColumn(out, (F.col("_cum") - 1).cast("bigint")).drop("_h", "_hb", "_one", "_cum")


def from_rank(df: DataFrame, hashed: Column, first: DataFrame) -> DataFrame:
    """Rows whose 0-based ``hash_rank`` is at least ``rank``, a column of the one-row table ``first``.

    The counts of the 4,096 buckets say in which one the rank lies; the rows of that
    bucket only are put in order, all others are kept or left out by their bucket.
    """
    cut = df.withColumn("_h", hashed).withColumn("_hb", F.substring("_h", 1, 3))
    order = Window.orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("_hb").agg(F.count(F.lit(1)).alias("_size")).withColumn("_before", F.coalesce(F.sum("_size").over(order), F.lit(0)))
    marks = durable(attach(sizes, first.select(F.col("rank").alias("_first"))).where("_before + _size > _first"))
    held = cut.join(F.broadcast(marks.select("_hb", "_before", "_first")), "_hb")
    whole = held.where("_before >= _first").select(*df.columns)
    ranked = held.where("_before < _first").withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("_hb").orderBy("_h")) - 1)
    return whole.unionByName(ranked.where("_rank >= _first").select(*df.columns))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row (equi-join on a constant)."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small constant table as a local relation (no Python worker)."""
    def text(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{v!r}D" if isinstance(v, float) else str(v)

    fields = [f.strip().split(" ") for f in schema.split(",")]
    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST(c{i} AS {t}) AS {n}" for i, (n, t) in enumerate(fields))
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS v({names})")
