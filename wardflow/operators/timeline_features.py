"""Features at label days and sequence summaries over the timeline.

A label is (person_id, day_index); feature rows are (person_id, day_index,
column, value).  Counts up to a label day are running sums over one merged order
of a person's days with a code and label days, read at the label days; label days
are never paired with events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import key_hash, sha256_mod
from ..functions.segments import attach, bucketed, buckets_of, dense_index, durable, hash_rank, in_passes, place_of, union_all, value_order, values_at_ranks
from . import timeline as T

#: Values in a range of a code, the number of values from which it gets no more ranges, and the least frequency of a text result.
LAB_SPLIT_SIZE, LAB_VALUES, TEXT_MIN = 500, 10000, 100
# Text results read as negative or positive, and those read as no result.
NEGATIVE_TEXTS = ["n", "neg", "neg.", "not detected", "none", "none seen", "nosee", "nr", "non reactive", "non-reactive"]
POSITIVE_TEXTS = ["p", "pos", "pos.", "reactive"]
NO_RESULT_TEXTS = [
    "not applicable", "see below:", "see below", "see report", "see note", "note:", "note", "null", "cancelled",
    "dnr", "dnrtnp", "qns", "nt", "nolav", "performed", "n/a", "sprcs", "prc",
]


def label_days(labels: DataFrame, days: DataFrame) -> DataFrame:
    """Label days with day and age; two labels on one day are an error."""
    n = F.count(F.lit(1))
    unique = labels.groupBy("person_id", "day_index").agg(n.alias("_n")).withColumn(
        "day_index", F.when(F.col("_n") > 1, F.raise_error(F.lit("two labels on one day"))).otherwise(F.col("day_index"))).drop("_n")
    return unique.join(days.select("person_id", "day_index", "day", "age"), ["person_id", "day_index"])


def beside(rows: DataFrame, leading: DataFrame) -> DataFrame:
    """Rows of persons written in as many buckets as ``leading`` has; a table that is so already is taken as it is."""
    buckets = buckets_of(leading)
    return rows if place_of(rows, "person_id") == buckets else rows.sparkSession.table(bucketed(rows, "person_id", buckets))


def age_statistics(points: DataFrame) -> DataFrame:
    """Mean, sample variance and deviation of the ages at label days (fitted state)."""
    return points.agg(F.avg("age").alias("mean"), F.var_samp("age").alias("variance"), F.stddev_samp("age").alias("deviation"))


def age_feature(points: DataFrame, fitted: DataFrame | None = None) -> DataFrame:
    """Age at the label day, standardised when a fitted state is given."""
    if fitted is None:
        return points.select("person_id", "day_index", F.lit(0).alias("column"), F.col("age").cast("double").alias("value"))
    value = F.try_divide(F.col("age") - F.col("mean"), F.col("deviation"))
    return attach(points, fitted).select("person_id", "day_index", F.lit(0).alias("column"), value.alias("value"))


def icd10_era(points: DataFrame) -> DataFrame:
    return points.select("person_id", "day_index", F.lit(0).alias("column"), (F.year("day") >= 2016).cast("double").alias("value"))


def constant(points: DataFrame, value: float) -> DataFrame:
    return points.select("person_id", "day_index", F.lit(0).alias("column"), F.lit(value).alias("value"))


def from_values(points: DataFrame, values: DataFrame) -> DataFrame:
    """Features taken from labels or precomputed values on (person_id, day_index)."""
    return points.join(values, ["person_id", "day_index"]).select(
        "person_id", "day_index", F.lit(0).alias("column"), F.col("value").cast("double").alias("value"))


def counted_codes(events: DataFrame, recorded: DataFrame | Column, closure: DataFrame | None = None, excluded: list[str] = ()) -> DataFrame:
    """Bare recorded-date codes per patient day, rolled up to ancestors when asked; written in buckets of persons.

    ``recorded``: a table of codes, or a test of a row's code, which needs no join.
    """
    def counts(rows):
        kept = rows.where(~T.valued()).where(~F.col("code").isin(*excluded))
        if closure is not None:
            kept = kept.join(recorded_closure(recorded, closure), "code").withColumn("code", F.col("ancestor"))
        else:
            kept = kept.where(recorded) if isinstance(recorded, Column) else kept.join(recorded.select("code"), "code", "left_semi")
        return kept.groupBy("person_id", F.col("code").alias("concept_id"), F.col("day").alias("at")).agg(F.count(F.lit(1)).alias("n"))

    # A test of the rows themselves shuffles nothing.
    return in_passes(events, "person_id", counts, passes=1 if closure is None and isinstance(recorded, Column) else None)


def recorded_closure(recorded: DataFrame | Column, closure: DataFrame) -> DataFrame:
    """Ancestors of the recorded codes only, so that events meet one table instead of two."""
    kept = closure.where(recorded) if isinstance(recorded, Column) else closure.join(recorded.select("code"), "code", "left_semi")
    return kept.select("code", "ancestor")


def bins_before(time_bins: list[int | None] | None, strictly: bool = False) -> list[int]:
    """Last day of each count bin as an offset from the label day; the last bin must be open."""
    last = -1 if strictly else 0
    if time_bins is None:
        return [last]
    if time_bins[-1] is not None:
        raise ValueError("the last time bin must be open (None)")
    return [last] + [-b - 1 for b in time_bins[:-1]]


def counts_before(points: DataFrame, counted: DataFrame, ends: list[int], step: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(person_id, day_index, concept_id, bin, n): counts of each code in the bins that end at falling offsets from the label day.

    ``counted`` holds ``n`` per person, code and day (``at``); ``step`` is done to it
    first.  A label day meets only the codes the person has had by then, which are rows
    of the result.  Per person and code these and the days with events are put in one
    order; a bin is the difference of two running sums over it.  Both kinds of rows are
    one per day at most, and a life has fewer than 60,000 days.  Both are written to
    one table in buckets of persons, so that their order needs no shuffle.
    """
    columns = ["person_id", "concept_id", "at", "n", "day_index"]
    shaped = lambda rows: (step(rows) if step else rows).withColumn("day_index", F.lit(None).cast("bigint")).select(*columns)
    table, buckets = f"bucketed_{uuid.uuid4().hex}", place_of(counted, "person_id") or buckets_of(points)
    counted = in_passes(counted, "person_id", shaped, buckets, None if step else 1, table)
    first = counted.groupBy("person_id", "concept_id").agg(F.min("at").alias("_first"))
    labelled = beside(points, counted).select("person_id", F.col("day_index").cast("bigint").alias("day_index"), F.col("day").alias("at"))
    had = F.col("_first") <= F.date_add("at", ends[0])
    probes = labelled.alias("l").join(first.alias("f"), (F.col("l.person_id") == F.col("f.person_id")) & had).select(
        "f.person_id", "f.concept_id", "l.at", F.lit(0).cast("bigint").alias("n"), "l.day_index")
    bucketed(probes.select(*columns), "person_id", buckets, table)
    # Rows without a person meet no label day and are not put in order.
    merged = counted.sparkSession.table(table).where("person_id IS NOT NULL")
    order = Window.partitionBy("person_id", "concept_id").orderBy("_d")
    upto = [F.coalesce(F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, e)), F.lit(0)).alias(f"_r{i}") for i, e in enumerate(ends)]
    read = merged.withColumn("_d", F.unix_date("at")).select("person_id", "day_index", "concept_id", *upto).where(F.col("day_index").isNotNull())
    later = [F.col(f"_r{i + 1}") for i in range(len(ends) - 1)] + [F.lit(0)]
    bins = F.array(*[F.struct(F.lit(i).alias("bin"), (F.col(f"_r{i}") - end).alias("n")) for i, end in enumerate(later)])
    day = points.schema["day_index"].dataType
    return read.select("person_id", F.col("day_index").cast(day).alias("day_index"), "concept_id", F.inline(bins)).where("n > 0")


def count_vocabulary(counted: DataFrame) -> DataFrame:
    return dense_index(counted.select("concept_id").distinct(), ["concept_id"], "code_column")


def count_features(
    points: DataFrame, counted: DataFrame, vocabulary: DataFrame, time_bins=None, binary: bool = False, strictly: bool = False
) -> DataFrame:
    """Counts of each code up to the label day, in time bins when given."""
    # The days with a code, which are fewer than the counts of it, meet the vocabulary.
    numbered = lambda rows: rows.join(vocabulary, "concept_id").select("person_id", F.col("code_column").alias("concept_id"), "at", "n")
    hits = counts_before(points, counted, bins_before(time_bins, strictly), numbered)
    size = vocabulary.agg(F.count(F.lit(1)).alias("_size"))
    value = F.lit(1.0) if binary else F.col("n").cast("double")
    return attach(hits, size).select(
        "person_id", "day_index", (F.col("concept_id") + F.col("bin") * F.col("_size")).alias("column"), value.alias("value"))


def combine(parts: list[tuple[DataFrame, DataFrame | int]]) -> DataFrame:
    """Side-by-side matrix: each part's columns start after those of the parts before it.

    A part comes with its number of columns, a number or a one-row table (``_size``).
    """
    frames, offsets, fixed = [], [], 0
    for triples, size in parts:
        shifted = triples.withColumn("column", F.col("column") + fixed)
        for table in offsets:
            shifted = attach(shifted, table).withColumn("column", F.col("column") + F.col("_size")).drop("_size")
        frames.append(shifted.withColumn("column", F.col("column").cast("bigint")))
        if isinstance(size, int):
            fixed += size
        else:
            offsets.append(size)
    return union_all(frames)


def numeric_bins(events: DataFrame, recorded: DataFrame, num_bins: int = 10, min_per_bin: int = 1) -> DataFrame:
    """Bins of numeric values per code: (code, low, high, bin_column).

    Edges are the order statistics at round((n-1) * i / num_bins), exact, from
    running counts over distinct values; bins with too few values join the next
    one (a fold over at most ``num_bins`` entries).
    """
    # Values are counted before they meet the recorded codes, so a code of many values is not dealt to one task.
    values = (
        events.where(F.col("numeric_value").isNotNull()).groupBy("code", F.col("numeric_value").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .join(recorded.select("code"), "code", "left_semi")
    )
    ordered = durable(value_order(values, ["code"], "value", {"upto": "n"}))
    totals = ordered.groupBy("code").agg(F.sum("n").alias("total"))
    ranks = F.array(*[F.bround((F.col("total") - 1) * (i + 1) / num_bins) for i in range(num_bins - 1)])
    placed = ordered.join(totals, "code").withColumn(
        "_hits", F.filter(ranks, lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto"))))
    # Equal ranks of one value are equal edges; at most num_bins - 1 edges per code.
    edges = placed.where(F.size("_hits") > 0).select("code", F.explode("_hits"), "value").groupBy("code").agg(
        F.concat(F.array(F.lit(float("-inf"))), F.sort_array(F.collect_list("value"))).alias("edges"))
    slot = F.size(F.filter("edges", lambda e: e <= F.col("value"))) - 1
    counts = ordered.join(edges, "code").groupBy("code", "edges", slot.alias("slot")).agg(F.sum("n").alias("n"))
    table = counts.groupBy("code", "edges").agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("by_slot"))
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit(None).cast("double").alias("low"), F.array().cast("array<double>").alias("out"))

    def fold(s, i):
        count = F.coalesce(F.col("by_slot")[i], F.lit(0)) + s["carry"]
        edge, full = F.get("edges", i), count >= min_per_bin
        return F.struct(
            F.when(full, 0).otherwise(count).cast("bigint").alias("carry"),
            F.when(~full, F.coalesce(s["low"], edge)).alias("low"),
            F.when(full, F.concat(s["out"], F.array(F.coalesce(s["low"], edge)))).otherwise(s["out"]).alias("out"),
        )

    kept = table.select("code", F.aggregate(F.sequence(F.lit(0), F.size("edges") - 1), start, fold)["out"].alias("lows"))
    rows = kept.select("code", "lows", F.posexplode("lows").alias("slot", "low")).withColumn("high", F.get("lows", F.col("slot") + 1)).drop("lows")
    return dense_index(rows, ["code", "slot"], "bin_column").drop("slot")


def numeric_bin_features(points: DataFrame, events: DataFrame, bins: DataFrame) -> DataFrame:
    """Counts of numeric values per fitted bin up to the label day; values below the first bin go to the last one."""
    values = events.where(F.col("numeric_value").isNotNull()).groupBy("person_id", "code", "day", F.col("numeric_value").alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    inside = (F.col("v") >= F.col("low")) & (F.col("high").isNull() | (F.col("v") < F.col("high")))
    binned = values.join(bins, "code").where(inside).groupBy(
        "person_id", F.col("bin_column").alias("concept_id"), F.col("day").alias("at")).agg(F.sum("n").alias("n"))
    hits = counts_before(points, binned, [0])
    return hits.select("person_id", "day_index", F.col("concept_id").alias("column"), F.col("n").cast("double").alias("value"))


def encode(df: DataFrame, dictionary: DataFrame, word: str, index: str) -> DataFrame:
    return df.join(dictionary.select(word, index).hint("shuffle_hash"), word).drop(word)


def decode(df: DataFrame, dictionary: DataFrame, word: str, index: str) -> DataFrame:
    return df.join(dictionary.select(word, index), index).drop(index)


def inpatient_day_rows(
    events: DataFrame, days: DataFrame, admissions: DataFrame, recorded: DataFrame, horizon: int = 180, min_patients: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """(points, counts) of in-stay days from the third record day on.

    A day counts when the patient is alive and either dies within the horizon
    or is followed up for it; code counts are taken strictly before the day,
    over codes held by more than ``min_patients`` patients.
    """
    death = events.where(F.col("code").startswith("Death Type/")).groupBy("person_id").agg(F.min("age").alias("_death"))
    stay_days = admissions.select("person_id", F.explode(F.sequence("start_age", "end_age")).alias("age")).distinct()
    left = F.col("_death") - F.col("age")
    points = beside(
        days.where("day_index >= 2").join(stay_days, ["person_id", "age"], "left_semi").join(death, "person_id", "left")
        .where(F.col("_death").isNull() | (left > 0))
        .withColumn("label", F.when(left <= horizon, 1).when(F.col("last_age") - F.col("age") >= horizon, 0))
        .where(F.col("label").isNotNull()).select("person_id", "day_index", "day", "age", "label"), days)
    counted = counted_codes(events, recorded)
    common = counted.select("concept_id", "person_id").distinct().groupBy("concept_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_patients)
    common = durable(common.select("concept_id"))
    hits = counts_before(points, counted, [-1], lambda rows: rows.join(common, "concept_id", "left_semi"))
    return points, hits.select("person_id", "day_index", F.col("concept_id").alias("code"), F.col("n").alias("value"))


# ---- sequence summaries ----------------------------------------------------


def window_lengths(days: DataFrame, train: tuple[str, str], val: tuple[str, str]) -> DataFrame:
    """Record length per patient up to each window's end; at least three days and one inside the window."""
    day = F.col("day")
    between = lambda a, b: (day >= F.lit(a).cast("date")) & (day < F.lit(b).cast("date"))
    before = lambda b: day < F.lit(b).cast("date")
    n = lambda c: F.sum(c.cast("int"))
    sizes = days.groupBy("person_id").agg(
        n(before(train[1])).alias("train_length"), n(between(*train)).alias("_t"), n(before(val[1])).alias("val_length"), n(between(*val)).alias("_v"))
    keep = lambda length, inside: F.when((F.col(length) >= 3) & (F.col(inside) > 0), F.col(length))
    return sizes.select("person_id", keep("train_length", "_t").alias("train_length"), keep("val_length", "_v").alias("val_length")).where(
        F.col("train_length").isNotNull() | F.col("val_length").isNotNull())


def age_gap_statistics(days: DataFrame, train_end: str) -> DataFrame:
    """Mean and deviation of ages and gaps before the window's end, plain and log(1 + x)."""
    gap = F.col("age") - F.coalesce(F.lag("age").over(Window.partitionBy("person_id").orderBy("age")), F.lit(0))
    rows = days.withColumn("gap", gap).where((F.col("day") < F.lit(train_end).cast("date")) & (F.col("age") > 0))
    out = []
    for name, column in (("age", F.col("age")), ("delta", F.col("gap"))):
        for stem, value in ((name, column), (f"{name}_log", F.log1p(column))):
            out += [F.avg(value).alias(f"{stem}_mean"), F.stddev_samp(value).alias(f"{stem}_std")]
    return rows.agg(*out)


def patients_per_code(events: DataFrame, recorded: DataFrame, closure: DataFrame, patients: DataFrame, end: str) -> DataFrame:
    """Patients holding each code or a descendant before the window's end."""
    held = (
        events.where(F.col("day") < F.lit(end).cast("date")).select("person_id", "code").distinct()
        .join(patients.select("person_id"), "person_id", "left_semi")
    )
    rolled = held.join(recorded_closure(recorded, closure), "code").select("person_id", F.col("ancestor").alias("code")).distinct()
    return rolled.groupBy("code").agg(F.count(F.lit(1)).alias("n_patients"))


def valid_codes(counts: DataFrame, edges: DataFrame, closure: DataFrame, root: str, min_patients: int) -> DataFrame:
    """Codes with enough patients, a path to the root and a sibling with enough patients, by descending count."""
    enough = counts.where(F.col("n_patients") >= min_patients)
    rooted = enough.join(closure.where((F.col("ancestor") == root) & (F.col("code") != root)).select("code"), "code", "left_semi")
    links = edges.select("code", "parent").distinct().join(enough.select("code"), "code", "left_semi")
    # A code has a sibling when one of its parents has two such children.
    families = links.groupBy("parent").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1")
    paired = links.join(families, "parent", "left_semi").select("code").distinct()
    return dense_index(rooted.join(paired, "code", "left_semi"), [F.col("n_patients").desc(), "code"], "valid_index")


def choose_patients(people: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None,
                    exclude_ratio: float = 0.0, seed: int = 0) -> DataFrame:
    """Include and exclude lists, then an exact share left out by hash rank."""
    out = people.select("person_id").distinct()
    if include is not None:
        out = out.join(include.select("person_id"), "person_id", "left_semi")
    if exclude is not None:
        out = out.join(exclude.select("person_id"), "person_id", "left_anti")
    if exclude_ratio:
        total = out.agg(F.count(F.lit(1)).alias("_n"))
        ranked = attach(hash_rank(out, [], key_hash("person_id", seed=seed)), total)
        out = ranked.where(F.col("rank") >= F.floor(F.col("_n") * exclude_ratio)).select("person_id")
    return out


def frequency_table(counts: DataFrame, floors=(10, 25, 50, 100, 1000)) -> DataFrame:
    """Number of codes with at least each number of patients."""
    at_least = F.explode(F.array(*[F.lit(f) for f in floors])).alias("at_least")
    return counts.select("n_patients", at_least).groupBy("at_least").agg(
        F.sum((F.col("n_patients") >= F.col("at_least")).cast("bigint")).alias("n_codes"))


def day_codes(events: DataFrame, recorded: DataFrame | Column, closure: DataFrame, valid: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Distinct (person_id, age, code) with every ancestor of the day's recorded codes; written in buckets of persons.

    With ``valid`` the ancestors carry its ``valid_index``, joined ``how`` before they meet the days.
    """
    above = recorded_closure(recorded, closure).select("code", F.col("ancestor").alias("up"))
    if valid is not None:
        above = above.join(valid.select(F.col("code").alias("up"), "valid_index"), "up", how)
    above = durable(above)

    def rolled(rows):
        bare = rows.select("person_id", "age", "code").distinct()
        return bare.join(above, "code").drop("code").withColumnRenamed("up", "code").repartition(buckets, "person_id").distinct()

    buckets = buckets_of(events)
    return in_passes(events, "person_id", rolled, buckets)


def day_rows(days: DataFrame, codes: DataFrame, valid: DataFrame, statistics: DataFrame) -> DataFrame:
    """Per day: valid code indices, standardised age, log age, gap, log gap and a birth flag."""
    indexed = codes if "valid_index" in codes.columns else codes.join(valid.select("code", "valid_index"), "code")
    indexed = indexed.where("valid_index IS NOT NULL").groupBy("person_id", "age").agg(
        F.sort_array(F.collect_set("valid_index")).alias("codes"))
    gap = F.col("age") - F.coalesce(F.lag("age").over(Window.partitionBy("person_id").orderBy("age")), F.lit(0))
    rows = attach(days.withColumn("gap", gap), statistics).join(indexed, ["person_id", "age"], "left")
    birth = F.col("age") == 0
    scaled = lambda v, s: F.when(birth, 0.0).otherwise(F.try_divide(v - F.col(f"{s}_mean"), F.col(f"{s}_std")))
    return rows.select(
        "person_id", "day_index", F.coalesce("codes", F.array().cast("array<bigint>")).alias("codes"),
        scaled(F.col("age"), "age").alias("age_z"), scaled(F.log1p("age"), "age_log").alias("log_age_z"),
        scaled(F.col("gap"), "delta").alias("gap_z"), scaled(F.log1p("gap"), "delta_log").alias("log_gap_z"),
        birth.cast("int").alias("is_birth"),
    )


def next_day_targets(days: DataFrame, codes: DataFrame, edges: DataFrame, valid: DataFrame) -> DataFrame:
    """Targets of each day, placed on the day before it.

    Positives are the day's codes with ancestors; negatives are the children of
    positives that are absent; ``seen`` marks codes present on an earlier day.  A day
    row carries its codes and those its person had before, so negatives are formed
    and checked one at a time and neither dealt nor sorted; a child of several
    positives comes from the first of them.
    """
    index = valid.select("code", "valid_index")
    links = edges.select("code", "parent").distinct().join(index, "code")
    parents = links.groupBy("code").agg(F.collect_set("parent").alias("_all"))
    before = F.filter("_all", lambda q: q < F.col("parent"))
    families = links.join(parents, "code").groupBy(F.col("parent").alias("_parent")).agg(
        F.collect_list(F.struct("valid_index", before.alias("before"))).alias("_kids"))
    held = codes if "valid_index" in codes.columns else codes.join(index, "code", "left")
    firsts = held.where(F.col("valid_index").isNotNull()).groupBy("person_id", "valid_index").agg(F.min("age").alias("first")).groupBy("person_id").agg(
        F.collect_list(F.struct("valid_index", "first")).alias("_firsts"))
    earlier = F.transform(F.filter("_firsts", lambda f: f["first"] < F.col("age")), lambda f: f["valid_index"])
    rows = (
        held.groupBy("person_id", "age").agg(F.collect_set("code").alias("_codes"), F.collect_set("valid_index").alias("_has"))
        .join(days.select("person_id", "age", "day_index").where("day_index > 0"), ["person_id", "age"])
        .join(firsts, "person_id", "left")
        .select("person_id", (F.col("day_index") - 1).alias("day_index"), "_codes", "_has", F.coalesce(earlier, F.array().cast("array<bigint>")).alias("_earlier"))
    )
    rows = durable(rows, co_located=True)
    present = rows.select("person_id", "day_index", "_earlier", F.explode("_has").alias("valid_index"), F.lit(1).alias("target"))
    children = rows.withColumn("_parent", F.explode("_codes")).join(families, "_parent").withColumn("_kid", F.explode("_kids"))
    absent = children.where(~F.array_contains("_has", F.col("_kid.valid_index")) & ~F.arrays_overlap("_codes", "_kid.before")).select(
        "person_id", "day_index", "_earlier", F.col("_kid.valid_index").alias("valid_index"), F.lit(0).alias("target"))
    return present.unionByName(absent).select("person_id", "day_index", "valid_index", "target", F.array_contains("_earlier", F.col("valid_index")).cast("int").alias("seen"))


def leaf_codes(valid: DataFrame, edges: DataFrame, leaf_vocabularies: list[str], prefix_vocabularies: list[str], prefix_length: int = 3) -> DataFrame:
    """Leaf prediction targets: valid codes without valid children, or category codes of a fixed length."""
    vocabulary, rest = F.split("code", "/")[0], F.split("code", "/")[1]
    inner = edges.join(valid.select("code"), "code", "left_semi").select(F.col("parent").alias("code")).distinct()
    leaves = valid.where(vocabulary.isin(*leaf_vocabularies)).join(inner, "code", "left_anti").select("code")
    short = valid.where(vocabulary.isin(*prefix_vocabularies) & (F.length(rest) == prefix_length)).select("code")
    return dense_index(leaves.unionByName(short).distinct(), ["code"], "leaf_index")


def entropy_candidates(counts: DataFrame, edges: DataFrame, closure: DataFrame, node: str, min_patients: int) -> DataFrame:
    """Codes below a node scored by the information of the child given its parent."""
    below = closure.where(F.col("ancestor") == node).select("code")
    child = counts.where(F.col("n_patients") >= min_patients).select("code", F.col("n_patients").alias("c"))
    parent = counts.select(F.col("code").alias("parent"), F.col("n_patients").alias("p"))
    links = edges.select("code", "parent").distinct().join(below.select(F.col("code").alias("parent")), "parent", "left_semi")
    r = F.col("c") / F.col("p")
    score = F.when(F.col("c") == F.col("p"), 0.0).otherwise(F.col("p") * (r * F.log(r) + (1 - r) * F.log(1 - r)))
    return links.join(child, "code").join(parent, "parent").select("parent", "code", score.alias("entropy"))


def six_digits(number: Column) -> Column:
    """Shortest text of a number with six significant digits; scientific below 1e-4 and from 1e6 on."""
    number = number.cast("double")
    scientific = F.format_string("%.5e", number)
    power = F.regexp_extract(scientific, r"e([+-][0-9]+)$", 1).cast("int")
    short = lambda c: F.regexp_replace(F.regexp_replace(c, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    plain = None
    for p in range(-4, 6):
        text = short(F.format_string(f"%.{5 - p}f", number))
        plain = F.when(power == p, text) if plain is None else plain.when(power == p, text)
    mantissa, exponent = F.split(scientific, "e")[0], F.split(scientific, "e")[1]
    return F.when(number == 0, "0").otherwise(F.coalesce(plain, F.concat(short(mantissa), F.lit("e"), exponent)))


def clean_text(value: Column) -> Column:
    """Lab text in lower case with common spellings of positive, negative and no result folded; ``<number`` in six digits."""
    low = F.lower(value)
    number = F.substr(low, F.lit(2)).try_cast("float")
    return (
        F.when(low.isin(*NEGATIVE_TEXTS), "negative").when(low.isin(*POSITIVE_TEXTS), "positive")
        .when(low.isin(*NO_RESULT_TEXTS) | low.startswith("tnp/"), "")
        .when(low.startswith("<") & number.isNotNull(), F.concat(F.lit("<"), six_digits(number)))
        .otherwise(low)
    )


def numeric_ranges(events: DataFrame, split_size: int = LAB_SPLIT_SIZE) -> DataFrame:
    """Inner split points per code at positions n * i / k of all its sorted values.

    k is n / ``split_size``, where values over ``LAB_VALUES`` add no more ranges, only
    sharper ones.  Repeats of the point before are skipped, the first and last distinct
    points go out.
    """
    values = events.where(F.col("numeric_value").isNotNull()).select("code", F.col("numeric_value").alias("value"))
    number = lambda total: F.floor(F.least(total, F.lit(LAB_VALUES)) / split_size).cast("int")
    place = lambda total, i: F.when(i == number(total), total - 1).otherwise(F.floor(total * i / number(total)))
    spots = lambda total: F.when(number(total) > 1, F.transform(F.sequence(F.lit(0), number(total)), lambda i: place(total, i))).otherwise(F.array().cast("array<bigint>"))
    points = values_at_ranks(values, "code", "value", spots)
    # A code has at most LAB_VALUES / split_size + 1 points.
    listed = points.groupBy("code").agg(F.sort_array(F.collect_set("value")).alias("v")).where(F.size("v") > 2)
    return listed.select("code", F.slice("v", F.lit(2), F.size("v") - 2).alias("ranges"))


def text_values(events: DataFrame, at_least: int = TEXT_MIN) -> DataFrame:
    """Cleaned text results seen more than ``at_least`` times, for codes with two or more of them; all results count."""
    cleaned = events.where(F.col("text_value").isNotNull()).select("code", clean_text(F.col("text_value")).alias("text")).where(F.col("text") != "")
    counts = cleaned.groupBy("code", "text").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > at_least)
    several = counts.groupBy("code").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1")
    return counts.join(several, "code", "left_semi")


def is_train(person: Column, seed: int) -> Column:
    """Hash split: SHA-256 of ``seed|id`` modulo ten, nine is validation."""
    text = F.concat_ws("|", F.lit(str(seed)), person.cast("string"))
    return sha256_mod(text.cast("binary"), 10, little=False) != 9
