"""Labels on patient days.

All labelers work on the day table (one row per patient day, so person windows
are bounded by the calendar) and on event tables reduced to patient days.  A
result row is (person_id, day_index, label).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import key_hash, little_endian, sha256_mod
from ..functions.segments import attach, durable, from_rank, in_passes
from . import timeline as T

ADMISSION_CODE = "Visit/IP"
MALE_CODE = "Gender/M"
ADULT_AGE_DAYS = 18 * 365.25
MORTALITY_DAYS = 180  # fixed horizon of the mortality label
OVERDOSE_DAYS, READMISSION_DAYS, CATEGORY_DAYS = 90, 30, 365
LONG_STAY_DAYS, HBA1C_LIMIT, HBA1C_GAP_DAYS = 7, 6.5, 180
# Hierarchy terms of the disease and drug labels.
OVERDOSE_TERMS = [f"ICD9CM/{c}" for c in ("E850.0", "E850.1", "E850.2", "965.00", "965.01", "965.02", "965.09")] + [
    f"ICD10CM/T40.{i}" for i in range(5)
]
OPIOID_TERMS = ["ATC/N02A"]
LUPUS_TERMS = ["ICD9CM/710.0", "ICD10CM/M32"]
CELIAC_TERMS, CELIAC_TEST_TERMS = ["ICD9CM/579.0", "ICD10CM/K90.0"], ["LNC/31017-7"]
DIABETES_TERMS, HBA1C_TERMS = ["ICD9CM/250", "ICD10CM/E08-E13"], ["LNC/4548-4"]

by_age = lambda: Window.partitionBy("person_id").orderBy("age")


def code_days(events: DataFrame, codes: DataFrame | list[str]) -> DataFrame:
    """Distinct (person_id, age) on which any of the codes occurs, bare or valued."""
    if isinstance(codes, list):
        return events.where(F.col("code").isin(*codes)).select("person_id", "age").distinct()
    codes = durable(codes.select("code"))
    hit = lambda rows: rows.select("person_id", "age", "code").join(codes, "code", "left_semi").select("person_id", "age").distinct()
    return in_passes(events, "person_id", hit)


def fixed_horizon(days: DataFrame, event_days: DataFrame, horizon: int, prediction_days: DataFrame | None = None) -> DataFrame:
    """Positive when the next event is later and within the horizon; negative only
    when the record reaches past the horizon; no row otherwise."""
    marked = days.join(event_days.select("person_id", "age", F.lit(True).alias("_event")), ["person_id", "age"], "left")
    coming = F.max(F.when(F.col("_event"), 1)).over(by_age().rangeBetween(1, horizon))
    label = F.when(coming == 1, 1).when(F.col("last_age") - F.col("age") >= horizon, 0)
    out = marked.withColumn("label", label)
    if prediction_days is not None:
        out = out.join(prediction_days.select("person_id", "day_index"), ["person_id", "day_index"], "left_semi")
    return out.where(F.col("label").isNotNull()).select("person_id", "day_index", "label")


def infinite_horizon(days: DataFrame, event_days: DataFrame) -> DataFrame:
    """Days before the first event are positive; without any event all are negative."""
    first = event_days.groupBy("person_id").agg(F.min("age").alias("_first"))
    return (
        days.join(first, "person_id", "left").where(F.col("_first").isNull() | (F.col("age") < F.col("_first")))
        .select("person_id", "day_index", F.col("_first").isNotNull().cast("int").alias("label"))
    )


def one_random_label(labels: DataFrame, seed: int) -> DataFrame:
    """One label per patient, chosen by SHA-256 of the seed and the patient id."""
    data = F.concat(little_endian(F.lit(seed), 8), little_endian(F.col("person_id"), 8))
    picks = labels.groupBy("person_id").agg(F.count(F.lit(1)).alias("_n")).select("person_id", sha256_mod(data, F.col("_n")).alias("_pick"))
    return (
        labels.withColumn("_k", F.row_number().over(Window.partitionBy("person_id").orderBy("day_index", "label")) - 1)
        .join(picks, "person_id").where(F.col("_k") == F.col("_pick"))
        .select("person_id", "day_index", "label")
    )


def year_of_history(labels: DataFrame, days: DataFrame) -> DataFrame:
    """Labels at least 365 days after the second day of the record."""
    second = days.where("day_index = 1").select("person_id", F.col("age").alias("_second"))
    return _on_days(labels, days).join(second, "person_id").where(F.col("age") >= F.col("_second") + 365).select(*labels.columns)


def _on_days(labels: DataFrame, days: DataFrame) -> DataFrame:
    return labels.join(days.select("person_id", "day_index", "age", "day"), ["person_id", "day_index"])


def restrict(
    labels: DataFrame, days: DataFrame, start=None, patients: DataFrame | None = None, min_age_days: float | None = None
) -> DataFrame:
    """Labels on or after a date, of some patients, above an age."""
    out = _on_days(labels, days)
    if start is not None:
        out = out.where(F.col("day") >= F.lit(start).cast("date"))
    if min_age_days is not None:
        out = out.where(F.col("age") >= min_age_days)
    if patients is not None:
        out = out.join(patients.select("person_id"), "person_id", "left_semi")
    return out.select(*labels.columns)


def code_label(days: DataFrame, events: DataFrame, codes, horizon: int) -> DataFrame:
    return fixed_horizon(days, code_days(events, codes), horizon)


def force_prevalence(labels: DataFrame, prevalence: float, seed: int) -> DataFrame:
    """Drop negatives at random until positives reach the prevalence; exact number."""
    sizes = labels.agg(F.sum("label").alias("_p"), F.sum(1 - F.col("label")).alias("_n"))
    too_few = F.col("_p") < prevalence * (F.col("_p") + F.col("_n"))
    wanted = F.when(too_few, F.floor(F.col("_n") - F.col("_p") * (1 - prevalence) / prevalence)).otherwise(0)
    kept = from_rank(labels.where("label = 0"), key_hash("person_id", "day_index", seed=seed), sizes.select(wanted.cast("bigint").alias("rank")))
    return labels.where("label = 1").unionByName(kept.select(*labels.columns))


def check_day_indices(labels: DataFrame, days: DataFrame) -> DataFrame:
    """Labels with an error raised for a day index outside the record."""
    sizes = days.groupBy("person_id").agg(F.max("day_index").alias("_last"))
    bad = F.col("_last").isNull() | (F.col("day_index") < 0) | (F.col("day_index") > F.col("_last"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("invalid day index of person "), F.col("person_id").cast("string")))).otherwise(F.col("day_index"))
    return labels.join(sizes, "person_id", "left").withColumn("day_index", checked).drop("_last")


def typed_label(kind: Column | str, value: Column, event: Column | None = None) -> Column:
    """Label struct with exactly one member set: binary, numeric, survival or categorical."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    is_event = F.lit(None).cast("boolean") if event is None else event
    return F.struct(
        F.when(kind == "binary", value > 0).alias("is_positive"),
        F.when(kind == "numeric", value.cast("double")).alias("numeric_value"),
        F.when(kind == "survival", F.struct(value.cast("bigint").alias("event_time"), is_event.alias("is_event"))).alias("survival"),
        F.when(kind == "categorical", value.cast("bigint")).alias("categorical_value"),
    )


def set_members(label: Column) -> Column:
    names = ("is_positive", "numeric_value", "survival", "categorical_value")
    return sum((label[n].isNotNull().cast("int") for n in names), F.lit(0))


def admissions(events: DataFrame, code: str = ADMISSION_CODE) -> DataFrame:
    """Merged inpatient intervals (start_age, end_age) at day granularity.

    One row per admission day enters the person window.
    """
    stays = events.where((F.col("code") == code) & F.col("numeric_value").isNotNull()).groupBy("person_id", "age").agg(
        F.max(F.floor("numeric_value")).cast("int").alias("_days"))
    before = by_age().rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.col("age") + F.col("_days")).over(before)
    island = F.sum(F.when(F.col("age") <= F.col("_reach"), 0).otherwise(1)).over(by_age())
    return (
        stays.withColumn("_reach", reach).withColumn("_island", island)
        .groupBy("person_id", "_island")
        .agg(F.min("age").alias("start_age"), F.max(F.col("age") + F.col("_days")).alias("end_age"))
        .drop("_island")
    )


def _day_of(days: DataFrame, table: DataFrame, age: str) -> DataFrame:
    return table.join(days.select("person_id", F.col("age").alias(age), "day_index"), ["person_id", age])


def value_above(events: DataFrame, days: DataFrame, code: str, limit: float) -> DataFrame:
    """Value above a limit, predicted from the day before; one row per value."""
    values = events.where((F.col("code") == code) & F.col("numeric_value").isNotNull()).select("person_id", "age", "numeric_value")
    return values.join(days, ["person_id", "age"]).where("day_index > 0").select(
        "person_id", (F.col("day_index") - 1).alias("day_index"), (F.col("numeric_value") > limit).cast("int").alias("label"))


def mortality(days: DataFrame, events: DataFrame, prefix: str = "Death Type/", horizon: int = MORTALITY_DAYS) -> DataFrame:
    """Death within the horizon; more than one death code is an error."""
    deaths = events.where(F.col("code").startswith(prefix))
    kinds = deaths.agg(F.count_distinct("code").alias("_kinds"))
    one = F.when(F.col("_kinds") != 1, F.raise_error(F.lit("could not find a single death code"))).otherwise(F.col("age"))
    return fixed_horizon(days, attach(deaths, kinds).select("person_id", one.alias("age")).distinct(), horizon)


def male_at_admission(days: DataFrame, events: DataFrame) -> DataFrame:
    first = days.where("day_index = 0").select("person_id", "age")
    male = code_days(events, [MALE_CODE]).join(first, ["person_id", "age"], "left_semi").select("person_id", F.lit(1).alias("_male"))
    starts = _day_of(days, admissions(events), "start_age")
    return starts.join(male, "person_id", "left").select("person_id", "day_index", F.coalesce("_male", F.lit(0)).alias("label"))


def overdose(days: DataFrame, events: DataFrame, overdose_codes: DataFrame, opioid_codes: DataFrame, horizon: int = OVERDOSE_DAYS) -> DataFrame:
    """Overdose within the horizon, predicted on days with an opioid."""
    on = code_days(events, opioid_codes).join(days, ["person_id", "age"]).select("person_id", "day_index")
    return fixed_horizon(days, code_days(events, overdose_codes), horizon, on)


def ever(days: DataFrame, events: DataFrame, codes: DataFrame) -> DataFrame:
    return infinite_horizon(days, code_days(events, codes))


def inpatient_mortality(days: DataFrame, events: DataFrame, death_code: str = T.DEATH_CODE) -> DataFrame:
    """Death inside the admission, predicted on the record day before it."""
    death = code_days(events, [death_code]).groupBy("person_id").agg(F.min("age").alias("_death"))
    died = F.coalesce(F.col("_death") <= F.col("end_age"), F.lit(False)).cast("int")
    return (
        _day_of(days, admissions(events), "start_age").join(death, "person_id", "left")
        .where((F.col("day_index") > 0) & (F.col("_death").isNull() | (F.col("_death") >= F.col("start_age"))))
        .select("person_id", (F.col("day_index") - 1).alias("day_index"), died.alias("label"))
    )


def readmission(days: DataFrame, events: DataFrame, horizon: int = READMISSION_DAYS) -> DataFrame:
    """Readmission, predicted on the first record day at or past each discharge.

    A record day serves one admission: with f_k the first day index at or past
    the k-th discharge, the day used is k + max over j <= k of (f_j - j).
    """
    stays = admissions(events)
    marks = stays.select("person_id", F.col("end_age").alias("age"), F.lit(1).alias("_end"))
    merged = days.select("person_id", "age", "day_index").unionByName(marks, allowMissingColumns=True).groupBy("person_id", "age").agg(
        F.max("day_index").alias("day_index"), F.max("_end").alias("_end"))
    ahead = by_age().rowsBetween(0, Window.unboundedFollowing)
    found = merged.withColumn("_f", F.min("day_index").over(ahead)).where("_end = 1 and _f is not null")
    nth = F.row_number().over(by_age())
    upto = by_age().rowsBetween(Window.unboundedPreceding, 0)
    used = found.withColumn("_k", nth).withColumn("day_index", F.col("_k") + F.max(F.col("_f") - F.col("_k")).over(upto))
    return fixed_horizon(days, stays.select("person_id", F.col("start_age").alias("age")), horizon, used)


def long_admission(days: DataFrame, events: DataFrame, min_days: int = LONG_STAY_DAYS) -> DataFrame:
    starts = _day_of(days, admissions(events), "start_age").where("day_index > 0")
    return starts.select("person_id", (F.col("day_index") - 1).alias("day_index"),
                         (F.col("end_age") - F.col("start_age") >= min_days).cast("int").alias("label"))


def first_test_result(
    days: DataFrame, events: DataFrame, tests: DataFrame, diagnoses: DataFrame, positive: list[str], negative: list[str]
) -> DataFrame:
    """First text result of a test, predicted from the day before; none when diagnosed earlier."""
    text = F.col("text_value")
    first = (
        events.where(text.isin(*positive, *negative)).join(tests.select("code"), "code", "left_semi")
        .join(days, ["person_id", "age"]).where("day_index > 0")
        .groupBy("person_id").agg(F.min(F.struct("age", "day_index", "code", "text_value")).alias("r"))
    )
    known = code_days(events, diagnoses).groupBy("person_id").agg(F.min("age").alias("_dx"))
    return first.join(known, "person_id", "left").where(F.col("_dx").isNull() | (F.col("_dx") >= F.col("r.age"))).select(
        "person_id", (F.col("r.day_index") - 1).alias("day_index"), F.col("r.text_value").isin(*positive).cast("int").alias("label"))


def high_hba1c(days: DataFrame, events: DataFrame, tests: DataFrame, diabetes: DataFrame,
               limit: float = HBA1C_LIMIT, gap: int = HBA1C_GAP_DAYS) -> DataFrame:
    """Test result after an earlier negative test, at most one per gap, until the first evidence of diabetes.

    The first evidence and the first negative test are minima per person.  Of the tests
    after the latter only the first of each day can count, so what is folded in order is
    at most one row per day of a life, whatever the number of tests.
    """
    values = events.where(F.col("numeric_value").isNotNull()).join(tests.select("code"), "code", "left_semi").select(
        "person_id", "age", "code", F.col("numeric_value").alias("value"))
    marks = code_days(events, diabetes).select("person_id", "age", F.lit("").alias("code"), F.lit(None).cast("double").alias("value"))
    steps = values.unionByName(marks).join(days, ["person_id", "age"]).where("day_index > 0").groupBy("person_id", "age", "code", "value", "day_index").agg(
        F.count(F.lit(1)).alias("copies"))
    high, step = F.col("value") > limit, F.struct("age", "code", "value")
    ends = steps.groupBy("person_id").agg(
        F.min(F.when(F.col("value").isNull() | high, F.col("age"))).alias("stop"), F.min(F.when(~high, step)).alias("negative"))
    # A second equal test on the day of the first negative one comes after it.
    after = (step > F.col("negative")) | ((step == F.col("negative")) & (F.col("copies") > 1))
    open_ = F.col("stop").isNull() | (F.col("age") <= F.col("stop"))
    first = steps.where("value IS NOT NULL").join(ends.where("negative IS NOT NULL"), "person_id").where(after & open_).groupBy("person_id", "age").agg(
        F.min(F.struct("code", "value", "day_index")).alias("t"))
    listed = first.groupBy("person_id").agg(F.sort_array(F.collect_list(F.struct(
        "age", (F.col("t.day_index") - 1).cast("int").alias("day_index"), (F.col("t.value") > limit).cast("int").alias("label")))).alias("tests"))
    start = F.struct(F.lit(None).cast("int").alias("last"), F.array().cast("array<struct<day_index:int,label:int>>").alias("out"))

    def fold(s, x):
        fires = s["last"].isNull() | (x["age"] - s["last"] > gap)
        label = F.struct(x["day_index"].alias("day_index"), x["label"].alias("label"))
        return F.struct(F.when(fires, x["age"]).otherwise(s["last"]).cast("int").alias("last"), F.when(fires, F.concat(s["out"], F.array(label))).otherwise(s["out"]).alias("out"))

    return listed.select("person_id", F.inline(F.aggregate("tests", start, fold)["out"]))


def treatment_choice(days: DataFrame, events: DataFrame, diagnoses: DataFrame, drug_a: DataFrame, drug_b: DataFrame) -> DataFrame:
    """First of two drugs after a diagnosis: 1 for drug A; none when it comes first or on the first day."""
    bare = events.where(~T.valued()).select("person_id", "age", "code")
    drugs = drug_a.select("code", F.lit(1).alias("_a")).unionByName(
        drug_b.join(drug_a, "code", "left_anti").select("code", F.lit(0).alias("_a"))).distinct()
    first_drug = bare.join(drugs, "code").groupBy("person_id").agg(F.min(F.struct("age", "code", "_a")).alias("d"))
    first_dx = bare.join(diagnoses.select("code"), "code", "left_semi").groupBy("person_id").agg(F.min(F.struct("age", "code")).alias("x"))
    return (
        first_drug.join(first_dx, "person_id").where(F.col("x") <= F.struct(F.col("d.age").alias("age"), F.col("d.code").alias("code")))
        .withColumn("age", F.col("d.age")).join(days, ["person_id", "age"]).where("day_index > 0")
        .select("person_id", (F.col("day_index") - 1).alias("day_index"), F.col("d._a").alias("label"))
    )


def next_year_category(days: DataFrame, events: DataFrame, codes: DataFrame, horizon: int = CATEGORY_DAYS) -> DataFrame:
    """Category code within a year, on days spaced by a year before the first such code; the first is skipped.

    Greedy spacing folds each person's day list (bounded by the calendar).
    """
    hits = code_days(events, codes)
    first = hits.groupBy("person_id").agg(F.min("age").alias("_first"))
    open_days = days.join(first, "person_id", "left").where(
        (F.col("day_index") > 0) & (F.col("_first").isNull() | (F.col("age") < F.col("_first"))))
    listed = open_days.groupBy("person_id").agg(F.sort_array(F.collect_list(F.struct("age", "day_index"))).alias("steps"))
    start = F.struct(F.lit(None).cast("int").alias("last"), F.array().cast("array<int>").alias("out"))

    def fold(s, x):
        take = s["last"].isNull() | (x["age"] >= s["last"] + horizon)
        return F.struct(
            F.when(take, x["age"]).otherwise(s["last"]).alias("last"),
            F.when(take, F.concat(s["out"], F.array(x["day_index"].cast("int")))).otherwise(s["out"]).alias("out"),
        )

    chosen = listed.select("person_id", F.aggregate("steps", start, fold)["out"].alias("picked"))
    after = chosen.select("person_id", F.posexplode("picked").alias("_p", "day_index")).where("_p > 0")
    return fixed_horizon(days, hits, horizon, after)


def possible_patients(index: DataFrame, required: list[DataFrame], any_of: list[DataFrame] | None = None) -> DataFrame:
    """Patients with a code of every required set and of any optional one, for pruning by a semi join."""
    out = None
    for codes in required:
        have = T.patients_with(index, codes)
        out = have if out is None else out.join(have, "person_id", "left_semi")
    if any_of:
        union = any_of[0]
        for codes in any_of[1:]:
            union = union.unionByName(codes)
        out = out.join(T.patients_with(index, union), "person_id", "left_semi")
    return out
