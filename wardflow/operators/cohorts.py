"""Cohort construction: inpatient, sepsis, outpatient and intensive-care cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import hash_int, hash_unit, key_hash
from ..functions.segments import first_per, hash_rank, next_row, running_sum
from ..functions.timeunits import diff_days, diff_hours, diff_years

INPATIENT_VISITS = (9201, 262)
OUTPATIENT_VISITS = (9202, 581477)
DIED_IN_CARE = 4216643
ICU_STAY = 32037
# Follow-up presets of the outpatient cohort: last index date and follow-up days.
HORIZONS = {
    "1yr": {"max_index_date": "2019-12-31", "event_followup_days": 365.25},
    "5yr": {"max_index_date": "2015-12-31", "event_followup_days": 5 * 365.25},
    "10yr": {"max_index_date": "2010-12-31", "event_followup_days": 10 * 365.25},
}


def inpatient_visits(
    visits: DataFrame, person: DataFrame, min_stay_hour: int | None = None, limit: int | None = None
) -> DataFrame:
    start, end = F.col("visit_start_datetime"), F.col("visit_end_datetime")
    kept = (
        visits.where(F.col("visit_concept_id").isin(*INPATIENT_VISITS) & (end > start))
        .select("person_id", "visit_concept_id", start, end)
        .join(person.select("person_id"), "person_id", "left_semi")
    )
    if min_stay_hour is not None:
        kept = kept.where(diff_hours(end, start) > min_stay_hour)
    return kept.limit(limit) if limit else kept


def admission_rollup(visits: DataFrame, start="visit_start_datetime", end="visit_end_datetime") -> DataFrame:
    """Merge overlapping or touching visits into admissions.

    Sweep line: +1 at a start, -1 at an end, netted per instant so touching
    visits cancel.  An instant where the running count leaves zero opens an
    admission, one where it returns to zero closes it; opens and closes
    alternate, so the row after an opening is its close.
    """
    sides = F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("step")),
        F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")),
    )
    net = (
        visits.where(F.col(end) > F.col(start))
        .select("person_id", F.explode(sides).alias("side"))
        .groupBy("person_id", F.col("side.at").alias("at"))
        .agg(F.sum("side.step").alias("step"))
    )
    counted = running_sum(net, ["person_id"], "at", "step", "open_visits")
    opens = (F.col("open_visits") > 0) & (F.col("open_visits") == F.col("step"))
    closes = F.col("open_visits") == 0
    edges = counted.where(opens | closes).withColumn("opens", opens)
    return (
        next_row(edges, ["person_id"], ["at"], "at", {"discharge_date": "at"})
        .where("opens")
        .select("person_id", F.col("at").alias("admit_date"), "discharge_date")
    )


def one_per_person(cohort: DataFrame, key: list[str], seed=None) -> DataFrame:
    """One repeatable pseudo-random row per person, with a hashed prediction id."""
    picked = first_per(cohort.withColumn("_rnd", key_hash(*key, seed=seed)), ["person_id"], ["_rnd", *key])
    return picked.drop("_rnd").withColumn("prediction_id", hash_int(*key))


def eligible(cohort: DataFrame, min_age: float, predicate: str | None = None) -> DataFrame:
    kept = cohort.where(F.col("age_in_years") >= min_age)
    return kept.where(F.expr(predicate)) if predicate else kept


def concept_names(concept: DataFrame, key: str, name: str) -> DataFrame:
    return concept.select(F.col("concept_id").alias(key), F.col("concept_name").alias(name))


def sepsis_admissions(admissions: DataFrame, person: DataFrame, concept: DataFrame) -> DataFrame:
    people = person.select("person_id", "birth_datetime", "gender_concept_id", "race_concept_id", "ethnicity_concept_id")
    for part in ("gender", "race", "ethnicity"):
        people = people.join(concept_names(concept, f"{part}_concept_id", f"{part}_name"), f"{part}_concept_id", "left")
    years = diff_years("admit_date", "birth_datetime")
    named = admissions.join(people, "person_id", "left").select(
        "person_id", "admit_date", "discharge_date", "birth_datetime", "gender_name", "race_name", "ethnicity_name",
        years.alias("age_in_years"), F.when(years <= 18, 0).otherwise(1).alias("adult_at_admission"),
    )
    return one_per_person(named, ["person_id", "admit_date", "discharge_date"])


def outpatient_index(
    visits: DataFrame,
    person: DataFrame,
    observation_period: DataFrame,
    years_history_required: float = 1,
    max_observation_period_end_date: str = "2021-12-31",
    min_age_in_years: float = 18.0,
    max_index_date: str = "2019-12-31",
    has_birth_datetime: bool = True,
) -> DataFrame:
    day = F.col("visit_start_date")
    age = (
        diff_days(day, "birth_datetime") / 365.25 if has_birth_datetime
        else (F.year(day) - F.col("year_of_birth")).cast("double")
    )
    index = (
        visits.where(F.col("visit_concept_id").isin(*OUTPATIENT_VISITS) & (day <= F.lit(max_index_date).cast("date")))
        .select("person_id", "visit_occurrence_id", "visit_start_date")
        .join(person.select("person_id", "birth_datetime", "year_of_birth"), "person_id")
        .withColumn("age_in_years", age)
        .where(F.col("age_in_years") >= min_age_in_years)
    )
    periods = observation_period.groupBy("person_id").agg(
        F.min("observation_period_start_date").alias("observation_period_start_date"),
        F.max("observation_period_end_date").alias("observation_period_end_date"),
    ).where(F.col("observation_period_end_date") <= F.lit(max_observation_period_end_date).cast("date"))
    return (
        index.join(periods, "person_id")
        .withColumn("years_since_start", diff_days(day, "observation_period_start_date") / 365.25)
        .withColumn("years_until_end", diff_days("observation_period_end_date", day) / 365.25)
        .where((F.col("years_since_start") >= years_history_required) & (F.col("years_until_end") >= 0))
        .drop("year_of_birth")
    )


def icu_stays(
    visit_detail: DataFrame,
    visits: DataFrame,
    person: DataFrame,
    relative_hours_index: int = 24,
    min_los_icu_hours: int = 12,
    max_los_icu_hours: int = 240,
    min_age_in_years: float = 15.0,
    min_hours_until_icu_disch: float = 6.0,
) -> DataFrame:
    """First intensive-care stay per person, indexed a fixed time after hospital start."""
    stays = visit_detail.where(F.col("visit_detail_concept_id") == ICU_STAY).select(
        "person_id", "visit_occurrence_id", "visit_detail_id",
        F.col("visit_start_datetime").alias("icu_start"), F.col("visit_end_datetime").alias("icu_end"),
        (F.col("discharge_to_concept_id") == DIED_IN_CARE).cast("int").alias("mortality_icu"),
    )
    first = first_per(stays, ["person_id"], ["icu_start", "visit_detail_id"])
    hospital = visits.select(
        "visit_occurrence_id", F.col("visit_start_datetime").alias("h_start"), F.col("visit_end_datetime").alias("h_end"),
        (F.col("discharge_to_concept_id") == DIED_IN_CARE).cast("int").alias("mortality_hospital"),
    )
    shift = F.make_dt_interval(F.lit(0), F.lit(relative_hours_index))
    return (
        first.join(hospital, "visit_occurrence_id", "left")
        .join(person.select("person_id", "birth_datetime"), "person_id")
        .withColumn("index_datetime", F.col("h_start") + shift)
        .withColumn("age_in_years", diff_days("index_datetime", "birth_datetime") / 365.25)
        .withColumn("los_hospital_hours", diff_hours("h_end", "h_start"))
        .withColumn("los_icu_hours", diff_hours("icu_end", "icu_start"))
        .where(
            F.col("age_in_years").between(min_age_in_years, 89.0)
            & F.col("los_icu_hours").between(min_los_icu_hours, max_los_icu_hours)
            & (diff_hours("icu_end", "index_datetime") >= min_hours_until_icu_disch)
        )
        .select(
            "person_id", "visit_occurrence_id", "visit_detail_id", "index_datetime", "age_in_years",
            "los_hospital_hours", "los_icu_hours",
            (F.col("los_icu_hours") > 72).cast("int").alias("los_icu_3days"),
            (F.col("los_icu_hours") > 168).cast("int").alias("los_icu_7days"),
            "mortality_hospital", "mortality_icu",
        )
    )


def adult_flag(cohort: DataFrame) -> DataFrame:
    """Adult or pediatric by age at admission; newborns go out."""
    return cohort.where(F.col("pediatric_age_group") != "term neonatal").withColumn(
        "adult_at_admission", F.when(F.col("age_in_years") < 18, 0).otherwise(1)
    )


def constrained_training(cohort: DataFrame, percents=tuple(range(5, 100, 5)), seed=0) -> DataFrame:
    """Training and validation persons kept at each sampling percentage.

    One hash rank per split serves every percentage: at p percent the first
    floor(n*p/100) persons by rank are kept.
    """
    people = cohort.where(F.col("fold_id").isin("train", "val")).select("person_id", "fold_id").distinct()
    sizes = people.groupBy("fold_id").agg(F.count(F.lit(1)).alias("_n"))
    ranked = hash_rank(people, ["fold_id"], key_hash("person_id", seed=seed)).join(F.broadcast(sizes), "fold_id")
    return (
        ranked.withColumn("percent", F.explode(F.array(*[F.lit(p) for p in percents])))
        .withColumn("constrain", (F.col("rank") < F.floor(F.col("_n") * F.col("percent") / 100)).cast("int"))
        .select("person_id", "fold_id", "percent", "constrain")
    )
