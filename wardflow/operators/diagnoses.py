"""Diagnosis labels on windows and the cardiovascular outcome of an index visit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.segments import durable, window_join
from ..functions.timeunits import diff_days
from . import outcomes
from .concepts import expand_sets, source_predicates, source_rollups

WINDOW = ["person_id", "admit_date", "discharge_date"]
# Fixed condition concept sets of the diagnosis labels.
DIAGNOSES = {
    "hypoglycemia_dx": [380688, 4226798, 36714116, 24609, 4029423, 45757363, 4096804, 4048805, 4228112, 23034, 4029424, 45769876],
    "aki_dx": [197320, 432961, 444044],
    "anemia_dx": [439777, 37018722, 37017132, 35624756, 4006467, 37398911, 37395652],
    "hyperkalemia_dx": [434610],
    "hyponatremia_dx": [435515, 4232311],
    "thrombocytopenia_dx": [432870],
    "neutropenia_dx": [301794, 320073],
}


def diagnosis_labels(
    cohort: DataFrame, conditions: DataFrame, concept: DataFrame, ancestors: DataFrame, sets: dict | None = None
) -> DataFrame:
    """First condition of each set inside the window, all sets in one pass."""
    sets = sets or DIAGNOSES
    members = expand_sets(concept, ancestors, sets).withColumnRenamed("concept_id", "condition_concept_id")
    events = (
        conditions.select("person_id", "condition_concept_id", "condition_start_datetime")
        .join(members, "condition_concept_id")
        .groupBy("person_id", "set_name", "condition_start_datetime").agg(F.lit(1).alias("_"))
        .drop("_")
    )
    hits = window_join(cohort.select(*WINDOW).distinct(), events, ["person_id"], "admit_date", "discharge_date", "condition_start_datetime")
    at = F.col("condition_start_datetime")
    first = hits.groupBy(*WINDOW).agg(*[F.min(F.when(F.col("set_name") == n, at)).alias(f"{n}_start_datetime") for n in sets])
    out = cohort.join(first, WINDOW, "left")
    for n in sets:
        out = out.withColumn(f"{n}_label", F.col(f"{n}_start_datetime").isNotNull().cast("int"))
    return out


def _days(df: DataFrame, concepts: DataFrame, column: str, date: str) -> DataFrame:
    """Distinct (person, day) of the events of a concept set."""
    named = concepts.withColumnRenamed("concept_id", column)
    return df.select("person_id", column, date).join(named, column, "left_semi").groupBy("person_id", F.col(date).alias("day")).agg(
        F.lit(1).alias("_")).drop("_")


def _around(index: DataFrame, days: DataFrame, keys: list[str]) -> DataFrame:
    """Per index row: first event day ever, first on or after, first strictly after.

    One person-day event list per person joins to the index days by a merged
    ordering: the day-level helper finds the next event day, so no pairs of
    index rows and events are formed.
    """
    marks = index.select("person_id", F.col("visit_start_date").alias("day")).distinct().withColumn("_index", F.lit(1))
    merged = (
        days.withColumn("_event", F.lit(1)).unionByName(marks, allowMissingColumns=True)
        .groupBy("person_id", "day").agg(F.max("_event").alias("_event"), F.max("_index").alias("_index"))
    )
    # At most one row per person and calendar day, so a person window is bounded.
    ahead = Window.partitionBy("person_id").orderBy("day")
    event_day = F.when(F.col("_event") == 1, F.col("day"))
    return (
        merged.withColumn("first_day", F.min(event_day).over(Window.partitionBy("person_id")))
        .withColumn("from_day", F.min(event_day).over(ahead.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("after_day", F.min(event_day).over(ahead.rowsBetween(1, Window.unboundedFollowing)))
        .where(F.col("_index") == 1)
        .select("person_id", F.col("day").alias("visit_start_date"), "first_day", "from_day", "after_day")
    )


def coronary_death_days(conditions: DataFrame, concepts: DataFrame, death: DataFrame) -> DataFrame:
    """Coronary condition days followed by death within 1 to 365 days."""
    deaths = death.groupBy("person_id").agg(F.min("death_date").alias("death_date"))
    return _before_death(_days(conditions, concepts, "condition_concept_id", "condition_start_date"), deaths)


def _before_death(days: DataFrame, deaths: DataFrame) -> DataFrame:
    return days.join(deaths, "person_id").where(diff_days("death_date", "day").between(1, 365)).select("person_id", "day")


def cardiovascular_outcome(
    index: DataFrame, conditions: DataFrame, drugs: DataFrame, death: DataFrame, concept: DataFrame,
    relationships: DataFrame, ancestors: DataFrame, event_followup_days: float = 3652.5, legacy_flags: bool = False,
) -> DataFrame:
    """History flags, first outcome after the index visit, censoring and the binary outcome.

    Two censoring definitions: with and without the start of a statin.  The
    binary outcome is NULL when follow-up ends early.  ``legacy_flags`` keeps
    the censor flags at 0, as a comparison of a column with itself gives.
    """
    # All sets in one pass, and one scan of the conditions for the days of all of them.
    roll = durable(source_rollups(concept, relationships, ancestors, source_predicates()))
    named = roll.select("set_name", F.col("concept_id").alias("condition_concept_id"))
    marked = durable(conditions.join(named, "condition_concept_id").select("set_name", "person_id", F.col("condition_start_date").alias("day")).distinct())
    condition_days = lambda n: marked.where(F.col("set_name") == n).select("person_id", "day")
    deaths = death.groupBy("person_id").agg(F.min("death_date").alias("death_date"))
    coronary = _before_death(condition_days("coronary"), deaths)
    outcome = condition_days("mi_stroke").union(coronary).distinct()
    statin = _days(drugs, roll.where("set_name = 'statin'").select("concept_id"), "drug_concept_id", "drug_exposure_start_date")
    keys = ["person_id", "visit_start_date"]
    day, horizon = F.col("visit_start_date"), F.lit(event_followup_days)

    def near(days, **cols):
        got = _around(index, days, keys)
        return got.select(*keys, *[F.expr(e).alias(n) for n, e in cols.items()])

    flag = "cast(coalesce(first_day < visit_start_date, false) as int)"
    end = F.col("observation_period_end_date")
    out = (
        index.join(near(condition_days("cardiovascular"), has_cvd_history=flag), keys, "left")
        .join(near(statin, has_statin_history=flag, statin_censoring_date="from_day"), keys, "left")
        .join(near(outcome, outcome_date="after_day"), keys, "left")
        .join(deaths, "person_id", "left")
        .withColumn("endpoint_censoring_date", F.least(F.coalesce("death_date", end), end))
        .withColumn("censoring_date", F.least("endpoint_censoring_date", F.coalesce("statin_censoring_date", end)))
        .withColumn("days_until_outcome", diff_days("outcome_date", day))
    )
    for stem, date, event, flag_name, binary in (
        ("censoring", "censoring_date", ("days_until_event", "event_indicator"), "censored_binary", "ascvd_binary"),
        ("endpoint_censoring", "endpoint_censoring_date", ("days_until_endpoint_censored_event", "endpoint_censored_event_indicator"),
         "endpoint_censored_binary", "ascvd_binary_endpoint_censored"),
    ):
        left, got = F.col(f"days_until_{stem}"), F.col("days_until_outcome")
        early = (left < horizon) & (got.isNull() | (left < got))
        out = (
            out.withColumn(f"days_until_{stem}", diff_days(date, day))
            .withColumn(event[0], F.least(got, left))
            .withColumn(event[1], F.coalesce((got <= left).cast("int"), F.lit(0)))
            .withColumn(flag_name, F.lit(0) if legacy_flags else early.cast("int"))
            .withColumn(binary, F.when(got.between(0, event_followup_days) & (got < left), 1)
                        .when((F.coalesce(got, left) > horizon) & (left > horizon), 0))
        )
    return out.withColumnRenamed("visit_start_date", "index_date")


def outcome_demographics(outcome: DataFrame, person: DataFrame, concept: DataFrame) -> DataFrame:
    """Outcome rows with age bands and demographics; unknown gender goes out."""
    people = outcomes.demographics(outcome, person, concept).drop("race_eth_raw")
    banded = outcome.withColumn("age_group", outcomes.age_band(F.col("age_in_years")))
    return banded.join(people, "person_id", "left").where(F.col("gender_concept_name") != "No matching concept")
