"""Outcome labels on admission or window tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import next_row, window_join
from ..functions.timeunits import band, diff_days, diff_years, end_of_day

WINDOW = ["person_id", "admit_date", "discharge_date"]
# Unit names that count as intensive care.
ICU_UNITS = [
    "J4|J4|J4|",
    "J2|J2|J2|",
    "K4|K4|K4|",
    "M4|M4|M4|",
    "L4|L4|L4|",
    "ACA6 ICU|ACA6ICU|ACA6ICU|",
    "E2-ICU|E2|E2-ICU|Intensive Care",
    "VCP CCU 2|VCPC2|VCP CCU 2|Critical Care Medicine",
    "VCP CCU 1|VCPC1|VCP CCU 1|Critical Care Medicine",
    "D2ICU-SURGE|D2ICU|D2ICU|Intensive Care",
    "2 NORTH|2NCVICU|Cardiovascular Intensive Care|",
    "CVICU 220|CVICU220|Cardiovascular Intensive Care 220|",
    "CVICU 320|CVICU320|Cardiovascular Intensive Care 320|",
    "CVICU|CVICU|Cardiovascular Intensive Care|",
    "E29-ICU|NICU|E29-ICU|Intensive Care",
    "NICU 260|NICU260|Neonatal Intensive Care|Neonatology",
    "NICU 270|NICU270|Neonatal Intensive Care|Neonatology",
    "PICU 320|PICU320|Pediatric Intensive Care 320|",
    "PICU 420|PICU420|Pediatric Intensive Care 420|",
    "PICU|PICU|Pediatric Intensive Care|",
    "VCP NICU|VCPNICU|VCP NICU|Neonatology",
]
# Race names folded into "Other".
OTHER_RACES = [
    "Native Hawaiian or Other Pacific Islander",
    "American Indian or Alaska Native",
    "No matching concept",
    "Other, non-Hispanic",
    "Race and Ethnicity Unknown",
    "Unknown",
    "Declines to State",
    "Patient Refused",
]


def end_of_days(cohort: DataFrame) -> DataFrame:
    return cohort.withColumn("admit_date_midnight", end_of_day("admit_date")).withColumn(
        "discharge_date_midnight", end_of_day("discharge_date")
    )


def _with_death(cohort: DataFrame, death: DataFrame) -> DataFrame:
    return cohort.join(death.groupBy("person_id").agg(F.min("death_date").alias("death_date")), "person_id", "left")


def hospital_mortality(cohort: DataFrame, death: DataFrame, compare_timestamps: bool = False) -> DataFrame:
    """Death inside the stay.  By default by calendar day; ``compare_timestamps``
    puts the death at midnight, so a death on the admission day is outside."""
    day = F.col("death_date")
    if compare_timestamps:
        inside = day.cast("timestamp_ntz").between(F.col("admit_date"), F.col("discharge_date"))
    else:
        inside = day.between(F.col("admit_date").cast("date"), F.col("discharge_date").cast("date"))
    return _with_death(cohort, death).withColumn("hospital_mortality", F.when(inside, 1).otherwise(0))


def month_mortality(cohort: DataFrame, death: DataFrame) -> DataFrame:
    same = F.trunc("death_date", "month") == F.trunc(F.col("discharge_date").cast("date"), "month")
    return _with_death(cohort, death).withColumn("month_mortality", F.when(same, 1).otherwise(0)).drop("death_date")


def length_of_stay(cohort: DataFrame) -> DataFrame:
    days = diff_days("discharge_date", "admit_date")
    return cohort.withColumn("los_days", days).withColumn("los_7", (days >= 7).cast("int"))


def readmission(cohort: DataFrame, days: int = 30) -> DataFrame:
    """Days to the next admission, and whether it comes within ``days``."""
    shifted = next_row(cohort, ["person_id"], ["admit_date", "discharge_date"], "admit_date", {"_next": "admit_date"})
    gap = diff_days("_next", "discharge_date")
    return (
        shifted.withColumn("readmission_window", gap)
        .withColumn(f"readmission_{days}", F.when(gap.between(0, days), 1).otherwise(0))
        .drop("_next")
    )


def icu_admission(
    cohort: DataFrame, visit_detail: DataFrame, min_stay_hour: int | None = None, distinct: bool = True
) -> DataFrame:
    """First transfer to an intensive-care unit inside the window; ties are kept unless ``distinct``."""
    transfers = visit_detail.where(F.col("visit_detail_source_value").isin(*ICU_UNITS)).select(
        "person_id", F.col("visit_detail_start_datetime").alias("icu_start_datetime")
    )
    # Several transfers at one instant become one row with a count before the join.
    transfers = transfers.groupBy("person_id", "icu_start_datetime").agg(F.count(F.lit(1)).alias("_ties"))
    hits = window_join(cohort.select(*WINDOW), transfers, ["person_id"], "admit_date", "discharge_date", "icu_start_datetime")
    if min_stay_hour is not None:
        later = F.col("admit_date") + F.make_dt_interval(F.lit(0), F.lit(min_stay_hour))
        hits = hits.where(F.col("icu_start_datetime") > later)
    first = hits.groupBy(*WINDOW).agg(F.min(F.struct("icu_start_datetime", "_ties")).alias("_f"))
    out = (
        cohort.join(first, WINDOW, "left")
        .withColumn("icu_start_datetime", F.col("_f.icu_start_datetime"))
        .withColumn("icu_admission", F.col("icu_start_datetime").isNotNull().cast("int"))
    )
    if not distinct:
        out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.coalesce(F.col("_f._ties"), F.lit(1)).cast("int")))).drop("_copy")
    return out.drop("_f")


def age_band(age: Column, first: int = 18, below: str = "<18") -> Column:
    """Bands with exclusive upper ends; anything outside goes to ``below``."""
    edges = [first, 30, 45, 55, 65, 75, 91]
    out = F.when(age.isNull(), F.lit(below))
    for lo, hi in zip(edges, edges[1:]):
        out = out.when((age >= lo) & (age < hi), F.lit(f"[{lo}-{hi})"))
    return out.otherwise(F.lit(below))


def age_groups(cohort: DataFrame, person: DataFrame, icu_variant: bool = False, start: str = "admit_date") -> DataFrame:
    if "age_in_years" not in cohort.columns:
        cohort = cohort.join(person.select("person_id", "birth_datetime"), "person_id").withColumn(
            "age_in_years", diff_years(start, "birth_datetime")
        ).drop("birth_datetime")
    age = F.col("age_in_years")
    return cohort.withColumn("age_group", age_band(age, 15, "other") if icu_variant else age_band(age))


def age_day_groups(cohort: DataFrame, person: DataFrame, start: str = "admit_date") -> DataFrame:
    """Pediatric stages and decade bands on the age in days."""
    year = 365
    stages = [(28, "term neonatal"), (year + 1, "infancy"), (2 * year + 1, "toddler"), (5 * year + 1, "early childhood"),
              (11 * year + 1, "middle childhood"), (18 * year + 1, "early adolescence"), (21 * year + 1, "late adolescence")]
    decades = [(17 * year + 1, "[0,18)"), (29 * year + 1, "[18,30)")] + [
        ((d + 9) * year + 1, f"[{d},{d + 10})") for d in range(30, 90, 10)
    ]
    age = F.col("age_days")
    known = age >= 0
    stage = band(age, [e for e, _ in stages], [n for _, n in stages], "non-pediatric")
    decade = band(age, [e for e, _ in decades], [n for _, n in decades], "[90,)")
    return (
        cohort.join(person.select("person_id", "birth_datetime"), "person_id", "left")
        .withColumn("age_days", diff_days(start, "birth_datetime"))
        .withColumn("pediatric_age_group", F.when(known, stage).otherwise("unknown"))
        .withColumn("age_group", F.when(known, decade).otherwise("unknown"))
        .drop("birth_datetime")
    )


def _person_names(person: DataFrame, concept: DataFrame, how: str) -> DataFrame:
    people = person.select("person_id", "gender_concept_id", "race_concept_id", "ethnicity_concept_id")
    for part in ("gender", "race", "ethnicity"):
        names = concept.select(F.col("concept_id").alias(f"{part}_concept_id"), F.col("concept_name").alias(f"{part}_name"))
        people = people.join(names, f"{part}_concept_id", how)
    return people


def demographics(cohort: DataFrame, person: DataFrame, concept: DataFrame) -> DataFrame:
    """Collapsed and raw race/ethnicity and gender name, one row per person."""
    hispanic = F.col("ethnicity_name") == "Hispanic or Latino"
    race = F.col("race_name")
    folded = (
        F.when(hispanic | (race == "Other, Hispanic"), "Hispanic or Latino")
        .when(race.isin(*OTHER_RACES), "Other").otherwise(race)
    )
    raw = F.when(hispanic, "Hispanic or Latino").when(race == "No matching concept", "Other").otherwise(race)
    return (
        _person_names(person, concept, "inner")
        .join(cohort.select("person_id"), "person_id", "left_semi")
        .select("person_id", folded.alias("race_eth"), raw.alias("race_eth_raw"), F.col("gender_name").alias("gender_concept_name"))
    )


def sex_and_race(cohort: DataFrame, person: DataFrame, concept: DataFrame) -> DataFrame:
    names = _person_names(person, concept, "left").select(
        "person_id", F.col("gender_name").alias("sex"), F.col("race_name").alias("race")
    )
    return cohort.join(names, "person_id", "left")


def race_rollup(
    cohort: DataFrame, person: DataFrame, concept: DataFrame, concept_ancestor: DataFrame, chosen=(8527,)
) -> DataFrame:
    """Race through its concept ancestors; persons under none of them are Other."""
    tops = (
        concept_ancestor.where(F.col("ancestor_concept_id").isin(*chosen))
        .select(F.col("descendant_concept_id").alias("race_concept_id"), F.col("ancestor_concept_id").alias("concept_id"))
        .join(concept.select("concept_id", F.col("concept_name").alias("_race")), "concept_id")
        .select("race_concept_id", "_race")
        .distinct()
    )
    gender = concept.select(F.col("concept_id").alias("gender_concept_id"), F.col("concept_name").alias("gender_concept_name"))
    return (
        cohort.select("person_id").distinct()
        .join(person.select("person_id", "race_concept_id", "gender_concept_id"), "person_id")
        .join(tops, "race_concept_id", "left")
        .join(gender, "gender_concept_id")
        .select("person_id", F.coalesce("_race", F.lit("Other")).alias("race_eth"), "gender_concept_name")
    )


def intersections(labelled: DataFrame) -> DataFrame:
    """Group strings over race, gender and age."""
    join = lambda *cs: F.concat_ws("_", *cs)
    return (
        labelled.withColumn("race_eth_gender", join("race_eth", "gender_concept_name"))
        .withColumn("race_eth_age_group", join("race_eth", "age_group"))
        .withColumn("gender_age_group", join("gender_concept_name", "age_group"))
        .withColumn("race_eth_gender_age_group", join("race_eth", "gender_concept_name", "age_group"))
    )


class LabelSet:
    """Named labels composed onto one window table by left joins on its keys.

    A label is a function ``cohort -> DataFrame`` that holds the window keys and
    its label columns.
    """

    def __init__(self):
        self.labels: dict[str, tuple[str, callable]] = {}

    def add(self, name: str, about: str, fn) -> "LabelSet":
        self.labels[name] = (about, fn)
        return self

    def describe(self) -> list[tuple[str, str]]:
        return [(name, about) for name, (about, _) in self.labels.items()]

    def compose(self, cohort: DataFrame, include=None, exclude=()) -> DataFrame:
        names = list(include) if include is not None else list(self.labels)
        unknown = [n for n in [*names, *exclude] if n not in self.labels]
        if unknown:
            raise KeyError(f"unknown labels: {unknown}")
        chosen = [n for n in names if n not in exclude]
        parts = [self.labels[n][1](cohort) for n in chosen]
        taken = set(cohort.columns)
        for i, part in enumerate(parts):
            fresh = [c for c in part.columns if c not in taken]
            taken.update(fresh)
            parts[i] = part.select(*WINDOW, *fresh)
        return reduce(lambda a, b: a.join(b, WINDOW, "left"), parts, cohort)
