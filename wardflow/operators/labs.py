"""Laboratory labels: one pass over the measurements of each window.

A label is a specification: concept set, units with conversion factors, the
direction of abnormality and the severity levels.  Every level keeps its first
abnormal measurement by ``min(struct(time, value))`` under a condition, so one
shuffle on the window keys replaces a window function and an outer join per
level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import window_join
from ..functions.timeunits import diff_days
from .concepts import expand

MGDL_PER_UMOL = 0.0113122


@dataclass(frozen=True)
class LabSpec:
    """``units`` maps a unit concept to its conversion rule; ``levels`` maps a name
    to (comparison, threshold).  ``low`` labels take the minimum and compare with
    the lower reference limit."""

    label: str
    concepts: tuple[int, ...]
    units: dict[int, str]
    low: bool
    levels: dict[str, tuple[str, float]]
    extreme: str
    limits: bool = True


# Fixed concept sets, unit factors and thresholds of the laboratory labels.
HYPERKALEMIA = LabSpec(
    "hyperkalemia_lab", (40653595, 37074594, 40653596), {8753: "", 9557: "", 8840: "/ 18"}, False,
    {"mild": (">", 5.5), "moderate": (">", 6.0), "severe": (">", 7.0)}, "max_potassium",
)
HYPOGLYCEMIA = LabSpec(
    "hypoglycemia_lab", (4144235, 1002597), {8753: "", 8840: "/ 18", 9028: "/ 18"}, True,
    {"mild": ("<=", 3.9), "moderate": ("<", 3.5), "severe": ("<", 3.0)}, "min_glucose",
)
HYPONATREMIA = LabSpec(
    "hyponatremia_lab", (40653762,), {8753: "", 9557: ""}, True,
    {"mild": ("<=", 135.0), "moderate": ("<", 130.0), "severe": ("<", 125.0)}, "min_sodium",
)
ANEMIA = LabSpec(
    "anemia_lab", (37072252,), {8713: "* 10", 8840: "/ 100"}, True,
    {"mild": ("<", 120.0), "moderate": ("<", 110.0), "severe": ("<", 70.0)}, "min_hemoglobin",
)
THROMBOCYTOPENIA = LabSpec(
    "thrombocytopenia_lab", (37037425, 40654106), {8848: "", 8961: ""}, True,
    {"mild": ("<", 150.0), "moderate": ("<", 100.0), "severe": ("<", 50.0)}, "min_platelet",
)
KIDNEY_INJURY = LabSpec(
    "aki_lab", (37029387, 4013964, 2212294, 3051825),
    {8749: "", 8840: "/ 0.0113122", 8837: "* 0.001 / 0.0113122"}, False,
    {"aki1": ("ratio_or_rise", 1.5), "aki2": ("ratio", 2.0), "aki3": ("ratio_or_rise", 3.0)}, "max_creatinine",
)
NEUTROPENIA_LEVELS = {"mild": ("<", 1.5), "moderate": ("<", 1.0), "severe": ("<", 0.5)}
# Rises over baseline (umol/L) that count beside the ratio.
RISES = {"aki1": 26.52, "aki3": 353.6}
WBC_UNITS = (8848, 8961)
# Creatinine norms in mg/dL below each age in days; adults differ by sex.
AGE_NORMS = [(15, 0.92), (2 * 365, 0.36), (5 * 365, 0.43), (12 * 365, 0.61), (15 * 365, 0.81), (19 * 365, 0.84)]
ADULT_NORMS = {8532: 1.1}
ADULT_NORM_OTHER = 1.2

WINDOW = ["person_id", "admit_date", "discharge_date"]


def lab_values(measurement: DataFrame, concepts: DataFrame, units: dict[int, str]) -> DataFrame:
    """Measurements of a concept set with value and limits in the label's unit."""
    unit = F.col("unit_concept_id")
    def converted(name: str) -> Column:
        cases = " ".join(f"when {u} then {name} {rule}" for u, rule in units.items())
        return F.expr(f"case unit_concept_id {cases} end")

    kept = measurement.where(unit.isin(*units)).join(
        concepts.withColumnRenamed("concept_id", "measurement_concept_id"), "measurement_concept_id", "left_semi"
    )
    return kept.select(
        "person_id", "measurement_datetime", converted("value_as_number").alias("value"),
        converted("range_low").alias("range_low"), converted("range_high").alias("range_high"),
    )


def _hit(op: str, level: str, threshold: float, value: Column, base: Column) -> Column:
    if op == "ratio":
        return F.try_divide(value, base) >= threshold
    if op == "ratio_or_rise":
        return (F.try_divide(value, base) >= threshold) | (value - base >= RISES[level])
    return {">": value > threshold, "<": value < threshold, "<=": value <= threshold}[op]


def level_labels(
    cohort: DataFrame,
    values: DataFrame,
    label: str,
    levels: dict[str, tuple[str, float]],
    low: bool,
    extreme: str,
    limits: bool = True,
    closed: str = "both",
    start: str = "admit_date",
    end: str = "discharge_date",
    extra: list[str] = (),
) -> DataFrame:
    """Extreme value and first abnormal measurement per level, per window with any value."""
    keys = ["person_id", start, end]
    columns = list(dict.fromkeys([*keys, *extra]))
    inside = window_join(cohort.select(*columns).distinct(), values, ["person_id"], start, end, "measurement_datetime", closed=closed)
    value, base = F.col("value"), F.col("baseline") if "baseline" in columns else F.lit(None)
    first = F.struct("measurement_datetime", "value", *(["range_low", "range_high"] if limits else []))
    tests = {n: _hit(op, n, x, value, base) for n, (op, x) in levels.items()}
    if limits:
        tests["abnormal"] = value < F.col("range_low") if low else value > F.col("range_high")
    best = F.min(value) if low else F.max(value)
    rolled = inside.groupBy(*keys).agg(
        best.alias("_extreme"), *[F.min(F.when(test, first)).alias(f"_{n}") for n, test in tests.items()]
    )
    out = [*keys, F.col("_extreme").alias(f"{label}_{extreme}")]
    for n in tests:
        out += [
            F.col(f"_{n}.value").alias(f"{label}_{n}_measurement"),
            F.col(f"_{n}.measurement_datetime").alias(f"{label}_{n}_measurement_datetime"),
            F.when(F.col(f"_{n}").isNotNull(), 1).alias(f"{label}_{n}_label"),
        ]
    if limits:
        out.append(F.col("_abnormal")["range_low" if low else "range_high"].alias(f"{label}_abnormal_threshold"))
    return rolled.select(*out)


def lab_label(
    cohort: DataFrame, measurement: DataFrame, concept: DataFrame, ancestors: DataFrame, spec: LabSpec, **window
) -> DataFrame:
    values = lab_values(measurement, expand(concept, ancestors, spec.concepts), spec.units)
    return level_labels(cohort, values, spec.label, spec.levels, spec.low, spec.extreme, spec.limits, **window)


def creatinine_baseline(
    cohort: DataFrame, values: DataFrame, person: DataFrame, unit_divisor: float = 1.0, start: str = "admit_date"
) -> DataFrame:
    """Lowest creatinine of the 90 days before the window, else a norm by age and sex.

    Windows of persons without any creatinine have no baseline.
    """
    keys = WINDOW
    has_values = cohort.join(values.select("person_id"), "person_id", "left_semi")
    before = has_values.withColumn("_from", F.col(start) - F.expr("interval 90 days"))
    low = (
        window_join(before.select(*keys, "_from"), values, ["person_id"], "_from", start, "measurement_datetime", closed="left")
        .groupBy(*keys)
        .agg(F.min("value").alias("_recent"))
    )
    age = diff_days(start, "birth_datetime")
    norm = F.when(age < 0, F.lit(None).cast("double"))
    for below, value in AGE_NORMS:
        norm = norm.when(age < below, F.lit(value))
    for gender, value in ADULT_NORMS.items():
        norm = norm.when(F.col("gender_concept_id") == gender, F.lit(value))
    norm = norm.when(F.col("gender_concept_id").isNotNull(), F.lit(ADULT_NORM_OTHER))
    return (
        has_values.join(person.select("person_id", "birth_datetime", "gender_concept_id"), "person_id", "left")
        .join(low, keys, "left")
        .withColumn("baseline", F.coalesce("_recent", norm / unit_divisor))
        .drop("_recent", "birth_datetime", "gender_concept_id")
    )


def kidney_injury_label(cohort, measurement, concept, ancestors, person) -> DataFrame:
    spec = KIDNEY_INJURY
    values = lab_values(measurement, expand(concept, ancestors, spec.concepts), spec.units)
    based = creatinine_baseline(cohort.select(*WINDOW), values, person, MGDL_PER_UMOL)
    return level_labels(based, values, spec.label, spec.levels, spec.low, spec.extreme, extra=["baseline"])


def neutrophil_values(measurement: DataFrame, concept: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Neutrophil count (thousand/uL) per person and instant.

    Percent values are scaled by every white-cell count of the same instant;
    the neutrophil and band parts are summed, and the white-cell count itself
    stands in where neither exists.
    """
    instant = ["person_id", "measurement_datetime"]
    unit, code, value = F.col("unit_concept_id"), F.col("measurement_concept_id"), F.col("value_as_number")
    # Distinct values per instant first: repeated records cannot multiply in the joins.
    wbc = measurement.where((code == 3010813) & unit.isin(*WBC_UNITS)).select(*instant, value.alias("wbc")).distinct()
    scaled = F.when(value <= 100, value / 100 * F.col("wbc"))
    bands = (
        measurement.where(code.isin(3035839, 3018199)).select(*instant, code, unit, value).distinct()
        .join(wbc, instant, "left")
        .withColumn("bands", F.when(code == 3035839, scaled).when(unit == 8784, value / 1000))
        .select(*instant, "bands").distinct()
    )
    sets = expand(concept, ancestors, (37045722, 37049637)).withColumnRenamed("concept_id", "measurement_concept_id")
    neutrophils = (
        measurement.where(unit.isin(8848, 8554, 8784, 8961)).join(sets, "measurement_concept_id", "left_semi")
        .select(*instant, unit, value).distinct()
        .join(wbc, instant, "left")
        .withColumn("neutrophils", F.when(unit == 8554, scaled).when(unit == 8784, value / 1000).otherwise(value))
        .select(*instant, "neutrophils").distinct()
    )
    parts = neutrophils.join(bands, instant, "full").join(wbc, instant, "full")
    either = F.col("neutrophils").isNotNull() | F.col("bands").isNotNull()
    total = F.when(either, F.coalesce("neutrophils", F.lit(0.0)) + F.coalesce("bands", F.lit(0.0))).otherwise(F.col("wbc"))
    return parts.select(*instant, total.alias("value")).where(F.col("value").isNotNull()).distinct()


def neutropenia_label(cohort, measurement, concept, ancestors) -> DataFrame:
    values = neutrophil_values(measurement, concept, ancestors)
    return level_labels(cohort, values, "neutropenia_lab", NEUTROPENIA_LEVELS, True, "min_neutrophils", limits=False)


def _first_hits(cohort: DataFrame, values: DataFrame, tests: dict[str, Column], best: Column, extra=()) -> DataFrame:
    inside = window_join(cohort.select(*WINDOW, *extra), values, ["person_id"], "admit_date", "discharge_date",
                         "measurement_datetime", closed="right")
    pair = F.struct("measurement_datetime", "value")
    return inside.groupBy(*WINDOW).agg(best.alias("_best"), *[F.min(F.when(t, pair)).alias(f"_{n}") for n, t in tests.items()])


def admission_labs(cohort, measurement, concept, ancestors, person) -> DataFrame:
    """Admission-level kidney injury (mg/dL), hypoglycemia (mg/dL) and
    neutropenia labels over the half-open window (admit, discharge]."""
    base = cohort.select(*WINDOW)
    value = F.col("value")
    crea = lab_values(
        measurement, expand(concept, ancestors, KIDNEY_INJURY.concepts), {8749: "* 0.0113122", 8840: "", 8837: "* 0.001"}
    )
    based = creatinine_baseline(base, crea, person)
    ratio = F.try_divide(value, F.col("baseline"))
    aki = _first_hits(based, crea, {"aki1": (ratio >= 1.5) | (value - F.col("baseline") >= 0.3), "aki2": ratio >= 2.0},
                      F.max(value), ["baseline"])
    glucose = lab_values(measurement, expand(concept, ancestors, HYPOGLYCEMIA.concepts), {8840: "", 9028: "", 8753: "* 18"})
    hg = _first_hits(base, glucose, {"hg": value <= 60}, F.min(value))
    cells = neutrophil_values(measurement, concept, ancestors)
    np_ = _first_hits(base, cells, {"np_500": value < 0.5, "np_1000": value < 1.0}, F.min(value))

    def named(df, best, levels):
        cols = [F.col("_best").alias(best)]
        for n, stem in levels.items():
            cols += [F.col(f"_{n}.value").alias(stem), F.col(f"_{n}.measurement_datetime").alias(f"{stem}_time")]
        return df.select(*WINDOW, *cols)

    out = (
        base.join(based.select(*WINDOW, F.col("baseline").alias("aki_base_creatinine")), WINDOW, "left")
        .join(named(aki, "aki_max_creatinine", {"aki1": "aki1_creatinine", "aki2": "aki2_creatinine"}), WINDOW, "left")
        .join(named(hg, "hg_min_glucose", {"hg": "hg_glucose"}), WINDOW, "left")
        .join(named(np_, "np_min_neutrophils", {"np_500": "np_500_neutrophils", "np_1000": "np_1000_neutrophils"}), WINDOW, "left")
    )
    for flag, source in {
        "aki1_label": "aki1_creatinine", "aki2_label": "aki2_creatinine", "hg_label": "hg_glucose",
        "np_500_label": "np_500_neutrophils", "np_1000_label": "np_1000_neutrophils",
    }.items():
        out = out.withColumn(flag, F.col(source).isNotNull().cast("int"))
    return out
