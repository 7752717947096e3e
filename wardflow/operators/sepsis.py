"""Suspected infection, organ-failure components, scores and the sepsis label.

All components of both periods (around the index day and before it) come from
one bucketed join per source table and one grouped aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import carry_last, durable, overlap_join, union_all, window_join
from ..functions.timeunits import diff_days, diff_minutes, diff_months
from .concepts import expand_sets

FLOWSHEET = 2000006253
CULTURES, ANTIBIOTICS = 4107893, 21602796
VASOPRESSORS = {"dopamine": 21600284, "dobutamine": 21600287, "epinephrine": 21600303, "norepinephrine": 21600283}
OXYGEN_PRESSURE, COMA_SCORE, MEAN_PRESSURE, URINE = 3027801, 3032652, 3027598, 45876241
SETS = {
    "platelet": [37037425, 40654106],
    "creatinine": [37029387, 4013964, 2212294, 3051825],
    "bilirubin": [3024128, 4230543],
    "lactate": [3047181, 40762125, 3014111, 3020138],
}
# Unit rules by component; the default set keeps the published factors, the
# corrected set divides lactate and multiplies creatinine.
UNIT_RULES = {
    "default": {"creatinine": {8749: "/ 0.0113122", 8837: "/ 1000"}, "lactate": {8840: "* 9.0", 8837: "/ 0.001 * 9.0"}},
    "corrected": {"creatinine": {8749: "* 0.0113122", 8837: "/ 1000"}, "lactate": {8840: "/ 9.0", 8837: "* 0.001 / 9.0"}},
}
# Day offsets from the index day: measurements and observations, and drug overlap.
PERIODS = {"current": (-1, 2), "prior": (-10, -3)}
DRUG_PERIODS = {"current": (-2, 1), "prior": (-10, -3)}
STAY = ["person_id", "admit_datetime"]
# Score bands: minimum age in months -> creatinine cuts for 4, 3, 2, 1 and the pressure limit.
AGE_BANDS = [
    (216, (5.0, 3.5, 2.0, 1.2), 70),
    (144, (4.2, 2.9, 1.7, 1.0), 67),
    (60, (2.6, 1.8, 1.1, 0.7), 65),
    (24, (2.3, 1.6, 0.9, 0.6), 62),
    (12, (1.5, 1.1, 0.6, 0.4), 60),
    (1, (1.2, 0.8, 0.5, 0.3), 55),
    (None, (1.6, 1.2, 1.0, 0.8), 46),
]


def flowsheets(observation: DataFrame, concept: DataFrame, visits: DataFrame | None = None) -> DataFrame:
    """Flowsheet rows: display name, value, unit and source name out of nested JSON,
    plain columns for other observations, with the visit that contains the time."""
    shape = "struct<values:array<struct<source:string,value:string>>>"
    pick = lambda parsed, source: F.get(F.filter(parsed["values"], lambda v: v["source"] == source), F.lit(0))["value"]
    nested = F.col("observation_concept_id") == FLOWSHEET
    parsed, origin = F.from_json("value_as_string", shape), F.from_json("observation_source_value", shape)
    names = concept.select(F.col("concept_id").alias("observation_source_concept_id"), F.col("concept_name").alias("_name"))
    # The nested texts are read before the rows are dealt, so that only what is picked from them moves.
    read = observation.select(
        "observation_id", "person_id", "observation_datetime", "observation_source_concept_id", nested.alias("_nested"),
        F.when(nested, pick(origin, "ip_flt_data.display_name")).otherwise(F.col("observation_source_value")).alias("source_display_name"),
        F.when(nested, pick(parsed, "ip_flo_gp_data.disp_name")).alias("_own"),
        F.when(nested, pick(parsed, "ip_flwsht_meas.meas_value"))
        .otherwise(F.coalesce("value_as_string", F.col("value_as_number").cast("string"))).alias("meas_value"),
        F.when(nested, pick(parsed, "ip_flo_gp_data.units")).otherwise(F.col("unit_source_value")).alias("unit_value"),
    )
    out = read.join(names, "observation_source_concept_id", "left").select(
        "observation_id", "person_id", "observation_datetime", "source_display_name",
        F.when(F.col("_nested"), F.col("_own")).otherwise(F.col("_name")).alias("display_name"), "meas_value", "unit_value")
    if visits is None:
        return out
    stays = visits.select("person_id", F.col("visit_occurrence_id"), "visit_start_datetime", "visit_end_datetime")
    points = out.select("person_id", "observation_datetime").distinct()
    inside = window_join(stays, points, ["person_id"], "visit_start_datetime", "visit_end_datetime", "observation_datetime")
    return out.join(inside.select("person_id", "observation_datetime", "visit_occurrence_id"), ["person_id", "observation_datetime"], "left")


def suspected_infection(
    admissions: DataFrame, measurement: DataFrame, drugs: DataFrame, ancestors: DataFrame, person: DataFrame
) -> DataFrame:
    """Admissions with a culture and a systemic antibiotic near each other.

    A culture day counts when an antibiotic day lies from one day before to
    three days after it; each culture day is expanded to those five days and
    met by equality, so culture and antibiotic pairs are never formed.  Days of
    both kinds meet the stays in one join.  The concept sets are written first, so
    that events of few concepts are not dealt by concept where the set is small.
    """
    below = lambda a, c: durable(ancestors.where(F.col("ancestor_concept_id") == a).select(F.col("descendant_concept_id").alias(c)).distinct())
    cultures = measurement.select("person_id", "measurement_concept_id", F.col("measurement_datetime").alias("_bc")).join(
        below(CULTURES, "measurement_concept_id"), "measurement_concept_id", "left_semi").drop("measurement_concept_id")
    abx = drugs.select("person_id", "drug_concept_id", F.col("drug_exposure_start_datetime").alias("_abx")).join(
        below(ANTIBIOTICS, "drug_concept_id"), "drug_concept_id", "left_semi").drop("drug_concept_id")
    stays = admissions.select(
        "person_id", F.col("admit_date").alias("admit_datetime"), F.col("discharge_date").alias("discharge_datetime"),
        (F.col("admit_date") - F.expr("interval 1 day")).alias("_from"))
    # The day of the event, at midnight, lies in the stay with one day of slack before it.
    firsts = cultures.unionByName(abx, allowMissingColumns=True).groupBy("person_id", F.coalesce("_bc", "_abx").cast("date").alias("_day")).agg(
        F.min("_bc").alias("_bc"), F.min("_abx").alias("_abx")).withColumn("_midnight", F.col("_day").cast("timestamp_ntz"))
    inside = window_join(stays, firsts, ["person_id"], "_from", "discharge_datetime", "_midnight")
    offsets = F.when(F.col("_bc").isNotNull(), F.sequence(F.lit(-1), F.lit(3))).otherwise(F.array(F.lit(0)))
    days = inside.select(*STAY, "discharge_datetime", "_day", "_bc", "_abx", F.explode(offsets).alias("_off")).groupBy(
        *STAY, "discharge_datetime", F.date_add("_day", F.col("_off")).alias("_at")).agg(
        F.min("_bc").alias("_bc"), F.min(F.when(F.col("_off") == 0, F.col("_abx"))).alias("_abx"))
    good = days.where(F.col("_bc").isNotNull() & F.col("_abx").isNotNull())
    births = person.select("person_id", "birth_datetime")
    return (
        good.groupBy(*STAY, "discharge_datetime").agg(F.min("_bc").alias("min_bc"), F.min("_abx").alias("min_systemic_abx"))
        .join(births, "person_id", "left")
        .select(
            "person_id", diff_months("admit_datetime", "birth_datetime").alias("age_in_months"),
            F.col("admit_datetime").cast("date").alias("admit_date"), "admit_datetime",
            F.col("discharge_datetime").cast("date").alias("discharge_date"), "discharge_datetime", "min_bc", "min_systemic_abx",
            F.least("min_bc", "min_systemic_abx").alias("sepsis_index_date"))
    )


def periods(infection: DataFrame, offsets=None) -> DataFrame:
    """Day windows of both periods around the index day."""
    rows = F.array(*[F.struct(F.lit(n).alias("period"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, (a, b) in (offsets or PERIODS).items()])
    index = F.col("sepsis_index_date").cast("date")
    return infection.select(*STAY, "discharge_datetime", index.alias("_index"), F.inline(rows)).select(
        *STAY, "discharge_datetime", "period", F.date_add("_index", F.col("a")).alias("lo"), F.date_add("_index", F.col("b")).alias("hi"))


def component_values(measurement: DataFrame, concept: DataFrame, ancestors: DataFrame, rules: str = "default") -> DataFrame:
    """(person_id, day, at, component, value) of the laboratory components, unit rules applied."""
    # Written first: where they are few, measurements are not dealt by their concept, of which there may be few as well.
    members = durable(expand_sets(concept, ancestors, SETS).select(F.col("set_name").alias("component"), F.col("concept_id").alias("measurement_concept_id")))
    value, code = F.col("value_as_number"), F.col("measurement_concept_id")
    rule = value
    for component, units in UNIT_RULES[rules].items():
        cases = " ".join(f"when {u} then value_as_number {r}" for u, r in units.items())
        rule = F.when(F.col("component") == component, F.expr(f"case unit_concept_id {cases} else value_as_number end")).otherwise(rule)
    at = F.col("measurement_datetime")
    labs = measurement.join(members, "measurement_concept_id").where(value > 0).select("person_id", at.alias("at"), "component", rule.alias("value"))
    direct = (
        F.when((code == COMA_SCORE) & value.between(3, 15), "gcs").when((code == MEAN_PRESSURE) & (value >= 10), "map")
        .when((code == OXYGEN_PRESSURE) & value.isNotNull(), "pao2").when((code == URINE) & (value >= 0), "urine")
    )
    known = measurement.where(code.isin(COMA_SCORE, MEAN_PRESSURE, OXYGEN_PRESSURE, URINE)).select(
        "person_id", at.alias("at"), direct.alias("component"), value.alias("value")).where(F.col("component").isNotNull())
    return labs.unionByName(known).withColumn("day", F.col("at").cast("date"))


def in_periods(infection: DataFrame, events: DataFrame) -> DataFrame:
    return window_join(periods(infection), events, ["person_id"], "lo", "hi", "day")


def component_extremes(infection: DataFrame, values: DataFrame) -> DataFrame:
    """Extreme value of every laboratory component, both periods in one aggregation."""
    kept = values.where(~F.col("component").isin("pao2", "urine"))
    pick = lambda fn, n: fn(F.when(F.col("component") == n, F.col("value")))
    return in_periods(infection, kept).groupBy(*STAY, "period").agg(
        pick(F.min, "platelet").alias("min_platelet"), pick(F.max, "creatinine").alias("max_creatinine"), pick(F.min, "gcs").alias("min_gcs"),
        pick(F.max, "bilirubin").alias("max_bilirubin"), pick(F.max, "lactate").alias("max_lactate"), pick(F.min, "map").alias("min_map"))


def ventilation(infection: DataFrame, sheets: DataFrame) -> DataFrame:
    """Number of ventilation-mode entries other than stand-by and monitor."""
    modes = sheets.where(
        F.upper("display_name").isin("VENT MODE", "VENTILATION MODE") & ~F.col("meas_value").isin("STANDBY", "MONITOR")
    ).groupBy("person_id", F.col("observation_datetime").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return in_periods(infection, modes).groupBy(*STAY, "period").agg(F.sum("n").alias("count_vent_mode"))


def inspired_oxygen(sheets: DataFrame) -> DataFrame:
    """FiO2 as a fraction in [0.21, 1]."""
    name, number = F.upper("display_name"), F.col("meas_value").try_cast("double")
    chosen = (name == "FIO2 (%)") | ((name == "FIO2 %") & (F.upper("source_display_name") == "RN CLINICAL SCREENING"))
    fraction = F.when(number > 1, number / 100).otherwise(number)
    return sheets.where(chosen).select("person_id", F.col("observation_datetime").alias("at"), fraction.alias("value")).where(
        F.col("value").between(0.21, 1.0))


def oxygen_saturation(sheets: DataFrame) -> DataFrame:
    name, source, number = F.upper("display_name"), F.upper("source_display_name"), F.col("meas_value").try_cast("double")
    chosen = ((name == "OXYGEN SATURATION") & (source == "SPO2")) | (name.like("SPO2 - %") & (source == "DEVICES TESTING TEMPLATE"))
    return sheets.where(chosen & (number > 0) & (number <= 100)).select(
        "person_id", F.col("observation_datetime").alias("at"), number.alias("value"))


def oxygen_ratio(infection: DataFrame, oxygen: DataFrame, inspired: DataFrame, out: str, tolerance_minutes: int = 1440) -> DataFrame:
    """Lowest oxygen / FiO2 ratio, each oxygen value against the latest FiO2 at or before it.

    The two series are merged per stay and period and FiO2 is carried forward,
    split by day; at one instant the largest FiO2 and smallest oxygen count.
    """
    kinds = inspired.groupBy("person_id", "at").agg(F.max("value").alias("fio2")).withColumn("_k", F.lit(0)).unionByName(
        oxygen.groupBy("person_id", "at").agg(F.min("value").alias("oxygen")).withColumn("_k", F.lit(1)), allowMissingColumns=True)
    merged = in_periods(infection, kinds.withColumn("day", F.col("at").cast("date"))).select(*STAY, "period", "at", "_k", "fio2", "oxygen")
    held = merged.withColumn("_f", F.when(F.col("fio2").isNotNull(), F.struct(F.col("at").alias("t"), F.col("fio2").alias("v"))))
    asof = carry_last(held, [*STAY, "period"], ["at", "_k"], "at", "_f", "_last").where("_k = 1")
    near = diff_minutes("at", F.col("_last.t")) <= tolerance_minutes
    return asof.where(near).groupBy(*STAY, "period").agg(F.min(F.col("oxygen") / F.col("_last.v")).alias(out))


def vasopressor_days(infection: DataFrame, drugs: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Longest exposure in days per vasopressor, for spans that overlap the period."""
    tops = F.create_map(*[x for n, a in VASOPRESSORS.items() for x in (F.lit(a), F.lit(n))])
    members = ancestors.where(F.col("ancestor_concept_id").isin(*VASOPRESSORS.values())).select(
        F.col("descendant_concept_id").alias("drug_concept_id"), tops[F.col("ancestor_concept_id").cast("int")].alias("drug")).distinct()
    spans = drugs.join(members, "drug_concept_id").select(
        "person_id", "drug", F.col("drug_exposure_start_datetime").cast("date").alias("start"),
        F.col("drug_exposure_end_datetime").cast("date").alias("end")).distinct()
    hits = overlap_join(periods(infection, DRUG_PERIODS), spans, ["person_id"], ("lo", "hi"), ("start", "end"))
    days = diff_days("end", "start") + 1
    return hits.groupBy(*STAY, "period").agg(
        *[F.max(F.when(F.col("drug") == n, days)).alias(f"max_{n}_days") for n in VASOPRESSORS])


def urine_output(infection: DataFrame, values: DataFrame, sheets: DataFrame, legacy_discharge: bool = False) -> DataFrame:
    """Lowest daily urine output; the first and last day are scaled to 24 hours.

    The admit day uses the hours left after its first charted time, the
    discharge day the hour of its last one (hour 0 counts as one hour).
    ``legacy_discharge`` takes the last charted time of the admit day instead.
    """
    urine = values.where(F.col("component") == "urine").groupBy("person_id", "day").agg(F.sum("value").alias("volume"))
    daily = in_periods(infection, urine)
    at = F.col("observation_datetime")
    charted = sheets.where(at != F.date_trunc("day", at)).groupBy("person_id", at.cast("date").alias("_day")).agg(
        F.hour(F.min(at)).alias("_first"), F.hour(F.max(at)).alias("_last"))
    first = charted.select("person_id", F.col("_day").alias("_admit"), "_first")
    last = charted.select("person_id", F.col("_day").alias("_leave"), "_last")
    leave = F.col("admit_datetime" if legacy_discharge else "discharge_datetime").cast("date")
    rows = (
        daily.withColumn("_admit", F.col("admit_datetime").cast("date")).withColumn("_leave", leave)
        .join(first, ["person_id", "_admit"], "left").join(last, ["person_id", "_leave"], "left")
    )
    is_admit, is_leave = F.col("day") == F.col("_admit"), F.col("day") == F.col("discharge_datetime").cast("date")
    by_admit = F.when(is_admit, F.col("volume") * 24 / (24 - F.col("_first")))
    by_leave = F.when(is_leave, F.col("volume") * 24 / F.when(F.col("_last") == 0, 1).otherwise(F.col("_last")))
    scaled = F.when(~is_admit & ~is_leave, F.col("volume")).otherwise(F.least(by_admit, by_leave))
    return rows.withColumn("_scaled", scaled).groupBy(*STAY, "period").agg(F.min("_scaled").alias("min_urine_daily"))


def _steps(value: Column, cuts, low: bool) -> Column:
    """4, 3, 2, 1 for the first cut that is passed, else 0."""
    out = None
    for score, cut in cuts:
        hit = value < cut if low else value >= cut
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(0)


def scores(components: DataFrame) -> DataFrame:
    """Organ sub-scores and shock flags of one row per stay and period."""
    c = F.col
    age = c("age_in_months")
    creatinine = pressure = None
    strong = c("max_epinephrine_days").isNotNull() | c("max_norepinephrine_days").isNotNull()
    weak = c("max_dopamine_days").isNotNull() | c("max_dobutamine_days").isNotNull()
    for months, cuts, limit in AGE_BANDS:
        step, low = _steps(c("max_creatinine"), zip((4, 3, 2, 1), cuts), False), F.when(c("min_map") < limit, 1).otherwise(0)
        if creatinine is None:
            creatinine, pressure = F.when(age >= months, step), F.when(age >= months, low)
        elif months is not None:
            creatinine, pressure = creatinine.when(age >= months, step), pressure.when(age >= months, low)
        else:
            creatinine, pressure = creatinine.otherwise(step), pressure.otherwise(low)
    vent = c("count_vent_mode").isNotNull()

    def respiratory(ratio, severe, high, mid, mild):
        r = c(ratio)
        return F.when(vent & (r < severe), 4).when(vent & (r < high), 3).when(r < mid, 2).when(r < mild, 1).otherwise(0)

    flag = lambda cond: F.when(cond, 1).otherwise(0)
    return (
        components
        .withColumn("plat_sofa", _steps(c("min_platelet"), [(4, 20), (3, 50), (2, 100), (1, 150)], True))
        .withColumn("bili_sofa", _steps(c("max_bilirubin"), [(4, 12), (3, 6), (2, 2), (1, 1.2)], False))
        .withColumn("crea_sofa", creatinine)
        .withColumn("cv_sofa", F.when(strong, 3).when(weak, 2).otherwise(pressure))
        .withColumn("pao2_resp_sofa", respiratory("min_pao2fio2_ratio", 100, 200, 300, 400))
        .withColumn("spo2_resp_sofa", respiratory("min_spo2fio2_ratio", 148, 221, 264, 292))
        .withColumn("resp_sofa", F.greatest("pao2_resp_sofa", "spo2_resp_sofa"))
        .withColumn("gcs_sofa", _steps(c("min_gcs"), [(4, 6), (3, 10), (2, 13), (1, 15)], True))
        .withColumn("urine_sofa", _steps(c("min_urine_daily"), [(4, 200), (3, 500)], True))
        .withColumn("vaso_shock", flag(strong | weak))
        .withColumn("map_shock", flag(c("min_map") < 65))
        .withColumn("lact_shock", flag(c("max_lactate") > 2))
    )


ORGANS = ["plat_sofa", "bili_sofa", "crea_sofa", "cv_sofa", "resp_sofa", "gcs_sofa", "urine_sofa"]
SHOCKS = ["vaso_shock", "map_shock", "lact_shock"]


def differences(scored: DataFrame) -> DataFrame:
    """Current minus prior scores; flags per organ, total and shock, one row per stay."""
    total = sum((F.col(o) for o in ORGANS[1:]), F.col(ORGANS[0]))
    shock = sum((F.col(s) for s in SHOCKS[1:]), F.col(SHOCKS[0]))
    rows = scored.withColumn("sofa_score", total).withColumn("shock_score", shock)
    names = [*ORGANS, *SHOCKS, "sofa_score", "shock_score"]
    # Both periods of a stay meet in one aggregation, so the scored rows are read once.
    of = lambda n, p: F.max(F.when(F.col("period") == p, F.col(n)))
    out = rows.groupBy(*STAY, "admit_date", "sepsis_index_date").agg(
        *[of(n, "current").alias(n) for n in names], *[of(n, "prior").alias(f"{n}_prior") for n in names])
    yes = lambda cond: F.when(cond, "Yes").otherwise("No")
    gap = lambda n: F.col(n) - F.col(f"{n}_prior")
    out = out.withColumn("sofa_score_diff", gap("sofa_score"))
    out = (
        out.withColumn("sofa_current", yes(F.col("sofa_score") >= 2)).withColumn("sofa_prior", yes(F.col("sofa_score_prior") >= 2))
        .withColumn("sofa_diff", yes(F.col("sofa_score_diff") >= 2)).withColumn("shock", yes(F.col("shock_score") == 2))
        .withColumn("shock_prior", yes(F.col("shock_score_prior") == 2)).withColumn("shock_diff", yes(gap("shock_score") == 2))
    )
    for o in ORGANS:
        out = out.withColumn(f"{o}_gt2", (F.col(o) >= 2).cast("int")).withColumn(f"{o}_prior_gt2", (F.col(f"{o}_prior") >= 2).cast("int"))
        out = out.withColumn(f"{o}_gt2_diff", (gap(o) >= 2).cast("int"))
    for s in SHOCKS:
        out = out.withColumn(f"{s}_diff", (gap(s) == 1).cast("int"))
    return out


def oxygen_ratios(values: DataFrame, sheets: DataFrame, tolerance_minutes: int = 1440) -> DataFrame:
    """(person_id, day, kind, value, since): both oxygen / FiO2 ratios of every instant, against the latest FiO2 at or before it.

    Both oxygen series and FiO2 share one row per person and instant, and FiO2 is
    carried forward per person, split by day.  ``since`` is the day of that FiO2: in a
    period it counts if it lies inside, as the latest one of the period does.
    """
    series = {"fio2": inspired_oxygen(sheets), "pao2": values.where("component = 'pao2'"), "spo2": oxygen_saturation(sheets)}
    rows = union_all([df.select("person_id", "at", *[(F.col("value") if n == k else F.lit(None).cast("double")).alias(k) for k in series]) for n, df in series.items()])
    instants = rows.groupBy("person_id", "at").agg(F.max("fio2").alias("fio2"), F.min("pao2").alias("pao2"), F.min("spo2").alias("spo2"))
    held = instants.withColumn("_f", F.when(F.col("fio2").isNotNull(), F.struct(F.col("at").alias("t"), F.col("fio2").alias("v"))))
    asof = carry_last(held, ["person_id"], ["at"], "at", "_f", "_last").where(diff_minutes("at", F.col("_last.t")) <= tolerance_minutes)
    pairs = F.array(*[F.when(F.col(o).isNotNull(), F.struct(F.lit(k).alias("kind"), (F.col(o) / F.col("_last.v")).alias("value"))) for k, o in (("pf", "pao2"), ("sf", "spo2"))])
    return asof.select("person_id", F.col("at").cast("date").alias("day"), F.col("_last.t").cast("date").alias("since"), F.inline(F.array_compact(pairs)))


def component_stream(values: DataFrame, sheets: DataFrame) -> DataFrame:
    """(person_id, day, kind, value, since, first_hour, last_hour): everything that a period is scored by, in one table."""
    at = F.col("observation_datetime")
    labs = values.where(~F.col("component").isin("pao2", "urine")).select("person_id", "day", F.col("component").alias("kind"), "value")
    modes = F.upper("display_name").isin("VENT MODE", "VENTILATION MODE") & ~F.col("meas_value").isin("STANDBY", "MONITOR")
    vents = sheets.where(modes).select("person_id", at.cast("date").alias("day"), F.lit("vent").alias("kind"), F.lit(1.0).alias("value"))
    # Urine volumes and charted hours of a day meet in one aggregation; days without urine go out.
    volumes = values.where("component = 'urine'").select("person_id", "day", "value")
    charted = sheets.where(at != F.date_trunc("day", at)).select("person_id", at.cast("date").alias("day"), at.alias("_at"))
    daily = volumes.unionByName(charted, allowMissingColumns=True).groupBy("person_id", "day").agg(
        F.sum("value").alias("value"), F.hour(F.min("_at")).alias("first_hour"), F.hour(F.max("_at")).alias("last_hour"))
    urine = daily.where("value IS NOT NULL").withColumn("kind", F.lit("urine"))
    return union_all([labs, vents, urine, oxygen_ratios(values, sheets)])


def components(t, infection: DataFrame, sheets: DataFrame, rules: str = "default") -> DataFrame:
    """Every component of both periods, one row per stay and period.

    All but the drug spans come as one stream of (person, day) events that meets the
    periods in one bucketed join and one aggregation; the values are written once, since
    several parts of the stream read them.
    """
    values = durable(component_values(t.measurement, t.concept, t.concept_ancestor, rules))
    kept = infection.select(*STAY, "age_in_months", "admit_date", "sepsis_index_date")
    base = periods(infection).select(*STAY, "period").join(kept, STAY)
    rows = in_periods(infection, component_stream(values, sheets))
    value, day = F.col("value"), F.col("day")
    pick = lambda fn, n: fn(F.when(F.col("kind") == n, value))
    admits, leaves = day == F.col("admit_datetime").cast("date"), day == F.col("discharge_datetime").cast("date")
    by_admit = F.when(admits, value * 24 / (24 - F.col("first_hour")))
    by_leave = F.when(leaves, value * 24 / F.when(F.col("last_hour") == 0, 1).otherwise(F.col("last_hour")))
    scaled = F.when(~admits & ~leaves, value).otherwise(F.least(by_admit, by_leave))
    ratio = lambda n: F.min(F.when((F.col("kind") == n) & (F.col("since") >= F.col("lo")), value))
    found = rows.groupBy(*STAY, "period").agg(
        pick(F.min, "platelet").alias("min_platelet"), pick(F.max, "creatinine").alias("max_creatinine"), pick(F.min, "gcs").alias("min_gcs"),
        pick(F.max, "bilirubin").alias("max_bilirubin"), pick(F.max, "lactate").alias("max_lactate"), pick(F.min, "map").alias("min_map"),
        F.sum(F.when(F.col("kind") == "vent", 1)).alias("count_vent_mode"), ratio("pf").alias("min_pao2fio2_ratio"), ratio("sf").alias("min_spo2fio2_ratio"),
        F.min(F.when(F.col("kind") == "urine", scaled)).alias("min_urine_daily"))
    return base.join(found, [*STAY, "period"], "left").join(vasopressor_days(infection, t.drug_exposure, t.concept_ancestor), [*STAY, "period"], "left")


def sepsis_label(admissions: DataFrame, difference: DataFrame) -> DataFrame:
    """Index date and 1 when the score rose by two or more."""
    found = difference.select("person_id", F.col("admit_datetime").alias("admit_date"), "sepsis_index_date", "sofa_diff")
    return admissions.join(found, ["person_id", "admit_date"], "left").withColumn(
        "sepsis", F.when(F.col("sofa_diff") == "Yes", 1).otherwise(0)).drop("sofa_diff")
