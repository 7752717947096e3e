"""Time-binned feature extraction, vocabularies and sparse triples.

One scan per source table serves every time bin: events are first counted per
(person, concept, instant), cohort rows are repeated once per bin, and both
meet on (person, grain, time bucket).  Long bins use a coarse grain and short
bins a fine one, so a cohort row is repeated a few dozen times at most and a
person's events are spread over the buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import dense_index, durable, union_all, values_at_ranks
from ..functions.timeunits import diff_years, epoch_day

FINE_DAYS, COARSE_DAYS = 32, 1024
ALL_HISTORY = -100 * 365


@dataclass(frozen=True)
class Source:
    """Concept and time columns of an event table."""

    table: str
    concept: str
    date: str
    datetime: str


# Event tables of the count analyses.
SOURCES = {
    "condition_occurrence": Source("condition_occurrence", "condition_concept_id", "condition_start_date", "condition_start_datetime"),
    "drug_exposure": Source("drug_exposure", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_start_datetime"),
    "device_exposure": Source("device_exposure", "device_concept_id", "device_exposure_start_date", "device_exposure_start_datetime"),
    "measurement": Source("measurement", "measurement_concept_id", "measurement_date", "measurement_datetime"),
    "procedure_occurrence": Source("procedure_occurrence", "procedure_concept_id", "procedure_date", "procedure_datetime"),
    "note_type": Source("note", "note_type_concept_id", "note_date", "note_datetime"),
    "observation": Source("observation", "observation_concept_id", "observation_date", "observation_datetime"),
}
DELAYED = ("condition_occurrence", "procedure_occurrence", "note_type")


def time_bins(bins=None, include_all_history=True, inclusive_right=False, all_history_bound=ALL_HISTORY):
    """List of (left, right) offsets; the right edge is one short for dates."""
    if bins is None and not include_all_history:
        raise ValueError("without bins the all-history bin is required")
    shrink = 0 if inclusive_right else -1
    out = [(all_history_bound, shrink)] if include_all_history else []
    return out + [(a, b + shrink) for a, b in zip(bins or [], (bins or [])[1:])]


def standard_only(events: DataFrame, concept: DataFrame, key: str = "concept_id") -> DataFrame:
    standard = concept.where(F.col("standard_concept") == "S").select(F.col("concept_id").alias(key))
    return events.join(standard, key, "left_semi")


def day_events(t, analysis: str, concept: DataFrame, at: str = "date") -> DataFrame:
    """(person_id, concept_id, at) of a source table, standard concepts only."""
    s = SOURCES[analysis]
    events = getattr(t, s.table)
    when = F.col(s.date).cast("date") if at == "date" else F.col(s.datetime)
    if at == "datetime":  # rows stamped exactly midnight carry no hour
        events = events.where(F.col(s.date).cast("timestamp_ntz") != F.col(s.datetime))
    return standard_only(events.select("person_id", F.col(s.concept).alias("concept_id"), when.alias("at")), concept)


def delayed_events(t, analysis: str, concept: DataFrame) -> DataFrame:
    """As ``day_events`` with the event day replaced by the end of its visit."""
    s = SOURCES[analysis]
    events = getattr(t, s.table).select("person_id", "visit_occurrence_id", F.col(s.concept).alias("concept_id"))
    ends = t.visit_occurrence.select("visit_occurrence_id", F.col("visit_end_date").alias("at"))
    return standard_only(events, concept).join(ends, "visit_occurrence_id").drop("visit_occurrence_id")


def note_events(t, concept: DataFrame, mode: str = "date") -> DataFrame:
    """Concepts extracted from notes, marked by whether the term exists."""
    found = standard_only(t.note_nlp.select("note_id", "note_nlp_concept_id", "term_exists"), concept, "note_nlp_concept_id")
    notes = t.note
    if mode == "delayed":
        ends = t.visit_occurrence.select("visit_occurrence_id", F.col("visit_end_date").alias("at"))
        notes = notes.join(ends, "visit_occurrence_id")
    elif mode == "datetime":
        notes = notes.where(F.col("note_date").cast("timestamp_ntz") != F.col("note_datetime")).withColumn("at", F.col("note_datetime"))
    else:
        notes = notes.withColumn("at", F.col("note_date").cast("date"))
    named = F.concat_ws("_", F.col("note_nlp_concept_id").cast("string"), "term_exists")
    return found.join(notes.select("note_id", "person_id", "at"), "note_id").select("person_id", named.alias("concept_id"), "at")


def range_events(t, concept: DataFrame, at: str = "date") -> DataFrame:
    """Measurements classed as abnormal high, abnormal low or normal."""
    value = F.col("value_as_number")
    kind = F.when(value > F.col("range_high"), "abnormal_high").when(value < F.col("range_low"), "abnormal_low").otherwise("normal")
    m = t.measurement.where(value.isNotNull() & F.col("range_low").isNotNull() & F.col("range_high").isNotNull())
    if at == "datetime":
        m = m.where(F.col("measurement_date").cast("timestamp_ntz") != F.col("measurement_datetime"))
    when = F.col("measurement_date" if at == "date" else "measurement_datetime")
    kept = standard_only(m, concept, "measurement_concept_id")
    return kept.select("person_id", F.concat_ws("_", F.col("measurement_concept_id").cast("string"), kind).alias("concept_id"), when.alias("at"))


def _windows(cohort: DataFrame, bins, hourly: bool) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(a).alias("l"), F.lit(b).alias("r")) for a, b in bins])
    out = cohort.select("row_id", "person_id", "index_date", F.explode(rows).alias("_bin"))
    index = F.col("index_date").cast("timestamp_ntz") if hourly else F.col("index_date").cast("date")
    if hourly:
        lo = index + F.make_dt_interval(F.lit(0), F.col("_bin.l"))
        hi = index + F.make_dt_interval(F.lit(0), F.col("_bin.r"))
    else:
        lo, hi = F.date_add(index, F.col("_bin.l")), F.date_add(index, F.col("_bin.r"))
    return out.select(
        "row_id", "person_id", index.alias("index_date"), lo.alias("_lo"), hi.alias("_hi"),
        F.concat_ws("_", F.lit("bin"), F.col("_bin.l").cast("string"), F.col("_bin.r").cast("string")).alias("time_bin"),
    )


def in_bins(cohort: DataFrame, events: DataFrame, bins, hourly: bool = False) -> DataFrame:
    """Counted events of every (cohort row, bin); ``events`` holds ``n``."""
    windows = _windows(cohort, bins, hourly).where(F.col("_lo") <= F.col("_hi"))
    spans = [(b - a) / (24 if hourly else 1) for a, b in bins]
    grains = sorted({COARSE_DAYS if s > 12 * FINE_DAYS else FINE_DAYS for s in spans})
    length = epoch_day("_hi") - epoch_day("_lo")
    grain = F.when(length > 12 * FINE_DAYS, COARSE_DAYS).otherwise(FINE_DAYS)
    left = windows.withColumn("_g", grain).withColumn(
        "_b", F.explode(F.sequence(F.floor(epoch_day("_lo") / F.col("_g")), F.floor(epoch_day("_hi") / F.col("_g"))))
    )
    right = events.withColumn("_g", F.explode(F.array(*[F.lit(g) for g in grains]))).withColumn(
        "_b", F.floor(epoch_day("at") / F.col("_g"))
    )
    return left.join(right, ["person_id", "_g", "_b"]).where(F.col("at").between(F.col("_lo"), F.col("_hi"))).drop("_g", "_b", "_lo", "_hi")


def count_features(cohort: DataFrame, events: DataFrame, bins, analysis_id: str, hourly: bool = False) -> DataFrame:
    counted = events.groupBy("person_id", F.col("concept_id").cast("string").alias("concept_id"), "at").agg(F.count(F.lit(1)).alias("n"))
    return _counted(in_bins(cohort, counted, bins, hourly), analysis_id)


def _counted(hits: DataFrame, analysis_id: str) -> DataFrame:
    keys = ["row_id", "person_id", "index_date", "concept_id", "time_bin"]
    return (
        hits.groupBy(*keys).agg(F.sum("n").alias("concept_count"))
        .withColumn("analysis_id", F.lit(analysis_id))
        .withColumn("feature_id", F.concat_ws("_", "concept_id", "time_bin", "analysis_id"))
        .select("row_id", "person_id", "index_date", "concept_id", "analysis_id", "time_bin", "feature_id", "concept_count")
    )


def value_bin_features(
    cohort: DataFrame, t, concept: DataFrame, bins, num_bins: int = 5, analysis_id: str = "measurement_bin", hourly: bool = False
) -> DataFrame:
    """Counts of measurement values in per-concept quantile bins.

    Quantiles are taken over the values inside each time bin, exact and by counted
    values; a value on an inner edge falls into both neighbours.  The edge table has at
    most ``num_bins`` rows per concept and bin and joins on both.  The values in bins
    are written once for edges and counts.
    """
    m = t.measurement.where(F.col("value_as_number").isNotNull())
    if hourly:
        m = m.where(F.col("measurement_date").cast("timestamp_ntz") != F.col("measurement_datetime"))
    when = F.col("measurement_datetime" if hourly else "measurement_date")
    events = (
        standard_only(m, concept, "measurement_concept_id")
        .groupBy("person_id", "measurement_concept_id", F.col("value_as_number").alias("value"), when.alias("at"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hits = durable(in_bins(cohort, events, bins, hourly))
    keys = ["measurement_concept_id", "time_bin"]
    # Edge i is the value at rank ceil(n * i / num_bins), counted from 1, over all values.
    rank = lambda total, i: F.greatest(F.floor((total * i + num_bins - 1) / num_bins) - 1, F.lit(0)).cast("bigint")
    points = values_at_ranks(hits, keys, "value", lambda total: F.array_distinct(F.array(*[rank(total, i) for i in range(num_bins + 1)])), "n")
    # At most num_bins + 1 entries per concept and bin.
    placed = points.select(*keys, "value", "total", F.explode("ranks").alias("rank")).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_m"), F.max("total").alias("total"))
    edge = lambda i: F.col("_m")[rank(F.col("total"), i)]
    spans = F.array(*[F.struct(F.lit(i).alias("_i"), edge(i).alias("lo"), edge(i + 1).alias("hi")) for i in range(num_bins)])
    edges = placed.select(*keys, F.inline(spans))
    text = lambda c: F.round(c, 4).cast("string")
    name = F.concat_ws("_", F.col("measurement_concept_id").cast("string"), F.lit("bin"), (F.col("_i") + 1).cast("string"), text("lo"), text("hi"))
    binned = (
        hits.join(edges, ["measurement_concept_id", "time_bin"])
        .where(F.col("value").between(F.col("lo"), F.col("hi")))
        .withColumn("concept_id", name)
    )
    return _counted(binned, analysis_id)


def static_features(cohort: DataFrame, person: DataFrame, column: str, analysis_id: str) -> DataFrame:
    people = person.select("person_id", F.col(column).cast("string").alias("concept_id"))
    return _static(cohort.join(people, "person_id"), analysis_id)


def _static(df: DataFrame, analysis_id: str) -> DataFrame:
    return df.select(
        "row_id", "person_id", F.col("index_date").cast("date").alias("index_date"), "concept_id", F.lit(analysis_id).alias("analysis_id"),
        F.lit("static").alias("time_bin"), F.concat_ws("_", "concept_id", F.lit(analysis_id)).alias("feature_id"),
        F.lit(1).cast("bigint").alias("concept_count"),
    )


def age_group_features(cohort: DataFrame, person: DataFrame, age_bin_size: int = 5) -> DataFrame:
    years = F.coalesce(diff_years("index_date", "birth_datetime"), F.year("index_date") - F.col("year_of_birth"))
    people = person.select("person_id", "birth_datetime", "year_of_birth")
    named = F.concat(F.lit("age_group_"), F.floor(years / age_bin_size).cast("string"))
    return _static(cohort.join(people, "person_id").withColumn("concept_id", named), "age_group")


def visit_counts(cohort: DataFrame, visits: DataFrame, bins, by_concept: bool) -> DataFrame:
    what = F.col("visit_concept_id").cast("string") if by_concept else F.lit("visit")
    events = visits.select("person_id", what.alias("concept_id"), F.col("visit_start_date").alias("at"))
    return count_features(cohort, events, bins, "visit_concept_count" if by_concept else "visit_count")


class Featurizer:
    """Registry of analyses over one cohort (row_id, person_id, index_date)."""

    def __init__(self, t, cohort: DataFrame, bins=None, hour_bins=None, include_all_history=True, age_bin_size=5, num_bins=5):
        days = time_bins(bins, include_all_history)
        hours = time_bins(hour_bins, False, inclusive_right=True) if hour_bins else []
        concept = t.concept
        self.analyses: dict[str, Callable[[], DataFrame]] = {}
        add = self.analyses.__setitem__
        count = lambda events, a, h=False: count_features(cohort, events, hours if h else days, a, h)
        for a in SOURCES:
            add(a, lambda a=a: count(day_events(t, a, concept), a))
            if hours:
                add(f"{a}_dt", lambda a=a: count(day_events(t, a, concept, "datetime"), f"{a}_dt", True))
        for a in DELAYED:
            add(f"{a}_delayed", lambda a=a: count(delayed_events(t, a, concept), f"{a}_delayed"))
        add("note_nlp", lambda: count(note_events(t, concept), "note_nlp"))
        add("note_nlp_delayed", lambda: count(note_events(t, concept, "delayed"), "note_nlp_delayed"))
        add("measurement_range", lambda: count(range_events(t, concept), "measurement_range"))
        add("measurement_bin", lambda: value_bin_features(cohort, t, concept, days, num_bins))
        if hours:
            add("note_nlp_dt", lambda: count(note_events(t, concept, "datetime"), "note_nlp_dt", True))
            add("measurement_range_dt", lambda: count(range_events(t, concept, "datetime"), "measurement_range_dt", True))
            add("measurement_bin_dt", lambda: value_bin_features(cohort, t, concept, hours, num_bins, "measurement_bin_dt", True))
        for part in ("gender", "race", "ethnicity"):
            add(part, lambda p=part: static_features(cohort, t.person, f"{p}_concept_id", p))
        add("age_group", lambda: age_group_features(cohort, t.person, age_bin_size))
        add("visit_count", lambda: visit_counts(cohort, t.visit_occurrence, days, False))
        add("visit_concept_count", lambda: visit_counts(cohort, t.visit_occurrence, days, True))

    def featurize(self, include=None, exclude=()) -> dict[str, DataFrame]:
        names = list(include) if include is not None else list(self.analyses)
        unknown = [n for n in [*names, *exclude] if n not in self.analyses]
        if unknown:
            raise KeyError(f"unknown analyses: {unknown}")
        return {n: self.analyses[n]() for n in names if n not in exclude}


def merge_features(frames, binary: bool = False) -> DataFrame:
    """Union of feature tables; call ``orderBy('row_id')`` on the result to write it sorted."""
    value = (F.col("concept_count") > 0).cast("bigint") if binary else F.col("concept_count")
    return union_all([f.select("row_id", "person_id", "feature_id", value.alias("concept_count")) for f in frames])


def vocabulary(features: DataFrame, key: str = "feature_id", out: str = "col_id") -> DataFrame:
    """Distinct features numbered from 0 by sorted name."""
    return dense_index(features.select(key).distinct(), [key], out)


def sparse_matrix(features: DataFrame, existing_vocabulary: DataFrame | None = None):
    """(triples, row map, vocabulary).  An existing vocabulary is honoured: its
    column numbers are used and unknown features are left out.  The long table
    is written once, since three results are read from it."""
    features = durable(features)
    vocab = existing_vocabulary if existing_vocabulary is not None else vocabulary(features)
    rows = dense_index(features.select("row_id").distinct(), ["row_id"], "features_row_id")
    triples = (
        features.join(vocab, "feature_id").join(rows, "row_id")
        .groupBy("features_row_id", "col_id").agg(F.sum("concept_count").alias("value"))
    )
    return triples, rows, vocab


def renumber(triples: DataFrame, keep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep a column list and number its columns from 0; (triples, column map)."""
    columns = dense_index(keep.select("col_id").distinct(), ["col_id"], "new_col_id")
    out = triples.join(columns, "col_id").select("features_row_id", F.col("new_col_id").alias("col_id"), "value")
    return out, columns


def usage_by_population(triples: DataFrame, row_groups: DataFrame, vocab: DataFrame) -> DataFrame:
    """Where each column occurs: pediatric only, adult only, both or neither."""
    seen = triples.join(row_groups, "features_row_id").groupBy("col_id").agg(
        F.max(F.when(F.col("adult") == 1, 1).otherwise(0)).alias("in_adult"),
        F.max(F.when(F.col("adult") == 0, 1).otherwise(0)).alias("in_pediatric"),
    )
    adult, child = F.coalesce("in_adult", F.lit(0)) == 1, F.coalesce("in_pediatric", F.lit(0)) == 1
    kind = F.when(adult & child, "both").when(adult, "adult_only").when(child, "pediatric_only").otherwise("neither")
    return vocab.join(seen, "col_id", "left").select("feature_id", "col_id", kind.alias("usage"))


# Windows of the covariate presets, in days before the index day.
PRESET_WINDOWS = {"any": (ALL_HISTORY, -1), "long": (-365, -1), "medium": (-180, -1), "short": (-30, -1)}
_STATIC = ["gender", "age_group", "race", "ethnicity"]
_EVENTS = ["condition_occurrence", "drug_exposure", "procedure_occurrence", "device_exposure"]
_VISITS = ["visit_count", "visit_concept_count"]
_ALL = ["any", "long", "medium", "short"]
_RECENT = ["long", "medium", "short"]
# Covariate presets: analyses and the windows they use; era analyses count the
# occurrence tables rolled up to their concept ancestors.
PRESETS: dict[str, dict[str, list[str]]] = {
    "all_covariates": {
        **{a: _ALL for a in [*_EVENTS, "measurement", "observation"]},
        **{a: _RECENT for a in ["measurement_range", *_VISITS]}, **{a: [] for a in _STATIC},
    },
    "no_measurement_observation": {
        **{a: _ALL for a in _EVENTS}, **{a: _RECENT for a in _VISITS}, **{a: [] for a in _STATIC},
    },
    "no_observation": {
        **{a: _ALL for a in [*_EVENTS, "measurement"]},
        **{a: _RECENT for a in ["measurement_range", *_VISITS]}, **{a: [] for a in _STATIC},
    },
    "binary_history": {
        **{a: ["any"] for a in [*_EVENTS, "condition_group_era", "drug_group_era", "measurement", "observation"]},
        **{a: [] for a in _STATIC},
    },
    "demographics": {a: [] for a in _STATIC},
    "condition_occurrence": {"condition_occurrence": _ALL},
    "condition_group_era": {"condition_group_era": _ALL},
    "drug_exposure": {"drug_exposure": _ALL},
    "drug_group_era": {"drug_group_era": _ALL},
    "procedure": {"procedure_occurrence": _ALL},
    "device": {"device_exposure": _ALL},
    "measurement": {"measurement": _ALL},
    "measurement_range_group": {"measurement_range": _ALL},
    "observation": {"observation": _ALL},
}


def group_events(events: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Events repeated under every concept ancestor (group form of an analysis)."""
    up = ancestors.select(F.col("descendant_concept_id").alias("concept_id"), "ancestor_concept_id").distinct()
    return events.join(up, "concept_id").select("person_id", F.col("ancestor_concept_id").alias("concept_id"), "at")


def index_calendar(cohort: DataFrame) -> DataFrame:
    """Index year and month as static features."""
    year = _static(cohort.withColumn("concept_id", F.year("index_date").cast("string")), "index_year")
    return year.unionByName(_static(cohort.withColumn("concept_id", F.month("index_date").cast("string")), "index_month"))


def preset_features(t, cohort: DataFrame, preset: str) -> DataFrame:
    """Union of the analyses of a preset, every window of an analysis in one scan."""
    concept, frames = t.concept, []
    for analysis, windows in PRESETS[preset].items():
        bins = [PRESET_WINDOWS[w] for w in windows]
        if analysis == "age_group":
            frames.append(age_group_features(cohort, t.person))
            frames.append(index_calendar(cohort))
        elif analysis in _STATIC:
            frames.append(static_features(cohort, t.person, f"{analysis}_concept_id", analysis))
        elif analysis in _VISITS:
            frames.append(visit_counts(cohort, t.visit_occurrence, bins, analysis == "visit_concept_count"))
        elif analysis == "measurement_range":
            frames.append(count_features(cohort, range_events(t, concept), bins, analysis))
        elif analysis.endswith("_group_era"):
            base = "condition_occurrence" if analysis.startswith("condition") else "drug_exposure"
            frames.append(count_features(cohort, group_events(day_events(t, base, concept), t.concept_ancestor), bins, analysis))
        else:
            frames.append(count_features(cohort, day_events(t, analysis, concept), bins, analysis))
    return union_all(frames)
