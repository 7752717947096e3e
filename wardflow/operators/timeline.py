"""Patient timelines: one long table of (person, day, code, value) and its forms.

The long table is the working form.  A person has at most one day row per
calendar day, so windows over the day table have a fixed bound; windows over
raw events are never used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import key_hash
from ..functions.segments import attach, bucket_count, bucketed, dense_index, durable, hash_rank, in_passes, shared_folder, union_all, writing
from ..functions.timeunits import diff_days

DEATH_CODE = "Death Type/OMOP generated"
# Event tables that carry one code per row: table, day column, concept column.
CODED_TABLES = [
    ("drug_exposure", "drug_exposure_start_date", "drug_concept_id"),
    ("condition_occurrence", "condition_start_date", "condition_concept_id"),
    ("procedure_occurrence", "procedure_date", "procedure_concept_id"),
    ("device_exposure", "device_exposure_start_date", "device_concept_id"),
    ("observation", "observation_date", "observation_concept_id"),
]
# Vocabularies kept as they are, and those dropped, by code normalisation.
KEPT_VOCABULARIES = [
    "LOINC", "ICD10CM", "CPT4", "Gender", "HCPCS", "Ethnicity", "Race", "ICD10PCS",
    "Condition Type", "Visit", "CMS Place of Service", "SNOMED",
]
DROPPED_VOCABULARIES = ["NDC", "ICD10CN", "ICD10", "ICD9ProcCN"]


def birth_dates(person: DataFrame) -> DataFrame:
    """Birth day: the datetime, else the parts with defaults 1900, 1 and 1."""
    part = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    made = F.make_date(part("year_of_birth", 1900), part("month_of_birth", 1), part("day_of_birth", 1))
    return person.select("person_id", F.coalesce(F.col("birth_datetime").cast("date"), made).alias("birth_date"))


def demographic_codes(person: DataFrame) -> DataFrame:
    """Gender, ethnicity and race concepts on the birth day."""
    concepts = F.array(*[F.col(f"{c}_concept_id").cast("bigint") for c in ("gender", "ethnicity", "race")])
    return (
        person.select("person_id", F.explode(concepts).alias("concept_id"))
        .join(birth_dates(person), "person_id")
        .withColumnRenamed("birth_date", "day")
    )


def coded_events(t) -> DataFrame:
    """(person_id, day, concept_id) of the single-code tables; concept 0 goes out."""
    return union_all(coded_tables(t))


def coded_tables(t) -> list[DataFrame]:
    """``coded_events`` by table."""
    return [
        getattr(t, table).where(F.col(concept) != 0).select(
            "person_id", F.col(day).cast("date").alias("day"), F.col(concept).cast("bigint").alias("concept_id"))
        for table, day, concept in CODED_TABLES
    ]


def death_events(death: DataFrame) -> DataFrame:
    return death.select("person_id", F.col("death_date").alias("day"), F.lit(DEATH_CODE).alias("code"))


def visit_values(visits: DataFrame) -> DataFrame:
    """Visit concepts valued by the length of the visit in days."""
    return visits.where(F.col("visit_concept_id") != 0).select(
        "person_id", F.col("visit_start_date").alias("day"), F.col("visit_concept_id").cast("bigint").alias("concept_id"),
        diff_days("visit_end_date", "visit_start_date").cast("double").alias("numeric_value"),
    )


def measurement_values(measurement: DataFrame) -> DataFrame:
    """Source text preferred over the number; numeric, text or no value."""
    chosen = F.coalesce(F.nullif(F.col("value_source_value"), F.lit("")), F.col("value_as_number").cast("string"))
    number = chosen.try_cast("double")
    return measurement.where(F.col("measurement_concept_id") != 0).select(
        "person_id", F.col("measurement_date").alias("day"), F.col("measurement_concept_id").cast("bigint").alias("concept_id"),
        number.alias("numeric_value"), F.when(number.isNull(), chosen).alias("text_value"),
    )


def concept_codes(concept: DataFrame) -> DataFrame:
    return concept.select("concept_id", F.concat_ws("/", "vocabulary_id", "concept_code").alias("code"))


def build(t) -> DataFrame:
    """Long timeline: person_id, day, age, code, numeric_value, text_value, no repeats; written in buckets of persons.

    Persons without a birth day or with demographics only are left out; days
    before birth move to it.  The facts are formed once, a source table after the
    other, and then meet their persons in passes, so that the shuffle files of one
    step only are on disk at a time.  The demographic rows come after them and are
    kept for the persons that the written facts hold.  Codes are looked up by hash,
    so a concept of many facts is never sorted.
    """
    codes = concept_codes(t.concept)
    births = birth_dates(t.person).where(F.col("birth_date").isNotNull())
    buckets, spark, table = bucket_count(t.visit_occurrence), t.spark, f"timeline_{uuid.uuid4().hex}"
    events = in_passes(facts(t, codes), "person_id", lambda rows: _aged(rows.repartition(buckets, "person_id"), births), buckets, table=table)
    known = births.join(events.select("person_id").distinct(), "person_id", "left_semi")
    own = demographic_codes(t.person).join(codes, "concept_id").select("person_id", "day", "code")
    own = durable(_aged(own.withColumn("numeric_value", F.lit(None).cast("double")).withColumn("text_value", F.lit(None).cast("string")), known))
    # Facts that are demographic rows themselves are not repeated; the codes of demographics are a few words.
    there = events.where(~valued()).join(F.broadcast(own.select("code").distinct()), "code", "left_semi")
    keys = ["person_id", "day", "age", "code"]
    bucketed(own.join(there.select(*keys), keys, "left_anti").select(*events.columns), "person_id", buckets, table)
    return spark.table(table)


def facts(t, codes: DataFrame) -> DataFrame:
    """Facts of all source tables with their codes, written a table after the other."""
    path = f"{shared_folder(t.spark)}/facts-{uuid.uuid4().hex}"
    looked_up = [rows.join(codes.hint("shuffle_hash"), "concept_id").drop("concept_id") for rows in [*coded_tables(t), visit_values(t.visit_occurrence), measurement_values(t.measurement)]]
    values = {"numeric_value": "double", "text_value": "string"}
    for rows in [*looked_up, death_events(t.death)]:
        rows = rows.select("person_id", "day", "code", *[F.col(c) if c in rows.columns else F.lit(None).cast(k).alias(c) for c, k in values.items()])
        with writing(t.spark):
            rows.write.option("compression", "zstd").mode("append").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path)


def _aged(facts: DataFrame, births: DataFrame) -> DataFrame:
    """Distinct facts of persons with a birth day, with the age in days; days before birth move to it."""
    return (
        facts.join(births.hint("shuffle_hash"), "person_id")
        .withColumn("age", F.greatest(diff_days("day", "birth_date"), F.lit(0)))
        .withColumn("day", F.greatest("day", "birth_date"))
        .select("person_id", "day", "age", "code", "numeric_value", "text_value")
        .distinct()
    )


def valued() -> Column:
    return F.col("numeric_value").isNotNull() | F.col("text_value").isNotNull()


def day_table(events: DataFrame) -> DataFrame:
    """One row per patient day with its index, the last age and the day count; read from buckets of persons without a shuffle."""
    person = Window.partitionBy("person_id")
    return (
        events.select("person_id", "day", "age").distinct()
        .withColumn("day_index", F.row_number().over(person.orderBy("day")) - 1)
        .withColumn("last_age", F.max("age").over(person))
        .withColumn("n_days", F.count(F.lit(1)).over(person))
    )


def day_records(events: DataFrame) -> DataFrame:
    """Day rows with sorted, distinct codes and valued codes."""
    value = F.struct("code", "numeric_value", "text_value")
    return events.groupBy("person_id", "day", "age").agg(
        F.sort_array(F.collect_set(F.when(~valued(), F.col("code")))).alias("observations"),
        F.sort_array(F.collect_set(F.when(valued(), value))).alias("valued_observations"),
    )


def year_records(days: DataFrame) -> DataFrame:
    """Nested patient records, one row per patient and calendar year (at most 366 days)."""
    day = F.struct("day", "age", "observations", "valued_observations")
    return days.groupBy("person_id", F.year("day").alias("year")).agg(F.sort_array(F.collect_list(day)).alias("days"))


def explode_records(records: DataFrame) -> DataFrame:
    return records.select("person_id", F.inline("days"))


def code_dictionary(events: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Codes by descending count, numbered from 0; only those of ``among`` when given, which meets the counts and not the events."""
    counts = events.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    if among is not None:
        counts = counts.join(among.select("code"), "code", "left_semi")
    return dense_index(counts, [F.col("n").desc(), "code"], "code_id")


def read_patients(events: DataFrame, ids: DataFrame | None = None, start=None, end=None) -> DataFrame:
    """Timeline restricted to patients and to days in [start, end)."""
    out = events if ids is None else events.join(ids.select("person_id"), "person_id", "left_semi")
    if start is not None:
        out = out.where(F.col("day") >= F.lit(start).cast("date"))
    return out if end is None else out.where(F.col("day") < F.lit(end).cast("date"))


def code_index(events: DataFrame) -> DataFrame:
    """Distinct (code, person_id); write it bucketed by code for repeated lookups."""
    return events.select("code", "person_id").distinct()


def patients_with(index: DataFrame, codes: DataFrame | list[str]) -> DataFrame:
    hit = index.where(F.col("code").isin(*codes)) if isinstance(codes, list) else index.join(codes.select("code"), "code", "left_semi")
    return hit.select("person_id").distinct()


def random_subset(people: DataFrame, ratio: float, seed: int) -> DataFrame:
    """Exactly floor(n * ratio) patients, repeatable by seed."""
    total = people.agg(F.count(F.lit(1)).alias("_n"))
    ranked = hash_rank(people.select("person_id"), [], key_hash("person_id", seed=seed))
    return attach(ranked, total).where(F.col("rank") < F.floor(F.col("_n") * ratio)).select("person_id")


def dense_ids(people: DataFrame) -> DataFrame:
    return dense_index(people.select("person_id").distinct(), ["person_id"], "patient_id")


def day_index_of(days: DataFrame, points: DataFrame, required: bool = False) -> DataFrame:
    """Last timeline day on or before each (person_id, date); null when there is none, an error if it is ``required``.

    Both sides meet in one table of person-days and the day index is carried
    forward, so no pairs of days and dates are formed.
    """
    marks = points.select("person_id", F.col("date").alias("day")).distinct().withColumn("_asked", F.lit(1))
    merged = days.select("person_id", "day", "day_index").unionByName(marks, allowMissingColumns=True)
    merged = merged.groupBy("person_id", "day").agg(F.max("day_index").alias("_i"), F.max("_asked").alias("_asked"))
    before = Window.partitionBy("person_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    found = merged.withColumn("day_index", F.last("_i", ignorenulls=True).over(before)).where("_asked = 1")
    place = F.col("day_index")
    if required:
        told = F.concat(F.lit("no timeline day on or before "), F.col("day").cast("string"), F.lit(" for person "), F.col("person_id").cast("string"))
        place = F.coalesce(place, F.raise_error(told).cast(found.schema["day_index"].dataType))
    return found.select("person_id", F.col("day").alias("date"), place.alias("day_index"))


def inspect(events: DataFrame, ids: DataFrame, person_id: int | None = None, patient_id: int | None = None) -> DataFrame:
    """All rows of one patient by original or dense id."""
    wanted = ids.where(F.col("person_id") == person_id) if person_id is not None else ids.where(F.col("patient_id") == patient_id)
    return events.join(wanted, "person_id")


# ---- code normalisation ----------------------------------------------------


def crosswalk(rows: DataFrame, diagnosis: bool = True) -> DataFrame:
    """(source, target) from crosswalk rows (line_no, source, target, flags).

    No-map rows go out.  A code keeps its first simple target, or, for
    combinations, one target per choice list of scenario 1 (the last row of a
    list wins).  Diagnosis targets get a dot after three characters.
    """
    flag = lambda i: F.substring("flags", i, 1).cast("int")
    target = F.when(F.length("target") > 3, F.concat(F.substring("target", 1, 3), F.lit("."), F.substr(F.col("target"), F.lit(4)))).otherwise(
        F.col("target")) if diagnosis else F.col("target")
    kept = rows.where(flag(2) != 1).select(
        "line_no", "source", target.alias("target"), (flag(3) == 1).alias("combination"), flag(4).alias("scenario"), flag(5).alias("choice"))
    simple = kept.where(~F.col("combination")).groupBy("source").agg(
        F.min(F.struct("line_no", "target")).alias("b")).select("source", F.col("b.line_no").alias("line_no"), F.col("b.target").alias("target"))
    combined = kept.where(F.col("combination") & (F.col("scenario") == 1)).groupBy("source", "choice").agg(
        F.max(F.struct("line_no", "target")).alias("b"), F.min("line_no").alias("first_line"))
    first_combined = combined.groupBy("source").agg(F.min("first_line").alias("first_line"))
    # A simple row counts only when no combination row of the code came first.
    simple = simple.join(first_combined, "source", "left").where(
        F.col("first_line").isNull() | (F.col("line_no") < F.col("first_line")))
    # Combination rows then fill their choice slots; slot 1 replaces a simple target.
    taken = combined.where(F.col("choice") == 1).select("source")
    simple = simple.join(taken, "source", "left_anti").select("source", "target")
    return simple.unionByName(combined.select("source", F.col("b.target").alias("target")))


def normalise_codes(
    events: DataFrame, mapping: DataFrame, mapped_vocabularies: list[str], kept=None, dropped=None, fallback=("HCPCS",)
) -> DataFrame:
    """Replace codes through a one-to-many map (code, target).

    Codes of ``mapped_vocabularies`` need a map row (those in ``fallback`` stay
    as they are without one); kept vocabularies pass, all others go out.  The
    join strategy is left to the size statistics of the mapping table.
    """
    vocabulary = F.split("code", "/")[0]
    kept = KEPT_VOCABULARIES if kept is None else kept
    dropped = DROPPED_VOCABULARIES if dropped is None else dropped
    needs = vocabulary.isin(*mapped_vocabularies)
    passes = (~needs & vocabulary.isin(*kept) & ~vocabulary.isin(*dropped)) | (needs & vocabulary.isin(*fallback))
    # Only codes that need a map take part in the one-to-many join.
    lookup = mapping.select(F.col("code").alias("_key"), "target")
    joined = events.withColumn("_key", F.when(needs, F.col("code"))).join(lookup, "_key", "left")
    target = F.when(needs & F.col("target").isNotNull(), F.col("target")).when(passes, F.col("code"))
    rest = [c for c in events.columns if c != "code"]
    return joined.select(*rest, target.alias("code")).where(F.col("code").isNotNull())


def suffix_retry(codes: DataFrame, mapping: DataFrame, suffixes=("0", "9", "1")) -> DataFrame:
    """Map claim codes, trying the code itself and then with each suffix."""
    tries = F.posexplode(F.array(F.lit(""), *[F.lit(s) for s in suffixes])).alias("attempt", "suffix")
    found = codes.select("code", tries).withColumn("source", F.concat("code", "suffix")).join(mapping, "source")
    best = found.groupBy("code").agg(F.min("attempt").alias("attempt"))
    return found.join(best, ["code", "attempt"]).select("code", "target").distinct()


def claim_events(claims: DataFrame, mapping: DataFrame) -> DataFrame:
    """Claim rows (person_id, day, code1..codeN) to mapped codes."""
    slots = [c for c in claims.columns if c.startswith("code")]
    long = claims.select("person_id", "day", F.explode(F.array(*slots)).alias("code")).where(
        F.col("code").isNotNull() & (F.col("code") != "")).distinct()
    mapped = suffix_retry(long.select("code").distinct(), mapping)
    return long.join(mapped, "code").select("person_id", "day", F.col("target").alias("code")).distinct()


def timeline_json(records: DataFrame, definitions: DataFrame | None = None) -> DataFrame:
    """Day records as JSON lines with code definitions."""
    if definitions is not None:
        defined = lambda rows: rows.select("person_id", "day", F.explode("observations").alias("code")).join(definitions, "code", "left").select(
            "person_id", "day", F.struct("code", "definition").alias("word"))
        words = in_passes(records, "person_id", defined).groupBy("person_id", "day").agg(F.sort_array(F.collect_set("word")).alias("observations"))
        records = records.drop("observations").join(words, ["person_id", "day"], "left")
    body = F.to_json(F.struct("day", "age", "observations", "valued_observations"))
    return records.select("person_id", "day", body.alias("record"))
