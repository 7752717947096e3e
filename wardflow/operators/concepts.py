"""Concept sets: descendants, source-code rollups, recovery of unmapped codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import durable, literal_rows

# Source-code patterns of the cardiovascular concept sets.
CARDIOVASCULAR = ["410%", "411%", "413%", "414%", "430%", "431%", "432%", "433%", "434%", "436%", "428%"]
MI_STROKE = ["410%", "430%", "431%", "432%", "436%"]
MI_STROKE_EXCEPT = {"433%": "433._0", "434%": "434._0"}
CORONARY = ["411%", "413%", "414%"]
STATINS = [
    "C10AA01", "C10AA07", "C10AA02", "C10AA08", "C10AA04", "C10AA03",
    "C10BA05", "C10AA06", "C10BX03", "C10BA01", "C10BA02", "C10BA04",
]


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def source_predicates() -> dict[str, Column]:
    code, vocabulary = F.col("concept_code"), F.col("vocabulary_id")
    icd9 = vocabulary == "ICD9CM"
    return {
        "cardiovascular": icd9 & (any_of([code.like(p) for p in CARDIOVASCULAR]) | (code == "427.31")),
        "mi_stroke": icd9 & any_of(
            [code.like(p) for p in MI_STROKE] + [code.like(p) & ~code.like(x) for p, x in MI_STROKE_EXCEPT.items()]
        ),
        "coronary": icd9 & any_of([code.like(p) for p in CORONARY]),
        "statin": (vocabulary == "ATC") & code.isin(*STATINS),
    }


def expand(concept: DataFrame, ancestors: DataFrame, ids) -> DataFrame:
    """The given concepts plus every valid descendant."""
    given = concept.where(F.col("concept_id").isin(*ids)).select("concept_id")
    below = (
        ancestors.where(F.col("ancestor_concept_id").isin(*ids))
        .select(F.col("descendant_concept_id").alias("concept_id"))
        .join(concept.where(F.col("invalid_reason").isNull()).select("concept_id"), "concept_id", "left_semi")
    )
    return given.union(below).distinct()


def expand_sets(concept: DataFrame, ancestors: DataFrame, sets: dict[str, list[int]]) -> DataFrame:
    """``expand`` for many named sets in one pass: (set_name, concept_id)."""
    members = literal_rows(
        concept.sparkSession, [(n, i) for n, ids in sets.items() for i in ids], "set_name string, id bigint"
    )
    small = F.broadcast(members)  # constant definition table
    given = concept.join(small, F.col("concept_id") == F.col("id")).select("set_name", "concept_id")
    below = (
        ancestors.join(small, F.col("ancestor_concept_id") == F.col("id"))
        .select("set_name", F.col("descendant_concept_id").alias("concept_id"))
        .join(concept.where(F.col("invalid_reason").isNull()).select("concept_id"), "concept_id", "left_semi")
    )
    return given.unionByName(below).distinct()


def source_rollups(concept: DataFrame, relationships: DataFrame, ancestors: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """(set_name, concept_id): source codes -> mapped standard concepts -> those and their descendants, all sets in one pass."""
    names = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in predicates.items()]))
    source = concept.select(F.explode(names).alias("set_name"), F.col("concept_id").alias("concept_id_1"))
    maps = relationships.where(F.col("relationship_id") == "Maps to").select("concept_id_1", F.col("concept_id_2").alias("concept_id"))
    standard = maps.join(source, "concept_id_1").select("set_name", "concept_id").distinct()
    pairs = ancestors.select(F.col("ancestor_concept_id").alias("concept_id"), "descendant_concept_id")
    below = pairs.join(standard, "concept_id").select("set_name", F.col("descendant_concept_id").alias("concept_id"))
    return standard.union(below).distinct()


def source_rollup(concept: DataFrame, relationships: DataFrame, ancestors: DataFrame, predicate: Column) -> DataFrame:
    """``source_rollups`` of one set: (concept_id)."""
    return source_rollups(concept, relationships, ancestors, {"one": predicate}).select("concept_id")


#: Vocabulary whose codes may list several parents; the one with the longest code counts.
MANY_PARENTS = "ICD10CM"


def single_parents(parents: DataFrame) -> DataFrame:
    """(code, parent): the one parent of each code; a code with several has none, except in ``MANY_PARENTS``.

    ``parents(code, parent, vocabulary)`` has the vocabulary of ``code``, if there are several; of equally long parents the smallest counts.
    """
    if "vocabulary" not in parents.columns:
        parents = parents.withColumn("vocabulary", F.lit(None).cast("string"))
    known = parents.where("code IS NOT NULL AND parent IS NOT NULL").select("code", "parent", "vocabulary").distinct()
    best = known.groupBy("code").agg(
        F.min(F.struct((-F.length("parent")).alias("o"), "parent")).alias("b"), F.count_distinct("parent").alias("n"), F.max("vocabulary").alias("vocabulary"))
    return best.where((F.col("n") == 1) | (F.col("vocabulary") == MANY_PARENTS)).select("code", F.col("b.parent").alias("parent"))


def recover_unmapped(unmapped: DataFrame, parents: DataFrame, mapped: DataFrame) -> DataFrame:
    """(code, recovered): the first mapped code up the chain of single parents of each unmapped code.

    A code points at its parent until that is mapped; in every step all codes move on
    to what their target points at, so a chain of n codes takes log n steps.  Codes
    whose chain ends are left out, and so are those that still move after as many
    steps as the longest possible chain takes: they lie on a cycle.
    """
    found = single_parents(parents)
    hits = mapped.select(F.col("code").alias("to")).distinct().withColumn("hit", F.lit(True))
    points = durable(found.select("code", F.col("parent").alias("to")).join(hits, "to", "left").select("code", "to", F.coalesce("hit", F.lit(False)).alias("hit")))
    longest, steps = points.count(), 0
    while (1 << steps) < longest + 1 and not points.where("NOT hit").isEmpty():
        far = points.select(F.col("code").alias("to"), F.col("to").alias("far"), F.col("hit").alias("far_hit"))
        # A target without a parent of its own ends its chain.
        moved = points.where("NOT hit").join(far, "to").select("code", F.col("far").alias("to"), F.col("far_hit").alias("hit"))
        points = durable(points.where("hit").unionByName(moved))
        steps += 1
    return unmapped.select("code").join(points.where("hit").select("code", F.col("to").alias("recovered")), "code")
