"""Code hierarchies as edge and closure tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import durable

# Vocabularies whose codes carry a recorded date.
RECORDED_VOCABULARIES = ["ATC", "CPT4", "DRG", "Gender", "HCPCS", "ICD10CM", "ICD10PCS", "LOINC"]
# Drug relations followed towards ingredients.
DRUG_RELATIONS = [
    "has_ingredient", "tradename_of", "has_ingredients", "has_form", "consists_of", "has_part", "has_precise_ingredient",
]


def closure(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(code, ancestor) pairs over parent edges, each code its own ancestor.

    Semi-naive steps: only pairs found in the last step are extended, known
    pairs are removed, so any depth and cycles end, and each step is written to reliable storage, so the
    plan does not grow and a lost executor repeats one step at most.
    """
    nodes = starts.select("code") if starts is not None else edges.select("code").union(edges.select("parent"))
    frontier = durable(nodes.distinct().select("code", F.col("code").alias("ancestor")))
    known = frontier
    up = edges.select(F.col("code").alias("ancestor"), "parent").distinct()
    while True:
        step = frontier.join(up, "ancestor").select("code", F.col("parent").alias("ancestor")).distinct()
        frontier = durable(step.join(known, ["code", "ancestor"], "left_anti"))
        if frontier.isEmpty():
            return known
        known = known.unionByName(frontier)


def subwords(used: DataFrame, edges: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Ancestors of each used code; codes unknown to the vocabulary become ``NO_MAP/code``."""
    known = used.select("code").join(vocabulary.select("code"), "code", "left_semi").distinct()
    lost = used.select("code").join(vocabulary.select("code"), "code", "left_anti").distinct()
    return closure(edges, known).unionByName(lost.select("code", F.concat(F.lit("NO_MAP/"), "code").alias("ancestor")))


def all_parents(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("code") != F.col("ancestor"))


def children(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("parent").alias("code"), F.col("code").alias("child")).distinct()


def words_under(pairs: DataFrame, terms: list[str]) -> DataFrame:
    """Codes at or below any of the terms."""
    return pairs.where(F.col("ancestor").isin(*terms)).select("code").distinct()


def roots(edges: DataFrame) -> DataFrame:
    parents = edges.select(F.col("parent").alias("code")).distinct()
    return parents.join(edges.select("code"), "code", "left_anti")


def recorded_date_codes(codes: DataFrame, vocabularies=None) -> DataFrame:
    return codes.where(is_recorded(vocabularies)).select("code").distinct()


def is_recorded(vocabularies=None, code: str = "code") -> Column:
    """Whether a code is one of ``recorded_date_codes``; a test of the code alone, for rows that hold it."""
    return F.split(code, "/")[0].isin(*(RECORDED_VOCABULARIES if vocabularies is None else vocabularies))


def with_definitions(codes: DataFrame, definitions: DataFrame) -> DataFrame:
    return codes.join(definitions, "code", "left")


def zip_hierarchy(zips: DataFrame) -> DataFrame:
    """(code, parent) edges of five-digit ZIP codes over three and one digits."""
    part = lambda n: F.concat(F.lit(f"ZIP_{n}/"), F.substring("zip", 1, n))
    edges = F.array(
        F.struct(part(5).alias("code"), part(3).alias("parent")),
        F.struct(part(3).alias("code"), part(1).alias("parent")),
        F.struct(part(1).alias("code"), F.lit("ZIP_0/root").alias("parent")),
    )
    return zips.select(F.inline(edges)).distinct()


def drug_classes(attributes: DataFrame, relations: DataFrame, atoms: DataFrame) -> DataFrame:
    """(vocabulary, code, atc) of drug codes through ingredient, form, part and trade-name edges.

    ``attributes(concept, vocabulary, code)``, ``relations(child, parent,
    relation)`` followed parent -> child, ``atoms(concept, vocabulary, code)``.
    """
    edges = relations.where(F.col("relation").isin(*DRUG_RELATIONS)).select(
        F.col("parent").alias("code"), F.col("child").alias("parent")).distinct()
    own = atoms.where(F.col("vocabulary") == "RXNORM").select("concept", F.lit("RxNorm").alias("vocabulary"), F.col("concept").alias("code"))
    named = attributes.select("concept", "vocabulary", "code").unionByName(own).distinct()
    atc = atoms.where(F.col("vocabulary") == "ATC").select(
        F.col("concept").alias("reached"), F.concat(F.lit("ATC/"), "code").alias("atc"))
    # The edges are walked from the classified concepts down, so pairs that end at no class are not formed.
    down = edges.select(F.col("parent").alias("code"), F.col("code").alias("parent"))
    reach = closure(down, atc.select(F.col("reached").alias("code"))).select(
        F.col("ancestor").alias("concept"), F.col("code").alias("reached"))
    return named.join(reach, "concept").join(atc, "reached").select("vocabulary", "code", "atc").distinct()


def atom_codes(atoms: DataFrame, vocabularies: list[str], term_types: list[str]) -> DataFrame:
    """Atoms of chosen vocabularies and term types to codes; a repeated (vocabulary, code) is an error."""
    kept = atoms.where(F.col("vocabulary").isin(*vocabularies) & F.col("term_type").isin(*term_types))
    twice = kept.groupBy("vocabulary", "code").agg(F.count(F.lit(1)).alias("n"))
    # The check rides along as a join, so it fails the job that reads the result.
    return kept.join(twice, ["vocabulary", "code"]).withColumn(
        "code", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("repeated code "), "code"))).otherwise(F.col("code"))
    ).drop("n")


def atom_parents(relations: DataFrame, synonyms: DataFrame, atoms: DataFrame, root_edges: DataFrame) -> DataFrame:
    """(atom, parent_atom) with synonym atoms replaced, fixed roots added, unknown ends dropped."""
    swap = lambda name: synonyms.select(F.col("atom").alias(name), F.col("preferred").alias(f"_{name}"))
    known = lambda name: atoms.select(F.col("atom").alias(name))
    return (
        relations.select("atom", "parent_atom")
        .join(swap("atom"), "atom", "left").join(swap("parent_atom"), "parent_atom", "left")
        .select(F.coalesce("_atom", "atom").alias("atom"), F.coalesce("_parent_atom", "parent_atom").alias("parent_atom"))
        .unionByName(root_edges.select("atom", "parent_atom"))
        .join(known("atom"), "atom", "left_semi").join(known("parent_atom"), "parent_atom", "left_semi")
        .where(F.col("atom") != F.col("parent_atom")).select("atom", "parent_atom").distinct()
    )
