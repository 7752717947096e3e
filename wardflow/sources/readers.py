"""Readers of clinical tables, delimited files, vocabulary releases and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CLINICAL_TABLES = [
    "person", "visit_occurrence", "visit_detail", "condition_occurrence", "procedure_occurrence", "drug_exposure",
    "device_exposure", "measurement", "observation", "note", "note_nlp", "death", "observation_period", "concept",
    "concept_ancestor", "concept_relationship",
]


def clinical_tables(spark: SparkSession, folder: str | None = None, database: str | None = None, names=None) -> dict[str, DataFrame]:
    """Clinical relations by name, from Parquet folders or catalogue tables."""
    names = names or CLINICAL_TABLES
    if folder is not None:
        return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
    return {n: spark.table(f"{database}.{n}" if database else n) for n in names}


def delimited(spark: SparkSession, path: str, columns: list[str], delimiter: str = ",", quotes: bool = True, schema: str | None = None) -> DataFrame:
    """Delimited files (plain or gzipped) with a header, chosen columns only."""
    reader = spark.read.option("header", True).option("sep", delimiter).option("quote", '"' if quotes else "")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path).select(*columns)


def headerless(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    """Vendor files of a known schema, where a file may or may not repeat the header as its first line."""
    fields = T._parse_datatype_string(schema).fields
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    rows = spark.read.schema(text).option("sep", delimiter).csv(path)
    is_header = F.lit(True)
    for f in fields:
        is_header = is_header & F.coalesce(F.lower(F.col(f.name)) == f.name.lower(), F.lit(False))
    return rows.where(~is_header).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def pipe_release(spark: SparkSession, path: str, columns: dict[str, int]) -> DataFrame:
    """Pipe-delimited vocabulary release files; ``columns`` maps a name to a position."""
    parts = F.split("value", r"\|", -1)
    return spark.read.text(path).select(*[F.get(parts, F.lit(i)).alias(n) for n, i in columns.items()])


def crosswalk_file(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace-separated crosswalk rows (source, target, five flag digits) with their file position.

    The position orders by file, by block inside the file and by row inside the
    block, because tasks do not follow the order of the blocks.
    """
    parts = F.split(F.trim("value"), r"\s+")
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = spark.read.text(path).select("value", place.alias("line_no"))
    return rows.select("line_no", parts[0].alias("source"), parts[1].alias("target"), parts[2].alias("flags")).where(F.col("flags").isNotNull())


def database_table(spark: SparkSession, url: str, query: str, key: str, low: int, high: int, partitions: int, **options) -> DataFrame:
    """A database query read in key ranges, one task per range."""
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) source").option("partitionColumn", key)
        .option("lowerBound", low).option("upperBound", high).option("numPartitions", partitions).options(**options).load()
    )
