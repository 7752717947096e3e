"""Clinical relations derived from the generic star-schema tables.

Each relation is one SQL text that both Spark and the checking engine accept;
``{TS}`` is the zone-less timestamp type and ``{table:name}`` a raw table.  The
texts name other relations by ``{name}``.  All of them are lazy projections or
joins of whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.segments import durable

RAW = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed concept rows used by the cohort and label definitions.
CONCEPTS = [
    (0, "No matching concept", "0", "None", None, None),
    (8507, "MALE", "M", "Gender", "S", None),
    (8532, "FEMALE", "F", "Gender", "S", None),
    (8527, "White", "5", "Race", "S", None),
    (8515, "Asian", "2", "Race", "S", None),
    (8516, "Black or African American", "3", "Race", "S", None),
    (8557, "Native Hawaiian or Other Pacific Islander", "4", "Race", "S", None),
    (8657, "American Indian or Alaska Native", "1", "Race", "S", None),
    (38003600, "European", "5.01", "Race", "S", None),
    (38003563, "Hispanic or Latino", "Hispanic", "Ethnicity", "S", None),
    (38003564, "Not Hispanic or Latino", "Not Hispanic", "Ethnicity", "S", None),
    (3023103, "Potassium", "2823-3", "LOINC", "S", None),
    (3004501, "Glucose", "2345-7", "LOINC", "S", None),
    (3016723, "Creatinine", "2160-0", "LOINC", "S", None),
    (3019550, "Sodium", "2951-2", "LOINC", "S", None),
    (3000963, "Hemoglobin", "718-7", "LOINC", "S", None),
    (3010813, "Leukocytes", "26464-8", "LOINC", "S", None),
    (3035839, "Band form percent", "26508-2", "LOINC", "S", None),
    (3018199, "Band form count", "26507-4", "LOINC", "S", None),
    (3013650, "Neutrophils", "751-8", "LOINC", "S", None),
    (3024929, "Platelets", "777-3", "LOINC", "S", None),
    (46000010, "Blood culture aerobic", "BC1", "LOINC", "S", None),
    (46000011, "Blood culture anaerobic", "BC2", "LOINC", "S", None),
    (46000019, "Unlisted test", "UL", "LOINC", None, None),
    (3027801, "Oxygen partial pressure", "2703-7", "LOINC", "S", None),
    (3024128, "Bilirubin", "1975-2", "LOINC", "S", None),
    (3047181, "Lactate", "2524-7", "LOINC", "S", None),
    (3032652, "Coma score", "9269-2", "LOINC", "S", None),
    (3027598, "Mean blood pressure", "8478-0", "LOINC", "S", None),
    (45876241, "Urine output", "9192-6", "LOINC", "S", None),
    (9201, "Inpatient Visit", "IP", "Visit", "S", None),
    (9202, "Outpatient Visit", "OP", "Visit", "S", None),
    (262, "Emergency Room and Inpatient Visit", "ERIP", "Visit", "S", None),
    (44814637, "Discharge summary", "DS", "Note Type", "S", None),
    (44814639, "Progress note", "PN", "Note Type", "S", None),
]
# Fixed ancestor pairs of the laboratory, culture and race concepts.
ANCESTORS = [
    (40653595, 3023103), (4144235, 3004501), (37029387, 3016723), (40653762, 3019550),
    (37072252, 3000963), (37045722, 3013650), (37037425, 3024929), (4107893, 46000010),
    (4107893, 46000011), (8527, 38003600), (8527, 8527), (8516, 8516), (8515, 8515),
]
# Diagnosis ancestors: the parts with p_partkey % 60 = position descend from them.
DX_ANCESTORS = [
    380688, 4226798, 36714116, 24609, 4029423, 45757363, 4096804, 4048805, 4228112, 23034, 4029424, 45769876,
    197320, 432961, 444044, 439777, 37018722, 37017132, 35624756, 4006467, 37398911, 37395652, 434610,
    435515, 4232311, 432870, 301794, 320073,
]
# Drug ancestors by p_partkey modulus and remainder.
DRUG_ANCESTORS = [(21602796, 3, 0), (21600284, 20, 1), (21600287, 20, 2), (21600303, 20, 4), (21600283, 20, 7)]


def _lit(v) -> str:
    return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))


def _values(rows, cols: str, alias: str) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS {alias}({cols})) AS {alias}"


_CONCEPT_VALUES = _values(
    CONCEPTS, "concept_id, concept_name, concept_code, vocabulary_id, standard_concept, invalid_reason", "cv"
)
_DX = _values(list(enumerate(DX_ANCESTORS)), "pos, anc", "dx")
_DRUG = _values(DRUG_ANCESTORS, "anc, modulus, rest", "dg")
_ANC = _values(ANCESTORS, "anc, des", "av")

_LINES = """
SELECT o.o_custkey AS person_id, o.o_orderkey AS order_id, o.o_orderdate AS order_date,
  o.o_orderdate + (o.o_orderkey % 24) * INTERVAL '1' HOUR AS visit_start,
  l.l_partkey AS pk, CAST(l.l_linenumber AS BIGINT) AS ln, l.l_quantity AS qty, l.l_shipdate AS ship_date,
  l.l_discount AS discount, l.l_returnflag AS flag,
  CASE WHEN l.l_partkey % 50 = 0 THEN 0 ELSE 50000000 + l.l_partkey END AS concept_id
FROM {table:lineitem} l JOIN {table:orders} o ON l.l_orderkey = o.o_orderkey
"""

RELATIONS: dict[str, str] = {
    "lines": _LINES,
    "person": """
SELECT c_custkey AS person_id,
  CAST(DATE '1930-01-01' + CAST((c_custkey * 37) % 25000 AS INT) AS {TS}) AS birth_datetime,
  CAST(EXTRACT(YEAR FROM DATE '1930-01-01' + CAST((c_custkey * 37) % 25000 AS INT)) AS INT) AS year_of_birth,
  CAST(EXTRACT(MONTH FROM DATE '1930-01-01' + CAST((c_custkey * 37) % 25000 AS INT)) AS INT) AS month_of_birth,
  CAST(EXTRACT(DAY FROM DATE '1930-01-01' + CAST((c_custkey * 37) % 25000 AS INT)) AS INT) AS day_of_birth,
  CASE WHEN c_custkey % 50 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
  CASE c_nationkey % 7 WHEN 0 THEN 8527 WHEN 1 THEN 8516 WHEN 2 THEN 8515 WHEN 3 THEN 8557
    WHEN 4 THEN 0 WHEN 5 THEN 38003600 ELSE 8657 END AS race_concept_id,
  CASE WHEN c_custkey % 5 = 0 THEN 38003563 ELSE 38003564 END AS ethnicity_concept_id
FROM {table:customer}""",
    "visit_occurrence": """
SELECT o_orderkey AS visit_occurrence_id, o_custkey AS person_id,
  CASE o_orderstatus WHEN 'F' THEN 9201 WHEN 'P' THEN 262 ELSE CASE WHEN o_orderkey % 3 = 0 THEN 9201 ELSE 9202 END END
    AS visit_concept_id,
  o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS visit_start_datetime,
  o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR + ((o_orderkey * 7) % 30) * INTERVAL '13' HOUR AS visit_end_datetime,
  CAST(o_orderdate AS DATE) AS visit_start_date,
  CAST(o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR + ((o_orderkey * 7) % 30) * INTERVAL '13' HOUR AS DATE) AS visit_end_date,
  CASE WHEN o_orderkey % 11 = 0 THEN 4216643 ELSE 0 END AS discharge_to_concept_id
FROM {table:orders}""",
    "visit_detail": """
SELECT o_orderkey AS visit_detail_id, o_orderkey AS visit_occurrence_id, o_custkey AS person_id,
  32037 AS visit_detail_concept_id,
  o_orderdate + ((o_orderkey % 24) + (o_orderkey % 30)) * INTERVAL '1' HOUR AS visit_detail_start_datetime,
  o_orderdate + ((o_orderkey % 24) + (o_orderkey % 30)) * INTERVAL '1' HOUR AS visit_start_datetime,
  o_orderdate + ((o_orderkey % 24) + (o_orderkey % 30) + (o_orderkey * 7) % 290) * INTERVAL '1' HOUR AS visit_end_datetime,
  CASE o_orderkey % 5 WHEN 0 THEN 'J4|J4|J4|' WHEN 1 THEN 'CVICU|CVICU|Cardiovascular Intensive Care|'
    WHEN 2 THEN 'WARD A' WHEN 3 THEN 'PICU|PICU|Pediatric Intensive Care|' ELSE 'WARD B' END AS visit_detail_source_value,
  CASE WHEN o_orderkey % 12 = 0 THEN 4216643 ELSE 0 END AS discharge_to_concept_id
FROM {table:orders} WHERE o_orderkey % 4 = 0""",
    "death": """
SELECT o_custkey AS person_id, CAST(max(o_orderdate) AS DATE) + CAST(o_custkey % 60 AS INT) AS death_date
FROM {table:orders} WHERE o_custkey % 7 = 0 GROUP BY o_custkey""",
    "observation_period": """
SELECT o_custkey AS person_id, CAST(min(o_orderdate) AS DATE) - CAST(200 + o_custkey % 300 AS INT) AS observation_period_start_date,
  CAST(max(o_orderdate) AS DATE) + CAST(o_custkey % 400 AS INT) AS observation_period_end_date
FROM {table:orders} GROUP BY o_custkey""",
    "condition_occurrence": """
SELECT person_id, order_id AS visit_occurrence_id, concept_id AS condition_concept_id,
  CAST(ship_date AS DATE) AS condition_start_date,
  CASE WHEN pk % 9 = 0 THEN ship_date ELSE visit_start + (pk % 50) * INTERVAL '1' HOUR END AS condition_start_datetime
FROM {lines} WHERE ln % 5 IN (0, 3)""",
    "drug_exposure": """
SELECT person_id, order_id AS visit_occurrence_id, concept_id AS drug_concept_id,
  CAST(order_date AS DATE) + CAST(pk % 4 AS INT) AS drug_exposure_start_date,
  order_date + (pk % 4 * 24 + 9) * INTERVAL '1' HOUR AS drug_exposure_start_datetime,
  order_date + ((pk % 4 + ln + pk % 5) * 24 + 9) * INTERVAL '1' HOUR AS drug_exposure_end_datetime
FROM {lines} WHERE ln % 5 IN (1, 2)""",
    "procedure_occurrence": """
SELECT person_id, order_id AS visit_occurrence_id, concept_id AS procedure_concept_id,
  CAST(ship_date AS DATE) AS procedure_date, visit_start + (pk % 70) * INTERVAL '1' HOUR AS procedure_datetime
FROM {lines} WHERE ln % 5 = 2""",
    "device_exposure": """
SELECT person_id, order_id AS visit_occurrence_id, concept_id AS device_concept_id,
  CAST(ship_date AS DATE) AS device_exposure_start_date,
  visit_start + (pk % 40) * INTERVAL '1' HOUR AS device_exposure_start_datetime
FROM {lines} WHERE ln % 5 = 3""",
    "observation": """
SELECT order_id * 10 + ln AS observation_id, person_id, order_id AS visit_occurrence_id,
  CASE WHEN ln = 4 THEN concept_id ELSE 2000006253 END AS observation_concept_id,
  concept_id AS observation_source_concept_id,
  CAST(visit_start + ((pk * 5 + ln * 3) % 72) * INTERVAL '1' HOUR AS DATE) AS observation_date,
  visit_start + ((pk * 5 + ln * 3) % 72) * INTERVAL '1' HOUR AS observation_datetime,
  CASE WHEN ln = 4 THEN CASE WHEN pk % 2 = 0 THEN 'text ' || flag ELSE NULL END
    ELSE '{{"values":[{{"source":"ip_flwsht_meas.meas_value","value":"' ||
      CASE pk % 5 WHEN 2 THEN CASE WHEN pk % 3 = 0 THEN 'STANDBY' ELSE 'SIMV' END
        ELSE CAST(CAST(qty * 2 AS INT) AS VARCHAR(9)) END ||
      '"}},{{"source":"ip_flo_gp_data.disp_name","value":"' ||
      CASE pk % 5 WHEN 0 THEN 'FiO2 (%)' WHEN 1 THEN 'Oxygen saturation' WHEN 2 THEN 'Vent mode' WHEN 3 THEN 'FiO2 %'
        ELSE 'Heart rate' END ||
      '"}},{{"source":"ip_flo_gp_data.units","value":"' || CASE WHEN pk % 5 = 2 THEN '' ELSE '%' END || '"}}]}}' END AS value_as_string,
  CASE WHEN ln = 4 THEN qty ELSE NULL END AS value_as_number,
  CASE WHEN ln = 4 THEN 'plain ' || flag
    ELSE '{{"values":[{{"source":"ip_flt_data.display_name","value":"' ||
      CASE pk % 5 WHEN 1 THEN 'SpO2' WHEN 3 THEN 'RN clinical screening' ELSE 'Vitals' END || '"}}]}}' END AS observation_source_value,
  CASE WHEN ln = 4 THEN 'u' ELSE NULL END AS unit_source_value
FROM {lines} WHERE ln IN (2, 4, 5, 7)""",
    "measurement": """
SELECT person_id, visit_occurrence_id, measurement_concept_id, CAST(measurement_datetime AS DATE) AS measurement_date,
  measurement_datetime, CAST(value_as_number AS DOUBLE) AS value_as_number, unit_concept_id,
  CAST(range_low AS DOUBLE) AS range_low, CAST(range_high AS DOUBLE) AS range_high, value_source_value
FROM (
SELECT person_id, order_id AS visit_occurrence_id,
  CASE pk % 20 WHEN 0 THEN 3023103 WHEN 1 THEN 3004501 WHEN 2 THEN 3016723 WHEN 3 THEN 3019550 WHEN 4 THEN 3000963
    WHEN 5 THEN 3010813 WHEN 6 THEN 3035839 WHEN 7 THEN 3018199 WHEN 8 THEN 3013650 WHEN 9 THEN 3024929
    WHEN 10 THEN 46000010 WHEN 11 THEN 3027801 WHEN 12 THEN 3024128 WHEN 13 THEN 3047181 WHEN 14 THEN 3032652
    WHEN 15 THEN 3027598 WHEN 16 THEN 45876241 WHEN 17 THEN 46000011 WHEN 18 THEN 3010813 ELSE 46000019 END AS measurement_concept_id,
  CASE WHEN pk % 20 IN (5, 6, 7, 8, 18) THEN visit_start + INTERVAL '2' HOUR
    ELSE visit_start + ((pk * 7 + ln * 13) % 120) * INTERVAL '1' HOUR + (pk % 60) * INTERVAL '1' MINUTE END AS measurement_datetime,
  CASE pk % 20 WHEN 0 THEN 1 + qty / 6 WHEN 1 THEN CASE WHEN ln % 3 = 0 THEN 20 + qty * 4 ELSE 1 + qty / 5 END
    WHEN 2 THEN CASE ln % 3 WHEN 0 THEN qty / 10 WHEN 1 THEN 40 + qty * 10 ELSE 300 + qty * 60 END
    WHEN 3 THEN 110 + qty WHEN 4 THEN CASE WHEN ln % 3 = 0 THEN 4000 + qty * 300 ELSE 4 + qty / 4 END
    WHEN 5 THEN qty / 4 WHEN 6 THEN qty * 2.2 WHEN 7 THEN qty * 40
    WHEN 8 THEN CASE ln % 3 WHEN 0 THEN qty * 2.2 WHEN 1 THEN qty * 90 ELSE qty / 8 END
    WHEN 9 THEN 10 + qty * 6 WHEN 11 THEN 40 + qty * 2 WHEN 12 THEN qty / 4 WHEN 13 THEN qty / 10
    WHEN 14 THEN floor(qty / 3) WHEN 15 THEN 35 + qty WHEN 16 THEN qty * 20 WHEN 18 THEN qty / 5 ELSE qty END AS value_as_number,
  CASE pk % 20 WHEN 0 THEN CASE ln % 3 WHEN 0 THEN 8753 WHEN 1 THEN 9557 ELSE 8840 END
    WHEN 1 THEN CASE ln % 3 WHEN 0 THEN 8840 ELSE 8753 END
    WHEN 2 THEN CASE ln % 3 WHEN 0 THEN 8840 WHEN 1 THEN 8749 ELSE 8837 END
    WHEN 3 THEN CASE ln % 3 WHEN 0 THEN 8753 ELSE 9557 END
    WHEN 4 THEN CASE ln % 3 WHEN 0 THEN 8840 ELSE 8713 END
    WHEN 7 THEN 8784 WHEN 8 THEN CASE ln % 3 WHEN 0 THEN 8554 WHEN 1 THEN 8784 ELSE 8848 END
    WHEN 13 THEN CASE ln % 3 WHEN 0 THEN 8840 ELSE 8753 END
    WHEN 6 THEN 8554 ELSE CASE ln % 2 WHEN 0 THEN 8848 ELSE 8961 END END AS unit_concept_id,
  CASE pk % 20 WHEN 0 THEN 3.5 WHEN 1 THEN 4.0 WHEN 2 THEN 0.5 WHEN 3 THEN 133.0 WHEN 4 THEN 12.0 WHEN 9 THEN 140.0 ELSE 10.0 END AS range_low,
  CASE pk % 20 WHEN 0 THEN 5.2 WHEN 1 THEN 9.0 WHEN 2 THEN 90.0 WHEN 3 THEN 145.0 WHEN 4 THEN 17.0 ELSE 40.0 END AS range_high,
  CASE WHEN pk % 4 = 0 THEN '' WHEN pk % 4 = 1 THEN 'POS ' || flag WHEN pk % 4 = 2 THEN CAST(CAST(qty AS INT) AS VARCHAR(9)) ELSE NULL END AS value_source_value
FROM {lines}) x""",
    "concept": f"""
SELECT CAST(concept_id AS BIGINT) AS concept_id, concept_name, concept_code, vocabulary_id, standard_concept, invalid_reason
FROM {_CONCEPT_VALUES}
UNION ALL SELECT 50000000 + p_partkey, p_name, CAST(p_partkey AS VARCHAR(20)), p_brand,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 'S' END, CASE WHEN p_partkey % 17 = 0 THEN 'D' ELSE NULL END FROM {{table:part}}
UNION ALL SELECT 80000000 + p_partkey, p_name,
  CASE WHEN p_partkey % 8 = 0 THEN CASE (p_partkey / 8) % 4 WHEN 0 THEN 'C10AA01' WHEN 1 THEN 'C10BA02' WHEN 2 THEN 'B01AB01' ELSE 'N02BE01' END
    ELSE CAST(400 + p_partkey % 45 AS VARCHAR(9)) || '.' || CAST(p_partkey % 3 AS VARCHAR(9)) || CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 4 AS VARCHAR(9)) ELSE '' END END,
  CASE WHEN p_partkey % 8 = 0 THEN 'ATC' ELSE 'ICD9CM' END, NULL, NULL FROM {{table:part}}""",
    "concept_relationship": """
SELECT 80000000 + p_partkey AS concept_id_1, 50000000 + p_partkey AS concept_id_2,
  CASE WHEN p_partkey % 10 = 9 THEN 'Subsumes' ELSE 'Maps to' END AS relationship_id FROM {table:part}""",
    "concept_ancestor": f"""
SELECT CAST(anc AS BIGINT) AS ancestor_concept_id, CAST(des AS BIGINT) AS descendant_concept_id FROM {_ANC}
UNION ALL SELECT CAST(dx.anc AS BIGINT), 50000000 + p.p_partkey FROM {{table:part}} p JOIN {_DX} ON p.p_partkey % 60 = dx.pos
UNION ALL SELECT CAST(dg.anc AS BIGINT), 50000000 + p.p_partkey FROM {{table:part}} p JOIN {_DRUG} ON p.p_partkey % dg.modulus = dg.rest
UNION ALL SELECT 50000000 + CAST(floor(p_partkey / 10) * 10 AS BIGINT), 50000000 + p_partkey FROM {{table:part}}""",
    "note": """
SELECT doc_id AS note_id, doc_id % 150 AS person_id, doc_id * 13 % 15000 AS visit_occurrence_id,
  CASE WHEN lang = 'en' THEN 44814637 ELSE 44814639 END AS note_type_concept_id,
  DATE '1996-01-01' + CAST((doc_id * 31) % 2000 AS INT) AS note_date,
  CAST(DATE '1996-01-01' + CAST((doc_id * 31) % 2000 AS INT) AS {TS}) + (doc_id % 30) * INTERVAL '1' HOUR AS note_datetime
FROM {table:documents}""",
    "note_nlp": """
SELECT doc_id * 2 + k AS note_nlp_id, doc_id AS note_id, 50000000 + (n_chars * (k + 3)) % 1999 + 1 AS note_nlp_concept_id,
  CASE WHEN n_chars % 4 = 0 THEN 'N' ELSE 'Y' END AS term_exists
FROM (SELECT doc_id, n_chars, 0 AS k FROM {table:documents} UNION ALL SELECT doc_id, n_chars, 1 AS k FROM {table:documents}) x""",
    "predictions": """
SELECT l.doc_id AS row_id, l.doc_id % 97 AS person_id, l.quality AS labels,
  l.toxic AS other_label, d.lang AS grp, d.source AS site,
  CAST(20 + 250 * l.quality + (d.n_chars * 79 + l.doc_id * 1047) % 701 AS DOUBLE) / 1000 AS pred_probs,
  CAST(20 + (d.n_chars * 31 + l.doc_id * 457) % 907 AS DOUBLE) / 1000 AS base_probs,
  CAST(1 + l.doc_id % 3 AS DOUBLE) AS weights
FROM {table:labels} l JOIN {table:documents} d ON l.doc_id = d.doc_id""",
}

RELATIONS["code_edges"] = """
SELECT p_brand || '/' || CAST(p_partkey AS VARCHAR(20)) AS code, 'GRP/' || CAST(CAST(floor(p_partkey / 10) AS BIGINT) AS VARCHAR(20)) AS parent FROM {table:part}
UNION ALL SELECT p_brand || '/' || CAST(p_partkey AS VARCHAR(20)), 'SIZE/' || CAST(p_size % 7 AS VARCHAR(20)) FROM {table:part}
UNION ALL SELECT DISTINCT 'SIZE/' || CAST(p_size % 7 AS VARCHAR(20)), 'ROOT/0' FROM {table:part}
UNION ALL SELECT DISTINCT 'GRP/' || CAST(CAST(floor(p_partkey / 10) AS BIGINT) AS VARCHAR(20)), 'TOP/' || CAST(CAST(floor(p_partkey / 100) AS BIGINT) AS VARCHAR(20)) FROM {table:part}
UNION ALL SELECT DISTINCT 'TOP/' || CAST(CAST(floor(p_partkey / 100) AS BIGINT) AS VARCHAR(20)), 'ROOT/0' FROM {table:part}"""

_NAME = re.compile(r"\{(table:)?(\w+)\}")


def spark_text(name: str, folder: str) -> str:
    """Relation as Spark SQL, nested relations inlined."""
    def fill(m: re.Match) -> str:
        if m.group(1):
            return f"parquet.`{folder}/{m.group(2)}.parquet`"
        if m.group(2) == "TS":
            return "TIMESTAMP_NTZ"
        return f"({spark_text(m.group(2), folder)})"
    text = RELATIONS[name].replace("{{", "\x00").replace("}}", "\x01")
    return _NAME.sub(fill, text).replace("\x00", "{").replace("\x01", "}")


def oracle_text(name: str) -> tuple[str, list[str]]:
    """Relation for the checking engine and the relations it names."""
    needs: list[str] = []

    def fill(m: re.Match) -> str:
        if m.group(1):
            return m.group(2)
        if m.group(2) == "TS":
            return "TIMESTAMP"
        needs.append(m.group(2))
        return m.group(2)
    text = RELATIONS[name].replace("{{", "\x00").replace("}}", "\x01")
    return _NAME.sub(fill, text).replace("\x00", "{").replace("\x01", "}"), needs


class Tables:
    """Lazy access: ``t.person`` is a relation, ``t.raw('orders')`` a raw table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder).rstrip("/")
        self._stored: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stored(self, name: str, build, written: bool = False) -> DataFrame:
        """A derived table that several jobs read, written once per session; ``written`` says that the build has done so."""
        if name not in self._stored:
            self._stored[name] = build(self) if written else durable(build(self))
        return self._stored[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in RELATIONS:
            found = self.spark.sql(spark_text(name, self.folder))
        elif name in RAW:
            found = self.raw(name)
        else:
            raise AttributeError(name)
        self.__dict__[name] = found
        return found


def input_files(spark: SparkSession, folder: str) -> str:
    """Paths, sizes and times of the raw tables' files, as one text."""
    jvm = spark._jvm
    found = []
    for name in RAW:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path):
            for f in files.listStatus(path):
                found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(found))


def tables(spark: SparkSession, folder: str) -> Tables:
    """One ``Tables`` per session, folder and state of its files, so a relation is analysed once and never outlives them."""
    folder = str(folder).rstrip("/")
    files = input_files(spark, folder)
    known = _TABLES.get(folder)
    if known is None or known[0].spark is not spark or known[1] != files:
        known = _TABLES[folder] = (Tables(spark, folder), files)
    return known[0]


_TABLES: dict[str, tuple[Tables, str]] = {}
