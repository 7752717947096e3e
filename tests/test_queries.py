"""Query registry: contract, oracles that bind, and a sample compared row by row."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from wardflow.plans import registry
from wardflow.sources.adapter import RAW

SAMPLE = [
    "coh_02_admission_rollup", "coh_03_one_admission_per_person", "out_05_readmission", "out_06_icu_admission", "labq_03_aki_lab",
    "labq_06_neutropenia_lab", "dxq_01_all_diagnosis_labels", "out_13_cardiovascular_outcome", "con_03_recover_unmapped", "sep_11_score_differences",
    "ftq_01_concept_counts", "ftq_09_value_bins", "ftq_15_sparse_matrix", "tml_05_merged_timeline", "ont_01_subwords", "tlb_17_readmission",
    "tlb_20_high_value_sequence", "tlb_22_next_year_category", "tft_08_numeric_bins", "seq_02_valid_codes", "spl_05_task_exclusions",
    "evl_01_metrics_by_stratum", "evl_17_cross_auc", "stt_02_superiority", "srv_01_time_bins", "evl_20_bootstrap_calibration_curve", "tft_09_encode_decode",
    "tml_18_timeline_store", "snk_07_row_maps", "ftq_18_split_matrix", "seq_09_numeric_ranges", "mdl_01_design_matrix",
]
WITHOUT_ORACLE: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, (int, float, Decimal)):
        return float(f"{float(v):.9g}")
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(registry.QUERIES) - set(entry.oracle_sql()) == WITHOUT_ORACLE


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle_binds(duck, name):
    duck.execute("explain " + entry.oracle_sql()[name])


def test_entry(spark):
    got = entry.entry(spark)
    assert set(got.columns) == {"person_id", "admit_date", "discharge_date", "readmission_window", "readmission_30"}
    assert got.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SMALL)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want)
    assert want


def test_every_unmapped_code_of_con_03_is_recovered(spark, small):
    # All parent edges of the parts count, so every chain ends at a mapped code.
    got = registry.run("con_03_recover_unmapped", spark, SMALL)
    assert got.count() == small.part.where("p_partkey % 11 <> 0").count()
