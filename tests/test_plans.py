"""Plans that must keep their shape."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sepsis_scores_meet_their_periods_once(spark):
    text = plan(entry.queries()["sep_11_score_differences"](spark, SMALL))
    assert text.count("Exchange hashpartitioning") <= 15


def test_all_sets_come_from_one_pass(spark):
    text = plan(entry.queries()["con_02_source_rollup"](spark, SMALL))
    assert text.count("Exchange hashpartitioning") <= 6


def test_cumulative_counts_have_no_bucketed_pairs(spark):
    assert "_bucket" not in plan(entry.queries()["tft_05_counts_in_time_bins"](spark, SMALL))


def test_stored_tables_follow_their_files(spark, tmp_path):
    from wardflow.sources.adapter import RAW, tables

    for name in RAW:
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    one = tables(spark, str(tmp_path))
    assert tables(spark, str(tmp_path)) is one
    people = one.stored("people", lambda t: t.person).count()
    spark.read.parquet(f"{SMALL}/customer.parquet").where(F.col("c_custkey") % 2 == 0).write.mode("append").parquet(f"{tmp_path}/customer.parquet")
    again = tables(spark, str(tmp_path))
    assert again is not one and again.stored("people", lambda t: t.person).count() > people
