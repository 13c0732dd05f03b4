"""Plans of the queries: no operator that breaks down at scale."""

import re

import pytest

from equifacts.bindings import QUERIES
from equifacts.bindings.catalog import Data
from equifacts.bindings.reports import landed_tables
from equifacts.session import PACKED, configure

FOLDER = "/root/testdata/sf0.001"
# These run jobs of their own while they are built; their steps are covered by the others.
EAGER = {
    "full_run", "csv_tables", "landed_increment", "stored_upsert", "resume_midway", "rerun_no_write", "landed_companies",
    "cascade_stored", "quarantined", "latest_kept", "constituent_files", "report_files", "run_records", "report_order",
    "facet_short"}


def plan(spark, name):
    df = QUERIES[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_costly_operator(spark, no_broadcast, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


@pytest.mark.parametrize("name", ["upsert_rows", "upsert_periods", "upsert_changes"])
def test_upsert_shuffles_each_side_once(spark, no_broadcast, name):
    text = plan(spark, name)
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("FullOuter") == 1


def test_rank_limit_holds_before_the_shuffle(spark, no_broadcast):
    for name in ("latest_n_periods", "quarterly_report"):
        assert plan(spark, name).count("WindowGroupLimit") == 2


def test_scans_read_the_needed_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    read = re.findall(r"ReadSchema: struct<(.*?)>", plan(spark, "fold_duplicates"))
    assert len(read) == 1 and "l_quantity" not in read[0] and "l_returnflag" not in read[0]
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus," in plan(
        spark, "replace_keep")
    pages = plan(spark, "page_holdings")
    assert "EvalPython" not in pages and "c_name" in pages


def test_pages_and_entities_are_read_without_python(spark):
    for name in ("page_profile", "page_fields", "clean_names", "feed_to_prices", "feed_to_periods", "resolve_identity", "merge_by_key"):
        assert "EvalPython" not in plan(spark, name)


def test_pages_of_a_small_table_are_dealt_over_tasks(spark):
    """One row group of customers makes pages that are far longer than its rows."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("page_profile", "page_holdings"):
        assert QUERIES[name](spark, FOLDER).rdd.getNumPartitions() == parts > 1


def test_tasks_are_packed_by_fewer_bytes_than_spark_does(spark):
    """A size that was given stands."""
    old = spark.conf.get(PACKED)
    try:
        for given, used in ((None, "4m"), ("8m", "8m"), ("128m", "128m")):
            spark.conf.unset(PACKED) if given is None else spark.conf.set(PACKED, given)
            configure(spark)
            assert spark.conf.get(PACKED) == used
    finally:
        spark.conf.set(PACKED, old)


def test_pages_of_a_run_are_made_after_the_join(spark):
    text = landed_tables(Data(spark, FOLDER)).pages._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("company_info") < text.index("Join ")
