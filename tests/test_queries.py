"""Every registered query against its SQL, and the shape of the plans."""

import os

import compare
import pytest
from helpers import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bugtide import storage
from bugtide.catalogue import adapters
from bugtide.catalogue.oracle import ORACLE
from bugtide.catalogue.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return compare.connect(SMALL)


OWN = list(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, database, name):
    """The rows, and a plan that stays in the JVM and crosses nothing."""
    found = entry.queries()[name](spark, SMALL)
    plan = plan_of(found)
    for bad in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    assert compare.difference(found, database, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(OWN) == set(ORACLE) and set(OWN) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 2


def test_report_texts_are_dealt_over_the_cores(spark):
    """One file of one row group feeds all cores; no task holds more than its share of the texts."""
    rows = adapters.tracker_raw(spark, SMALL).select(F.spark_partition_id().alias("task"), F.length("body").alias("n"))
    shares = [r["count"] for r in rows.groupBy("task").count().collect()]
    assert len(shares) >= spark.sparkContext.defaultParallelism
    assert max(shares) < 3 * sum(shares) / len(shares)


def test_texts_joined_by_a_shuffle_are_dealt_over_the_cores(spark):
    """The tasks of that join are not merged by the few bytes they read."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = adapters.tracker_raw(spark, SMALL).select(F.spark_partition_id().alias("task"), F.length("body").alias("n"))
        shares = [r["count"] for r in rows.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(shares) >= spark.sparkContext.defaultParallelism
    assert max(shares) < 3 * sum(shares) / len(shares)


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entry.queries()["dedup_stats"](spark, SMALL))
    assert plan.count("ReadSchema: struct<o_orderkey:bigint>") >= 1
    plan = plan_of(entry.queries()["resolution_days"](spark, SMALL))
    assert "l_extendedprice" not in plan and "documents" not in plan


@pytest.mark.parametrize("name", ["confusion_matrix", "severity_f1", "metrics_summary"])
def test_metrics_count_before_the_last_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    assert "partial_count" in plan and "partial_sum" in plan


@pytest.mark.parametrize("name", ["ingest_reports", "ingest_cleaned", "ingest_statistics", "ingest_merged"])
def test_exports_go_when_they_have_been_read(spark, name):
    before = storage.stored()
    found = QUERIES[name](spark, SMALL)
    kept = storage._folders[before:]
    assert not [folder for folder in kept if os.path.exists(f"{folder}/trackers")]
    assert name != "ingest_merged" or len([folder for folder in kept if os.path.exists(folder)]) == 1
    assert found.count() > 0


def test_stored_tracker_table_is_gzipped(spark):
    root = adapters.stored_sources(spark, SMALL)
    files = [name for name in os.listdir(f"{root}/tracker") if name.startswith("part-")]
    assert files and all(name.endswith(".csv.gz") for name in files)
