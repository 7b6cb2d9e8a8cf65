import random
import statistics

import numpy as np
import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from bugtide import storage
from bugtide import vocabulary as v
from bugtide.operators import profile
from bugtide.plans import reports
from bugtide.sources import tables


def frame(spark, values, type_="double", name="x"):
    return spark.createDataFrame([(x,) for x in values], f"{name} {type_}")


@pytest.mark.parametrize(
    ("values", "cap", "bins"),
    [
        ([float(x) for x in random.Random(3).choices(range(800), k=500)], 365, 50),
        ([1.0, 2.0, 3.0, 60.0, 61.0, 99.0], 60, 40),
        ([7.0, 7.0], 365, 50),
        ([0.0, 500.0], 500, 50),
        ([random.Random(5).random() * 10 for _ in range(200)], 8, 7),
    ],
)
def test_histogram_equals_numpy(spark, values, cap, bins):
    found = profile.histogram(frame(spark, [*values, None]), "x", cap, bins).orderBy("bin").collect()
    rows, edges = np.histogram(np.minimum(values, cap), bins)
    assert [r.rows for r in found] == rows.tolist()
    assert [r.lower for r in found] == pytest.approx(edges[:-1].tolist())
    assert [r.upper for r in found] == pytest.approx(edges[1:].tolist())


def test_value_counts_leave_out_missing(spark):
    df = frame(spark, ["a", "b", "b", None, "c", "c"], "string")
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [("b", 2), ("c", 2), ("a", 1)]


def test_domain_counts_and_pivots(spark):
    df = spark.createDataFrame([("s", "P0"), ("s", "P0"), ("t", "P4"), (None, "P1"), ("t", None)], "source string, priority string")
    assert [tuple(r) for r in profile.domain_counts(df).collect()] == [("P0", 2), ("P1", 1), ("P2", 0), ("P3", 0), ("P4", 1)]
    assert rows_of(profile.count_pivot(df, "source", "priority", v.PRIORITIES)) == [("s", 2, 0, 0, 0, 0), ("t", 0, 0, 0, 0, 1)]
    shares = profile.distribution_by(df, "priority", domain=["P0", "P4"])
    assert rows_of(shares) == [("s", 100.0, 0.0), ("t", 0.0, 100.0)]


def test_mapping_check(spark):
    df = spark.createDataFrame([("a", "P0"), ("a", "P0"), ("b", "P1"), ("b", "P0")], "raw_severity string, priority string")
    found = {r.raw_severity: (r.reached, r.is_single) for r in profile.mapping_check(df).collect()}
    assert found == {"a": ("P0", True), "b": ("P0,P1", False)}


def test_word_counts(spark):
    df = spark.createDataFrame([("a b", ""), ("", "x  y\nz"), ("one", "w")], "title string, body string")
    found = {r.field: tuple(r)[1:] for r in profile.word_count_summary(profile.with_word_counts(df)).collect()}
    assert found == {"title": (1.0, 1.0, 2), "body": (1.3, 1.0, 3)}


def test_median_is_exact(spark):
    values = [float(x) for x in random.Random(9).choices(range(50), k=100)]
    df = frame(spark, values, name="resolution_time_days").withColumn("source", F.lit("s"))
    assert profile.duration_summary(df).first().median_days == statistics.median(values)


MEDIAN_CASES = {
    "few": [float(x) for x in random.Random(1).choices(range(9), k=5000)],
    "fractions": [random.Random(2).random() ** 9 * 1e6 for _ in range(1)] + [random.Random(i).random() ** 9 * 1e6 for i in range(4000)],
    "heavy tails": [(-1) ** i * 10.0 ** (i % 600 - 300) for i in range(3001)],
    "one": [7.5],
    "two": [1.0, 2.0],
    "equal": [3.0] * 2000 + [1e300],
    None: [float(i) for i in range(999)],
}


@pytest.mark.parametrize(("fine", "error"), [(100_000, 1e-4), (50, 1e-4), (50, 0.02), (0, 0.2)])
def test_medians_by_narrowing(spark, fine, error):
    rows = [(g, x) for g, values in MEDIAN_CASES.items() for x in values] + [("one", None), ("none", None)]
    df = spark.createDataFrame(rows, "`group` string, value double").repartition(5)
    found = {r["group"]: r["median"] for r in profile.exact_medians(df, fine, error).collect()}
    assert found == {g: statistics.median(values) for g, values in MEDIAN_CASES.items()}


def test_medians_keep_no_counter_per_value(spark):
    df = spark.range(1000).select(F.lit("s").alias("source"), (F.col("id") / 7).alias("resolution_time_days"))
    found = profile.duration_summary(df)
    assert "percentile(" not in plan_of(found)
    row = found.first()
    assert (row.reports, row.median_days, row.min_days) == (1000, 999 / 14, 0.0)


def test_fractional_histogram_stores_nothing(spark):
    before = len(storage._folders)
    profile.histogram(spark.range(100).select((F.col("id") / 3).alias("x")), "x", 20, 5).collect()
    assert len(storage._folders) == before
    counted = profile.histogram(spark.range(100).select((F.col("id") % 4).alias("x")), "x", 2, 5)
    assert len(storage._folders) == before + 1 and sum(r.rows for r in counted.collect()) == 100


def test_histogram_of_nothing_and_of_missing_values(spark):
    for df in (frame(spark, []), frame(spark, [None]), frame(spark, [None], "int")):
        assert {(r.lower, r.rows) for r in profile.histogram(df, "x", 5, 3).collect()} == {(None, 0)}


def test_profile_reads_the_splits_twice(spark, tmp_path):
    rows = [(f"k{i}", str(i % 7), "s", f"t {i % 3}", "b " * (i % 5), v.PRIORITIES[i % 5], "infra", "", "fixed", float(i % 9), v.SPLITS[i % 3]) for i in range(90)]
    schema = "report_key string, id string, source string, title string, body string, priority string, team string, " \
        "raw_severity string, resolution string, resolution_time_days double, split string"
    tables.write_splits(spark.createDataFrame(rows, schema), str(tmp_path / "splits"))
    splits = tables.read_splits(spark, str(tmp_path / "splits"))
    seen = []
    found = reports.profile_dataset(splits.withColumn("is_over_escalated", F.col("priority") == "P0"))
    for name, table in found.items():
        if tmp_path.name in plan_of(table):
            seen.append(name)
    assert seen == ["duplicate_groups"]
    assert tuple(found["shape"].first()) == (90, 12)
    assert {r.source: r.rows for r in found["sources"].collect()} == {"s": 90}
    assert found["durations"].first().median_days == 4.0
    overall = found["over_escalation"].where("dimension = 'all'").first()
    assert (overall.positives, overall.total) == (18, 90)


def test_phrases_are_literal_substrings(spark):
    df = spark.createDataFrame(
        [("It MIGHT fail", "appears to"), ("mighty", ""), ("not", "sure"), ("a.b", None)], "title string, body string"
    )
    found = {r.phrase: r.reports for r in profile.phrase_counts(df).collect()}
    assert len(found) == 16
    assert (found["might"], found["appears to"], found["not sure"], found["flaky"]) == (2, 1, 1, 0)


def test_duplicates(spark):
    rows = [("a", 1), ("a", 1), ("a", None), ("a", None), ("a", None), (None, 1), ("b", 2)]
    df = spark.createDataFrame(rows, "x string, n int").repartition(3)
    assert tuple(profile.duplicate_summary(df).first()) == (7, 4, 3, 5)
    assert rows_of(profile.duplicate_groups(df)) == sorted([("a", 1, 2), ("a", None, 3)], key=repr)
    assert rows_of(profile.duplicate_members(df)) == sorted(rows[:5], key=repr)


def test_rates_by_dimension(spark):
    df = spark.createDataFrame([("a", "x", True), ("a", "y", False), ("b", "x", False)], "s string, p string, f boolean")
    found = {(r.dimension, r.value): (r.positives, r.total, r.rate_pct) for r in profile.rates_by_dimension(df, "f", ["s", "p"]).collect()}
    assert found == {
        ("all", "all"): (1, 3, 33.3), ("s", "a"): (1, 2, 50.0), ("s", "b"): (0, 1, 0.0),
        ("p", "x"): (1, 2, 50.0), ("p", "y"): (0, 1, 0.0),
    }


def test_quality_checks(spark):
    rows = [(p, "unknown" if i < 2 else "infra", i == 0, s) for i, (p, s) in enumerate(zip(v.PRIORITIES, ["train", "val", "test", "val", "val"]))]
    df = spark.createDataFrame(rows, "priority string, team string, is_over_escalated boolean, split string")
    found = {r.check: (r.value, r.passed) for r in profile.quality_checks(df).collect()}
    assert found == {
        "unknown_team_rate": (40.0, False), "priorities_represented": (5.0, True), "null_priorities": (0.0, True),
        "over_escalation_rate": (20.0, True), "positives_in_train": (1.0, True), "positives_in_val": (0.0, False),
        "positives_in_test": (0.0, False),
    }


def test_small_reports(spark):
    df = spark.createDataFrame([("P0", "unknown", "s"), (None, "infra", "s")], "priority string, team string, source string")
    assert tuple(profile.shape(df).first()) == (2, 3)
    assert profile.null_labels(df).first()[0] == 1
    assert tuple(profile.unknown_rate(df).first()) == (2, 1, 50.0)
    assert tuple(profile.team_coverage(df).first()) == ("s", 2, 1, 50.0)
    assert {r[0] for r in profile.distinct_values(df, "priority").collect()} == {"P0", None}


def test_word_counts_are_summed_up_without_a_job(spark):
    from bugtide import storage

    rows = [(1, 4), (2, 4), (2, None), (9, 7), (None, 1)]
    before = storage.stored()
    found = profile.word_count_summary(spark.createDataFrame(rows, "title_words int, body_words int"))
    assert storage.stored() == before
    assert {r.field: tuple(r)[1:] for r in found.collect()} == {"title": (3.5, 2.0, 9), "body": (4.0, 4.0, 7)}
    empty = profile.word_count_summary(spark.createDataFrame([], "title_words int, body_words int"))
    assert sorted(map(tuple, empty.collect())) == [("body", None, None, None), ("title", None, None, None)]


def test_tables_of_counts_read_no_text(spark, tmp_path):
    from bugtide.plans import reports

    columns = "source string, priority string, team string, split string, title string, body string, resolution_time_days double"
    spark.createDataFrame([("a", "P1", "infra", "train", "t", "b", 1.0)], columns).write.parquet(str(tmp_path / "s"))
    seen = []
    splits = spark.read.parquet(str(tmp_path / "s"))
    original = reports.written
    reports.written = lambda df: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or original(df)
    try:
        assert reports.profile_tables(splits)["shape"]().first().rows == 1
    finally:
        reports.written = original
    read = spark.read.parquet(str(tmp_path / "s")).columns
    assert len(seen) == 1 and "md5" not in seen[0] and set(read) == set(splits.columns)
