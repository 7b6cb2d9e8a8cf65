import collections
import random

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.catalogue import adapters
from bugtide.operators import labelling, split
from bugtide.operators.copies import count_copies, repeat_rows


def table(spark, counts):
    rows = [(f"{p}-{i}", p) for p, n in counts.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "report_key string, priority string").repartition(7)


def test_published_sizes():
    total = split.split_quotas({"P0": 10_000, "P1": 20_000, "P2": 14_795, "P3": 90_000, "P4": 20_000}, 0.8, 0.1)
    sizes = [sum(q[name] for q in total.values()) for name in ("train", "val", "test")]
    assert sizes == [123_836, 15_479, 15_480]


def test_largest_remainder():
    assert split.proportional_quotas({"a": 5, "b": 3, "c": 2}, 7) == {"a": 4, "b": 2, "c": 1}
    assert split.proportional_quotas({"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}


@pytest.mark.parametrize("seed", range(5))
def test_quotas_add_up(seed):
    rng = random.Random(seed)
    counts = {f"P{i}": rng.randint(12, 5_000) for i in range(5)}
    quotas = split.split_quotas(counts, 0.8, 0.1)
    for label, quota in quotas.items():
        assert sum(quota.values()) == counts[label] and min(quota.values()) >= 0
        assert abs(quota["train"] - 0.8 * counts[label]) < 1.5


def test_split_is_exact_complete_and_repeatable(spark):
    counts = {"P0": 31, "P1": 100, "P2": 57, "P3": 1_403, "P4": 10}
    df = table(spark, counts)
    first = split.stratified_split(df)
    quotas = split.split_quotas(counts, 0.8, 0.1)
    found = {(r.priority, r.split): r["count"] for r in first.groupBy("priority", "split").count().collect()}
    assert found == {(p, s): n for p, q in quotas.items() for s, n in q.items() if n}
    assert first.select("report_key").distinct().count() == sum(counts.values())
    again = split.stratified_split(df.repartition(3))
    assert rows_of(first) == rows_of(again)
    assert rows_of(first) != rows_of(split.stratified_split(df, seed=1))


def test_split_equals_a_plain_ranking(spark):
    df = table(spark, {"P0": 40, "P3": 700})
    order = split.keys.row_digest(["priority", "report_key"], "42")
    ranked = collections.defaultdict(list)
    for row in df.select("*", order.alias("o")).collect():
        ranked[row.priority].append((row.o, row.report_key))
    quotas = split.split_quotas({"P0": 40, "P3": 700}, 0.8, 0.1)
    expected = []
    for label, rows in ranked.items():
        names = [n for n in ("train", "val", "test") for _ in range(quotas[label][n])]
        expected += [(key, label, name) for (_, key), name in zip(sorted(rows), names)]
    assert rows_of(split.stratified_split(df)) == sorted(expected, key=repr)


def test_identical_rows_are_divided_by_count(spark):
    """A third of the rows are copies of one row, so the bounds fall inside them."""
    rows = [("same", "P3")] * 900 + [(f"k{i}", "P3") for i in range(100)] + [("other", "P1")] * 50
    df = spark.createDataFrame(rows, "report_key string, priority string").repartition(5)
    out = split.stratified_split(df)
    quotas = split.split_quotas({"P3": 1_000, "P1": 50}, 0.8, 0.1)
    found = {(r.priority, r.split): r["count"] for r in out.groupBy("priority", "split").count().collect()}
    assert found == {(p, s): n for p, q in quotas.items() for s, n in q.items()}
    assert rows_of(out.drop("split")) == rows_of(df)


def test_too_small_a_class_is_refused(spark):
    with pytest.raises(ValueError, match="P0"):
        split.stratified_split(table(spark, {"P0": 1, "P3": 100}))
    with pytest.raises(ValueError, match="without a priority"):
        split.stratified_split(spark.createDataFrame([("a", None)], "report_key string, priority string"))


def test_assignment_neither_joins_nor_shuffles(spark):
    out = split.stratified_split(table(spark, {"P0": 40, "P3": 700}))
    plan = plan_of(out)
    # The only exchange is the one that the input comes with.
    assert plan.count("Exchange") == plan.count("Exchange RoundRobin") == 1
    assert "Join" not in plan and "Window" not in plan


def test_places_are_narrowed_down_in_three_passes(spark, monkeypatch):
    df = table(spark, {"P0": 40, "P3": 700})
    expected = rows_of(split.stratified_split(df))
    monkeypatch.setattr(split, "FINE_ROWS", 0)
    assert rows_of(split.stratified_split(df)) == expected


def test_rows_that_share_a_key_are_divided_by_their_columns(spark):
    """Half the rows have one key, some of them are equal besides."""
    rows = [("same", "P3", f"text {i % 300}") for i in range(500)] + [(f"k{i}", "P3", "x") for i in range(500)]
    df = spark.createDataFrame(rows, "report_key string, priority string, body string").repartition(5)
    out = split.stratified_split(df)
    quotas = split.split_quotas({"P3": 1_000}, 0.8, 0.1)["P3"]
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == quotas
    assert rows_of(out.drop("split")) == rows_of(df)
    assert rows_of(out) == rows_of(split.stratified_split(df.repartition(2)))


def test_too_many_strata_are_refused(spark, monkeypatch):
    monkeypatch.setattr(split, "MAX_STRATA", 1)
    with pytest.raises(ValueError, match="more than 1 values of priority"):
        split.stratified_split(table(spark, {"P0": 40, "P3": 700}))


def test_a_split_of_labels_cleans_no_text(spark):
    df = labelling.drop_unknown_team(adapters.labelled(spark, "/root/testdata/sf0.001"))
    plan = plan_of(split.stratified_split(df).select("report_key", "priority", "split"))
    assert v.BLANK_LINES not in plan.replace("\\n", "\n") and "<[^>]+>" not in plan


def test_seeded_sample_takes_only_the_top(spark):
    df = table(spark, {"P0": 50, "P3": 300})
    sample = split.seeded_sample(df, 20)
    assert "TakeOrderedAndProject" in plan_of(sample)
    assert rows_of(sample) == rows_of(split.seeded_sample(df.repartition(2), 20))
    assert sample.count() == 20 and split.seeded_sample(df, 1_000).count() == 350


def test_sample_per_group(spark):
    df = table(spark, {"P0": 4, "P1": 30, "P3": 900})
    out = split.sample_per_group(df, ["priority"], 10)
    counts = {r.priority: r["count"] for r in out.groupBy("priority").count().collect()}
    assert counts == {"P0": 4, "P1": 10, "P3": 10}
    order = split.keys.seeded_order(F.col("report_key"))
    best = df.where("priority = 'P3'").orderBy(order).limit(10)
    assert rows_of(best) == rows_of(out.where("priority = 'P3'"))
    assert "WindowGroupLimit" in plan_of(out)


def test_samples_sort_no_text(spark):
    """Only groups, keys and their order are drawn from; the text is joined to the winners."""
    df = spark.createDataFrame(
        [(f"k{i}", "P3" if i % 3 else None, "text " * 50) for i in range(600)], "report_key string, priority string, body string"
    )
    out = split.sample_per_group(df, ["priority"], 4)
    lines = plan_of(out).splitlines()
    drawn = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    below = lines[drawn[0] : ]
    assert drawn and all("body" not in line for line in lines[drawn[0] : drawn[-1] + 2] if "Sort" in line or "Exchange" in line)
    assert any("_seeded" in line for line in below if "Sort" in line)
    assert {(r.priority, r["count"]) for r in out.groupBy("priority").count().collect()} == {("P3", 4), (None, 4)}


def test_sample_of_rows_that_share_a_key(spark):
    """A third of the rows have one key; no more of them are drawn than the group may have."""
    rows = [("same", "P3", f"text {i}") for i in range(200)] + [(f"k{i}", "P3", "x") for i in range(400)] + [(None, "P1", "y")] * 3
    df = spark.createDataFrame(rows, "report_key string, priority string, body string").repartition(4)
    for n in (1, 5, 250, 1000):
        out = split.sample_per_group(df, ["priority"], n)
        counts = {r.priority: r["count"] for r in out.groupBy("priority").count().collect()}
        assert counts == {"P3": min(n, 600), "P1": min(n, 3)}
        assert rows_of(out) == rows_of(split.sample_per_group(df.repartition(2), ["priority"], n))
        assert out.exceptAll(df).count() == 0


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), (None, 25)], "x string, n int")
    out = repeat_rows(df, F.col("n"), chunk=10)
    assert rows_of(out) == sorted([("b", 1)] + [(None, 25)] * 25, key=repr)
    assert rows_of(count_copies(out)) == sorted([("b", 1, 1), (None, 25, 25)], key=repr)
