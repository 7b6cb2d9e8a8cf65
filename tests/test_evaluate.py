import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from helpers import apply, plan_of
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import outputs
from bugtide.operators import evaluate, scoring

ROOT = Path(__file__).resolve().parents[1]

ANSWERS = {
    "severity:P1 | team:platform": ("P1", "platform"),
    "severity:P0|team:infra": ("P0", "infra"),
    "some garbage text": (None, None),
    "Sev severity : p3|TEAM: Infra x": ("P3", "infra"),
    "severity:P2 | team:payments": ("P2", None),
    "severity:P9 | team:infra": (None, None),
    "severity:P1 | team:": (None, None),
    "severity\n:\tP4 \n|　team:db severity:P0|team:infra": ("P4", None),
    "x severity:P9|team:infra severity:P0|team:mobile y": ("P0", "mobile"),
    "severity:P1|team:infrà": ("P1", None),
    "severity:P1|team:infra.": ("P1", "infra"),
    "": (None, None),
    None: (None, None),
}


def test_parse_outputs(spark):
    found = apply(spark, list(ANSWERS), outputs.severity, outputs.team)
    assert dict(zip(ANSWERS, found)) == ANSWERS


def scored(spark, seed, n):
    rng = random.Random(seed)
    levels = rng.sample(v.PRIORITIES, rng.randint(1, 5))
    rows = [
        (f"k{i}", rng.choice(levels), rng.choice(v.TEAMS), rng.choice([*v.PRIORITIES, None]), rng.choice([*v.TEAMS, None]))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(
        rows, "report_key string, priority string, team string, pred_severity string, pred_team string"
    )


@pytest.mark.parametrize("seed", range(4))
def test_metrics_equal_a_direct_count(spark, seed):
    rows, df = scored(spark, seed, 157)
    counts = evaluate.outcome_counts(df)
    record = evaluate.metric_record(counts).first()
    scores = []
    for p in v.PRIORITIES:
        tp = sum(r[1] == r[3] == p for r in rows)
        wrong = sum((r[1] == p) != (r[3] == p) for r in rows)
        scores.append(2 * tp / (2 * tp + wrong) if tp + wrong else 0.0)
    n = len(rows)
    near = lambda x: pytest.approx(x, abs=6e-5)
    assert record.severity_macro_f1 == near(sum(scores) / 5)
    assert [record.per_class_f1[p] for p in v.PRIORITIES] == [near(s) for s in scores]
    assert record.severity_accuracy == near(sum(r[1] == r[3] for r in rows) / n)
    assert record.team_accuracy == near(sum(r[2] == r[4] for r in rows) / n)
    assert record.parse_failure_rate == near(sum(r[3] is None for r in rows) / n)
    matrix = [[sum(r[1] == t and r[3] == p for r in rows) for p in v.PRIORITIES] for t in v.PRIORITIES]
    assert record.confusion_matrix == matrix and record.n_samples == n
    cells = {(r.true_severity, r.pred_severity): r.rows for r in evaluate.confusion_matrix(counts).collect()}
    assert len(cells) == 25 and sum(cells.values()) == sum(r[3] is not None for r in rows)
    for r in evaluate.per_class_f1(counts).collect():
        assert r.support == sum(x[1] == r.severity for x in rows)
        assert r.predicted == sum(c for (_, p), c in cells.items() if p == r.severity)


def test_empty_input_gives_nulls_not_errors(spark):
    df = scored(spark, 1, 1)[1].limit(0)
    record = evaluate.metric_record(evaluate.outcome_counts(df)).first()
    assert record.n_samples == 0 and record.severity_accuracy is None and record.parse_failure_rate is None
    assert evaluate.parse_failure_rate(df).first().parse_failure_rate is None


def test_critical_errors(spark):
    rows = [("P0", "P3", 4), ("P0", "P1", 2), ("P1", "P1", 9), ("P1", "P4", 0), ("P2", "P4", 7)]
    df = spark.createDataFrame(rows, "true_severity string, pred_severity string, rows long")
    found = {(r.true_severity, r.pred_severity): r.kind for r in evaluate.critical_errors(df).collect()}
    assert found == {("P0", "P3"): "CRITICAL", ("P0", "P1"): "notable"}


def test_copies_of_a_report_meet_their_prediction_once(spark):
    truth = spark.createDataFrame(
        [("hot", "P1", "infra")] * 300 + [("cold", "P2", "mobile")], "report_key string, priority string, team string"
    )
    answers = spark.createDataFrame(
        [("hot", "severity:P1|team:infra"), ("cold", "junk")], "report_key string, raw_output string"
    )
    record = evaluate.evaluate(truth, answers).first()
    assert record.n_samples == 301 and record.severity_accuracy == round(300 / 301, 4)
    gaps = evaluate.alignment_gaps(truth, answers).first()
    assert tuple(gaps) == (0, 0, 0)
    odd = answers.where("report_key = 'hot'").union(answers.where("report_key = 'hot'")).union(
        spark.createDataFrame([("stray", "x")], "report_key string, raw_output string")
    )
    assert tuple(evaluate.alignment_gaps(truth, odd).first()) == (1, 1, 1)


def test_a_key_with_a_third_of_the_reports_is_split(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, x in settings.items():
        spark.conf.set(k, x)
    try:
        n = 30_000
        number = F.col("id").cast("string")
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(number)
        truth = spark.range(n).repartition(8).select(key.alias("report_key"), F.sha2(number, 256).alias("body"))
        answers = spark.range(1, n).select(key.alias("report_key")).distinct().withColumn("raw_output", F.lit("x"))
        answers.write.parquet(str(tmp_path / "answers"))
        joined = evaluate.align(truth, spark.read.parquet(str(tmp_path / "answers")))
        assert len(joined.collect()) == n
        assert "skewed" in plan_of(joined)
    finally:
        for k, x in before.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_report_marks_failed_parses_as_wrong(spark):
    df = spark.createDataFrame(
        [("t", "", "P1", "infra", "junk"), ("t", " \n", "P1", "infra", "severity:P1|team:db")],
        "title string, body string, priority string, team string, raw_output string",
    )
    a, b = evaluate.prediction_report(df).collect()
    assert (a.sev_correct, a.team_correct) == (False, False)
    assert (b.sev_correct, b.team_correct, b.pred_team) == (True, False, None)
    assert a.input_prompt == b.input_prompt == "### Incident report:\nt\n\n### Triage:\n"


REPORTS = [
    ("CRITICAL: Production database is completely down.", "severity:P0 | team:database"),
    ("Login page throwing errors, OAuth redirect failing.", "severity:P1 | team:security"),
    ("API response times degraded on checkout endpoint", "severity:P2 | team:backend"),
    ("Disk usage on staging server at 85%", "severity:P3 | team:infra"),
    ("iOS app shows wrong font on settings screen", "severity:P4 | team:mobile"),
]


def test_score_reports(spark):
    df = spark.createDataFrame([(t, "") for t, _ in REPORTS], "title string, body string")
    found = {r.title: r.raw_output for r in scoring.score_reports(df).collect()}
    assert found == dict(REPORTS)


def test_the_predictor_gets_whole_prompts_with_their_line_breaks(spark):
    def make():
        return lambda batch: [p + "!" for p in batch]

    body = "\n".join(f"line {i}" for i in range(400))
    df = spark.createDataFrame([("long title " * 50, body)], "title string, body string")
    row = scoring.score_reports(df, make).first()
    assert row.raw_output == row.input_prompt + "!" and body in row.raw_output
    assert row.raw_output.endswith("\n### Triage:\n!")


def test_the_rule_is_the_same_in_columns_and_in_batches(spark):
    df = spark.createDataFrame([(t, "") for t, _ in REPORTS], "title string, body string")
    batches = scoring.score_reports(df, scoring.rule_predictor).collect()
    assert batches == scoring.score_reports(df).collect()
    assert "Python" not in plan_of(scoring.score_reports(df))


TRUTH = [("a", "P1", "infra"), ("b", "P1", "infra"), ("c", "P1", "infra"), ("d", "P1", "infra")]


def test_incomplete_or_repeated_answers_raise_or_count_as_failures(spark):
    truth = spark.createDataFrame(TRUTH, "report_key string, priority string, team string")
    right = "severity:P1|team:infra"

    def answers(*names):
        return spark.createDataFrame([(n, right) for n in names], "report_key string, raw_output string")

    for odd in (answers("a", "b"), answers("a", "b", "b", "c", "d"), answers("a", "b", "c", "d", "stray")):
        with pytest.raises(ValueError, match="one to one"):
            evaluate.evaluate(truth, odd)
    record = evaluate.evaluate(truth, answers("a", "b", "stray"), gaps="failure").first()
    assert (record.n_samples, record.severity_accuracy, record.parse_failure_rate) == (4, 0.5, 0.5)
    record = evaluate.evaluate(truth, answers("a", "b", "b", "c", "d"), gaps="failure").first()
    assert (record.n_samples, record.severity_accuracy) == (4, 0.75)


def test_predictor_sees_the_prompt_only(spark):
    df = spark.createDataFrame([("t", "b", "x" * 10)], "title string, body string, wide string")
    plan = plan_of(scoring.score_reports(df, scoring.rule_predictor))
    assert "ArrowEvalPython" in plan and "MapInPandas" not in plan and "BatchEvalPython" not in plan


def test_scoring_works_where_only_the_driver_has_the_package(tmp_path):
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from bugtide.operators import scoring
df = spark.createDataFrame([("iOS app shows wrong font", "")], "title string, body string")
print("ANSWER", scoring.score_reports(df, scoring.rule_predictor).first().raw_output)
"""
    clean = {k: x for k, x in os.environ.items() if not k.startswith(("PYTHONPATH", "PYSPARK", "SPARK"))}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=180
    )
    assert "ANSWER severity:P4 | team:mobile" in done.stdout, done.stderr[-2000:]
