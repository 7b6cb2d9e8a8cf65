"""Score a split, report the predictions and compute the metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bugtide.operators import evaluate, scoring
from bugtide.sources import output, tables
from bugtide.storage import written


def evaluate_split(
    spark: SparkSession,
    splits_path: str,
    split: str = "val",
    make_predictor: Callable[[], scoring.Predict] | None = None,
    report_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Prediction report and metric record of one split.

    Predictions are stored before they are used twice, so the predictor runs
    once per report. The answer stays on the report's row; nothing is joined.
    """
    rows = tables.read_splits(spark, splits_path, split)
    report = written(evaluate.prediction_report(scoring.score_reports(rows, make_predictor)))
    if report_path:
        output.replace(spark, report_path, lambda staged: tables.write_csv(report, staged))
    return report, evaluate.metric_record(evaluate.outcome_counts(report))
