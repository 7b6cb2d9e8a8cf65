"""Batch scoring of reports with a rule or a pluggable predictor."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import labels, prompts
from bugtide.functions import text as tx
from bugtide.shipping import ship_package

# Takes a batch of prompts, gives one answer each.
Predict = Callable[[list[str]], list[str]]

# Words by which the rule guesses a severity, most severe first.
SEVERITY_WORDS = [
    ("P0", ["blocker", "critical", "crash", "down", "outage"]),
    ("P1", ["failing", "fails", "failure", "error", "errors", "severe"]),
    ("P2", ["degraded", "slow", "timeout", "regression"]),
    ("P4", ["cosmetic", "typo", "minor", "trivial", "wrong"]),
]


def rule_answer(prompt: Column) -> Column:
    """A deterministic stand-in for a model: keywords decide both answers."""

    def answer(found: Column) -> Column:
        level = labels.first_rule(found, SEVERITY_WORDS, v.DEFAULT_PRIORITY)
        return prompts.completion(level, labels.first_rule(found, v.TEAM_KEYWORDS, v.UNKNOWN_TEAM))

    return tx.named(labels.keywords_in(prompt, SEVERITY_WORDS, v.TEAM_KEYWORDS), answer)


def rule_predictor() -> Predict:
    """The same rule as a predictor of batches."""
    severities, teams = ([(a, set(words)) for a, words in rules] for rules in (SEVERITY_WORDS, v.TEAM_KEYWORDS))
    word = re.compile(r"\w+")

    def predict(batch: list[str]) -> list[str]:
        answers = []
        for prompt in batch:
            seen = set(word.findall(prompt.lower()))
            level, team = (
                next((answer for answer, keywords in rules if keywords & seen), default)
                for rules, default in ((severities, v.DEFAULT_PRIORITY), (teams, v.UNKNOWN_TEAM))
            )
            answers.append(f"{v.COMPLETION_SEVERITY}{level}{v.COMPLETION_TEAM}{team}")
        return answers

    return predict


def score_reports(df: DataFrame, make_predictor: Callable[[], Predict] | None = None) -> DataFrame:
    """Add ``input_prompt`` and ``raw_output``.

    Without a predictor the rule answers, in column expressions. A predictor is made
    once per task and sees only the whole prompts, in Arrow batches; cutting them is
    its tokenizer's business, and so is the length of the answers.
    """
    prompted = df.withColumn("input_prompt", prompts.prompt(F.col("title"), F.col("body")))
    if make_predictor is None:
        return prompted.withColumn("raw_output", rule_answer(F.col("input_prompt")))
    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = make_predictor()
        for batch in batches:
            yield pd.Series(predict(batch.tolist()))

    return prompted.withColumn("raw_output", answer("input_prompt"))
