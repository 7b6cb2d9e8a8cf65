"""Derive priority, team and clean text; flag over-escalated reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import labels, times
from bugtide.functions import text as tx


def normalise_priority(
    df: DataFrame, bugzilla: str = v.BUGZILLA, tracker: str = v.TRACKER
) -> DataFrame:
    level = labels.priority(
        F.col("source"), F.col("raw_severity"), F.col("raw_priority"), bugzilla, tracker
    )
    return df.withColumn("priority", level)


def assign_team(df: DataFrame) -> DataFrame:
    """Must see the uncleaned text, so it comes before ``clean_texts``.

    The team leaves a generator, which no filter passes: a condition on it, such as
    ``drop_unknown_team``, then tests the finished column. Otherwise the optimizer
    would write the whole rule into the filter too, and run it twice a row.
    """
    team = labels.team(F.col("project"), F.col("title"), F.col("body"))
    return df.withColumn("team", F.explode(F.array(team)))


def clean_texts(df: DataFrame, max_words: int = v.BODY_WORDS) -> DataFrame:
    """Clean title and body; only the body is cut to ``max_words``."""
    body = F.col("body")
    return df.withColumns({"title": tx.clean_text(F.col("title")), "body": tx.clean_truncated(body, max_words)})


def keep_processed(df: DataFrame) -> DataFrame:
    """The processed columns that are there, and the report key."""
    wanted = [*v.PROCESSED_COLUMNS, "report_key"]
    return df.select(*[c for c in wanted if c in df.columns])


def label_reports(
    unified: DataFrame,
    max_words: int = v.BODY_WORDS,
    bugzilla: str = v.BUGZILLA,
    tracker: str = v.TRACKER,
) -> DataFrame:
    """Priority, then team, then clean text, then the processed columns."""
    return (
        unified.transform(normalise_priority, bugzilla, tracker)
        .transform(assign_team)
        .transform(clean_texts, max_words)
        .transform(keep_processed)
    )


def drop_unknown_team(df: DataFrame, watch: Observation | None = None) -> DataFrame:
    """Keep reports with a team. ``watch`` receives ``reports`` and ``dropped``
    once the result has been computed, without a pass of its own."""
    known = F.col("team") != v.UNKNOWN_TEAM
    if watch is not None:
        df = df.observe(
            watch, F.count(F.lit(1)).alias("reports"), F.count_if(~known).alias("dropped")
        )
    return df.where(known)


def require_priority(df: DataFrame) -> DataFrame:
    """Fail the job on the first row without a priority."""
    checked = F.coalesce(F.col("priority"), F.raise_error(F.lit("report without a priority")).cast("string"))
    return df.withColumn("priority", checked)


def flag_over_escalation(df: DataFrame, days: float = v.OVER_ESCALATION_DAYS) -> DataFrame:
    """Add the strict priority, the cleaned resolution, the fractional duration,
    the three conditions and their conjunction ``is_over_escalated``."""
    return (
        df.withColumns(
            {
                "priority_mapped": labels.strict_priority(F.col("priority")),
                "resolution_clean": labels.clean_resolution(F.col("resolution")),
                "elapsed_days": times.elapsed_days(F.col("created_at"), F.col("closed_at")),
            }
        )
        .withColumns(
            {
                "is_top_priority": labels.is_top_priority(F.col("priority_mapped")),
                "is_non_fix": labels.is_non_fix(F.col("resolution_clean")),
                "is_slow": labels.is_slow(F.col("elapsed_days"), days),
            }
        )
        .withColumn(
            "is_over_escalated", F.col("is_top_priority") & F.col("is_non_fix") & F.col("is_slow")
        )
    )


def over_escalated_rows(df: DataFrame, limit: int = 50, order_by: str = "id") -> DataFrame:
    """The first over-escalated reports, for reading."""
    return (
        df.where("is_over_escalated")
        .orderBy(order_by)
        .select(
            order_by, "priority", "priority_mapped", "resolution", "resolution_clean",
            "created_at", "closed_at", "body",
        )
        .limit(limit)
    )
