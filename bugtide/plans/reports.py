"""Named sets of profile and audit tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import DataFrame

from bugtide import vocabulary as v
from bugtide.operators import labelling, profile, split, tokens, unify
from bugtide.storage import written


def profile_dataset(splits: DataFrame) -> dict[str, DataFrame]:
    """Size, distributions, lengths, histograms and duplicates of stored splits; runs jobs when called."""
    return {name: table() for name, table in profile_tables(splits).items()}


def profile_tables(splits: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """The same tables, each made when it is asked for.

    Tables of counts are added up from one count of all labels, for which no text is read.
    Durations, word counts and the digests of rows are stored once each where a table needs
    them. The splits are read again for the text of repeated rows.
    """
    content = splits.drop("split")
    flags = [c for c in ("is_over_escalated",) if c in splits.columns]
    labels = ["source", "priority", "team", "split", *flags]

    @cache
    def words() -> DataFrame:
        return written(profile.with_word_counts(splits).select("title_words", "body_words"))

    @cache
    def digests() -> DataFrame:
        return written(content.select(profile.row_digests(content)))

    @cache
    def counts() -> DataFrame:
        return written(profile.counted_by(splits, labels, "rows"))

    @cache
    def timed() -> DataFrame:
        return written(unify.with_valid_duration(splits.select("source", "resolution_time_days")))

    tables = {
        "shape": lambda: profile.shape(counts(), "rows", len(splits.columns)),
        "sources": lambda: profile.value_counts(counts(), "source", "rows"),
        "priorities": lambda: profile.domain_counts(counts(), weight="rows"),
        "priority_by_source": lambda: profile.count_pivot(counts(), "source", "priority", v.PRIORITIES, "rows"),
        "teams": lambda: profile.value_counts(counts(), "team", "rows"),
        "durations": lambda: profile.duration_summary(timed()),
        "word_counts": lambda: profile.word_count_summary(words()),
        "duplicates": lambda: profile.duplicate_summary(content, digests()),
        "duplicate_groups": lambda: profile.duplicate_groups(content, digests()),
        "splits": lambda: profile.split_report(counts(), "rows"),
    }
    for column, (cap, bins) in v.HISTOGRAMS.items():
        rows = timed if column == "resolution_time_days" else words
        tables[f"histogram_{column}"] = partial(_histogram, rows, column, cap, bins)
    if flags:
        domains = {"priority": v.PRIORITIES, "split": v.SPLITS}
        dimensions = ["source", "priority", "split"]
        tables["over_escalation"] = lambda: profile.rates_by_dimension(counts(), flags[0], dimensions, domains, "rows")
    return tables


def _histogram(rows: Callable[[], DataFrame], column: str, cap: float, bins: int) -> DataFrame:
    return profile.histogram(rows(), column, cap, bins)


def audit_labels(labelled: DataFrame, bugzilla: str = v.BUGZILLA) -> dict[str, DataFrame]:
    """Checks of the derived labels. Coverage means something only on a table
    from which reports without a team have not been dropped."""
    of_bugzilla = unify.of_source(labelled, bugzilla)
    spot = split.seeded_sample(labelled, v.SPOT_CHECK_ROWS)
    return {
        "severity_crosstab": profile.count_pivot(of_bugzilla, "raw_severity", "priority", v.PRIORITIES),
        "severity_mapping": profile.mapping_check(of_bugzilla),
        "teams": profile.value_counts(labelled, "team"),
        "team_coverage": profile.team_coverage(labelled),
        "spot_check": spot,
        "hedging": profile.phrase_counts(unify.top_priority(of_bugzilla)),
        "priority_distribution": profile.distribution_by(labelled, "priority", domain=v.PRIORITIES),
        "team_distribution": profile.distribution_by(
            labelled, "team", domain=[*v.TEAMS, v.UNKNOWN_TEAM]
        ),
        "checks": profile.quality_checks(labelled),
    }


def over_escalation(reports: DataFrame) -> dict[str, DataFrame]:
    """Flag counts and the flagged reports of a canonical tracker table."""
    flagged = labelling.flag_over_escalation(reports)
    flags = ["is_top_priority", "is_non_fix", "is_slow", "is_over_escalated"]
    return {
        "counts": profile.flag_counts(flagged, flags),
        "rows": labelling.over_escalated_rows(flagged),
    }


def sample_prompts(splits: DataFrame, n: int = 3) -> DataFrame:
    """Prompt, expected answer and both together for ``n`` reports per split."""
    drawn = split.sample_per_group(splits, ["split"], n)
    return tokens.with_prompt_text(drawn).select("split", "report_key", "prompt", "completion", "full_text")


def escalation_pairs(flagged: DataFrame, group: str = "project", n: int = 3, key: str = "id") -> DataFrame:
    """Up to ``n`` over-escalated and ``n`` other reports of each group, side by side."""
    return split.sample_per_group(flagged, [group, "is_over_escalated"], n, key)
