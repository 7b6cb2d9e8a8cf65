"""Priority, team and over-escalation labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import text as tx

# Names in order of precedence, each with its keywords in lower case.
Rules = list[tuple[str, list[str]]]


def lookup(table: dict[str, str], key: Column, default: str | None = None) -> Column:
    """Value of ``key`` in a literal table; ``default`` (or null) on a miss."""
    literal = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    found = F.try_element_at(literal, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def severity_priority(severity: Column) -> Column:
    return lookup(v.SEVERITY_TO_PRIORITY, severity, v.DEFAULT_PRIORITY)


def tracker_priority(priority: Column) -> Column:
    """Case-insensitive but not trimmed, so padded values take the default."""
    upper = {spelling.upper(): level for spelling, level in v.TRACKER_TO_PRIORITY.items()}
    return lookup(upper, F.upper(priority), v.DEFAULT_PRIORITY)


def priority(
    source: Column,
    severity: Column,
    raw_priority: Column,
    bugzilla: str = v.BUGZILLA,
    tracker: str = v.TRACKER,
) -> Column:
    """Normalised priority by source; sources without a rule take the default."""
    return (
        F.when(source == bugzilla, severity_priority(severity))
        .when(source == tracker, tracker_priority(raw_priority))
        .otherwise(F.lit(v.DEFAULT_PRIORITY))
    )


def strict_priority(raw: Column) -> Column:
    """Trimmed, case-sensitive mapping; null where the spelling is not known."""
    return lookup(v.TRACKER_TO_PRIORITY, tx.strip(raw))


def whole_words(text: Column) -> Column:
    """The words of a text without regard to case: runs of letters, digits and underscores."""
    letters = "".join(v.FOLDED_LETTERS), "".join(v.FOLDED_LETTERS.values())
    folded = tx.where_marked(text, list(v.FOLDED_LETTERS), lambda name: F.translate(name, *letters))
    return F.split(F.lower(folded), f"[^{v.WORD_CLASS}]++")


def keywords_in(text: Column, *rule_sets: Rules) -> Column:
    """The distinct keywords of some rules that occur in a text as whole words.

    The text is cut into words once, whatever the number of rules; each word costs one
    look-up in a hash set.
    """
    listed = dict.fromkeys(word for rules in rule_sets for _, words in rules for word in words)
    return F.array_intersect(whole_words(text), F.array(*map(F.lit, listed)))


def first_rule(found: Column, rules: Rules, default: str) -> Column:
    """Name of the first rule that has one of the keywords found."""
    ranks = {word: str(rank) for rank, (_, words) in reversed(list(enumerate(rules))) for word in words}
    best = F.array_min(F.transform(found, lambda word: lookup(ranks, word).cast("int")))
    return F.coalesce(F.get(F.array(*[F.lit(name) for name, _ in rules]), best), F.lit(default))


def team(project: Column, title: Column, body: Column) -> Column:
    """First team, in rule order, one of whose keywords occurs in the report.

    Looks at the project, the title and the start of the *uncleaned* body.
    """
    haystack = F.concat_ws(" ", project, title, F.left(body, F.lit(v.TEAM_BODY_CHARS)))
    return first_rule(keywords_in(haystack, v.TEAM_KEYWORDS), v.TEAM_KEYWORDS, v.UNKNOWN_TEAM)


def clean_resolution(resolution: Column) -> Column:
    return F.upper(tx.strip(resolution))


def is_top_priority(level: Column) -> Column:
    return F.coalesce(level.isin(v.TOP_PRIORITIES), F.lit(False))


def is_non_fix(cleaned_resolution: Column) -> Column:
    return F.coalesce(cleaned_resolution.isin(v.NON_FIX_RESOLUTIONS), F.lit(False))


def is_slow(days: Column, threshold: float = v.OVER_ESCALATION_DAYS) -> Column:
    return F.coalesce(days > threshold, F.lit(False))
