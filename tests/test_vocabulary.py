"""Every entry of the tables, with the result it must have, written out."""

import pytest
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import labels
from bugtide.operators import labelling, profile

SEVERITIES = [
    ("blocker", "P0"),
    ("critical", "P1"),
    ("major", "P2"),
    ("normal", "P3"),
    ("minor", "P4"),
    ("trivial", "P4"),
]
SPELLINGS = [
    ("High", "P1"),
    ("Normal", "P3"),
    ("Low", "P4"),
    ("Urgent", "P0"),
    ("P1", "P0"),
    ("P2", "P1"),
    ("P3", "P2"),
    ("P4", "P3"),
    ("P5", "P4"),
    ("Blocker", "P0"),
    ("Critical", "P1"),
    ("Major", "P2"),
    ("Minor", "P3"),
    ("Trivial", "P4"),
]
# Fixed values, as they are.
KEYWORDS = {
    "security": [
        "security", "auth", "ssl", "tls", "crypto", "certificate", "permission", "oauth", "saml", "jwt",
        "encryption",
    ],
    "database": [
        "database", "db", "sql", "mysql", "postgres", "sqlite", "oracle", "mongo", "jdbc", "orm", "hibernate",
        "derby", "h2",
    ],
    "mobile": [
        "android", "ios", "iphone", "ipad", "mobile", "tablet", "swift", "kotlin",
    ],
    "frontend": [
        "ui", "gui", "frontend", "interface", "widget", "dialog", "window", "css", "html", "browser", "editor",
        "view", "swt", "birt", "rendering", "firefox", "thunderbird", "display", "layout",
    ],
    "infra": [
        "infra", "infrastructure", "deploy", "docker", "kubernetes", "k8s", "ci", "cd", "pipeline", "devops",
        "monitoring", "logging", "tomcat", "server", "maven", "gradle", "ant", "build", "jenkins", "slurm",
    ],
    "platform": [
        "platform", "core", "runtime", "jvm", "jdk", "classpath", "aspectj", "eclipse_platform", "equinox",
    ],
    "backend": [
        "api", "backend", "service", "rest", "endpoint", "handler", "controller", "jdt", "cdt", "compiler",
        "parser", "refactor",
    ],
}
RESOLUTIONS = [
    "WON'T FIX", "WONTFIX", "WON'T DO", "NOT A PROBLEM", "CANNOT REPRODUCE", "INVALID", "NOT A BUG",
    "WORKS FOR ME", "WORKSFORME", "INCOMPLETE", "ABANDONED", "MOVED", "INACTIVE", "AUTO CLOSED",
    "PENDING CLOSED",
]
PHRASES = [
    "sometimes", "occasionally", "intermittent", "might", "maybe", "appears to", "seems", "randomly", "flaky",
    "not reproducible", "not always", "sporadically", "unclear", "not sure", "possibly", "perhaps",
]


def column_of(spark, cases):
    return spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x string").orderBy("i")


def test_each_severity(spark):
    found = column_of(spark, [a for a, _ in SEVERITIES]).select(labels.severity_priority(F.col("x"))).collect()
    assert [r[0] for r in found] == [b for _, b in SEVERITIES] and len(v.SEVERITY_TO_PRIORITY) == len(SEVERITIES)


def test_each_spelling(spark):
    rows = column_of(spark, [a for a, _ in SPELLINGS])
    both = rows.select(labels.strict_priority(F.col("x")), labels.tracker_priority(F.upper("x"))).collect()
    assert [tuple(r) for r in both] == [(b, b) for _, b in SPELLINGS] and len(v.TRACKER_TO_PRIORITY) == len(SPELLINGS)


@pytest.mark.parametrize("team", list(KEYWORDS))
def test_each_keyword(spark, team):
    words = KEYWORDS[team]
    found = column_of(spark, words).select(labels.team(F.lit("p"), F.concat(F.lit("an "), "x"), F.lit("b"))).collect()
    assert [r[0] for r in found] == [team] * len(words)
    assert dict(v.TEAM_KEYWORDS)[team] == words


def test_each_resolution(spark):
    rows = column_of(spark, [*map(str.lower, RESOLUTIONS), "duplicate", "fixed"]).select(
        "i", F.col("x").alias("resolution"), F.lit("High").alias("priority"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("closed_at"),
    )
    found = labelling.flag_over_escalation(rows).orderBy("i").collect()
    assert [r.is_non_fix for r in found] == [True] * len(RESOLUTIONS) + [False, False]
    assert len(v.NON_FIX_RESOLUTIONS) == len(RESOLUTIONS)


def test_each_phrase(spark):
    rows = column_of(spark, PHRASES).select(F.col("x").alias("title"), F.lit("").alias("body"))
    found = {r.phrase: r.reports for r in profile.phrase_counts(rows).collect()}
    assert found == dict.fromkeys(PHRASES, 1)
