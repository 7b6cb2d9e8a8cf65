import datetime as dt
import itertools
import random

import pytest
from helpers import apply, plan_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import labels
from bugtide.operators import labelling, scoring


def test_severity_priority(spark):
    cases = {"blocker": "P0", "minor": "P4", "trivial": "P4", "enhancement": "P3", "": "P3", None: "P3", "Blocker": "P3"}
    assert apply(spark, list(cases), labels.severity_priority) == list(cases.values())


def test_tracker_priority_ignores_case_but_not_blanks(spark):
    cases = {"HIGH": "P1", "high": "P1", " HIGH": "P3", "P1": "P0", "MINOR": "P3", "--": "P3", None: "P3"}
    assert apply(spark, list(cases), labels.tracker_priority) == list(cases.values())


def test_strict_priority_ignores_blanks_but_not_case(spark):
    cases = {" High ": "P1", "high": None, "P5": "P4", "--": None, None: None}
    assert apply(spark, list(cases), labels.strict_priority) == list(cases.values())


def test_priority_depends_on_source(spark):
    rows = [("bugzilla", "minor", "P1"), ("tracker", "minor", "P1"), ("elsewhere", "blocker", "P1"), (None, "", "")]
    df = spark.createDataFrame(rows, "source string, raw_severity string, raw_priority string")
    found = [r.priority for r in df.transform(labelling.normalise_priority).collect()]
    assert found == ["P4", "P0", "P3", "P3"]


def test_missing_priority_fails_the_job(spark):
    df = spark.createDataFrame([("a", None)], "id string, priority string")
    with pytest.raises(Exception, match="without a priority"):
        labelling.require_priority(df).collect()


@pytest.mark.parametrize(
    ("project", "title", "body", "team"),
    [
        ("", "Login broken with SSL", "", "security"),
        ("Tomcat", "jdbc pool", "", "database"),
        ("Derby", "permission denied", "", "security"),
        ("", "mysql8 fails", "web_ui", "unknown"),
        ("", "eclipse_platform crash", "", "platform"),
        ("", "Eclipse Platform crash", "", "platform"),
        ("", "eclipse-platform crash", "", "platform"),
        ("", "eclipse crash", "", "unknown"),
        ("", "the naïve réui", "", "unknown"),
        ("", "uié", "", "unknown"),
        ("", "(ui)", "", "frontend"),
        ("", "UI\u0307", "", "frontend"),
        ("", "\u017fecurity", "", "security"),
        ("", "\u212a8s", "", "infra"),
        ("", "ui2", "", "unknown"),
        ("", "d\u00b2 db\u00b2", "", "unknown"),
        ("C++ui#x", "", "", "frontend"),
        ("", "x", "a" * 197 + " ui", "frontend"),
        ("", "x", "a" * 198 + " ui", "unknown"),
        ("", "x", "a" * 200 + " ui", "unknown"),
        ("REST", "", "", "backend"),
        # A letter beyond 16 bits is part of a word like others.
        ("", "\U0001d518ui", "", "unknown"),
        ("", "\U0001f642ui", "", "frontend"),
        ("", "", "", "unknown"),
    ],
)
def test_team_rules(spark, project, title, body, team):
    df = spark.createDataFrame([(project, title, body)], "project string, title string, body string")
    assert df.transform(labelling.assign_team).first().team == team


def test_words_equal_a_case_insensitive_pattern(spark):
    """The word index against the pattern of each keyword, on texts of all sorts of letters."""
    rng = random.Random(4)
    keywords = [w for _, listed in v.TEAM_KEYWORDS for w in listed]
    odd = ["\u0130", "\u0131", "\u017f", "\u212a", "\u0307", "\u00e9", "\u00b2", "_", "-", " ", "\n", ".", "2", "\u00df", "\u2163"]
    texts = []
    for _ in range(400):
        parts = [rng.choice([w, w.upper(), w.title()]) if rng.random() < 0.4 else rng.choice(odd) for w in rng.choices(keywords, k=8)]
        text = "".join(parts)
        for plain, other in (("i", "\u0130"), ("I", "\u0131"), ("s", "\u017f"), ("k", "\u212a")):
            text = text.replace(plain, other) if rng.random() < 0.1 else text
        texts.append(text)

    def by_pattern(column):
        case = F.lit(v.UNKNOWN_TEAM)
        for team, listed in reversed(v.TEAM_KEYWORDS):
            pattern = rf"(?iu)(?<![{v.WORD_CLASS}])(?:{'|'.join(listed)})(?![{v.WORD_CLASS}])"
            case = F.when(column.rlike(pattern), team).otherwise(case)
        return case

    def by_words(column):
        return labels.first_rule(labels.keywords_in(column, v.TEAM_KEYWORDS), v.TEAM_KEYWORDS, v.UNKNOWN_TEAM)

    found = apply(spark, texts, by_pattern, by_words)
    assert [a for a, _ in found] == [b for _, b in found]
    assert len({a for a, _ in found}) == len(v.TEAM_KEYWORDS) + 1


def test_the_rule_stands_once_in_a_plan(spark):
    df = spark.createDataFrame(
        [("1", "tracker", "t ui", "x", "", "P1", "fixed", "", None)],
        "id string, source string, title string, body string, raw_severity string, raw_priority string, "
        "resolution string, project string, resolution_time_days double",
    )
    kept = labelling.drop_unknown_team(labelling.label_reports(df))
    assert kept.first().team == "frontend"
    plan = plan_of(kept)
    assert plan.count("array_intersect") == 1 and plan.count("rlike") == plan.count("RLIKE") == 0
    scored = scoring.score_reports(kept).select("raw_output")
    assert plan_of(scored).count("array_intersect") == 2


def test_every_keyword_reaches_a_team_no_later_than_its_own(spark):
    order = [team for team, _ in v.TEAM_KEYWORDS]
    words = [(word, team) for team, listed in v.TEAM_KEYWORDS for word in listed]
    found = apply(spark, [w.upper() for w, _ in words], lambda c: labels.team(F.lit("p"), c, F.lit("b")))
    assert [order.index(a) <= order.index(t) for a, (_, t) in zip(found, words)] == [True] * len(words)
    assert set(found) == set(order)


def test_team_is_found_before_text_is_cleaned(spark):
    df = spark.createDataFrame(
        [("1", "tracker", "<ui>", "x", "", "P1", "fixed", "", None)],
        "id string, source string, title string, body string, raw_severity string, raw_priority string, "
        "resolution string, project string, resolution_time_days double",
    )
    row = labelling.label_reports(df).first()
    assert (row.team, row.title, row.priority) == ("frontend", "", "P0")
    assert labelling.label_reports(df).columns == v.PROCESSED_COLUMNS


def test_over_escalation_flag_equals_the_rule_row_by_row(spark):
    day = dt.datetime(2024, 3, 1)
    priorities = ["High", " Urgent ", "Low", "high", None]
    resolutions = ["Won't Fix", " invalid ", "Fixed", "Duplicate", None]
    closings = [day + dt.timedelta(days=7), day + dt.timedelta(days=7, microseconds=1), day - dt.timedelta(days=9), None]
    rows = [(p, r, day, c) for p, r, c in itertools.product(priorities, resolutions, closings)]
    df = spark.createDataFrame(
        rows, "priority string, resolution string, created_at timestamp_ntz, closed_at timestamp_ntz"
    )

    def expected(p, r, opened, closed):
        urgent = v.TRACKER_TO_PRIORITY.get((p or "").strip()) in ("P0", "P1")
        return urgent and (r or "").strip().upper() in v.NON_FIX_RESOLUTIONS and bool(
            closed and closed - opened > dt.timedelta(days=7)
        )

    found = labelling.flag_over_escalation(df).collect()
    assert [r.is_over_escalated for r in found] == [expected(*r[:4]) for r in found]
    assert sum(r.is_over_escalated for r in found) == 4


def test_dropped_reports_are_counted_on_the_way(spark):
    df = spark.createDataFrame([("infra",), ("unknown",), ("unknown",)], "team string")
    watch = Observation("drop")
    assert labelling.drop_unknown_team(df, watch).count() == 1
    assert watch.get == {"reports": 3, "dropped": 2}
