"""Plain SQL statements of the registered queries, for an independent engine.

They are written from the rules, not from the Spark code: windows and unbounded
pattern repeats are fine here, because this side only checks small tables. The fixed values
come from the same module as the code's; ``tests/test_vocabulary.py`` states each of them anew.
"""

from __future__ import annotations

from bugtide import vocabulary as v

ORACLE: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str | None]) -> str:
    return "[" + ", ".join("NULL" if x is None else _text(x) for x in values) + "]"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(_text(x) for x in values) + ")"


def _by_remainder(k: str, values: list[str | None]) -> str:
    return f"({_list(values)})[({k} % {len(values)}) + 1]"


def _lookup(key: str, table: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {_text(a)} THEN {_text(b)}" for a, b in table.items()) + " END"


# --- rules -------------------------------------------------------------------

NL = "chr(10)"
SPACE = v.SPACE_CLASS
WORD = rf"[^{SPACE}]+"
# A frame in the plain form of the rule; the driver's tables hold ASCII frames.
FRAME = r"\s*at\s+[\w.$]+\([\w.]+:\d+\)[\r\n]+"


def strip(x: str) -> str:
    return f"trim({x}, {_text(v.WHITESPACE)})"


def replace_all(x: str, pattern: str, new: str) -> str:
    return f"regexp_replace({x}, {_text(pattern)}, {new}, 'g')"


def shorten(x: str) -> str:
    return replace_all(x, f"((?:{FRAME}){{10}})(?:{FRAME})*", r"'\1'")


def clean(x: str) -> str:
    x = replace_all(x, v.HTML_TAG, "' '")
    x = replace_all(x, v.ENTITY, "' '")
    x = f"replace(replace({x}, chr(13) || {NL}, {NL}), chr(13), {NL})"
    x = shorten(x)
    x = replace_all(x, v.SPACES, "' '")
    x = replace_all(x, v.BLANK_LINES, f"{NL} || {NL}")
    return f"coalesce({strip(x)}, '')"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, {_text(WORD)})"


def count_words(x: str) -> str:
    return f"CAST(len({words(x)}) AS BIGINT)"


def truncate(x: str, limit: int = v.BODY_WORDS) -> str:
    return (
        f"CASE WHEN len({words(x)}) <= {limit} THEN {x} "
        f"ELSE array_to_string(list_slice({words(x)}, 1, {limit}), ' ') END"
    )


def team_of(text: str) -> str:
    outside = rf"[^{v.WORD_CLASS}]"
    rules = [
        f"WHEN regexp_matches({text}, "
        + _text(rf"(?i)(^|{outside})({'|'.join(words)})({outside}|$)")
        + f") THEN {_text(team)}"
        for team, words in v.TEAM_KEYWORDS
    ]
    return "CASE " + " ".join(rules) + f" ELSE {_text(v.UNKNOWN_TEAM)} END"


UPPER_TRACKER = {spelling.upper(): level for spelling, level in v.TRACKER_TO_PRIORITY.items()}


def whole_days(a: str, b: str) -> str:
    return f"floor((epoch_us({b}) - epoch_us({a})) / 86400000000.0)::DOUBLE"


def measured(x: str) -> str:
    return f"coalesce(length({x}) || ':' || {x}, '-')"


def report_key(source, project, issue, title, body) -> str:
    name = f"coalesce({issue}, 'text:' || md5({measured(title)} || {measured(body)}))"
    return f"sha256({measured(source)} || {measured(project)} || {measured(name)})"


def prompt(title: str, body: str) -> str:
    text = strip(f"coalesce({body}, '')")
    return (
        f"{_text(v.PROMPT_HEAD)} || {strip(title)} || {NL} || "
        f"CASE WHEN {text} = '' THEN '' ELSE {NL} || {text} END || {_text(v.PROMPT_TAIL)}"
    )


def completion(priority: str, team: str) -> str:
    return f"{_text(v.COMPLETION_SEVERITY)} || {priority} || {_text(v.COMPLETION_TEAM)} || {team}"


# --- inputs ------------------------------------------------------------------

TRACKER_RAW = f"""
tracker_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS k,
    left(text, 60) AS title,
    CASE WHEN o_orderkey % 11 <> 0 THEN text END AS body,
    CASE WHEN o_orderkey % 4 = 0 THEN substr(o_orderpriority, instr(o_orderpriority, '-') + 1)
         WHEN o_orderkey % 4 = 1 THEN 'P' || (o_orderkey % 5 + 1)
         WHEN o_orderkey % 4 = 2
           THEN {_by_remainder("o_orderkey", ["Blocker", "Critical", "Major", "Minor", "Trivial"])}
         WHEN o_orderkey % 12 = 3 THEN '--'
         WHEN o_orderkey % 12 = 11 THEN ' High ' END AS priority,
    {_by_remainder("o_orderkey", ["Fixed", "Won't Fix", "WORKSFORME", "Invalid", "Duplicate", None,
                                  " incomplete "])} AS resolution,
    o_orderdate + to_seconds(o_orderkey % 86400) AS created_at,
    CASE WHEN o_orderstatus <> 'P' THEN shipped END AS closed_at,
    {_by_remainder("o_orderkey", ["Security", "Derby", "iOS", "Thunderbird", "Tomcat", "Equinox", "jdt",
                                  "Misc", None])} AS project
  FROM orders
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey)
    ON l_orderkey = o_orderkey
  LEFT JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)
)"""

SEVERITIES = ["Blocker", "critical", "MAJOR", "normal", "minor", "trivial", "enhancement", None]


def bugzilla_raw(endings: list[str]) -> str:
    return f"""
bugzilla_raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS project,
    {_by_remainder("p_partkey", SEVERITIES)} AS severity,
    {_by_remainder("p_partkey", [None, "FIXED"])} AS resolution,
    p_name || {_by_remainder("p_partkey", endings)} AS title
  FROM part
)"""


BUGZILLA_RAW = bugzilla_raw([" dialog", " jdbc", " build", " sometimes", ""])

BUGZILLA = """
bugzilla AS (
  SELECT id, 'bugzilla' AS source, coalesce(title, '') AS title, '' AS body,
    coalesce(lower(severity), '') AS raw_severity, '' AS raw_priority,
    coalesce(lower(resolution), 'fixed') AS resolution, coalesce(project, '') AS project,
    CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS closed_at,
    CAST(NULL AS DOUBLE) AS resolution_time_days
  FROM bugzilla_raw
)"""

UNIFIED = f"""{TRACKER_RAW}, {BUGZILLA_RAW}, {BUGZILLA},
unkeyed AS (
  SELECT id, 'tracker' AS source, coalesce(title, '') AS title, coalesce(body, '') AS body,
    '' AS raw_severity, upper(coalesce(priority, '')) AS raw_priority,
    lower(coalesce(resolution, '')) AS resolution, coalesce(project, '') AS project,
    created_at, closed_at, {whole_days("created_at", "closed_at")} AS resolution_time_days
  FROM tracker_raw
  UNION ALL SELECT * FROM bugzilla
),
unified AS (
  SELECT *, {report_key("source", "project", "id", "title", "body")} AS report_key FROM unkeyed
)"""

PRIORITY = f"""CASE WHEN source = 'bugzilla' THEN coalesce({_lookup("raw_severity", v.SEVERITY_TO_PRIORITY)}, 'P3')
    WHEN source = 'tracker' THEN coalesce({_lookup("upper(raw_priority)", UPPER_TRACKER)}, 'P3')
    ELSE 'P3' END"""
TEAM = team_of(f"project || ' ' || title || ' ' || left(body, {v.TEAM_BODY_CHARS})")


def label(unified: str) -> str:
    return f"""
cleaned AS (
  SELECT * REPLACE ({clean("title")} AS title, {clean("body")} AS body),
    {PRIORITY} AS priority, {TEAM} AS team
  FROM {unified}
),
labelled AS (
  SELECT id, source, title, {truncate("body")} AS body, priority, team, raw_severity, resolution,
    resolution_time_days, report_key
  FROM cleaned
)"""


LABELLED = f"{UNIFIED}, {label('unified')}"
WITH_TEAM = f"{LABELLED}, truth AS (SELECT * FROM labelled WHERE team <> 'unknown')"
# The label columns alone, for queries that need no text.
TRUTH_LABELS = f"""{UNIFIED},
truth AS (SELECT * FROM (SELECT id, source, report_key, {PRIORITY} AS priority, {TEAM} AS team FROM unified)
          WHERE team <> 'unknown')"""
TRUTH_RAW = f"""{UNIFIED},
truth AS (SELECT * FROM (SELECT *, {PRIORITY} AS priority, {TEAM} AS team FROM unified) WHERE team <> 'unknown')"""
ANY_TEAM = f"""{UNIFIED},
labels_only AS (SELECT id, source, report_key, {PRIORITY} AS priority, {TEAM} AS team FROM unified)"""

SCHEMA_UNIFIED = ", ".join([*v.UNIFIED_COLUMNS, "report_key"])

OUTPUTS = f"""
outputs AS (
  SELECT report_key, CASE
    WHEN k <= 5 THEN {completion("priority", "team")}
    WHEN k = 6 THEN {completion("'P' || ((CAST(substr(priority, 2, 1) AS INTEGER) + 1) % 5)", "team")}
    WHEN k = 7 THEN {completion("priority", "'payments'")}
    WHEN k = 8 THEN 'severity:P9 | team:infra'
    WHEN k = 9 THEN 'Answer: SEVERITY : ' || priority || ' |  TEAM :  ' || upper(team) || ' ok'
    WHEN k = 10 THEN 'junk' END AS raw_output
  FROM (SELECT *, CAST(id AS BIGINT) % 12 AS k FROM truth)
)"""
ANSWER = r"(?i)severity\s*:\s*(P[0-4])\s*\|\s*team\s*:\s*(\w+)"


def parsed(table: str, column: str = "raw_output") -> str:
    found = f"lower(regexp_extract({column}, {_text(ANSWER)}, 2))"
    return f"""(SELECT *, nullif(upper(regexp_extract({column}, {_text(ANSWER)}, 1)), '') AS pred_severity,
      CASE WHEN {found} IN {_in(v.TEAMS)} THEN {found} END AS pred_team FROM {table})"""


JOINED = f"""{TRUTH_LABELS}, {OUTPUTS},
joined AS (
  SELECT priority, team, pred_severity, pred_team FROM truth JOIN {parsed("outputs")} USING (report_key)
)"""
DOMAIN = f"domain AS (SELECT unnest({_list(v.PRIORITIES)}) AS p)"


def f1_rows(joined: str) -> str:
    return f"""f1 AS (
  SELECT p AS severity, support, predicted,
    CASE WHEN support + predicted = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * hits / (support + predicted) END AS score
  FROM (SELECT p,
      (SELECT count(*) FROM {joined} WHERE priority = p) AS support,
      (SELECT count(*) FROM {joined} WHERE pred_severity = p) AS predicted,
      (SELECT count(*) FROM {joined} WHERE priority = p AND pred_severity = p) AS hits
    FROM domain)
)"""


F1 = f1_rows("joined")
ROUNDED_F1 = "SELECT severity, round(score, 4) AS f1, support, predicted FROM f1"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


# --- unify and label ---------------------------------------------------------

ORACLE["unify_sources"] = with_(UNIFIED, f"SELECT {SCHEMA_UNIFIED} FROM unified")

_STATUS = _by_remainder("event_id", ["Resolved Fixed", "Resolved WontFix", "Closed WontFix", None])
ORACLE["unify_timestamped"] = f"""
WITH rows AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'timestamped' AS source, coalesce(event_type, '') AS title,
    coalesce(props, '') AS body, '' AS raw_severity, '' AS raw_priority,
    coalesce(lower({_STATUS}), '') AS resolution, coalesce(event_type, '') AS project,
    CASE WHEN event_id % 50 <> 0 THEN ts END AS created_at,
    CASE WHEN event_id % 40 <> 0 THEN TIMESTAMP '1970-01-01 00:00:00'
      + to_seconds(CAST(floor(epoch(ts)) + floor(value * 86400) AS BIGINT)) END AS closed_at
  FROM events
)
SELECT *, {whole_days("created_at", "closed_at")} AS resolution_time_days,
  {report_key("source", "project", "id", "title", "body")} AS report_key FROM rows"""

ORACLE["rename_and_drop"] = with_(
    TRACKER_RAW,
    "SELECT id, title, body, priority, resolution, created_at, closed_at, project FROM tracker_raw",
)
ORACLE["missing_values"] = with_(
    TRACKER_RAW,
    f"""SELECT id, priority, CASE WHEN r NOT IN {_in(v.NA_TOKENS)} THEN r END AS resolution
  FROM (SELECT id, priority, coalesce(resolution,
    {_by_remainder("k", ["NaN", "N/A", "", "null", "none"])}) AS r FROM tracker_raw)""",
)
ORACLE["priority_normalise"] = with_(
    UNIFIED,
    f"SELECT report_key, source, raw_severity, raw_priority, {PRIORITY} AS priority FROM unified",
)
ORACLE["priority_strict"] = with_(
    TRACKER_RAW,
    f"SELECT id, {_lookup('trim(priority)', v.TRACKER_TO_PRIORITY)} AS priority_mapped FROM tracker_raw",
)
ORACLE["team_assign"] = with_(UNIFIED, f"SELECT report_key, source, project, {TEAM} AS team FROM unified")
ORACLE["team_of_documents"] = (
    f"SELECT doc_id, {team_of(chr(39) * 2 + ' || text || ' + _text(' ') + ' || left(text, 200)')} AS team FROM documents"
)
ORACLE["label_engineering"] = with_(LABELLED, "SELECT * FROM labelled")

# --- tracker folders ---------------------------------------------------------


def _present(x: str) -> str:
    return f"CASE WHEN {x} NOT IN {_in(v.NA_TOKENS)} THEN {x} END"


# A list names its report, the next one (of another project) and the ninth (of its own).
FOLDERS = f"""{TRACKER_RAW},
exported AS (
  SELECT id, {_present("title")} AS title, {_present("body")} AS body, {_present("priority")} AS priority,
    {_present("resolution")} AS resolution, CAST(created_at AS VARCHAR) AS created_at,
    CAST(closed_at AS VARCHAR) AS closed_at, coalesce(project, 'Misc') AS project FROM tracker_raw
),
listed AS (
  SELECT DISTINCT coalesce(project, 'Misc') AS project, CAST(k + d AS VARCHAR) AS id
  FROM tracker_raw, (VALUES (0), (1), (9)) AS step(d) WHERE k % 10 = 0
),
cleaned AS (SELECT * FROM exported WHERE (project, id) NOT IN (SELECT (project, id) FROM listed))"""
ORACLE["ingest_cleaned"] = with_(FOLDERS, "SELECT *, 'Closed' AS \"Status\", '1.0' AS versions FROM cleaned")
ORACLE["ingest_reports"] = with_(
    FOLDERS, "SELECT * FROM cleaned WHERE priority <> '--' AND resolution IS NOT NULL"
)
ORACLE["ingest_merged"] = with_(
    FOLDERS,
    "SELECT *, 'Closed' AS \"Status\", '1.0' AS versions FROM cleaned WHERE priority <> '--' AND resolution IS NOT NULL",
)
ORACLE["load_all_sources"] = f"""
SELECT {SCHEMA_UNIFIED} FROM ({ORACLE["unify_sources"]})
UNION ALL SELECT {SCHEMA_UNIFIED} FROM ({ORACLE["unify_timestamped"]})"""
ORACLE["load_required_source"] = f"SELECT * FROM ({ORACLE['unify_sources']}) WHERE source = 'bugzilla'"
ORACLE["ingest_statistics"] = with_(
    FOLDERS,
    """SELECT project, before_rows, after_rows, before_rows - after_rows AS removed_rows, listed_ids,
  CASE WHEN project IN ('Security', 'Derby', 'iOS', 'Thunderbird') THEN 'Issue id' ELSE 'ISSUE ID' END AS bug_id_column,
  'issue_id' AS issue_column, 'duplicate_ids' AS duplicate_column
  FROM (SELECT project, count(*) AS before_rows FROM exported GROUP BY project)
  JOIN (SELECT project, count(*) AS after_rows FROM cleaned GROUP BY project) USING (project)
  JOIN (SELECT project, count(*) AS listed_ids FROM listed GROUP BY project) USING (project)""",
)

ORACLE["ingest_rejected"] = f"""
WITH filed AS (
  SELECT {_by_remainder("o_orderkey", ["Security", "Derby", "iOS", "Tomcat"])} AS project, o_orderkey AS k,
    o_orderkey || ',"order, ' || o_orderkey || '",' || o_orderpriority || ',Fixed,2024-01-01,2024-01-02,' ||
      CASE WHEN o_orderkey IN (10, 11) THEN '"open' WHEN o_orderkey % 97 = 0 THEN 'b,one more' ELSE 'b' END AS record,
    o_orderkey IN (10, 11) OR o_orderkey % 97 = 0 AS bad
  FROM orders
)
SELECT project, 'bugs' AS kind, record, before_rows, rejected_records
FROM filed JOIN (SELECT project, count(*) FILTER (NOT bad) AS before_rows, count(*) FILTER (bad) AS rejected_records
                 FROM filed GROUP BY project) USING (project)
WHERE bad"""

# --- text --------------------------------------------------------------------

ORACLE["clean_html"] = f"""
WITH pages_cleaned AS (SELECT page_id, {clean("url")} AS url, {clean("html")} AS cleaned FROM pages)
SELECT page_id, url, cleaned, {truncate("cleaned")} AS body FROM pages_cleaned"""
ORACLE["stack_truncate"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, {shorten("'boom' || chr(10) || repeat('  at a.b.C.m(F.java:'"
    " || (o_orderkey % 97) || ')' || chr(10), o_orderkey % 25) || 'tail'")} AS body FROM orders"""
ORACLE["word_truncate"] = f"""
SELECT doc_id, {count_words("text")} AS words, {count_words("body")} AS kept_words, body
FROM (SELECT doc_id, text, {truncate("text")} AS body FROM documents)"""

# --- duplicates, filters, durations ------------------------------------------

_LISTED = """
listed AS (
  SELECT CAST(o_orderkey + d AS VARCHAR) AS id
  FROM orders, (VALUES (0), (1), (2)) AS step(d) WHERE o_orderkey % 10 = 0
)"""
ORACLE["dedup_subtract"] = with_(
    f"{TRACKER_RAW}, {_LISTED}",
    """SELECT id, title, body, priority, resolution, created_at, closed_at, project FROM tracker_raw
  WHERE id NOT IN (SELECT id FROM listed)""",
)
ORACLE["dedup_stats"] = with_(
    f"{TRACKER_RAW}, {_LISTED}",
    """SELECT count(*) AS before_rows, count(*) FILTER (id NOT IN (SELECT id FROM listed)) AS after_rows,
  count(*) FILTER (id IN (SELECT id FROM listed)) AS removed_rows,
  (SELECT count(DISTINCT id) FROM listed) AS listed_ids FROM tracker_raw""",
)
ORACLE["priority_filter"] = with_(
    TRACKER_RAW,
    """SELECT id, title, body, priority, resolution, created_at, closed_at, project FROM tracker_raw
  WHERE priority IS NOT NULL AND priority <> '--' AND resolution IS NOT NULL""",
)
_CLOSED = "FROM tracker_raw WHERE resolution IS NULL AND closed_at IS NOT NULL"
ORACLE["closed_without_resolution"] = with_(
    TRACKER_RAW, f"SELECT project, count(*) AS rows {_CLOSED} AND project IS NOT NULL GROUP BY project"
)
ORACLE["closed_without_resolution_rows"] = with_(
    TRACKER_RAW, f"SELECT id, project, closed_at {_CLOSED} AND project = 'Derby'"
)
ORACLE["resolution_days"] = with_(
    TRACKER_RAW,
    f"""SELECT id, (epoch_us(closed_at) - epoch_us(created_at)) / 86400000000.0::DOUBLE AS elapsed_days,
  {whole_days("created_at", "closed_at")} AS whole_days FROM tracker_raw""",
)
ORACLE["resolution_summary"] = with_(
    UNIFIED,
    """SELECT source, count(*) AS reports, median(resolution_time_days) AS median_days,
  min(resolution_time_days) AS min_days, max(resolution_time_days) AS max_days
  FROM unified WHERE resolution_time_days >= 0 GROUP BY source""",
)

# --- over-escalation ---------------------------------------------------------

FLAGGED = f"""{TRACKER_RAW},
conditions AS (
  SELECT *, {_lookup("trim(priority)", v.TRACKER_TO_PRIORITY)} AS priority_mapped,
    upper(trim(resolution)) AS resolution_clean FROM tracker_raw
),
flagged AS (
  SELECT *, coalesce(priority_mapped IN ('P0', 'P1'), false) AS is_top_priority,
    coalesce(resolution_clean IN {_in(v.NON_FIX_RESOLUTIONS)}, false) AS is_non_fix,
    coalesce(closed_at - created_at > INTERVAL 7 DAY, false) AS is_slow,
    coalesce(priority_mapped IN ('P0', 'P1'), false) AND coalesce(resolution_clean IN
      {_in(v.NON_FIX_RESOLUTIONS)}, false)
      AND coalesce(epoch_us(closed_at) - epoch_us(created_at) > 7 * 86400000000, false) AS is_over_escalated
  FROM conditions
)"""
ORACLE["over_escalation"] = with_(
    FLAGGED,
    """SELECT id, priority_mapped, resolution_clean, is_top_priority, is_non_fix, is_slow, is_over_escalated
  FROM flagged""",
)
ORACLE["over_escalated_rows"] = with_(
    FLAGGED,
    """SELECT id, priority, priority_mapped, resolution, resolution_clean, created_at, closed_at, body
  FROM flagged WHERE is_over_escalated ORDER BY id LIMIT 50""",
)
ORACLE["over_escalation_counts"] = with_(
    FLAGGED,
    """SELECT count(*) AS total, count(*) FILTER (is_top_priority) AS is_top_priority,
  count(*) FILTER (is_non_fix) AS is_non_fix, count(*) FILTER (is_slow) AS is_slow,
  count(*) FILTER (is_over_escalated) AS is_over_escalated FROM flagged""",
)
_RATE = """count(*) FILTER (is_over_escalated) AS positives, count(*) AS total,
  round(100.0::DOUBLE * count(*) FILTER (is_over_escalated) / count(*), 1) AS rate_pct"""
ORACLE["over_escalation_rates"] = with_(
    FLAGGED,
    f"""SELECT 'all' AS dimension, 'all' AS value, {_RATE} FROM flagged
  UNION ALL SELECT 'project', coalesce(project, ''), {_RATE} FROM flagged GROUP BY coalesce(project, '')
  UNION ALL SELECT 'priority', level, {_RATE}
  FROM (SELECT *, coalesce({_lookup("upper(priority)", UPPER_TRACKER)}, 'P3') AS level FROM flagged)
  GROUP BY level""",
)

ORACLE["escalation_pairs"] = with_(
    FLAGGED,
    """SELECT id, project, is_over_escalated, priority_mapped, resolution_clean,
    (epoch_us(closed_at) - epoch_us(created_at)) / 86400000000.0::DOUBLE AS elapsed_days
  FROM flagged QUALIFY row_number() OVER (PARTITION BY project, is_over_escalated ORDER BY md5('42:' || id)) <= 3""",
)

# --- split and samples -------------------------------------------------------

# Sizes as the rule states them: the test side of each cut is rounded up; shares
# by largest remainder, equal remainders by label.
SPLIT = f"""{WITH_TEAM},
counts AS (SELECT priority, count(*) AS c FROM truth GROUP BY priority),
sizes AS (SELECT sum(c)::BIGINT AS n, ceil((1 - 0.8::DOUBLE) * sum(c))::BIGINT AS n_rest FROM counts),
train_share AS (
  SELECT priority, c, (c * (n - n_rest)) // n AS base, (c * (n - n_rest)) % n AS over, n - n_rest AS wanted
  FROM counts, sizes
),
train_quota AS (
  SELECT priority, c, base + CASE WHEN row_number() OVER (ORDER BY over DESC, priority)
    <= wanted - (SELECT sum(base) FROM train_share) THEN 1 ELSE 0 END AS q_train FROM train_share
),
val_share AS (
  SELECT priority, q_train, wanted, (r * wanted) // n_rest AS base, (r * wanted) % n_rest AS over
  FROM (SELECT priority, q_train, c - q_train AS r, n_rest,
      n_rest - ceil((1 - 0.1::DOUBLE / (1 - 0.8::DOUBLE)) * n_rest)::BIGINT AS wanted
    FROM train_quota, sizes)
),
quota AS (
  SELECT priority, q_train, base + CASE WHEN row_number() OVER (ORDER BY over DESC, priority)
    <= wanted - (SELECT sum(base) FROM val_share) THEN 1 ELSE 0 END AS q_val FROM val_share
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY priority ORDER BY md5('42|' || {measured("priority")} || {measured("report_key")})) AS place FROM truth
),
splits AS (
  SELECT ranked.*, CASE WHEN place <= q_train THEN 'train' WHEN place <= q_train + q_val THEN 'val'
    ELSE 'test' END AS split FROM ranked JOIN quota USING (priority)
)"""
ORACLE["stratified_split"] = with_(SPLIT, "SELECT report_key, priority, split FROM splits")
ORACLE["split_report"] = with_(
    SPLIT,
    "SELECT split, count(*) AS rows, "
    + ", ".join(f"count(*) FILTER (priority = '{p}') AS {p}" for p in v.PRIORITIES)
    + ", round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM splits), 1) AS share_pct"
    + " FROM splits GROUP BY split",
)
ORACLE["stored_splits"] = with_(SPLIT, f"SELECT {', '.join([*v.PROCESSED_COLUMNS, 'report_key', 'split'])} FROM splits")
_OF_SPLIT = f"""{SPLIT},
domain AS (
  SELECT 'priority' AS dimension, unnest({_list(v.PRIORITIES)}) AS value
  UNION ALL SELECT 'split', unnest({_list(v.SPLITS)})
  UNION ALL SELECT DISTINCT 'source', source FROM splits
  UNION ALL SELECT 'all', 'all'
),
flagged AS (
  SELECT source, priority, split, coalesce(priority IN {_in(v.TOP_PRIORITIES)}
    AND upper(trim(resolution)) IN {_in(v.NON_FIX_RESOLUTIONS)} AND resolution_time_days > 7, false) AS hit FROM splits
),
told AS (
  SELECT 'all' AS dimension, 'all' AS value, hit FROM flagged
  UNION ALL SELECT 'source', source, hit FROM flagged
  UNION ALL SELECT 'priority', priority, hit FROM flagged
  UNION ALL SELECT 'split', split, hit FROM flagged
)"""
ORACLE["over_escalation_by_split"] = with_(
    _OF_SPLIT,
    """SELECT domain.dimension, domain.value, count(*) FILTER (hit) AS positives, count(hit) AS total,
  CASE WHEN count(hit) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (hit) / count(hit), 1) END AS rate_pct
  FROM domain LEFT JOIN told ON told.dimension = domain.dimension AND told.value = domain.value
  GROUP BY domain.dimension, domain.value""",
)
_SEEDED = "md5('42:' || report_key)"
ORACLE["seeded_sample"] = with_(
    LABELLED,
    f"""SELECT report_key, source, title, team, priority, left(body, 100) AS body_preview
  FROM labelled ORDER BY {_SEEDED} LIMIT 200""",
)
ORACLE["group_sample"] = with_(
    LABELLED,
    f"""SELECT report_key, team, left(title, 100) AS title,
    CASE WHEN body = '' THEN '(empty)' ELSE left(body, 200) END AS body
  FROM labelled QUALIFY row_number() OVER (PARTITION BY team ORDER BY {_SEEDED}) <= 10""",
)

# --- prompts and tokens ------------------------------------------------------

PROMPTED = f"""{WITH_TEAM},
prompted AS (SELECT *, {prompt("title", "body")} AS prompt, {completion("priority", "team")} AS completion FROM truth)"""
ORACLE["prompt_text"] = with_(
    PROMPTED, "SELECT report_key, prompt, completion, prompt || completion AS full_text FROM prompted"
)
ORACLE["training_sample"] = with_(
    PROMPTED,
    """SELECT prompt AS input_prompt, completion AS expected_output, prompt || completion AS full_string
  FROM prompted ORDER BY report_key LIMIT 100""",
)
COUNTED = f"""{PROMPTED},
counted AS (
  SELECT *, least({count_words("prompt || completion")}, 512) AS n, least({count_words("prompt")}, 512) AS p
  FROM prompted
)"""
ORACLE["tokenise_mask"] = with_(
    COUNTED,
    """SELECT report_key, priority, team, source, id, CAST(512 AS BIGINT) AS length, n AS n_tokens,
  n AS n_attended, p AS n_masked, n - p AS n_learned,
  CASE WHEN n < 512 THEN n + 1 ELSE 0 END AS first_pad_label,
  CAST(length(prompt || completion) AS BIGINT) AS full_text_chars, p >= 512 AS labels_all_masked FROM counted""",
)
_IDS = f"""{SPLIT},
prompted AS (
  SELECT report_key, split, {prompt("title", "body")} AS prompt, {completion("priority", "team")} AS completion
  FROM splits
),
listed AS (
  SELECT report_key, split, least(len({words("prompt")}), 512) AS p,
    list_transform(list_slice({words("prompt || completion")}, 1, 512),
      lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 131072 + 1) AS ids FROM prompted
),
padded AS (SELECT *, list_resize(ids, 512, 0) AS input_ids FROM listed)"""
ORACLE["tokenise_ids"] = with_(
    _IDS,
    """SELECT report_key, split, array_to_string(input_ids, ' ') AS input_ids,
  array_to_string(list_transform(range(512), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ' ') AS attention_mask,
  array_to_string(list_transform(range(512), lambda i: CASE WHEN i < p THEN -100 ELSE input_ids[i + 1] END), ' ') AS labels
  FROM padded""",
)
ORACLE["masked_rows_audit"] = with_(
    COUNTED,
    """SELECT source, count(*) AS rows, count(*) FILTER (p >= 512) AS all_masked, max(p) AS longest_prompt
  FROM counted GROUP BY source""",
)

ORACLE["prompt_samples"] = with_(
    f"""{SPLIT}, drawn AS (
  SELECT * FROM splits QUALIFY row_number() OVER (PARTITION BY split ORDER BY {_SEEDED}) <= 3
),
told AS (SELECT split, report_key, {prompt("title", "body")} AS prompt, {completion("priority", "team")} AS completion
  FROM drawn)""",
    "SELECT *, prompt || completion AS full_text FROM told",
)

# --- profile and audit -------------------------------------------------------

ORACLE["value_counts"] = with_(ANY_TEAM, "SELECT team, count(*) AS rows FROM labels_only GROUP BY team")
ORACLE["priority_domain_counts"] = with_(
    f"{ANY_TEAM}, {DOMAIN}",
    "SELECT p AS priority, (SELECT count(*) FROM labels_only WHERE priority = p) AS rows FROM domain",
)


def _pivot(row: str, table: str, column: str = "priority", domain: list[str] = v.PRIORITIES) -> str:
    cells = ", ".join(f"count(*) FILTER ({column} = '{x}') AS {x}" for x in domain)
    return f"SELECT {row}, {cells} FROM {table} GROUP BY {row}"


ORACLE["source_priority_pivot"] = with_(ANY_TEAM, _pivot("source", "labels_only"))
_BUGZILLA_LABELS = f"{BUGZILLA_RAW}, {BUGZILLA}, labels_only AS (SELECT *, {PRIORITY} AS priority FROM bugzilla)"
ORACLE["profile_shape"] = with_(TRUTH_LABELS, "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM truth")
ORACLE["profile_source_counts"] = with_(TRUTH_LABELS, "SELECT source, count(*) AS rows FROM truth GROUP BY source")
ORACLE["profile_teams"] = with_(TRUTH_LABELS, "SELECT team, count(*) AS rows FROM truth GROUP BY team")
ORACLE["profile_priorities"] = with_(
    f"{TRUTH_LABELS}, {DOMAIN}",
    "SELECT p AS priority, (SELECT count(*) FROM truth WHERE priority = p) AS rows FROM domain",
)
ORACLE["profile_sources"] = with_(TRUTH_LABELS, _pivot("source", "truth"))
ORACLE["profile_splits"] = ORACLE["split_report"]
ORACLE["profile_duplicates"] = with_(
    WITH_TEAM,
    f"""SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_rows, sum(n - 1)::BIGINT AS surplus,
  coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS members
  FROM (SELECT count(*) AS n FROM truth GROUP BY {', '.join([*v.PROCESSED_COLUMNS, 'report_key'])})""",
)
ORACLE["profile_duplicate_groups"] = """
SELECT source, lang AS team, text AS body, count(*) AS copies FROM documents GROUP BY ALL HAVING count(*) > 1"""
ORACLE["profile_durations"] = with_(
    WITH_TEAM,
    """SELECT source, count(*) AS reports, median(resolution_time_days) AS median_days,
  min(resolution_time_days) AS min_days, max(resolution_time_days) AS max_days
  FROM truth WHERE resolution_time_days >= 0 GROUP BY source""",
)
ORACLE["audit_severity_crosstab"] = with_(
    WITH_TEAM, _pivot("raw_severity", "(SELECT * FROM truth WHERE source = 'bugzilla')")
)
ORACLE["audit_spot_check"] = with_(
    WITH_TEAM, f"SELECT report_key, title, body, team, priority FROM truth ORDER BY {_SEEDED} LIMIT 200"
)
ORACLE["severity_crosstab"] = with_(_BUGZILLA_LABELS, _pivot("raw_severity", "labels_only"))
ORACLE["severity_map_check"] = with_(
    _BUGZILLA_LABELS,
    """SELECT raw_severity, string_agg(DISTINCT priority, ',' ORDER BY priority) AS reached,
  count(DISTINCT priority) AS n_values, count(DISTINCT priority) = 1 AS is_single
  FROM labels_only GROUP BY raw_severity""",
)
ORACLE["team_coverage"] = with_(
    ANY_TEAM,
    """SELECT source, count(*) AS reports, count(*) FILTER (team <> 'unknown') AS covered,
  round(avg(CASE WHEN team <> 'unknown' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS covered_pct
  FROM labels_only GROUP BY source""",
)
ORACLE["unknown_rate"] = with_(
    ANY_TEAM,
    """SELECT count(*) AS reports, count(*) FILTER (team = 'unknown') AS unknown,
  round(avg(CASE WHEN team = 'unknown' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1) AS unknown_pct FROM labels_only""",
)


def _distribution(column: str, domain: list[str], ctes: str = ANY_TEAM, table: str = "labels_only") -> str:
    cells = ", ".join(
        f"round(100.0::DOUBLE * count(*) FILTER ({column} = '{x}') / count(*), 1) AS {x}" for x in domain
    )
    return with_(ctes, f"SELECT source, {cells} FROM {table} GROUP BY source")


ORACLE["priority_distribution_by_source"] = _distribution("priority", v.PRIORITIES)
ORACLE["team_distribution_by_source"] = _distribution("team", [*v.TEAMS, v.UNKNOWN_TEAM])

WORDED = f"""{WITH_TEAM},
worded AS (SELECT {count_words("title")} AS title_words, {count_words("body")} AS body_words FROM truth)"""
ORACLE["text_length_stats"] = with_(
    WORDED,
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, round(avg({f}_words), 1) AS mean_words, median({f}_words)::DOUBLE AS median_words, "
        f"max({f}_words) AS max_words FROM worded"
        for f in ("title", "body")
    ),
)
ORACLE["profile_word_counts"] = ORACLE["text_length_stats"]
ORACLE["audit_severity_mapping"] = with_(
    TRUTH_RAW,
    """SELECT raw_severity, string_agg(DISTINCT priority, ',' ORDER BY priority) AS reached,
  count(DISTINCT priority) AS n_values, count(DISTINCT priority) = 1 AS is_single
  FROM truth WHERE source = 'bugzilla' GROUP BY raw_severity""",
)
ORACLE["audit_teams"] = ORACLE["profile_teams"]
ORACLE["audit_team_coverage"] = with_(
    TRUTH_LABELS,
    "SELECT source, count(*) AS reports, count(*) AS covered, 100.0::DOUBLE AS covered_pct FROM truth GROUP BY source",
)
ORACLE["audit_hedging"] = with_(
    WITH_TEAM,
    f"""SELECT phrase, (SELECT count(*) FROM truth WHERE source = 'bugzilla' AND priority IN ('P0', 'P1')
    AND contains(lower(title || ' ' || body), phrase)) AS reports
  FROM (SELECT unnest({_list(v.HEDGING_PHRASES)}) AS phrase)""",
)
ORACLE["audit_priority_distribution"] = _distribution("priority", v.PRIORITIES, TRUTH_LABELS, "truth")
ORACLE["audit_team_distribution"] = _distribution("team", [*v.TEAMS, v.UNKNOWN_TEAM], TRUTH_LABELS, "truth")


def _histogram(ctes: str, table: str, column: str) -> str:
    cap, bins = v.HISTOGRAMS[column]
    return with_(
        f"""{ctes},
capped AS (SELECT least({column}, {cap})::DOUBLE AS x FROM {table} WHERE {column} IS NOT NULL),
ends AS (SELECT min(x) AS lo, max(x) AS hi FROM capped),
edges AS (SELECT CASE WHEN lo = hi THEN lo - 0.5::DOUBLE ELSE lo END AS lo,
  CASE WHEN lo = hi THEN 1.0::DOUBLE ELSE hi - lo END AS w FROM ends),
placed AS (SELECT least(floor({bins}.0::DOUBLE * (x - lo) / w)::BIGINT + 1, {bins}) AS bin FROM capped, edges)""",
        f"""SELECT bin, lo + (bin - 1) * (w / {bins}) AS lower, lo + bin * (w / {bins}) AS upper,
  (SELECT count(*) FROM placed WHERE placed.bin = bins.bin) AS rows
  FROM (SELECT unnest(range(1, {bins + 1})) AS bin) AS bins, edges""",
    )


ORACLE["title_length_histogram"] = _histogram(WORDED, "worded", "title_words")
ORACLE["body_length_histogram"] = _histogram(WORDED, "worded", "body_words")
ORACLE["resolution_histogram"] = _histogram(
    f"""{TRACKER_RAW}, timed AS (
  SELECT * FROM (SELECT {whole_days("created_at", "closed_at")} AS resolution_time_days FROM tracker_raw)
  WHERE resolution_time_days >= 0)""",
    "timed",
    "resolution_time_days",
)
ORACLE["profile_histogram_title_words"] = ORACLE["title_length_histogram"]
ORACLE["profile_histogram_body_words"] = ORACLE["body_length_histogram"]
ORACLE["profile_histogram_resolution_time_days"] = _histogram(
    f"{WITH_TEAM}, timed AS (SELECT resolution_time_days FROM truth WHERE resolution_time_days >= 0)",
    "timed",
    "resolution_time_days",
)
_HEDGED = f"""{bugzilla_raw([" appears to", " not sure", " might", " mighty", " seems", ""])}, {BUGZILLA},
urgent AS (
  SELECT lower(title || ' ' || body) AS text FROM bugzilla WHERE {PRIORITY} IN ('P0', 'P1')
)"""
ORACLE["hedging_frequency"] = with_(
    _HEDGED,
    f"""SELECT phrase, (SELECT count(*) FROM urgent WHERE contains(text, phrase)) AS reports
  FROM (SELECT unnest({_list(v.HEDGING_PHRASES)}) AS phrase)""",
)
ORACLE["duplicate_audit"] = """
SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_rows, sum(n - 1)::BIGINT AS surplus,
  coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS members
FROM (SELECT text, count(*) AS n FROM documents GROUP BY text)"""
ORACLE["duplicate_members"] = """
SELECT text, lang, source FROM documents QUALIFY count(*) OVER (PARTITION BY text, lang, source) > 1"""
_CHECKS = """SELECT 'unknown_team_rate' AS "check", round(avg(CASE WHEN team = 'unknown' THEN 1.0::DOUBLE ELSE 0 END) * 100, 1)
    AS value, avg(CASE WHEN team = 'unknown' THEN 1.0::DOUBLE ELSE 0 END) * 100 < 40 AS passed FROM {table}
  UNION ALL SELECT 'priorities_represented', count(DISTINCT priority)::DOUBLE, count(DISTINCT priority) = 5
  FROM {table}
  UNION ALL SELECT 'null_priorities', count(*) FILTER (priority IS NULL)::DOUBLE,
    count(*) FILTER (priority IS NULL) = 0 FROM {table}"""
ORACLE["label_quality_checks"] = with_(ANY_TEAM, _CHECKS.format(table="labels_only"))
ORACLE["audit_checks"] = with_(TRUTH_LABELS, _CHECKS.format(table="truth"))
ORACLE["distinct_resolutions"] = with_(TRACKER_RAW, "SELECT DISTINCT resolution FROM tracker_raw")
ORACLE["table_shape"] = with_(UNIFIED, "SELECT count(*) AS rows, CAST(9 AS BIGINT) AS columns FROM unified")

# --- evaluation --------------------------------------------------------------

ORACLE["parse_outputs"] = with_(
    f"{TRUTH_LABELS}, {OUTPUTS}",
    f"SELECT report_key, raw_output, pred_severity, pred_team FROM {parsed('outputs')}",
)
ORACLE["parse_failure_rate"] = with_(
    f"{TRUTH_LABELS}, {OUTPUTS}",
    f"""SELECT count(*) AS n_samples, count(*) FILTER (pred_severity IS NULL) AS failures,
  round(count(*) FILTER (pred_severity IS NULL) / count(*)::DOUBLE, 4) AS parse_failure_rate
  FROM {parsed('outputs')}""",
)
ORACLE["alignment_gaps"] = with_(
    TRUTH_LABELS,
    """SELECT count(*) FILTER (CAST(id AS BIGINT) % 100 = 0) AS reports_without_answer,
  CAST(0 AS BIGINT) AS answers_without_report, CAST(0 AS BIGINT) AS keys_answered_twice FROM truth""",
)
ORACLE["severity_f1"] = with_(f"{JOINED}, {DOMAIN}, {F1}", ROUNDED_F1)
MATRIX = f"""{JOINED}, {DOMAIN},
matrix AS (
  SELECT t.p AS true_severity, q.p AS pred_severity,
    (SELECT count(*) FROM joined WHERE priority = t.p AND pred_severity = q.p) AS rows
  FROM domain AS t, domain AS q
)"""
ORACLE["confusion_matrix"] = with_(MATRIX, "SELECT * FROM matrix")
ORACLE["critical_errors"] = with_(
    MATRIX,
    """SELECT *, CASE WHEN pred_severity IN ('P3', 'P4') THEN 'CRITICAL' ELSE 'notable' END AS kind FROM matrix
  WHERE true_severity IN ('P0', 'P1') AND true_severity <> pred_severity AND rows > 0""",
)
_SUMMARY = f"""{DOMAIN}, {F1},
summary AS (
  SELECT round((SELECT avg(score) FROM f1), 4) AS severity_macro_f1,
    round(avg(coalesce(priority = pred_severity, false)::INTEGER), 4) AS severity_accuracy,
    round(avg(coalesce(team = pred_team, false)::INTEGER), 4) AS team_accuracy,
    round(avg((pred_severity IS NULL)::INTEGER), 4) AS parse_failure_rate, count(*) AS n_samples FROM joined
)"""
_ON_TARGET = """SELECT *, severity_macro_f1 > 0.72 AS macro_f1_on_target, team_accuracy > 0.78 AS team_accuracy_on_target
  FROM summary"""
ORACLE["metrics_summary"] = with_(f"{JOINED}, {_SUMMARY}", _ON_TARGET)
_ANSWERED = f"{TRUTH_LABELS}, {OUTPUTS}, answered AS (SELECT * FROM {parsed('outputs')})"
ORACLE["metrics_incomplete"] = with_(
    f"""{_ANSWERED},
joined AS (
  SELECT priority, team, pred_severity, pred_team FROM truth
  LEFT JOIN answered ON truth.report_key = answered.report_key AND CAST(id AS BIGINT) % 100 <> 0
), {_SUMMARY}""",
    _ON_TARGET,
)
ORACLE["metrics_repeated_keys"] = with_(
    f"""{_ANSWERED},
joined AS (
  SELECT priority, team, pred_severity, pred_team
  FROM (SELECT * FROM truth UNION ALL SELECT * FROM truth) JOIN answered USING (report_key)
), {_SUMMARY}""",
    _ON_TARGET,
)
ORACLE["prediction_report"] = with_(
    f"{WITH_TEAM}, {OUTPUTS}",
    f"""SELECT report_key, title, body, priority, team, {prompt("title", "body")} AS input_prompt, raw_output,
  pred_severity, pred_team, coalesce(priority = pred_severity, false) AS sev_correct,
  coalesce(team = pred_team, false) AS team_correct FROM truth JOIN {parsed("outputs")} USING (report_key)""",
)

# The rule, stated over the whole prompt.
from bugtide.operators.scoring import SEVERITY_WORDS  # noqa: E402

_GUESS = (
    "CASE "
    + " ".join(
        "WHEN regexp_matches(seen, "
        + _text(rf"(?i)(^|[^{v.WORD_CLASS}])({'|'.join(w)})([^{v.WORD_CLASS}]|$)")
        + f") THEN {_text(level)}"
        for level, w in SEVERITY_WORDS
    )
    + " ELSE 'P3' END"
)
SCORED = f"""{PROMPTED},
seen AS (SELECT *, prompt AS seen FROM prompted),
scored AS (SELECT report_key, priority, team, {completion(_GUESS, team_of("seen"))} AS raw_output FROM seen)"""
ORACLE["score_reports"] = with_(SCORED, "SELECT * FROM scored")
ORACLE["scored_metrics"] = with_(
    f"{SCORED}, joined AS (SELECT priority, pred_severity FROM {parsed('scored')}), {DOMAIN}, {F1}", ROUNDED_F1
)

_SCORED_SPLITS = f"""{SPLIT},
prompted AS (SELECT *, {prompt("title", "body")} AS seen FROM splits),
scored AS (SELECT *, seen AS input_prompt, {completion(_GUESS, team_of("seen"))} AS raw_output FROM prompted),
answered AS (SELECT * FROM {parsed('scored')})"""
ORACLE["evaluated_split"] = with_(
    f"{_SCORED_SPLITS}, joined AS (SELECT * FROM answered WHERE split = 'val'), {_SUMMARY}", _ON_TARGET
)
ORACLE["evaluated_report"] = with_(
    _SCORED_SPLITS,
    """SELECT report_key, title, body, priority, team, input_prompt, raw_output, pred_severity, pred_team,
  coalesce(priority = pred_severity, false) AS sev_correct, coalesce(team = pred_team, false) AS team_correct
  FROM answered WHERE split = 'test'""",
)
_REPORT_TEXT = ", ".join(
    f"{_present(c)} AS {c}" for c in ("title", "body", "priority", "team", "input_prompt", "raw_output", "pred_severity", "pred_team")
)
ORACLE["published_report"] = with_(
    _SCORED_SPLITS,
    f"""SELECT report_key, {_REPORT_TEXT}, CAST(coalesce(priority = pred_severity, false) AS VARCHAR) AS sev_correct,
  CAST(coalesce(team = pred_team, false) AS VARCHAR) AS team_correct FROM answered WHERE split = 'val'""",
)
