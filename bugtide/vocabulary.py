"""Word lists, lookup tables, patterns, formats and constants.

Everything in this module is data that results depend on, stated as text. Change
an entry and the labels change; the code that applies them lives elsewhere.
"""

# --- label domains -----------------------------------------------------------

PRIORITIES = ["P0", "P1", "P2", "P3", "P4"]
DEFAULT_PRIORITY = "P3"
TOP_PRIORITIES = ["P0", "P1"]
LOW_PRIORITIES = ["P3", "P4"]

TEAMS = ["platform", "database", "frontend", "backend", "infra", "security", "mobile"]
UNKNOWN_TEAM = "unknown"

SPLITS = ["train", "val", "test"]

# Source labels of the three loaders; every function that needs one takes it as
# a parameter with these defaults.
BUGZILLA = "bugzilla"
TRACKER = "tracker"
TIMESTAMPED = "timestamped"

# --- priority tables ---------------------------------------------------------

# Lower-case severity of a Bugzilla report. Anything else is DEFAULT_PRIORITY.
SEVERITY_TO_PRIORITY = {
    "blocker": "P0",
    "critical": "P1",
    "major": "P2",
    "normal": "P3",
    "minor": "P4",
    "trivial": "P4",
}

# Priority of a tracker report as its project spells it.
TRACKER_TO_PRIORITY = {
    "High": "P1",
    "Normal": "P3",
    "Low": "P4",
    "Urgent": "P0",
    "P1": "P0",
    "P2": "P1",
    "P3": "P2",
    "P4": "P3",
    "P5": "P4",
    "Blocker": "P0",
    "Critical": "P1",
    "Major": "P2",
    "Minor": "P3",
    "Trivial": "P4",
}

PLACEHOLDER_PRIORITY = "--"

# --- team keywords, most specific team first ---------------------------------

# Whole words. "eclipse platform" needs no entry: its second word has one.

TEAM_KEYWORDS = [
    (
        "security",
        [
            "security", "auth", "ssl", "tls", "crypto", "certificate", "permission", "oauth", "saml", "jwt",
            "encryption",
        ],
    ),
    (
        "database",
        [
            "database", "db", "sql", "mysql", "postgres", "sqlite", "oracle", "mongo", "jdbc", "orm",
            "hibernate", "derby", "h2",
        ],
    ),
    (
        "mobile",
        [
            "android", "ios", "iphone", "ipad", "mobile", "tablet", "swift", "kotlin",
        ],
    ),
    (
        "frontend",
        [
            "ui", "gui", "frontend", "interface", "widget", "dialog", "window", "css", "html", "browser",
            "editor", "view", "swt", "birt", "rendering", "firefox", "thunderbird", "display", "layout",
        ],
    ),
    (
        "infra",
        [
            "infra", "infrastructure", "deploy", "docker", "kubernetes", "k8s", "ci", "cd", "pipeline",
            "devops", "monitoring", "logging", "tomcat", "server", "maven", "gradle", "ant", "build", "jenkins",
            "slurm",
        ],
    ),
    (
        "platform",
        [
            "platform", "core", "runtime", "jvm", "jdk", "classpath", "aspectj", "eclipse_platform", "equinox",
        ],
    ),
    (
        "backend",
        [
            "api", "backend", "service", "rest", "endpoint", "handler", "controller", "jdt", "cdt", "compiler",
            "parser", "refactor",
        ],
    ),
]

# --- resolutions and phrases -------------------------------------------------

# After trimming and upper-casing. DUPLICATE is left out on purpose.
NON_FIX_RESOLUTIONS = [
    "WON'T FIX",
    "WONTFIX",
    "WON'T DO",
    "NOT A PROBLEM",
    "CANNOT REPRODUCE",
    "INVALID",
    "NOT A BUG",
    "WORKS FOR ME",
    "WORKSFORME",
    "INCOMPLETE",
    "ABANDONED",
    "MOVED",
    "INACTIVE",
    "AUTO CLOSED",
    "PENDING CLOSED",
]

HEDGING_PHRASES = [
    "sometimes",
    "occasionally",
    "intermittent",
    "might",
    "maybe",
    "appears to",
    "seems",
    "randomly",
    "flaky",
    "not reproducible",
    "not always",
    "sporadically",
    "unclear",
    "not sure",
    "possibly",
    "perhaps",
]

# --- text patterns -----------------------------------------------------------

# The characters Python's str.split() and str.strip() treat as whitespace, as a
# string and as the inside of a regex character class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Any character but line breaks, plain spaces and those sure to be no blank.
UNUSUAL = r"[^\x20-\x7e\n\x{a1}-\x{167f}\x{1681}-\x{1fff}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}]"
WORD_CLASS = r"\p{L}\p{N}_"
# Letters that equal an ASCII letter when case is ignored, but do not become it in lower case.
FOLDED_LETTERS = {"\u017f": "s", "\u212a": "k", "\u0130": "i", "\u0131": "i"}

HTML_TAG = "<[^>]+>"
ENTITY = r"&[a-z]+;|&#\p{Nd}+;"
SPACES = "[ \t]+"
BLANK_LINES = "\n{3,}"

KEPT_FRAMES = 10
BODY_WORDS = 400
TEAM_BODY_CHARS = 200

ID_SEPARATORS = "[,;|]+"

# --- prompts, tokens and model output ----------------------------------------

PROMPT_HEAD = "### Incident report:\n"
PROMPT_TAIL = "\n### Triage:\n"
COMPLETION_SEVERITY = "severity:"
COMPLETION_TEAM = " | team:"

TOKEN_LENGTH = 512
MASKED_LABEL = -100

TARGET_MACRO_F1 = 0.72
TARGET_TEAM_ACCURACY = 0.78

# --- audit and profile constants ---------------------------------------------

SEED = 42
OVER_ESCALATION_DAYS = 7
MAX_UNKNOWN_PERCENT = 40
SPOT_CHECK_ROWS = 200

# value -> (cap, number of bins)
HISTOGRAMS = {
    "resolution_time_days": (365, 50),
    "title_words": (60, 40),
    "body_words": (500, 50),
}

# --- tracker files -----------------------------------------------------------

# The strings the usual CSV readers of data-frame libraries take as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

ISSUE_ID_HEADERS = ["issueid", "bugid", "id", "issuekey", "bugnumber", "issuenumber"]
LISTED_ISSUE_HEADERS = ["issueid", "bugid", "id"]
LISTED_DUPLICATE_HEADERS = ["duplicateid", "dupid", "duplicatedbugid"]

TRACKER_COLUMNS = [
    "id", "title", "body", "priority", "resolution", "created_at", "closed_at", "project",
]

EXPORT_TO_CANONICAL = {
    "Summary": "title",
    "Issue id": "id",
    "Priority": "priority",
    "Resolution": "resolution",
    "Created": "created_at",
    "Resolved": "closed_at",
    "Description": "body",
    "source_project": "project",
}
UNUSED_EXPORT_COLUMNS = ["Status", "Affects Version/s"]

# Timestamp layouts tried, in order, after ISO 8601.
TIMESTAMP_FORMATS = [
    "dd/MMM/yy h:mm a",
    "dd/MMM/yy HH:mm",
    "yyyy/MM/dd HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy",
    "dd MMM yyyy HH:mm:ss",
]

# --- table layouts -----------------------------------------------------------

UNIFIED_COLUMNS = [
    "id", "source", "title", "body", "raw_severity", "raw_priority", "resolution", "project",
    "created_at", "closed_at", "resolution_time_days",
]
PROCESSED_COLUMNS = [
    "id", "source", "title", "body", "priority", "team", "raw_severity", "resolution",
    "resolution_time_days",
]
