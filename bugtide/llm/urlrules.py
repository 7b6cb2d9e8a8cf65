"""URL filtering: fixed host rules first, then association rules mined by FP-growth.

A URL's host is what follows its first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case; its path goes on up to ``?``, ``#`` or the end. A fixed rule fits its host
and all subdomains, if the path starts with the rule's; the longest rule wins.

Where no fixed rule fits, tokens of the URL decide: scheme, labels of the host, words
of the path, its ending, names of parameters; numbers are one token. Pages whose id is
labelled are transactions, with an item for a bad label (toxic, or of low quality).
Spark's FP-growth mines the combinations that `LEAST_BAD` bad pages or more hold, a number
and not a share, so that a host is found however many other pages are labelled. Rules that
lead to the bad item are kept above the least confidence if they beat the base rate (the
lower end of the Wilson interval at `SURE` deviations lies above the share of bad pages in
all labelled ones) and are more reliable than every rule on some of their tokens; an inverted
index from token to rule matches them: a rule fires if all its tokens are met. Equal token
sets are matched once.

Defined cases: a missing URL, or one without ``://``, has an empty host and path, and no
tokens; repeated pages are judged each for itself, repeated labels of an id count as
bad if one of them is; a page without a label is not a transaction; with no labelled
page there are no rules and all else is allowed; an empty table gives an empty table;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path).
FIXED = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LEAST_BAD = 3
CONFIDENCE = 0.6
SURE = 3.0
BAD = "label=bad"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    url = F.coalesce(url, F.lit(""))
    tagged = lambda tag, values: F.transform(values, lambda x: F.concat(F.lit(tag), x))
    plain = F.regexp_replace(path(url), "[0-9]+", "0")
    query = F.regexp_extract(url, "(?s)^[^#]*?\\?([^#]*)", 1)
    found = F.concat(
        tagged("scheme:", F.array(F.regexp_extract(url, "(?s)^(.*?)://", 1))),
        tagged("host:", F.split(host(url), "\\.")),
        tagged("path:", F.split(plain, "[/.]+")),
        tagged("ending:", F.array(F.regexp_extract(plain, "\\.([A-Za-z]+)$", 1))),
        tagged("parameter:", F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1))),
    )
    real = F.filter(found, lambda x: ~x.endswith(":"))
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(real))).otherwise(F.array().cast("array<string>"))


def fixed_rule(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none does."""
    chosen = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host_ == h) | host_.endswith("." + h)) & path_.startswith(p) for _, h, p in chosen]
    pick = lambda value: F.coalesce(*(F.when(f, F.lit(value(r))) for f, r in zip(fits, chosen, strict=True)))
    if not chosen:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def reliable(bad: Column, all_: Column, base: float, sure: float = SURE) -> Column:
    """Whether ``bad`` of ``all_`` pages lie above the base rate by the Wilson interval's lower end."""
    share = bad / all_
    spread = F.sqrt(share * (1 - share) / all_ + sure**2 / (4 * all_ * all_))
    return (share + sure**2 / (2 * all_) - sure * spread) / (1 + sure**2 / all_) > base


def association_rules(
    transactions: DataFrame, least: int = LEAST_BAD, confidence: float = CONFIDENCE, sure: float = SURE
) -> DataFrame:
    """(items, bad, all, confidence) of the token combinations that lead to `BAD`.

    ``transactions`` has a column `items` of distinct tokens.
    """
    found = transactions.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("items", BAD)).alias("bad")).first()
    n, base = found["n"], found["bad"] / max(found["n"], 1)
    # Half a page less, so that rounding never loses a combination of exactly ``least`` pages.
    support = min(1.0, max(least - 0.5, 0.5) / max(n, 1))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(transactions)
    bad = F.round(F.col("support") * n)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.array_sort("antecedent").alias("items"),
        bad.cast("bigint").alias("bad"),
        F.round(bad / F.col("confidence")).cast("bigint").alias("all"),
        "confidence",
    )
    return rules.where(reliable(F.col("bad"), F.col("all"), base, sure))


def mine(transactions: DataFrame, least: int = LEAST_BAD, confidence: float = CONFIDENCE, sure: float = SURE) -> DataFrame:
    """(rule, token, size) of the association rules that no rule on fewer tokens replaces, an inverted index."""
    rules = association_rules(transactions, least, confidence, sure)
    numbered = rules.select(F.xxhash64("items").alias("rule"), "items", "confidence", F.size("items").alias("size"))
    index = numbered.select("rule", "size", "confidence", F.explode("items").alias("token"))
    # A rule is superfluous if a rule on some of its tokens is as reliable.
    smaller = index.select(F.col("rule").alias("_rule"), F.col("size").alias("_size"), F.col("confidence").alias("_confidence"), "token")
    covered = (
        index.join(smaller, "token")
        .where("_size < size AND _confidence >= confidence")
        .groupBy("rule", "_rule", "_size")
        .count()
        .where("count = _size")
        .select("rule")
        .distinct()
    )
    return index.join(covered, "rule", "left_anti").select("rule", "token", "size")


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = FIXED,
    key: str = "page_id",
    url: str = "url",
    least: int = LEAST_BAD,
    confidence: float = CONFIDENCE,
    sure: float = SURE,
) -> DataFrame:
    """Key, host, path, fixed rule and verdict of every page.

    ``labels`` has doc_id, quality and toxic (0 or 1, or missing) of some pages.
    """
    bad = F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.col("toxic") == 1, F.col("quality") == 0, F.lit(False))
    judged = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max(bad).alias("_bad"))
    known = pages.select(F.col(key).alias("_id"), tokens(F.col(url)).alias("_tokens")).join(judged, "_id")
    items = F.when(F.col("_bad"), F.array_append("_tokens", F.lit(BAD))).otherwise(F.col("_tokens"))
    transactions = known.select(items.alias("items")).where(F.size("items") > 0)
    rows = pages.select(F.col(key).alias("_key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), tokens(F.col(url)).alias("_tokens"))
    index = mine(transactions, least, confidence, sure)
    sets = rows.select("_tokens").distinct()
    fired = (
        sets.select("_tokens", F.explode("_tokens").alias("token"))
        .join(index, "token")
        .groupBy("_tokens", "rule", "size")
        .count()
        .where("count = size")
        .groupBy("_tokens")
        .agg(F.count(F.lit(1)).alias("n_rules"))
    )
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    return rows.join(fired, "_tokens", "left").select(
        F.col("_key").alias(key),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("n_rules") > 0, F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("n_rules", F.lit(0).cast("bigint")).alias("n_rules"),
    )
