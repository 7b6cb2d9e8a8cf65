"""Distributions, histograms and audits of labelled reports.

Group values (sources, priorities, teams) are few, so every count is added up on
the map side and only the small result is sorted, pivoted or windowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugtide import vocabulary as v
from bugtide.functions import keys
from bugtide.functions import text as tx
from bugtide.operators.copies import count_copies, repeat_rows
from bugtide.storage import written


# A table may be one that has been counted already: ``weight`` then names its column of
# row counts, and the operators below add those up.


def _rows(weight: str | None = None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0)).cast("bigint")


def _rows_if(condition: Column, weight: str | None = None) -> Column:
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint")


def counted_by(df: DataFrame, columns: list[str], weight: str = "rows") -> DataFrame:
    """Rows per combination of a few columns of few values, from which all their counts follow."""
    return df.groupBy(*columns).agg(_rows().alias(weight))


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(_rows(weight).alias("rows"))
        .orderBy(F.desc("rows"), column)
    )


def domain_counts(
    df: DataFrame, column: str = "priority", domain: list[str] = v.PRIORITIES, weight: str | None = None
) -> DataFrame:
    """Rows per value of a fixed domain, 0 where a value does not occur."""
    cells = [
        F.struct(F.lit(value).alias(column), _rows_if(F.col(column) == value, weight).alias("rows"))
        for value in domain
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def count_pivot(
    df: DataFrame, row: str, column: str, domain: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """Two-way counts, zero filled; without a domain the values are looked up."""
    present = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return present.groupBy(row).pivot(column, domain).agg(_rows(weight)).na.fill(0)


def mapping_check(df: DataFrame, key: str = "raw_severity", value: str = "priority") -> DataFrame:
    """Whether each key reaches exactly one value, and which ones it reaches."""
    return (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.array_join(F.sort_array(F.collect_set(value)), ",").alias("reached"),
             F.count_distinct(value).alias("n_values"))
        .withColumn("is_single", F.col("n_values") == 1)
    )


def _percent(condition: Column) -> Column:
    return F.round(F.avg(condition.cast("double")) * 100, 1)


def team_coverage(df: DataFrame) -> DataFrame:
    """Percentage of reports with a known team, by source. Run it before reports
    without a team are dropped."""
    known = F.col("team") != v.UNKNOWN_TEAM
    return df.groupBy("source").agg(
        _rows().alias("reports"), F.count_if(known).alias("covered"), _percent(known).alias("covered_pct")
    )


def unknown_rate(df: DataFrame) -> DataFrame:
    unknown = F.col("team") == v.UNKNOWN_TEAM
    return df.agg(
        _rows().alias("reports"), F.count_if(unknown).alias("unknown"), _percent(unknown).alias("unknown_pct")
    )


def distribution_by(df: DataFrame, column: str, group: str = "source", domain: list[str] | None = None) -> DataFrame:
    """Percentage of each value within its group, one column per value."""
    counts = (
        df.where(F.col(group).isNotNull() & F.col(column).isNotNull())
        .groupBy(group, column)
        .agg(_rows().alias("rows"))
    )
    share = F.round(100 * F.col("rows") / F.sum("rows").over(Window.partitionBy(group)), 1)
    return counts.withColumn("pct", share).groupBy(group).pivot(column, domain).agg(F.first("pct")).na.fill(0.0)


def flag_counts(df: DataFrame, flags: list[str]) -> DataFrame:
    """Total rows and rows per flag, in one pass."""
    return df.agg(_rows().alias("total"), *[F.count_if(F.col(f)).alias(f) for f in flags])


def closed_without_resolution_counts(closed: DataFrame) -> DataFrame:
    return value_counts(closed, "project")


#: A bracket of at most so many rows is ordered by value.
FINE_ROWS = 100_000
#: The sketch's ranks are off by at most this share of the rows.
SKETCH_ERROR = 1 / 10_000


def exact_medians(values: DataFrame, fine: int = FINE_ROWS, error: float = SKETCH_ERROR) -> DataFrame:
    """``group`` and ``median`` of a table of ``group`` and ``value`` (double), missing values left out.

    The two columns are stored, and narrowed down to a bracket around the middle of each
    group: between two quantiles of a mergeable sketch, and, while a bracket holds more than
    ``fine`` rows and more than one value, between quantiles of its own rows. Only the rows of
    the brackets are counted by value and ordered. No pass holds more than a sketch for each
    group, however many values there are; every bracket's rank is counted, so the
    sketch decides how narrow it is and not what comes out.

    Runs jobs when called.
    """
    stored = written(values.where(F.col("value").isNotNull()).select("group", F.col("value").cast("double").alias("value")))
    middle = F.percentile_approx("value", [0.5 - 2 * error, 0.5 + 2 * error], int(1 / error))
    found = stored.groupBy("group").agg(_rows().alias("n"), middle.alias("edges"))
    state = _counted(stored, found.select("group", "n", F.col("edges")[0].alias("low"), F.col("edges")[1].alias("high")))
    wide = _wide(state, fine)
    while wide:
        narrower = _counted(stored, _narrowed(stored, state, error))
        before, wide = wide, _wide(narrower, fine)
        state = narrower
        if wide >= before:
            break
    counts = _bracketed(stored, state).groupBy("group", "value").agg(_rows().alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("group").orderBy("value"))
    ranked = counts.withColumn("upto", upto).join(state, F.col("group").eqNullSafe(F.col("_group")))
    last = F.col("below") + F.col("upto")
    covers = lambda rank: (last > rank) & (last - F.col("rows") <= rank)
    return ranked.groupBy("group").agg(
        (
            0.5 * F.max(F.when(covers(_first_rank()), F.col("value")))
            + 0.5 * F.max(F.when(covers(_last_rank()), F.col("value")))
        ).alias("median")
    )


def _wide(state: DataFrame, fine: int) -> int:
    """Rows in brackets that are worth narrowing."""
    return state.where((F.col("inside") > fine) & (F.col("low") < F.col("high"))).agg(F.sum("inside")).first()[0] or 0


def _first_rank() -> Column:
    """The ranks, from 0, of the one or two middle values of ``n``."""
    return F.floor((F.col("n") - 1) / 2)


def _last_rank() -> Column:
    return F.floor(F.col("n") / 2)


def _joined(stored: DataFrame, brackets: DataFrame) -> DataFrame:
    named = brackets.withColumnRenamed("group", "_group") if "group" in brackets.columns else brackets
    return stored.join(named, F.col("group").eqNullSafe(F.col("_group")))


def _bracketed(stored: DataFrame, brackets: DataFrame) -> DataFrame:
    """The rows inside their group's bracket."""
    return _joined(stored, brackets).where(F.col("value").between(F.col("low"), F.col("high")))


def _counted(stored: DataFrame, brackets: DataFrame) -> DataFrame:
    """The brackets with the number of rows below and inside; one that misses the middle becomes the whole range."""
    inside = F.col("value").between(F.col("low"), F.col("high"))
    counted = (
        _joined(stored, brackets)
        .groupBy(F.col("group").alias("_group"), "n", "low", "high")
        .agg(
            F.count_if(F.col("value") < F.col("low")).alias("below"),
            F.count_if(inside).alias("inside"),
            F.min("value").alias("least"),
            F.max("value").alias("most"),
        )
    )
    held = (F.col("below") <= _first_rank()) & (F.col("below") + F.col("inside") > _last_rank())
    return written(
        counted.select(
            "_group",
            "n",
            F.when(held, F.col("low")).otherwise(F.col("least")).alias("low"),
            F.when(held, F.col("high")).otherwise(F.col("most")).alias("high"),
            F.when(held, F.col("below")).otherwise(F.lit(0)).alias("below"),
            F.when(held, F.col("inside")).otherwise(F.col("n")).alias("inside"),
        )
    )


def _narrowed(stored: DataFrame, state: DataFrame, error: float) -> DataFrame:
    """Each bracket between the quantiles of its rows that lie around the middle ranks."""
    cuts = max(2, int(0.1 / error))
    edges = F.percentile_approx("value", [i / cuts for i in range(cuts + 1)], int(1 / error))
    rows = _bracketed(stored, state).groupBy("_group", "n", "below", "inside").agg(edges.alias("edges"))
    share = lambda rank: (rank - F.col("below")) * cuts / F.col("inside")
    first = F.greatest(F.floor(share(_first_rank())) - 1, F.lit(0)).cast("int")
    last = F.least(F.ceil(share(_last_rank())) + 1, F.lit(cuts)).cast("int")
    return rows.select("_group", "n", F.get("edges", first).alias("low"), F.get("edges", last).alias("high"))


def duration_summary(df: DataFrame, column: str = "resolution_time_days") -> DataFrame:
    """Exact median and range of durations, by source; runs jobs when called."""
    medians = exact_medians(df.select(F.col("source").alias("group"), F.col(column).alias("value")))
    ranges = df.groupBy("source").agg(
        F.count(column).alias("reports"), F.min(column).alias("min_days"), F.max(column).alias("max_days")
    )
    found = ranges.join(medians, F.col("source").eqNullSafe(F.col("group")), "left")
    return found.select("source", "reports", F.col("median").alias("median_days"), "min_days", "max_days")


def with_word_counts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"title_words": tx.word_count(F.col("title")), "body_words": tx.word_count(F.col("body"))}
    )


def word_count_summary(counted: DataFrame) -> DataFrame:
    """Mean, exact median and maximum of the word counts of titles and bodies.

    Rows are first counted by field and word count, so the text is read once and everything
    follows from a table that is as long as the word counts differ; no job runs when called.
    """
    fields = [F.struct(F.lit(name).alias("field"), F.col(f"{name}_words").alias("words")) for name in ("title", "body")]
    rows = counted.select(F.inline(F.array(*fields))).groupBy("field", "words").agg(_rows().alias("rows"))
    known = rows.where(F.col("words").isNotNull())
    upto = F.sum("rows").over(Window.partitionBy("field").orderBy("words"))
    total = F.sum("rows").over(Window.partitionBy("field"))
    ranked = known.withColumns({"_upto": upto, "n": total})
    covers = lambda rank: (F.col("_upto") > rank) & (F.col("_upto") - F.col("rows") <= rank)
    middle = [F.max(F.when(covers(rank), F.col("words"))) for rank in (_first_rank(), _last_rank())]
    sums = ranked.groupBy("field").agg(
        F.round(F.sum(F.col("words") * F.col("rows")) / F.sum("rows"), 1).alias("mean_words"),
        (0.5 * middle[0] + 0.5 * middle[1]).alias("median_words"),
        F.max("words").cast("bigint").alias("max_words"),
    )
    names = counted.sparkSession.range(1).select(F.explode(F.array(F.lit("title"), F.lit("body"))).alias("field"))
    return names.join(sums, "field", "left").select("field", "mean_words", "median_words", "max_words")


def _capped(column: str, cap: float) -> Column:
    value = F.col(column).cast("double")
    return F.when(value > cap, F.lit(float(cap))).otherwise(value)


def histogram(df: DataFrame, column: str, cap: float, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and the largest capped value, the
    last one closed; empty bins are listed.

    One aggregate finds the range, a second one counts the bins; each task holds no
    more than ``bins`` counts. Whole numbers, of which a cap leaves few, are counted by
    value first and both aggregates read those counts, so a column that is costly to compute is
    computed once; a fractional column is read twice and never stored. Runs a job when called.
    """
    if isinstance(df.schema[column].dataType, T.IntegralType):
        values = written(df.groupBy(_capped(column, cap).alias("value")).agg(_rows().alias("n")))
    else:
        values = df.select(_capped(column, cap).alias("value"), F.lit(1).cast("bigint").alias("n"))
    values = values.where(F.col("value").isNotNull())
    low, high = values.agg(F.min("value"), F.max("value")).first()
    if low is None:
        low, width = None, None
    elif low == high:
        low, width = low - 0.5, 1.0
    else:
        width = high - low
    low, width = F.lit(low).cast("double"), F.lit(width).cast("double")
    place = F.floor(F.lit(float(bins)) * (F.col("value") - low) / width) + 1
    filled = values.groupBy(F.least(place, F.lit(bins)).alias("bin")).agg(F.sum("n").alias("n"))
    step = width / bins
    return (
        df.sparkSession.range(1, bins + 1)
        .select(F.col("id").alias("bin"))
        .join(filled, "bin", "left")
        .select(
            "bin",
            (low + (F.col("bin") - 1) * step).alias("lower"),
            (low + F.col("bin") * step).alias("upper"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"),
        )
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def null_labels(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("priority").isNull()).alias("null_priorities"))


def shape(df: DataFrame, weight: str | None = None, columns: int | None = None) -> DataFrame:
    return df.agg(_rows(weight).alias("rows")).withColumn("columns", F.lit(columns or len(df.columns)).cast("bigint"))


def phrase_counts(df: DataFrame, phrases: list[str] = v.HEDGING_PHRASES) -> DataFrame:
    """Reports whose lower-cased title and body contain each phrase; one pass."""
    text = F.lower(F.concat_ws(" ", "title", "body"))
    cells = [
        F.struct(F.lit(phrase).alias("phrase"), F.count_if(F.col("_text").contains(phrase)).alias("reports"))
        for phrase in phrases
    ]
    return (
        df.select(text.alias("_text"))
        .agg(F.array(*cells).alias("cells"))
        .select(F.inline("cells"))
        .orderBy(F.desc("reports"), "phrase")
    )


def row_digests(df: DataFrame) -> Column:
    """A digest over all columns of a table; equal rows have equal ones."""
    return keys.row_digest(df.columns).alias("digest")


def duplicate_summary(df: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Rows, distinct rows, surplus copies and rows that have a copy.

    Only a digest of each row is shuffled, counted on the map side first; ``digests`` has
    them where they have been computed.
    """
    found = df.select(row_digests(df)) if digests is None else digests
    groups = found.groupBy("digest").agg(_rows().alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        _rows().alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("members"),
    )


def duplicate_groups(df: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Every row content that occurs more than once, with its number of copies.

    Digests are counted first; only rows whose digest repeats are grouped whole.
    """
    found = df.select(row_digests(df)) if digests is None else digests
    repeated = found.groupBy("digest").agg(_rows().alias("_n")).where("_n > 1").select(F.col("digest").alias("_digest"))
    marked = df.select("*", row_digests(df).alias("_digest"))
    return count_copies(marked.join(repeated, "_digest", "left_semi").drop("_digest")).where("copies > 1")


def duplicate_members(df: DataFrame) -> DataFrame:
    """All rows that have an identical copy, each as often as it occurs, in order of all columns."""
    members = repeat_rows(duplicate_groups(df), F.col("copies")).drop("copies")
    return members.orderBy(*[F.col(f"`{c}`") for c in df.columns])


def split_report(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows of each split, its share, and its rows per priority."""
    counts = df.groupBy("split").agg(
        _rows(weight).alias("rows"),
        *[_rows_if(F.col("priority") == p, weight).alias(p) for p in v.PRIORITIES],
    )
    share = F.round(100 * F.col("rows") / F.sum("rows").over(Window.partitionBy(F.lit(1))), 1)
    return counts.withColumn("share_pct", share)


def rates_by_dimension(
    df: DataFrame,
    flag: str,
    dimensions: list[str],
    domains: dict[str, list[str]] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Positives, total and rate of a flag overall and per value of each dimension.

    Rows are counted once per combination; the groupings are then formed from
    that small table. Values of a fixed domain that do not occur count 0, their
    rate is null.
    """
    small = df.groupBy(*dimensions).agg(
        _rows_if(F.col(flag), weight).alias("_positives"), _rows(weight).alias("_total")
    )
    sets = [[]] + [[d] for d in dimensions]
    name, value = F.lit("all"), F.lit("all")
    for d in dimensions:
        name = F.when(F.grouping(d) == 0, F.lit(d)).otherwise(name)
        value = F.when(F.grouping(d) == 0, F.col(d).cast("string")).otherwise(value)
    rates = (
        small.groupingSets([[F.col(d) for d in s] for s in sets], *dimensions)
        .agg(
            name.alias("dimension"),
            value.alias("value"),
            F.sum("_positives").alias("positives"),
            F.sum("_total").alias("total"),
        )
        .drop(*dimensions)
    )
    if domains:
        fixed = [(d, x) for d, values in domains.items() for x in values]
        absent = df.sparkSession.createDataFrame(fixed, "dimension string, value string")
        rates = rates.join(absent, ["dimension", "value"], "full").na.fill(0, ["positives", "total"])
    return rates.withColumn("rate_pct", F.round(F.try_divide(100 * F.col("positives"), F.col("total")), 1))


def quality_checks(df: DataFrame) -> DataFrame:
    """Named pass/fail checks of the labels, from one aggregate."""
    unknown = F.avg((F.col("team") == v.UNKNOWN_TEAM).cast("double")) * 100
    checks = [
        ("unknown_team_rate", F.round(unknown, 1), unknown < v.MAX_UNKNOWN_PERCENT),
        (
            "priorities_represented",
            F.count_distinct("priority").cast("double"),
            F.count_distinct("priority") == len(v.PRIORITIES),
        ),
        (
            "null_priorities",
            F.count_if(F.col("priority").isNull()).cast("double"),
            F.count_if(F.col("priority").isNull()) == 0,
        ),
    ]
    if "is_over_escalated" in df.columns:
        rate = F.avg(F.col("is_over_escalated").cast("double")) * 100
        checks.append(("over_escalation_rate", F.round(rate, 1), rate.between(2, 25)))
        if "split" in df.columns:
            for name in v.SPLITS:
                positives = F.count_if(F.col("is_over_escalated") & (F.col("split") == name))
                checks.append((f"positives_in_{name}", positives.cast("double"), positives > 0))
    cells = [
        F.struct(F.lit(name).alias("check"), value.alias("value"), passed.alias("passed"))
        for name, value, passed in checks
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
