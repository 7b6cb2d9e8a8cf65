"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.catalogue import adapters
from bugtide.functions import labels, times
from bugtide.functions import text as tx
from bugtide.operators import dedup, evaluate, labelling, profile, scoring, split, tokens, unify
from bugtide.plans import dataset, evaluation, ingest, reports
from bugtide.sources import tables
from bugtide.storage import release, scratch_folder, stored, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- unify and label ---------------------------------------------------------


@query
def unify_sources(spark, sf_dir):
    return adapters.unified(spark, sf_dir)


@query
def unify_timestamped(spark, sf_dir):
    return unify.unify_timestamped(adapters.timestamped_raw(spark, sf_dir))


@query
def rename_and_drop(spark, sf_dir):
    raw = adapters.tracker_raw(spark, sf_dir).withColumns(
        {"Status": F.lit("Closed"), "Affects Version/s": F.lit("1.0")}
    )
    exported = unify.to_export_names(raw)
    return exported.transform(unify.to_canonical_names).transform(unify.drop_unused)


@query
def missing_values(spark, sf_dir):
    raw = adapters.tracker_raw(spark, sf_dir, text=False, times=False).select("id", "priority", "resolution")
    k = F.col("id").cast("bigint")
    dirty = raw.withColumn(
        "resolution", F.coalesce("resolution", adapters.by_remainder(k, ["NaN", "N/A", "", "null", "none"]))
    )
    return unify.missing_to_null(dirty)


@query
def priority_normalise(spark, sf_dir):
    rows = adapters.unified(spark, sf_dir).transform(labelling.normalise_priority)
    return rows.transform(labelling.require_priority).select(
        "report_key", "source", "raw_severity", "raw_priority", "priority"
    )


@query
def priority_strict(spark, sf_dir):
    raw = adapters.tracker_raw(spark, sf_dir, text=False, times=False)
    return raw.select("id", labels.strict_priority(F.col("priority")).alias("priority_mapped"))


@query
def team_assign(spark, sf_dir):
    rows = adapters.unified(spark, sf_dir).transform(labelling.assign_team)
    return rows.select("report_key", "source", "project", "team")


@query
def team_of_documents(spark, sf_dir):
    docs = adapters.text_table(spark, sf_dir, "documents", "doc_id")
    return docs.select("doc_id", labels.team(F.lit(""), F.col("text"), F.col("text")).alias("team"))


@query
def label_engineering(spark, sf_dir):
    return adapters.labelled(spark, sf_dir)


@query
def load_all_sources(spark, sf_dir):
    """All three sources as they are stored, the tracker's table in CSV."""
    root = adapters.stored_sources(spark, sf_dir)
    return tables.load_all(spark, f"{root}/bugzilla", f"{root}/tracker", f"{root}/timestamped")


@query
def load_required_source(spark, sf_dir):
    """The required source alone, where the optional ones are missing."""
    root = adapters.stored_sources(spark, sf_dir, optional=False)
    return tables.load_all(spark, f"{root}/bugzilla", f"{root}/none", f"{root}/neither")


# --- tracker folders ---------------------------------------------------------


def _ingested(spark, sf_dir, out=None):
    """All tables of the job. The exports, which were made for it and have been read, go."""
    before = stored()
    exports = adapters.tracker_folders(spark, sf_dir)
    made = stored()
    found = ingest.ingest_trackers(spark, exports, out, gzipped=True)
    release(spark, since=before, keep=stored() - made)
    return found


@query
def ingest_reports(spark, sf_dir):
    return _ingested(spark, sf_dir).reports


@query
def ingest_cleaned(spark, sf_dir):
    cleaned = _ingested(spark, sf_dir).cleaned
    return cleaned.transform(unify.to_canonical_names).withColumnRenamed("Affects Version/s", "versions")


@query
def ingest_statistics(spark, sf_dir):
    statistics = _ingested(spark, sf_dir).statistics
    # A project's reports come in as many files as tasks wrote them.
    return statistics.groupBy(F.substring_index("pair", "/", 1).alias("project")).agg(
        *[F.sum(c).alias(c) for c in ("before_rows", "after_rows", "removed_rows")],
        F.max("listed_ids").alias("listed_ids"),
        *[F.max(c).alias(c) for c in ("bug_id_column", "issue_column", "duplicate_column")],
    )


@query
def ingest_merged(spark, sf_dir):
    """The merged CSV, read back as published; the tables stored on the way go."""
    out, before = scratch_folder(spark), stored()
    _ingested(spark, sf_dir, out)
    release(spark, since=before)
    merged = tables.read_table(spark, f"{out}/merged", "csv")
    return merged.transform(unify.to_canonical_names).withColumnRenamed("Affects Version/s", "versions")


@query
def ingest_rejected(spark, sf_dir):
    """The records set aside, and how many of their file's were read."""
    found = ingest.ingest_trackers(spark, adapters.damaged_folders(spark, sf_dir))
    kept = found.statistics.select("pair", "before_rows", "rejected_records")
    rejected = found.rejected.join(kept, "pair")
    return rejected.select(F.substring_index("pair", "/", 1).alias("project"), "kind", "record", "before_rows", "rejected_records")


# --- text --------------------------------------------------------------------


@query
def clean_html(spark, sf_dir):
    cleaned = tx.clean_text(F.col("html"))
    pages = adapters.text_table(spark, sf_dir, "pages", "page_id")
    return pages.select("page_id", "url", cleaned.alias("cleaned")).select(
        "page_id", tx.clean_text(F.col("url")).alias("url"), "cleaned",
        tx.truncate_words(F.col("cleaned")).alias("body"),
    )


@query
def stack_truncate(spark, sf_dir):
    rows = adapters.trace_bodies(spark, sf_dir)
    return rows.select("id", tx.shorten_stack_traces(F.col("body")).alias("body"))


@query
def word_truncate(spark, sf_dir):
    docs = adapters.text_table(spark, sf_dir, "documents", "doc_id")
    cut = docs.withColumn("body", tx.truncate_words(F.col("text")))
    return cut.select(
        "doc_id",
        tx.word_count(F.col("text")).cast("bigint").alias("words"),
        tx.word_count(F.col("body")).cast("bigint").alias("kept_words"),
        "body",
    )


# --- duplicates, filters, durations ------------------------------------------


@query
def dedup_subtract(spark, sf_dir):
    ids = dedup.listed_ids(adapters.duplicate_lists(spark, sf_dir))
    return dedup.subtract_listed(adapters.tracker_raw(spark, sf_dir), ids, sieve=True)


@query
def dedup_stats(spark, sf_dir):
    ids = dedup.listed_ids(adapters.duplicate_lists(spark, sf_dir))
    bugs = adapters.tracker_raw(spark, sf_dir, text=False, times=False)
    return dedup.subtraction_statistics(bugs, ids).drop("scope")


@query
def priority_filter(spark, sf_dir):
    raw = adapters.tracker_raw(spark, sf_dir)
    return raw.transform(unify.with_real_priority).transform(unify.resolved_only)


@query
def closed_without_resolution(spark, sf_dir):
    closed = unify.closed_without_resolution(adapters.tracker_raw(spark, sf_dir, text=False))
    return profile.closed_without_resolution_counts(closed)


@query
def closed_without_resolution_rows(spark, sf_dir):
    closed = unify.closed_without_resolution(adapters.tracker_raw(spark, sf_dir, text=False))
    return closed.where(F.col("project") == "Derby").select("id", "project", "closed_at")


@query
def resolution_days(spark, sf_dir):
    raw = adapters.tracker_raw(spark, sf_dir, text=False)
    opened, closed = F.col("created_at"), F.col("closed_at")
    return raw.select(
        "id",
        times.elapsed_days(opened, closed).alias("elapsed_days"),
        times.whole_days(opened, closed).alias("whole_days"),
    )


@query
def resolution_summary(spark, sf_dir):
    rows = adapters.unified(spark, sf_dir).transform(unify.with_valid_duration)
    return profile.duration_summary(rows)


# --- over-escalation ---------------------------------------------------------


def _flagged(spark, sf_dir):
    return labelling.flag_over_escalation(adapters.tracker_raw(spark, sf_dir, text=False))


@query
def over_escalation(spark, sf_dir):
    return _flagged(spark, sf_dir).select(
        "id", "priority_mapped", "resolution_clean", "is_top_priority", "is_non_fix", "is_slow", "is_over_escalated"
    )


@query
def over_escalated_rows(spark, sf_dir):
    flagged = labelling.flag_over_escalation(adapters.tracker_raw(spark, sf_dir))
    return labelling.over_escalated_rows(flagged)


@query
def over_escalation_counts(spark, sf_dir):
    flags = ["is_top_priority", "is_non_fix", "is_slow", "is_over_escalated"]
    return profile.flag_counts(_flagged(spark, sf_dir), flags)


@query
def over_escalation_rates(spark, sf_dir):
    flagged = _flagged(spark, sf_dir).withColumn(
        "priority", labels.tracker_priority(F.col("priority"))
    )
    rows = flagged.withColumn("project", F.coalesce("project", F.lit("")))
    return profile.rates_by_dimension(
        rows, "is_over_escalated", ["project", "priority"], {"priority": v.PRIORITIES}
    )


@query
def escalation_pairs(spark, sf_dir):
    drawn = reports.escalation_pairs(_flagged(spark, sf_dir))
    return drawn.select("id", "project", "is_over_escalated", "priority_mapped", "resolution_clean", "elapsed_days")


# --- split and samples -------------------------------------------------------


def _split_labels(spark, sf_dir):
    """The labels, computed once, and their splits."""
    stored = written(adapters.with_team(spark, sf_dir).select("report_key", "priority"))
    return split.stratified_split(stored)


@query
def stratified_split(spark, sf_dir):
    return _split_labels(spark, sf_dir).select("report_key", "priority", "split")


@query
def split_report(spark, sf_dir):
    return profile.split_report(_split_labels(spark, sf_dir))


@query
def stored_splits(spark, sf_dir):
    return tables.read_splits(spark, adapters.stored_splits(spark, sf_dir), *v.SPLITS)


@query
def over_escalation_by_split(spark, sf_dir):
    """Rates by source, priority and split, priorities that do not occur included."""
    late = F.coalesce(F.col("resolution_time_days") > v.OVER_ESCALATION_DAYS, F.lit(False))
    unfixed = F.upper(F.trim("resolution")).isin(v.NON_FIX_RESOLUTIONS)
    urgent = F.col("priority").isin(v.TOP_PRIORITIES)
    splits = tables.read_splits(spark, adapters.stored_splits(spark, sf_dir))
    flagged = splits.withColumn("is_over_escalated", urgent & unfixed & late)
    return reports.profile_tables(flagged)["over_escalation"]()


# The samples are drawn before the text is cleaned: neither the order nor the
# groups depend on clean text, and only the drawn reports need it.


@query
def seeded_sample(spark, sf_dir):
    drawn = split.seeded_sample(adapters.unified(spark, sf_dir), v.SPOT_CHECK_ROWS)
    return labelling.label_reports(drawn).select(
        "report_key", "source", "title", "team", "priority",
        tx.preview(F.col("body"), 100).alias("body_preview"),
    )


@query
def group_sample(spark, sf_dir):
    teams = adapters.unified(spark, sf_dir).transform(labelling.assign_team)
    drawn = split.sample_per_group(teams, ["team"], 10).transform(labelling.clean_texts)
    return drawn.select(
        "report_key", "team", tx.preview(F.col("title"), 100).alias("title"),
        tx.preview(F.col("body"), 200, "(empty)").alias("body"),
    )


# --- prompts and tokens ------------------------------------------------------


@query
def prompt_text(spark, sf_dir):
    rows = tokens.with_prompt_text(adapters.with_team(spark, sf_dir))
    return rows.select("report_key", "prompt", "completion", "full_text")


@query
def training_sample(spark, sf_dir):
    return tables.training_sample(adapters.with_team(spark, sf_dir))


@query
def tokenise_mask(spark, sf_dir):
    rows = tokens.tokenise(adapters.with_team(spark, sf_dir))

    def total(name, *dropped):
        kept = reduce(F.array_remove, map(F.lit, dropped), F.col(name))
        return F.size(kept).cast("bigint")

    return rows.select(
        "report_key", "priority", "team", "source", "id",
        F.size("input_ids").cast("bigint").alias("length"),
        total("input_ids", tokens.PAD).alias("n_tokens"),
        total("attention_mask", 0).alias("n_attended"),
        (total("labels") - total("labels", v.MASKED_LABEL)).alias("n_masked"),
        total("labels", v.MASKED_LABEL, tokens.PAD).alias("n_learned"),
        F.array_position("labels", 0).alias("first_pad_label"),
        F.length("full_text").cast("bigint").alias("full_text_chars"),
        "labels_all_masked",
    )


@query
def tokenise_ids(spark, sf_dir):
    """The ids, masks and labels of all three splits, as stored, one text per list."""
    folder = scratch_folder(spark)
    dataset.build_prompt_dataset(spark, adapters.stored_splits(spark, sf_dir), folder)
    stored = tables.read_table(spark, folder)

    def listed(name):
        return F.array_join(F.col(name).cast("array<string>"), " ").alias(name)

    return stored.select("report_key", "split", *map(listed, ("input_ids", "attention_mask", "labels")))


@query
def masked_rows_audit(spark, sf_dir):
    rows = tokens.tokenise(adapters.with_team(spark, sf_dir))
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("labels_all_masked").alias("all_masked"),
        F.max("prompt_length").cast("bigint").alias("longest_prompt"),
    )


@query
def prompt_samples(spark, sf_dir):
    return reports.sample_prompts(split.stratified_split(adapters.with_team(spark, sf_dir)))


# --- profile and audit -------------------------------------------------------


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(adapters.labelled(spark, sf_dir), "team")


@query
def priority_domain_counts(spark, sf_dir):
    return profile.domain_counts(adapters.labelled(spark, sf_dir))


@query
def source_priority_pivot(spark, sf_dir):
    return profile.count_pivot(adapters.labelled(spark, sf_dir), "source", "priority", v.PRIORITIES)


def _bugzilla(spark, sf_dir, endings=None):
    return labelling.label_reports(unify.unify_bugzilla(adapters.bugzilla_raw(spark, sf_dir, endings)))


def _profile(spark, sf_dir, name):
    splits = tables.read_splits(spark, adapters.stored_splits(spark, sf_dir), *v.SPLITS)
    return reports.profile_tables(splits)[name]()


def _plan_query(name, table, run):
    """Register one table of a plan."""

    def found(spark, sf_dir):
        return run(spark, sf_dir, table)

    found.__name__ = name
    query(found)


# The tables of the two plans, as each of them gives them.
_plan_query("profile_sources", "priority_by_source", _profile)
_plan_query("profile_source_counts", "sources", _profile)
for _table in [
    "shape", "priorities", "teams", "durations", "word_counts", "duplicates", "splits",
    "histogram_resolution_time_days", "histogram_title_words", "histogram_body_words",
]:
    _plan_query(f"profile_{_table}", _table, _profile)


@query
def profile_duplicate_groups(spark, sf_dir):
    """Repeated documents as the plan finds them in a table of reports."""
    docs = adapters.table(spark, sf_dir, "documents")
    reports_of = docs.select(
        F.col("source"), F.lit("P3").alias("priority"), F.col("lang").alias("team"), F.lit("train").alias("split"),
        F.lit("").alias("title"), F.col("text").alias("body"), F.lit(0.0).alias("resolution_time_days"),
    )
    return reports.profile_tables(reports_of)["duplicate_groups"]().select("source", "team", "body", "copies")


def _audit(spark, sf_dir, name):
    return reports.audit_labels(tables.read_splits(spark, adapters.stored_splits(spark, sf_dir)))[name]


for _table in [
    "severity_crosstab", "severity_mapping", "teams", "team_coverage", "hedging", "priority_distribution",
    "team_distribution", "checks",
]:
    _plan_query(f"audit_{_table}", _table, _audit)


@query
def audit_spot_check(spark, sf_dir):
    return _audit(spark, sf_dir, "spot_check").select("report_key", "title", "body", "team", "priority")


@query
def severity_crosstab(spark, sf_dir):
    return profile.count_pivot(_bugzilla(spark, sf_dir), "raw_severity", "priority", v.PRIORITIES)


@query
def severity_map_check(spark, sf_dir):
    return profile.mapping_check(_bugzilla(spark, sf_dir))


@query
def team_coverage(spark, sf_dir):
    return profile.team_coverage(adapters.labelled(spark, sf_dir))


@query
def unknown_rate(spark, sf_dir):
    return profile.unknown_rate(adapters.labelled(spark, sf_dir))


@query
def priority_distribution_by_source(spark, sf_dir):
    return profile.distribution_by(adapters.labelled(spark, sf_dir), "priority", domain=v.PRIORITIES)


@query
def team_distribution_by_source(spark, sf_dir):
    return profile.distribution_by(
        adapters.labelled(spark, sf_dir), "team", domain=[*v.TEAMS, v.UNKNOWN_TEAM]
    )


@query
def text_length_stats(spark, sf_dir):
    return profile.word_count_summary(profile.with_word_counts(adapters.with_team(spark, sf_dir)))


def _histogram(df, column):
    cap, bins = v.HISTOGRAMS[column]
    return profile.histogram(df, column, cap, bins)


@query
def title_length_histogram(spark, sf_dir):
    return _histogram(profile.with_word_counts(adapters.with_team(spark, sf_dir)), "title_words")


@query
def body_length_histogram(spark, sf_dir):
    return _histogram(profile.with_word_counts(adapters.with_team(spark, sf_dir)), "body_words")


@query
def resolution_histogram(spark, sf_dir):
    raw = adapters.tracker_raw(spark, sf_dir, text=False)
    days = times.whole_days(F.col("created_at"), F.col("closed_at"))
    return _histogram(
        raw.select(days.alias("resolution_time_days")).transform(unify.with_valid_duration),
        "resolution_time_days",
    )


@query
def hedging_frequency(spark, sf_dir):
    endings = [" appears to", " not sure", " might", " mighty", " seems", ""]
    reports = _bugzilla(spark, sf_dir, endings)
    return profile.phrase_counts(unify.top_priority(unify.of_source(reports, v.BUGZILLA)))


@query
def duplicate_audit(spark, sf_dir):
    return profile.duplicate_summary(adapters.table(spark, sf_dir, "documents").select("text"))


@query
def duplicate_members(spark, sf_dir):
    texts = adapters.table(spark, sf_dir, "documents").select("text", "lang", "source")
    return profile.duplicate_members(texts)


@query
def label_quality_checks(spark, sf_dir):
    return profile.quality_checks(adapters.labelled(spark, sf_dir))


@query
def distinct_resolutions(spark, sf_dir):
    return profile.distinct_values(
        adapters.tracker_raw(spark, sf_dir, text=False, times=False), "resolution"
    )


@query
def table_shape(spark, sf_dir):
    return profile.shape(adapters.labelled(spark, sf_dir).drop("report_key"))


# --- evaluation --------------------------------------------------------------


def _truth(spark, sf_dir):
    return adapters.with_team(spark, sf_dir)


def _labels(spark, sf_dir):
    """The labels without the text, stored, as both sides of the join need them."""
    return written(_truth(spark, sf_dir).select("report_key", "id", "priority", "team"))


def _counts(spark, sf_dir):
    truth = _labels(spark, sf_dir)
    return evaluate.outcome_counts_by_key(truth, adapters.model_outputs(truth))


@query
def parse_outputs(spark, sf_dir):
    return evaluate.parse_outputs(adapters.model_outputs(_truth(spark, sf_dir)))


@query
def parse_failure_rate(spark, sf_dir):
    parsed = evaluate.parse_outputs(adapters.model_outputs(_truth(spark, sf_dir)))
    return evaluate.parse_failure_rate(parsed)


@query
def alignment_gaps(spark, sf_dir):
    truth = _labels(spark, sf_dir)
    outputs = adapters.model_outputs(truth.where(F.col("id").cast("bigint") % 100 != 0))
    return evaluate.alignment_gaps(truth, outputs)


@query
def severity_f1(spark, sf_dir):
    return evaluate.per_class_f1(_counts(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_counts(spark, sf_dir))


@query
def critical_errors(spark, sf_dir):
    return evaluate.critical_errors(evaluate.confusion_matrix(_counts(spark, sf_dir)))


@query
def metrics_summary(spark, sf_dir):
    truth = _labels(spark, sf_dir)
    return evaluate.evaluate(truth, adapters.model_outputs(truth)).drop("per_class_f1", "confusion_matrix")


@query
def metrics_incomplete(spark, sf_dir):
    truth = _labels(spark, sf_dir)
    outputs = adapters.model_outputs(truth.where(F.col("id").cast("bigint") % 100 != 0))
    return evaluate.evaluate(truth, outputs, gaps="failure").drop("per_class_f1", "confusion_matrix")


@query
def metrics_repeated_keys(spark, sf_dir):
    truth = _labels(spark, sf_dir)
    found = evaluate.evaluate(truth.unionByName(truth), adapters.model_outputs(truth))
    return found.drop("per_class_f1", "confusion_matrix")


@query
def prediction_report(spark, sf_dir):
    truth = written(_truth(spark, sf_dir))
    return evaluate.prediction_report(evaluate.align(truth, adapters.model_outputs(truth)))


@query
def score_reports(spark, sf_dir):
    scored = scoring.score_reports(_truth(spark, sf_dir))
    return scored.select("report_key", "priority", "team", "raw_output")


@query
def scored_metrics(spark, sf_dir):
    report = evaluate.prediction_report(scoring.score_reports(_truth(spark, sf_dir)))
    return evaluate.per_class_f1(evaluate.outcome_counts(report))


@query
def evaluated_split(spark, sf_dir):
    _, metrics = evaluation.evaluate_split(spark, adapters.stored_splits(spark, sf_dir), "val")
    return metrics.drop("per_class_f1", "confusion_matrix")


@query
def evaluated_report(spark, sf_dir):
    report, _ = evaluation.evaluate_split(spark, adapters.stored_splits(spark, sf_dir), "test")
    return report


@query
def published_report(spark, sf_dir):
    """The prediction report of a split as published in CSV."""
    path = f"{scratch_folder(spark)}/report"
    evaluation.evaluate_split(spark, adapters.stored_splits(spark, sf_dir), "val", report_path=path)
    return tables.read_table(spark, path, "csv")
