"""Bring the three tracker shapes to one schema, and filter and rename raw exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugtide import vocabulary as v
from bugtide.functions import keys, times


def _no_time() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _time(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    if isinstance(kind, T.TimestampType):
        return times.from_instant(F.col(name))
    return times.parse_utc(F.col(name).cast("string"))


def _unified(df: DataFrame, **columns: Column) -> DataFrame:
    """Select the unified columns plus ``report_key`` in their fixed order."""
    days = times.whole_days(F.col("created_at"), F.col("closed_at"))
    key = keys.report_key(*(F.col(c) for c in ("source", "project", "id", "title", "body")))
    base = df.select(*[columns[c].alias(c) for c in v.UNIFIED_COLUMNS if c in columns])
    return base.withColumns({"resolution_time_days": days, "report_key": key}).select(
        *v.UNIFIED_COLUMNS, "report_key"
    )


def unify_bugzilla(df: DataFrame, source: str = v.BUGZILLA) -> DataFrame:
    """One-line Bugzilla reports: no body, no times, severity instead of priority."""
    return _unified(
        df,
        id=F.col("Bug ID").cast("string"),
        source=F.lit(source),
        title=_text("Short Description"),
        body=F.lit(""),
        raw_severity=F.lower(_text("Severity Label")),
        raw_priority=F.lit(""),
        resolution=F.coalesce(F.lower(F.col("Resolution Status")), F.lit("fixed")),
        project=_text("Project"),
        created_at=_no_time(),
        closed_at=_no_time(),
    )


def unify_tracker(df: DataFrame, source: str = v.TRACKER) -> DataFrame:
    """Issue-tracker reports in the canonical column names."""
    require_columns(df, v.TRACKER_COLUMNS)
    return _unified(
        df,
        id=F.col("id").cast("string"),
        source=F.lit(source),
        title=_text("title"),
        body=_text("body"),
        raw_severity=F.lit(""),
        raw_priority=F.upper(_text("priority")),
        resolution=F.lower(_text("resolution")),
        project=_text("project"),
        created_at=_time(df, "created_at"),
        closed_at=_time(df, "closed_at"),
    )


def unify_timestamped(df: DataFrame, source: str = v.TIMESTAMPED) -> DataFrame:
    """Reports closed by a commit, whose time is given in epoch seconds."""
    return _unified(
        df,
        id=F.col("bug_id").cast("string"),
        source=F.lit(source),
        title=_text("summary"),
        body=_text("description"),
        raw_severity=F.lit(""),
        raw_priority=F.lit(""),
        resolution=F.lower(_text("status")),
        project=_text("project_name"),
        created_at=_time(df, "report_time"),
        closed_at=times.from_epoch_seconds(F.col("commit_timestamp").cast("string")),
    )


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def append(*frames: DataFrame | None) -> DataFrame:
    """Rows of all the frames that are there, columns matched by name."""
    present = [frame for frame in frames if frame is not None]
    if not present:
        raise ValueError("no source to append")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def missing_to_null(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Turn the usual spellings of a missing value into null, in text columns but those to ``keep``."""
    text = {field.name for field in df.schema if isinstance(field.dataType, T.StringType)} - set(keep or [])
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(v.NA_TOKENS), F.col(f"`{c}`")).alias(c)
            if c in text
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def to_canonical_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(v.EXPORT_TO_CANONICAL)


def to_export_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({new: old for old, new in v.EXPORT_TO_CANONICAL.items()})


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*v.UNUSED_EXPORT_COLUMNS)


def with_real_priority(df: DataFrame, column: str = "priority") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != v.PLACEHOLDER_PRIORITY))


def resolved_only(df: DataFrame, column: str = "resolution") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def of_source(df: DataFrame, source: str) -> DataFrame:
    return df.where(F.col("source") == source)


def with_valid_duration(df: DataFrame) -> DataFrame:
    return df.where(F.col("resolution_time_days") >= 0)


def top_priority(df: DataFrame, column: str = "priority") -> DataFrame:
    return df.where(F.col(column).isin(v.TOP_PRIORITIES))


def closed_without_resolution(df: DataFrame) -> DataFrame:
    return df.where(F.col("resolution").isNull() & F.col("closed_at").isNotNull())
