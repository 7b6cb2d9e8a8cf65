"""From unified reports to stored splits and token sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bugtide.operators import labelling, split, tokens
from bugtide.sources import output, tables
from bugtide.storage import written


def prepare_dataset(unified: DataFrame, path: str | None = None) -> DataFrame:
    """Label, drop reports without a team, split, and store by split.

    The labelled reports are stored before they are split, so that the sources are read
    and the labels computed once; finding the bounds then reads two narrow columns.
    """
    labelled = written(labelling.label_reports(unified).transform(labelling.drop_unknown_team))
    splits = split.stratified_split(labelled)
    if path:
        output.replace(splits.sparkSession, path, lambda staged: tables.write_splits(splits, staged))
    return splits


def build_prompt_dataset(
    spark: SparkSession,
    splits_path: str,
    path: str | None = None,
    make_encoder: Callable[[], tokens.Encode] | None = None,
) -> DataFrame:
    """Token ids, masks and labels of all three splits, which must exist."""
    rows = tables.read_splits(spark, splits_path, "train", "val", "test")
    encoded = tokens.tokenise(rows, make_encoder=make_encoder)
    if path:
        output.replace(spark, path, lambda staged: tables.write_tokens(encoded, staged))
    return encoded
