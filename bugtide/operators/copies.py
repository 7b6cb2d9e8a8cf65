"""Counting and emitting identical rows without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 100_000


def repeat_rows(df: DataFrame, times: Column, chunk: int = CHUNK) -> DataFrame:
    """Emit every row ``times`` times.

    A row with a large count is first cut into chunks, and the chunks are spread
    over the cluster, so no task emits more than ``chunk`` copies in one go.
    """
    names = df.columns
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(chunk).cast("bigint")))
    return (
        df.withColumn("_n", times.cast("bigint"))
        .where("_n > 0")
        .withColumn("_start", starts)
        .withColumn("_size", F.least(F.col("_n") - F.col("_start"), F.lit(chunk)).cast("int"))
        .repartition("_start", *names)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_size"))))
        .select(*names)
    )


def count_copies(df: DataFrame, count: str = "copies") -> DataFrame:
    """Each distinct row once, with the number of times it occurs.

    Copies are added up on the map side, so even one row that makes up a third of
    the table reaches the shuffle once per task. Nulls count as equal.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))
