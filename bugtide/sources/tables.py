"""Reading and writing tables: raw sources, splits, token sets and reports."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugtide.functions import prompts
from bugtide.operators import unify
from bugtide.operators.split import first_rows
from bugtide.operators.unify import missing_to_null


def read_table(
    spark: SparkSession, path: str, layout: str = "parquet", optional: bool = False
) -> DataFrame | None:
    """A raw source. A missing optional one gives None, a required one raises.

    CSV is read as text throughout, so ids keep their spelling.
    """
    reader = spark.read
    if layout == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST")
    try:
        df = reader.format(layout).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if optional:
            return None
        raise FileNotFoundError(path) from error
    return missing_to_null(df) if layout == "csv" else df


def load_all(
    spark: SparkSession,
    bugzilla: str,
    tracker: str | None = None,
    timestamped: str | None = None,
    layout: str = "parquet",
    tracker_layout: str = "csv",
) -> DataFrame:
    """All sources that exist, in the unified schema."""
    frames = [unify.unify_bugzilla(read_table(spark, bugzilla, layout))]
    if tracker:
        raw = read_table(spark, tracker, tracker_layout, optional=True)
        frames.append(unify.unify_tracker(raw) if raw is not None else None)
    if timestamped:
        raw = read_table(spark, timestamped, layout, optional=True)
        frames.append(unify.unify_timestamped(raw) if raw is not None else None)
    return unify.append(*frames)


#: A task that writes to at most so many folders keeps a file open in each.
OPEN_FOLDERS = 20


@contextmanager
def _open_folders(spark: SparkSession) -> Iterator[None]:
    """While this lasts, rows are not sorted by folder before they are written, which would sort whole texts.

    A task that meets more folders sorts the rest of its rows.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_splits(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """One Parquet folder per split, so that reading one split skips the others.

    Each task writes to all three folders. ``rebalance`` adds a shuffle that fills
    files evenly, and divides the large split over many tasks.
    """
    if rebalance:
        df = df.hint("rebalance", "split")
    with _open_folders(df.sparkSession):
        df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str, *splits: str) -> DataFrame:
    """The named splits, or all of them; a split that was never written raises."""
    df = read_table(spark, path)
    for name in splits:
        read_table(spark, f"{path}/split={name}")
    return df.where(F.col("split").isin(list(splits))) if splits else df


# The writer would otherwise trim values, and prompts end in a line break.
CSV_OUT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    # Texts may hold line breaks, so a file is read by one task, whatever its size.
    "maxRecordsPerFile": 20_000,
    # Of gzip, if a table is written so.
    "zlib.compress.level": "BEST_SPEED",
}


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").options(**CSV_OUT).csv(path, compression=compression)


def write_csv_by_project(df: DataFrame, path: str, compression: str = "none") -> None:
    """One folder per project; the project column stays in the files' path only."""
    df.write.mode("overwrite").options(**CSV_OUT).partitionBy("source_project").csv(path, compression=compression)


def training_sample(train: DataFrame, n: int = 100, order_by: str = "report_key") -> DataFrame:
    """Prompt, expected answer and both together for the first ``n`` reports."""
    first = first_rows(train, n, order_by)
    prompt = prompts.prompt(F.col("title"), F.col("body"))
    answer = prompts.completion(F.col("priority"), F.col("team"))
    return first.select(
        prompt.alias("input_prompt"),
        answer.alias("expected_output"),
        F.concat(prompt, answer).alias("full_string"),
    )


def write_tokens(df: DataFrame, path: str) -> None:
    with _open_folders(df.sparkSession):
        df.write.mode("overwrite").partitionBy("split").parquet(path)


