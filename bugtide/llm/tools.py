"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bugtide.shipping import ship_package

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """A text column as bytes; a missing text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def split_remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def numbered(df: DataFrame) -> DataFrame:
    """The same columns under names (c0, c1, ...) that no helper column has."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def in_arrow(df: DataFrame, work: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand in the tasks."""
    ship_package(df.sparkSession)

    def task(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            hand_back()

    return df.mapInArrow(task, schema)


def hand_back() -> None:
    """Give freed memory back to the system; a worker lives on and would keep it beside the next task's."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def as_bytes(texts: pa.Array) -> pa.Array:
    """A column of texts as their bytes; a missing text has none."""
    if not pa.types.is_binary(texts.type):
        texts = texts.cast(pa.string()).cast(pa.binary())
    return pc.fill_null(texts, b"")


def pieces(batch: pa.RecordBatch, column: str, most: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """A batch in slices whose texts add up to about ``most`` bytes, with those texts.

    Bounds the memory of a task when a batch holds very long texts; a single text
    is never cut. Only the texts of one slice are Python objects at a time.
    """
    texts = as_bytes(batch.column(batch.schema.get_field_index(column)))
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + n > most:
            yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
    if start < len(texts):
        yield batch.slice(start), texts.slice(start).to_pylist()


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """An Arrow list column from its flat values and the lists' lengths."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of several ranges, one after another."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - before, lengths)


def run_starts(values: np.ndarray) -> np.ndarray:
    """Indices at which a sorted array takes a new value."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def grouped(batches: Batches, column: str) -> Iterator[pa.Table]:
    """The rows of one value of an integer column after another; the rows come sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column)).to_numpy()
        starts = run_starts(values)
        for start, past in zip(starts, [*starts[1:], len(values)], strict=True):
            if held and values[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = values[start]
            held.append(batch.slice(start, past - start))
    if held:
        yield pa.Table.from_batches(held)
