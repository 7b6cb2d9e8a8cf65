"""Jump consistent hashing of stable keys to shards, in column expressions only.

The shard of a key depends on the key and the number of shards alone; no table of
shards is kept. When one shard is appended, the expected share 1/(n+1) of the keys
moves, all of them into the new shard.

Defined cases: a missing key counts as the empty text; equal keys share a shard;
rows that are equal in key, size and checksum get neighbouring slots; an empty table
gives an empty table; other columns are left alone by `with_shard`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The multiplier of the published generator (fixed value).
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF
#: Rows that a window of `with_slots` aims at.
CHUNK_ROWS = 16_384
#: Copies of one row that a task emits at once.
COPIES = 100_000


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _times_low(x: Column, factor: int) -> Column:
    """The low 32 bits (and some above) of ``x * factor``, both below 2**32."""
    high = F.shiftright(x, 16) * _long(factor)
    return x.bitwiseAND(_long(0xFFFF)) * _long(factor) + F.shiftleft(high.bitwiseAND(_long(0xFFFF)), 16)


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """One step of the 64-bit generator, on two halves so that no product overflows."""
    upper, lower = MULTIPLIER >> 32, MULTIPLIER & LOW
    a = low.bitwiseAND(_long(0xFFFF)) * _long(lower)
    b = F.shiftright(low, 16) * _long(lower)
    total = a + F.shiftleft(b.bitwiseAND(_long(LOW)), 16) + _long(1)
    carried = F.shiftright(total, 32) + F.shiftleft(F.shiftright(b, 32), 16)
    carried = carried + _times_low(high, lower) + _times_low(low, upper)
    return carried.bitwiseAND(_long(LOW)), total.bitwiseAND(_long(LOW))


def key_halves(key: str) -> tuple[Column, Column]:
    """A stable 64-bit number of any key: the first 16 digits of its text's MD5."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9))


def jump(high: Column, low: Column, shards: int) -> Column:
    """A struct of the bucket among ``shards`` and the one among ``shards + 1``.

    The bucket is the last of the increasing jump targets that lies below the
    number of buckets, so one walk answers both.
    """
    start = F.struct(
        high.alias("high"), low.alias("low"), _long(0).alias("at"), _long(0).alias("now"), _long(0).alias("grown")
    )

    def step(state: Column, _: Column) -> Column:
        high, low = _next(state["high"], state["low"])
        factor = F.lit(2.0**31) / (F.shiftright(high, 1) + 1).cast("double")
        walked = F.struct(
            high.alias("high"),
            low.alias("low"),
            F.floor((state["at"] + 1).cast("double") * factor).cast("bigint").alias("at"),
            F.when(state["at"] < shards, state["at"]).otherwise(state["now"]).alias("now"),
            state["at"].alias("grown"),
        )
        return F.when(state["at"] <= shards, walked).otherwise(state)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(shards)),
        start,
        step,
        lambda s: F.struct(s["now"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown_shard")),
    )


def with_shard(df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """Every row with its shard, and with the shard it would have with one more.

    A projection: rows stay where they are.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    names = [c for c in df.columns if c not in (shard, grown)]
    placed = df.withColumn("_jump", jump(*key_halves(key), shards))
    return placed.select(*names, F.col("_jump.shard").alias(shard), F.col("_jump.grown_shard").alias(grown))


def with_slots(df: DataFrame, group: str, slot: str = "slot", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    Equal rows are counted before the shuffle. Distinct rows are dealt by their hash
    into chunks whose number follows the table; chunk totals give each chunk its
    first slot, so no window holds a whole group.
    """
    names = df.columns
    bits = max(0, math.ceil(math.log2(max(1, df.count() / chunk_rows))))
    order = F.xxhash64(*names)
    rows = (
        df.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_order", order)
        .withColumn("_chunk", F.pmod(F.col("_order"), _long(1 << bits)))
    )
    totals = rows.groupBy(group, "_chunk").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col(group).alias("_group"),
        F.col("_chunk").alias("_in"),
        F.coalesce(F.sum("_rows").over(before), _long(0)).alias("_first"),
    )
    within = Window.partitionBy(group, "_chunk").orderBy("_order", *names)
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.join(
        totals, rows[group].eqNullSafe(F.col("_group")) & (F.col("_chunk") == F.col("_in"))
    ).withColumn("_first", F.col("_first") + F.coalesce(F.sum("_n").over(within), _long(0)))
    starts = F.explode(F.sequence(_long(0), F.col("_n") - 1, _long(COPIES)))
    return (
        numbered.withColumn("_start", starts)
        .repartition("_order", "_start")
        .withColumn("_copy", F.explode(F.sequence(F.col("_start"), F.least(F.col("_n"), F.col("_start") + COPIES) - 1)))
        .select(*names, (F.col("_first") + F.col("_copy")).alias(slot))
    )


def shard_table(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, checksum, shard and slot of every row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = docs.select(
        key,
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return with_slots(with_shard(narrow, key, shards), "shard")
