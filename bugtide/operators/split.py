"""Exact stratified splits and reproducible samples."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import keys
from bugtide.operators.copies import repeat_rows
from bugtide.storage import written

ORDER = "_order"
# Hex digits of the order hash by which places are narrowed down, pass by pass. A
# bucket that still holds more rows than `FINE_ROWS` is cut once more before its
# hashes are ranked whole; what is large after that is equal, and counted as one.
DEPTHS = (3, 6)
WHOLE = 32
FINE_ROWS = 100_000
# Strata are listed on the driver.
MAX_STRATA = 1_000


def proportional_quotas(counts: dict[str, int], total: int) -> dict[str, int]:
    """Share out ``total`` over the strata in proportion, by largest remainder.

    Equal remainders go to the stratum whose label sorts first.
    """
    size = sum(counts.values())
    quotas = {label: counts[label] * total // size for label in counts}
    by_remainder = sorted(counts, key=lambda label: (-(counts[label] * total % size), label))
    for label in by_remainder[: total - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def split_quotas(
    counts: dict[str, int], train: float, val: float
) -> dict[str, dict[str, int]]:
    """Rows of each stratum that go to train, val and test.

    The test side of both cuts is rounded up, which fixes the overall sizes.
    """
    total = sum(counts.values())
    rest_total = math.ceil((1 - train) * total)
    in_train = proportional_quotas(counts, total - rest_total)
    rest = {label: counts[label] - in_train[label] for label in counts}
    small = sorted(label for label in counts if counts[label] < 2 or rest[label] < 2)
    if small:
        raise ValueError(f"too few rows to stratify: {', '.join(map(str, small))}")
    test_total = math.ceil((1 - val / (1 - train)) * rest_total)
    in_val = proportional_quotas(rest, rest_total - test_total)
    return {
        label: {"train": in_train[label], "val": in_val[label], "test": rest[label] - in_val[label]}
        for label in counts
    }


@dataclass
class Cut:
    """Where a position falls: the ``inside``-th of ``rows`` equal keys."""

    stratum: str
    position: int
    key: str
    inside: int
    rows: int


def _find(counts: DataFrame, positions: dict[str, list[int]]) -> list[Cut]:
    """For each wanted position of a stratum, the key it falls on.

    ``counts`` holds (stratum, key, rows); only one row per position comes back.
    """
    if not positions:
        return []
    running = F.sum("rows").over(
        Window.partitionBy("stratum").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    )
    wanted = F.create_map(
        *[
            part
            for label, places in positions.items()
            for part in (F.lit(label), F.array(*[F.lit(p).cast("bigint") for p in places]))
        ]
    )
    inside = F.col("position") - F.col("upto") + F.col("rows")
    hits = (
        counts.withColumn("upto", running)
        .withColumn("position", F.explode(F.try_element_at(wanted, F.col("stratum"))))
        .where((inside >= 1) & (inside <= F.col("rows")))
        .select("stratum", "position", "key", inside, "rows")
    )
    return [Cut(*row) for row in hits.collect()]


def _bounds(rows: DataFrame, stratum: str, positions: dict[str, list[int]], coarse: DataFrame) -> list[Cut]:
    """The exact order hash at each position, found in two or three narrow passes."""
    rough = _find(coarse, positions)
    wide = any(cut.rows > FINE_ROWS for cut in rough)
    for before, depth in zip(DEPTHS, (*DEPTHS[1:], WHOLE)) if wide else [(DEPTHS[0], WHOLE)]:
        inside: dict[str, list[int]] = {}
        for cut in rough:
            inside.setdefault(f"{cut.stratum}/{cut.key}", []).append(cut.inside)
        group = F.concat_ws("/", stratum, F.left(ORDER, F.lit(before)))
        counts = (
            rows.select(group.alias("stratum"), F.left(ORDER, F.lit(depth)).alias("key"))
            .where(F.col("stratum").isin(list(inside)))
            .groupBy("stratum", "key")
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        found = {(cut.stratum, cut.position): cut for cut in _find(counts, inside)}
        hits = [(cut, found[f"{cut.stratum}/{cut.key}", cut.inside]) for cut in rough]
        rough = [Cut(cut.stratum, cut.position, hit.key, hit.inside, hit.rows) for cut, hit in hits]
    return rough


def _split_of(stratum: str, cuts: list[Cut], quotas: dict[str, dict[str, int]]) -> Column:
    """CASE over the strata that compares the order hash with literal bounds."""
    case = None
    for label, quota in quotas.items():
        ends = {cut.position: cut.key for cut in cuts if cut.stratum == label}
        train_end, val_end = ends.get(quota["train"]), ends.get(quota["train"] + quota["val"])
        side = F.lit("test")
        if val_end is not None:
            side = F.when(F.col(ORDER) <= val_end, F.lit("val")).otherwise(side)
        if train_end is not None:
            side = F.when(F.col(ORDER) <= train_end, F.lit("train")).otherwise(side)
        condition = F.col(stratum) == label
        case = F.when(condition, side) if case is None else case.when(condition, side)
    return case


def _divided(cuts: list[Cut], quotas: dict[str, dict[str, int]]) -> dict[str, dict[str, int]]:
    """Groups of identical rows that a bound cuts through: hash -> rows per split."""
    shares = {}
    for cut in cuts:
        if cut.inside == cut.rows:
            continue
        before = cut.position - cut.inside
        ends = {"train": quotas[cut.stratum]["train"]}
        ends["val"] = ends["train"] + quotas[cut.stratum]["val"]
        ends["test"] = ends["val"] + quotas[cut.stratum]["test"]
        share, start = {}, 0
        for name in v.SPLITS:
            low, high = max(start, before), min(ends[name], before + cut.rows)
            share[name] = max(high - low, 0)
            start = ends[name]
        shares[cut.key] = share
    return shares


def _counts(rows: DataFrame, stratum: str) -> DataFrame:
    """Rows per (stratum, first digits of the order hash)."""
    first = F.left(ORDER, F.lit(DEPTHS[0])).alias("key")
    return rows.groupBy(F.col(stratum).alias("stratum"), first).agg(F.count(F.lit(1)).alias("rows"))


def _cuts(rows: DataFrame, stratum: str, quotas: dict[str, dict[str, int]], coarse: DataFrame) -> list[Cut]:
    """Where each stratum passes from train to val and from val to test."""
    positions = {}
    for label, quota in quotas.items():
        ends = {quota["train"], quota["train"] + quota["val"]} - {0}
        if ends:
            positions[label] = sorted(ends)
    return _bounds(rows, stratum, positions, coarse)


def _narrow(df: DataFrame, stratum: str, order: Column) -> DataFrame:
    return written(df.select(F.col(stratum), order.alias(ORDER)))


def _divide_tied(tied: DataFrame, shares: dict[str, dict[str, int]], names: list[str], seed: int) -> DataFrame:
    """Divide the groups of one key that a bound cuts through.

    Inside such a group rows are ordered by all their columns; identical rows are
    divided by their count.
    """
    group, keyed = "_group", tied.withColumnRenamed(ORDER, "_group")
    digest = keys.row_digest(names, str(seed))
    rows = _narrow(keyed, group, digest)
    cuts = _cuts(rows, group, shares, _counts(rows, group))
    placed = keyed.withColumn(ORDER, digest)
    whole = placed.withColumn("split", _split_of(group, cuts, shares))
    equal = _divided(cuts, shares)
    if not equal:
        return whole.select(*names, "split")
    share = F.create_map(
        *[
            part
            for key, share in equal.items()
            for part in (F.lit(key), F.create_map(*[F.lit(x) for pair in share.items() for x in pair]))
        ]
    )
    same = F.col(ORDER).isin(list(equal))
    copies = (
        placed.where(same)
        .dropDuplicates()
        .select("*", F.explode(F.element_at(share, F.col(ORDER))).alias("split", "_share"))
        .transform(lambda rest: repeat_rows(rest, F.col("_share")))
    )
    return whole.where(~same).select(*names, "split").unionByName(copies.select(*names, "split"))


def stratified_split(
    df: DataFrame,
    stratum: str = "priority",
    train: float = 0.80,
    val: float = 0.10,
    seed: int = v.SEED,
    key: str = "report_key",
) -> DataFrame:
    """Add ``split`` (train, val or test) with exact sizes per stratum.

    Rows are ordered by a hash of their stratum and key, so the outcome depends on
    the data and the seed alone. Only the stratum and that hash are stored, and a
    few aggregations over them find the hash at which each stratum passes from one
    split to the next; the assignment itself then compares with those literals, and
    no row is shuffled or ranked. Only rows that share a key on a bound are treated
    apart, ordered by all their columns.

    Runs jobs when called. More than `MAX_STRATA` strata, or one with too few rows,
    are refused.
    """
    names = df.columns
    order = keys.row_digest([stratum, key], str(seed))
    rows = _narrow(df, stratum, order)
    coarse = _counts(rows, stratum).persist()
    totals = coarse.groupBy("stratum").agg(F.sum("rows").alias("rows")).limit(MAX_STRATA + 1).collect()
    if len(totals) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} values of {stratum}")
    counts = {row["stratum"]: row["rows"] for row in totals}
    if None in counts:
        raise ValueError(f"rows without a {stratum} cannot be stratified")
    if not counts:
        return df.withColumn("split", F.lit(None).cast("string"))
    quotas = split_quotas(dict(sorted(counts.items())), train, val)
    cuts = _cuts(rows, stratum, quotas, coarse)
    coarse.unpersist()

    ordered = df.withColumn(ORDER, order)
    whole = ordered.withColumn("split", _split_of(stratum, cuts, quotas))
    shares = _divided(cuts, quotas)
    if not shares:
        return whole.drop(ORDER)
    tied = F.col(ORDER).isin(list(shares))
    divided = _divide_tied(ordered.where(tied), shares, names, seed)
    return whole.where(~tied).select(*names, "split").unionByName(divided)


def seeded_sample(df: DataFrame, n: int, key: str = "report_key", seed: int = v.SEED) -> DataFrame:
    """``n`` rows in seeded order; each task keeps only its own first ``n``."""
    order = keys.seeded_order(F.col(key), seed)
    return df.orderBy(order, key).limit(n)


def first_rows(df: DataFrame, n: int, order_by: str = "report_key") -> DataFrame:
    return df.orderBy(order_by).limit(n)


def sample_per_group(
    df: DataFrame, groups: list[str], n: int, key: str = "report_key", seed: int = v.SEED
) -> DataFrame:
    """Up to ``n`` rows of every group in seeded order.

    The drawing sees the groups, the key and its order alone: each task keeps its own
    first ``n`` of a group before anything is shuffled, so a group that holds most of
    the table costs no more than others. The rows of the drawn keys are then
    joined back; no other row's text is sorted or sent. Rows that share a key are told
    apart by all their columns.
    """
    names = [f"_group{i}" for i in range(len(groups))]
    plain = [F.col(f"`{c}`").alias(name) for c, name in zip(groups, names, strict=True)]
    narrow = df.select(*plain, F.col(key).alias("_key"), keys.seeded_order(F.col(key), seed).alias("_seeded"))
    place = F.row_number().over(Window.partitionBy(*names).orderBy("_seeded", "_key"))
    drawn = (
        narrow.withColumn("_place", place)
        .where(F.col("_place") <= n)
        .groupBy(*names, "_key")
        .agg(F.count(F.lit(1)).alias("_wanted"))
    )
    same = [F.col(f"`{c}`").eqNullSafe(F.col(name)) for c, name in zip([*groups, key], [*names, "_key"], strict=True)]
    inside = F.row_number().over(Window.partitionBy(*names, "_key").orderBy(keys.row_digest(df.columns)))
    found = df.join(drawn, reduce(and_, same)).withColumn("_inside", inside)
    return found.where(F.col("_inside") <= F.col("_wanted")).select(*[F.col(f"`{c}`") for c in df.columns])
