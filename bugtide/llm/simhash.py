"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower
case, shingles of three words joined by a blank (all words, if fewer), XXH64 with seed
42 of each; a bit is 1 if set in over half of the hashes. A text without words has
fingerprint zero. Fingerprints link at three or fewer differing bits, and documents
belong together if a chain of links joins them.

Search: correlated bits are put into the same part (greedily, by the correlations in
a bounded sample of fingerprints). If two fingerprints differ in at most `t` bits, and
part i has a threshold t_i with sum(t_i + 1) = t + 1, some part differs in at most
t_i bits. A dynamic programme chooses the thresholds, -1 (part unused) included, that
cost least by the candidates and probes estimated from the sample; the number of
parts is chosen by the same estimate. A threshold t_i is probed by leaving out every
t_i bits of the part: two values within t_i bits agree on at least one remainder.
The choice changes the cost only: every choice finds every link.

Copies: equal fingerprints are merged before the search. A bucket (same probe value)
of more than `CELL` fingerprints is cut into blocks, and pairs of blocks are
compared in different tasks; a task returns a forest of what it linked, never the
pairs. Components are then joined by alternating star contraction.

Defined cases: missing and empty texts have fingerprint zero and link like any other;
repeated rows are in the same component; rows without an id belong to a component but
never name it (its id is missing only if no row has one); an empty table gives an
empty table; extra columns are ignored by `near_duplicates`, kept by `keep_one`.
"""

from __future__ import annotations

import math
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from bugtide.llm.tools import Batches, in_arrow, numbered, pieces, run_starts, utf8
from bugtide.storage import written

BITS = 64
SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Fingerprints from which correlations and candidate numbers are estimated.
SAMPLE = 4096
#: Fingerprints of a bucket that are compared in one block.
CELL = 2048
PARTS = range(2, 9)
#: Shingles whose bits are counted at once.
SHINGLES = 65_536
#: Bytes of text that a task holds as Python objects.
SLICE = 2_000_000


def fingerprint(text: bytes) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
        n = len(words) - SHINGLE + 1
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, SHINGLES):
        part = hashes[at : at + SHINGLES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, fingerprint (as a signed number) and a digest of the text."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for rows, texts in pieces(batch, "_text", SLICE):
                prints = [fingerprint(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(prints, pa.int64()), rows.column(2)], names=["_key", "_print", "_digest"]
                )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("_key"), utf8(text).alias("_text"), F.xxhash64(text).alias("_digest"))
    return in_arrow(narrow, work, f"_key {kind}, _print bigint, _digest bigint")


def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def correlated_parts(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size, the correlated ones together."""
    table = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    table -= table.mean(axis=0)
    spread = np.maximum(table.std(axis=0), 1e-9)
    likeness = np.abs(table.T @ table) / (len(table) * spread[:, None] * spread[None, :])
    np.fill_diagonal(likeness, 0)
    left, groups = list(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        own = likeness[np.ix_(left, left)]
        group = [left[int(own.max(axis=1).argmax())]]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(rest[int(likeness[np.ix_(rest, group)].sum(axis=1).argmax())])
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def expected_candidates(sample: np.ndarray, bits: list[int], most: int) -> np.ndarray:
    """Share of pairs that differ in at most 0 .. ``most`` of the bits.

    The larger of what the sample's pairs show and of what independent bits give;
    the latter serves where the sample is too small to show any.
    """
    mask = np.uint64(_mask(bits) & ((1 << BITS) - 1))
    own = sample.view(np.uint64) & mask
    seen = np.zeros(most + 1)
    for shift in range(1, min(len(own), 257)):
        distance = np.bitwise_count(own[shift:] ^ own[:-shift])
        seen += [(distance <= t).sum() for t in range(most + 1)]
    shares = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").mean(axis=0)
    spread = np.zeros(most + 2)
    spread[0] = 1
    for b in bits:
        differ = 2 * shares[b] * (1 - shares[b])
        spread[1:] = spread[1:] * (1 - differ) + spread[:-1] * differ
        spread[0] *= 1 - differ
    pairs = sum(max(0, len(own) - s) for s in range(1, min(len(own), 257)))
    return np.maximum(seen / max(1, pairs), np.cumsum(spread[:-1]))


def allocate(costs: list[np.ndarray], budget: int) -> tuple[float, list[int]]:
    """Thresholds, from -1, with sum(threshold + 1) = ``budget`` and the least cost.

    ``costs[i][u]`` is what part i costs at threshold u - 1.
    """
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * budget
    for cost in costs:
        best = [
            min(
                ((best[b - u][0] + cost[u], [*best[b - u][1], u - 1]) for u in range(min(b, len(cost) - 1) + 1)),
                key=lambda x: x[0],
            )
            for b in range(budget + 1)
        ]
    return best[budget]


def choose_probes(sample: np.ndarray, count: int, distance: int = DISTANCE) -> list[int]:
    """The masks under which fingerprints are grouped."""
    if len(sample) < 2:
        sample = np.arange(2, dtype=np.int64)
    choices = []
    for parts in PARTS:
        groups = correlated_parts(sample, parts)
        costs = []
        for bits in groups:
            shares = expected_candidates(sample, bits, distance)
            probes = np.array([math.comb(len(bits), t) for t in range(distance + 1)], dtype=float)
            # A probe costs a row of two shuffles, a candidate one comparison.
            costs.append(np.concatenate([[0.0], 200 * probes * count + probes * shares * count * count / 2]))
        cost, thresholds = allocate(costs, distance + 1)
        choices.append((cost, groups, thresholds))
    _, groups, thresholds = min(choices, key=lambda c: c[0])
    return [
        _mask(set(bits) - set(left_out))
        for bits, t in zip(groups, thresholds, strict=True)
        if t >= 0
        for left_out in combinations(bits, t)
    ]


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (the smallest index of each) after joining a[i] with b[i]."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further
    return labels


def linked_in_groups(group: np.ndarray, prints: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the links inside groups; ``group`` is sorted.

    Row i is compared with row i + 1, i + 2, ... of its group, all groups at once.
    """
    values, index = np.unique(prints, return_inverse=True)
    labels = np.arange(len(values))
    bits = prints.view(np.uint64)
    at, shift = np.arange(max(0, len(group) - 1)), 1
    while len(at):
        at = at[at + shift < len(group)]
        at = at[group[at] == group[at + shift]]
        near = at[np.bitwise_count(bits[at] ^ bits[at + shift]) <= distance]
        labels = merged(labels, index[near], index[near + shift])
        shift += 1
    joined = np.flatnonzero(labels != np.arange(len(values)))
    return values[joined], values[labels[joined]]


def _links(batches: Batches, distance: int) -> Batches:
    """Forests of sorted groups; a group that goes on in the next batch waits for it."""
    rest = np.zeros((0, 2), dtype=np.int64)

    def forest(rows: np.ndarray) -> pa.RecordBatch:
        a, b = linked_in_groups(rows[:, 0], np.ascontiguousarray(rows[:, 1]), distance)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        rows = np.concatenate([rest, rows])
        past = int(run_starts(rows[:, 0])[-1])
        rest = rows[past:]
        if past:
            yield forest(rows[:past])
    if len(rest):
        yield forest(rest)


def links(prints: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """Pairs (a, b) of linked fingerprints that span every component.

    ``prints`` has one column, `_print`, of distinct values.
    """
    count = prints.count()
    sample = prints.orderBy(F.xxhash64("_print")).limit(SAMPLE).collect()
    masks = choose_probes(np.array([r[0] for r in sample], dtype=np.int64), count, distance)
    probes = F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("_print").bitwiseAND(m))
    probed = prints.select("_print", F.posexplode(probes).alias("_probe", "_value"))
    buckets = probed.groupBy("_probe", "_value").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / cell).cast("int")
    cells = (
        probed.join(buckets, ["_probe", "_value"])
        .withColumn("_block", F.pmod(F.xxhash64("_print"), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            F.xxhash64("_probe", "_value", F.least("_block", "_other"), F.greatest("_block", "_other")).alias("_cell"),
            "_print",
        )
    )
    dealt = cells.repartition("_cell").sortWithinPartitions("_cell")
    return in_arrow(dealt, lambda batches: _links(batches, distance), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(member, root) for every value that occurs in a pair, by alternating stars."""

    def star(pairs: DataFrame, least: DataFrame) -> DataFrame:
        joined = pairs.join(least, "u")
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = state(pairs)
    while True:
        # Large star: larger neighbours go to the smallest value around.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = star(both.where("v > u"), least).where("u <> v").distinct()
        # Small star: a value and its smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = star(large, least).unionByName(least.select("u", F.col("m").alias("v")))
        pairs = written(small.where("u <> v").distinct())
        after = state(pairs)
        if after == before:
            return pairs.select(F.col("u").alias("member"), F.col("v").alias("root"))
        before = after


def _grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = written(with_fingerprint(docs, key, text))
    first = written(rows.groupBy("_print").agg(F.min("_key").alias("_first")))
    linked = components(links(first.select("_print")))
    roots = linked.unionByName(linked.select(F.col("root").alias("member"), "root").distinct())
    roots = roots.withColumnRenamed("member", "_print")
    least = (
        first.join(roots, "_print")
        .groupBy("root")
        .agg(F.min("_first").alias("_least"))
        .join(roots, "root")
        .select("_print", "_least", "root")
    )
    named = first.join(least, "_print", "left").select(
        "_print", F.coalesce("_least", "_first").alias("component_id"), F.coalesce("root", "_print").alias("_class")
    )
    return rows.join(named, "_print")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, fingerprint as 16 hexadecimal digits, and the component of every document."""
    return _grouped(docs, key, text).select(
        F.col("_key").alias(key),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id; all columns."""
    plain = numbered(docs)
    names = plain.columns
    own_key, own_text = (names[docs.columns.index(c)] for c in (key, text))
    kept = (
        _grouped(docs, key, text)
        .groupBy("_class")
        .agg(F.min(F.struct(F.col("_key").isNull(), "_key", "_digest")).alias("_best"))
        .select("_best._key", "_best._digest")
        .distinct()
    )
    rows = plain.withColumn("_of", F.xxhash64(own_text))
    same = rows[own_key].eqNullSafe(kept["_key"]) & (rows["_of"] == kept["_digest"])
    return rows.join(kept, same).dropDuplicates(["_key", "_digest"]).select(*names).toDF(*docs.columns)
