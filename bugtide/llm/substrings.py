"""Repeated substrings, found by building a sorted collection column by column.

Every byte that is covered by a string of `LENGTH` bytes which also starts anywhere
else, in the same document or another, is removed. Texts are UTF-8 bytes.

Which strings can meet. The hashes of all `CORE`-byte strings inside a string of
`LENGTH` bytes are compared, and the smallest (the first of equals) is its anchor. The
anchor depends on the string alone, so equal strings have equal anchors at the same
offset. The starts that share an anchor follow each other; with the bytes they cover
they form a segment. Segments whose anchors' hash occurs once hold no repeat. Equal
segments are counted: they repeat as a whole. Only distinct segments around the same
anchor are left to compare.

Column-wise construction. Distinct segments of an anchor form a collection. They are
aligned at the anchor, so suffixes can be equal over `LENGTH` bytes only if they
start in the same column, and the transform of the whole collection falls apart into
one piece per column. Rounds go from the last column to the first; in each round every
segment gets one symbol more. From the order of the suffixes of the round before,
the symbols in that order are this column of the transform; a stable sort of them is
the new order, and the common prefixes of neighbours follow from the old ones by range
minima. Columns lie in a scratch file and are read one after another, so memory holds
three numbers a segment, however long they are. A start repeats where a neighbour
shares `LENGTH` bytes.

Anchors with more than `TOGETHER` distinct segments are never gathered in a task. Equal
strings have equal distances to the anchor, so each segment falls into stretches of
`STRETCH` distances; all strings of a stretch share its middle bytes, whose hash is
counted first. Only where it repeats are the strings themselves counted, by distance and
hash. These are aggregations over keys that only equal bytes share.

As a job: two passes compute anchors next to the text (numpy, no text is moved) and
shuffle 8 and 32 bytes for each; the text is shuffled once, to fetch distinct segments
and to apply the result (the second use reads the same exchange).

Defined cases: a missing text is empty; texts shorter than `LENGTH` lose nothing;
repeated rows repeat each other; an empty table gives an empty table; extra columns
are ignored by `repeats`, kept by `remove_repeats`; there, a character of which a
byte is removed goes as a whole.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bugtide.llm.tools import Batches, as_bytes, grouped, in_arrow, lists, numbered, pieces, ranges, run_starts, utf8
from bugtide.storage import written

LENGTH = 200
CORE = 50
#: Strings of `CORE` bytes inside one of `LENGTH` bytes.
SPAN = LENGTH - CORE + 1
#: Bytes hashed at once; chosen to stay in a processor's cache.
SLICE = 200_000
#: Segments whose columns are sorted together; an anchor that has more is split by hashes.
TOGETHER = 20_000
#: Distances to the anchor that are looked at together in an anchor that is split.
STRETCH = 16
#: Segments whose strings are hashed at once.
HASHED = 500

_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash's base and of its inverse, modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            self.up, self.down = (_powers(base, size) for base in (_BASE, _INVERSE))
        return self.up[: n + 1], self.down[: n + 1]


def _powers(base: int, most: int) -> np.ndarray:
    factors = np.full(most + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_POWERS = Powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Segments of the texts: text, anchor, its distance to the first and to the last start, and two hashes.

    The hashes are those of the anchor's `CORE` bytes and of the whole segment.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts) + bytes(LENGTH), dtype=np.uint8)
    n = len(data)
    up, down = _POWERS.upto(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * up[:n], out=sums[1:])
    core = _mixed((sums[CORE:] - sums[:-CORE]) * down[: n - CORE + 1])
    # High half of the hash, then the place: minima are the first of equals.
    keyed = (core & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(core), dtype=np.uint64)
    padded = np.full(-(-len(keyed) // SPAN) * SPAN, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keyed)] = keyed
    blocks = padded.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    total = n - LENGTH
    least = np.minimum(behind[:total], ahead[SPAN - 1 : SPAN - 1 + total])
    # Starts whose string ends inside their own text.
    full = np.maximum(lengths - LENGTH + 1, 0)
    begins = np.cumsum(lengths) - lengths
    starts = ranges(begins, full)
    at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1
    anchor, low, high = at[first], starts[first], starts[last]
    segment = _mixed((sums[high + LENGTH] - sums[low]) * down[low] + (anchor - low).astype(np.uint64) * np.uint64(0x9E3779B9))
    segment = _mixed(segment + (high - low).astype(np.uint64))
    text = np.searchsorted(begins + lengths, low, side="right")
    return text, anchor - begins[text], anchor - low, anchor - high, core[anchor].view(np.int64), segment.view(np.int64)


def repeated_starts(
    group: np.ndarray, segments: list[bytes], low: np.ndarray, high: np.ndarray, length: int = LENGTH, span: int = SPAN
) -> np.ndarray:
    """For each segment and distance to the anchor (0 .. span - 1), whether the string that starts there
    also starts in another segment of the same group. ``group`` is sorted.

    A segment's first byte lies ``low`` before the anchor, its last start ``high``.
    """
    n, columns = len(segments), span - 1 + length
    found = np.zeros((span, n), dtype=bool)
    sizes = low - high + length
    with tempfile.TemporaryFile() as scratch:
        table = np.memmap(scratch, dtype=np.uint16, mode="w+", shape=(columns, n))
        for at in range(0, n, TOGETHER):
            part = slice(at, at + TOGETHER)
            data = np.frombuffer(b"".join(segments[part]), dtype=np.uint8).astype(np.uint16) + 1
            row = np.repeat(np.arange(at, min(at + TOGETHER, n)), sizes[part])
            table[ranges(span - 1 - low[part], sizes[part]), row] = data
        order, common = np.arange(n), np.zeros(n + 1, dtype=np.int16)
        groups = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])).astype(np.int64) * 512
        for column in reversed(range(columns)):
            transform = table[column][order].astype(np.int64)
            keys = groups + transform
            by = np.argsort(keys, kind="stable")
            keys, order = keys[by], order[by]
            same = np.flatnonzero((keys[1:] == keys[:-1]) & (transform[by[1:]] > 0))
            least = np.zeros(n + 1, dtype=np.int16)
            if len(same):
                edges = np.stack([by[same] + 1, by[same + 1] + 1], axis=1).ravel()
                least[same + 1] = np.minimum(np.minimum.reduceat(common, edges)[::2] + 1, length)
            common = least
            distance = span - 1 - column
            if distance >= 0:
                long = common >= length
                found[distance, order[long[:-1] | long[1:]]] = True
        del table
    return found & (np.arange(span)[:, None] <= low) & (np.arange(span)[:, None] >= high)


def _segments(batches: Batches, cores_only: bool) -> Batches:
    for batch in batches:
        for rows, texts in pieces(batch, "_text", SLICE):
            text, anchor, low, high, core, segment = anchors(texts)
            columns = [pa.array(core)]
            names = ["_core"]
            if not cores_only:
                columns += [
                    pa.array(segment),
                    rows.column(0).take(pa.array(text)),
                    pa.array(anchor << 16 | low << 8 | high),
                ]
                names += ["_segment", "_row", "_place"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, place >> 8 & 255, place & 255


def _fetch(batches: Batches, text: str) -> Batches:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        wanted = batch.column(batch.schema.get_field_index("_wanted")).to_pylist()
        texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
        for data, own in zip(texts, wanted, strict=True):
            data = data.as_py()
            place = np.array([w["_place"] for w in own], dtype=np.int64)
            anchor, low, high = _unpacked(place)
            cut = [data[a:b] for a, b in zip((anchor - low).tolist(), (anchor - high + LENGTH).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w["_core"] for w in own], pa.int64()),
                    pa.array([w["_segment"] for w in own], pa.int64()),
                    pa.array(low),
                    pa.array(high),
                    pa.array(cut, pa.binary()),
                ],
                names=["_core", "_segment", "_low", "_high", "_bytes"],
            )


def string_hashes(segments: list[bytes], low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segment, stretch, hash of the bytes that its strings share, number of strings; then hash and distance of all strings."""
    sizes = low - high + LENGTH
    data = np.frombuffer(b"".join(segments), dtype=np.uint8)
    up, down = _POWERS.upto(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=sums[1:])
    hashed = lambda at, n: _mixed((sums[at + n] - sums[at]) * down[at]).view(np.int64)
    # Where the anchor of each segment would stand.
    anchor = np.cumsum(sizes) - sizes + low
    row = np.repeat(np.arange(len(segments)), low - high + 1)
    distance = ranges(high, low - high + 1)
    first = run_starts(row * SPAN + distance // STRETCH)
    stretch, of = distance[first] // STRETCH, row[first]
    near, far = stretch * STRETCH, np.minimum(stretch * STRETCH + STRETCH, SPAN) - 1
    shared = hashed(anchor[of] - near, LENGTH - far + near)
    return of, stretch, shared, np.diff(np.append(first, len(row))), hashed(anchor[row] - distance, LENGTH), distance


def _hashed(batches: Batches, text: str) -> Batches:
    """The hashes of the strings of the wanted segments of each text, by stretch."""
    for rows in _fetch(batches, text):
        for at in range(0, rows.num_rows, HASHED):
            part = rows.slice(at, HASHED)
            low, high = (part.column(i).to_numpy() for i in (2, 3))
            of, stretch, shared, sizes, strings, distance = string_hashes(part.column(4).to_pylist(), low, high)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(of)),
                    part.column(1).take(pa.array(of)),
                    pa.array(stretch.astype(np.int32)),
                    pa.array(shared),
                    pa.array(distance[np.cumsum(sizes) - sizes].astype(np.int32)),
                    lists(strings, sizes),
                ],
                names=["_core", "_segment", "_stretch", "_shared", "_first", "_strings"],
            )


def _split(hashed: DataFrame) -> DataFrame:
    """Runs of distances at which a segment's strings start in another segment too."""
    shared = ["_core", "_stretch", "_shared"]
    twice = lambda df, keys: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    left = hashed.join(twice(hashed, shared), shared, "left_semi")
    strings = left.select("_core", "_segment", "_first", F.posexplode("_strings").alias("_i", "_string")).select(
        "_core", "_segment", (F.col("_first") + F.col("_i")).cast("bigint").alias("_distance"), "_string"
    )
    string = ["_core", "_distance", "_string"]
    found = strings.join(twice(strings, string), string, "left_semi")
    place = F.row_number().over(Window.partitionBy("_core", "_segment").orderBy("_distance"))
    runs = found.select("_core", "_segment", "_distance").distinct().withColumn("_run", F.col("_distance") - place)
    return (
        runs.groupBy("_core", "_segment", "_run")
        .agg(F.max("_distance").alias("_from"), F.min("_distance").alias("_to"))
        .select("_core", "_segment", "_from", "_to")
    )


def _once(batches: Batches) -> Batches:
    """Sorted segments without the copies that repeated rows bring."""
    last = None
    for batch in batches:
        pair = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
        if not len(pair):
            continue
        fresh = np.append(last is None or (pair[0] != last).any(), (pair[1:] != pair[:-1]).any(axis=1))
        last = pair[-1]
        yield batch.filter(pa.array(fresh))


def _collections(batches: Batches) -> Iterator[pa.Table]:
    """Whole groups, some thousand segments at a time."""
    held: list[pa.Table] = []
    size = 0
    for table in grouped(_once(batches), "_core"):
        if size and size + table.num_rows > TOGETHER:
            yield pa.concat_tables(held)
            held, size = [], 0
        held.append(table)
        size += table.num_rows
    if held:
        yield pa.concat_tables(held)


def _construct(batches: Batches) -> Batches:
    for table in _collections(batches):
        core, segment, low, high = (table.column(c).to_numpy() for c in ("_core", "_segment", "_low", "_high"))
        found = repeated_starts(core, table.column("_bytes").to_pylist(), low, high)
        # Runs of distances, from the far end: those of the first starts come first.
        padded = np.pad(found[::-1].T, ((0, 0), (1, 1))).astype(np.int8)
        row, edge = np.nonzero(np.diff(padded, axis=1))
        first, last = SPAN - 1 - edge[::2], SPAN - edge[1::2]
        yield pa.RecordBatch.from_arrays(
            [pa.array(core[row[::2]]), pa.array(segment[row[::2]]), pa.array(first), pa.array(last)],
            names=["_core", "_segment", "_from", "_to"],
        )


def open_cores(distinct: DataFrame, together: int) -> tuple[DataFrame, DataFrame]:
    """Anchors whose distinct segments are to be compared: those sorted in a task, those with too many for it."""
    kinds = distinct.groupBy("_core").agg(F.count(F.lit(1)).alias("_kinds"), F.min("_times").alias("_least"))
    kinds = kinds.where("_kinds > 1 AND _least = 1")
    few = F.col("_kinds") <= together
    return kinds.where(few).select("_core"), kinds.where(~few).select("_core")


def _with_spans(docs: DataFrame, key: str, text: str, together: int = TOGETHER) -> DataFrame:
    """The documents with the (start, last start) of what repeats in their texts' bytes."""
    marked = docs.withColumn("_row", F.xxhash64(key, text))
    narrow = marked.select("_row", utf8(text).alias("_text"))
    cores = in_arrow(narrow, lambda b: _segments(b, True), "_core bigint")
    repeated = cores.groupBy("_core").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select("_core")
    every = in_arrow(
        narrow, lambda b: _segments(b, False), "_core bigint, _segment bigint, _row bigint, _place bigint"
    )
    found = written(every.join(repeated, "_core", "left_semi"))
    distinct = found.groupBy("_core", "_segment").agg(
        F.count(F.lit(1)).alias("_times"), F.min(F.struct("_row", "_place")).alias("_at")
    )
    sorted_cores, split_cores = open_cores(distinct, together)

    def fetched(cores: DataFrame) -> DataFrame:
        wanted = (
            distinct.join(cores, "_core", "left_semi")
            .groupBy(F.col("_at._row").alias("_row"))
            .agg(F.collect_list(F.struct("_core", "_segment", F.col("_at._place").alias("_place"))).alias("_wanted"))
        )
        return marked.join(wanted, "_row")

    bytes_ = in_arrow(
        fetched(sorted_cores), lambda b: _fetch(b, text), "_core bigint, _segment bigint, _low bigint, _high bigint, _bytes binary"
    )
    sorted_ = bytes_.repartition("_core").sortWithinPartitions("_core", "_segment")
    partly = in_arrow(sorted_, _construct, "_core bigint, _segment bigint, _from bigint, _to bigint")
    hashed = in_arrow(
        fetched(split_cores),
        lambda b: _hashed(b, text),
        "_core bigint, _segment bigint, _stretch int, _shared bigint, _first int, _strings array<bigint>",
    )
    partly = partly.unionByName(_split(hashed))
    wholly = distinct.where("_times > 1").select(
        "_core",
        "_segment",
        F.shiftright("_at._place", 8).bitwiseAND(F.lit(255)).alias("_from"),
        F.col("_at._place").bitwiseAND(F.lit(255)).alias("_to"),
    )
    once = distinct.where("_times = 1").select("_core", "_segment")
    partly = partly.join(once, ["_core", "_segment"], "left_semi")
    anchor = F.shiftright("_place", 16)
    spans = (
        found.join(wholly.unionByName(partly), ["_core", "_segment"])
        .groupBy("_row")
        .agg(
            F.collect_list(F.struct((anchor - F.col("_from")).alias("first"), (anchor - F.col("_to")).alias("last"))).alias(
                "_spans"
            )
        )
    )
    return marked.join(spans, "_row", "left")


def _removed(text: bytes, spans: list[dict] | None) -> np.ndarray:
    """A mark for each byte that a repeated string covers."""
    marks = np.zeros(len(text) + 1, dtype=np.int64)
    if spans:
        np.add.at(marks, [s["first"] for s in spans], 1)
        np.add.at(marks, [s["last"] + LENGTH for s in spans], -1)
    return np.cumsum(marks)[:-1] > 0


def _kept(text: bytes, marks: np.ndarray) -> bytes:
    return np.frombuffer(text, dtype=np.uint8)[~marks].tobytes() if marks.any() else text


def _columns(batch: pa.RecordBatch, text: str) -> Iterator[tuple[bytes, np.ndarray]]:
    spans = batch.column(batch.schema.get_field_index("_spans"))
    texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
    for data, own in zip(texts, spans, strict=True):
        data = data.as_py()
        yield data, _removed(data, own.as_py())


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", together: int = TOGETHER) -> DataFrame:
    """For each document the sizes before and of what goes, the runs, and a digest of the rest."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        for batch in batches:
            sizes, removed, runs, digests = [], [], [], []
            for data, marks in _columns(batch, "_body"):
                sizes.append(len(data))
                removed.append(int(marks.sum()))
                runs.append(int((np.diff(marks.astype(np.int8), prepend=0) == 1).sum()))
                digests.append(hashlib.sha256(_kept(data, marks)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("_key")),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["_key", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_body"))
    found = _with_spans(narrow, "_key", "_body", together).drop("_row")
    done = in_arrow(found, work, f"_key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return done.withColumnRenamed("_key", key)


def whole_characters(text: bytes, marks: np.ndarray) -> np.ndarray:
    """Marks widened to whole UTF-8 characters."""
    starts = np.flatnonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)
    if not len(starts):
        return marks
    touched = np.maximum.reduceat(marks.astype(np.int8), starts)
    return np.repeat(touched > 0, np.diff(np.append(starts, len(text))))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, without the repeated parts of their texts."""
    plain = numbered(docs)
    names = plain.columns
    place = docs.columns.index(text)

    def work(batches: Batches) -> Batches:
        for batch in batches:
            old, new = batch.column(place), []
            for i, (data, marks) in enumerate(_columns(batch, names[place])):
                new.append(_kept(data, whole_characters(data, marks)).decode() if marks.any() else old[i].as_py())
            columns = [pa.array(new, pa.string()) if i == place else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    found = _with_spans(plain, names[docs.columns.index(key)], names[place])
    return in_arrow(found.select(*names, "_spans"), work, plain.schema).toDF(*docs.columns)
