"""Mixture-controlled packing: deficit round-robin over the queues of the sources.

Every document becomes its token ids and one end id. The documents of a source form
a queue, and every window of `WINDOW` ids is filled from all queues in their target
proportions: a queue earns its share of the window, spends whole ids, and carries what
it could not spend (its deficit) into the next window. Targets are the queues' shares
of all ids unless weights are given; with weights, a queue that runs dry leaves its
share to the others in proportion. Only the very last window is padded.

As a job: one pass tokenises and stores the ids, with each document's place in the
queue of its task; task totals give the place in the whole queue. A queue's cumulative
share is its weight times a common virtual time, up to its total; the times at which
partitions of `WINDOWS` windows begin, on totals alone, say which stretch of every
queue a partition gets and which deficits it starts with. That takes a few numbers for
each partition and each queue, however many sources there are. Documents are cut at
these bounds, dealt out by partition (all of equal size, whatever the sources' sizes),
and round-robin over windows goes on inside.

Defined cases: a missing or empty text is its end id alone; a missing source is a
queue of its own; a source with weight 0 comes last; repeated rows are packed each for itself; an empty table gives no pieces; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugtide.llm.tools import Batches, grouped, in_arrow, pieces, ranges, run_starts, utf8
from bugtide.storage import written

WINDOW = 4096
#: Windows of a partition, at least.
WINDOWS = 256
MAX_PARTITIONS = 65_536
#: So many names of queues stand in the plan; more are joined.
NAMED_QUEUES = 64
#: Queues by partitions whose bounds are looked for at once.
BOUNDS = 1_000_000
END = 2
#: Words whose ids a worker remembers.
REMEMBERED = 500_000
#: Bytes of text that are tokenised at once.
SLICE = 2_000_000
#: A table of so many rows (tasks by queues) may be sent to all tasks; a larger one is shuffled.
SENT_ROWS = 500_000


#: What may end a word and always is a token of its own kind.
MARKS = b".,;:!?"
#: Letters below this are letters in every version of Unicode that libraries know.
LATIN = "\u0250"
#: Special tokens hold this; they are told apart from text before it is lower-cased.
SPECIAL = b"<|"


class WordTokenizer:
    """Ids of texts by a tokenizer that never joins across blanks, word by word.

    The vocabulary's rules drop the ASCII blanks, lower-case the text, and cut a word
    between letters and marks. The ids of words are remembered, and of the letters and
    the marks at the end of new words. New runs of lower-case Latin letters go to the
    vocabulary's merges alone; all else new goes through the whole tokenizer.
    """

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end
        # The letter that the byte-level rule writes for each byte.
        self.letters = {b: self._byte_letter(b) for b in range(256)}
        self.forget()

    @staticmethod
    def _byte_letter(b: int) -> str:
        plain = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b
        return chr(b) if plain else chr(0x100 + b if b <= 0x20 else 0x100 + 0x21 + b - 0x7F if b <= 0xA0 else 0x143)

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.runs: set[bytes] = set()
        self.ids = np.array([self.end], dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)
        self.lengths = np.ones(1, dtype=np.int64)

    def _letters(self, runs: list[bytes]) -> dict[bytes, str]:
        """Those that are lower-case Latin letters alone, as the byte-level rule writes them."""
        texts = b"\n".join(runs).decode().split("\n") if runs else []
        found = {r: t for r, t in zip(runs, texts, strict=True) if t.islower() and t.isalpha()}
        for run, text in found.items():
            if not text.isascii():
                found[run] = run.decode("latin-1").translate(self.letters) if text == text.lower() and max(text) < LATIN else ""
        return {r: t for r, t in found.items() if t}

    def _add(self, words: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.index.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def _learn(self, words: list[bytes]) -> None:
        index = self.index
        runs = [word.rstrip(MARKS) for word in words]
        new = [r for r in dict.fromkeys(runs) if r not in self.runs and not (r in index and r[-1:].isalpha())]
        letters = self._letters(new)
        self.runs.update(letters)
        other = set(new).difference(letters)
        joined = [(w, r, w[len(r) :]) for w, r in zip(words, runs, strict=True) if len(r) < len(w) and r not in other]
        whole = dict.fromkeys(w for w, r in zip(words, runs, strict=True) if r in other) if other else {}
        whole.update((tail, None) for _, _, tail in joined if tail not in index)
        merge = self.tokenizer.model.tokenize
        found = [[t.id for t in merge(text)] for text in letters.values()]
        texts = [w.decode() for w in whole]
        found += [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum()))
        self._add([*letters, *whole], lengths, flat)
        # A run and the marks behind it, put together from what is known of both.
        both = chain.from_iterable((run, tail) for _, run, tail in joined)
        parts = np.fromiter(map(index.__getitem__, both), dtype=np.int64, count=2 * len(joined))
        lengths = self.lengths[parts]
        flat = self.ids[ranges(self.starts[parts], lengths)]
        self._add([word for word, _, _ in joined], lengths.reshape(-1, 2).sum(axis=1), flat)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, end ids included, and their number for each text."""
        if len(self.index) > REMEMBERED:
            self.forget()
        # Each distinct word of a batch is looked up once; only these become Python objects.
        folded = pa.array([t if SPECIAL in t else t.lower() for t in texts], pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(folded)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        known = np.fromiter(map(self.index.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        unknown = [i for i in np.flatnonzero(known < 0).tolist() if distinct[i]]
        if unknown:
            new = [distinct[i] for i in unknown]
            self._learn(new)
            known[unknown] = np.fromiter(map(self.index.__getitem__, new), dtype=np.int64, count=len(new))
        at = known[coded.indices.to_numpy()] if len(distinct) else np.zeros(0, dtype=np.int64)
        # Blanks at either end of a text leave an empty word there.
        real = at >= 0
        words = pc.list_value_length(split).to_numpy().astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(real)])[np.concatenate([[0], np.cumsum(words)])]
        at, words = at[real], np.diff(upto)
        at = np.insert(at, upto[1:], 0)
        lengths = self.lengths[at]
        ids = self.ids[ranges(self.starts[at], lengths)]
        ends = np.cumsum(lengths)[np.cumsum(words + 1) - 1]
        return ids, np.diff(np.concatenate([[0], ends]))


@lru_cache(maxsize=2)
def _tokenizer(path: str, end: int) -> WordTokenizer:
    return WordTokenizer(path, end)


def deal(size: int, weights: np.ndarray, left: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each queue gives to a window of ``size`` ids, and the deficits after it.

    ``left`` is what the queues still hold; together it is at least ``size``.
    """
    open_ = left > 0
    share = np.where(open_, weights, 0.0)
    share = share / share.sum() if share.sum() else open_ / max(1, open_.sum())
    credit = np.where(open_, deficit + share * size, 0.0)
    take = np.clip(np.floor(credit + 1e-9).astype(np.int64), 0, left)
    short = size - int(take.sum())
    while short > 0:
        room = left - take
        live = np.where(room > 0, np.maximum(share, 1e-300), 0.0)
        more = np.minimum(np.floor(short * live / live.sum()).astype(np.int64), room)
        if not more.any():
            rest = np.where(room > 0, credit - take, -np.inf)
            first = np.argsort(-rest, kind="stable")[: min(short, int((room > 0).sum()))]
            more[first] = 1
        take += more
        short -= int(more.sum())
    while short < 0:
        first = np.argsort(np.where(take > 0, credit - take, np.inf), kind="stable")[: min(-short, int((take > 0).sum()))]
        take[first] -= 1
        short += len(first)
    return take, np.where(left > take, credit - take, 0.0)


def rounds(sizes: list[int], weights: np.ndarray, totals: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the queues after every window, a row of zeros first, and the deficits before each."""
    left = totals.copy()
    bounds, deficits = [np.zeros_like(totals)], []
    for size in sizes:
        deficits.append(deficit)
        take, deficit = deal(size, weights, left, deficit)
        left = left - take
        bounds.append(bounds[-1] + take)
    return np.array(bounds), np.array(deficits).reshape(len(sizes), len(totals))


class Schedule:
    """Where partitions begin in every queue, at any number of queues.

    At virtual time x, queue q has given ``weight * x`` ids, rounded, up to its total.
    ``at`` are numbers of ids given by all queues together. The numbers between two
    neighbouring times go to the first queues.
    """

    def __init__(self, weights: np.ndarray, totals: np.ndarray, at: list[int]):
        self.totals = totals
        self.weights = np.maximum(weights, (weights.max(initial=0) or 1) * 1e-12)
        end = float(((totals + 1) / self.weights).max(initial=0))
        goal = np.array(at, dtype=np.int64)
        self.low, self.high = np.zeros(len(goal)), np.full(len(goal), end)
        self.first = np.zeros(len(goal), dtype=np.int64)
        for a in range(0, len(goal), max(1, BOUNDS // max(1, len(totals)))):
            own = slice(a, a + max(1, BOUNDS // max(1, len(totals))))
            low, high = self.low[own], self.high[own]
            while True:
                middle = (low + high) / 2
                live = (middle > low) & (middle < high)
                if not live.any():
                    break
                more = self._given(middle[:, None]).sum(axis=1) > goal[own]
                high[live & more], low[live & ~more] = middle[live & more], middle[live & ~more]
            before = self._given(low[:, None])
            gains = np.cumsum(self._given(high[:, None]) - before, axis=1)
            self.first[own] = (gains <= (goal[own] - before.sum(axis=1))[:, None]).sum(axis=1)

    def _given(self, time: np.ndarray, queue: int | slice = slice(None)) -> np.ndarray:
        return np.clip(np.floor(self.weights[queue] * time + 0.5).astype(np.int64), 0, self.totals[queue])

    def bounds(self, queue: int) -> np.ndarray:
        """What a queue has given before every partition."""
        return self._given(np.where(queue < self.first, self.high, self.low), queue)

    def deficits(self, part: int, queues: np.ndarray) -> np.ndarray:
        """What is due to the queues, and not given, before a partition."""
        given = np.where(queues < self.first[part], self._given(self.high[part])[queues], self._given(self.low[part])[queues])
        return np.minimum(self.weights[queues] * self.low[part], self.totals[queues]) - given


def queue_of(source: str) -> Column:
    """The source as text; a missing one has a name that no source has."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def id_bytes(tokenizer: str, end: int) -> int:
    """Bytes that hold any id of the vocabulary, 2 or 4."""
    return 2 if max(_tokenizer(tokenizer, end).tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else 4


def tokenised(docs: DataFrame, tokenizer: str, key: str, text: str, queue: Column, end: int, wide: int) -> DataFrame:
    """Key, queue, ids of ``wide`` bytes each, and the place in the queue of the task."""

    def work(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        filled: dict[str, int] = {}
        encode = _tokenizer(tokenizer, end).encode
        for batch in batches:
            for rows, texts in pieces(batch, "_text", SLICE):
                ids, lengths = encode(texts)
                raw, ends = ids.astype(f"<u{wide}").tobytes(), np.cumsum(lengths)
                places = []
                for name, n in zip(rows.column(1).to_pylist(), lengths.tolist(), strict=True):
                    places.append(filled.get(name, 0))
                    filled[name] = places[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(1),
                        pa.array([part] * len(texts), pa.int32()),
                        pa.array(places, pa.int64()),
                        pa.array(lengths),
                        pa.array([raw[wide * (e - n) : wide * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["_key", "_queue", "_part", "_place", "_n", "_ids"],
                )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("_key"), queue.alias("_queue"), utf8(text).alias("_text"))
    return in_arrow(narrow, work, f"_key {kind}, _queue string, _part int, _place bigint, _n bigint, _ids binary")


def _cut(batches: Batches, schedule: Schedule, wide: int) -> Batches:
    """Documents cut where a partition's stretch of their queue ends."""
    for batch in batches:
        get = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
        queue = get("_queue").to_numpy().astype(np.int64)
        first = get("_place").to_numpy() + get("_before").to_numpy()
        size = get("_n").to_numpy()
        by = np.argsort(queue, kind="stable")
        found = [np.zeros((4, 0), dtype=np.int64)]
        for own in np.split(by, run_starts(queue[by])[1:]) if len(by) else []:
            bounds = schedule.bounds(queue[own[0]])
            # Partitions that get nothing of the queue hold no piece.
            parts = np.flatnonzero(np.diff(bounds))
            ends = bounds[parts + 1]
            low = np.searchsorted(ends, first[own], side="right")
            count = np.searchsorted(ends, first[own] + size[own] - 1, side="right") - low + 1
            part = parts[ranges(low, count)]
            found.append(np.stack([np.repeat(own, count), part, bounds[part], bounds[part + 1]]))
        row, part, lower, upper = np.concatenate(found, axis=1)
        begin = np.maximum(first[row], lower)
        past = np.minimum(first[row] + size[row], upper)
        start = begin - first[row]
        texts = get("_ids").to_pylist()
        spans = zip(row.tolist(), (wide * start).tolist(), (wide * (start + past - begin)).tolist(), strict=True)
        ids = [texts[r][a:b] for r, a, b in spans]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(queue[row].astype(np.int32)),
                pa.array(begin - lower),
                batch.column(0).take(pa.array(row)),
                pa.array(start),
                pa.array(size[row]),
                pa.array(ids, pa.binary()),
            ],
            names=["_partition", "_queue", "_at", "_key", "start", "doc_tokens", "ids"],
        )


def _fill(rows: pa.Table, window: int, windows: int, schedule: Schedule, wide: int) -> pa.RecordBatch:
    """The pieces of one partition, rows sorted by queue and place."""
    part = rows.column("_partition")[0].as_py()
    held, queue = np.unique(rows.column("_queue").to_numpy(), return_inverse=True)
    texts = rows.column("ids").to_pylist()
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) // wide
    totals = np.bincount(queue, weights=lengths, minlength=len(held)).astype(np.int64)
    whole = int(totals.sum())
    sizes = [min(window, whole - at) for at in range(0, whole, window)]
    own, _ = rounds(sizes, schedule.weights[held], totals, schedule.deficits(part, held))
    takes = np.diff(own, axis=0)
    inside = np.cumsum(takes, axis=1) - takes
    at = rows.column("_at").to_numpy()
    start = rows.column("start").to_numpy()
    found = []
    for q in range(len(held)):
        mine = np.flatnonzero(queue == q)
        cuts = np.unique(np.concatenate([at[mine], own[:, q]]))
        begin, size = cuts[:-1], np.diff(cuts)
        row = mine[np.searchsorted(at[mine], begin, side="right") - 1]
        where = np.searchsorted(own[:, q], begin, side="right") - 1
        found.append(np.stack([row, begin - at[row], size, where, inside[where, q] + begin - own[where, q]]))
    row, skip, size, where, offset = np.concatenate(found, axis=1)
    spans = zip(row.tolist(), (wide * skip).tolist(), (wide * (skip + size)).tolist(), strict=True)
    ids = [np.frombuffer(texts[r][a:b], f"<u{wide}").astype("<u4").tobytes() for r, a, b in spans]
    index = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("_key").combine_chunks().take(index),
            rows.column("_queue").combine_chunks().take(index),
            pa.array(start[row] + skip),
            rows.column("doc_tokens").combine_chunks().take(index),
            pa.array(part * windows + where),
            pa.array(offset),
            pa.array(ids, pa.binary()),
        ],
        names=["_key", "_queue", "start", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Mapping[str, float] | None = None,
    window: int = WINDOW,
    end: int = END,
) -> DataFrame:
    """One row for each piece: key, source, start, doc_tokens, sequence_id, offset, ids.

    ``ids`` are little-endian 32-bit numbers. ``weights`` are target proportions by
    source; sources that they leave out get the smallest weight.
    """
    wide = id_bytes(tokenizer, end)
    stored = written(tokenised(docs, tokenizer, key, text, queue_of(source), end, wide))
    parts = stored.groupBy("_queue", "_part").agg(F.sum("_n").alias("_all"))
    before = Window.partitionBy("_queue").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(
        parts.select(
            "_queue", "_part", "_all", F.coalesce(F.sum("_all").over(before), F.lit(0).cast("bigint")).alias("_before")
        )
    )
    sums = {r["_queue"]: r["n"] for r in parts.groupBy("_queue").agg(F.sum("_all").alias("n")).collect()}
    queues = {name: i for i, name in enumerate(sorted(sums))}
    totals = np.array([sums[q] for q in queues], dtype=np.int64)
    if weights:
        least = min(weights.values())
        wanted = np.array([weights.get(q[1:], least) for q in queues], dtype=float)
    else:
        wanted = totals.astype(float)
    whole = int(totals.sum())
    windows = max(WINDOWS, -(-whole // (window * MAX_PARTITIONS)))
    step = window * windows
    schedule = Schedule(wanted, totals, [*range(0, whole, step), whole])

    def cut(batches: Batches) -> Batches:
        return _cut(batches, schedule, wide)

    def fill(batches: Batches) -> Batches:
        for rows in grouped(batches, "_partition"):
            yield _fill(rows, window, windows, schedule, wide)

    kind = stored.schema["_key"].dataType.simpleString()
    text_of = lambda q: q[1:] if q.startswith("=") else None
    names = docs.sparkSession.createDataFrame(
        [(q, i, text_of(q)) for q, i in queues.items()], "_queue string, _q int, queue string"
    )
    known = parts.join(names, "_queue")
    known = F.broadcast(known) if parts.count() <= SENT_ROWS else known
    placed = stored.join(known, ["_queue", "_part"])
    placed = placed.select("_key", F.col("_q").alias("_queue"), "_place", "_before", "_n", "_ids")
    dealt = in_arrow(
        placed, cut, f"_partition int, _queue int, _at bigint, _key {kind}, start bigint, doc_tokens bigint, ids binary"
    )
    dealt = dealt.repartition("_partition").sortWithinPartitions("_partition", "_queue", "_at")
    filled = in_arrow(
        dealt, fill, f"_key {kind}, _queue int, start bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    )
    if len(queues) > NAMED_QUEUES:
        found = filled.join(names.select(F.col("_q").alias("_queue"), "queue"), "_queue")
        return found.select(F.col("_key").alias(key), "queue", *filled.columns[2:])
    named = F.array(*(F.lit(text_of(q)) for q in queues)) if queues else F.array(F.lit(""))
    return filled.select(
        F.col("_key").alias(key), F.get(named, F.col("_queue")).alias("queue"), *filled.columns[2:]
    )


def packing_digest(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The pieces in numbers, a checksum in place of the ids."""
    return packed.select(
        key,
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "queue",
    )
