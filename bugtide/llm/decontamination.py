"""Benchmark decontamination: an FM-index per training shard, searched backwards.

A text is lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
A window is ten consecutive words of a benchmark item; an item of fewer words, but not
none, is one window. Every document word inside an occurrence of a window is hit.

Documents are not moved. Each task cuts its documents into shards of about
`SHARD_WORDS` words and builds an FM-index over the shard's words, in which words that
no item holds are breaks: no window crosses them. All windows are searched together,
one word a step, through the ranks of a wavelet matrix; occurrences are located from
sampled suffix positions and merged into spans.

The benchmark is the stated query set. The driver reads it in blocks of `BLOCK_WORDS`
words; longer items are cut, with the overlap that windows need. Blocks of at most
`PASS_WORDS` words together are sent out and searched in one pass over the documents.
A larger benchmark takes several passes: what one found is stored with the documents,
and its blocks are given up before the next.

Defined cases: a missing text has no words; an item without words has no window; a
missing item id is written as the empty text, items that share an id count as one;
repeated rows are scanned each for itself; empty tables give no hits or no rows; extra
columns of the benchmark are ignored, those of the documents kept by `remove_leaks`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from bugtide.llm.fmindex import FMIndex
from bugtide.llm.tools import Batches, in_arrow, numbered, pieces, ranges, utf8
from bugtide.storage import written

NGRAM = 10
SHARD_WORDS = 1_000_000
#: Bytes of text that a shard may have besides (long words).
SHARD_BYTES = 8_000_000
BLOCK_WORDS = 500_000
#: Words of the blocks that tasks hold at a time.
PASS_WORDS = 1_000_000
#: Letters to lower case, other bytes below 0x80 but digits to a blank.
WORDS = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 0x20 for b in range(128)) + bytes(range(128, 256))
WORD = re.compile(rb"[^ ]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Phrases:
    """The distinct windows of a block of items, as numbers, by length."""

    def __init__(self, items: list[tuple[str, bytes]], ngram: int):
        self.n_words = 0
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            self.n_words += len(ids)
            size = min(ngram, len(ids))
            for at in range(len(ids) - size + 1 if ids else 0):
                owners.setdefault(size, {}).setdefault(tuple(ids[at : at + size]), set()).add(item)
        self.by_length = {
            size: (np.array(list(found), dtype=np.int64), list(map(sorted, found.values())))
            for size, found in owners.items()
        }

    def find(self, documents: list[list[bytes]]) -> list[tuple[np.ndarray, set[str]]]:
        """For each document a mark per word, and the items found."""
        lengths = np.array([len(d) for d in documents], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        sequence = np.zeros(starts[-1] + 1, dtype=np.int64)
        for start, document in zip(starts, documents):
            ids = map(self.vocabulary.get, document, repeat(0))
            sequence[start : start + len(document)] = np.fromiter(ids, dtype=np.int64, count=len(document))
        # A run of known words that is shorter than every window holds none.
        edges = np.flatnonzero(np.diff(np.concatenate([[0], sequence > 0, [0]]))).reshape(-1, 2)
        runs = edges[edges[:, 1] - edges[:, 0] < min(self.by_length, default=1)]
        sequence[ranges(runs[:, 0], runs[:, 1] - runs[:, 0])] = 0
        # Of a run of breaks only the first is kept.
        kept = np.flatnonzero((sequence > 0) | np.concatenate([[True], sequence[:-1] > 0]))
        marks = np.zeros(len(sequence) + 1, dtype=np.int64)
        items: list[set[str]] = [set() for _ in documents]
        index = FMIndex(sequence[kept], len(self.vocabulary) + 1)
        for size, (patterns, owners) in self.by_length.items():
            which, at = index.occurrences(patterns)
            at = kept[at]
            np.add.at(marks, at, 1)
            np.add.at(marks, at + size, -1)
            inside = np.searchsorted(starts, at, side="right") - 1
            for document, pattern in np.unique(np.stack([inside, which]), axis=1).T.tolist():
                items[document].update(owners[pattern])
        hit = np.cumsum(marks) > 0
        return [(hit[s : s + n], found) for s, n, found in zip(starts, lengths, items, strict=False)]


def _blocks(benchmark: DataFrame, item: str, text: str, ngram: int, most: int) -> Iterator[Phrases]:
    """Windows of the benchmark, a bounded number of words at a time."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), utf8(text).alias("text")
    ).toLocalIterator()
    block: list[tuple[str, bytes]] = []
    size = 0
    for row in rows:
        own = words(bytes(row["text"]))
        # Pieces of a long item overlap, so that each of its windows is whole in one of them.
        for at in range(0, max(1, len(own) - ngram + 1), most):
            piece = own[at : at + most + ngram - 1]
            if block and size + len(piece) + 1 > most:
                yield Phrases(block, ngram)
                block, size = [], 0
            block.append((row["item"], b" ".join(piece)))
            size += len(piece) + 1
    if block:
        yield Phrases(block, ngram)


def _searched(part: pa.RecordBatch, texts: list[bytes], blocks: list) -> list[tuple[np.ndarray, set[str]]]:
    """A mark per word and the items found, with what earlier passes found."""
    documents = [words(t) for t in texts]
    found = [(np.zeros(len(d), dtype=bool), set()) for d in documents]
    if "_spans" in part.schema.names:
        earlier = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("_spans", "_items"))
        for (marks, items), spans, others in zip(found, *earlier, strict=True):
            for first, past in zip(spans[::2], spans[1::2], strict=True):
                marks[first:past] = True
            items.update(others)
    for block in blocks:
        for (marks, items), (more, others) in zip(found, block.value.find(documents), strict=True):
            marks |= more
            items |= others
    return found


def _spans(found: list[tuple[np.ndarray, set[str]]]) -> pa.Array:
    edges = [np.flatnonzero(np.diff(np.concatenate([[0], m, [0]]))) for m, _ in found]
    return pa.array([e.tolist() for e in edges], pa.list_(pa.int64()))


def _items(found: list[tuple[np.ndarray, set[str]]]) -> pa.Array:
    return pa.array([sorted(items) for _, items in found], pa.list_(pa.string()))


def _shards(batch: pa.RecordBatch, text: str, shard_words: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    yield from pieces(batch, text, min(SHARD_BYTES, 8 * shard_words))


def _passed(docs: DataFrame, own: str, blocks: list, shard_words: int) -> DataFrame:
    """The documents, with spans and items found so far in two more columns."""
    names = [c for c in docs.columns if c not in ("_spans", "_items")]

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for part, texts in _shards(batch, own, shard_words):
                found = _searched(part, texts, blocks)
                columns = [*(part.column(i) for i in range(len(names))), _spans(found), _items(found)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "_spans", "_items"])

    schema = StructType([docs.schema[c] for c in names])
    schema = schema.add("_spans", ArrayType(LongType())).add("_items", ArrayType(StringType()))
    return in_arrow(docs, work, schema)


def _all_but_last(
    docs: DataFrame, own: str, benchmark: DataFrame, item: str, text: str, ngram: int, shard_words: int, most: int, at_once: int
) -> tuple[DataFrame, list]:
    """The documents after all passes but the last, and the blocks of the last."""
    context = docs.sparkSession.sparkContext
    sent, size = [], 0
    for block in _blocks(benchmark, item, text, ngram, most):
        if sent and size + block.n_words > at_once:
            docs = written(_passed(docs, own, sent, shard_words))
            for old in sent:
                old.destroy()
            sent, size = [], 0
        sent.append(context.broadcast(block))
        size += block.n_words
    return docs, sent


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    ngram: int = NGRAM,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
    pass_words: int = PASS_WORDS,
) -> DataFrame:
    """Words, hit words, items found and merged word spans of every document."""
    narrow = docs.select(F.col(key).alias("_key"), utf8(text).alias("_text"))
    narrow, blocks = _all_but_last(narrow, "_text", benchmark, item, item_text, ngram, shard_words, block_words, pass_words)

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for part, texts in _shards(batch, "_text", shard_words):
                found = _searched(part, texts, blocks)
                yield pa.RecordBatch.from_pydict(
                    {
                        "_key": part.column(0),
                        "n_words": pa.array([len(m) for m, _ in found], pa.int64()),
                        "n_hit": pa.array([int(m.sum()) for m, _ in found], pa.int64()),
                        "items": _items(found),
                        "spans": _spans(found),
                    }
                )

    kind = docs.schema[key].dataType.simpleString()
    found = in_arrow(narrow, work, f"_key {kind}, n_words bigint, n_hit bigint, items array<string>, spans array<bigint>")
    return found.withColumnRenamed("_key", key)


def cut(text: bytes, marks: np.ndarray) -> bytes:
    """A text without its marked words and what stands between neighbouring ones."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks, [0]]))).reshape(-1, 2)
    spans = [m.span() for m in WORD.finditer(re.sub(rb"\s", b" ", text.translate(WORDS)))]
    kept, at = [], 0
    for first, past in edges:
        kept.append(text[at : spans[first][0]])
        at = spans[past - 1][1]
    return b"".join([*kept, text[at:]])


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    ngram: int = NGRAM,
    block_words: int = BLOCK_WORDS,
    pass_words: int = PASS_WORDS,
) -> DataFrame:
    """The documents, all columns, with the spans found cut out of the text."""
    place, plain = docs.columns.index(text), numbered(docs)
    names = plain.columns
    marked, blocks = _all_but_last(
        plain, names[place], benchmark, item, item_text, ngram, SHARD_WORDS, block_words, pass_words
    )

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for part, texts in _shards(batch, names[place], SHARD_WORDS):
                found = _searched(part, texts, blocks)
                old = part.column(place)
                new = [
                    cut(t, marks).decode() if marks.any() else old[i].as_py()
                    for i, (t, (marks, _)) in enumerate(zip(texts, found, strict=True))
                ]
                columns = [pa.array(new, pa.string()) if i == place else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_arrow(marked, work, plain.schema).toDF(*docs.columns)


def leak_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The result in numbers: counts, a checksum of the items, and whether anything was hit."""
    return found.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def digest_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
