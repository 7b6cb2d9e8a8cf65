"""Chat formatting by columnar byte assembly.

A turn is written as ``<s>`` role, line break, text, ``</s>`` line break. Control strings
(`CONTROL`) inside a text get a backslash behind their first character, and lose it when
read back; a role writes backslash, line break, ``<`` and ``[`` as ``\\\\``, ``\\n``, ``\\l`` and
``\\b``. So neither can end a turn or start one, and both come back as they were. The loss mask
covers the text of each assistant turn and nothing else, as byte positions.

A batch is assembled at once: the lengths of all headers, texts and ends, summed up,
say where each of them starts; numpy scatters the bytes of whole columns to these
places in one preallocated Arrow buffer, and the conversations' ends are its offsets.

As a job: rows are ranged by conversation, turn, role and a hash of the text, so a
conversation that holds much of the table is cut over many tasks. It comes out in parts
of about `PART` bytes, numbered in order; ordinary conversations are one part. Reading back
streams the parts of a conversation in order and holds one batch at a time.

Defined cases: a missing text or role is empty; rows without a conversation are one
conversation of their own; turns that are equal or missing (these first) follow each
other by role, then by a hash of the text, repeated rows each for itself; an empty table
gives no conversations; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bugtide.llm.tools import Batches, as_bytes, in_arrow, ranges, run_starts, utf8

LEARNED = "assistant"
OPEN, CLOSE = b"<s>", b"</s>\n"
#: What marks turns here and in related templates.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: Bytes after which a conversation goes on in its next part.
PART = 1 << 20
#: Bytes of text that are assembled at once, unless one text is longer.
SLICE = 8_000_000

_TAILS = "|".join(re.escape(tail) for tail in ("s>", "/s>", "<SYS>>", "</SYS>>"))
_SQUARE = "|".join(re.escape(tail) for tail in ("INST]", "/INST]"))
# A first character, any backslashes, the rest of a control string.
_MARKED = rf"(?:(<)(\\*)({_TAILS})|(\[)(\\*)({_SQUARE}))"
_BROKEN = re.compile(rf"(?:<\\+(?:{_TAILS})|\[\\+(?:{_SQUARE}))".encode())
_ROLE = {"\\": "\\\\", "\n": "\\n", "<": "\\l", "[": "\\b"}
_ROLE_BACK = {code[1].encode(): c.encode() for c, code in _ROLE.items()}


def escaped(texts: pa.Array) -> pa.Array:
    """The texts with a backslash more inside each control string."""
    return pc.replace_substring_regex(texts, pattern=_MARKED, replacement=r"\1\4\2\5\\\3\6")


def unescaped(text: bytes) -> bytes:
    return _BROKEN.sub(lambda m: m[0][:1] + m[0][2:], text) if b"\\" in text else text


def header(role: str) -> bytes:
    return OPEN + "".join(_ROLE.get(c, c) for c in role).encode() + b"\n"


def role_of(head: bytes) -> bytes:
    """The role of a header without its line break."""
    return re.sub(rb"\\(.)", lambda m: _ROLE_BACK[m[1]], head[len(OPEN) :])


def characters(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero(np.frombuffer(text, dtype=np.uint8) & 0xC0 != 0x80))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where its values start and the last one ends."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets


def assemble(roles: pa.Array, texts: pa.Array, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The parts that begin at rows ``starts``, and each row's text in its part, from and to."""
    coded = roles.dictionary_encode()
    heads = pa.array([header(r) for r in coded.dictionary.to_pylist()], pa.binary())
    kind = coded.indices.to_numpy()
    head_bytes, head_at = _bytes_of(heads)
    text_bytes, text_at = _bytes_of(escaped(texts))
    head_size, text_size = np.diff(head_at)[kind], np.diff(text_at)
    size = head_size + text_size + len(CLOSE)
    begin = np.cumsum(size) - size
    total = int(size.sum())

    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, dtype=np.uint8)
    out[ranges(begin, head_size)] = head_bytes[ranges(head_at[:-1][kind], head_size)]
    text_from = begin + head_size
    out[ranges(text_from, text_size)] = text_bytes[text_at[0] : text_at[-1]]
    end = np.frombuffer(CLOSE, dtype=np.uint8)
    out[(text_from + text_size)[:, None] + np.arange(len(end))] = end
    offsets = np.append(begin[starts], total)
    if total < 1 << 31:
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), buffer])
    else:
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), buffer])
    own = np.repeat(offsets[:-1], np.diff(np.append(starts, len(texts))))
    return parts, text_from - own, text_from + text_size - own


def _formatted(rows: pa.Table, number: int, most: int) -> pa.RecordBatch:
    """The parts of sorted rows; a conversation may go on in a part after them."""
    rows = rows.combine_chunks()
    key = rows.column("key").combine_chunks()
    texts, roles = as_bytes(rows.column("text").combine_chunks()), rows.column("role").combine_chunks()
    starts = run_starts(key.dictionary_encode(null_encoding="encode").indices.to_numpy())
    size = pc.binary_length(texts).to_numpy().astype(np.int64)
    before = np.cumsum(size) - size
    inside = before - np.repeat(before[starts], np.diff(np.append(starts, len(texts))))
    starts = np.unique(np.concatenate([starts, np.flatnonzero(np.diff(inside // most, prepend=0) > 0)]))
    parts, text_from, text_to = assemble(roles, texts, starts)

    learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
    part_of = np.cumsum(np.isin(np.arange(len(texts)), starts)) - 1
    per_part = np.bincount(part_of[learned], minlength=len(starts))
    offsets = pa.array(np.append(0, np.cumsum(per_part)).astype(np.int32))
    spans = [pa.ListArray.from_arrays(offsets, pa.array(x[learned])) for x in (text_from, text_to)]
    return pa.RecordBatch.from_arrays(
        [
            key.take(pa.array(starts)),
            pa.array(number + np.arange(len(starts), dtype=np.int64)),
            pa.array(np.diff(np.append(starts, len(texts)))),
            parts,
            *spans,
        ],
        names=["key", "part", "turns", "formatted", "loss_from", "loss_to"],
    )


def _format(batches: Batches, most: int) -> Batches:
    """Rows of whole conversations, or of `SLICE` bytes of one, at a time."""
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []

    def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        nonlocal number
        done = _formatted(pa.Table.from_batches(rows), number, most)
        number += len(done)
        return done

    for batch in batches:
        size = pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)
        # Slices end where a conversation does; what is open at the end waits for the next batch.
        ends = np.append(run_starts(batch.column("key").dictionary_encode(null_encoding="encode").indices.to_numpy())[1:], len(batch))
        at, filled = 0, sum(b.nbytes for b in held)
        if held and held[-1].column("key")[-1] != batch.column("key")[0] and not _both_missing(held[-1], batch):
            yield flush(held)
            held, filled = [], 0
        for end in ends:
            filled += int(size[at:end].sum())
            held.append(batch.slice(at, end - at))
            at = end
            if filled > SLICE or end < len(batch) and filled > SLICE // 4:
                yield flush(held)
                held, filled = [], 0
    if held:
        yield flush(held)


def _both_missing(last: pa.RecordBatch, batch: pa.RecordBatch) -> bool:
    return not last.column("key")[-1].is_valid and not batch.column("key")[0].is_valid


def format_conversations(
    rows: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_bytes: int = PART,
) -> DataFrame:
    """key, part, turns, formatted, loss_from and loss_to of each conversation.

    ``formatted`` is text; the loss spans are positions of its UTF-8 bytes. Parts follow each
    other by ``part``; most conversations have one.
    """
    kind = rows.schema[key].dataType.simpleString()
    plain = rows.select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        utf8(text).alias("text"),
        F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["key", "turn", "role", "hash", "row"]
    ranged = plain.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "role", "text")
    found = in_arrow(
        ranged,
        lambda batches: _format(batches, part_bytes),
        f"key {kind}, part bigint, turns bigint, formatted binary, loss_from array<bigint>, loss_to array<bigint>",
    )
    return found.withColumn("formatted", F.col("formatted").cast("string")).withColumnRenamed("key", key)


def _read_back(batches: Batches) -> Batches:
    """Turns and learned text of each conversation, parsed from its parts in order."""
    done: list[tuple] = []
    state: list | None = None
    kind = None

    def close(state: list) -> tuple:
        return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

    def hand_on() -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        columns = [pa.array([row[i] for row in done], k) for i, k in enumerate(kinds)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        kind = batch.schema.field("key").type
        columns = [batch.column(name) for name in ("key", "formatted", "loss_from", "loss_to")]
        for i in range(len(batch)):
            name = columns[0][i].as_py()
            if state is None or state[0] != name:
                if state is not None:
                    done.append(close(state))
                state = [name, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            whole = columns[1][i].as_py()
            for written_turn in whole.split(CLOSE)[:-1]:
                head, _, text = written_turn.partition(b"\n")
                state[1] += 1
                state[2].update(role_of(head) + b"\n" + unescaped(text) + b"\n")
            for start, end in zip(columns[2][i].as_py(), columns[3][i].as_py(), strict=True):
                text = unescaped(whole[start:end])
                state[3] += characters(text)
                state[4].update(text)
            state[5] += characters(whole)
        if done:
            yield hand_on()
    if state is not None:
        done.append(close(state))
        yield hand_on()


def chat_digest(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What the formatted conversations hold, read back from them alone.

    A hash over a conversation needs its parts in order, so they pass one task, part by part.
    """
    narrow = formatted.select(
        F.col(key).alias("key"), "part", F.col("formatted").cast("binary").alias("formatted"), "loss_from", "loss_to"
    )
    dealt = narrow.repartition("key").sortWithinPartitions("key", "part")
    kind = formatted.schema[key].dataType.simpleString()
    found = in_arrow(
        dealt,
        _read_back,
        f"key {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
    return found.withColumnRenamed("key", key)
