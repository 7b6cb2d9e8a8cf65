"""Cross-tokenizer alignment: where two tokenizers cut a text at the same byte.

A text, with a space before it, is encoded by a byte-level tokenizer (A) and by a
piece tokenizer (B). The cumulative byte ends of each side's tokens go into a dictionary from
end to index; the intersection of the two key sets, sorted, slices both id lists into
groups, and each slice is expanded to its links, the A and B tokens whose ranges end
together. Tokens are never empty, so that is the last of each side.

Neither tokenizer joins across a single space between two characters that are not white space
(the byte-level pattern starts a word there; no piece holds a space behind anything else,
which is checked). Both cut there, so a text is dealt with chunk by chunk, a distinct chunk is
aligned once in a while, and a text of any length costs bounded memory beside its ids.

As a job: one pass encodes, aligns and stores the digest with the text's links, each a
number below `Alignment.pairs`. Two linked tokens end at one byte, so one's bytes are
the end of the other's: the vocabularies alone say which pairs can be linked (some 300,000
for those used here), whatever the corpus. Links are counted inside tasks by that number
and summed in a shuffle, and the counts, bounded by the vocabularies, are sent to a
second pass over the stored links.

Defined cases: a missing or empty text, one that is not UTF-8, and one whose tokens do not
spell it on either side have no tokens, all zeros and an empty hash; rows without an id and
repeated rows count each for itself; an empty table gives an empty table; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bugtide.llm.tools import Batches, in_arrow, lists, pieces, ranges, utf8
from bugtide.storage import written

#: Distinct chunks that a worker remembers.
REMEMBERED = 500_000
#: Ids of chunks that a worker remembers.
REMEMBERED_IDS = 6_000_000
#: Bytes of text that are encoded at once.
SLICE = 2_000_000
#: Characters of a text whose chunks are looked up at once.
SECTION = 1_000_000
#: Chunks that are written into a hash at once.
WRITTEN = 100_000
#: New chunks that are encoded as one text.
JOINED = 500

_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(0x100) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


def piece_bytes(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(_SPACE, " ").encode()


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted codes a * len(b) + b of the id pairs of which one token's bytes end the other's."""
    found = set()
    for mine, other, code in ((a, b, lambda i, j: i * len(b) + j), (b, a, lambda i, j: j * len(b) + i)):
        by_bytes: dict[bytes, list[int]] = {}
        for i, token in enumerate(other):
            by_bytes.setdefault(token, []).append(i)
        for i, token in enumerate(mine):
            for k in range(len(token)):
                found.update(code(i, j) for j in by_bytes.get(token[k:], ()))
    return np.array(sorted(found), dtype=np.int64)


class Ragged:
    """Lists of numbers one after another, looked up by their place."""

    def __init__(self):
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)

    def add(self, flat: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        new = np.concatenate(sizes)
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(new) - new)
        self.sizes = np.append(self.sizes, new)
        self.flat = np.concatenate([self.flat, *flat]).astype(np.int32)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at these places, joined, and their sizes."""
        sizes = self.sizes[at]
        return self.flat[ranges(self.starts[at], sizes)], sizes


@dataclass
class Aligned:
    """Ids of both sides, where each group ends in them, and the number of each link's pair."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    links: np.ndarray


class Aligner:
    """Both tokenizers, the pairs their tokens can form, and the chunks met so far."""

    def __init__(self, byte_level: str, piece_model: str):
        # The tasks are the parallelism; threads inside each would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        letters = byte_letters()
        self.a_bytes = [
            bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
            for entry in map(self.a.id_to_token, range(self.a.get_vocab_size()))
        ]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE in name.lstrip(_SPACE) for name in names):
            raise ValueError("a piece holds a space behind another character; texts cannot be cut there")
        self.b_bytes = [piece_bytes(name) for name in names]
        self.sizes = [np.array(list(map(len, side))) for side in (self.a_bytes, self.b_bytes)]
        self.pairs = linkable(self.a_bytes, self.b_bytes)
        # How an id is written inside its side of a group, and at the end of it.
        self.marks = [
            f"{i}{mark}".encode()
            for size, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
            for i in range(size)
            for mark in ends
        ]
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.sound = np.zeros(0, dtype=bool)
        self.known = {name: Ragged() for name in ("a", "b", "a_ends", "b_ends", "links")}
        #: The groups of each chunk as text.
        self.written: list[bytes] = []

    def align(self, text: bytes, a: list[int], b: list[int]) -> Aligned | None:
        """The groups of both id lists; nothing if a side does not spell the text."""
        sides = [list(map(table.__getitem__, ids)) for table, ids in ((self.a_bytes, a), (self.b_bytes, b))]
        if any(b"".join(side) != text for side in sides):
            return None
        ids = [np.array(x, dtype=np.int64) for x in (a, b)]
        to_index = [
            dict(zip(np.cumsum(size[x]).tolist(), range(1, len(x) + 1), strict=True)) for size, x in zip(self.sizes, ids, strict=True)
        ]
        common = sorted(to_index[0].keys() & to_index[1].keys())
        a_ends, b_ends = (np.fromiter(map(side.__getitem__, common), dtype=np.int64, count=len(common)) for side in to_index)
        # In a slice the last tokens alone end together.
        codes = ids[0][a_ends - 1] * len(self.b_bytes) + ids[1][b_ends - 1]
        return Aligned(ids[0], ids[1], a_ends, b_ends, np.searchsorted(self.pairs, codes))

    def _marked(self, found: Aligned) -> list[bytes]:
        """The written ids in the order of the groups, A before B."""
        sizes = [np.diff(ends, prepend=0) for ends in (found.a_ends, found.b_ends)]
        code = np.empty(len(found.a) + len(found.b), dtype=np.int64)
        # A group's A ids stand behind all B ids of the groups before it, its B ids behind its own A ids too.
        a_place = np.arange(len(found.a)) + np.repeat(found.b_ends - sizes[1], sizes[0])
        b_place = np.arange(len(found.b)) + np.repeat(found.a_ends, sizes[1])
        code[a_place] = 2 * found.a
        code[b_place] = 2 * (found.b + len(self.a_bytes))
        code[a_place[found.a_ends - 1]] += 1
        code[b_place[found.b_ends - 1]] += 1
        return list(map(self.marks.__getitem__, code.tolist()))

    def _learn(self, chunks: list[str]) -> None:
        """Encode and align distinct new chunks, each of them the text after a space.

        Chunks that leave their neighbours alone are joined and dealt with as one text.
        """
        alone = [c[-1].isspace() or _SPACE in c for c in chunks]
        calm = [c for c, a in zip(chunks, alone, strict=True) if not a]
        runs = [calm[i : i + JOINED] for i in range(0, len(calm), JOINED)]
        runs += [[c] for c, a in zip(chunks, alone, strict=True) if a]
        self._learn_runs(runs)

    def _learn_runs(self, runs: list[list[str]]) -> None:
        texts = [" ".join(run) for run in runs]
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        flat: dict[str, list[np.ndarray]] = {name: [] for name in self.known}
        sizes: dict[str, list[np.ndarray]] = {name: [] for name in self.known}
        sound, again, kept = [], [], []
        for run, text, x, y in zip(runs, texts, a, b, strict=True):
            found = self.align(b" " + text.encode(), x.ids, y)
            if found is None and len(run) > 1:
                again += [[c] for c in run]
                continue
            kept += run
            sound.append(np.full(len(run), found is not None))
            if found is None:
                none = np.zeros(0, dtype=np.int64)
                for name in self.known:
                    flat[name].append(none)
                    sizes[name].append(np.zeros(1, dtype=np.int64))
                self.written.append(b"")
                continue
            # The chunks' ends are ends of groups.
            ends = np.cumsum([1 + len(c.encode()) for c in run])
            at = np.cumsum(self.sizes[0][found.a])[found.a_ends - 1]
            last = np.searchsorted(at, ends)
            if not np.array_equal(at[last], ends):
                raise ValueError("a tokenizer joined two chunks")
            groups = np.diff(last, prepend=-1)
            a_upto, b_upto = found.a_ends[last], found.b_ends[last]
            a_sizes, b_sizes = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
            marks = self._marked(found)
            both = (a_upto + b_upto).tolist()
            self.written += [b"".join(marks[i:j])[:-1] for i, j in pairwise([0, *both])]
            for name, values, n in (
                ("a", found.a, a_sizes),
                ("b", found.b, b_sizes),
                ("a_ends", found.a_ends - np.repeat(a_upto - a_sizes, groups), groups),
                ("b_ends", found.b_ends - np.repeat(b_upto - b_sizes, groups), groups),
                ("links", found.links, groups),
            ):
                flat[name].append(values)
                sizes[name].append(n)
        if kept:
            self.index.update(zip(kept, range(len(self.index), len(self.index) + len(kept)), strict=True))
            self.sound = np.concatenate([self.sound, *sound])
            for name, known in self.known.items():
                known.add(flat[name], sizes[name])
        if again:
            self._learn_runs(again)

    def _places(self, chunks: list[str]) -> np.ndarray:
        """The numbers of chunks; new ones are learnt first."""
        at = np.fromiter(map(self.index.get, chunks, repeat(-1)), dtype=np.int64, count=len(chunks))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = [chunks[i] for i in unknown]
            self._learn(list(dict.fromkeys(new)))
            at[unknown] = np.fromiter(map(self.index.__getitem__, new), dtype=np.int64, count=len(new))
        return at

    def texts(self, texts: list[bytes]) -> Iterator[np.ndarray | None]:
        """The numbers of each text's chunks; none for a text without tokens."""
        if len(self.index) > REMEMBERED or len(self.known["a"].flat) > REMEMBERED_IDS:
            self.forget()
        decoded = []
        for text in texts:
            try:
                decoded.append(text.decode())
            except UnicodeDecodeError:
                decoded.append("")
        # The chunks of a slice are looked up together, those of a long text section by section.
        short = [_CUT.split(t) if 0 < len(t) <= SECTION else [] for t in decoded]
        places = self._places(list(chain.from_iterable(short)))
        bounds = list(accumulate(map(len, short), initial=0))
        for text, (i, j) in zip(decoded, pairwise(bounds), strict=True):
            at = self._long(text) if len(text) > SECTION else places[i:j]
            yield at if len(at) and self.sound[at].all() else None

    def _long(self, text: str) -> np.ndarray:
        parts, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + SECTION)
            end = cut.start() if cut else len(text)
            parts.append(self._places(_CUT.split(text[start:end])))
            start = end + 1
        return np.concatenate(parts)

    def joined(self, at: np.ndarray) -> Aligned:
        """Chunks one after another as one alignment."""
        a, a_sizes = self.known["a"].take(at)
        b, b_sizes = self.known["b"].take(at)
        a_ends, groups = self.known["a_ends"].take(at)
        b_ends, _ = self.known["b_ends"].take(at)
        a_ends = a_ends + np.repeat(np.cumsum(a_sizes) - a_sizes, groups)
        b_ends = b_ends + np.repeat(np.cumsum(b_sizes) - b_sizes, groups)
        return Aligned(a, b, a_ends, b_ends, self.known["links"].take(at)[0])

    def counts(self, at: np.ndarray) -> tuple[int, int, int, int]:
        """Ids of A and of B, groups and links of chunks."""
        return tuple(int(self.known[name].sizes[at].sum()) for name in ("a", "b", "a_ends", "links"))

    def digest(self, at: np.ndarray) -> str:
        """SHA-256 of the groups of chunks, written as ``a1,a2|b1;a3|b2,b3``."""
        state = hashlib.sha256()
        for i in range(0, len(at), WRITTEN):
            state.update((b";" if i else b"") + b";".join(map(self.written.__getitem__, at[i : i + WRITTEN].tolist())))
        return state.hexdigest()


@lru_cache(maxsize=2)
def aligner(byte_level: str, piece_model: str) -> Aligner:
    return Aligner(byte_level, piece_model)


def _narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), utf8(text).alias("_text"))


def align(docs: DataFrame, byte_level: str, piece_model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, a_ids, b_ids, a_ends, b_ends: the ids of both sides, and the number of ids up to the end of each group.

    The last ids of a group's two sides are linked.
    """

    def work(batches: Batches) -> Batches:
        of = aligner(byte_level, piece_model)
        none = np.zeros(0, dtype=np.int32)
        for batch in batches:
            for rows, texts in pieces(batch, "_text", SLICE):
                found = [Aligned(none, none, none, none, none) if at is None else of.joined(at) for at in of.texts(texts)]
                columns = [[f.a for f in found], [f.b for f in found], [f.a_ends for f in found], [f.b_ends for f in found]]
                made = [lists(np.concatenate(c).astype(np.int32), np.array([len(x) for x in c])) for c in columns]
                yield pa.RecordBatch.from_arrays([rows.column(0), *made], names=["_key", "a_ids", "b_ids", "a_ends", "b_ends"])

    kind = docs.schema[key].dataType.simpleString()
    found = in_arrow(_narrow(docs, key, text), work, f"_key {kind}, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")
    return found.withColumnRenamed("_key", key)


def _digested(batches: Batches, byte_level: str, piece_model: str) -> Batches:
    of = aligner(byte_level, piece_model)
    for batch in batches:
        for rows, texts in pieces(batch, "_text", SLICE):
            sizes, hashes, links = [], [], []
            for at in of.texts(texts):
                sizes.append((0, 0, 0, 0) if at is None else of.counts(at))
                hashes.append("" if at is None else of.digest(at))
                links.append(b"" if at is None else of.known["links"].take(at)[0].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *(pa.array(c, pa.int64()) for c in zip(*sizes, strict=True)), pa.array(hashes), pa.array(links, pa.binary())],
                names=["_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
            )


def _link_counts(batches: Batches, pairs: int) -> Batches:
    """How often each pair is linked in the task's rows."""
    total = np.zeros(pairs, dtype=np.int64)
    for batch in batches:
        for links in batch.column("links").to_pylist():
            total += np.bincount(np.frombuffer(links, dtype="<u4"), minlength=pairs) if len(links) > pairs else 0
            if 0 < len(links) <= pairs:
                pair, times = np.unique(np.frombuffer(links, dtype="<u4"), return_counts=True)
                total[pair] += times
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["pair", "n"])


def alignment_digest(docs: DataFrame, byte_level: str, piece_model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The alignment of each text in numbers, with how common its links are in all texts."""
    kind = docs.schema[key].dataType.simpleString()
    stored = written(
        in_arrow(
            _narrow(docs, key, text),
            lambda batches: _digested(batches, byte_level, piece_model),
            f"_key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary",
        )
    )
    known = aligner(byte_level, piece_model)
    pairs, wide = known.pairs, len(known.b_bytes)
    counted = in_arrow(stored.select("links"), lambda batches: _link_counts(batches, len(pairs)), "pair bigint, n bigint")
    # At most one row for each pair that the vocabularies allow.
    rows = counted.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(len(pairs), dtype=np.int64)
    count[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    highest = np.zeros(wide, dtype=np.int64)
    np.maximum.at(highest, pairs % wide, count)
    sent = docs.sparkSession.sparkContext.broadcast((count, count == highest[pairs % wide]))

    def rate(batches: Batches) -> Batches:
        count, best = sent.value
        for batch in batches:
            links = [np.frombuffer(x, dtype="<u4") for x in batch.column("links").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([int(np.count_nonzero(best[x])) for x in links], pa.int64()),
                    pa.array([int(count[x].sum()) for x in links], pa.int64()),
                ],
                names=[*batch.schema.names[:-1], "n_best", "count_sum"],
            )

    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rated = in_arrow(
        stored, rate, f"_key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    )
    return rated.select(F.col("_key").alias(key), *names)
