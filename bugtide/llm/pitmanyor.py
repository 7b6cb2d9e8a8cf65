"""Scoring by a hierarchical Pitman-Yor language model, seated by Gibbs sampling.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, then one
end. The model has a root restaurant and `CLASSES` context restaurants that share it as
their parent: a token's context is the word before it (the end, before the first),
put into a class by its hash, so that frequent words own a restaurant in practice and
rare ones share one. The root's parent is uniform over the training words and one
unknown word. Customers of a context restaurant are training tokens; every table of it
sends one customer to the root.

Seating is sampled by Gibbs: all customers of a word in a restaurant are unseated and
their number of tables is drawn from its conditional given the other tables and the
parent's probability of the word (exact up to `EXACT` customers, through generalised
Stirling numbers; beyond, customers are seated one after another, in growing groups).
Probabilities use only the numbers of customers and tables. They are averaged over
`SAMPLES` states after `BURN_IN`. Discounts come from counts of counts.

As a job: a survey counts tokens and words; a word with more than a quarter of a
bucket is hot, and so is a pair of word and context. Each block of documents then sends
its (word, context, document) triples, sorted and packed, to the bucket of the word; hot
words are spread over all buckets by context, hot pairs by block. There is at most one
of either for each `BUCKET_TOKENS` / 4 tokens. A bucket thus holds all restaurants'
customers of its words, but for hot pairs, whose tables are drawn with the totals.
Between global rounds only the restaurants' totals travel (`CLASSES` numbers, and two
for each hot word or pair).
Sums of log probabilities go back by block and document. Buckets are sized by tokens;
the packed triples are checkpointed to the shared folder between rounds.

Defined cases: a missing or empty text is one end token; a missing id counts as the
empty text for the split; repeated rows are scored each for itself (and counted each);
without any training token all probabilities are uniform; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from bugtide.llm.tools import Batches, grouped, in_arrow, lists, pieces, run_starts, split_remainder, utf8

CLASS_BITS = 14
CLASSES = 1 << CLASS_BITS
#: Documents and bytes of a block.
DOCUMENT_BITS = 12
BLOCK_BYTES = 6_000_000
#: Tokens that a bucket aims at.
BUCKET_TOKENS = 4_000_000
MAX_BUCKETS = 1 << 20
#: A word, or a pair of word and context, with this share of a bucket's tokens is hot.
HOT_SHARE = 1 / 4
#: A block counts pairs that it holds so often; of any other pair it holds next to nothing.
PAIR_LEAST = 32
STRENGTH = 1.0
EXACT = 64
#: Beyond, so many shares of the seated customers are seated at once.
GROUPS = 32
BURN_IN = 2
SAMPLES = 3
SEED = 11
#: Words whose hash a task remembers.
REMEMBERED = 400_000
_END = np.uint64(xxh64_intdigest(b" "))
_MIX = np.uint64(0x9E3779B97F4A7C15)


NO_WORDS = np.zeros(0, dtype=np.uint64)
#: Words and contexts.
NO_PAIRS = (NO_WORDS, np.zeros(0, dtype=np.int64))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


def token_hashes(texts: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and their number for each text."""
    split = [t.lower().split() for t in texts]
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    hashes = np.empty(int(sizes.sum()) + len(split), dtype=np.uint64)
    at = 0
    for words in split:
        past = at + len(words)
        hashes[at:past] = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        hashes[past] = _END
        at = past + 1
    return hashes, sizes + 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def contexts(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The class of the token before each, the end's before a text's first."""
    before = np.concatenate([[_END], hashes[:-1]]) if len(hashes) else hashes
    return (_mixed(before) >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def pair_codes(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """One number for a word in a context."""
    return _mixed(hashes + classes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def buckets(
    hashes: np.ndarray, classes: np.ndarray, hot: np.ndarray, count: int, pairs: tuple[np.ndarray, np.ndarray] = NO_PAIRS, block: int = 0
) -> np.ndarray:
    """The bucket of each token: by its word, of a hot word by word and context, of a hot pair by block too."""
    spread = np.isin(hashes, hot)
    codes = pair_codes(hashes, classes)
    own = np.where(spread, codes, _mixed(hashes))
    if len(pairs[0]):
        dealt = np.isin(codes, pair_codes(*pairs))
        own[dealt] = _mixed(codes[dealt] + _mixed(np.full(1, block + 1, dtype=np.uint64) * _MIX))
    return ((own >> np.uint64(32)) % np.uint64(count)).astype(np.int64)


# --- the survey ---------------------------------------------------------------


def _survey(batches: Batches) -> Batches:
    known = WordHashes()
    for batch in batches:
        for rows, texts in pieces(batch, "_text", BLOCK_BYTES):
            hashes, sizes = token_hashes(texts, known)
            train = ~np.array(rows.column(1).to_pylist(), dtype=bool)
            values, counts = np.unique(hashes, return_counts=True)
            classes = contexts(hashes, sizes)
            _, first, times = np.unique(pair_codes(hashes, classes), return_index=True, return_counts=True)
            first, times = first[times >= PAIR_LEAST], times[times >= PAIR_LEAST]
            n, m = len(values), len(first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.zeros(2, np.uint64), values, hashes[first]]).view(np.int64)),
                    pa.array(np.concatenate([np.full(n + 2, -1), classes[first]]).astype(np.int32)),
                    pa.array(np.repeat([0, 1, 2, 3], [1, 1, n, m]).astype(np.int32)),
                    pa.array(np.concatenate([[sizes.sum(), sizes[train].sum()], counts, times]).astype(np.int64)),
                ],
                names=["_word", "_class", "_kind", "_n"],
            )


# --- packing triples ------------------------------------------------------------


def _pack(batches: Batches, hot: np.ndarray, count: int, pairs: tuple[np.ndarray, np.ndarray]) -> Batches:
    known, packer = WordHashes(), zstandard.ZstdCompressor(level=1)
    block = TaskContext.get().partitionId() << 24
    for batch in batches:
        for part, _ in pieces(batch, "_text", BLOCK_BYTES):
            for at in range(0, part.num_rows, 1 << DOCUMENT_BITS):
                rows = part.slice(at, 1 << DOCUMENT_BITS)
                hashes, sizes = token_hashes(rows.column(2).to_pylist(), known)
                held = np.array(rows.column(1).to_pylist(), dtype=bool)
                yield from _packed(block, rows.column(0), hashes, sizes, held, hot, count, packer, pairs)
                block += 1


def _packed(block, keys, hashes, sizes, held, hot, count, packer, pairs=NO_PAIRS) -> Iterator[pa.RecordBatch]:
    classes = contexts(hashes, sizes)
    bucket = buckets(hashes, classes, hot, count, pairs, block)
    document = np.repeat(np.arange(len(sizes)), sizes)
    # A unit is a word, or the part of a hot word that goes to one bucket.
    unit = np.where(np.isin(hashes, hot), _mixed(hashes + bucket.astype(np.uint64)), hashes)
    _, first, inverse = np.unique(unit, return_index=True, return_inverse=True)
    order = np.argsort(bucket[first], kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    flags = (held[document].astype(np.int64) << DOCUMENT_BITS) | document
    entries = (place[inverse] << (CLASS_BITS + DOCUMENT_BITS + 1)) | (classes << (DOCUMENT_BITS + 1)) | flags
    entries.sort()
    owner = entries >> (CLASS_BITS + DOCUMENT_BITS + 1)
    per_unit = np.bincount(owner, minlength=len(order))
    unit_bucket, words = bucket[first][order], hashes[first][order]
    cuts = np.append(run_starts(unit_bucket), len(order))
    ends = np.concatenate([[0], np.cumsum(per_unit)])
    classes = (entries >> (DOCUMENT_BITS + 1) & (CLASSES - 1)).astype(np.uint16)
    flags = (entries & ((1 << (DOCUMENT_BITS + 1)) - 1)).astype(np.uint16)
    blobs, shapes = [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        x, y = ends[a], ends[b]
        data = (words[a:b].tobytes(), per_unit[a:b].astype(np.uint32).tobytes(), classes[x:y].tobytes(), flags[x:y].tobytes())
        blobs.append(packer.compress(b"".join(data)))
        shapes.append((int(unit_bucket[a]), int(b - a), int(y - x)))
    n = len(blobs)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([s[0] for s in shapes] + [-1], pa.int32()),
            pa.array([block] * (n + 1), pa.int64()),
            pa.array([s[1] for s in shapes] + [0], pa.int32()),
            pa.array([s[2] for s in shapes] + [0], pa.int32()),
            pa.array([*blobs, None], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(keys)], pa.int32()), keys),
            pa.array([[]] * n + [held.tolist()], pa.list_(pa.bool_())),
            pa.array([[]] * n + [sizes.tolist()], pa.list_(pa.int64())),
        ],
        names=["_bucket", "_block", "_units", "_entries", "_blob", "_keys", "_held", "_sizes"],
    )


class Bucket:
    """All triples of a bucket's words: entries by (word, context), with their documents."""

    def __init__(self, table: pa.Table):
        unpack = zstandard.ZstdDecompressor()
        words, counts, classes, flags, blocks = [], [], [], [], []
        columns = (table.column(c).to_pylist() for c in ("_blob", "_units", "_entries", "_block"))
        for blob, units, entries, block in zip(*columns, strict=True):
            data = unpack.decompress(blob)
            words.append(np.frombuffer(data, np.uint64, units))
            counts.append(np.frombuffer(data, np.uint32, units, 8 * units).astype(np.int64))
            classes.append(np.frombuffer(data, np.uint16, entries, 12 * units))
            flags.append(np.frombuffer(data, np.uint16, entries, 12 * units + 2 * entries))
            blocks.append(block)
        self.blocks = np.array(blocks, dtype=np.int64)
        self.sizes = np.array([len(c) for c in classes], dtype=np.int64)
        self.flags = np.concatenate(flags)
        train = (self.flags >> DOCUMENT_BITS) == 0
        self.words, of_unit = np.unique(np.concatenate(words), return_inverse=True)
        word = np.repeat(of_unit, np.concatenate(counts))
        pairs = (word << CLASS_BITS) | np.concatenate(classes)
        self.pairs, self.of_entry = np.unique(pairs, return_inverse=True)
        self.word, self.context = self.pairs >> CLASS_BITS, self.pairs & (CLASSES - 1)
        self.customers = np.bincount(self.of_entry, weights=train, minlength=len(self.pairs)).astype(np.int64)
        self.counts = np.bincount(self.word, weights=self.customers, minlength=len(self.words)).astype(np.int64)


# --- seating ----------------------------------------------------------------------


def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """log of the generalised Stirling numbers S(c, t), for c, t up to ``most``."""
    table = np.full((most + 1, most + 1), -np.inf)
    table[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        stay = np.where(t <= c, table[c, t] + np.log(np.maximum(c - discount * t, 1e-300)), -np.inf)
        table[c + 1, t] = np.logaddexp(table[c, t - 1], stay)
    return table


def draw_tables(
    rng: np.random.Generator, customers: np.ndarray, base: np.ndarray, others: np.ndarray, discount: float, strength: float
) -> np.ndarray:
    """Numbers of tables of dishes with the given customers, each given the others' tables."""
    tables = np.minimum(customers, 1)
    stirling = log_stirling(discount)
    order = np.argsort(customers, kind="stable")
    ordered = customers[order]
    cuts = np.searchsorted(ordered, np.arange(2, EXACT + 2))
    for c, a, b in zip(range(2, EXACT + 1), cuts[:-1], cuts[1:], strict=True):
        # log of base^t * prod(strength + discount * (others + i)) * S(c, t)
        for at in range(a, b, 1_000_000 // c + 1):
            own = order[at : min(b, at + 1_000_000 // c + 1)]
            steps = np.log(base[own])[:, None] + np.log(strength + discount * (others[own][:, None] + np.arange(c)))
            weight = np.cumsum(steps, axis=1) + stirling[c, 1 : c + 1]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            pick = rng.random(len(own)) * weight[:, -1]
            tables[own] = 1 + (weight < pick[:, None]).sum(axis=1)
    large = order[cuts[-1] :][::-1]
    seated = np.ones(len(large), dtype=np.int64)
    opened = np.ones(len(large), dtype=np.int64)
    total = customers[large]
    live = np.arange(len(large))
    while len(live):
        k, t = seated[live], opened[live]
        more = np.minimum(np.maximum(1, k // GROUPS), total[live] - k)
        new = (strength + discount * (others[large[live]] + t)) * base[large[live]]
        opened[live] = t + rng.binomial(more, new / (new + k - discount * t))
        seated[live] = k + more
        live = live[seated[live] < total[live]]
    tables[large] = opened
    return tables


def discount_of(once: float, twice: float) -> float:
    """The usual estimate from the numbers of types seen once and twice."""
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.95)) if once + twice else 0.5


class Totals:
    """What all buckets have together: restaurants' customers and tables, the root's sums, hot words and pairs.

    ``hot`` is sorted. The tables of hot pairs, and the root's tables of hot words, are one
    each at first, and drawn by the totals ``before`` then.
    """

    def __init__(
        self,
        rows: dict[tuple[int, int], float],
        hot: np.ndarray = NO_WORDS,
        pairs: tuple[np.ndarray, np.ndarray] = NO_PAIRS,
        before: Totals | None = None,
    ):
        get = rows.get
        numbers = lambda kind, ids: np.array([get((kind, k), 0) for k in ids.view(np.int64).tolist()], dtype=np.int64)
        words, classes = pairs
        rng = np.random.default_rng([SEED, len(hot), len(words)])
        self.customers = np.array([get((0, c), 0.0) for c in range(CLASSES)])
        self.tables = np.array([get((1, c), 0.0) for c in range(CLASSES)])
        self.hot_counts, self.hot_customers = numbers(2, hot), numbers(3, hot)
        self.pair_customers = numbers(5, pair_codes(words, classes))
        self.pair_tables = np.minimum(self.pair_customers, 1)
        if before and len(words):
            base = before.root_probability(before.hot_customers, before.hot_root)[np.searchsorted(hot, words)]
            shared = np.bincount(classes, weights=before.pair_tables, minlength=CLASSES)
            others = self.tables[classes] + shared[classes] - before.pair_tables
            self.pair_tables = draw_tables(rng, self.pair_customers, base, others, before.discount, STRENGTH)
        np.add.at(self.tables, classes, self.pair_tables)
        np.add.at(self.hot_customers, np.searchsorted(hot, words), self.pair_tables)
        self.vocabulary = int(get((4, 0), 0)) + int((self.hot_counts > 0).sum())
        self.tokens = int(self.customers.sum())
        self.root_customers = self.tables.sum()
        self.discount = discount_of(get((4, 2), 0.0), get((4, 3), 0.0))
        self.root_discount = discount_of(get((4, 4), 0.0), get((4, 5), 0.0))
        self.root_tables = get((4, 1), 0.0)
        self.hot_root = np.minimum(self.hot_customers, 1)
        if before and len(hot):
            others = self.root_tables + before.hot_root.sum() - before.hot_root
            base = np.full(len(hot), 1 / (self.vocabulary + 1))
            self.hot_root = draw_tables(rng, self.hot_customers, base, others, self.root_discount, STRENGTH)
        self.root_tables += self.hot_root.sum()

    def root_probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Of words with these customers and tables of the root."""
        uniform = (STRENGTH + self.root_discount * self.root_tables) / (self.vocabulary + 1)
        return (np.maximum(customers - self.root_discount * tables, 0) + uniform) / (STRENGTH + self.root_customers)


class Seating:
    """One bucket's part of the seating; the rest of the restaurants is known by totals."""

    def __init__(
        self, bucket: Bucket, hot: np.ndarray, totals: Totals | None, seed: int, pairs: tuple[np.ndarray, np.ndarray] = NO_PAIRS
    ):
        self.bucket, self.totals = bucket, totals
        self.rng = np.random.default_rng([SEED, seed])
        # Hot words are in every bucket, and must be seated alike in all of them.
        self.alike = np.random.default_rng([SEED, len(hot)])
        # Hot pairs are seated with the totals; here is only a part of them.
        self.codes = pair_codes(*pairs)
        by = np.argsort(self.codes)
        own = pair_codes(bucket.words[bucket.word], bucket.context)
        self.shared = np.flatnonzero(np.isin(own, self.codes))
        self.pair = by[np.searchsorted(self.codes, own[self.shared], sorter=by)]
        self.customers = bucket.customers.copy()
        self.customers[self.shared] = 0
        self.seen = np.flatnonzero(self.customers > 0)
        self.tables = np.minimum(self.customers, 1)
        self.hot = np.isin(bucket.words, hot)
        self.place = np.searchsorted(hot, bucket.words[self.hot])
        self.hot_root = totals.hot_root if totals else np.zeros(len(hot), dtype=np.int64)
        self.before = self._by_class()
        self.root = np.zeros(len(bucket.words), dtype=np.int64)
        self._reseat_root()

    def _by_class(self) -> np.ndarray:
        return np.bincount(self.bucket.context, weights=self.tables, minlength=CLASSES)

    def root_customers(self) -> np.ndarray:
        own = np.bincount(self.bucket.word, weights=self.tables, minlength=len(self.bucket.words)).astype(np.int64)
        if self.totals:
            own[self.hot] = self.totals.hot_customers[self.place]
        return own

    def _reseat_root(self) -> None:
        if not self.totals:
            return
        customers = self.root_customers()
        others = np.maximum(self.totals.root_tables - self.root, 0)
        base = np.full(len(customers), 1 / (self.totals.vocabulary + 1))
        self.root = draw_tables(self.rng, customers, base, others, self.totals.root_discount, STRENGTH)
        if len(self.hot_root):
            t = self.totals
            base = np.full(len(self.hot_root), 1 / (t.vocabulary + 1))
            others = np.maximum(t.root_tables - self.hot_root, 0)
            self.hot_root = draw_tables(self.alike, t.hot_customers, base, others, t.root_discount, STRENGTH)
            self.root[self.hot] = self.hot_root[self.place]

    def root_probability(self) -> np.ndarray:
        return self.totals.root_probability(self.root_customers(), self.root)

    def restaurant_tables(self) -> np.ndarray:
        """Tables of all restaurants: the last totals, moved by what changed here."""
        return np.maximum(self.totals.tables + self._by_class() - self.before, 0)

    def sweep(self) -> None:
        b = self.bucket
        base = self.root_probability()[b.word[self.seen]]
        others = np.maximum(self.restaurant_tables()[b.context[self.seen]] - self.tables[self.seen], 0)
        self.tables[self.seen] = draw_tables(
            self.rng, self.customers[self.seen], base, others, self.totals.discount, STRENGTH
        )
        self._reseat_root()

    def synced(self, totals: Totals) -> None:
        self.totals, self.before = totals, self._by_class()
        self._reseat_root()

    def probabilities(self) -> np.ndarray:
        """Of every (word, context) pair."""
        b, t = self.bucket, self.totals
        back = STRENGTH + t.discount * self.restaurant_tables()[b.context]
        customers, tables = self.customers.copy(), self.tables.copy()
        customers[self.shared], tables[self.shared] = t.pair_customers[self.pair], t.pair_tables[self.pair]
        own = np.maximum(customers - t.discount * tables, 0)
        return (own + back * self.root_probability()[b.word]) / (STRENGTH + t.customers[b.context])

    def report(self) -> dict[str, np.ndarray]:
        """Rows (kind, id, value) that add up to `Totals` over all buckets."""
        b, cold = self.bucket, ~self.hot
        customers = np.bincount(b.context, weights=b.customers, minlength=CLASSES)
        used = np.flatnonzero(customers)
        hot_words = b.words[self.hot].view(np.int64)
        own = np.bincount(b.word, weights=self.tables, minlength=len(b.words))
        once = [(self.customers == n).sum() for n in (1, 2)]
        root_once = [(own[cold] == n).sum() for n in (1, 2)]
        root_tables = self.root[cold].sum() if self.totals else (own[cold] > 0).sum()
        scalars = [(b.counts[cold] > 0).sum(), root_tables, *once, *root_once]
        codes = self.codes[self.pair].view(np.int64)
        kinds = np.repeat([0, 1, 2, 3, 4, 5], [len(used), len(used), len(hot_words), len(hot_words), len(scalars), len(codes)])
        ids = np.concatenate([used, used, hot_words, hot_words, np.arange(len(scalars)), codes])
        values = np.concatenate(
            [customers[used], self._by_class()[used], b.counts[self.hot], own[self.hot], scalars, b.customers[self.shared]]
        )
        return {"kind": np.array(kinds, dtype=np.int32), "id": ids.astype(np.int64), "value": values.astype(float)}


def _round(batches: Batches, hot: np.ndarray, totals: Totals | None, pairs: tuple[np.ndarray, np.ndarray]) -> Batches:
    """Totals of the first state, or of the state after the burn-in."""
    for table in grouped(batches, "_bucket"):
        bucket = table.column("_bucket")[0].as_py()
        if bucket < 0:
            continue
        seating = Seating(Bucket(table), hot, totals, bucket, pairs)
        if totals:
            for _ in range(BURN_IN):
                seating.sweep()
        yield pa.RecordBatch.from_pydict(seating.report())


def _scores(batches: Batches, hot: np.ndarray, first: Totals, totals: Totals, pairs: tuple[np.ndarray, np.ndarray]) -> Batches:
    """Sums by block and document: known tokens, log10(count + 1), log10 of the probability."""
    for table in grouped(batches, "_bucket"):
        bucket = table.column("_bucket")[0].as_py()
        if bucket < 0:
            yield _documents(table)
            continue
        own = Bucket(table)
        seating = Seating(own, hot, first, bucket, pairs)
        for _ in range(BURN_IN):
            seating.sweep()
        seating.synced(totals)
        mean = np.zeros(len(own.pairs))
        for _ in range(SAMPLES):
            seating.sweep()
            mean += seating.probabilities() / SAMPLES
        counts = own.counts.copy()
        counts[seating.hot] = totals.hot_counts[seating.place]
        score = np.log10(mean)[own.of_entry]
        word = own.word[own.of_entry]
        base = np.log10(counts + 1.0)[word]
        known = (counts > 0)[word]
        document = (own.flags & ((1 << DOCUMENT_BITS) - 1)).astype(np.int64)
        place = (np.repeat(np.arange(len(own.blocks)), own.sizes) << DOCUMENT_BITS) | document
        size = len(own.blocks) << DOCUMENT_BITS
        total = np.bincount(place, minlength=size)
        used = np.flatnonzero(total)
        sums = [np.bincount(place, weights=x, minlength=size)[used] for x in (known, base, score)]
        per_block = np.bincount(used >> DOCUMENT_BITS, minlength=len(own.blocks))
        n = len(own.blocks)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(own.blocks),
                lists((used & ((1 << DOCUMENT_BITS) - 1)).astype(np.int16), per_block),
                lists(sums[0].astype(np.int32), per_block),
                lists(sums[1], per_block),
                lists(sums[2], per_block),
                pa.ListArray.from_arrays(pa.array([0] * (n + 1), pa.int32()), table.column("_keys").combine_chunks().values[:0]),
                pa.array([[]] * n, pa.list_(pa.bool_())),
                pa.array([[]] * n, pa.list_(pa.int64())),
            ],
            names=["_block", "_document", "_known", "_base", "_score", "_keys", "_held", "_sizes"],
        )


def _documents(table: pa.Table) -> pa.RecordBatch:
    n = table.num_rows
    empty = lambda kind: pa.array([[]] * n, pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            table.column("_block").combine_chunks(),
            empty(pa.int16()),
            empty(pa.int32()),
            empty(pa.float64()),
            empty(pa.float64()),
            *(table.column(c).combine_chunks() for c in ("_keys", "_held", "_sizes")),
        ],
        names=["_block", "_document", "_known", "_base", "_score", "_keys", "_held", "_sizes"],
    )


def _added(batches: Batches, totals: Totals) -> Batches:
    """The documents of each block, with the sums over all buckets."""
    for table in grouped(batches, "_block"):
        flat = lambda c: table.column(c).combine_chunks().flatten()  # noqa: E731, B023
        keys, held, sizes = (flat(c) for c in ("_keys", "_held", "_sizes"))
        sizes = sizes.to_numpy()
        n, at = len(keys), flat("_document").to_numpy()
        known, base, score = (
            np.bincount(at, weights=flat(c).to_numpy(), minlength=n) for c in ("_known", "_base", "_score")
        )
        base = base - sizes * np.log10(totals.tokens + totals.vocabulary + 1)
        yield pa.RecordBatch.from_arrays(
            [
                keys,
                held,
                pa.array(sizes),
                pa.array(known.astype(np.int64)),
                pa.array(np.full(n, totals.tokens, dtype=np.int64)),
                pa.array(base),
                pa.array(score),
            ],
            names=["_key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )


def score_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2, bucket_tokens: int = BUCKET_TOKENS
) -> DataFrame:
    """Key, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Rows whose crc32(key as text) leaves ``fold`` modulo ``folds`` are held out.
    """
    narrow = docs.select(
        F.col(key).alias("_key"), (split_remainder(key, folds) == fold).alias("_held"), utf8(text).alias("_text")
    )
    survey = in_arrow(narrow, _survey, "_word bigint, _class int, _kind int, _n bigint")
    survey = survey.groupBy("_kind", "_word", "_class").agg(F.sum("_n").alias("_n"))
    # Two sums, and hot words and pairs: each stands for so many tokens.
    top = survey.where((F.col("_kind") < 2) | (F.col("_n") >= max(1, HOT_SHARE * bucket_tokens))).collect()
    all_tokens = next((r["_n"] for r in top if r["_kind"] == 0), 0)
    count = int(min(MAX_BUCKETS, max(1, -(-all_tokens // bucket_tokens))))
    chosen = lambda kind, name: np.array([r[name] for r in top if r["_kind"] == kind and count > 1], dtype=np.int64)
    hot = np.sort(chosen(2, "_word").view(np.uint64))
    pairs = chosen(3, "_word").view(np.uint64), chosen(3, "_class")
    # The same in every run, whatever the order of rows.
    by = np.argsort(pair_codes(*pairs))
    pairs = pairs[0][by], pairs[1][by]
    kind = docs.schema[key].dataType.simpleString()
    attributes = f"_keys array<{kind}>, _held array<boolean>, _sizes array<bigint>"
    packed = in_arrow(
        narrow,
        lambda batches: _pack(batches, hot, count, pairs),
        f"_bucket int, _block bigint, _units int, _entries int, _blob binary, {attributes}",
    )
    # Documents' own rows have no bucket and are dealt by block.
    place = F.when(F.col("_bucket") < 0, F.pmod(F.col("_block"), F.lit(count)).cast("int")).otherwise(F.col("_bucket"))
    dealt = packed.repartitionById(count, place)
    dealt = dealt.sortWithinPartitions("_bucket", "_block").checkpoint()

    def totals_of(totals: Totals | None) -> Totals:
        rows = in_arrow(dealt, lambda batches: _round(batches, hot, totals, pairs), "kind int, id bigint, value double")
        return Totals({(r[0], r[1]): r[2] for r in rows.groupBy("kind", "id").agg(F.sum("value")).collect()}, hot, pairs, totals)

    first = totals_of(None)
    totals = totals_of(first)
    sums = in_arrow(
        dealt,
        lambda batches: _scores(batches, hot, first, totals, pairs),
        f"_block bigint, _document array<smallint>, _known array<int>, _base array<double>, _score array<double>, {attributes}",
    )
    sums = sums.repartition("_block").sortWithinPartitions("_block")
    done = in_arrow(
        sums,
        lambda batches: _added(batches, totals),
        f"_key {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
    return done.withColumnRenamed("_key", key)


def perplexity(scores: DataFrame) -> DataFrame:
    """Perplexity per token of the model and of the base, by held_out."""
    mean = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(mean("score").alias("perplexity"), mean("base_score").alias("base_perplexity"))
