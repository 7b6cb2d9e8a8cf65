"""Source divergence audit: how far the sources of a language lie apart, term by term.

A group is a (language, source). Its price of a kept term that it holds c times is
``1 + floor(SCALE * (c + PRIOR) / (N + PRIOR * V))``, whole numbers throughout; V is the
number of the language's kept terms, N the group's count of them. Two groups diverge by
the sum, over all kept terms, of the distance of their prices; a term stands out in a
group by as much as its price there exceeds its price in the whole language.

As a job: terms are counted inside tasks, then by (language, source, term) in a
shuffle. The kept terms of a language get numbers and fall into blocks of about
`BLOCK_TERMS` by hash, so a group's sorted (number, count) array is bounded however
large the vocabulary is. Sources are numbered and dealt into tiles of `TILE`; a task holds
the arrays of two tiles and one block, and each unordered pair in it is one merge: the
smaller array gallops through the larger one, and the terms in both, in one alone and
in neither are priced. The blocks' sums add up to the divergence, which holds both ways.
The result is quadratic in the sources of a language, as asked; no array is sent more
often than there are tiles.

Defined cases: missing text, language and source count as empty; a group without terms has
N = 0 and takes part; a language without kept terms gives divergence 0 and no terms;
every row counts as a document of its own, repeated ones and those without an id
included; equal values rank by their name in UTF-8; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugtide.llm.tools import Batches, in_arrow, pieces, utf8
from bugtide.shipping import ship_package
from bugtide.storage import written

#: Documents of a language that a kept term occurs in, at least.
LEAST_DOCUMENTS = 30
SCALE = 1_000_000_000
PRIOR = 5
TERM_RANKS = 50
#: Kept terms of a block, about.
BLOCK_TERMS = 32_768
#: Sources of a tile.
TILE = 16
#: Entries that a task counts before it hands them on.
HELD = 400_000
#: Bytes of text that are cut into words at once.
SLICE = 2_000_000
#: Above this count a price may leave 64 bits; Python's whole numbers take over.
LARGE = 9_000_000_000
#: Keys that gallop together.
STRIDE = 512

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, lists of bounded size: runs of ASCII letters, lower-cased, and other characters."""
    text = text.translate(_FOLD)
    start = 0
    while len(text) - start > SLICE:
        cut = text.find(b" ", start + SLICE)
        if cut < 0:
            break
        yield text[start:cut].split()
        start = cut
    yield text[start:].split() if start else text.split()


def _count(batches: Batches, most: int = HELD) -> Batches:
    """(lang, source, term, occurrences, documents), summed over a part of the task's rows.

    A group that was seen has a row without a term too.
    """
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def hand_on() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (times, documents) in held.items():
            columns[0] += [lang] * (len(times) + 1)
            columns[1] += [source] * (len(times) + 1)
            columns[2] += [None, *times]
            columns[3] += [0, *times.values()]
            columns[4] += [0, *map(documents.__getitem__, times)]
        held.clear()
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "source", "term", "n", "docs"]
        )

    for batch in batches:
        for rows, texts in pieces(batch, "_text", SLICE):
            groups = zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)
            for group, text in zip(groups, texts, strict=True):
                times, documents = held.setdefault(group, (Counter(), Counter()))
                seen: set[bytes] = set()
                for words in words_of(text):
                    times.update(words)
                    seen.update(words)
                documents.update(seen)
            if sum(len(times) for times, _ in held.values()) > most:
                yield hand_on()
    if held:
        yield hand_on()


def gallop(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where sorted keys stand, or would stand, in a sorted table.

    A run of keys doubles its reach from where the last run ended until it has passed
    its largest key, and is searched for inside that reach alone.
    """
    found = np.empty(len(keys), dtype=np.int64)
    at = 0
    for start in range(0, len(keys), STRIDE):
        run = keys[start : start + STRIDE]
        reach = STRIDE
        while at + reach < len(table) and table[at + reach - 1] < run[-1]:
            reach *= 2
        found[start : start + STRIDE] = at + np.searchsorted(table[at : at + reach], run)
        at = int(found[start + len(run) - 1])
    return found


def price(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / whole), exactly."""
    if whole > LARGE or counts.max(initial=0) > LARGE:
        counts = counts.astype(object)
    return SCALE * (counts + PRIOR) // whole + 1


def distance(left: tuple, right: tuple, terms: int) -> int:
    """Sum of price distances over ``terms`` terms; a side is its numbers, its prices and the price of no occurrence."""
    if len(left[0]) > len(right[0]):
        left, right = right, left
    (few, few_prices, few_none), (many, many_prices, many_none) = left, right
    place = gallop(few, many)
    both = np.zeros(len(few), dtype=bool)
    inside = place < len(many)
    both[inside] = many[place[inside]] == few[inside]
    other = place[both]
    total = int(np.abs(few_prices[both] - many_prices[other]).sum())
    total += int(np.abs(few_prices[~both] - many_none).sum())
    alone = np.abs(many_prices - few_none)
    total += int(alone.sum()) - int(alone[other].sum())
    union = len(few) + len(many) - len(other)
    return total + (terms - union) * abs(few_none - many_none)


def _merge(rows: pa.Table, size: int) -> pa.Table:
    """The pairs of one cell: two tiles of sources and one block of terms."""
    rows = rows.sort_by("place")
    place = rows.column("place").to_numpy()
    tile = place // size
    whole = rows.column("whole").to_pylist()
    terms = rows.column("terms")[0].as_py()
    sides = []
    for numbers, counts, n in zip(rows.column("numbers"), rows.column("counts"), whole, strict=True):
        arrays = [x.values.to_numpy() if x.is_valid else np.zeros(0, dtype=np.int64) for x in (numbers, counts)]
        sides.append((arrays[0], price(arrays[1], n or 1), SCALE * PRIOR // n + 1 if n else 0))
    first, second, value = [], [], []
    for i in np.flatnonzero(tile == rows.column("low")[0].as_py()):
        for j in np.flatnonzero((place > place[i]) & (tile == rows.column("high")[0].as_py())):
            first.append(int(place[i]))
            second.append(int(place[j]))
            value.append(distance(sides[i], sides[j], terms))
    lang = pa.array([rows.column("lang")[0].as_py()] * len(first), pa.string())
    return pa.table([lang, pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(value, pa.int64())], names=["lang", "first", "second", "value"])


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Occurrences and documents by (lang, source, term), stored; every group has a row without a term."""
    narrow = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))),
        utf8(text).alias("_text"),
    )
    partial = in_arrow(narrow, _count, "lang string, source string, term binary, n bigint, docs bigint")
    return written(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _price(count: str, whole: str) -> Column:
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * ({count} + {PRIOR})) div {whole}")


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_DOCUMENTS,
    ranks: int = TERM_RANKS,
    block_terms: int = BLOCK_TERMS,
    tile: int = TILE,
) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: each other source of the language by divergence, all of them. Part
    ``term``: the first ``ranks`` terms by how much they stand out in the group.
    """
    counts = count_terms(docs, text, lang, source)
    kept = (
        counts.where(F.col("term").isNotNull())
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least)
    )
    kept = written(kept.select("lang", "term", "in_lang", F.monotonically_increasing_id().alias("number")))
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("n_lang"))
    languages = languages.withColumn("blocks", F.ceil(F.col("v") / block_terms).cast("int"))
    held = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang", "number"))

    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.join(sums, ["lang", "source"], "left").withColumn("place", place.cast("bigint"))
    groups = written(
        groups.join(languages, "lang", "left").select(
            "lang",
            "source",
            "place",
            F.coalesce("v", F.lit(0)).alias("v"),
            F.coalesce("blocks", F.lit(1)).alias("blocks"),
            (F.coalesce("n_group", F.lit(0)) + PRIOR * F.coalesce("v", F.lit(0))).alias("whole"),
            (F.coalesce("n_lang", F.lit(0)) + PRIOR * F.coalesce("v", F.lit(0))).alias("whole_lang"),
        )
    )
    return _pairs(groups, held, kept, languages, tile).unionByName(_terms(groups, held, ranks))


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("number"), F.col(blocks)).cast("int").alias("block")


def _pairs(groups: DataFrame, held: DataFrame, kept: DataFrame, languages: DataFrame, size: int) -> DataFrame:
    small = languages.select("lang", "blocks")
    sizes = kept.join(small, "lang").select("lang", _block("blocks")).groupBy("lang", "block").agg(F.count(F.lit(1)).alias("terms"))
    arrays = (
        held.join(small, "lang")
        .select("lang", "source", _block("blocks"), F.struct("number", "n").alias("entry"))
        .groupBy("lang", "source", "block")
        .agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    )
    everywhere = groups.select("lang", "source", "place", "whole", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    last = groups.groupBy("lang").agg(F.floor(F.max("place") / size).alias("last_tile"))
    tile, other = F.floor(F.col("place") / size), F.col("other")
    cells = (
        everywhere.join(arrays, ["lang", "source", "block"], "left")
        .join(sizes, ["lang", "block"], "left")
        .join(last, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last_tile"))))
        .select(
            "lang", "block", F.least(tile, other).alias("low"), F.greatest(tile, other).alias("high"),
            "place", "whole", F.coalesce("terms", F.lit(0)).alias("terms"),
            F.col("entries.number").alias("numbers"), F.col("entries.n").alias("counts"),
        )
    )
    ship_package(groups.sparkSession)
    cells = cells.groupBy("lang", "block", "low", "high")
    partial = cells.applyInArrow(lambda rows: _merge(rows, size), "lang string, first bigint, second bigint, value bigint")
    pairs = partial.groupBy("lang", "first", "second").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("first").alias("own"), F.col("second").alias("other")), F.struct(F.col("second").alias("own"), F.col("first").alias("other"))))
    named = groups.select("lang", "place", "source")
    found = (
        pairs.select("lang", "value", both.alias("side")).select("lang", "value", "side.*")
        .join(named.withColumnsRenamed({"place": "own"}), ["lang", "own"])
        .join(named.withColumnsRenamed({"place": "other", "source": "item"}), ["lang", "other"])
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(groups: DataFrame, held: DataFrame, ranks: int) -> DataFrame:
    rows = held.where(F.col("n") > 0).join(groups.select("lang", "source", "whole", "whole_lang"), ["lang", "source"])
    above = (_price("n", "whole") - _price("in_lang", "whole_lang")).cast("bigint")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return (
        rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), above.alias("value"))
        .where(F.col("value") > 0)
        .withColumn("rank", rank)
        .where(F.col("rank") <= ranks)
    )
