"""Divergence against plain fractions, and the galloping merge against sets."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bugtide.llm import divergence

RNG = random.Random(3)
VOCABULARY = ["alpha", "Beta", "été", "Éa", "x1y", "the", "THE", "日本", "z'z", "rare"]


def _rows():
    rows = []
    for i in range(160):
        lang, source = RNG.choice([("en", "s0"), ("en", "s1"), ("en", None), ("de", "s0"), (None, "s1"), ("en", "Z"), ("en", "é")])
        words = [RNG.choice(VOCABULARY[: 4 + i % 6]) for _ in range(RNG.randint(0, 30))]
        rows.append((i, " ".join(words), lang, source))
    rows += [(None, None, "en", "empty"), (1, "", "fr", "a"), (1, "12 3 !", "fr", "b"), (2, "beta " * 900, "en", "s0"), (2, "beta " * 900, "en", "s0")]
    rows += [(3, "solo", "it", "only")]
    return rows


ROWS = _rows()


def plain(rows, least, ranks):
    docs, times, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source, found = lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]
        groups.add((lang, source))
        docs[lang].update(set(found))
        times[lang, source].update(found)
    out = []
    for lang, source in groups:
        kept = [w for w, n in docs[lang].items() if n >= least]
        of_lang = sum((times[g] for g in groups if g[0] == lang), Counter())

        def price(counts, word, kept=kept):
            whole = sum(counts[w] for w in kept) + 5 * len(kept)
            return 1 + 10**9 * (counts[word] + 5) // whole

        own = times[lang, source]
        pairs = [
            (sum(abs(price(own, w) - price(times[g], w)) for w in kept), g[1]) for g in groups if g[0] == lang and g[1] != source
        ]
        above = [(price(own, w) - price(of_lang, w), w) for w in kept if own[w] and price(own, w) > price(of_lang, w)]
        for part, items in (("pair", pairs), ("term", above)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            kept_ranks = items if part == "pair" else items[:ranks]
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(kept_ranks, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile, block", [(16, 32_768), (2, 2)])
def test_audit_equals_plain_fractions(spark, tile, block):
    rows = ROWS
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, lang string, source string, term string, n int")
    found = divergence.audit(docs.repartition(4), least=10, ranks=3, block_terms=block, tile=tile)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 10, 3)
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]


def test_counts_handed_on_early_add_up():
    texts = [r[1] or "" for r in ROWS]
    columns = [[r[2] or "" for r in ROWS], [r[3] or "" for r in ROWS], [t.encode() for t in texts]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["lang", "source", "_text"])
    sums = []
    for most in (divergence.HELD, 0):
        total = defaultdict(lambda: [0, 0])
        for part in divergence._count([batch.slice(i, 1) for i in range(len(batch))], most):
            for row in part.to_pylist():
                total[row["lang"], row["source"], row["term"]][0] += row["n"]
                total[row["lang"], row["source"], row["term"]][1] += row["docs"]
        sums.append(dict(total))
    assert sums[0] == sums[1]


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_long_text_is_cut_between_words(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 7)
    text = ("Ab cde, " * 50 + "x" * 40 + " end").encode()
    found = [w for words in divergence.words_of(text) for w in words]
    assert found == [w.lower() for w in re.findall(rb"[A-Za-z]+", text)]


def test_gallop_and_distance_on_random_arrays(monkeypatch):
    monkeypatch.setattr(divergence, "STRIDE", 3)
    rng = np.random.default_rng(1)
    for _ in range(200):
        sides = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(2)]
        assert divergence.gallop(*sides).tolist() == np.searchsorted(sides[1], sides[0]).tolist()
        counts = [rng.integers(1, 9, len(s)) for s in sides]
        whole = [int(c.sum()) + 5 * 60 for c in counts]
        made = [(s, divergence.price(c, n), 5 * 10**9 // n + 1) for s, c, n in zip(sides, counts, whole)]
        full = []
        for s, c, n in zip(sides, counts, whole):
            all_counts = dict(zip(s.tolist(), c.tolist()))
            full.append([1 + 10**9 * (all_counts.get(i, 0) + 5) // n for i in range(60)])
        assert divergence.distance(*made, 60) == sum(abs(x - y) for x, y in zip(*full))


def test_prices_beyond_64_bits_are_exact():
    whole = 4 * 10**12
    assert divergence.price(np.array([10**12, 3]), whole).tolist() == [1 + 10**9 * (10**12 + 5) // whole, 1 + 10**9 * 8 // whole]
