"""Alignment against whole texts encoded at once and every pair of ends compared."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bugtide.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None,
    "",
    " ",
    "   two  spaces ",
    "It's a \t tab.\n\nNew line\r\n end",
    "naïve façade — ½ ﬁ 日本語のテキスト 🙂🙂 𝔘nicode",
    "a sign ▁ that the pieces cannot spell",
    "<|endoftext|> </s> <s> <unk> <0x41>",
    "\x1c sep \x1f\x85next em 　wide",
    "x" * 5000 + " " + "ab " * 400,
    "nul \x00 byte",
    "the river the river the river",
    "the river the river the river",
    "don't we'll  I'M 1234567 12 3,000.50 !!! ... ?!",
]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def groups_of(both, text):
    """Groups by comparing all ends, from the text encoded as a whole."""
    a, b = both
    if not text:
        return None
    letters = alignment.byte_letters()
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    spelt = [
        [bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]],
        [alignment.piece_bytes(b.id_to_piece(i)) for i in ids[1]],
    ]
    if any(b"".join(s) != (" " + text).encode() for s in spelt):
        return None
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelt]
    groups, at = [], (0, 0)
    for end in sorted(set(ends[0]) & set(ends[1])):
        past = tuple(e.index(end) + 1 for e in ends)
        groups.append((ids[0][at[0] : past[0]], ids[1][at[1] : past[1]]))
        at = past
    return ids, groups, [(x, y) for x, p in zip(ids[0], ends[0]) for y, q in zip(ids[1], ends[1]) if p == q]


def expected(both, texts):
    found = [groups_of(both, t) for t in texts]
    count = Counter(link for f in found if f for link in f[2])
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(n, highest.get(y, 0))
    rows = []
    for f in found:
        if not f:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[1])
        best = sum(count[link] == highest[link[1]] for link in f[2])
        rows.append(
            (len(f[0][0]), len(f[0][1]), len(f[1]), len(f[2]), best, sum(count[x] for x in f[2]), hashlib.sha256(written.encode()).hexdigest())
        )
    return rows


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_digest_equals_whole_texts(spark, both, monkeypatch):
    own = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()]
    texts = TEXTS + own
    rows = [(i if i else None, t, "z", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, links string, n_a int").repartition(3)
    found = alignment.alignment_digest(docs, A, B).collect()
    by_id = {r["doc_id"] or 0: tuple(r[n] for n in NAMES) for r in found}
    assert len(found) == len(texts)
    assert [by_id[i] for i in range(len(texts))] == expected(both, texts)


def test_sections_forgetting_and_blocks_change_nothing(both, monkeypatch):
    monkeypatch.setattr(alignment, "SECTION", 40)
    monkeypatch.setattr(alignment, "WRITTEN", 3)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    monkeypatch.setattr(alignment, "JOINED", 4)
    of = alignment.Aligner(A, B)
    for text in TEXTS:
        (at,) = of.texts([(text or "").encode()])
        plain = groups_of(both, text)
        assert (at is None) == (plain is None)
        if plain:
            found = of.joined(at)
            assert of.counts(at) == (len(plain[0][0]), len(plain[0][1]), len(plain[1]), len(plain[2]))
            assert found.a.tolist() == plain[0][0] and found.b.tolist() == plain[0][1]
            written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain[1])
            assert of.digest(at) == hashlib.sha256(written.encode()).hexdigest()
            codes = of.pairs[found.links]
            assert [(c // len(of.b_bytes), c % len(of.b_bytes)) for c in codes] == plain[2]


def test_groups_as_lists(spark, both):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in alignment.align(docs, A, B).collect():
        plain = groups_of(both, TEXTS[row["doc_id"]])
        if plain is None:
            assert row["a_ids"] == row["b_ends"] == []
            continue
        a, b = [0, *row["a_ends"]], [0, *row["b_ends"]]
        cut = [(row["a_ids"][i:j], row["b_ids"][k:m]) for i, j, k, m in zip(a, a[1:], b, b[1:])]
        assert cut == plain[1]


def test_text_that_is_not_utf8_has_no_tokens(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(X'C328' as string)").alias("text"))
    row = alignment.alignment_digest(docs, A, B).first()
    assert (row["n_a"], row["groups_sha256"]) == (0, "")


def test_empty_table(spark):
    assert alignment.alignment_digest(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_every_link_is_a_possible_pair():
    pairs = alignment.linkable([b"ab", b"b", b"x"], [b"b", b"cab", b"y"])
    assert pairs.tolist() == sorted([0 * 3 + 0, 0 * 3 + 1, 1 * 3 + 0, 1 * 3 + 1])
