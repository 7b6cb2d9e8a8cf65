"""Every operator on odd rows and against a plain computation."""

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from bugtide.llm import (
    decontamination,
    fmindex,
    language,
    licenses,
    packing,
    pitmanyor,
    queries,
    sharding,
    simhash,
    substrings,
    topk,
    urlrules,
)

RNG = random.Random(5)
WORDS = ["the", "of", "and", "tree", "blue", "river", "été", "schön", "señor", "x1", "le", "der", "und", "que", "los", "ship"]
BENCH = " ".join(RNG.choice(WORDS) for _ in range(25))


def _text(n):
    return " ".join(RNG.choice(WORDS) + RNG.choice(["", "", ",", "."]) for _ in range(n))


BASE = _text(120)
ROWS = [
    (0, None, None, None),
    (1, "", "en", "a"),
    (2, "   \t\n", "en", "a"),
    (3, "7 ... !!", "de", None),
    (4, "A", "en", "b"),
    (5, BASE, "en", "a"),
    (6, BASE, "en", "a"),
    (7, BASE.replace("tree", "Tree", 1) + " tail", "en", "b"),
    (8, "start " + BENCH.upper() + " end. Released under the MIT License now", "de", "b"),
    (9, " ".join(BENCH.split()[3:15]), "de", "a"),
    (10, _text(6000), "fr", "a"),
    (10, BASE, "en", "a"),
    (11, "x " * 900, "fr", "a"),
    (11, "x " * 900, "fr", "a"),
    (None, "é" * 150 + BASE, "es", "c"),
    (12, "This work is licensed under the GNU General Public License, version 3. <|endoftext|> It's", "es", "c"),
    *((20 + i, _text(RNG.randint(1, 60)), RNG.choice(["en", "de", "fr", "es", None]), RNG.choice("abc")) for i in range(30)),
]
# The names clash with results and with helper columns.
EXTRA = ["n_words", "score", "_text", "_row", "_key", "size", "_of"]
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["z"] * len(EXTRA)) for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def bench(spark):
    items = [(1, BENCH), (2, "blue river ship"), (3, None), (4, "!!"), (10, BENCH)]
    return spark.createDataFrame(items, "item_id long, text string")


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def text_of(row):
    return row[1] or ""


def test_sharding(docs):
    def plain(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    found = sharding.shard_table(docs, 16).collect()
    assert len(found) == len(ROWS)
    slots = defaultdict(list)
    for r in found:
        key = int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:16], 16)
        assert (r["shard"], r["grown_shard"]) == (plain(key, 16), plain(key, 17))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = sorted((len(text_of(r).encode()) + 1, zlib.crc32(text_of(r).encode())) for r in ROWS)
    assert sorted((r["size"], r["text_crc32"]) for r in found) == expected


def test_many_copies_get_all_slots(spark):
    df = spark.range(1).select(F.lit(7).alias("k"), F.explode(F.sequence(F.lit(1), F.lit(250_000))).alias("_")).select("k")
    found = sharding.with_slots(df, "k").agg(F.count("slot"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).first()
    assert tuple(found) == (250_000, 0, 249_999, 250_000)


PLAIN_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("block_words", [500_000, 3])
def test_decontamination(docs, bench, block_words):
    phrases = defaultdict(set)
    for item in bench.collect():
        w = PLAIN_WORD.findall(lower(item["text"] or ""))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            phrases[tuple(w[i : i + n])].add(str(item["item_id"]))
    expected = []
    for r in ROWS:
        w, hit, items = PLAIN_WORD.findall(lower(text_of(r))), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in phrases:
                    hit.update(range(i, i + n))
                    items |= phrases[tuple(w[i : i + n])]
        expected.append((r[0], len(w), len(hit), len(items), decontamination.digest_of(list(items)), bool(hit)))
    found = decontamination.find_leaks(docs, bench, shard_words=40, block_words=block_words)
    digest = decontamination.leak_digest(found)
    assert rows(digest, *digest.columns) == sorted(expected, key=repr)
    kept = decontamination.remove_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert not decontamination.leak_digest(decontamination.find_leaks(kept, bench)).where("contaminated").count()
    clean = {r[0] for r in expected if not r[5]} - {10, None}
    assert {r["doc_id"]: r["text"] for r in kept.collect() if r["doc_id"] in clean} == {r[0]: r[1] for r in ROWS if r[0] in clean}


def test_decontamination_in_several_passes(spark, docs, bench):
    whole, parts = (
        decontamination.leak_digest(decontamination.find_leaks(docs, bench, **sizes)) for sizes in ({}, {"block_words": 8, "pass_words": 20})
    )
    assert rows(whole, *whole.columns) == rows(parts, *parts.columns)
    left = [decontamination.remove_leaks(docs, bench, **sizes) for sizes in ({}, {"block_words": 8, "pass_words": 20})]
    assert rows(left[0], *left[0].columns) == rows(left[1], *left[1].columns)
    # A text without blanks has words too.
    long = spark.createDataFrame([(1, "-".join(f"w{i}" for i in range(100)))], "item_id long, text string")
    blocks = list(decontamination._blocks(long, "item_id", "text", 10, 30))
    assert max(b.n_words for b in blocks) <= 39 and sum(len(b.by_length[10][0]) for b in blocks) == 91


def test_fm_index_finds_all_occurrences():
    rng = np.random.default_rng(3)
    sequence = rng.integers(0, 5, 3000)
    index = fmindex.FMIndex(sequence, 5)
    patterns = rng.integers(1, 5, (60, 4))
    which, at = index.occurrences(patterns)
    found = sorted(zip(which.tolist(), at.tolist(), strict=True))
    assert found == sorted(
        (p, i) for p in range(60) for i in range(len(sequence) - 3) if (sequence[i : i + 4] == patterns[p]).all()
    )


def simhash_groups(texts):
    """Fingerprints, and the smallest place that each text is linked to, by comparing all pairs."""

    def print_of(text):
        w = lower(text).encode().split()
        s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [print_of(t) for t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    return prints, group


def repeat_marks(texts):
    """For each text the bytes that a string of 200 bytes covers which occurs elsewhere too."""
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    found = []
    for t in texts:
        marks = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                marks[i : i + 200] = True
        found.append(marks)
    return found


def test_simhash(docs):
    prints, group = simhash_groups([text_of(r) for r in ROWS])
    least = {g: min((ROWS[i][0] for i in range(len(ROWS)) if group[i] == g and ROWS[i][0] is not None), default=None) for g in group}
    expected = [(r[0], f"{p:016x}", least[g]) for r, p, g in zip(ROWS, prints, group, strict=True)]
    found = simhash.near_duplicates(docs)
    assert rows(found, *found.columns) == sorted(expected, key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))


def test_simhash_links_in_cells_and_at_any_threshold(spark):
    rng = np.random.default_rng(2)
    center = rng.integers(0, 2**62, 12)
    values = {int(c) ^ sum(1 << int(b) for b in rng.choice(62, 4, replace=False)) for c in center for _ in range(30)}
    values = np.array(sorted(values))
    df = spark.createDataFrame([(int(x),) for x in values], "_print long")
    linked = simhash.components(simhash.links(df, cell=7)).collect()
    root = {r["member"]: r["root"] for r in linked}
    labels = np.arange(len(values))
    i, j = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    labels = simhash.merged(labels, i, j)
    mine = [root.get(int(x), int(x)) for x in values]
    assert [mine[k] == mine[n] for k in range(len(values)) for n in range(k)] == [
        labels[k] == labels[n] for k in range(len(values)) for n in range(k)
    ]


def test_thresholds_by_dynamic_programme():
    costs = [np.array([0.0, 1, 2, 9, 99]), np.array([0.0, 5, 6, 7, 7.5])]
    assert simhash.allocate(costs, 4) == (7.5, [-1, 3])
    assert simhash.allocate(costs, 2) == (2.0, [1, -1])


def test_repeated_substrings(docs):
    texts = [text_of(r).encode() for r in ROWS]
    expected, left = [], []
    for r, t, marks in zip(ROWS, texts, repeat_marks(texts), strict=True):
        kept = bytes(b for b, m in zip(t, marks, strict=True) if not m)
        runs = int((np.diff(marks.astype(int), prepend=0) == 1).sum())
        expected.append((r[0], len(t), int(marks.sum()), runs, hashlib.sha256(kept).hexdigest()))
        whole = substrings.whole_characters(t, marks) if t else marks
        left.append((r[0], bytes(b for b, m in zip(t, whole, strict=True) if not m).decode() if r[1] is not None else None))
    found = substrings.repeats(docs)
    assert rows(found, *found.columns) == sorted(expected, key=repr)
    kept = substrings.remove_repeats(docs)
    assert kept.columns == docs.columns and rows(kept, "doc_id", "text") == sorted(left, key=repr)


def test_repeated_substrings_around_a_hot_anchor(spark):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, long = prose(120), prose(195)
    texts = [prose(300) + line + prose(300) for _ in range(40)] + [prose(90) + long + prose(90) for _ in range(40)]
    # Strings of 200 bytes and more that some of them share, over one start or several.
    texts += [prose(150) + line + t + prose(150) for t in (prose(80), prose(81)) for _ in range(3)]
    texts += [prose(50) + long + t + prose(60) for t in (prose(5), prose(25)) for _ in range(2)]
    texts += [texts[0], texts[-1]]
    data = [t.encode() for t in texts]
    seen = Counter(t[i : i + 200] for t in data for i in range(len(t) - 199))
    expected = []
    for k, t in enumerate(data):
        marks = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                marks[i : i + 200] = True
        expected.append((k, int(marks.sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~marks])).hexdigest()))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sum(n > 0 for _, n, _ in expected) > 10
    for together in (3, substrings.TOGETHER):
        assert rows(substrings.repeats(df, together=together), "doc_id", "n_removed", "kept_sha256") == sorted(expected, key=repr)
    kinds = spark.createDataFrame([(1, i, 1) for i in range(4)] + [(2, i, 1) for i in range(3)], "_core long, _segment long, _times long")
    assert [[r[0] for r in cores.collect()] for cores in substrings.open_cores(kinds, 3)] == [[2], [1]]


def test_language(spark, docs):
    found = language.identify(docs).collect()
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {0, 1, 2, 3}
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 4
    small = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right = language.identify(small).join(small.select("doc_id", "lang"), "doc_id").where("held_out")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_language_without_labels_with_many_and_with_a_hot_one(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    lettered = [r[0] for r in ROWS if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert sorted(map(repr, (r["doc_id"] for r in language.keep_identified(unlabelled).collect()))) == sorted(map(repr, lettered))
    # More labels than machines were allowed before; all rows of one language are one text.
    many = [(i, f"{'abcdefghij'[i % 10] * 3}{'klmnopqrst'[i // 10 % 10] * 3} " * 9, f"l{i % 150}", "s") for i in range(600)]
    many += [(1000 + i, "hot text here", "hot", "s") for i in range(2000)]
    df = spark.createDataFrame(many, "doc_id long, text string, lang string, source string").repartition(4)
    found = language.identify(df).where("doc_id >= 1000").groupBy("lang_pred").count().collect()
    assert [tuple(r) for r in found] == [("hot", 2000)]


def test_smallest_hashes_are_merged(monkeypatch):
    monkeypatch.setattr(language, "PER_LANGUAGE", 3)
    rows = [("a", h) for h in (5, 1, 1, 9, 7, 1)] + [("b", 2)] + [("a", h) for h in (0, 9, 3)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i : i + 4]]), pa.array([r[1] for r in rows[i : i + 4]])], names=["_lang", "_order"]) for i in (0, 4, 8)]
    (found,) = language._smallest(iter(batches))
    assert [tuple(r.values()) for r in found.to_pylist()] == [("a", 0), ("a", 1), ("a", 3), ("b", 2)]


def test_language_stage_decides(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    only = language.keep_identified(rows, wanted=["de"], least=0.0)
    shares = {r["lang"]: r["count"] for r in only.groupBy("lang").count().collect()}
    assert shares["de"] / sum(shares.values()) > 0.97
    assert language.keep_identified(rows, least=1.0).count() < rows.count()


def test_topk(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.3, 20)]) for i in range(400)]
    vectors += [(1000 + i, [0.5] * 20) for i in range(50)]
    # Ids that occur twice, with equal and with other vectors, and rows without an id.
    vectors += [(7, [0.9] * 20), (50, [0.9] * 20), (50, [0.9] * 20), (None, [0.8] * 20), (None, [0.8] * 20), (1001, [0.5] * 20)]
    vectors += [(2004, []), (2005, [3.0])]
    odd = [(2000, None), (2001, [None] + [0.1] * 19), (2002, [math.nan] * 20), (2003, [math.inf] * 20)]
    df = spark.createDataFrame([(*v, "z") for v in vectors + odd], "vec_id long, embedding array<float>, score string")
    whole = [(k, np.array([math.floor(256 * float(np.float32(x))) for x in v] + [0] * (20 - len(v)))) for k, v in vectors]
    expected = []
    for i, (q, own) in enumerate(whole):
        if q is not None and q % 50 == 0:
            others = [(-int(own @ v), k is None, k or 0) for j, (k, v) in enumerate(whole) if j != i]
            expected += [(q, rank, None if none else k, -s) for rank, (s, none, k) in enumerate(sorted(others)[:5], 1)]
    found = topk.nearest(df, F.col("vec_id") % 50 == 0)
    assert rows(found, "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)


def test_topk_of_large_components_and_few_rows(spark):
    big = [(0, [1e20, -1.0]), (50, [1e200, 0.5]), (1, [3.0, 2.0]), (2, [-1e20, 0.0]), (3, [2.0**60, 0.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    found = topk.nearest(df, F.col("vec_id") % 50 == 0, k=3)
    expected = []
    for q, own in big[:2]:
        number = [[int(x) * 256 if abs(x) > 2.0**50 else math.floor(x * 256) for x in v] for _, v in big]
        mine = number[[k for k, _ in big].index(q)]
        scores = [(-sum(a * b for a, b in zip(mine, n)), k) for (k, _), n in zip(big, number) if k != q]
        clipped = [(q, i, k, min(max(-s, -(2**63)), 2**63 - 1)) for i, (s, k) in enumerate(sorted(scores)[:3], 1)]
        expected += clipped
    assert rows(found, "query_id", "score") == sorted([(e[0], e[3]) for e in expected], key=repr)
    alone = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert topk.nearest(alone, F.col("vec_id") % 50 == 0).count() == 0


def test_topk_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 60)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "SAMPLE", 7)
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.normal(0, 1, 40)]) for i in range(500)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    whole = np.array([[math.floor(256 * x) for x in v] for _, v in vectors])
    expected = []
    for q in range(0, 500, 50):
        scores = sorted((-int(whole[q] @ whole[i]), i) for i in range(500) if i != q)[:5]
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    found = topk.nearest(df, F.col("vec_id") % 50 == 0)
    assert rows(found, "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://A.com", "http://www.Example.com/en/1?x=1#y", "https://m.example.com/en/x", "ftp://b.net/es/", "http://example.org"]
    bad = [(100 + i, f"http://site{i % 3}.org/spam/{i}?ref=x") for i in range(40)]
    good = [(200 + i, f"http://site{i % 3}.org/ham/{i}") for i in range(40)]
    pages = spark.createDataFrame([*enumerate(urls), (None, "http://c.org/spam/1"), *bad, *good], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 1) for i, _ in bad] + [(i, 1, None) for i, _ in good] + [(None, 0, 1)], "doc_id long, quality int, toxic int")
    found = {r["page_id"]: tuple(r[1:5]) for r in urlrules.judge(pages, labels).collect()}
    assert [found[i] for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.com", "", None, "allow"),
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("m.example.com", "/en/x", "example.com/en/", "block"),
        ("b.net", "/es/", "net/es/", "block"), ("example.org", "", None, "allow"),
    ]
    assert {found[i][3] for i, _ in bad} == {"block"} and {found[i][3] for i, _ in good} == {"allow"}
    assert found[None][3] == "block"
    assert {r["verdict"] for r in urlrules.judge(pages, labels.limit(0)).where("rule IS NULL").collect()} == {"allow"}


def test_mined_rules_equal_an_exhaustive_search(spark):
    """All token combinations of all labelled pages, counted one by one."""
    rng = random.Random(8)
    hosts = ["good.org", "mixed.net", "spam.com", "www.spam.com", "lone.io"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['a', 'b', 'c'])}/{rng.randint(1, 99)}{rng.choice(['', '?x=1', '.html'])}" for _ in range(220)]
    urls += ["http://rare.biz/z"] * 3 + [None, "no scheme", "http://" + "long" * 5000 + ".org/" + "p/" * 40]
    bad = [int("spam" in (u or "") and rng.random() < 0.9 or "rare" in (u or "") or rng.random() < 0.1) for u in urls]
    pages = spark.createDataFrame([(i, u, 0, "z", "z") for i, u in enumerate(urls)], "page_id long, url string, toxic int, items string, host string")
    labels = spark.createDataFrame([(i, 1, b, "x") for i, b in enumerate(bad)] + [(0, 1, bad[0], "x"), (None, 0, 1, "x")], "doc_id long, quality int, toxic int, url string")
    sets = {r["page_id"]: r["t"] for r in pages.select("page_id", urlrules.tokens(F.col("url")).alias("t")).collect()}
    counted = defaultdict(lambda: [0, 0])
    for i, own in sets.items():
        for size in range(1, len(own) + 1):
            for chosen in itertools.combinations(own, size):
                counted[chosen][0] += bad[i]
                counted[chosen][1] += 1
    labelled = [i for i, own in sets.items() if own or bad[i]]
    base = sum(bad[i] for i in labelled) / len(labelled)

    def sure(k, n, z=urlrules.SURE):
        p = k / n
        return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n) > base

    rules = {c: k / n for c, (k, n) in counted.items() if k >= urlrules.LEAST_BAD and k / n >= urlrules.CONFIDENCE and sure(k, n)}
    kept = {c: p for c, p in rules.items() if not any(set(d) < set(c) and q >= p for d, q in rules.items())}
    known = spark.createDataFrame([(own + [urlrules.BAD] * bad[i],) for i, own in sets.items() if own or bad[i]], "items array<string>")
    mined = defaultdict(set)
    for r in urlrules.mine(known).collect():
        mined[r["rule"]].add(r["token"])
    assert kept and {frozenset(c) for c in kept} == {frozenset(c) for c in mined.values()}
    fired = {i: sum(set(c) <= set(own) for c in kept) for i, own in sets.items()}
    found = urlrules.judge(pages, labels, rules=()).collect()
    assert {r["page_id"]: r["n_rules"] for r in found} == fired
    assert {r["page_id"] for r in found if r["verdict"] == "block"} == {i for i, n in fired.items() if n}


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0}])
def test_packing(docs, weights):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    ids = [t.encode(text_of(r), add_special_tokens=False).ids + [2] for r in ROWS]
    packed = packing.pack(docs, queries.tokenizer_path(), weights=weights, window=64).collect()
    pieces, offsets = defaultdict(list), defaultdict(list)
    for p in packed:
        own = np.frombuffer(p["ids"], "<u4").tolist()
        pieces[p["doc_id"]].append((p["start"], own, p["doc_tokens"]))
        offsets[p["sequence_id"]].append((p["offset"], len(own)))
    assert Counter(x for own in pieces.values() for _, i, _ in own for x in i) == Counter(x for i in ids for x in i)
    for row, own in zip(ROWS, ids, strict=True):
        if row[0] not in (10, 11, None):
            assert [x for _, i, _ in sorted(pieces[row[0]]) for x in i] == own
            assert {n for _, _, n in pieces[row[0]]} == {len(own)}
    for held in offsets.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 64
    full = -(-sum(map(len, ids)) // 64)
    assert sorted(offsets) == list(range(full))


def test_round_robin_keeps_proportions_and_carries_deficits():
    totals = np.array([7000, 2500, 400, 3, 97])
    bounds, _ = packing.rounds([100] * 100, totals.astype(float), totals, np.zeros(5))
    assert (bounds[-1] == totals).all() and (np.diff(bounds.sum(axis=1)) == 100).all()
    due = np.arange(101)[:, None] * totals / 100
    assert np.abs(bounds - due).max() < 3


def test_packing_keeps_a_queue_for_each_of_many_sources(spark):
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choices(["tree", "ship", "river"], k=60)), f"s{i % 100}") for i in range(1000)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(5)
    weights = {f"s{i}": 3.0 if i < 10 else 1.0 for i in range(100)}
    packed = packing.pack(df, queries.tokenizer_path(), weights=weights, window=512).collect()
    assert {(p["doc_id"], p["queue"]) for p in packed} == {(i, s) for i, _, s in texts}
    held = defaultdict(Counter)
    for p in packed:
        held[p["sequence_id"]][p["queue"]] += len(p["ids"]) // 4
    assert sorted(held) == list(range(len(held))) and {sum(c.values()) for s, c in held.items() if s < len(held) - 1} == {512}
    # Until the heavy sources are empty, every window has each source at its share.
    for s in range(30):
        for q, w in weights.items():
            assert abs(held[s][q] - 512 * w / 120) < 5


@pytest.mark.parametrize("weighted", [False, True])
def test_schedule_of_partitions(weighted):
    totals = np.array([7000, 2500, 400, 3, 97, 97])
    weights = np.array([1.0, 1, 5, 0, 2, 2]) if weighted else totals.astype(float)
    at = [*range(0, int(totals.sum()), 50), int(totals.sum())]
    schedule = packing.Schedule(weights, totals, at)
    bounds = np.stack([schedule.bounds(q) for q in range(len(totals))], axis=1)
    assert (bounds.sum(axis=1) == at).all() and (np.diff(bounds, axis=0) >= 0).all() and (bounds[-1] == totals).all()
    queues = np.arange(len(totals))
    assert max(np.abs(schedule.deficits(p, queues)).max() for p in range(len(at))) < 1.01
    if not weighted:
        assert np.abs(bounds - np.array(at)[:, None] * totals / totals.sum()).max() <= (1 + len(totals)) / 2


def test_word_tokenizer_equals_the_tokenizer():
    from tokenizers import Tokenizer

    own, whole = packing.WordTokenizer(queries.tokenizer_path(), 2), Tokenizer.from_file(queries.tokenizer_path())
    letters = "aAbé'sÉßﬁ ΣςİıŉǅÅ ́.,;:!?<|endoftext|>12\t\n\x0b\x0c\x1c\x85 　ñçœ日本ªº-_"
    texts = ["".join(RNG.choice(letters) for _ in range(RNG.randint(0, 30))) for _ in range(800)] + ["<|endoftext|>", "<|ENDOFTEXT|>", ""]
    ids, sizes = own.encode([t.encode() for t in texts])
    at = 0
    for text, n in zip(texts, sizes.tolist(), strict=True):
        assert ids[at : at + n].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]
        at += n


def test_licenses(docs):
    found = licenses.find_licenses(docs)
    assert rows(found, "doc_id", "license", "n_shared", "n_template") == [(12, "GPL-3.0", 8, 8), (8, "MIT", 1, 1)]
    with pytest.raises(ValueError, match="fewer than"):
        licenses.find_licenses(docs, notices={"short": "a b"})


def test_licence_variants_are_told_apart(spark):
    n = licenses.NOTICES
    two = n["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* ")
    given = {
        1: two,
        2: n["BSD-3-Clause"],
        3: "x y " + n["GPL-2.0"] + " z",
        4: n["GPL-2.0"] + ". " + n["GPL-3.0"],
        5: n["LGPL-2.1-header"],
        6: n["LGPL-3.0-header"] + " and " + n["GPL-3.0-header"],
        7: n["GPL-3.0-header"],
        8: n["ISC"],
        9: n["CC-BY-SA-4.0"],
        10: n["GPL-2.0-header"].replace(";", ","),
        11: "nothing of the kind",
        12: " ".join(n.values()),
    }
    df = spark.createDataFrame(list(given.items()), "doc_id long, text string")
    found = defaultdict(set)
    for r in licenses.find_licenses(df).collect():
        found[r["doc_id"]].add(r["license"])
    assert {k: x for k, x in found.items() if k < 12} == {
        1: {"BSD-2-Clause"}, 2: {"BSD-3-Clause"}, 3: {"GPL-2.0"}, 4: {"GPL-2.0", "GPL-3.0"}, 5: {"LGPL-2.1-header"},
        6: {"LGPL-3.0-header", "GPL-3.0-header"}, 7: {"GPL-3.0-header"}, 8: {"ISC"}, 9: {"CC-BY-SA-4.0"}, 10: {"GPL-2.0-header"},
    }
    assert found[12] == set(n) - {"BSD-2-Clause"}


def test_pitman_yor(spark, docs):
    found = pitmanyor.score_documents(docs).collect()
    tokens = [[*lower(text_of(r)).encode().split(), b" "] for r in ROWS]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in ROWS]
    count = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(count.values()), len(count)
    expected = sorted((str(r[0]), h, len(t), sum(count[w] > 0 for w in t), n) for r, t, h in zip(ROWS, tokens, held, strict=True))
    assert sorted((str(r[0]), *r[1:5]) for r in found) == expected
    base = sorted(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t) for t in tokens)
    assert np.allclose(sorted(r["base_score"] for r in found), base)
    small = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    better = pitmanyor.perplexity(pitmanyor.score_documents(small)).where("held_out").first()
    assert better["perplexity"] < 0.6 * better["base_perplexity"]


def test_pitman_yor_spreads_every_word_and_pair_that_outgrows_a_bucket(spark):
    # 40 words of 2.5 % each, none of them common in a block's eyes; one pair has a tenth of all tokens.
    rng = random.Random(4)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(40)] + ["on the"] * 5) for _ in range(300)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6).cache()
    known, words, classes = pitmanyor.WordHashes(), [], []
    for t in texts:
        hashes, sizes = pitmanyor.token_hashes([t.encode()], known)
        words.append(hashes)
        classes.append(pitmanyor.contexts(hashes, sizes))
    pair = (np.array([xxh64_intdigest(b"the")], np.uint64), pitmanyor.contexts(np.array([xxh64_intdigest(b"on"), 0], np.uint64), np.array([2]))[1:])
    loads = np.bincount(
        np.concatenate([pitmanyor.buckets(w, c, np.unique(np.concatenate(words)), 16, pair, i) for i, (w, c) in enumerate(zip(words, classes))])
    )
    assert loads.max() < 2 * loads.mean()
    one, many = (pitmanyor.score_documents(df, bucket_tokens=n) for n in (1_000_000, 1000))
    same = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert rows(one, *same) == rows(many, *same)
    base = [[r["base_score"] for r in f.orderBy("doc_id").collect()] for f in (one, many)]
    assert np.allclose(*base)
    worse = [pitmanyor.perplexity(f).where("held_out").first()["perplexity"] for f in (one, many)]
    assert abs(worse[1] / worse[0] - 1) < 0.03


def test_tables_are_drawn_from_their_conditional():
    rng, c, base, others, d, strength = np.random.default_rng(0), 4, 0.3, 5.0, 0.6, 1.0
    weight = np.zeros(c + 1)

    def seat(sizes, p):
        if sum(sizes) == c:
            weight[len(sizes)] += p
            return
        seat([*sizes, 1], p * (strength + d * (others + len(sizes))) * base)
        for i in range(len(sizes)):
            seat([*sizes[:i], sizes[i] + 1, *sizes[i + 1 :]], p * (sizes[i] - d))

    seat([], 1.0)
    n = 40_000
    drawn = pitmanyor.draw_tables(rng, np.full(n, c), np.full(n, base), np.full(n, others), d, strength)
    assert np.abs(np.bincount(drawn, minlength=c + 1) / n - weight / weight.sum()).max() < 0.01


def test_probabilities_sum_to_one():
    import pyarrow as pa

    known = pitmanyor.WordHashes()
    hashes, sizes = pitmanyor.token_hashes([t.encode() for t in (BASE, _text(300), _text(50))], known)
    none = np.zeros(0, dtype=np.uint64)
    import zstandard

    batch = next(pitmanyor._packed(0, pa.array([1, 2, 3]), hashes, sizes, np.zeros(3, bool), none, 1, zstandard.ZstdCompressor()))
    own = pitmanyor.Bucket(pa.Table.from_batches([batch.slice(0, 1)]))
    report = pitmanyor.Seating(own, none, None, 0).report()
    totals = pitmanyor.Totals(dict(zip(zip(report["kind"].tolist(), report["id"].tolist(), strict=True), report["value"], strict=True)))
    seating = pitmanyor.Seating(own, none, totals, 0)
    context = own.context[0]
    t, mine = totals, own.context == context
    back = (pitmanyor.STRENGTH + t.discount * t.tables[context]) / (pitmanyor.STRENGTH + t.customers[context])
    seen = (own.customers[mine] - t.discount * seating.tables[mine]).sum() / (pitmanyor.STRENGTH + t.customers[context])
    assert abs(seen + back - 1) < 1e-9


def test_empty_tables(spark, docs, bench):
    none = docs.limit(0)
    path = queries.tokenizer_path()
    for empty in (
        sharding.shard_table(none, 16), decontamination.find_leaks(none, bench), simhash.near_duplicates(none),
        simhash.keep_one(none), substrings.repeats(none), substrings.remove_repeats(none), language.identify(none),
        language.keep_identified(none), packing.pack(none, path), licenses.find_licenses(none), pitmanyor.score_documents(none),
        topk.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0),
        urlrules.judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")),
    ):
        assert empty.count() == 0
    assert decontamination.find_leaks(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_pipeline_stages(spark, docs, bench, tmp_path):
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "packing" and json.dumps([n for n, _ in corpus_pipeline.STAGES])
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert packed.count() > 0


def test_pipeline_stage_by_stage(spark, bench, tmp_path):
    """Each stage on what the one before kept, against a plain computation on the same rows."""
    near = [(300 + i, BASE.replace("river", "lake", i), "en", "b") for i in range(3)]
    shared = _text(70)
    own = [(400 + i, f"{_text(30)} {shared} {_text(30)}", "en", "a") for i in range(4)]
    own += [(410, f"{_text(20)} {BENCH} {_text(20)}", "de", "b"), (411, None, "en", "a"), (412, "12 ! 34", "en", "a")]
    given = [r for r in ROWS if r[0] is not None and r[0] not in (10, 11)] + near + own
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    sf_dir = str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    names = ["doc_id", "text", "lang", "source"]

    def run(name, docs):
        kept = stages[name](spark, docs, sf_dir)
        assert kept.columns == names
        stored = spark.createDataFrame(kept.collect(), kept.schema)
        return stored, [tuple(r) for r in stored.orderBy("doc_id").collect()]

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = {r["doc_id"]: r for r in language.identify(docs).collect()}
    docs, kept = run("language_id", docs)
    assert [r[0] for r in kept] == sorted(i for i, r in told.items() if r["lang_pred"] != "und" and r["score"] >= language.LEAST_SCORE)
    assert not {411, 412} & {r[0] for r in kept}

    _, group = simhash_groups([r[1] for r in kept])
    before, (docs, kept) = kept, run("simhash_near_dedup", docs)
    places = [group[before.index(r)] for r in kept]
    assert len(places) == len(set(places)) == len(set(group)) < len(before)

    texts = [r[1].encode() for r in kept]
    left = [t[~substrings.whole_characters(bytes(t), m)].tobytes().decode() for t, m in zip([np.frombuffer(t, np.uint8) for t in texts], repeat_marks(texts))]
    before, (docs, kept) = kept, run("suffix_array_dedup", docs)
    assert [r[1] for r in kept] == left and left != [r[1] for r in before]
    assert [r[0] for r in kept] == [r[0] for r in before]

    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    windows = {tuple(w[i : i + 10]) for w in (cut(r["text"]) for r in bench.collect()) if w for i in range(max(1, len(w) - 9))}
    hit = lambda text: any(tuple(cut(text)[i : i + len(w)]) == w for w in windows for i in range(len(cut(text))))
    before, (docs, kept) = kept, run("benchmark_decontamination", docs)
    assert [r[0] for r in kept] == [r[0] for r in before] and any(hit(r[1]) for r in before)
    assert not any(hit(r[1]) for r in kept)
    assert [r for r in kept if not hit(before[kept.index(r)][1])] == [r for r in before if not hit(r[1])]

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_path())
    pieces = defaultdict(list)
    for r in stages["packing"](spark, docs, sf_dir).collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert sorted(pieces) == [r[0] for r in kept]
    for doc_id, text, *_ in kept:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for start, length, crc, n in sorted(pieces[doc_id]):
            assert (start, n, crc) == (at, len(ids), zlib.crc32(ids[at : at + length].tobytes()))
            at += length
        assert at == len(ids)
