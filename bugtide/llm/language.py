"""Language identification in two steps: the family, then the language within it.

A text's features are its byte trigrams: A-Z in lower case, other ASCII bytes that are
not letters as one blank, counted in `FEATURES` hashed places; the square roots of
their shares have unit length. A one-against-the-rest linear support vector machine
for each family (squared hinge loss) chooses the family; within it, one-versus-one
machines vote, ties going to the larger sum of margins. Only the whole text is read.

The machines are fitted on the driver, on at most `PER_LANGUAGE` distinct training
rows of a language, those with the smallest hashes, and about `SAMPLE_ROWS` rows of all of them
(fewer of each if there are many, one at least; there is no limit on languages). Each task
keeps its own smallest hashes of a language, so a language that most rows have is not
gathered. Prediction is one pass without a shuffle.

Defined cases: a text that is missing or has no letter is `und` with score 0, and so is
every text if nothing was learned; `keep_identified` then keeps the texts with a letter. A
language outside `FAMILIES` is a family of its own; repeated training rows count
once, repeated rows are predicted each for itself; an empty table gives an empty table; extra
columns are ignored by `identify`, kept by `keep_identified`.
"""

from __future__ import annotations

from collections.abc import Collection
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugtide.llm.tools import Batches, in_arrow, numbered, pieces, split_remainder, utf8
from bugtide.storage import written

#: Families of languages, by ISO 639-1 code (fixed values).
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
FEATURES = 4096
PER_LANGUAGE = 200
SAMPLE_ROWS = 12_800
ROUNDS = 150
STEP = 64
SLICE = 1_000_000
LETTERS = bytes(
    b if b >= 0x80 or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 0x20 for b in range(128)
) + bytes(range(128, 256))


def features(texts: list[bytes]) -> np.ndarray:
    """One row of `FEATURES` for each text."""
    rows = []
    for at in range(0, len(texts), STEP):
        own = [b" %b " % t.translate(LETTERS) for t in texts[at : at + STEP]]
        sizes = np.array([len(t) for t in own])
        data = np.frombuffer(b"".join(own) + b"  ", dtype=np.uint8).astype(np.uint32)
        code = data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)
        code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 12)
        # Trigrams that reach into the next text, and runs of blanks, do not count.
        inside = np.ones(len(code), dtype=bool)
        ends = np.cumsum(sizes)
        inside[ends - 1] = inside[ends - 2] = False
        inside &= ~((data[:-2] == 0x20) & (data[1:-1] == 0x20))
        place = np.repeat(np.arange(len(own)) * FEATURES, sizes) + code
        counts = np.bincount(place[inside], minlength=len(own) * FEATURES).reshape(len(own), FEATURES)
        rows.append(np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)))
    return np.concatenate(rows) if rows else np.zeros((0, FEATURES))


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights (the bias last) of a linear support vector machine, by accelerated descent.

    ``y`` is 1 or -1; both classes weigh the same.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    y = y.astype(np.float32)
    w = look = np.zeros(x.shape[1] + 1, dtype=np.float32)
    rate = np.float32(1 / (2 * 2 + penalty))
    for i in range(ROUNDS):
        pull = weight * y * np.maximum(0, 1 - y * (x @ look[:-1] + look[-1]))
        new = look - rate * (np.float32(penalty) * look - 2 * np.append(pull @ x, pull.sum()))
        look = new + np.float32(i / (i + 3)) * (new - w)
        w = new
    return w


class Model:
    def __init__(self, languages: list[str], x: np.ndarray):
        self.languages = sorted(set(languages))
        own = np.array(languages)
        family = np.array([FAMILY_OF.get(code, f"={code}") for code in languages])
        self.families = [[c for c in self.languages if FAMILY_OF.get(c, f"={c}") == f] for f in sorted(set(family))]
        several = len(self.families) > 1
        self.first = [
            fit_machine(x, np.where(np.isin(own, members), 1.0, -1.0)) if several else np.zeros(FEATURES + 1)
            for members in self.families
        ]
        self.within = [
            {
                (a, b): fit_machine(x[np.isin(own, (a, b))], np.where(own[np.isin(own, (a, b))] == a, 1.0, -1.0))
                for a, b in combinations(members, 2)
            }
            for members in self.families
        ]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margin = np.stack([x @ w[:-1] + w[-1] for w in self.first], axis=1)
        family = margin.argmax(axis=1)
        sure = _share(margin[np.arange(len(x)), family]) if len(self.families) > 1 else np.ones(len(x))
        found = np.empty(len(x), dtype=object)
        for f, members in enumerate(self.families):
            own = np.flatnonzero(family == f)
            votes = np.zeros((len(own), len(members)))
            sums = np.zeros((len(own), len(members)))
            for (a, b), w in self.within[f].items():
                m = x[own] @ w[:-1] + w[-1]
                i, j = members.index(a), members.index(b)
                votes[:, i] += m > 0
                votes[:, j] += m <= 0
                sums[:, i] += m
                sums[:, j] -= m
            best = (votes + 1e-3 * np.tanh(sums)).argmax(axis=1)
            found[own] = [members[i] for i in best]
            if len(members) > 1:
                sure[own] *= _share(sums[np.arange(len(own)), best] / (len(members) - 1))
        return found.tolist(), sure


def _share(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-3 * np.clip(margin, -20, 20)))


def _smallest(batches: Batches) -> Batches:
    """The `PER_LANGUAGE` smallest distinct hashes of each language among the task's rows."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        order, kind = batch.column(1).to_numpy(), coded.indices.to_numpy()
        for i, name in enumerate(coded.dictionary.to_pylist()):
            own = np.concatenate([held.get(name, np.zeros(0, dtype=np.int64)), order[kind == i]])
            held[name] = np.unique(own)[:PER_LANGUAGE]
    names = [name for name, own in held.items() for _ in own]
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(np.concatenate([*held.values(), np.zeros(0, dtype=np.int64)]), pa.int64())],
        names=["_lang", "_order"],
    )


def train(docs: DataFrame, held_out: Column, key: str, text: str, lang: str) -> Model | None:
    """Fit on a bounded sample of the rows that are not held out and have a language."""
    rows = docs.where(~held_out & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("_lang"), utf8(text).alias("_text"), F.xxhash64(key, text).alias("_order")
    )
    smallest = in_arrow(rows.select("_lang", "_order"), _smallest, "_lang string, _order bigint").distinct()
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_order"))
    ranked = written(smallest.withColumn("_rank", rank).where(F.col("_rank") <= PER_LANGUAGE))
    languages = ranked.select("_lang").distinct().count()
    if not languages:
        return None
    each = min(PER_LANGUAGE, max(1, SAMPLE_ROWS // languages))
    ends = ranked.where(F.col("_rank") <= each).groupBy("_lang").agg(F.max("_order").alias("_last"))
    def work(batches: Batches) -> Batches:
        for batch in batches:
            x = features(batch.column(1).to_pylist()).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["_lang", "_x"]
            )

    # At most `PER_LANGUAGE` distinct rows of a language are left, however many copies they had.
    sample = rows.join(ends, "_lang").where(F.col("_order") <= F.col("_last")).dropDuplicates(["_lang", "_order"])
    found = in_arrow(sample.select("_lang", "_text"), work, "_lang string, _x binary").orderBy("_lang", "_x").collect()
    x = np.stack([np.frombuffer(r["_x"], dtype=np.float32) for r in found])
    return Model([r["_lang"] for r in found], x)


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, fold: int = 1
) -> DataFrame:
    """Key, held_out, lang_pred and score of every document."""
    held = split_remainder(key, folds) == fold
    narrow = docs.select(F.col(key).alias("_key"), held.alias("held_out"), utf8(text).alias("_text"), _letter(text))
    kind = docs.schema[key].dataType.simpleString()
    model = train(docs, held, key, text, lang)

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for rows, texts in pieces(batch, "_text", SLICE):
                found, score = _predicted(model, texts, rows.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(found, pa.string()), pa.array(score)],
                    names=["_key", "held_out", "lang_pred", "score"],
                )

    found = in_arrow(narrow, work, f"_key {kind}, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("_key", key)


def _letter(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string").rlike("\\p{L}"), F.lit(False)).alias("_letter")


def _predicted(model: Model | None, texts: list[bytes], letter: list[bool]) -> tuple[list[str], np.ndarray]:
    if model is None:
        return ["und"] * len(texts), np.zeros(len(texts))
    found, scores = [], [np.zeros(0)]
    # Few rows at a time: however short texts are, only so many rows of features exist at once.
    for at in range(0, len(texts), STEP):
        own, score = model.predict(features(texts[at : at + STEP]))
        found += own
        scores.append(score)
    return [f if ok else "und" for f, ok in zip(found, letter, strict=True)], np.where(letter, np.concatenate(scores), 0.0)


#: A text whose prediction scores less is taken for a text in no language: even odds in both steps.
LEAST_SCORE = 0.25


def keep_identified(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 3,
    fold: int = 1,
    wanted: Collection[str] | None = None,
    least: float = LEAST_SCORE,
) -> DataFrame:
    """The documents, all columns, whose predicted language is one of ``wanted`` (any, if none
    are named) with a score of ``least``. If nothing was learned, those with a letter."""
    model = train(docs, split_remainder(key, folds) == fold, key, text, lang)
    plain = numbered(docs)
    names = plain.columns
    own = names[docs.columns.index(text)]

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for rows, texts in pieces(batch, own, SLICE):
                letter = rows.column(len(names)).to_pylist()
                found, score = _predicted(model, texts, letter)
                if model is None:
                    kept = np.array(letter, dtype=bool)
                else:
                    kept = np.array([f != "und" and (wanted is None or f in wanted) for f in found], dtype=bool) & (score >= least)
                yield rows.select(names).filter(pa.array(kept))

    return in_arrow(plain.select("*", _letter(own)), work, plain.schema).toDF(*docs.columns)
