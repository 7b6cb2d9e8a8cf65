"""Chat formatting: what is read back equals what went in."""

import hashlib
import itertools
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bugtide.llm import chat

RNG = random.Random(9)
BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "<", "[", "\n", "é🙂", "ok", "s>", "INST]", "<\\s>", "[\\\\INST]"]
ROLES = ["user", "assistant", "system", None, "", "odd\nrole", "<s>", "[INST]\\l"]


def _rows():
    rows = [(1, 0, "assistant", None), (1, 1, "user", ""), (None, None, "assistant", "lost"), (None, 2, "user", "x"), (2, 5, "assistant", "same"), (2, 5, "assistant", "same")]
    for conv in range(3, 40):
        for turn in range(RNG.randint(1, 9)):
            rows.append((conv, turn, RNG.choice(ROLES), "".join(RNG.choices(BITS, k=RNG.randint(0, 8)))))
    # One conversation holds a third of all rows, another one long texts.
    rows += [(100, i, ("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(len(rows) // 2)]
    rows += [(101, i, "assistant", "é long [INST] " * 9000) for i in range(4)]
    return rows


ROWS = _rows()


def expected(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((-1 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        own.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in own)
        learned = "".join(text for _, role, text in own if role == "assistant")
        out[conv] = (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


NAMES = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, key string, part int"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(*r, "z", 1) for r in ROWS], SCHEMA).repartition(3)


@pytest.mark.parametrize("part, batch", [(1 << 20, 10_000), (300, 7)])
def test_round_trip(spark, rows, part, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        formatted = chat.format_conversations(rows, part_bytes=part).cache()
        found = {r["conv_id"]: r for r in chat.chat_digest(formatted).collect()}
        assert {k: tuple(r[n] for n in NAMES) for k, r in found.items()} == expected(ROWS)
        parts = formatted.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = defaultdict(int)
    for p in parts:
        sizes[p["conv_id"]] += len(p["formatted"])
        # Only turns' own marks are left.
        assert p["formatted"].count("</s>") == p["formatted"].count("<s>") == p["turns"]
        assert not any(c in p["formatted"] for c in ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))
    assert sizes == {k: r["formatted_chars"] for k, r in found.items()}
    assert sum(p["conv_id"] == 100 for p in parts) > 1 or part > 300


def test_loss_covers_assistant_text_alone(spark):
    df = spark.createDataFrame([(1, 0, "user", "é?"), (1, 1, "assistant", "ja é"), (1, 2, "assistant", "")], "conv_id long, turn long, role string, text string")
    (row,) = chat.format_conversations(df).collect()
    whole = row["formatted"].encode()
    assert [whole[a:b].decode() for a, b in zip(row["loss_from"], row["loss_to"])] == ["ja é", ""]
    assert row["formatted"] == "<s>user\né?</s>\n<s>assistant\nja é</s>\n<s>assistant\n</s>\n"


def test_empty_table(spark):
    formatted = chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert formatted.count() == 0 and chat.chat_digest(formatted).count() == 0


def test_clashing_names_and_text_keys(spark):
    df = spark.createDataFrame([("a", 1, "assistant", "hi", 3)], "key string, part long, role string, text string, turns long")
    formatted = chat.format_conversations(df, key="key", turn="part")
    (row,) = chat.chat_digest(formatted, key="key").collect()
    assert row["key"] == "a" and row["loss_chars"] == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=8).map("".join), st.lists(st.sampled_from(BITS), max_size=5).map("".join))
def test_escapes_are_reversible(text, role):
    (escaped,) = chat.escaped(pa.array([text.encode()])).to_pylist()
    assert chat.unescaped(escaped).decode() == text
    assert not any(c.encode() in escaped for c in chat.CONTROL)
    head = chat.header(role)
    assert chat.role_of(head[:-1]).decode() == role and head.count(b"\n") == 1
    assert not any(c.encode() in head[3:] for c in chat.CONTROL)


def test_all_short_strings_of_control_characters():
    for letters in itertools.product("<[\\/s>", repeat=5):
        text = "".join(letters).encode()
        (escaped,) = chat.escaped(pa.array([text])).to_pylist()
        assert chat.unescaped(escaped) == text and b"<s>" not in escaped and b"</s>" not in escaped
