import random
import time

import pytest
from helpers import apply

from bugtide import vocabulary as v
from bugtide.functions import text as tx

FRAME = "  at org.acme.Runner$Inner.run(Runner.java:42)\n"


def random_texts(n, alphabet, length, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, length))) for _ in range(n)]


def test_whitespace_is_what_python_strips():
    assert set(v.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_words_and_counts_agree_with_python(spark):
    texts = random_texts(300, list("ab") + list(v.WHITESPACE) + ["é", "​", "語"], 12)
    found = apply(spark, texts, tx.strip, tx.words, tx.word_count)
    assert found == [(t.strip(), t.split(), len(t.split())) for t in texts]


@pytest.mark.parametrize(
    ("raw", "cleaned"),
    [
        ("<p>Hello</p> <b>you</b>", "Hello you"),
        ("if a < b and c > d", "if a d"),
        ("<a\nhref='x'>link</a>", "link"),
        ("x <> y", "x <> y"),
        ("a << b", "a << b"),
        ("tail < open", "tail < open"),
        ("a&nbsp;b&#160;c&amp;d", "a b c d"),
        ("&NBSP; and &#xA0; stay", "&NBSP; and &#xA0; stay"),
        ("one\r\ntwo\rthree", "one\ntwo\nthree"),
        ("a \t b", "a b"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("a\n \n \nb", "a\n \n \nb"),
        ("　 padded \x1f", "padded"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_text_cases(spark, raw, cleaned):
    assert apply(spark, [raw], tx.clean_text) == [cleaned]


@pytest.mark.parametrize("frames", [0, 1, 9, 10, 11, 25, 300, 50_000])
def test_stack_trace_keeps_ten_frames(spark, frames):
    text = "boom\n" + FRAME * frames + "tail"
    assert apply(spark, [text], tx.shorten_stack_traces) == ["boom\n" + FRAME * min(frames, 10) + "tail"]


def test_stack_trace_runs_are_counted_apart(spark):
    break_ = "  at sun.reflect.Native.invoke(Native Method)\n"
    texts = [
        FRAME * 12 + break_ + FRAME * 12,
        FRAME * 6 + break_ + FRAME * 6,
        FRAME * 9 + "  at java.lang.Thread.<init>(Thread.java:1)\n" + FRAME * 9,
        FRAME * 15 + "Caused by: x\n" + FRAME * 30,
        FRAME.strip() + "\n" + FRAME * 20,
        (FRAME * 14).rstrip("\n"),
        "start" + FRAME.strip() + "\n" + FRAME * 12,
        "\n\n" + FRAME * 12,
        (FRAME + "\n\n") * 12 + "end",
    ]
    expected = [
        FRAME * 10 + break_ + FRAME * 10,
        texts[1],
        texts[2],
        FRAME * 10 + "Caused by: x\n" + FRAME * 10,
        FRAME.strip() + "\n" + FRAME * 9,
        FRAME * 10 + FRAME.rstrip("\n"),
        "start" + FRAME.strip() + "\n" + FRAME * 9,
        "\n\n" + FRAME * 10,
        (FRAME + "\n\n") * 10 + "end",
    ]
    assert apply(spark, texts, tx.shorten_stack_traces) == expected


def test_no_input_makes_cleaning_slow(spark):
    million = 1_000_000
    texts = [
        " " * million + "at x",
        ("\n " * (million // 2)) + ":1)\n",
        "<" * million,
        "<" * million + ">",
        "&" * million,
        "&" + "a" * million,
        (FRAME * 9 + "\n" * 50 + "x\n") * 2_000,
        "at " * (million // 3) + "(F.java:1)\n",
        " " * million + "end",
        "x" + "  " * (million // 2) + "x)\n",
        "a.b(" * (million // 4) + ":1)\n",
        "at " + "a" * million + ":1)\n",
    ]
    start = time.time()
    apply(spark, texts, tx.clean_text)
    assert time.time() - start < 60


def test_truncate_words(spark):
    exact = " \n ".join("w" for _ in range(400))
    longer = exact + "\t\textra more"
    short_but_long_words = "x" * 5_000 + "  y"
    found = apply(spark, [exact, longer, "", "  one  two ", short_but_long_words], tx.truncate_words)
    assert found == [exact, " ".join(["w"] * 400), "", "  one  two ", short_but_long_words]


def test_truncate_never_exceeds_the_limit(spark):
    texts = random_texts(200, list("ab \n\t "), 60)
    found = apply(spark, texts, lambda c: tx.truncate_words(c, 3))
    assert found == [t if len(t.split()) <= 3 else " ".join(t.split()[:3]) for t in texts]


def test_preview(spark):
    found = apply(spark, ["", None, "abcdef"], lambda c: tx.preview(c, 3, "(empty)"), lambda c: tx.preview(c, 3))
    assert found == [("(empty)", ""), ("(empty)", None), ("abc", "abc")]


def test_the_start_of_a_long_text_gives_the_words_of_the_whole(spark):
    marks = ["<b>", "<", ">", "&amp;", "\r\n", "\r", FRAME * 12, "  at a.b(C.java:1)\n", ")\n", "\n\n\n", "\t", " "]
    texts = random_texts(400, ["ab", "c", "é"] * 8 + [" "] * 24 + marks, 60)
    texts += [" ".join(["word"] * 9) + FRAME * 14, "one two three four <" + " x" * 30 + ">", "", None]
    both = apply(
        spark, texts, lambda c: tx.clean_truncated(c, 3), lambda c: tx.truncate_words(tx.clean_text(c), 3)
    )
    assert [a for a, _ in both] == [b for _, b in both]


def test_a_long_text_is_stripped_like_a_short_one(spark):
    texts = [a + "x" * 300 + b for a in ["", *v.WHITESPACE] for b in ["", *v.WHITESPACE]] + [" " * 300, None]
    found = apply(spark, texts, tx.strip_text)
    assert found == [t if t is None else t.strip() for t in texts]
