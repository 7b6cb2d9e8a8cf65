"""Text cleaning, word counting and truncation.

The patterns are written so that no input makes them super-linear or recursive:
a possessive quantifier or a look-behind keeps the matcher from retrying inside a
run of blanks, and no group is repeated over unbounded text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from bugtide import vocabulary as v

# One stack frame line, e.g. "  at org.acme.Runner.run(Runner.java:42)\n".
FRAME = (
    rf"[{v.SPACE_CLASS}]*+at[{v.SPACE_CLASS}]++[{v.WORD_CLASS}.$]++"
    rf"\([{v.WORD_CLASS}.]++:\p{{Nd}}++\)[\r\n]++"
)
# Either a frame that directly follows the previous match, which is dropped, or
# the first KEPT_FRAMES frames of a run, which are kept. A run can only begin
# where a run of blanks begins.
FRAME_RUN = rf"(?!\A)\G{FRAME}|(?<![{v.SPACE_CLASS}])((?:{FRAME}){{{v.KEPT_FRAMES}}})"

# Characters for each wanted word in which `truncate_words` first looks for them.
HEAD_CHARS = 8
# Texts of fewer bytes are stripped without a look at their ends.
SHORT_BYTES = 200
# What a tag, an entity, a foreign line break or the end of a stack frame begins with.
CLEANING_MARKS = ["<", "&", "\r", ")\n"]


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda name: use(name)), 0)


def where_marked(text: Column, marks: list[str], step: Callable[[Column], Column]) -> Column:
    """Apply a step to text that contains one of the marks it needs.

    Looking for a fixed string costs a fraction of running a pattern, and most
    texts need few of the steps.
    """

    def guarded(name: Column) -> Column:
        marked = reduce(or_, [name.contains(mark) for mark in marks])
        return F.when(marked, step(name)).otherwise(name)

    return named(text, guarded)


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode blanks included."""
    return F.btrim(text, F.lit(v.WHITESPACE))


def strip_text(text: Column) -> Column:
    """`strip` for long texts, which trims only those that begin or end with a blank."""

    def step(name: Column) -> Column:
        blank = reduce(or_, [name.startswith(b) | name.endswith(b) for b in v.WHITESPACE])
        return F.when((F.octet_length(name) < SHORT_BYTES) | blank, strip(name)).otherwise(name)

    return named(text, step)


def blank_tags(text: Column) -> Column:
    """Replace every HTML tag by one space.

    Text after the last ``>`` cannot hold a tag and is set aside, so that a long
    row of unclosed ``<`` is not rescanned from each of them.
    """

    def step(name: Column) -> Column:
        tail = F.substring_index(name, ">", -1)
        head = F.left(name, F.length(name) - F.length(tail))
        return F.concat(F.regexp_replace(head, v.HTML_TAG, " "), tail)

    return where_marked(text, [">"], step)


def blank_entities(text: Column) -> Column:
    """Replace lower-case named and decimal entities by one space."""
    return where_marked(text, ["&"], lambda name: F.regexp_replace(name, v.ENTITY, " "))


def unify_newlines(text: Column) -> Column:
    return where_marked(text, ["\r"], lambda name: F.regexp_replace(name, "\r\n?", "\n"))


def shorten_stack_traces(text: Column) -> Column:
    """Keep the first ten lines of every run of ten or more stack frames."""
    return where_marked(
        text, [")\n", ")\r"], lambda name: F.regexp_replace(name, FRAME_RUN, "$1")
    )


def collapse_spaces(text: Column) -> Column:
    return where_marked(text, ["  ", "\t"], lambda name: F.regexp_replace(name, v.SPACES, " "))


def collapse_blank_lines(text: Column) -> Column:
    return where_marked(
        text, ["\n\n\n"], lambda name: F.regexp_replace(name, v.BLANK_LINES, "\n\n")
    )


def clean_text(text: Column) -> Column:
    """All cleaning steps in their fixed order; null becomes the empty string."""
    for step in (
        blank_tags,
        blank_entities,
        unify_newlines,
        shorten_stack_traces,
        collapse_spaces,
        collapse_blank_lines,
        strip_text,
    ):
        text = step(text)
    return F.coalesce(text, F.lit(""))


def _plain_blanks(text: Column) -> Column:
    """Every blank as a plain space.

    A line break is replaced as a fixed string. Only a text with some character
    outside the usual ones, as one search tells, has all blanks mapped character by
    character, which costs several times as much.
    """

    def plain(name: Column) -> Column:
        mapped = F.translate(name, v.WHITESPACE, " " * len(v.WHITESPACE))
        usual = F.replace(name, F.lit("\n"), F.lit(" "))
        return F.when(F.regexp_instr(name, F.lit(v.UNUSUAL)) > 0, mapped).otherwise(usual)

    return named(text, plain)


def spaced(text: Column) -> Column:
    """The words of a text with one plain space between them; only longer gaps need a pattern."""
    return F.trim(where_marked(_plain_blanks(text), ["  "], lambda name: F.regexp_replace(name, " {2,}", " ")))


def words(text: Column) -> Column:
    """The whitespace-separated words; none for the empty string."""
    return F.array_remove(F.split(spaced(text), " "), "")


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for the empty string."""
    return F.size(words(text))


def _first_words(text: Column, limit: int) -> Column:
    """The first ``limit`` words, one space between them; null where there are no more than that."""

    def first(name: Column) -> Column:
        head = F.substring_index(name, " ", limit)
        return F.when(F.octet_length(head) < F.octet_length(name), head)

    return named(spaced(text), first)


def truncate_words(text: Column, limit: int = v.BODY_WORDS) -> Column:
    """Text of at most ``limit`` words; a shorter text keeps its own spacing.

    More than ``limit`` words take more than ``2 * limit`` characters, so shorter
    texts are passed through untouched. Where the start of a text holds more words
    than that, the rest is not looked at.
    """
    start = HEAD_CHARS * limit

    def truncated(name: Column) -> Column:
        longer = F.when(F.length(name) > start, _first_words(name, limit))
        whole = F.coalesce(_first_words(F.left(name, F.lit(start)), limit), longer, name)
        return F.when(F.length(name) <= 2 * limit, name).otherwise(whole)

    return named(text, truncated)


def clean_truncated(text: Column, limit: int = v.BODY_WORDS) -> Column:
    """``truncate_words(clean_text(text), limit)``, without a look at the rest of a long text where it can be told.

    Where the start of a text holds no mark at which a cleaning step that changes words could
    begin, and more than ``limit`` words, those are the words that the whole clean text begins with.
    """
    start = HEAD_CHARS * limit

    def cleaned(name: Column) -> Column:
        whole = truncate_words(clean_text(name), limit)
        found = named(F.left(name, F.lit(start)), unmarked)
        return F.when(F.length(name) > start, F.coalesce(found, whole)).otherwise(whole)

    def unmarked(head: Column) -> Column:
        marked = reduce(or_, [head.contains(mark) for mark in CLEANING_MARKS])
        return F.when(~marked, _first_words(head, limit))

    return named(text, cleaned)


def preview(text: Column, chars: int, empty: str | None = None) -> Column:
    """The first ``chars`` characters, or ``empty`` where there is no text."""
    head = F.left(text, F.lit(chars))
    if empty is None:
        return head
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(empty)).otherwise(head)
