"""Identifiers: multi-valued id cells, report keys and row digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.functions import text as tx


def split_ids(cell: Column) -> Column:
    """The ids in one cell: separated, trimmed, unquoted, empties dropped."""
    parts = F.split(cell, v.ID_SEPARATORS)
    bare = F.transform(
        parts, lambda part: F.btrim(F.btrim(tx.strip(part), F.lit('"')), F.lit("'"))
    )
    return F.coalesce(F.filter(bare, lambda part: part != ""), F.array().cast("array<string>"))


def report_key(source: Column, project: Column, issue: Column, title: Column, body: Column) -> Column:
    """A key over source, project and id, since an id alone is not unique.

    A report without an id is keyed by its text, so that such reports do not all
    fall on one key.
    """
    text = F.concat(F.lit("text:"), F.md5(F.concat(_measured(title), _measured(body))))
    return F.sha2(F.concat(*map(_measured, (source, project, F.coalesce(issue, text)))), 256)


def _measured(part: Column) -> Column:
    """A part after its length, so that parts put together never read like others."""
    return F.coalesce(F.concat(F.length(part), F.lit(":"), part), F.lit("-"))


def row_digest(columns: list[str], salt: str = "") -> Column:
    """MD5 over all the columns, each preceded by its length and null marked, so
    that different rows never read the same."""
    cells = [F.col(f"`{name}`").cast("string") for name in columns]
    return F.md5(F.concat(F.lit(f"{salt}|"), *map(_measured, cells)))


def seeded_order(key: Column, seed: int = v.SEED) -> Column:
    """A pseudo-random but reproducible sort key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key))
