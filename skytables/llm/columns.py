"""Column expressions and small DataFrame helpers the operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text_of(column: str | Column) -> Column:
    """The text, empty for NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def words(column: Column, separator: str = SPACE) -> Column:
    """Array of the maximal runs between separators."""
    return F.array_remove(F.split(column, separator), "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have, so that helper columns never clash with its own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(texts: list[str], budget: int = 1 << 20) -> list[tuple[int, int]]:
    """Consecutive (start, end) ranges of ``texts`` of at most ``budget`` characters each, one text at least, so that
    a tokenizer's per-token objects for one call stay small whatever the size of an Arrow batch."""
    out, start, held = [], 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > budget:
            out.append((start, i))
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        out.append((start, len(texts)))
    return out
