"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_slug(c: str | Column) -> Column:
    """Lower-case folder name: spaces and dashes become underscores."""
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.translate(col, "- ", "__"))


def contains_ignoring_case(c: str | Column, needle: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(col).contains(needle.lower())


def title_case(c: str | Column) -> Column:
    """Capital after every non-letter, so ``o'neil-smith`` gives ``O'Neil-Smith``.

    ``initcap`` starts a word only after a space. The text is cut before each letter
    that follows a non-letter, each piece is capitalised, and the pieces are joined.
    """
    col = F.col(c) if isinstance(c, str) else c
    pieces = F.split(F.lower(col), r"(?<=[^\p{L}])(?=\p{L})")
    capital = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2))))
    return F.array_join(capital, "")
