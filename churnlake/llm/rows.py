"""Rows carried whole beside the columns that an operator works on, so that no name of a
caller's column meets one of the operator's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_row"
#: Rows of a few numbers each that one task may take.
ROWS_PER_TASK = 50_000


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and every column in the struct ``_row``."""
    whole = F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias(ROW)
    return docs.select(*[quoted(c) for c in needed], whole)


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, with underscores after it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def few_tasks(df: DataFrame, rows: int, each: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` of at most about ``rows`` rows in no more tasks than ``each`` rows a task need.

    Small frames between shuffles would otherwise be as many tiny tasks and files as there are
    shuffle partitions, round after round.
    """
    return df.coalesce(max(1, -(-rows // each)))
