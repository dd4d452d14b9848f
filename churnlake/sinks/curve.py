"""Rows clustered along a space-filling curve, so that filters on any of several columns skip
row groups, with Bloom filters for point lookups.

A sort helps its first column only. Here each column is cut into ranges of about equal row
counts, and rows are stored in Z-order of their ranges: near rows of every column share row
groups, whose minimum and maximum then rule most of them out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 4
# Bytes of a text that its place on the curve looks at; the filters see whole texts.
TEXT_BYTES = 7


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values: dates by day, times by second, texts by
    their first bytes. NaN counts as null here."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, TEXT_BYTES)), 2 * TEXT_BYTES, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(c).cast("double")
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Values at which each column's ranges end: approximate quantiles of all rows, taken for
    all columns in one pass. At most ``2 ** bits - 1`` a column, fewer where a value is common."""
    parts = 2**bits
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = df.agg(
        *[F.struct(F.percentile_approx(_number(df, c), shares, 10_000).alias("at"), F.max(_number(df, c)).alias("top")).alias(f"_{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: sorted({v for v in found[f"_{i}"]["at"] or () if v < found[f"_{i}"]["top"]}) for i, c in enumerate(columns)}


def _place(value: Column, ends: Sequence[float], bits: int) -> Column:
    """Range of a value, spread over all of ``2 ** bits`` so that a column of two values has a
    say in the first bit of the curve. Null is in the first range."""
    if not ends:
        return F.lit(0)
    above = reduce(lambda a, b: a + b, [(value > F.lit(e)).cast("int") for e in ends])
    return F.coalesce(F.floor(above * F.lit(2**bits - 1) / F.lit(len(ends))).cast("int"), F.lit(0))


def curve_position(df: DataFrame, ends: Mapping[str, Sequence[float]], bits: int = BITS) -> Column:
    """Z-order position: the bits of the columns' ranges in turn, the highest first."""
    return _interleaved([_place(_number(df, c), e, bits) for c, e in ends.items()], bits)


def _placed(df: DataFrame, ends: Mapping[str, Sequence[float]], bits: int) -> DataFrame:
    """The same position as a column after those of ``df``, last of all. Each step is a column
    that the next one refers to, so that a row's numbers are computed once; in a sort key they
    would be computed again for each comparison."""
    width = len(df.columns)
    whole = df.toDF(*[f"_{i}" for i in range(width)])
    at = [df.columns.index(c) for c in ends]
    numbers = whole.select("*", *[_number(whole, f"_{i}").alias(f"n{i}") for i in at])
    places = numbers.select(*whole.columns, *[_place(F.col(f"n{i}"), e, bits).alias(f"p{i}") for i, e in zip(at, ends.values())])
    return places.select(*whole.columns, _interleaved([F.col(f"p{i}") for i in at], bits).alias("z"))


def _interleaved(places: Sequence[Column], bits: int) -> Column:
    if bits * len(places) > 62:
        raise ValueError("the curve has 62 bits at most: take fewer columns or fewer bits")
    taken = [
        F.shiftleft(F.shiftright(p, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(places) + len(places) - 1 - i)
        for i, p in enumerate(places)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a + b, taken, F.lit(0).cast("bigint"))


def layout_by_curve(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    lookups: Mapping[str, int] | None = None,
    bits: int = BITS,
    files: int | None = None,
    options: Mapping[str, Any] | None = None,
) -> None:
    """Write ``df`` as Parquet in curve order over ``columns``.

    ``lookups`` names columns that get a Bloom filter, each with the distinct values expected
    in a row group. ``files`` fixes the number of files; else adaptive execution sizes them.
    Files are ranges of the curve; with fewer than some ``2 ** (columns + 2)`` row groups the
    last columns gain little. Rows in one place of it, which may be a third of all, are
    ranged on by the columns and a hash of the whole row, so that no task gets them all. Two
    passes over ``df``: freeze what is expensive to compute.

    Nulls of a column come first on the curve; a table without rows gives a folder without
    rows; repeated rows are all kept; no helper column is stored or can clash with a column.
    """
    if not columns:
        raise ValueError("a curve needs a column")
    names = [f"_{i}" for i in range(len(df.columns))]
    plain = [n for n, f in zip(names, df.schema.fields) if isinstance(f.dataType, T.AtomicType)]
    placed = _placed(df, cuts(df, columns, bits), bits).select("*", F.xxhash64(*plain).alias("h"))
    order = ["z", *[names[df.columns.index(c)] for c in columns], "h"]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    kept = ranged.sortWithinPartitions(*order[:-1]).select(*names).toDF(*df.columns)
    writer = kept.write.mode("overwrite").options(**(options or {}))
    for name, distinct in (lookups or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", distinct)
    writer.parquet(path)
