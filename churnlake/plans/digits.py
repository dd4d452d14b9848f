"""Exact order statistics without moving a row.

The value at a wanted position is found by descent: a range of values is cut into bins of
equal width, the rows of each bin are counted with partial sums in every task, and the bin
that holds the position is the next, narrower range. Only counts are shuffled, a few numbers
come to the driver for each position, and ties of any number are one value. As soon as few
rows are left in the open ranges, their values are counted one by one, which ends the search.

The ranges of all columns are narrowed in the same passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import floor, isinf
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.plans.bounded import freeze, frozen_scope

#: Bins of a range in one pass, and rows of open ranges that are counted value by value.
BINS = 1 << 16
FEW = 1 << 20


@dataclass(frozen=True)
class Spot:
    """A value and the number of rows below it."""

    value: Any
    below: int


@dataclass
class _Range:
    lane: str
    low: Any
    high: Any
    below: int
    rows: int
    positions: list[int]

    def holds(self, value: Column) -> Column:
        return value.between(F.lit(self.low), F.lit(self.high))

    def bin_of(self, value: Column) -> Column:
        """Bin of a value in the range; larger values never get a smaller bin."""
        if isinstance(self.low, int) and self.high - self.low < 1 << 62:
            share = (value - F.lit(self.low)).cast("double") / float(self.high - self.low)
        elif isinf(float(self.high) - float(self.low)):
            share = (value.cast("double") / 2 - self.low / 2) / (self.high / 2 - self.low / 2)
        else:
            share = (value.cast("double") - float(self.low)) / (float(self.high) - float(self.low))
        return F.least(F.floor(share * BINS), F.lit(BINS - 1))


def _narrowed(df: DataFrame, lanes: Mapping[str, Column], ranges: Sequence[_Range], by_value: bool) -> list[tuple[_Range, Any]]:
    """One pass: the groups of values that hold a wanted position, with their range."""
    entries = []
    for lane, value in lanes.items():
        number = place = None
        for i, r in enumerate(ranges):
            if r.lane == lane:
                number = F.when(r.holds(value), i) if number is None else number.when(r.holds(value), i)
                bin_ = r.bin_of(value)
                place = F.when(r.holds(value), bin_) if place is None else place.when(r.holds(value), bin_)
        if number is not None:
            entries.append(F.struct(number.alias("range"), place.alias("bin"), value.alias("v")))
    rows = df.select(F.explode(F.array(*entries)).alias("e")).filter("e.range is not null").select("e.*")
    groups = rows.groupBy("range", "v" if by_value else "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    # A range has BINS groups at most, or FEW.
    upto = F.sum("n").over(Window.partitionBy("range").orderBy("low").rowsBetween(Window.unboundedPreceding, 0))
    positions = F.array(*[F.array(*[F.lit(p - r.below).cast("long") for p in r.positions]) for r in ranges])
    hit = F.exists(positions[F.col("range")], lambda p: (p <= F.col("upto")) & (p > F.col("upto") - F.col("n")))
    found = groups.withColumn("upto", upto).filter(hit).collect()  # a row for each position at most
    return [(ranges[g["range"]], g) for g in found]


def order_statistics(
    df: DataFrame, lanes: Mapping[str, Column], wanted: Mapping[str, Sequence[int]], spans: Mapping[str, tuple[int, Any, Any]]
) -> dict[str, dict[int, Spot]]:
    """For each lane (a column of doubles or longs; null is no value), the values at the wanted
    1-based positions in ascending order. ``spans`` gives count, smallest and largest value of
    each lane. Positions that a lane does not have are left out.

    ``df`` is read once for each pass and should give the same rows each time.
    """
    out: dict[str, dict[int, Spot]] = {lane: {} for lane in lanes}
    ranges = []
    for lane in lanes:
        count, low, high = spans[lane]
        positions = sorted({p for p in wanted.get(lane, ()) if 1 <= p <= (count or 0)})
        if positions:
            ranges.append(_Range(lane, low, high, 0, count, positions))
    while ranges:
        for r in [r for r in ranges if r.low == r.high]:
            out[r.lane].update({p: Spot(r.low, r.below) for p in r.positions})
        ranges = [r for r in ranges if r.low != r.high]
        if not ranges:
            break
        following = []
        for r, g in _narrowed(df, lanes, ranges, sum(r.rows for r in ranges) <= FEW):
            first, last = r.below + g["upto"] - g["n"], r.below + g["upto"]
            inside = [p for p in r.positions if first < p <= last]
            following.append(_Range(r.lane, g["low"], g["high"], first, g["n"], inside))
        ranges = following
    return out


def spans_of(df: DataFrame, lanes: Mapping[str, Column]) -> dict[str, tuple[int, Any, Any]]:
    """Count, smallest and largest value of each lane, in one pass."""
    aggs = [f(v).alias(f"{n}_{i}") for i, v in enumerate(lanes.values()) for n, f in (("c", F.count), ("l", F.min), ("h", F.max))]
    row = df.agg(*aggs).first()
    return {lane: (row[f"c_{i}"], row[f"l_{i}"], row[f"h_{i}"]) for i, lane in enumerate(lanes)}


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], also: Mapping[str, Any] | None = None
) -> list[dict[str, Any]]:
    """Exact linear-interpolated quantiles: a dict per column that has values, with ``column``,
    the quantiles by their names, and further aggregates (name to function of a column) from
    the first pass. NaN is no value.

    The numbers are written once as they are, so passes do not compute the source again.
    """
    also = also or {}
    with frozen_scope(df.sparkSession):
        value = {c: F.col(c).cast("double") for c in columns}
        kept = freeze(df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(value.values())]), "numbers")
        lanes = {c: F.col(f"v{i}") for i, c in enumerate(columns)}
        basic = {"_n": F.count, "_low": F.min, "_high": F.max}
        first = kept.agg(*[f(v).alias(f"{n}:{c}") for c, v in lanes.items() for n, f in (basic | dict(also)).items()]).first()
        spans = {c: (first[f"_n:{c}"], first[f"_low:{c}"], first[f"_high:{c}"]) for c in columns}
        ends = {c: {q: (spans[c][0] - 1) * p for q, p in probs.items()} for c in columns if spans[c][0]}
        wanted = {c: [floor(at) + k for at in each.values() for k in (1, 2)] for c, each in ends.items()}
        spots = order_statistics(kept, lanes, wanted, spans)
    out = []
    for c, each in ends.items():
        row = {"column": c} | {n: first[f"{n}:{c}"] for n in also}
        for q, at in each.items():
            low = spots[c][floor(at) + 1].value
            high = spots[c][floor(at) + 2].value if at > floor(at) else low
            row[q] = low + (high - low) * (at - floor(at))
        out.append(row)
    return out


def tile_of(df: DataFrame, value: str, key: str, tiles: int) -> Column:
    """NTILE over ``value`` (a long, null first), ties by ``key`` (a long that identifies a
    row), as an expression over ``df``: the first ``n mod tiles`` buckets get one row more.

    The last row of each bucket is found by value and, among ties, by key; a row's bucket
    follows from comparing it with those few. With fewer rows than tiles, later buckets are
    empty.
    """
    lowest = F.lit(-(1 << 63))
    v, k = F.coalesce(F.col(value), lowest), F.coalesce(F.col(key), lowest)
    spans = spans_of(df, {"v": v})
    n = spans["v"][0]
    size, extra = divmod(n, tiles)
    cuts = [p for p in (t * size + min(t, extra) for t in range(1, tiles)) if 1 <= p < n]
    if not cuts:
        return F.lit(1)
    spots = order_statistics(df, {"v": v}, {"v": cuts}, spans)["v"]
    ties = {str(p): F.when(v == F.lit(spots[p].value), k) for p in cuts}
    keys = order_statistics(df, ties, {str(p): [p - spots[p].below] for p in cuts}, spans_of(df, ties))
    out = F.lit(1)
    for p in cuts:
        edge, last = F.lit(spots[p].value), F.lit(keys[str(p)][p - spots[p].below].value)
        out = out + F.when((v > edge) | ((v == edge) & (k > last)), 1).otherwise(0)
    return out.cast("int")
