"""Global order without a single-task window.

A window without ``partitionBy`` moves the whole table to one task. Here the rows are
range-partitioned on the sort key plus a unique tie key, sorted inside each partition and
numbered by their position there. The numbered frame is frozen once, so that partition ids
cannot change between passes; the row counts per partition (one row each) give the offset
that turns a local position into the global one.

The tie key is part of the range key: a sort value shared by a third of all rows is
spread over as many partitions as its rows need.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.plans.bounded import freeze

# monotonically_increasing_id keeps the position inside the partition in its low 33 bits.
_POSITION_BITS = 33

Order = Sequence[tuple[str, str]]


def _sort_columns(by: Order, tie: Sequence[str]) -> list[Column]:
    keys = [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in by]
    return keys + [F.col(c).asc() for c in tie]


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Frozen rows in global order, with their partition and position inside it."""
    return freeze(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumns(
            {
                "_part": F.shiftright("_id", _POSITION_BITS),
                "_position": F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
            }
        )
        .drop("_id"),
        "ordered",
    )


def _sum_before() -> Column:
    """Sum over the earlier partitions. The window sees one row per range partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.sum("_n").over(before)


def number_rows(df: DataFrame, by: Order, tie: Sequence[str], name: str = "row_number") -> DataFrame:
    """``df`` with its global 1-based position, plus the row count in ``_total``.

    ``tie`` makes the order total; its columns must identify a row.
    """
    placed = _placed(df, _sort_columns(by, tie))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(_sum_before(), F.lit(0)).alias("_before"),
            F.sum("_n").over(everything).alias("_total"),
        )
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_position") + 1)
        .drop("_part", "_position", "_before")
    )


def running_sum(df: DataFrame, by: str, way: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` up to and including all rows tied on ``by``.

    The values of ``by`` are summed first, then inside their range partitions; each partition
    adds the total of those before it.
    """
    per_value = df.groupBy(by).agg(F.sum(value).alias("_s"))
    placed = _placed(per_value, _sort_columns([(by, way)], []))
    inside = Window.partitionBy("_part").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    offsets = placed.groupBy("_part").agg(F.sum("_s").alias("_n")).select("_part", _sum_before().alias("_before"))
    sums = placed.join(F.broadcast(offsets), "_part").select(
        F.col(by).alias("_by"), (F.sum("_s").over(inside) + F.coalesce("_before", F.lit(0))).alias(name)
    )
    return df.join(sums, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")


def ntile_of(position: Column, total: Column, tiles: int) -> Column:
    """Bucket of a 1-based position; the first ``total mod tiles`` buckets get one extra row."""
    k = F.lit(tiles)
    size = F.floor(total / k)
    extra = total % k
    in_larger = position <= extra * (size + 1)
    larger = F.floor((position - 1) / (size + 1)) + 1
    smaller = extra + F.floor((position - 1 - extra * (size + 1)) / F.greatest(size, F.lit(1))) + 1
    return F.when(in_larger, larger).otherwise(smaller).cast("int")


def ranked(
    df: DataFrame,
    by: Order,
    tie: Sequence[str],
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    ntile: Mapping[str, int] | None = None,
) -> DataFrame:
    """``df`` with the named global rankings, all from one range shuffle.

    RANK differs from the position only for tied values, so just those are looked up.
    DENSE_RANK numbers the distinct values the same way and joins them back.
    """
    out = number_rows(df, by, tie, "_row")
    names = [c for c, _ in by]
    added: dict[str, Column] = {}
    if row_number:
        added[row_number] = F.col("_row")
    for label, tiles in (ntile or {}).items():
        added[label] = ntile_of(F.col("_row"), F.col("_total"), tiles)
    if rank or dense_rank:
        keys = out.groupBy(*names).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_ties"))
        if dense_rank:
            numbered = number_rows(keys, [("_first", "asc")], [], "_dense").drop("_total")
            out = _join_values(out, numbered, names, ["_first", "_dense"])
            added[dense_rank] = F.col("_dense")
        else:
            out = _join_values(out, keys.filter("_ties > 1"), names, ["_first"])
        if rank:
            added[rank] = F.coalesce(F.col("_first"), F.col("_row"))
    return out.withColumns(added).select(*df.columns, *added)


def _join_values(rows: DataFrame, values: DataFrame, names: Sequence[str], carry: Sequence[str]) -> DataFrame:
    renamed = values.select(*[F.col(c).alias(f"_v_{c}") for c in names], *carry)
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(renamed[f"_v_{c}"]) for c in names])
    return rows.join(renamed, same, "left").drop(*[f"_v_{c}" for c in names])
