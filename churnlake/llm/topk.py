"""Exact top-k inner products: tiles of queries and shards, merged up a tree.

Queries and candidates are dealt into blocks of bounded size by a hash of their id. Each pair
of blocks is one tile: a matrix product and a partial selection give every query of the block
its best candidates of the shard. The lists of a query are then merged in groups of
``fan_in`` shards until one is left, so no task sees all lists of a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.vectors import exact_scores, matrix, whole_vectors
from churnlake.plans.bounded import freeze

__all__ = ["top_k", "whole_vectors"]

QUERY_BLOCK = 1024
SHARD = 4096
FAN_IN = 64


def _best_of_tile(k: int):
    def best(key: tuple, queries: pa.Table, shard: pa.Table) -> pa.Table:
        names = ["query_id", "part", "vec_id", "score"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        if not queries.num_rows or not shard.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        shard = shard.sort_by("id")
        ids, asked = shard["id"].to_numpy(), queries["query_id"].to_numpy()
        width = max(pa.compute.max(pa.compute.list_value_length(v)).as_py() for v in (queries["q"], shard["w"]))
        scores = exact_scores(matrix(queries["q"], width), matrix(shard["w"], width))
        out: list[list[np.ndarray]] = [[], [], []]
        for row, query in zip(scores, asked):
            others = ids != query
            mine, there = row[others], ids[others]
            if len(mine) > k:
                least = np.partition(mine, len(mine) - k)[len(mine) - k]
                above, tied = np.flatnonzero(mine > least), np.flatnonzero(mine == least)
                pick = np.concatenate([above, tied[: k - len(above)]])  # ids are in order
                mine, there = mine[pick], there[pick]
            out[0].append(np.full(len(mine), query))
            out[1].append(there)
            out[2].append(mine)
        query_id, vec_id, score = (np.concatenate(x) for x in out)
        part = np.full(len(query_id), key[1].as_py())
        return pa.table([pa.array(x, t) for x, t in zip((query_id, part, vec_id, score), types)], names=names)

    return best


def top_k(
    vectors: DataFrame,
    asks: Column,
    k: int = 20,
    query_block: int = QUERY_BLOCK,
    shard: int = SHARD,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors (vec_id, v)`` that
    ``asks`` holds for, the ``k`` other rows of highest inner product.

    Ties go to the smaller vec_id; vectors of different length count as padded with zeros. A
    score beyond the range of a long counts as its nearest end.
    A query with fewer others gets them all; an empty table gives no rows.
    """
    rows = freeze(vectors.select("vec_id", "v"), "vectors")
    counts = rows.agg(F.count(F.lit(1)).alias("all"), F.coalesce(F.sum(asks.cast("long")), F.lit(0)).alias("asked")).first()
    blocks = max(1, -(-counts["asked"] // query_block))
    parts = max(1, -(-counts["all"] // shard))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    queries = rows.filter(asks).select(dealt(blocks).alias("block"), every(parts).alias("part"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    shards = rows.select(every(blocks).alias("block"), dealt(parts).alias("part"), F.col("vec_id").alias("id"), F.col("v").alias("w"))
    lists = (
        queries.groupBy("block", "part")
        .cogroup(shards.groupBy("block", "part"))
        .applyInArrow(_best_of_tile(k), "query_id long, part long, vec_id long, score long")
    )
    while True:
        parts = -(-parts // fan_in)
        lists = lists.withColumn("part", F.floor(F.col("part") / fan_in).cast("long"))
        order = Window.partitionBy("query_id", "part").orderBy(F.col("score").desc(), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if parts == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
