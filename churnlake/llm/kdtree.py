"""Sharding by a k-d tree over document metadata, with DataFrame operations only.

A node that holds several shards is split at a weighted quantile along its widest dimension
(its span there against the span of the whole table), so that each side gets bytes in
proportion to its shards. All nodes of a level are split together.

Quantiles are exact and distributed. A row's place along the dimension is a 63-bit key: its
scaled value, then a hash of its text, then a hash of its doc_id. The quantile of a node is
found digit by digit from the summed bytes per digit, at most 65,536 sums per node and pass;
rows are never collected by node. Rows that share a value are split where the quantile falls
among them, so one value or one group of copies that holds a third of all rows is divided
like any other range, and copies of a text stay together unless the quantile falls on them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.plans.bounded import freeze
from churnlake.plans.ordering import number_rows

# Bits of a key: scaled value, hash of the text, hash of the document.
_VALUE_BITS, _TEXT_BITS, _DOC_BITS = 20, 21, 22
# Digits of a key, from the top.
_SHIFTS = (48, 32, 16, 0)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _bits(value: Column, n: int) -> Column:
    return F.xxhash64(value).bitwiseAND(F.lit((1 << n) - 1))


def metadata() -> dict[str, Column]:
    """Default dimensions: characters, language, bytes per character. Equal texts are equal
    in all of them."""
    chars = F.coalesce(F.col("n_chars"), F.length("text"), F.lit(0)).cast("double")
    code = F.conv(F.hex(F.substring(F.coalesce("lang", F.lit("")), 1, 4)), 16, 10)
    per_char = (text_bytes(F.col("text")) - 1) / F.greatest(F.length("text"), F.lit(1))
    return {
        "chars": F.log1p(F.greatest(chars, F.lit(0.0))),
        "lang": F.coalesce(code.cast("double"), F.lit(0.0)),
        "per_char": F.coalesce(per_char, F.lit(0.0)),
    }


def _cuts(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, cut)``: the rows of a node up to key ``cut`` are its left side."""
    at = nodes.select("node", "leaves", "goal", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("prefix"))
    for i, shift in enumerate(_SHIFTS):
        top = F.lit(0).cast("long") if i == 0 else F.shiftright("key", _SHIFTS[i - 1])
        sums = (
            keyed.select("node", "size", "key", top.alias("prefix"))
            .join(at, ["node", "prefix"])
            .groupBy("node", "leaves", "goal", "before", F.shiftright("key", shift).alias("prefix"))
            .agg(F.sum("size").alias("bytes"))
        )
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("prefix")) + F.col("before")
        at = (
            sums.withColumn("upto", upto)
            # The goal is a fraction of the node's bytes: compared in whole numbers.
            .filter("upto * leaves >= goal")
            .groupBy("node", "leaves", "goal")
            .agg(F.min(F.struct("prefix", (F.col("upto") - F.col("bytes")).alias("before"), "bytes")).alias("at"))
            .select("node", "leaves", "goal", "at.before", "at.prefix", "at.bytes")
        )
        at = freeze(at, "digit")
        if shift:
            at = at.drop("bytes")
    nearer = (F.col("before") * 2 + F.col("bytes")) * F.col("leaves") <= F.col("goal") * 2
    return at.select("node", F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("cut"))


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    Give the number of ``shards``, or ``target_bytes`` per shard. ``size`` is the UTF-8
    length plus 1; a null text counts as empty and has a null crc. Null metadata count
    as 0. Rows equal in doc_id and text are not divided from each other. ``slot`` counts
    from 0 in each shard by doc_id, null first. An empty table gives no rows.
    """
    dims = dict(dimensions or metadata())
    names = [f"d{i}" for i in range(len(dims))]
    crc = F.crc32(F.col("text").cast("binary"))
    tie = F.shiftleft(_bits(F.coalesce(crc, F.lit(-1)), _TEXT_BITS), _DOC_BITS).bitwiseOR(
        _bits(F.struct("doc_id", crc), _DOC_BITS)
    )
    rows = freeze(
        docs.select(
            "doc_id",
            text_bytes(F.col("text")).alias("size"),
            crc.alias("text_crc32"),
            tie.alias("tie"),
            *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in zip(names, dims.values())],
        ),
        "metadata",
    )
    root = rows.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), *[(F.max(n) - F.min(n)).alias(n) for n in names]
    ).first()
    if shards is None:
        if not target_bytes:
            raise ValueError("give shards or target_bytes")
        shards = max(1, -(-root["bytes"] // target_bytes))
    # A node is named by its first shard.
    rows = rows.withColumns({"node": F.lit(0).cast("long"), "leaves": F.lit(shards).cast("long")})
    for _ in range((shards - 1).bit_length()):
        rows = _split_level(rows, names, [root[n] or 1.0 for n in names])
    placed = number_rows(
        rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard")),
        [("shard", "asc"), ("doc_id", "asc")],
        ["text_crc32", "size"],
        "_row",
    )
    first = freeze(placed.groupBy("shard").agg(F.min("_row").alias("_first")), "first_rows")
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )


def _split_level(rows: DataFrame, names: list[str], spans: list[float]) -> DataFrame:
    width = [(F.max(n) - F.min(n)) / F.lit(s) for n, s in zip(names, spans)]
    stats = rows.filter("leaves > 1").groupBy("node", "leaves").agg(
        F.sum("size").alias("bytes"),
        F.array(*width).alias("widths"),
        F.array(*[F.min(n) for n in names]).alias("lows"),
        F.array(*[F.max(n) for n in names]).alias("highs"),
    )
    widest = F.array_position("widths", F.array_max("widths")).cast("int")
    nodes = freeze(
        stats.select(
            "node",
            "leaves",
            widest.alias("dim"),
            F.element_at("lows", widest).alias("low"),
            F.element_at("highs", widest).alias("high"),
            F.floor(F.col("leaves") / 2).cast("long").alias("left"),
            (F.col("bytes") * F.floor(F.col("leaves") / 2)).cast("long").alias("goal"),
        ),
        "nodes",
    )
    along = nodes.select("node", "dim", "low", "high", "left")
    value = reduce(lambda e, i: e.when(F.col("dim") == i + 1, F.col(names[i])), range(1, len(names)), F.when(F.col("dim") == 1, F.col(names[0])))
    scale = (1 << _VALUE_BITS) - 1
    scaled = F.when(
        F.col("high") > F.col("low"), F.floor((value - F.col("low")) / (F.col("high") - F.col("low")) * scale)
    ).otherwise(0)
    key = F.shiftleft(scaled.cast("long"), _TEXT_BITS + _DOC_BITS).bitwiseOR(F.col("tie"))
    keyed = freeze(
        rows.join(along, "node", "left").withColumn("key", F.when(F.col("left").isNotNull(), key)).drop("dim", "low", "high"),
        "keyed",
    )
    cuts = _cuts(keyed.filter("key is not null").select("node", "size", "key"), nodes)
    told = keyed.join(cuts, "node", "left")
    goes_left = F.col("key") <= F.col("cut")
    leaves = F.when(goes_left, F.col("left")).otherwise(F.col("leaves") - F.col("left"))
    return told.withColumns(
        {
            "node": F.when(F.col("left").isNull() | goes_left, F.col("node")).otherwise(F.col("node") + F.col("left")),
            "leaves": F.when(F.col("left").isNull(), F.col("leaves")).otherwise(leaves),
        }
    ).drop("left", "key", "cut")
