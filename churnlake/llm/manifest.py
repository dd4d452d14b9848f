"""Merkle manifest of a dataset: a digest per row, per group and of the whole, with proofs.

Leaves are ordered inside their group and cut into aligned blocks of ``fan ** depth`` leaves.
A block keeps each level of its tree as one string of hex digests side by side, so a parent
is the hash of a fixed-width substring, and the siblings of a node are the substrings left
and right of it in its run. The roots of the blocks are the leaves of the next, ``fan **
depth`` times smaller, round, until each group has one root; the roots of the groups are
hashed the same way to the root of all.

Going back down, the siblings above a block are attached to the block, not to its rows; rows
come out of their block with all their siblings, so digests are shuffled and texts never.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.plans.bounded import freeze, frozen_scope
from churnlake.plans.ordering import number_rows

HEX = 64
FAN = 2
#: Levels that a block holds: 2^8 leaves, 16 KB of digests.
DEPTH = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def encoded(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon, and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(F.concat(*[encoded(v) for v in values]))


def _above(level: Column, fan: int) -> Column:
    """The level over a level: a hash for each run of ``fan`` digests, the last maybe shorter."""
    runs = F.ceil(F.length(level) / (HEX * fan)).cast("int")
    parents = F.transform(
        F.sequence(F.lit(0), runs - 1), lambda i: digest(F.substring(level, i * (HEX * fan) + 1, F.lit(HEX * fan)))
    )
    return F.array_join(parents, "")


def _flanks(level: Column, place: Column, fan: int) -> Column:
    """Siblings of the node at ``place`` (0-based) of a level: what stands left and right of it
    in its run."""
    first = (place - place % fan).cast("int")
    here = place.cast("int")
    return F.struct(
        F.substring(level, first * HEX + 1, (here - first) * HEX).alias("left"),
        F.substring(level, (here + 1) * HEX + 1, (first + (fan - 1) - here) * HEX).alias("right"),
    )


def _height(count: Column, fan: int, depth: int) -> Column:
    """Levels that a block climbs: all, unless its group fits into one block."""
    steps = F.lit(0)
    for k in range(depth):
        steps = steps + F.when(count > fan**k, 1).otherwise(0)
    return steps


def _blocks(rows: DataFrame, fan: int, depth: int) -> DataFrame:
    """Blocks of ``rows (grp, place, count, node, item)``, frozen: ``grp, block, levels, height,
    root, members``. ``levels`` are the strings below the root, null above the block's height."""
    packed = (
        rows.withColumn("block", F.floor(F.col("place") / fan**depth))
        .groupBy("grp", "block")
        .agg(
            F.array_sort(F.collect_list(F.struct("place", "node", "item"))).alias("members"),
            _height(F.max("count"), fan, depth).alias("height"),
        )
        .select("grp", "block", "height", "members", F.array_join("members.node", "").alias("level_0"))
    )
    for k in range(depth):
        packed = packed.withColumn(f"level_{k + 1}", F.when(F.col("height") > k, _above(F.col(f"level_{k}"), fan)))
    levels = F.array(*[F.col(f"level_{k}") for k in range(depth + 1)])
    out = packed.select(
        "grp",
        "block",
        "height",
        F.slice(levels, 1, depth).alias("levels"),
        F.element_at(levels, F.col("height") + 1).alias("root"),
        F.transform("members", lambda m: F.struct(m["place"].alias("place"), m["item"].alias("item"))).alias("members"),
    )
    return freeze(out, "merkle_blocks")


def _climb(leaves: DataFrame, fan: int, depth: int) -> list[DataFrame]:
    """Rounds of blocks over ``leaves (grp, place, count, node, item)``; in the last one each
    group has one block. A round has one row for ``fan ** depth`` of the one before."""
    rounds = [_blocks(leaves, fan, depth)]
    while not rounds[-1].filter("block > 0").isEmpty():
        blocks = rounds[-1]
        counts = blocks.groupBy(F.col("grp").alias("_grp")).agg(F.count(F.lit(1)).alias("count"))
        nodes = blocks.join(counts, F.col("grp").eqNullSafe(F.col("_grp"))).select(
            "grp",
            F.col("block").alias("place"),
            "count",
            F.col("root").alias("node"),
            F.lit(None).cast("int").alias("item"),
        )
        rounds.append(_blocks(nodes, fan, depth))
    return rounds


def _descend(rounds: Sequence[DataFrame], tops: DataFrame, fan: int, depth: int) -> DataFrame:
    """Members of the first round with their leaf and all siblings up to the root of their
    group, then those in ``tops (grp, above, carry)``: ``grp, item, leaf, siblings, carry``."""
    size = fan**depth
    told = tops.withColumn("place", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        up = told.select(F.col("grp").alias("_grp"), F.col("place").alias("_block"), "above", "carry")
        joined = blocks.join(up, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block")))
        each = joined.select("grp", "levels", "height", "above", "carry", F.explode("members").alias("member"))
        at = (F.col("member.place") % size).cast("int")
        inside = F.array(
            *[
                F.when(F.col("height") > k, _flanks(F.col("levels")[k], F.floor(at / fan**k).cast("int"), fan))
                for k in range(depth)
            ]
        )
        told = each.select(
            "grp",
            F.col("member.place").alias("place"),
            F.col("member.item").alias("item"),
            F.substring(F.col("levels")[0], at * HEX + 1, F.lit(HEX)).alias("leaf"),
            F.concat(F.array_compact(inside), "above").alias("above"),
            "carry",
        )
    return told.select("grp", "item", "leaf", F.col("above").alias("siblings"), "carry")


def _no_siblings() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def merkle_tree(rows: DataFrame, group: str, order: str, leaf: str, item: Column, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """``group, item, leaf, subroot, root, siblings`` for each row.

    Leaves of a group ascend by ``order`` (null first), ties by ``leaf``, so equal rows are
    leaves side by side; each run of ``fan`` nodes becomes the hash of them, the last run and a
    run of one too, until one is left: the subroot. Subroots by group (null first, in bytes)
    give the root in the same way. ``siblings`` are, level by level from the leaf to the root,
    what stands left and right of the node in its run. No rows give no rows.
    """
    spark = rows.sparkSession
    with frozen_scope(spark) as scope:
        slim = rows.select(F.col(group).alias("grp"), F.col(order).alias("_order"), F.col(leaf).alias("node"), item.alias("item"))
        placed = freeze(number_rows(slim, [("grp", "asc"), ("_order", "asc")], ["node"], "row"), "merkle_leaves")
        spans = placed.groupBy(F.col("grp").alias("_grp")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("count"))
        leaves = placed.join(spans, F.col("grp").eqNullSafe(F.col("_grp"))).select(
            "grp", (F.col("row") - F.col("first")).alias("place"), "count", "node", "item"
        )
        below = _climb(leaves, fan, depth)
        subroots = number_rows(below[-1].select("grp", F.col("root").alias("node")), [("grp", "asc")], [], "row")
        tops = _climb(
            subroots.select(
                F.lit(0).alias("grp"), (F.col("row") - 1).alias("place"), F.col("_total").alias("count"), "node", F.col("grp").alias("item")
            ),
            fan,
            depth,
        )
        top = tops[-1].select("grp", _no_siblings().alias("above"), F.col("root").alias("carry"))
        per_group = _descend(tops, top, fan, depth).select(
            F.col("item").alias("grp"),
            F.col("siblings").alias("above"),
            F.struct(F.col("leaf").alias("subroot"), F.col("carry").alias("root")).alias("carry"),
        )
        scope.keep(*below, *tops)
        return _descend(below, per_group, fan, depth).select(
            F.col("grp").alias(group), "item", "leaf", "carry.subroot", "carry.root", "siblings"
        )


def fold(node: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(siblings, node, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))


def proof_digest(siblings: Column) -> Column:
    """A hash over all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""))


def tampered(doc_id: Column, every: int) -> Column:
    """Whether a row is among those that the check of proofs tampers with."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(False))


def checked_manifest(docs: DataFrame, tamper_every: int = 7, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """The manifest of documents with one proof a row, and what the proof says of rows of which
    one in ``tamper_every`` got another ``n_chars``.

    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``. A null in any column
    is ``-`` in the leaf; a null n_chars stays null when tampered with, so such a row still
    verifies, as does one without doc_id. Repeated rows are leaves each; extra columns have no
    part in a leaf. An empty table gives no rows.
    """
    plain = [F.col(c) for c in FIELDS]
    raised = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = tampered(F.col("doc_id"), tamper_every)
    rows = docs.select("doc_id", "lang", leaf_of(*plain).alias("leaf"), F.when(hit, leaf_of(*raised)).alias("altered"))
    tree = merkle_tree(rows, "lang", "doc_id", "leaf", F.struct("doc_id", "altered"), fan, depth)
    folded = tree.withColumn("folded_root", fold(F.coalesce("item.altered", "leaf"), F.col("siblings")))
    return folded.select(
        "item.doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("siblings")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
