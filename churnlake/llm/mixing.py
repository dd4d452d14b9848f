"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

A source's share of the mix is its weight times one common level, but never more than
``max_epochs`` times the source. Capped sources leave the excess to the others in proportion
to their weights; the level rises until no source is above its cap.

A target of 1.3 epochs takes every document once and a seeded choice of documents a second
time. The choice goes through the documents of a source in the order of a seeded hash and
stops where the words reach the target, so the sum misses it by half a document at most.
Where a running sum stops is found from the sums of hash ranges: 65,536 ranges per source
first, then the single hashes inside the one range where the sum passes the target. No task
ever holds the documents of a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.rows import ROW, packed
from churnlake.plans.bounded import freeze
from churnlake.plans.ordering import number_rows

WORD = r"[^\x20\x09-\x0D]+"
_RANGE_BITS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _seeded(seed: str) -> Column:
    """32 bits that depend on the seed and doc_id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    return docs.withColumns({"_size": word_count(F.col("text")), "_hash": _seeded(seed)})


def fill(
    sources: DataFrame, weights: Sequence[int], share: tuple[int, int], max_epochs: int
) -> DataFrame:
    """``(source, source_size, target)`` for ``sources (source, source_size)``.

    Weights go round by the code point order of the source names, null last. All sums are
    whole numbers, so the targets don't depend on the order of tasks.
    """
    ranked = number_rows(
        sources.withColumn("_last", F.col("source").isNull()), [("_last", "asc"), ("source", "asc")], [], "_row"
    )
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = freeze(
        ranked.select(
            "source",
            "source_size",
            F.element_at(cycle, ((F.col("_row") - 1) % len(weights) + 1).cast("int")).alias("_w"),
            (F.col("source_size") * max_epochs).alias("_cap"),
        ),
        "weights",
    )
    over, under = share
    whole = weighed.agg(F.sum("source_size"), F.sum("_w")).first()
    level, weight = over * (whole[0] or 0), whole[1] or 0  # the level is level / (under * weight)
    while weight:
        full = F.col("_w") * level >= F.col("_cap") * under * weight
        capped = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0))
        ).first()
        raised = over * whole[0] - under * capped[0]
        if capped[1] in (0, weight):
            level, weight = (raised, weight) if capped[1] else (level, 0)
            break
        level, weight = raised, capped[1]
    if weight:
        free = F.col("_w") * F.lit(level).cast("long")
        below = free < F.col("_cap") * F.lit(under * weight).cast("long")
        target = F.when(below, free / F.lit(under * weight)).otherwise(F.col("_cap").cast("double"))
    else:
        target = F.col("_cap").cast("double")
    return weighed.select("source", "source_size", target.alias("target"))


def plan(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    max_epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per source: ``source, source_size, target, whole`` epochs and ``cut``, the
    largest seeded hash that gets one more repetition.
    """
    sized = freeze(_sized(docs, seed).select("source", "_size", "_hash"), "sizes")
    sources = sized.groupBy("source").agg(F.sum("_size").alias("source_size"))
    targets = fill(sources, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    quotas = freeze(
        targets.withColumn("whole", whole.cast("long")).withColumn(
            "_quota", F.col("target") - F.col("whole") * F.col("source_size")
        ),
        "targets",
    )
    # The hash range in which the running sum of each source passes its quota.
    ranged = sized.groupBy("source", F.shiftright("_hash", _RANGE_BITS).alias("_range")).agg(F.sum("_size").alias("_words"))
    per_range = Window.partitionBy("source").orderBy("_range")
    passed = (
        ranged.withColumn("_upto", F.sum("_words").over(per_range))
        .join(quotas.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .filter("_upto >= _quota")
        .groupBy("source")
        .agg(F.min(F.struct("_range", (F.col("_upto") - F.col("_words")).alias("_before"))).alias("_at"))
        .select(F.col("source").alias("_s"), "_at._range", "_at._before")
    )
    ends = freeze(
        quotas.join(passed, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"),
        "ranges",
    )
    # The single hashes of that range, tied rows together.
    inside = sized.join(
        ends.select(F.col("source").alias("_s"), "_range", "_before", "_quota"),
        F.col("source").eqNullSafe(F.col("_s")) & (F.shiftright("_hash", _RANGE_BITS) == F.col("_range")),
    )
    per_hash = Window.partitionBy("source").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        inside.groupBy("source", "_hash", "_before", "_quota")
        .agg(F.sum("_size").alias("_words"))
        .withColumn("_middle", F.col("_before") + F.coalesce(F.sum("_words").over(per_hash), F.lit(0)) + F.col("_words") / 2)
        .filter("_middle < _quota")
        .groupBy("source")
        .agg(F.max("_hash").alias("_cut"))
        .select(F.col("source").alias("_s"), "_cut")
    )
    start = F.shiftleft("_range", _RANGE_BITS) - 1
    return freeze(
        ends.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "source_size", "target", "whole", F.coalesce("_cut", start).alias("cut")
        ),
        "mix",
    )


def decide(docs: DataFrame, mix: DataFrame, seed: str = "mix") -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_copies``.

    A source of the plan is one row; a hot source is split by adaptive execution.
    """
    told = mix.select(
        F.col("source").alias("_s"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        F.col("whole").alias("_whole"),
        F.col("cut").alias("_cut"),
    )
    joined = _sized(docs, seed).join(told, F.col("source").eqNullSafe(F.col("_s")))
    more = F.when(F.col("_hash") <= F.col("_cut"), 1).otherwise(0)
    return joined.withColumn("_copies", F.col("_whole") + more).drop("_s", "_whole", "_cut", "_hash")


def mix_words(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, copies, taken``.

    Null and empty texts have size 0; a null source is a source of its own, last in order.
    Rows with one doc_id share their seeded hash and so their decision. A source without
    words has target 0 and is left out of the mix. An empty table gives no rows.
    """
    base = docs.select("doc_id", "source", "text")
    return decide(base, plan(base, seed=seed, **how), seed).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_copies").alias("copies"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def repeat(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it."""
    base = docs.select("doc_id", "source", "text")
    whole = packed(docs, "doc_id", "source", "text")
    chosen = decide(whole, plan(base, seed=seed, **how), seed).filter("_copies > 0")
    return chosen.select(ROW, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(f"{ROW}.*")
