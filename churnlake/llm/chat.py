"""Chat formatting in budgeted windows.

The running sum of a conversation's turn tokens decides which window a turn belongs to: the
sum is cut into stretches of the budget left after system turn and history, turns inside one
stretch share a window, and a turn that crosses into the next stretch has one of its own. So a
window never ends inside a turn and goes over the budget only where a single turn does.

Each window repeats the system turn and up to ``history_turns`` turns before it. Repeated
turns are outside the loss mask, so every assistant text is a target exactly once.

Running sums go over range partitions ordered by conversation and turn, so a conversation
with a third of all turns is spread like any other rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.plans.bounded import freeze

BUDGET = 1024
HISTORY_TOKENS = 256
HISTORY_TURNS = 2
TURN_END = "<|end|>\n"


def tokens_of(text: Column) -> Column:
    """Size of a turn: a token for every four bytes of text, and four for its marks."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def escape(text: Column) -> Column:
    """A backslash after each ``\\``, ``<``, ``[`` and ``|``: no control string of this or
    another template can occur in the result."""
    return F.regexp_replace(text, r"([\\<\[|])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[|])\\", "$1")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and token sum of each row inside its run of one conversation."""
    conv, place, total = None, 0, 0
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        size = batch.column("tokens").to_pylist()
        places, sums = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for i, (c, t) in enumerate(zip(ids, size)):
            if c != conv:
                conv, place, total = c, 0, 0
            places[i], sums[i] = place, total
            place, total = place + 1, total + t
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(places), pa.array(sums)], names=[*batch.schema.names, "place", "before"]
        )


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Turns with ``idx`` (from 0) and ``start`` (tokens before) within their conversation."""
    order = ["conv_id", "turn", "role", "text"]
    schema = "conv_id long, turn long, role string, text string, tokens long, part int, place long, before long"
    rows = freeze(
        turns.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .filter("conv_id is not null")
        .withColumn("tokens", tokens_of(F.col("text")))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(_running, schema),
        "turns",
    )
    # What the earlier partitions hold of a conversation: a row per partition that it spans.
    held = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.select(
        "conv_id", "part", F.sum("n").over(earlier).alias("more"), F.sum("t").over(earlier).alias("moved")
    ).filter("more is not null")
    zero = F.lit(0).cast("long")
    return rows.join(freeze(carried, "carried"), ["conv_id", "part"], "left").select(
        *order,
        "tokens",
        (F.col("place") + F.coalesce("more", zero)).alias("idx"),
        (F.col("before") + F.coalesce("moved", zero)).alias("start"),
    )


def chat_windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS,
) -> DataFrame:
    """``conv_id, window, text, repeated, loss`` for ``turns (conv_id, turn, role, text)``.

    ``text`` is the formatted window, ``repeated`` the number of turns at its head that an
    earlier window already had, ``loss`` an array of ``(begin, until)`` code points of the
    assistant texts to train on. Rows of one turn number are ordered by role and text; equal
    rows stay separate turns. Null roles and texts count as empty, a null turn comes first,
    rows without conv_id are left out. An empty table gives no rows.
    """
    rows = freeze(ordered_turns(turns), "ordered_turns")
    system = freeze(
        rows.filter("idx = 0 and role = 'system'").select(
            "conv_id", F.col("text").alias("system_text"), F.col("tokens").alias("system_tokens")
        ),
        "system",
    )
    zero = F.lit(0).cast("long")
    room = F.greatest(F.lit(budget - history_tokens) - F.coalesce("system_tokens", zero), F.lit(budget // 4)).cast("long")
    head = F.col("system_tokens").isNotNull() & (F.col("idx") == 0)
    begin = F.col("start") - F.coalesce("system_tokens", zero)
    stretch = F.floor(F.col("begin") / F.col("room")).cast("long")
    crosses = (F.col("begin") + F.col("tokens") > (stretch + 1) * F.col("room")) & (F.col("begin") > stretch * F.col("room"))
    binned = freeze(
        rows.join(system, "conv_id", "left")
        .withColumns({"room": room, "head": head, "begin": F.when(head, zero).otherwise(begin)})
        .withColumn("window", F.when(F.col("head"), zero).otherwise(stretch * 2 + crosses.cast("long")))
        .select("conv_id", "window", "idx", "role", "text", "begin", "head", "system_text"),
        "binned",
    )
    firsts = freeze(
        binned.groupBy("conv_id", "window").agg(
            F.min("idx").alias("first"), F.min("begin").alias("from"), F.max("system_text").alias("system_text")
        ),
        "windows",
    )
    wanted = firsts.select(
        "conv_id",
        F.col("window").alias("w"),
        F.col("from"),
        F.explode(F.sequence(F.col("first") - history_turns, F.col("first") - 1)).alias("idx"),
    ).filter("idx >= 0")
    history = (
        binned.filter("not head")
        .join(wanted, ["conv_id", "idx"])
        .filter(F.col("from") - F.col("begin") <= history_tokens)
        .select("conv_id", F.col("w").alias("window"), "idx", "role", "text", F.lit(True).alias("again"))
    )
    system_again = firsts.filter("first > 0 and system_text is not null").select(
        "conv_id", "window", F.lit(-1).cast("long").alias("idx"), F.lit("system").alias("role"), F.col("system_text").alias("text"), F.lit(True).alias("again")
    )
    new = binned.select("conv_id", "window", "idx", "role", "text", F.lit(False).alias("again"))
    put = F.array_sort(F.collect_list(F.struct("idx", "role", "text", "again")))
    gathered = new.union(history).union(system_again).groupBy("conv_id", "window").agg(put.alias("turns"))
    heads = lambda t: F.concat(F.lit("<|"), escape(t["role"]), F.lit("|>\n"))
    shown = F.transform(
        "turns",
        lambda t: F.struct(
            heads(t).alias("mark"), escape(t["text"]).alias("body"), ((t["role"] == "assistant") & ~t["again"]).alias("learn")
        ),
    )
    whole = lambda s: F.length(s["mark"]) + F.length(s["body"]) + len(TURN_END)
    spans = F.aggregate(
        "shown",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,until:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + whole(s)).alias("at"),
            F.when(
                s["learn"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(s["mark"])).alias("begin"),
                            (acc["at"] + F.length(s["mark"]) + F.length(s["body"])).alias("until"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    text = F.array_join(F.transform("shown", lambda s: F.concat(s["mark"], s["body"], F.lit(TURN_END))), "")
    return gathered.select(
        "conv_id", "window", F.size(F.filter("turns", lambda t: t["again"])).alias("repeated"), shown.alias("shown")
    ).select("conv_id", "window", text.alias("text"), "repeated", spans.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, window, turns, learned``: the new turns as ``(role, text)`` and the texts
    under the loss mask, parsed from the formatted windows alone."""
    parts = F.split("text", r"<\|end\|>\n")
    new = F.slice(parts, F.col("repeated") + 1, F.greatest(F.size(parts) - 1 - F.col("repeated"), F.lit(0)))
    mark = F.lit("|>\n")
    turn = lambda p: F.struct(
        unescape(F.substring(p, F.lit(3), F.instr(p, "|>\n") - 3)).alias("role"),
        unescape(F.substring(p, F.instr(p, "|>\n") + F.length(mark), F.length(p))).alias("text"),
    )
    learned = F.transform(
        "loss", lambda s: unescape(F.substring(F.col("text"), s["begin"] + 1, s["until"] - s["begin"]))
    )
    return windows.select("conv_id", "window", F.transform(new, turn).alias("turns"), learned.alias("learned"))
