"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

1. Vectors are ordered along a Hilbert curve through the dimensions of largest variance and
   written as Parquet, a folder per range partition, in blocks of ``BLOCK`` rows.
2. The zone map of a block holds the smallest and largest value of each dimension, and of the
   label. With interval arithmetic it bounds the score that an anchor can have in the block
   from both sides.
3. A search looks for the best ``k`` rows of an anchor inside score windows. First an anchor
   reads its own block, whose rows lie near it; the k-th best score found there is a floor.
   Then only those blocks are read whose bounds reach above the floor and into the window.
   Blocks are read tile by tile: one task scores a block for the anchors of a tile that need
   it, and the best of all blocks are merged.

Positives are a search in the anchor's label without a window; negatives are one in the other
labels with a window per positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.vectors import exact_scores, finite, matrix, whole
from churnlake.plans.bounded import freeze, frozen_scope
from churnlake.plans.ordering import number_rows

#: Rows of a block, anchors of a tile, zone maps that one task compares with a tile.
BLOCK = 2048
TILE = 1024
ZONES = 2048
#: Dimensions of the curve and bits of each.
CURVE_DIMENSIONS, CURVE_BITS = 8, 7
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1
_POSITION = 33
_PER_PART = 1 << 24
_HITS = "anchor_id long, window int, vec_id long, score long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of whole coordinates below 2^bits on the Hilbert curve (by Skilling's
    transform from axes to the transposed index)."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(n):
            hit = (x[:, i] & q) != 0
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(hit, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    q = top
    while q > 1:
        turn ^= np.where((x[:, -1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    place = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[:, i] >> bit) & 1)
    return place


def labelled_vectors(vectors: DataFrame, label: Column, key: str = "vec_id", value: str = "embedding", scale: int = 256) -> DataFrame:
    """``(vec_id, label, v)``: components x as floor(scale * x), one row per id.

    Rows without id or label and vectors that are null or hold null or non-finite components
    are left out. If an id repeats, its smallest label counts, then its smallest vector.
    """
    scaled = F.transform(F.col(value), lambda x: whole(x, scale))
    sound = vectors.filter(F.col(key).isNotNull() & finite(value) & label.isNotNull())
    least = F.min(F.struct(label.cast("long").alias("label"), scaled.alias("v"))).alias("least")
    return sound.groupBy(F.col(key).alias("vec_id")).agg(least).select("vec_id", "least.label", "least.v")


def _on_curve(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with their place on the curve, all vectors padded to one width, and the width."""
    spread = (
        rows.select(F.posexplode("v").alias("d", "x"))
        .groupBy("d")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.var_pop("x").alias("spread"))
        .collect()  # one row a dimension
    )
    width = len(spread)
    chosen = sorted(spread, key=lambda r: (-(r["spread"] if np.isfinite(r["spread"]) else np.inf), r["d"]))[:CURVE_DIMENSIONS]
    axes = [r["d"] for r in chosen]
    low = np.array([min(r["low"], 0.0) for r in chosen])
    high = np.array([max(r["high"], 0.0) for r in chosen])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(pa.chunked_array([batch.column("v")]), width)[:, axes]
            with np.errstate(all="ignore"):
                share = np.nan_to_num((x - low) / np.where(high > low, high - low, 1.0))
            cells = np.clip(share * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
            places = hilbert(cells, CURVE_BITS) if axes else np.zeros(batch.num_rows, np.int64)
            yield batch.append_column("place", pa.array(places, pa.int64()))

    missing = F.lit(width) - F.size("v")
    padded = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), missing)))
    return padded.mapInArrow(place, "vec_id long, label long, v array<double>, place long"), width


def _written(rows: DataFrame, block: int) -> DataFrame:
    """Rows in curve order with their block, in a folder per range partition."""
    order = ["place", "vec_id"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    part = F.shiftright("at", _POSITION)
    position = F.col("at").bitwiseAND(F.lit((1 << _POSITION) - 1))
    out = placed.select(
        "vec_id", "label", "v", "place", (part * _PER_PART + F.floor(position / block)).alias("block"), part.cast("int").alias("part")
    )
    return freeze(out, "curve", folders=["part"])


def _zone_maps(blocks: DataFrame) -> DataFrame:
    """``part, block, label_low, label_high, low, high``."""
    each = (
        blocks.select("part", "block", "label", F.posexplode_outer("v").alias("d", "x"))
        .groupBy("part", "block", "d")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.min("label").alias("label_low"), F.max("label").alias("label_high"))
    )
    sides = each.groupBy("part", "block").agg(
        F.min("label_low").alias("label_low"),
        F.max("label_high").alias("label_high"),
        F.array_sort(F.collect_list(F.struct("d", "low", "high"))).alias("sides"),
    )
    held = F.filter("sides", lambda s: s["d"].isNotNull())
    return freeze(
        sides.select(
            "part",
            "block",
            "label_low",
            "label_high",
            F.transform(held, lambda s: s["low"]).alias("low"),
            F.transform(held, lambda s: s["high"]).alias("high"),
        ),
        "zones",
    )


def _lists(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column of longs, all of one length."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def _bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that each row of ``a`` can have with a vector between
    ``low`` and ``high``, widened by what rounding may hide."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    with np.errstate(all="ignore"):
        error = (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T) * ((a.shape[1] + 4) * 2.0**-52)
        error[error < 0.25] = 0  # exact below
        return up @ low.T + down @ high.T - error, up @ high.T + down @ low.T + error


def _needed(same: bool, width: int):
    """Blocks of a chunk of zone maps that anchors of a tile must read."""

    def choose(key: tuple, anchors: pa.Table, zones: pa.Table) -> pa.Table:
        names = ["tile", "part", "block", "anchors"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        if not anchors.num_rows or not zones.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        least, most = _bounds(matrix(anchors["v"], width), matrix(zones["low"], width), matrix(zones["high"], width))
        label = anchors["label"].to_numpy()[:, None]
        low, high = zones["label_low"].to_numpy()[None], zones["label_high"].to_numpy()[None]
        fits = (low <= label) & (label <= high) if same else (low != label) | (high != label)
        floors, tops = _lists(anchors["floor"]).astype(float), _lists(anchors["high"]).astype(float)
        reached = np.zeros(fits.shape, bool)
        for w in range(floors.shape[1]):
            floor, top = floors[:, w, None], tops[:, w, None]
            # Thresholds are longs: as doubles they may be off by a share of 2^-53.
            slack = lambda t: np.where(np.abs(t) < 2.0**53, 0, np.abs(t) * 2.0**-52)
            reached |= ~(most < floor - slack(floor)) & ~(least > top + slack(top)) & (floor <= top)
        rows, columns = np.nonzero((fits & reached).T)
        ids = anchors["anchor_id"].to_numpy()
        picked, starts = np.unique(rows, return_index=True)
        lists = [ids[x] for x in np.split(columns, starts[1:])] if len(picked) else []
        tile = np.full(len(picked), key[0].as_py())
        parts, blocks = zones["part"].to_numpy()[picked], zones["block"].to_numpy()[picked]
        return pa.table([pa.array(x, t) for x, t in zip((tile, parts, blocks, lists), types)], names=names)

    return choose


def _best(same: bool, k: int, width: int):
    """Per anchor and window, the best ``k`` rows of a block."""

    def best(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        names, types = ["anchor_id", "window", "vec_id", "score"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        if not anchors.num_rows or not rows.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        rows = rows.sort_by("vec_id")
        ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        asked, label = anchors["anchor_id"].to_numpy(), anchors["label"].to_numpy()
        scores = exact_scores(matrix(anchors["v"], width), matrix(rows["v"], width))
        allowed = (label[:, None] == labels) == same
        allowed &= asked[:, None] != ids
        floors, tops = _lists(anchors["floor"]), _lists(anchors["high"])
        out: list[list[np.ndarray]] = [[], [], [], []]
        for w in range(floors.shape[1]):
            inside = allowed & (scores >= floors[:, w, None]) & (scores <= tops[:, w, None])
            for i in np.flatnonzero(inside.any(axis=1)):
                at = np.flatnonzero(inside[i])
                at = at[np.argsort(~scores[i, at], kind="stable")[:k]]  # ~x falls as x rises, at any size
                for column, value in zip(out, (np.full(len(at), asked[i]), np.full(len(at), w), ids[at], scores[i, at])):
                    column.append(value)
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table([pa.array(x, t) for x, t in zip(columns, types)], names=names)

    return best


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each anchor and window, ranked."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class Candidates:
    """Vectors on the curve, their zone maps, and the anchors among them in tiles."""

    def __init__(self, rows: DataFrame, anchors: Column, block: int = BLOCK, tile: int = TILE, zones: int = ZONES):
        on_curve, self.width = _on_curve(rows)
        self.blocks = _written(on_curve, block)
        self.maps = _zone_maps(self.blocks)
        self.chunks = max(1, -(-self.maps.count() // zones))
        numbered = number_rows(self.blocks.filter(anchors), [("place", "asc")], ["vec_id"], "row")
        self.anchors = freeze(
            numbered.select(
                F.floor((F.col("row") - 1) / tile).alias("tile"), "block", F.col("vec_id").alias("anchor_id"), "label", "v"
            ),
            "anchors",
        )
        self.tiles = -(-self.anchors.count() // tile)

    def search(self, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """``anchor_id, window, rank, vec_id, score``: the best ``k`` rows of the anchor's label
        (``same``) or of the others, by score and then id, for each anchor and each window of
        ``windows (anchor_id, low, high)``: arrays of the scores that windows start and end with,
        of one length for all anchors."""
        asked = freeze(self.anchors.join(windows.withColumnRenamed("low", "floor"), "anchor_id"), "asked")
        seeds = (
            asked.groupBy("block")
            .cogroup(self.blocks.select("block", "vec_id", "label", "v").groupBy("block"))
            .applyInArrow(_best(same, k, self.width), _HITS)
        )
        kth = (
            seeds.groupBy("anchor_id", "window")
            .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
            .filter(F.col("n") == k)
            .groupBy(F.col("anchor_id").alias("_anchor"))
            .agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("kth"))
        )
        raised = F.transform("floor", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("kth", w), F.lit(_LOWEST))))
        known = freeze(
            asked.join(kth, F.col("anchor_id") == F.col("_anchor"), "left").withColumn(
                "floor", F.when(F.col("kth").isNull(), F.col("floor")).otherwise(raised)
            ).drop("_anchor", "kth"),
            "floors",
        )

        def every(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

        if not self.tiles:
            return self.anchors.sparkSession.createDataFrame([], "anchor_id long, window int, rank int, vec_id long, score long")
        dealt = self.maps.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(self.chunks)))
        wanted = freeze(
            known.withColumn("chunk", every(self.chunks))
            .groupBy("tile", "chunk")
            .cogroup(dealt.withColumn("tile", every(self.tiles)).groupBy("tile", "chunk"))
            .applyInArrow(_needed(same, self.width), "tile long, part int, block long, anchors array<long>"),
            "wanted",
        )
        # Folders are range partitions, whose number is bounded by the shuffle's.
        parts = [r["part"] for r in wanted.select("part").distinct().collect()]
        read = self.blocks.filter(F.col("part").isin(parts)).select("block", "vec_id", "label", "v")
        asks = wanted.select("tile", "block", F.explode("anchors").alias("anchor_id"))
        mine = known.drop("tile", "block").join(asks, "anchor_id")
        needed = wanted.select(F.col("tile").alias("to_tile"), F.col("block").alias("to_block"))
        there = read.join(needed, F.col("block") == F.col("to_block"))
        hits = (
            mine.groupBy("tile", "block")
            .cogroup(there.groupBy("to_tile", "to_block"))
            .applyInArrow(_best(same, k, self.width), _HITS)
        )
        return _first(hits, k).select("anchor_id", "window", "rank", "vec_id", "score")


def _window(score: Column) -> tuple[Column, Column]:
    """Least and greatest whole score n with 50 * score <= 100 * n <= 95 * score; a negative
    score has none, so the first lies above the second."""
    half = F.shiftright(score, 1) + score.bitwiseAND(F.lit(1).cast("long"))
    rest = score % 20
    most = (score - rest) / F.lit(20)  # whole, but a double
    twentieths = most.cast("long") * 19 + F.floor(rest * 19 / 20)
    return F.when(score < 0, F.lit(1)).otherwise(half).cast("long"), F.when(score < 0, F.lit(0)).otherwise(twentieths).cast("long")


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, block: int = BLOCK, tile: int = TILE, zones: int = ZONES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows (vec_id, label, v)`` have one row per id, as ``labelled_vectors`` makes them; those
    that ``anchors`` holds for are anchors. An anchor's positives are its first ``positives``
    other rows of the same label; for each of them come the first ``negatives`` rows of other
    labels whose score lies between 50 % and 95 % of the positive's. Higher scores come first,
    ties by smaller id. A positive of negative score, and one without such rows, gives none.
    Vectors of different length count as padded with zeros; no rows or anchors give no rows.
    """
    with frozen_scope(rows.sparkSession) as scope:
        all_rows = Candidates(freeze(rows.select("vec_id", "label", "v"), "vectors"), anchors, block, tile, zones)
        anywhere = all_rows.anchors.select(
            "anchor_id", F.array(F.lit(_LOWEST)).alias("low"), F.array(F.lit(_HIGHEST)).alias("high")
        )
        liked = freeze(
            all_rows.search(anywhere, same=True, k=positives).select(
                "anchor_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("_score")
            ),
            "positives",
        )
        low, high = _window(F.col("_score"))
        ranges = liked.select("anchor_id", F.struct("rank", low.alias("low"), high.alias("high")).alias("w"))
        listed = ranges.groupBy("anchor_id").agg(F.array_sort(F.collect_list("w")).alias("ws"))
        # An anchor with fewer positives gets windows that hold nothing.
        fill = lambda c, empty: F.concat(c, F.array_repeat(F.lit(empty).cast("long"), F.lit(positives) - F.size(c)))
        windows = listed.select("anchor_id", fill(F.col("ws.low"), 1).alias("low"), fill(F.col("ws.high"), 0).alias("high"))
        found = freeze(all_rows.search(windows, same=False, k=negatives).withColumnRenamed("rank", "place"), "negatives")
        scope.keep(liked, found)
    out = found.withColumn("nth", F.col("window") + 1).join(liked.withColumnRenamed("rank", "nth"), ["anchor_id", "nth"])
    return out.select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
