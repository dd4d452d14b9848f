"""Embedding near-dedup by iterative quantisation.

A rotation is learned that makes the signs of a vector's coordinates a balanced binary code
(alternating between codes and the rotation that fits them best). Vectors meet in multi-index
Hamming tables, each keyed by some bits drawn from two codes. How many bits and tables there
are is found from the sample: pairs made at the threshold, where recall is lowest, tell how
many bits such pairs differ in, and of all choices whose expected recall there is at least
``RECALL`` the one of least work is taken. Keys have one bit at least, at any number of vectors.
Pairs that meet are compared by cosine on the original vectors.

Each pair is judged once, in the first table where it meets, which its codes tell. A table
entry that many vectors share is cut into blocks, and each pair of blocks is one matrix
product, so no task gets more than two blocks of it and nothing is left out. Only counts of
links and a spanning set of edges leave a block. Equal vectors are one entry throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.components import components
from churnlake.plans.bounded import freeze

#: Vectors that the rotations are learned from, by a hash of their id.
SAMPLE = 20_000
BITS, CODES = 64, 2
THRESHOLD = 0.9
#: Expected share of the pairs at the threshold that meet in a table.
RECALL = 0.98
#: Most bits of a table's keys, and the work of one table entry in compared pairs.
PART, ENTRY_COST = 28, 100
#: Tables beyond which a width counts as without recall.
MOST_TABLES = 4096
BLOCK = 1024
ROWS_PER_BIN = 20_000
_SMALL = 32


@dataclass
class Quantizer:
    """Mean, one projection per code, and the bits of each table."""

    mean: np.ndarray
    projections: list[np.ndarray]
    tables: np.ndarray | None = None

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """One row of 64-bit codes per vector."""
        width = min(unit.shape[1], len(self.mean))
        shifted = np.zeros((len(unit), len(self.mean)))
        shifted[:, :width] = unit[:, :width]
        shifted -= self.mean
        out = [np.packbits(shifted @ p > 0, axis=1, bitorder="little").view(np.int64)[:, 0] for p in self.projections]
        return np.stack(out, axis=1)

    def parts(self, codes: np.ndarray) -> np.ndarray:
        """The bits of each table (columns) of each row of codes, as numbers."""
        bits = _bits(codes).astype(np.int32)
        out = np.zeros((len(codes), len(self.tables)), np.int32)
        for t, chosen in enumerate(self.tables):
            for i, bit in enumerate(chosen):
                out[:, t] |= bits[:, bit] << i
        return out


def _bits(codes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(codes).view(np.uint8), axis=1, bitorder="little")


def _agreement(model: Quantizer, sample: np.ndarray, threshold: float, rng: np.random.Generator) -> list[np.ndarray]:
    """Shares of bits that pairs at the threshold agree in: each vector of the sample with one
    turned away from it in any direction, and with one turned towards another of the sample."""
    x = sample[rng.permutation(len(sample))[:2000]]
    out = []
    for away in (rng.normal(size=x.shape), np.roll(x, 1, axis=0)):
        away = away - (away * x).sum(axis=1, keepdims=True) * x
        length = np.sqrt((away * away).sum(axis=1))
        fits = length > 1e-6
        y = threshold * x[fits] + np.sqrt(max(0.0, 1 - threshold * threshold)) * away[fits] / length[fits, None]
        if fits.any():
            out.append((_bits(model.codes(x[fits])) == _bits(model.codes(y))).mean(axis=1))
    return out


def choose_tables(model: Quantizer, sample: np.ndarray, count: int, threshold: float, seed: int = 11) -> np.ndarray:
    """Bits of each table (rows) for ``count`` vectors."""
    rng = np.random.default_rng(seed)
    shares = _agreement(model, sample, threshold, rng)
    recall = lambda width, n: min(float((1 - (1 - a**width) ** n).mean()) for a in shares)
    width, tables, least = 1, CODES * BITS, float("inf")
    for w in range(1, PART + 1 if shares else 0):
        low, n = 0, 1
        while recall(w, n) < RECALL and n * ENTRY_COST < least and n < MOST_TABLES:
            low, n = n, 2 * n
        while n - low > 1:
            low, n = (low, (low + n) // 2) if recall(w, (low + n) // 2) >= RECALL else ((low + n) // 2, n)
        cost = n * (ENTRY_COST + count / 2**w)
        if recall(w, n) >= RECALL and cost < least:
            width, tables, least = w, n, cost
    return np.array([rng.permutation(CODES * BITS)[:width] for _ in range(tables)], np.int64).reshape(tables, width)


def learn(sample: np.ndarray, rounds: int = 50, seed: int = 7) -> Quantizer:
    """Fit on unit vectors. Wide vectors are first cut to their 64 main directions, narrow
    ones spread over 64 coordinates."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    centred = sample - mean
    width = sample.shape[1]
    projections = []
    for _ in range(CODES):
        if width >= BITS:
            _, axes = np.linalg.eigh(centred.T @ centred)
            base = axes[:, ::-1][:, :BITS]
        else:
            base = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0][:width]
        z = centred @ base
        rotation = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
        for _ in range(rounds):
            signs = np.where(z @ rotation > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(z.T @ signs)
            rotation = u @ v
        projections.append(base @ rotation)
    return Quantizer(mean, projections)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column, short ones padded with zeros."""
    lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(lengths.max(initial=1))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _encode(model: Quantizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = model.codes(_unit(_matrix(batch.column("v"))))
            keys = model.parts(codes) + (np.arange(len(model.tables), dtype=np.int64) << PART)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(codes), pa.list_(pa.int64())), pa.array(list(keys), pa.list_(pa.int64()))],
                names=[*batch.schema.names, "codes", "keys"],
            )

    return run


def _first_here(parts_a: np.ndarray, parts_b: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether pairs meet in no table before the one they are compared in."""
    same = parts_a == parts_b
    return same.argmax(axis=-1) == table


def _first_met(parts: np.ndarray, a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``_first_here`` for pairs of rows, some at a time."""
    step = max(1, (1 << 22) // parts.shape[1])
    cuts = [slice(at, at + step) for at in range(0, len(a), step)]
    return np.concatenate([np.zeros(0, bool), *(_first_here(parts[a[c]], parts[b[c]], table[c]) for c in cuts)])


def _lowest(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label of each linked set of a matrix whose rows and columns carry labels."""
    while True:
        to_a = np.minimum(a, np.where(mask, b[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        to_b = np.minimum(b, np.where(mask, to_a[:, None], np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max))
        if (to_a == a).all() and (to_b == b).all():
            return a, b
        a, b = to_a, to_b


def _rerank(threshold: float, model: Quantizer):
    def rerank(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("block", "ascending")])
        rep, many, key = (table[c].to_numpy() for c in ("rep", "many", "key"))
        i, j, block = (table[c].to_numpy() for c in ("i", "j", "block"))
        unit = _unit(_matrix(table["v"]))
        codes = pa.concat_arrays(table["codes"].chunks).flatten().to_numpy().reshape(-1, CODES)
        parts = model.parts(codes)
        links = np.zeros(len(rep), np.int64)
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        new = np.ones(len(rep), bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(rep))
        table_no = key >> PART
        # Short runs together, by the distance of the two rows.
        size = np.repeat(ends - starts, ends - starts)
        until = np.repeat(ends, ends - starts)
        short = np.flatnonzero((size <= _SMALL) & (size > 1))
        for step in range(1, int(size[short].max(initial=1))):
            a = short[short + step < until[short]]
            b = a + step
            fits = (i[a] == j[a]) | (block[a] != block[b])
            a, b = a[fits], b[fits]
            near = np.einsum("nd,nd->n", unit[a], unit[b]) >= threshold
            a, b = a[near], b[near]
            near = _first_met(parts, a, b, table_no[a])
            a, b = a[near], b[near]
            np.add.at(links, a, many[b])
            np.add.at(links, b, many[a])
            edges.append((rep[a], rep[b]))
        for s, e in zip(starts[ends - starts > _SMALL], ends[ends - starts > _SMALL]):
            cut = e if i[s] == j[s] else s + int((block[s:e] == i[s]).sum())
            left, right = np.arange(s, cut), np.arange(cut, e) if cut < e else np.arange(s, e)
            if not len(left) or (i[s] != j[s] and cut == e):
                continue
            for at in range(0, len(left), 256):
                rows = left[at : at + 256]
                mask = unit[rows] @ unit[right].T >= threshold
                mask &= rows[:, None] < right[None, :]
                x, y = np.nonzero(mask)
                kept = _first_met(parts, rows[x], right[y], table_no[rows[x]])
                mask[x[~kept], y[~kept]] = False
                links[rows] += mask @ many[right]
                links[right] += many[rows] @ mask
                low_a, low_b = _lowest(mask, rep[rows], rep[right])
                edges += [(rep[rows], low_a), (rep[right], low_b)]
        a = np.concatenate([x[0] for x in edges]) if edges else rep[:0]
        b = np.concatenate([x[1] for x in edges]) if edges else rep[:0]
        linked = links > 0
        pairs = np.unique(np.stack([a[a != b], b[a != b]]), axis=1)
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.table(
            [
                pa.concat_arrays([pa.array(rep[linked]), pa.array(pairs[0])]),
                pa.concat_arrays([pa.array(links[linked]), none(len(pairs[0]))]),
                pa.concat_arrays([none(int(linked.sum())), pa.array(pairs[1])]),
            ],
            names=["a", "n", "b"],
        )

    return rerank


def near_groups(
    vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, block: int = BLOCK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, embedding)``.

    Two vectors link if they meet in a table and their cosine in double precision is at least
    ``threshold``. ``n_links`` counts the other vectors linked directly, ``component_id`` is
    the smallest vec_id reachable, ``kept`` says that it is the vector itself.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing, and so do rows without vec_id, whose ``component_id`` is null and which are not
    kept. Vectors of different length count as padded with zeros. Rows that repeat an id are
    vectors of their own. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    infinite = F.lit(float("inf"))
    sound = (
        F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < infinite))
        & F.exists("v", lambda x: x != 0)
    )
    # Floats stay floats on the way to the tables.
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind).alias("v")).withColumn(
        "sound", F.coalesce(sound, F.lit(False))
    )
    distinct = freeze(
        rows.filter("sound").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("many")), "vectors"
    )
    picked = distinct.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toArrow()["v"]
    width = distinct.agg(F.coalesce(F.max(F.size("v")), F.lit(1))).first()[0]
    known = np.zeros((len(picked), width))
    if len(picked):
        found = _matrix(picked)
        known[:, : found.shape[1]] = _unit(found)
    model = learn(known)
    count = distinct.count()
    model.tables = choose_tables(model, known, count, threshold)
    coded = freeze(
        distinct.mapInArrow(_encode(model), f"v {kind}, rep long, many long, codes array<long>, keys array<long>"), "codes"
    )
    load = coded.select(F.explode("keys").alias("key")).groupBy("key").count()
    crowded = freeze(load.filter(F.col("count") > block).select("key", F.ceil(F.col("count") / block).alias("blocks")), "crowded")
    entries = coded.select("rep", "many", "codes", "v", F.explode("keys").alias("key")).join(crowded, "key", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    tiles = (
        entries.withColumn("blocks", blocks)
        .withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    copied = crowded.join(load, "key").agg(F.sum(F.col("count") * (F.col("blocks") - 1))).first()[0] or 0
    bins = max(12, (count * len(model.tables) + copied) // ROWS_PER_BIN)
    dealt = tiles.withColumn("bin", F.pmod(F.xxhash64("key", "i", "j"), F.lit(bins))).select(
        "bin", "key", "i", "j", "block", "rep", "many", "codes", "v"
    )
    found = freeze(dealt.groupBy("bin").applyInArrow(_rerank(threshold, model), "a long, n long, b long"), "found")
    links = found.filter("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    groups = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    told = distinct.join(links, "rep", "left").join(groups, "rep", "left").select(
        F.col("v").alias("w"),
        (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("linked"),
        F.coalesce("component", "rep").alias("group"),
    )
    joined = rows.join(freeze(told, "told"), F.col("sound") & (F.col("v") == F.col("w")), "left")
    component = F.coalesce("group", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("linked", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
