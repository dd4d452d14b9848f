"""N-gram Jaccard join by PartEnum signatures.

Two sets of Jaccard similarity g or more differ in at most k = (|x| + |y|)(1 - g) / (1 + g)
elements. Sizes are cut into bands so that such sets lie in one band or in neighbours. For each
band the domain of shingle hashes is cut into groups of ranges, so many that one group at least
has differences in all but two of its ranges at most. All pairs of ranges of a group are
enumerated; a set's projection on a pair is a signature, and similar sets share one. Small k
takes one group of k + 2 ranges, larger k groups of three. A pair of ranges tells more sets
apart than the single range that a cut into k + 1 would give, for half as many signatures again.

Both ranges of a pair may be empty in both sets. A set in which fewer groups have such a pair
than agree with any partner can't meet one in empty pairs alone, so it leaves them out; the
rare set with more emits them.
Nothing is cut off: no signature, bucket or partner count is capped.

Links between sets of one signature are tested until components can't grow. First each set
against the smallest of its buckets. While many tests are left in buckets whose sets are not
in one component yet, a center drawn anew for each bucket is tested against the members of
other components, which joins large groups of copies. Last, the members outside a bucket's
main component are tested against all of other components, in tiles of both. A pair is dropped
without its sets where a parity sketch already differs in more than k bits (each differing
element flips one bit at most); the others are tested by exact intersection. Texts with one
shingle set are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm import sharedkeys
from churnlake.llm.bloom import bloom_joins
from churnlake.llm.components import components
from churnlake.llm.rows import ROW, few_tasks, packed
from churnlake.llm.words import Words, chunks, mixed, shingles, tidy, tidy_group
from churnlake.plans.bounded import freeze, frozen_scope

WIDTH = 5
PERCENT = 80
#: Differences from which a band has several groups of ranges.
ONE_GROUP = 5
#: Tests per member of open buckets from which centers are tried first, and turns of that. A turn
#: costs about as much as 2,000 tests a member do in tiles, and has to save more than that.
TESTS_PER_MEMBER, CENTER_TURNS = 2048, 3
#: Signatures of a set by which a pair that shares several is given once.
FIRST_KEYS = 16
#: Members and words of sketches on a side of a tile, and bytes of the tiles of a bin.
TILE_ROWS, TILE_WORDS, TILES_BYTES = 4096, 1 << 19, 8 << 20
#: Words that a tile compares at a time, and pairs after which repeated ones go.
WORDS_AT_ONCE, PAIRS_AT_ONCE = 1 << 17, 1 << 20
#: Sets that a task makes or intersects.
SETS_PER_TASK = 2_000

_DOC, _EDGE, _MEMBER = 3, 4, 5
_NO_ID = np.iinfo(np.int64).min
_SALT = np.uint64(0x2545F4914F6CDD1D)
_EMPTY = np.uint64(0x6A09E667F3BCC909)


@lru_cache(maxsize=None)
def _bands(percent: int) -> list[int]:
    """Largest size of each band; band i starts after the end of band i - 1."""
    tops, low = [], 1
    while low < 1 << 40:
        tops.append(low * 100 // percent)
        low = tops[-1] + 1
    return tops


@lru_cache(maxsize=None)
def _pairs(band: int, percent: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of ranges, those that any similar sets agree in at least, the lower bounds of all
    ranges, and the enumerated pairs of ranges, group by group, with their salts.

    Sets agree in a group if all but two of its ranges differ at most. One that they don't
    agree in takes ``parts - 1`` differences.
    """
    top = _bands(percent)[band]
    k = 2 * top * (100 - percent) // (100 + percent)
    parts, groups = (k + 2, 1) if k < ONE_GROUP else (3, k // 2 + 2 + k // 24)
    n = parts * groups
    bounds = np.array([(t << 64) // n for t in range(n)], np.uint64)
    within = np.array(list(combinations(range(parts), 2)))
    pairs = (np.arange(groups)[:, None, None] * parts + within).reshape(-1, 2)
    salts = mixed(mixed(np.full(len(pairs), np.uint64(band + 1)) * _SALT) + np.arange(len(pairs), dtype=np.uint64))
    return groups, groups - k // (parts - 1), bounds, pairs, salts


def signatures(shingle_set: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of a sorted set of hashes, for its own band and the next one."""
    n = len(shingle_set)
    if not n:
        return np.zeros(0, np.uint64)
    band = int(np.searchsorted(_bands(percent), n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(shingle_set + _SALT), out=sums[1:])
    out = []
    for b in (band, band + 1):
        groups, agreeing, bounds, pairs, salts = _pairs(b, percent)
        at = np.append(np.searchsorted(shingle_set, bounds), n)
        projections = (sums[at[1:]] - sums[at[:-1]])[pairs].sum(axis=1)
        empty = (at[1:] == at[:-1])[pairs].all(axis=1)
        out.append(mixed(projections[~empty] + salts[~empty]))
        if int(empty.reshape(groups, -1).any(axis=1).sum()) >= agreeing:
            out.append(mixed(_EMPTY + salts[empty]))
    return np.concatenate(out)


def _sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text as a sorted array."""
    hashes = words.hashes(lower=True)
    whole = shingles(hashes, width) if len(hashes) >= width else np.zeros(0, np.uint64)
    for a, b in zip(words.first[:-1], words.first[1:]):
        yield np.unique(whole[a : b - width + 1] if b - a >= width else shingles(hashes[a:b], width))


def _node(shingle_set: np.ndarray) -> int:
    """63 bits that stand for a set."""
    total = mixed(shingle_set ^ _SALT).sum(dtype=np.uint64) + np.uint64(len(shingle_set))
    return int(mixed(np.array([total], np.uint64))[0] >> np.uint64(1))


def _emit(bins: int, width: int, percent: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                ids = part.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                nodes, sizes = np.full(len(ids), _NO_ID), np.zeros(len(ids), np.int32)
                sketches = []
                keys, owners, seen = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], set()
                for i, found in enumerate(_sets(Words(part.column("text")), width)):
                    sizes[i] = len(found)
                    if len(found):
                        nodes[i] = _node(found)
                        sketches.append(_sketch(found))
                        if nodes[i] not in seen:
                            seen.add(nodes[i])
                            keys.append(signatures(found, percent))
                            owners.append(np.full(len(keys[-1]), nodes[i]))
                keys, owners = np.concatenate(keys), np.concatenate(owners)
                # Any number that differs from chunk to chunk and is the same on a retry.
                chunk = int(mixed(np.array([ids.sum()]).view(np.uint64))[0] >> np.uint64(33))
                yield sharedkeys.pack(keys, owners, np.zeros(len(keys)), bins, chunk)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk % bins], pa.int32()),
                        pa.array([_DOC], pa.int32()),
                        pa.array([ids.tobytes() + part.column("text_hash").to_numpy().tobytes()]),
                        pa.array([nodes.tobytes()]),
                        pa.array([sizes.tobytes() + b"".join(x.tobytes() for x in sketches)]),
                    ],
                    names=["bin", "kind", "keys", "owners", "extras"],
                )

    return emit


_FOUND = "kind int, a long, b long, n int, sketch array<long>, hash long"


def _buckets(table: pa.Table) -> pa.Table:
    """Edges from the smallest node of each shared signature, and members ``(key, node)`` of
    the signatures of three nodes or more. A signature that is whole in this bin is given
    once per list of members."""
    kinds, left, right, sizes, sketches, hashes = [], [], [], [], [], [np.zeros(0, np.int64)]

    def put(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> None:
        kinds.append(np.full(len(a), kind, np.int32))
        left.append(a.view(np.int64))
        right.append(b)
        sizes.append(np.zeros(len(a), np.int32) if n is None else n)

    for row in table.filter(pa.compute.equal(table["kind"], _DOC)).to_pylist():
        nodes = np.frombuffer(row["owners"], np.int64)
        ids, told = np.frombuffer(row["keys"], np.int64).reshape(2, -1)
        hashes.append(told)
        n = np.frombuffer(row["extras"], np.int32, len(ids))
        put(_DOC, ids, nodes, n)
        words, at = np.frombuffer(row["extras"][4 * len(ids) :], np.int64), 0
        for size in n.tolist():
            sketches.append(words[at : at + _sketch_words(size)] if size else None)
            at += _sketch_words(size) if size else 0
    for i, (keys, owners, _, fresh) in enumerate(sharedkeys.bin_groups(table)):
        if not len(keys):
            continue
        # Before repeated entries go: an entry that is not fresh tells of members in other bins,
        # also where the bin has a fresh one of the same node.
        starts, _ = sharedkeys.runs(keys)
        whole = np.logical_and.reduceat(fresh, starts) if i == 0 else np.zeros(len(starts), bool)
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
        keys, owners, fresh = keys[new], owners[new], fresh[new]
        starts, ends = sharedkeys.runs(keys)
        counts = ends - starts
        lists = np.add.reduceat(mixed(owners.view(np.uint64)), starts) + counts.astype(np.uint64)
        first = np.zeros(len(starts), bool)
        first[np.unique(lists, return_index=True)[1]] = True
        low = np.repeat(owners[starts], counts)
        edge = np.repeat(first, counts) & (low != owners)
        put(_EDGE, low[edge], owners[edge])
        member = np.repeat(~whole | (first & (counts > 2)), counts) & fresh
        put(_MEMBER, keys[member], owners[member])
    columns = [np.concatenate(x) if x else np.zeros(0) for x in (kinds, left, right, sizes)]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    arrays = [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types)]
    lists = pa.array(sketches, pa.list_(pa.int64()))
    arrays.append(pa.concat_arrays([lists, pa.nulls(len(arrays[0]) - len(lists), lists.type)]))
    texts = pa.array(np.concatenate(hashes))
    arrays.append(pa.concat_arrays([texts, pa.nulls(len(arrays[0]) - len(texts), texts.type)]))
    return pa.table(arrays, names=["kind", "a", "b", "n", "sketch", "hash"])


def _sketch_words(n: int) -> int:
    """Words of the parity sketch of a set: a bit or two an element, a power of two."""
    return max(2, 1 << max(0, (n - 1) // 64).bit_length())


def _sketch(shingle_set: np.ndarray) -> np.ndarray:
    bits = _sketch_words(len(shingle_set)) * 64
    odd = np.bincount((mixed(shingle_set + _EMPTY) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _with_sets(width: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = list(_sets(Words(part.column("text")), width))
                # A repeated doc_id may have other texts: its node tells the right one.
                right = np.array([len(x) > 0 and _node(x) == n for x, n in zip(found, part.column("node").to_pylist())], bool)
                sets = pa.array([x.view(np.int64) for x, r in zip(found, right) if r], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("node").filter(pa.array(right)), sets], names=["node", "elements"])

    return add


def _folded(long: str, short: str) -> Column:
    """A sketch as if it had been made with as many words as a shorter one."""
    half = F.size(short)
    pairs = F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(long) > F.size(short), pairs).otherwise(F.col(long))


def _may_link(percent: int) -> Column:
    """Sizes and sketches of ``na, sa`` and ``nb, sb`` allow a link. Exact: never false for one."""
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    flips = F.aggregate(
        F.zip_with(_folded("sa", "sb"), _folded("sb", "sa"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, x: total + x,
    )
    return sizes & (flips * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))


@dataclass
class _Corpus:
    """Texts, and ``(node, doc_id, n, sketch)`` of each distinct set."""

    texts: DataFrame
    nodes: DataFrame
    width: int
    percent: int

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` of nodes whose sets have the wanted similarity.

        Only sets of pairs that pass the sketch test are made, from the texts of one document
        each.
        """
        pairs = freeze(pairs, "pairs")
        asked = pairs.count()
        light = lambda x: self.nodes.select(
            F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")
        )
        both = pairs.join(light("a"), "a").join(light("b"), "b")
        passed = both.filter(_may_link(self.percent)).select("a", "b", (F.col("na") + F.col("nb")).alias("sizes"))
        likely = freeze(few_tasks(passed, asked), "likely")
        close = likely.count()
        ends = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
        wanted = freeze(few_tasks(ends.join(self.nodes.select("node", "doc_id"), "node"), 2 * close), "wanted")
        with bloom_joins(pairs.sparkSession):
            read = self.texts.join(wanted.filter(F.col("doc_id") > F.lit(_NO_ID)), "doc_id").select("node", "text")
            # A repeated row gives its set twice, which repeats links and changes nothing.
            made = read.mapInArrow(tidy(_with_sets(self.width)), "node long, elements array<long>")
            sets = freeze(few_tasks(made, 2 * close, SETS_PER_TASK), "sets")
        heavy = lambda x: sets.select(F.col("node").alias(x), F.col("elements").alias(f"e{x}"))
        common = F.size(F.array_intersect("ea", "eb"))
        near = likely.join(heavy("b"), "b").join(heavy("a"), "a").filter(
            common * 100 >= (F.col("sizes") - common) * self.percent
        )
        return freeze(few_tasks(near.select("a", "b"), close, SETS_PER_TASK), "links")


def _open_members(members: DataFrame, groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of the signatures whose nodes are not all in one component, with the component
    that most of them are in (``main``), the number of tests that the others need, and the
    first of each member's signatures. Of the signatures with equal members one is kept."""
    known = freeze(
        members.join(groups.withColumnRenamed("node", "b"), "b", "left")
        .select(F.col("a").alias("key"), F.col("b").alias("node"), F.coalesce("component", "b").alias("component"))
        .distinct(),
        "members",
    )
    rows = known.count()
    mark = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    parts = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), mark.alias("mark"))
    keys = parts.groupBy("key").agg(
        F.sum("n").alias("all"),
        F.max("n").alias("most"),
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.sum("mark").alias("mark"),
    )
    once = keys.filter("most < all").groupBy("mark", "all", "most", "main").agg(F.min("key").alias("key"))
    tests = ((F.col("all") - F.col("most")) * F.col("all")).alias("tests")
    unsettled = freeze(few_tasks(once.select("key", "main", tests), rows), "open_keys")
    open_ = known.join(unsettled, "key")
    firsts = F.slice(F.array_sort(F.collect_set("key")), 1, FIRST_KEYS).alias("first_keys")
    told = nodes.select("node", "n", "sketch").join(open_.groupBy("node").agg(firsts), "node")
    return freeze(few_tasks(open_.join(told, "node"), rows), "open")


def _to_center(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of each open signature's center of this turn and the members of other components."""
    order = F.xxhash64("node", F.lit(turn))
    centers = freeze(
        rows.groupBy("key").agg(F.min_by(F.struct("node", "component"), F.struct(order, "node")).alias("c")).select("key", "c.*"),
        "centers",
    )
    pairs = rows.join(centers.select("key", F.col("node").alias("c"), F.col("component").alias("cc")), "key")
    ends = pairs.filter("component <> cc").select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b"))
    return ends.distinct()


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows by the tiles that they are tested in, with the ``bin`` of each tile: members outside
    the main component in block i of their signature (role 1) against all members in block j
    (role 2). Role 3 is both, where there is one tile.

    A signature of many members has several tiles, so that no task has to take all of it.
    """
    side = F.least(F.lit(TILE_ROWS), F.greatest(F.lit(1), F.lit(TILE_WORDS) / F.col("words"))).cast("long")
    keys = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if(F.col("component") != F.col("main")).alias("out"),
        F.greatest(F.lit(2), F.max("n") / 32).alias("words"),  # of a sketch, at most
    )
    keys = keys.select("key", "all", "out", "words", F.ceil(F.col("out") / side).alias("p"), F.ceil(F.col("all") / side).alias("q"))
    several = "p > 1 or q > 1"
    sent = F.when(F.expr(several), F.expr("all * p + out * q")).otherwise(F.col("all")) * (F.col("words") + FIRST_KEYS + 6) * 8
    wide = freeze(few_tasks(keys.filter(several).select("key", "p", "q"), 1), "wide")
    bins = max(12, int(keys.agg(F.sum(sent)).first()[0] or 0) // TILES_BYTES)
    block = lambda n: F.pmod(F.xxhash64("node"), n)
    tile = lambda i, j, role: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(role).alias("role"))
    one = F.array(F.when(F.col("component") == F.col("main"), tile(F.lit(0), F.lit(0), 2)).otherwise(tile(F.lit(0), F.lit(0), 3)))
    to_all = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda j: tile(block(F.col("p")), j, 1))
    to_outer = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda i: tile(i, block(F.col("q")), 2))
    both = F.when(F.col("component") == F.col("main"), to_outer).otherwise(F.concat(to_all, to_outer))
    tiles = F.explode(F.when(F.col("p").isNull(), one).otherwise(both)).alias("tile")
    dealt = rows.join(wide, "key", "left").select("key", tiles, "node", "component", "main", "n", "sketch", "first_keys")
    return dealt.select(
        F.pmod(F.xxhash64("key", "tile.i", "tile.j"), F.lit(bins)).cast("int").alias("bin"),
        "key", "tile.i", "tile.j", "tile.role", "node", "component", (F.col("component") == F.col("main")).alias("inner"), "n", "sketch",
        "first_keys",
    )


def _fold(words: np.ndarray, to: int) -> np.ndarray:
    """Sketches ``(word, row)`` as if they had been made with ``to`` words."""
    while len(words) > to:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, and the start and length of each list."""
    lists = column.combine_chunks()
    bounds = lists.offsets.to_numpy()
    return np.asarray(lists.values), bounds[:-1], np.diff(bounds)


def _met(percent: int):
    def met(table: pa.Table) -> pa.Table:
        """Pairs of the tiles of one bin that may link."""
        table = table.combine_chunks()
        whole = lambda name: table.column(name).to_numpy()
        values, starts, words = _lists(table.column("sketch"))
        values = values.view(np.uint64)
        key, i, j = whole("key"), whole("i"), whole("j")
        # Tile by tile, and in a tile by the length of sketches.
        order = np.lexsort((words, j, i, key))
        key, i, j, words, starts = key[order], i[order], j[order], words[order], starts[order]
        node, component, n, role = (whole(x)[order] for x in ("node", "component", "n", "role"))
        n, inner = n.astype(np.int64), whole("inner")[order]
        firsts, upto = np.zeros((len(key), FIRST_KEYS), np.int64), np.zeros(len(key), np.int64)
        known, begin, upto[:] = _lists(table.column("first_keys"))
        for k in range(FIRST_KEYS):
            firsts[upto > k, k] = known[begin[upto > k] + k]
        firsts, upto = firsts[order], upto[order]
        change = np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        runs = np.flatnonzero(change | np.concatenate([[True], words[1:] != words[:-1]]))
        tile = np.cumsum(change)[runs]
        runs = np.append(runs, len(key))
        found, size_found = [np.zeros((0, 2), np.int64)], 0

        def here(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Whether a pair is given by this signature: the smallest that both ends have among
            their first ones, or any if they have none in common there."""
            has = lambda x: (np.arange(FIRST_KEYS) < upto[x, None])
            common = ((firsts[a][:, :, None] == firsts[b][:, None, :]) & has(b)[:, None, :]).any(axis=2) & has(a)
            return ~common.any(axis=1) | (firsts[a, common.argmax(axis=1)] == key[a])

        def test(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> None:
            """Members outside the main component against all, some rows at a time."""
            nonlocal found, size_found
            size = min(len(x), len(y))
            x, y = _fold(x, size), _fold(y, size)
            step = max(1, WORDS_AT_ONCE // (size * len(b)))
            for at in range(0, len(a), step):
                c = a[at : at + step]
                flips = np.bitwise_count(x[:, at : at + step, None] ^ y[:, None, :]).sum(axis=0, dtype=np.int64)
                na, nb = n[c, None], n[None, b]
                close = flips * (100 + percent) <= (na + nb) * (100 - percent)
                close &= np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent
                close &= (component[c, None] != component[None, b]) & (inner[None, b] | (node[c, None] < node[None, b]))
                p, q = np.nonzero(close)
                if len(p):
                    p, q = c[p], b[q]
                    given = here(p, q)
                    p, q = node[p[given]], node[q[given]]
                    found.append(np.column_stack([np.minimum(p, q), np.maximum(p, q)]))
                    size_found += len(p)
                if size_found > PAIRS_AT_ONCE:
                    found = [np.unique(np.concatenate(found), axis=0)]
                    size_found = 0

        at = 0
        while at < len(tile):
            end = int(np.searchsorted(tile, tile[at], "right"))
            outer, members = [], []
            for first, last in zip(runs[at:end], runs[at + 1 : end + 1]):
                rows = np.arange(first, last)
                sketch = values[starts[rows] + np.arange(words[first])[:, None]]
                for side, bit in ((outer, 1), (members, 2)):
                    asked = (role[first:last] & bit) > 0
                    if asked.any():
                        side.append((rows[asked], np.ascontiguousarray(sketch[:, asked])))
            for a, x in outer:
                for b, y in members:
                    test(a, x, b, y)
            at = end
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return met


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of one signature in different components that may link, whatever their number:
    the members outside the main component against all others.

    The sketches of a tile are compared as blocks of numbers: no row is made for a pair that
    is dropped. Copies share many signatures. A pair comes out of the smallest one of the
    ``FIRST_KEYS`` that each end has first, if they share one of those, and else wherever it meets.
    """
    return _tiled(rows).groupBy("bin").applyInArrow(tidy_group(_met(percent)), "a long, b long").distinct()


def _between(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    side = lambda x: groups.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _linked_groups(edges: DataFrame, members: DataFrame, corpus: _Corpus) -> DataFrame:
    """``(node, component)`` over all links of nodes that share a signature."""

    def joined(groups: DataFrame, links: DataFrame) -> DataFrame:
        """Components after more links; those known count as links."""
        if links.isEmpty():
            return groups
        known = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return components(known.union(links), groups.count() + links.count())

    groups = components(corpus.linked(edges.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")))
    groups = joined(groups, corpus.linked(_between(edges, groups)))
    for turn in range(CENTER_TURNS + 1):
        rows = _open_members(members, groups, corpus.nodes)
        per_key = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max("tests").alias("tests"))
        load = per_key.agg(F.sum("rows").alias("rows"), F.sum("tests").alias("tests")).first()
        if not load["rows"]:
            return groups
        if load["tests"] <= TESTS_PER_MEMBER * load["rows"] or turn == CENTER_TURNS:
            break
        groups = joined(groups, corpus.linked(_to_center(rows, turn)))
    return joined(groups, corpus.linked(_across(rows, corpus.percent)))


def _named(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, hash, n, group`` of every row: the hash of its text, the size of its set, and a
    node that names its group, null without shingles."""
    with frozen_scope(docs.sparkSession) as scope:
        texts = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"))
        bins = sharedkeys.bins_for(texts) * 3 // 2  # a set has that many more keys
        packed = texts.mapInArrow(tidy(_emit(bins, width, percent)), sharedkeys.SCHEMA)
        found = freeze(sharedkeys.in_bins(packed, _buckets, _FOUND), "signatures")
        rows = found.filter(F.col("kind") == _DOC).select(
            F.when(F.col("a") != _NO_ID, F.col("a")).alias("doc_id"), F.when(F.col("n") > 0, F.col("b")).alias("node"), "n", "sketch", "hash"
        )
        edges = freeze(found.filter(F.col("kind") == _EDGE).select("a", "b").distinct(), "stars")
        # One document stands for each node.
        nodes = (
            rows.filter("doc_id is not null and node is not null")
            .groupBy("node")
            .agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("sketch").alias("sketch"))
        )
        members = found.filter(F.col("kind") == _MEMBER).select("a", "b")
        groups = _linked_groups(edges, members, _Corpus(texts, freeze(nodes, "nodes"), width, percent))
        named = rows.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
        named = freeze(named.select("doc_id", "hash", "n", "group"), "named")
        scope.keep(named)
    return named


def jaccard_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs (doc_id, text)``.

    Words are lower-cased in A-Z. A document's set has its distinct runs of ``width`` words,
    or the whole sequence if it has fewer. Two documents link if 100 |x & y| is at least
    ``percent`` |x | y|; ``component_id`` is the smallest doc_id reachable over links. A
    null, empty or blank text has no shingles and links with nothing. A row without doc_id
    belongs to the group of documents with its set, if there is one; else its
    ``component_id`` is null. Rows with one doc_id are judged by their own texts. An empty
    table gives no rows.

    Sets and shingles are compared by 64-bit hashes.
    """
    with frozen_scope(docs.sparkSession) as scope:
        named = _named(docs, width, percent)
        least = freeze(
            named.filter("group is not null").groupBy(F.col("group").alias("g")).agg(F.min("doc_id").alias("least")), "least"
        )
        scope.keep(named, least)
    return named.join(least, F.col("group") == F.col("g"), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def one_per_group(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of linked ones: the smallest doc_id's.

    A document is what shares doc_id and text: if a doc_id has several texts, each goes or
    stays with its own group, and of two in one group the text of smaller hash stays. Equal
    rows of a group are given once. Rows without doc_id stay, and so do rows without
    shingles.
    """
    with frozen_scope(docs.sparkSession) as scope:
        named = _named(docs, width, percent).filter("group is not null and doc_id is not null").select("doc_id", "hash", "group")
        first = named.groupBy(F.col("group").alias("g")).agg(F.min(F.struct("doc_id", "hash")).alias("first"))
        told = named.join(first, F.col("group") == F.col("g")).withColumn("stays", F.col("first") == F.struct("doc_id", "hash"))
        judged = freeze(told.groupBy("doc_id", "hash").agg(F.bool_and("stays").alias("stays"), F.count(F.lit(1)).alias("copies")), "judged")
        leaving = freeze(judged.filter("not stays").select(F.col("doc_id").alias("d"), F.col("hash").alias("h")), "leaving")
        repeated = freeze(judged.filter("stays and copies > 1").select(F.col("doc_id").alias("d"), F.col("hash").alias("h")), "repeated")
        scope.keep(leaving, repeated)
    rows = packed(docs, "doc_id", "text").withColumn("hash", F.xxhash64("text"))
    same = lambda x: (F.col("doc_id") == x["d"]) & (F.col("hash") == x["h"])
    kept = rows.join(leaving, same(leaving), "left_anti")
    if not repeated.isEmpty():
        several = kept.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "hash"])
        kept = kept.join(repeated, same(repeated), "left_anti").unionByName(several)
    return kept.select(f"{ROW}.*")
