"""Substring dedup with an FM-index per shard.

A window is ``width`` words. A word goes if a window that covers it also starts in a document
of smaller doc_id.

1. Every window has a minimizer, the ``SEED``-word run of smallest hash in it; equal windows
   have equal minimizers. Minimizers that occur in one document only are found with one packed
   shuffle of hashes, and windows that have one are done with.
2. The other windows are cut into segments (windows in a row with one minimizer) and dealt to
   shards by minimizer, so that equal windows meet. The segments of a very frequent minimizer
   are cut into single windows, dealt by all their words. Equal segments of one chunk of input
   are sent once, with their places in the smallest document, and a chunk's segments travel as
   one packed row a shard.
3. Each shard indexes its distinct segments: suffix array, Burrows-Wheeler transform, a wavelet
   matrix of packed bits over it, and the smallest doc_id of each range of suffixes. All of
   them are then streamed through it, last word first, many at a time: backward search
   extends a match to the left as long as some occurrence lies in a smaller document. That
   gives the matching statistics, and where they reach ``width`` words the interval is
   reported. A segment that is the same in several documents is streamed as the smallest
   one's; in the others all of it is a repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm import sharedkeys
from churnlake.llm.bloom import bloom_joins
from churnlake.llm.rows import ROW, packed
from churnlake.llm.words import Words, chunks, mixed, shingles, tidy, tidy_group
from churnlake.plans.bounded import freeze, frozen_scope

WIDTH = 13
SEED = 5
#: Occurrences from which a minimizer's segments are sent window by window.
FREQUENT = 20_000
#: Bytes of a word and its space, for the number of shards.
WORD_BYTES = 8

_DOC, _HIT, _FREQUENT = 3, 4, 5


class WaveletMatrix:
    """Rank over a sequence of symbols, one packed bit per symbol and level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.size = len(symbols)
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = ((symbols >> level) & 1).astype(bool)
            padded = np.zeros((self.size // 64 + 1) * 64, bool)
            padded[: self.size] = bits
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(self.size - int(counts.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where prefixes of length ``at`` end among the sorted occurrences of ``symbols``."""
        for i in range(self.levels):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[i][word] + np.bitwise_count(self.words[i][word] & mask)
            up = ((symbols >> (self.levels - 1 - i)) & 1).astype(bool)
            at = np.where(up, self.zeros[i] + ones, at - ones)
        return at


class RangeMin:
    """Smallest value of ranges of an array, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        sizes = [n - (1 << i) + 1 for i in range(max(1, n.bit_length()))]
        self.starts = np.cumsum([0, *sizes])
        self.flat = np.empty(self.starts[-1], np.int32)
        self.flat[:n] = values
        for i, size in enumerate(sizes[1:]):
            last = self.flat[self.starts[i] : self.starts[i + 1]]
            np.minimum(last[:size], last[-size:], out=self.flat[self.starts[i + 1] : self.starts[i + 2]])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For ranges ``low <= i < high`` that are not empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        base = self.starts[level]
        return np.minimum(self.flat[base + low], self.flat[base + high - (1 << level.astype(np.int64))])


class FMIndex:
    """FM-index of several texts of dense symbols, each with an owner."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, owners: np.ndarray, sigma: int):
        """``symbols`` are the texts one after another, values 1 to ``sigma - 1``."""
        count, n = len(lengths), len(symbols) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = symbols
        # Each end mark is a symbol of its own below all words, so suffixes never run on.
        rank = text + count
        rank[ends] = np.arange(count)
        step, longest = 1, int(lengths.max()) + 1
        while True:
            follow = np.zeros(n, np.int64)
            follow[:-step] = rank[step:] + 1
            order = np.argsort(rank * (n + sigma + count + 2) + follow, kind="stable")
            if step >= longest:
                break
            pair = (rank[order], follow[order])
            new = np.concatenate([[0], np.cumsum((pair[0][1:] != pair[0][:-1]) | (pair[1][1:] != pair[1][:-1]))])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            step *= 2
        transform = text[order - 1]  # the text before the first one is an end mark
        self.size = n
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.tree = WaveletMatrix(transform, sigma)
        self.base = self.tree.place(np.arange(sigma), np.zeros(sigma, np.int64))
        self.least = RangeMin(np.repeat(owners, lengths + 1)[order])

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges after one more symbol on the left."""
        both = self.tree.place(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        shift = self.below[symbols] - self.base[symbols]
        return both[: len(low)] + shift, both[len(low) :] + shift


def repeated_windows(
    index: FMIndex, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Stream texts through an index: ``(text, start)`` of each window of ``width`` symbols
    that also occurs in a text of a smaller owner.

    ``begin`` to ``end`` is the present match of a text. If it can't grow, every window over
    the symbol that failed and the match is out, and the search goes on from the last end
    that avoids them.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    who = np.flatnonzero(lengths >= width)
    end, begin = lengths[who].copy(), lengths[who].copy()
    low, high = np.zeros(len(who), np.int64), np.full(len(who), index.size)
    while len(who):
        new_low, new_high = index.extend(symbols[starts[who] + begin - 1], low, high)
        grows = new_high > new_low
        grows[grows] = index.least.of(new_low[grows], new_high[grows]) < owners[who[grows]]
        begin = begin - grows
        low, high = np.where(grows, new_low, 0), np.where(grows, new_high, index.size)
        hit = grows & (end - begin >= width)
        if hit.any():
            found.append((who[hit], begin[hit]))
        end = np.where(grows, end, np.minimum(end - 1, begin + width - 1))
        begin = np.where(grows, begin, end)
        go = (begin > 0) & (end >= width)
        who, end, begin, low, high = who[go], end[go], begin[go], low[go], high[go]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _minimizers(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows inside a text, the place of each one's minimizer, and the hashes
    of all runs of ``SEED`` words. Of equal hashes the first counts."""
    none = np.zeros(0, np.int64)
    if len(hashes) < width:
        return none, none, np.zeros(0, np.uint64)
    seeds = shingles(hashes, SEED)
    lengths = np.diff(first)
    until = np.repeat(first[1:], lengths)
    begin = np.arange(len(hashes))
    begin = begin[begin + width <= until]
    span = width - SEED + 1
    view = np.lib.stride_tricks.sliding_window_view(seeds, span)
    return begin, begin + view.argmin(axis=1)[begin], seeds


def _digests(column: pa.Array) -> list[bytes]:
    """SHA-256 of each text's words joined by one space. Bytes are split at the same six bytes
    that end a word here."""
    return [hashlib.sha256(b" ".join((t or b"").split())).digest() for t in column.cast(pa.binary()).to_pylist()]


def _emit(bins: int, width: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"))
                ids = part.column("doc_id").fill_null(0).to_numpy().astype(np.int64)
                known = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                digests = _digests(part.column("text"))
                begin, place, seeds = _minimizers(words.hashes(), words.first, width)
                place = np.unique(place)
                doc = np.searchsorted(words.first, place, "right") - 1
                place, doc = place[known[doc]], doc[known[doc]]
                chunk = int(mixed(np.array([ids.sum()]).view(np.uint64))[0] >> np.uint64(33))
                yield sharedkeys.pack(seeds[place], ids[doc], place - words.first[doc], bins, chunk)
                counts = np.diff(words.first)
                info = np.rec.fromarrays(
                    [counts.astype(np.int64), part.column("text_hash").to_numpy(), known.astype(np.int64)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk % bins], pa.int32()),
                        pa.array([_DOC], pa.int32()),
                        pa.array([ids.tobytes()]),
                        pa.array([info.tobytes()]),
                        pa.array([b"".join(digests)]),
                    ],
                    names=["bin", "kind", "keys", "owners", "extras"],
                )

    return emit


_FOUND = "kind int, a long, b long, c long, blob binary"


def _seen_twice(frequent: int):
    def seen(table: pa.Table) -> pa.Table:
        """Documents as they are, shared minimizers by document, and frequent minimizers."""
        kinds, a, b, c, blobs = [], [], [], [], []

        def put(kind: int, x: list, y: list, z: list, blob: list) -> None:
            kinds.extend([kind] * len(x))
            a.extend(x), b.extend(y), c.extend(z), blobs.extend(blob)

        for row in table.filter(pa.compute.equal(table["kind"], _DOC)).to_pylist():
            ids = np.frombuffer(row["keys"], np.int64)
            info = np.frombuffer(row["owners"], np.int64).reshape(-1, 3)
            ids = [int(i) if k else None for i, k in zip(ids, info[:, 2])]
            digests = [row["extras"][i : i + 32] for i in range(0, len(row["extras"]), 32)]
            put(_DOC, ids, info[:, 0].tolist(), info[:, 1].tolist(), digests)
        for i, (keys, owners, extras, fresh) in enumerate(sharedkeys.bin_groups(table)):
            starts, ends = sharedkeys.runs(keys)
            if i == 0:
                weight = np.add.reduceat(np.where(fresh, 1, extras), starts) if len(starts) else starts
                often = weight >= frequent
                keys_of = keys[starts[often]].view(np.int64).tolist()
                put(_FREQUENT, keys_of, weight[often].tolist(), keys_of, [None] * len(keys_of))
            keys, owners, extras = keys[fresh], owners[fresh], extras[fresh]
            order = np.argsort(owners, kind="stable")
            owners, extras = owners[order], extras[order]
            for s, e in zip(*sharedkeys.runs(owners)):
                put(_HIT, [int(owners[s])], [0], [0], [np.unique(extras[s:e]).tobytes()])
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table(
            [pa.array(x, t) for x, t in zip((kinds, a, b, c, blobs), types)], names=["kind", "a", "b", "c", "blob"]
        )

    return seen


def _told(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of each segment's words with their places in it, some segments at a time."""
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(low), 4096):
        a, size = low[at : at + 4096], (high - low)[at : at + 4096]
        begins = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begins, size)
        each = mixed(hashes[np.repeat(a, size) + place] + place.astype(np.uint64))
        out.append(mixed(np.add.reduceat(each, begins) + size.astype(np.uint64)))
    return np.concatenate(out)


_NO_KEYS = np.zeros(0, np.int64)


def _segments(width: int, often: np.ndarray = _NO_KEYS):
    """Segments of each chunk as ``key, doc_id, start, length, words``. Those with a minimizer
    in ``often`` are cut into windows, and a window's key is a hash of its words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"))
                ids = part.column("doc_id").to_numpy().astype(np.int64)
                hashes = words.hashes()
                begin, place, seeds = _minimizers(hashes, words.first, width)
                shared = np.zeros(len(hashes) + 1, bool)
                for d, lists in enumerate(part.column("places").to_pylist()):
                    for blob in lists:
                        at = np.frombuffer(blob, np.int32) + words.first[d]
                        shared[at[at < words.first[d + 1]]] = True
                good = shared[place]
                begin, place = begin[good], place[good]
                doc = np.searchsorted(words.first, begin, "right") - 1
                new = np.ones(len(begin), bool)
                new[1:] = (begin[1:] != begin[:-1] + 1) | (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(begin)) - 1
                low, high, owner = begin[head], begin[tail] + width, ids[doc[head]]
                keys = seeds[place[head]].view(np.int64)
                split = np.isin(keys, often)
                if split.any():
                    a, size = low[split], (high - low)[split] - width + 1
                    each = np.repeat(a - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                    low, high = np.concatenate([low[~split], each]), np.concatenate([high[~split], each + width])
                    keys, owner = keys[~split], np.concatenate([owner[~split], np.repeat(owner[split], size)])
                first = words.first[np.searchsorted(words.first, low, "right") - 1]
                # Equal segments of this chunk: the smallest document's is sent, the others are
                # repeats of it. They are told by a hash of all their words, each with its place.
                same = _told(hashes, low, high)
                keys = np.concatenate([keys, same[len(keys) :].view(np.int64)])
                order = np.lexsort((owner, same))
                sent = np.ones(len(order), bool)
                sent[order[1:]] = same[order[1:]] != same[order[:-1]]
                least = np.zeros(len(order), np.int64)
                starts, ends = sharedkeys.runs(same[order])
                least[order] = np.repeat(owner[order[starts]], ends - starts) if len(starts) else least[order]
                sent |= least == owner  # a document's own repeats are judged like the first
                blobs = [
                    words.data[words.starts[s] : words.ends[e - 1]].tobytes() if keep else None
                    for s, e, keep in zip(low.tolist(), high.tolist(), sent.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys),
                        pa.array(owner),
                        pa.array(low - first, pa.int32()),
                        pa.array(high - low, pa.int32()),
                        pa.array(blobs, pa.binary()).cast(pa.string()),
                    ],
                    names=["key", "doc_id", "start", "length", "words"],
                )

    return cut


#: Segments of one chunk that go to one shard: documents, places in them, places of each
#: segment, bytes of each and all their bytes. Without bytes: intervals that are repeats.
_DEALT = "shard int, docs binary, starts binary, places binary, sizes binary, words binary"
_DEALT_NAMES = ["shard", "docs", "starts", "places", "sizes", "words"]


def _intervals(owner: np.ndarray, start: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each owner in order, those that touch or overlap as one."""
    order = np.lexsort((start, owner))
    owner, start, until = owner[order], start[order], until[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > until[:-1])
    head = np.flatnonzero(new)
    return owner[head], start[head], np.maximum.reduceat(until, head) if len(head) else until


def _dealt(width: int, shards: int, often: np.ndarray):
    cut = _segments(width, often)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cut(batches):
            shard = (mixed(part.column("key").to_numpy().view(np.uint64)) % np.uint64(shards)).astype(np.int32)
            ids, start = part.column("doc_id").to_numpy(), part.column("start").to_numpy().astype(np.int32)
            sent = part.column("words").is_valid().to_numpy(zero_copy_only=False)
            rows = []
            if not sent.all():
                length = part.column("length").to_numpy()
                a, b, c = _intervals(ids[~sent], start[~sent], (start + length)[~sent])
                rows.append((int(mixed(ids[:1].view(np.uint64))[0] % np.uint64(shards)), a.tobytes(), b.tobytes(), None, c.tobytes(), None))
            at = np.flatnonzero(sent)
            if len(at):
                # Equal segments are of one document here, and of one shard.
                text = part.column("words").cast(pa.binary()).take(pa.array(at)).dictionary_encode()
                code = text.indices.to_numpy()
                order = np.lexsort((ids[at], code, shard[at]))
                at, code = at[order], code[order]
                new = np.ones(len(at), bool)
                new[1:] = (code[1:] != code[:-1]) | (ids[at[1:]] != ids[at[:-1]]) | (shard[at[1:]] != shard[at[:-1]])
                head = np.flatnonzero(new)
                column = text.dictionary.take(pa.array(code[head]))
                offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
                sizes, places = np.diff(offsets), np.diff(np.append(head, len(at))).astype(np.int32)
                begins = np.append(head, len(at))
                for a, b in zip(*sharedkeys.runs(shard[at[head]])):
                    blob = column.buffers()[2].slice(int(offsets[a]), int(offsets[b] - offsets[a])).to_pybytes()
                    starts = start[at[begins[a] : begins[b]]]
                    rows.append(
                        (int(shard[at[head[a]]]), ids[at[head[a:b]]].tobytes(), starts.tobytes(), places[a:b].tobytes(), sizes[a:b].tobytes(), blob)
                    )
            types = [pa.int32()] + [pa.binary()] * 5
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_DEALT_NAMES)

    return deal


def _judge(width: int):
    def judge(table: pa.Table) -> pa.Table:
        """Intervals ``(doc_id, start, until)`` of one shard."""
        sent = table["words"].is_valid()
        read = lambda rows, name, dtype: np.frombuffer(b"".join(rows[name].to_pylist()), dtype)
        told = table.filter(pa.compute.invert(sent))
        table = table.filter(sent)
        out = [(read(told, "docs", np.int64), read(told, "starts", np.int32), read(told, "sizes", np.int32))]
        if table.num_rows:
            docs, start = read(table, "docs", np.int64), read(table, "starts", np.int32)
            places = read(table, "places", np.int32)
            offsets = np.concatenate([[0], np.cumsum(read(table, "sizes", np.int32), dtype=np.int64)])
            data = pa.py_buffer(b"".join(table["words"].to_pylist()))
            del table
            column = pa.Array.from_buffers(pa.large_binary(), len(docs), [None, pa.py_buffer(offsets), data])
            text = column.dictionary_encode()
            code = np.repeat(text.indices.to_numpy(), places)
            docs = np.repeat(docs, places)
            words = Words(text.dictionary)
            del column, text, data, offsets
            # Each distinct segment is indexed once, under its smallest document.
            order = np.lexsort((docs, code))
            docs, start, code = docs[order], start[order], code[order]
            begins = sharedkeys.runs(code)[0]
            least = docs[begins]
            values, symbols = np.unique(words.hashes(), return_inverse=True)
            symbols = symbols.astype(np.int64) + 1
            starts, lengths = words.first[:-1], np.diff(words.first)
            del words
            owners = np.unique(least, return_inverse=True)[1]
            index = FMIndex(symbols, lengths, owners, len(values) + 1)
            found, begin = repeated_windows(index, symbols, starts, lengths, owners, width)
            del index
            # What was found holds at each place in the smallest document; others repeat it all.
            own = docs == least[code]
            out.append((docs[~own], start[~own], start[~own] + lengths[code[~own]]))
            found, begin, until = _intervals(found, begin, begin + width)
            times = np.bincount(code[own], minlength=len(least))[found]
            at = np.repeat(begins[found] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
            out.append((docs[at], start[at] + np.repeat(begin, times), start[at] + np.repeat(until, times)))
        doc_id, start, until = _intervals(*(np.concatenate(x) for x in zip(*out)))
        return pa.table([pa.array(doc_id, pa.int64()), pa.array(start, pa.int32()), pa.array(until, pa.int32())], names=["doc_id", "start", "until"])

    return judge


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed = [], []
        for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
            words = (text or b"").split()
            stay = np.ones(len(words), bool)
            for span in spans:
                stay[span["start"] : span["until"]] = False
            kept.append(b" ".join(w for w, s in zip(words, stay.tolist()) if s))
            removed.append(int(len(words) - stay.sum()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "text_hash", "n_removed", "kept"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"))


def repeats(docs: DataFrame, width: int = WIDTH, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """All documents as ``(doc_id, n_words, text_hash, sha256)`` of their words joined by one
    space, and those that lose words as ``(doc_id, text_hash, n_removed, kept)``.

    A null text has no words. Texts shorter than a window lose nothing. A document's own
    repeats don't count, nor do those of rows with one doc_id among each other; rows without
    doc_id neither lose words nor make others lose them. Of a repeated doc_id each text is
    judged by itself.
    """
    spark = docs.sparkSession
    texts = _keyed(docs)
    bins = sharedkeys.bins_for(texts)
    packed = texts.mapInArrow(tidy(_emit(bins, width)), sharedkeys.SCHEMA)
    found = freeze(sharedkeys.in_bins(packed, _seen_twice(frequent), _FOUND), "minimizers")
    rows = found.filter(F.col("kind") == _DOC).select(
        F.col("a").alias("doc_id"), F.col("b").alias("n_words"), F.col("c").alias("text_hash"), F.lower(F.hex("blob")).alias("sha256")
    )
    places = freeze(
        found.filter(F.col("kind") == _HIT).groupBy(F.col("a").alias("doc_id")).agg(F.collect_list("blob").alias("places")),
        "places",
    )
    with bloom_joins(spark):
        likely = freeze(texts.join(places.filter(F.size("places") > 0), "doc_id"), "likely")
    often = freeze(
        found.filter(F.col("kind") == _FREQUENT).select(F.col("a").alias("key"), F.col("b").alias("weight")),
        "frequent",
    )
    # A window sent by itself is ``width`` words, so those shards are counted by what is sent.
    windows_sent = (often.agg(F.sum("weight")).first()[0] or 0) * (width - SEED + 1)
    shards = bins + windows_sent * width * WORD_BYTES // sharedkeys.BYTES_PER_BIN
    # At most one key for ``frequent`` words of input, so few that each task can have them all.
    keys = np.array([r["key"] for r in often.select("key").collect()], np.int64)
    segments = likely.mapInArrow(tidy(_dealt(width, shards, keys)), _DEALT)
    spans = segments.groupBy("shard").applyInArrow(tidy_group(_judge(width)), "doc_id long, start int, until int")
    by_doc = freeze(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "until")).alias("spans")), "spans")
    cut = likely.select("doc_id", "text", "text_hash").join(by_doc, "doc_id").mapInArrow(
        tidy(_cut_out), "doc_id long, text_hash long, n_removed long, kept string"
    )
    return rows, cut


def repeat_digest(docs: DataFrame, width: int = WIDTH, frequent: int = FREQUENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256``."""
    with frozen_scope(docs.sparkSession) as scope:
        rows, cut = repeats(docs, width, frequent)
        rows = freeze(rows, "documents")
        lost = cut.select(
            F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
        ).distinct()
        lost = freeze(lost, "lost")
        scope.keep(rows, lost)
    return rows.join(lost, (F.col("doc_id") == F.col("d")) & (F.col("text_hash") == F.col("h")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, width: int = WIDTH, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and ``n_chars`` to match if there
    is such a column. Texts that lose nothing stay as they are; a text that loses words is
    its kept words joined by one space. No row is dropped."""
    with frozen_scope(docs.sparkSession) as scope:
        _, cut = repeats(docs, width, frequent)
        lost = freeze(
            cut.filter("n_removed > 0").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("kept").alias("_kept")).distinct(),
            "lost",
        )
        scope.keep(lost)
    same = (F.col("doc_id") == F.col("_d")) & (F.xxhash64("text") == F.col("_h"))
    joined = packed(docs, "doc_id", "text").join(lost, same, "left")
    changed = F.col(ROW).withField("text", F.coalesce("_kept", "text"))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("_kept").isNotNull(), F.length("_kept").cast("long")).otherwise(F.col(f"{ROW}.n_chars"))
        changed = changed.withField("n_chars", n_chars)
    return joined.select(changed.alias(ROW)).select(f"{ROW}.*")
