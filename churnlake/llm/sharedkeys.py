"""Keys that several owners share, found with one packed shuffle.

Tasks emit 64-bit keys with the id of their owner. Keys are dealt into bins by value, packed
as byte columns, and each bin looks for keys of two owners or more. A key that is already
shared inside one task's chunk is settled there: its entries go to a bin by chunk, and the
key's own bin only hears that the key is shared. So a key that a third of all owners have
reaches its bin once per chunk of input, not once per owner.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.words import mixed, tidy_group

SCHEMA = "bin int, kind int, keys binary, owners binary, extras binary"
_NAMES = ["bin", "kind", "keys", "owners", "extras"]
#: Kinds of packed rows: entries to be judged by the bin, entries of shared keys, shared keys.
ENTRY, SETTLED, SHARED = 0, 1, 2
#: Bytes of text for each bin: a million keys or two.
BYTES_PER_BIN = 14 << 20


def bins_for(docs: DataFrame, column: str = "text") -> int:
    """Bins in proportion to the text of the input."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(12, total // BYTES_PER_BIN)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal values of a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.append(starts[1:], len(keys))


def _shared(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For entries sorted by key and owner: does the key have another owner?"""
    starts, ends = runs(keys)
    return np.repeat(owners[starts] != owners[ends - 1], ends - starts)


def _packed(bins: np.ndarray, kind: int, keys: np.ndarray, owners: np.ndarray, extras: np.ndarray) -> list[tuple]:
    order = np.argsort(bins, kind="stable")
    bins, keys, owners, extras = bins[order], keys[order], owners[order], extras[order]
    return [
        (int(bins[a]), kind, keys[a:b].tobytes(), owners[a:b].tobytes(), extras[a:b].tobytes())
        for a, b in zip(*runs(bins))
    ]


def pack(keys: np.ndarray, owners: np.ndarray, extras: np.ndarray, bins: int, chunk: int) -> pa.RecordBatch:
    """One chunk's entries as packed rows. ``chunk`` is any number that varies by chunk."""
    keys, owners, extras = keys.astype(np.uint64), owners.astype(np.int64), extras.astype(np.int32)
    order = np.lexsort((owners, keys))
    keys, owners, extras = keys[order], owners[order], extras[order]
    # The bin comes from mixed bits, as keys may have structure.
    home = (mixed(keys) % np.uint64(bins)).astype(np.int32)
    settled = _shared(keys, owners)
    rows = _packed(home[~settled], ENTRY, keys[~settled], owners[~settled], extras[~settled])
    if settled.any():
        k, o, e = keys[settled], owners[settled], extras[settled]
        starts, ends = runs(k)
        rows += _packed(home[settled][starts], SHARED, k[starts], o[starts], (ends - starts).astype(np.int32))
        rows.append((chunk % bins, SETTLED, k.tobytes(), o.tobytes(), e.tobytes()))
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def _joined(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = table.filter(pa.compute.equal(table["kind"], kind))
    read = lambda name, dtype: np.frombuffer(b"".join(rows[name].to_pylist()), dtype)
    return read("keys", np.uint64), read("owners", np.int64), read("extras", np.int32)


def bin_groups(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Shared keys of one bin as ``keys, owners, extras, fresh``, sorted by key and owner:
    first the bin's own, then the settled ones of each chunk. An entry of the bin's own that
    is not fresh stands for the settled entries of a chunk and is one of them; its extra is
    their number."""
    keys, owners, extras = _joined(table, ENTRY)
    fresh = np.ones(len(keys), bool)
    told = _joined(table, SHARED)
    keys, owners, extras = (np.concatenate(x) for x in zip((keys, owners, extras), told))
    fresh = np.concatenate([fresh, np.zeros(len(told[0]), bool)])
    order = np.lexsort((owners, keys))
    keys, owners, extras, fresh = keys[order], owners[order], extras[order], fresh[order]
    starts, ends = runs(keys)
    pick = _shared(keys, owners)
    if len(starts):
        pick |= np.repeat(~np.logical_and.reduceat(fresh, starts), ends - starts)
    yield keys[pick], owners[pick], extras[pick], fresh[pick]
    settled = table.filter(pa.compute.equal(table["kind"], SETTLED))
    for row in settled.select(["keys", "owners", "extras"]).to_pylist():
        keys = np.frombuffer(row["keys"], np.uint64)
        owners, extras = np.frombuffer(row["owners"], np.int64), np.frombuffer(row["extras"], np.int32)
        yield keys, owners, extras, np.ones(len(keys), bool)


def in_bins(packed: DataFrame, each: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return packed.groupBy("bin").applyInArrow(tidy_group(each), schema)
