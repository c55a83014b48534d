"""Words and word n-gram hashes of Arrow text columns, vectorised over whole batches.

A word is a run of bytes other than space and 0x09-0x0D.  Hashes are 64-bit; two
different words (or n-grams) share one with a chance of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text is worked on in slices of about this many bytes, always whole documents.
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _byte_table(lower: bool) -> np.ndarray:
    b = np.arange(256)
    if lower:
        b = np.where((b >= 65) & (b <= 90), b + 32, b)
    table = mix(b.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    table[[9, 10, 11, 12, 13, 32]] = 0  # separators add nothing to a word's sum
    return table


def text_array(column: pa.Array) -> pa.Array:
    """A plain string array without nulls (null text counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and each text's bounds in them."""
    column = text_array(column)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole documents of about ``limit`` bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    first: np.ndarray  # word bounds of each document
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def room(self) -> np.ndarray:
        """Words from each word to the end of its document, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hashes))

    @property
    def index(self) -> np.ndarray:
        """Position of each word in its document."""
        return np.arange(len(self.hashes)) - np.repeat(self.first[:-1], self.counts)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each position; only valid where ``room >= k``."""
        return mix(window_hash(self.hashes, k))


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """sum h[i+j] * B**(k-1-j) over j < k for each i, zero-padded, by doubling."""
    base = np.uint64(0x9FB21C651E98DF25)
    out, size = np.zeros_like(h), 0
    block, width, scale = h, 1, base
    with np.errstate(over="ignore"):
        while k:
            if k & 1:  # append `block` behind what is there
                tail = np.zeros_like(h)
                there = max(0, len(h) - size)
                tail[:there] = block[size : size + there]
                out, size = out * scale + tail, size + width
            k >>= 1
            if k:
                ahead = np.zeros_like(h)
                ahead[: max(0, len(h) - width)] = block[width:]
                block, width, scale = block * scale + ahead, 2 * width, scale * scale
    return out


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, bounds = raw_text(column)
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(data, z, z, np.zeros(len(bounds), np.int64), np.zeros(0, np.uint64))
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    solid = ~space[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    edge = bounds[:-1][bounds[:-1] < n]
    begin[edge] = solid[edge]  # a word never crosses documents
    starts = np.flatnonzero(begin)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return Words(data, z, z, np.zeros(len(bounds), np.int64), np.zeros(0, np.uint64))
    span = np.diff(np.append(starts, n))
    # bytes of each stretch that belong to its word (the rest are separators)
    length = np.add.reduceat(solid.astype(np.int32), starts).astype(np.int64)
    within = np.arange(starts[0], n) - np.repeat(starts, span)
    power = np.full(int(within.max()) + 1, 0x2127599BF4325C37, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    terms = _byte_table(lower)[data[starts[0] :]] * power[within]
    hashes = mix(np.add.reduceat(terms, starts - starts[0]) + length.astype(np.uint64))
    return Words(data, starts, starts + length, np.searchsorted(starts, bounds), hashes)


def pack(bucket: np.ndarray, **columns: np.ndarray) -> Iterator[tuple[int, dict[str, bytes]]]:
    """Columns of one batch, sorted by bucket and cut into one set of byte strings each."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
    cols = {k: v[order] for k, v in columns.items()}
    for lo, hi in zip(at, np.append(at[1:], len(bucket))):
        yield int(bucket[lo]), {k: v[lo:hi].tobytes() for k, v in cols.items()}


def unpack(table: pa.Table, column: str, kind) -> np.ndarray:
    """All byte strings of a column as one array."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in table.column(column)]
    return np.concatenate(parts) if parts else np.zeros(0, kind)
