"""Packing of token documents into fixed windows by sum-of-squares online placement.

Each task reads its documents in turn and keeps a level array: how many of its open
windows are filled to each level.  A document of n tokens first fills n // size windows
of its own; its rest r goes to the level h, or to a new window, for which the sum of the
squared counts over all levels grows least (ties: the fuller window).  Only levels of
open windows are in that sum, so a placement that fills a window up lowers it.  A window
is given out as soon as it is full.

At the end of a task, or when it has more than ``max_open`` open windows (whose ids are
all that it keeps, 4 * size bytes each), the open windows are emptied one after another
into full windows, and what is left over is cut into windows whose fill is a power of two.
So nothing is padded, and no task holds more than ``max_open`` windows however the lengths
fall.  No row moves: tasks pack what they read.

Ids: words between ASCII blanks are encoded once for each slice of text.  The vocabulary
must drop white space and split at it (true of files with a white-space-free splitter such
as ``word_bpe_49k.json``); ``encoded`` is compared with whole texts in the tests.

Null and empty texts are the end id alone; null ids and repeated rows are packed like any
others; an empty table gives no rows; columns other than id and text are not read.  A word
is encoded whole: a text of one long word needs the tokenizer's memory for it.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.llm.common import read
from tilescope.llm.textkit import slices, text_array

WINDOW = 2048
END_ID = 1
MAX_OPEN = 4096
SLICE = 32 << 20
CHUNK = 2000
DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
KINDS = pa.schema([(f.split()[0], pa.int64()) for f in DDL.split(", ")])


class Packer:
    """Sum-of-squares placement; ``rows`` collects the pieces of the closed windows."""

    def __init__(self, size: int = WINDOW, first: int = 0, max_open: int = MAX_OPEN):
        self.size, self.max_open, self.next = size, max_open, first
        self.counts = np.zeros(size, np.int64)  # open windows by level; level 0 stays empty
        self.open = defaultdict(list)  # level -> windows, each a list of pieces
        self.left = 0
        self.rows: list[tuple] = []

    def level(self, rest: int) -> int:
        """The level (0: a new window) whose use by ``rest`` ids raises the sum of squares least."""
        top = self.size - rest
        grown = 2 * self.counts[rest:] + 1  # one more window at levels rest .. size - 1
        shrunk = 1 - 2 * self.counts[: top + 1]  # one less at levels 0 .. top
        shrunk[0] = 0
        cost = np.append(grown, 0) + shrunk  # a full window leaves the sum
        usable = self.counts[: top + 1] > 0
        usable[0] = True
        cost = np.where(usable, cost, np.iinfo(np.int64).max)
        return int(top - np.argmin(cost[::-1]))

    def close(self, window: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.size
        for start in range(0, whole, self.size):
            self.close([(doc, start, ids[start : start + self.size], total)])
        rest = total - whole
        if not rest:
            return
        h = self.level(rest)
        window = self.open[h].pop() if h else []
        if h:
            self.counts[h] -= 1
        window.append((doc, whole, ids[whole:].copy(), total))
        if h + rest == self.size:
            self.close(window)
            self.left -= h > 0
            return
        self.open[h + rest].append(window)
        self.counts[h + rest] += 1
        self.left += h == 0
        if self.left > self.max_open:
            self.flush()

    def flush(self) -> None:
        """Empty all open windows into full ones, then into powers of two."""
        windows = [w for h in sorted(self.open, reverse=True) for w in self.open[h]]
        ahead = sum(len(p[2]) for w in windows for p in w)
        now, room = [], 0
        for doc, start, ids, total in (p for w in windows for p in w):
            while len(ids):
                if not room:
                    room = self.size if ahead >= self.size else 1 << (ahead.bit_length() - 1)
                    ahead -= room
                take = min(room, len(ids))
                now.append((doc, start, ids[:take], total))
                start, ids, room = start + take, ids[take:], room - take
                if not room:
                    self.close(now)
                    now = []
        self.counts[:], self.left = 0, 0
        self.open.clear()

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * len(KINDS)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=KINDS)


def _word_ids(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and the number of ids of each."""
    ids, counts = [], np.zeros(len(words), np.int64)
    at = 0
    while at < len(words):
        to, room = at, CHUNK
        while to < len(words) and (to == at or room >= len(words[to])):
            room -= len(words[to]) + 1
            to += 1
        found = tokenizer.encode(" ".join(words[at:to]), add_special_tokens=False)
        if found.ids:
            starts = np.cumsum([0, *(len(w) + 1 for w in words[at : to - 1])])
            owner = np.searchsorted(starts, np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids)), "right") - 1
            counts[at:to] = np.bincount(owner, minlength=to - at)
            ids.append(np.array(found.ids, "<u4"))
        at = to
    return (np.concatenate(ids) if ids else np.zeros(0, "<u4")), counts


def encoded(tokenizer, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, each text's end id behind it, and the bounds of the texts."""
    split = pc.ascii_split_whitespace(text_array(texts))
    seen = split.flatten().dictionary_encode()
    ids, counts = _word_ids(tokenizer, seen.dictionary.to_pylist())
    ids, counts = np.append(ids, np.uint32(end_id)).astype("<u4"), np.append(counts, 1)
    first = np.cumsum(counts) - counts
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = np.insert(seen.indices.to_numpy(zero_copy_only=False).astype(np.int32), ends, len(counts) - 1)
    n = counts[words]
    behind = np.cumsum(n)
    out = ids[np.repeat(first[words] - behind + n, n) + np.arange(behind[-1] if len(n) else 0)]
    return out, np.append(0, behind[ends + np.arange(len(ends))])


def packed(
    docs: DataFrame,
    vocabulary: str,
    size: int = WINDOW,
    end_id: int = END_ID,
    max_open: int = MAX_OPEN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each piece of a document; ``vocabulary`` is the path of a tokenizer file on the driver."""
    body = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(body.value)
        packer = Packer(size, TaskContext.get().partitionId() << 32, max_open)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids, bounds = encoded(tokenizer, part.column("text"), end_id)
                for doc, a, b in zip(part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:]):
                    packer.add(doc, ids[a:b])
                yield packer.taken()
        packer.flush()
        yield packer.taken()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(place, DDL)


def op11_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
