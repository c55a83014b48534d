"""Removal of word sequences that also start in a document with a smaller id.

Two operators find the candidates, each by its own method, and share what follows.
``k`` words in a row are a window; a word goes if a window covers it whose word
sequence also starts in a document with a smaller id.  All windows are judged on the
input.  Runs of such windows are maximal exact repeats.

* ``fixed_block_anchors`` indexes the non-overlapping blocks of ``b`` words of every
  document, with k >= 2b - 1, so that every window holds one whole block of its
  document.  A window occurs elsewhere only if one of its b-word windows (every
  position of every document is probed) is an indexed block of the other document.
* ``sparse_suffixes`` keeps the suffixes that start at minimisers: of each window of k
  words, the leftmost position with the smallest hash of ``b`` words.  Equal windows
  have the same minimiser at the same offset, so a window occurs elsewhere only if its
  suffix's first b words are retained elsewhere too.  Suffixes that pass are sorted
  with their left context, neighbours are compared, and matches grow left and right.

Either index is counted exactly by Spark (hashes meet by bucket) and then becomes a
Bloom filter of a fixed size, the only thing that is broadcast.  The filter only saves
work: a full one passes more windows on, and the windows that pass are compared
exactly, sorted by 64-bit hash and id, in buckets whose number grows with the input.

Copies of a text are taken once: the first copy decides what its words bring to
others, and every copy with a larger id goes whole if it has k words.  Null text is
empty; a null id is neither smaller nor larger than any, so such rows lose nothing;
repeated rows get equal results; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.llm.common import read, unused, widened
from tilescope.llm.textkit import Words, mix, pack, slices, text_array, unpack, words_of

FILTER_BITS = 28  # log2 of the filter's size in bits: 32 MB
FEWER_BITS = 2  # the filter of hashes that occur twice is so much smaller
PROBES = 3
BUCKET_BYTES = 24 << 20  # input bytes of text for each bucket of hashes
FLUSH = 1_000_000  # rows a task gathers before it hands them on


class Filter:
    """A Bloom filter in segments, one a bucket of hashes."""

    def __init__(self, words: np.ndarray, bits: int):
        self.bits = bits
        self.words = words

    @staticmethod
    def positions(h: np.ndarray, segment_bits: int) -> Iterator[np.ndarray]:
        step = mix(h) | np.uint64(1)
        low = np.uint64((1 << segment_bits) - 1)
        for i in range(PROBES):
            yield (h + np.uint64(i) * step) & low

    @staticmethod
    def segment(h: np.ndarray, segment_bits: int) -> np.ndarray:
        seen = np.zeros(1 << segment_bits, bool)
        for p in Filter.positions(h, segment_bits):
            seen[p] = True
        return np.packbits(seen, bitorder="little")

    def hold(self, h: np.ndarray, bucket_bits: int) -> np.ndarray:
        inner = self.bits - bucket_bits
        base = (h >> np.uint64(64 - bucket_bits)) << np.uint64(inner) if bucket_bits else np.zeros_like(h)
        out = np.ones(len(h), bool)
        todo = np.arange(len(h))
        for p in self.positions(h, inner):
            at = base[todo] + p[todo]
            hit = (self.words[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
            out[todo[~hit]] = False
            todo = todo[hit]
        return out


def bucket_bits_for(docs: DataFrame, text: str) -> int:
    """log2 of the number of buckets, from the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return int(min(14, max(3, (size // BUCKET_BYTES).bit_length())))


def _with_keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("id"),
        body.alias("text"),
        F.xxhash64(body).alias("k1"),
        F.xxhash64(F.lit("2"), body).alias("k2"),
    )


def _fresh(batch: pa.RecordBatch, seen: dict) -> pa.RecordBatch:
    """Rows whose text this task has not met yet under an id as small."""
    ids, a, b = (batch.column(c).to_pylist() for c in ("id", "k1", "k2"))
    keep = np.zeros(len(ids), bool)
    for i, (d, key) in enumerate(zip(ids, zip(a, b))):
        if d is not None and d < seen.get(key, d + 1):
            seen[key] = d
            keep[i] = True
    return batch.filter(pa.array(keep))


def index_filter(
    keyed: DataFrame, marks: Callable[[Words], np.ndarray], gram: int, bits: int, once: bool
) -> list[tuple[np.ndarray, int]]:
    """Arguments of the filters of the ``gram``-word hashes at the marked positions.

    The second holds those that are marked in two documents or more; the first (only if
    ``once``) all of them.
    """
    inner = FILTER_BITS - bits

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            for part in slices(_fresh(batch, seen)):
                w = words_of(part.column("text"))
                at = marks(w)
                h, doc = w.grams(gram)[at], w.doc[at]
                # once for each document
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h = h[new]
                rows = list(pack(_bucket(h, bits), h=h))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in rows], pa.int32()), pa.array([c["h"] for _, c in rows], pa.binary())], names=["bucket", "h"]
                )

    def build(table: pa.Table) -> pa.Table:
        h, n = np.unique(unpack(table, "h", np.uint64), return_counts=True)
        first = Filter.segment(h, inner).tobytes() if once else b""
        twice = Filter.segment(h[n > 1], inner - FEWER_BITS).tobytes()
        return pa.table({"bucket": table.column("bucket").combine_chunks()[:1], "a": [first], "b": [twice]})

    hashes = keyed.mapInArrow(emit, "bucket int, h binary")
    rows = hashes.groupBy("bucket").applyInArrow(build, "bucket int, a binary, b binary").collect()  # a fixed size
    by = {r.bucket: r for r in rows}
    out = []
    for name, size in (("a", inner), ("b", inner - FEWER_BITS)) if once else (("b", inner - FEWER_BITS),):
        empty = np.zeros((1 << size) // 8, np.uint8)
        segments = [np.frombuffer(by[k][name], np.uint8) if k in by else empty for k in range(1 << bits)]
        out.append((np.concatenate(segments), size + bits))
    return out


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int32)


def window_any(hit: np.ndarray, width: int) -> np.ndarray:
    """For each i, whether any of hit[i : i + width] is set."""
    total = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
    to = np.minimum(np.arange(len(hit)) + width, len(hit))
    return total[to] > total[: len(hit)]


def minimisers(w: Words, k: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the k-word windows, and the leftmost position in each of the least gram-word hash."""
    starts = np.flatnonzero(w.room >= k)
    span = k - gram + 1
    h = w.grams(gram)
    at = np.arange(len(h))
    width = 1
    while width < span:  # leftmost least over doubling spans; spans overlap to end at the full one
        step = min(width, span - width)
        other = np.append(at[step:], at[len(at) - min(step, len(at)) :])[: len(at)]
        at = np.where(h[other] < h[at], other, at)
        width += step
    return starts, at[starts]


def repeated_windows(keyed: DataFrame, k: int, bits: int, pick: Callable[[Words], np.ndarray]) -> DataFrame:
    """(id, k1, at): starts of windows that also start in a document with a smaller id, packed by document.

    ``pick`` gives the starts that may be such; they are compared exactly here.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        held, size = [], 0

        def flush():
            h, i, key, at = (np.concatenate(c) for c in zip(*held))
            rows = list(pack(_bucket(h, bits), h=h, id=i, k1=key, at=at))
            held.clear()
            cols = [pa.array([c[n] for _, c in rows], pa.binary()) for n in ("h", "id", "k1", "at")]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *cols], names=["bucket", "h", "id", "k1", "at"])

        for batch in batches:
            for part in slices(_fresh(batch, seen)):
                w = words_of(part.column("text"))
                at = pick(w)
                if len(at):
                    doc = w.doc[at]
                    ids = part.column("id").to_numpy(zero_copy_only=False).astype(np.int64)[doc]
                    keys = part.column("k1").to_numpy(zero_copy_only=False).astype(np.int64)[doc]
                    held.append((w.grams(k)[at], ids, keys, w.index[at].astype(np.uint32)))
                    size += len(at)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    def compare(table: pa.Table) -> pa.Table:
        h, ids = unpack(table, "h", np.uint64), unpack(table, "id", np.int64)
        k1, at = unpack(table, "k1", np.int64), unpack(table, "at", np.uint32)
        order = np.lexsort((ids, h))
        sorted_h = h[order]
        new = np.ones(len(h), bool)
        new[1:] = sorted_h[1:] != sorted_h[:-1]
        first = ids[order][np.flatnonzero(new)[np.cumsum(new) - 1]]  # the least id of each run of equal windows
        go = order[ids[order] > first]
        ids, k1, at = ids[go], k1[go], at[go]
        rows = list(pack(_bucket(mix(k1.view(np.uint64)), bits), id=ids, k1=k1, at=at))
        cols = [pa.array([c[n] for _, c in rows], pa.binary()) for n in ("id", "k1", "at")]
        return pa.Table.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *cols], names=["part", "id", "k1", "at"])

    def gather(table: pa.Table) -> pa.Table:
        ids, k1, at = unpack(table, "id", np.int64), unpack(table, "k1", np.int64), unpack(table, "at", np.uint32)
        order = np.lexsort((at, k1, ids))
        ids, k1, at = ids[order], k1[order], at[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (k1[1:] != k1[:-1])
        lo = np.flatnonzero(new)
        blobs = [x.tobytes() for x in np.split(at, lo[1:])] if len(lo) else []
        return pa.table({"id": ids[lo], "k1": k1[lo], "at": pa.array(blobs, pa.binary())})

    rows = keyed.mapInArrow(emit, "bucket int, h binary, id binary, k1 binary, at binary")
    met = rows.groupBy("bucket").applyInArrow(compare, "part int, id binary, k1 binary, at binary")
    # by document; its positions come from every bucket
    return met.groupBy("part").applyInArrow(gather, "id long, k1 long, at binary")


def later_copies(keyed: DataFrame) -> DataFrame:
    """(id, k1) of the rows whose whole text stands under a smaller id too."""
    rows = keyed.select("id", "k1", "k2")
    first = rows.groupBy("k1", "k2").agg(F.min("id").alias("_first"), F.max("id").alias("_last")).where("_first < _last")
    first = first.select(F.col("k1").alias("_a"), F.col("k2").alias("_b"), "_first")
    same = (F.col("k1") == F.col("_a")) & (F.col("k2") == F.col("_b")) & (F.col("id") > F.col("_first"))
    return rows.join(first, same).select("id", "k1").distinct()


def without_repeats(docs: DataFrame, windows: DataFrame, keyed: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """``docs`` with kept_text, n_words, n_removed and the removed spans (first word, words)."""
    added = {"kept_text": "string", "n_words": "long", "n_removed": "long", "spans": "array<struct<at:long,words:long>>"}
    base = docs.drop(*added)
    id_, k1_, whole_, at_ = unused(base.columns, "_id", "_k1", "_whole", "_at")
    whole = later_copies(keyed).select("id", "k1", F.lit(True).alias("whole"), F.lit(None).cast("binary").alias("at"))
    marks = windows.select("id", "k1", F.lit(False).alias("whole"), "at").unionByName(whole)
    # two rows a document at most
    marks = marks.groupBy(F.col("id").alias(id_), F.col("k1").alias(k1_)).agg(
        F.max("whole").alias(whole_), F.first("at", ignorenulls=True).alias(at_)
    )
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    joined = base.join(marks, (F.col(doc_id).cast("long") == F.col(id_)) & (body == F.col(k1_)), "left").drop(id_, k1_)
    names = [*base.columns, *added]
    span_type = pa.list_(pa.struct([("at", pa.int64()), ("words", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts, whole, at = text_array(part.column(text)), part.column(whole_), part.column(at_)
                kept_text, n_words, n_removed, spans = [], [], [], []
                for i in range(part.num_rows):
                    words = texts[i].as_buffer().to_pybytes().split()
                    runs: list[tuple[int, int]] = []
                    if whole[i].as_py() and len(words) >= k:
                        runs = [(0, len(words))]
                    elif at[i].is_valid:
                        gone = np.frombuffer(at[i].as_buffer(), np.uint32).astype(np.int64)
                        cuts = np.flatnonzero(np.diff(gone) > k) + 1
                        runs = [(int(x[0]), int(x[-1] - x[0]) + k) for x in np.split(gone, cuts)]
                    left, to = [], 0
                    for a, n in runs:
                        left += words[to:a]
                        to = a + n
                    left += words[to:]
                    kept_text.append(b" ".join(left))
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    spans.append([{"at": a, "words": n} for a, n in runs])
                rest = [c for n, c in zip(part.schema.names, part.columns) if n not in (whole_, at_)]
                new = [
                    pa.array(kept_text, pa.binary()).cast(pa.string()),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(spans, span_type),
                ]
                yield pa.RecordBatch.from_arrays([*rest, *new], names=names)

    schema = widened(base.schema, ", ".join(f"{n} {t}" for n, t in added.items()))
    return joined.mapInArrow(cut, schema)


def fixed_block_anchors(docs: DataFrame, k: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Substring dedup; see the module's text.  Returns what ``without_repeats`` does."""
    block = (k + 1) // 2
    keyed = _with_keys(docs, doc_id, text)
    bits = bucket_bits_for(keyed, "text")

    def blocks(w: Words) -> np.ndarray:
        return np.flatnonzero((w.index % block == 0) & (w.room >= block))

    filters = keyed.sparkSession.sparkContext.broadcast(index_filter(keyed, blocks, block, bits, once=True))

    def pick(w: Words) -> np.ndarray:
        some, twice = (Filter(*f) for f in filters.value)
        h, own = w.grams(block), w.index % block == 0
        hit = np.zeros(len(h), bool)
        for where, f in ((~own, some), (own, twice)):
            at = np.flatnonzero(where & (w.room >= block))
            hit[at] = f.hold(h[at], bits)
        return np.flatnonzero(window_any(hit, k - block + 1) & (w.room >= k))

    return without_repeats(docs, repeated_windows(keyed, k, bits, pick), keyed, k, doc_id, text)


def sparse_suffixes(docs: DataFrame, k: int = 50, prefix: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Suffix-array dedup; see the module's text.  Returns what ``without_repeats`` does."""
    keyed = _with_keys(docs, doc_id, text)
    bits = bucket_bits_for(keyed, "text")

    def retained(w: Words) -> np.ndarray:
        return np.unique(minimisers(w, k, prefix)[1])

    filters = keyed.sparkSession.sparkContext.broadcast(index_filter(keyed, retained, prefix, bits, once=False))

    def pick(w: Words) -> np.ndarray:
        (twice,) = (Filter(*f) for f in filters.value)
        starts, at = minimisers(w, k, prefix)
        suffixes = np.unique(at)
        known = suffixes[twice.hold(w.grams(prefix)[suffixes], bits)]
        return starts[np.isin(at, known, assume_unique=False)] if len(known) else starts[:0]

    return without_repeats(docs, repeated_windows(keyed, k, bits, pick), keyed, k, doc_id, text)


def digest(found: DataFrame) -> DataFrame:
    kept_sha = F.sha2(F.encode("kept_text", "UTF-8"), 256)
    return found.select("doc_id", "n_words", "n_removed", kept_sha.alias("kept_sha256"), F.size("spans").alias("n_spans"))


def op5_suffix_array(spark, sf_dir: str) -> DataFrame:
    return digest(sparse_suffixes(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return digest(fixed_block_anchors(read(spark, sf_dir, "documents").select("doc_id", "text")))


def _oracle(k: int) -> str:
    return rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, md5(array_to_string(w[i : i + {k - 1}], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM t)),
firsts AS (SELECT g, min(doc_id) AS d FROM grams GROUP BY g),
starts AS (SELECT DISTINCT doc_id, i FROM grams JOIN firsts USING (g) WHERE doc_id > d),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {k})) AS p FROM starts),
marked AS (SELECT DISTINCT doc_id, i - (row_number() OVER (PARTITION BY doc_id ORDER BY i)) AS run, i FROM starts),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM t),
left_over AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
edges AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM starts),
spans AS (SELECT doc_id, count(*) AS n FROM edges WHERE gap IS NULL OR gap > {k} GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(l.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256, coalesce(s.n, 0)::INTEGER AS n_spans
FROM t LEFT JOIN left_over l USING (doc_id) LEFT JOIN spans s USING (doc_id)
"""


ORACLE_SQL = {"op5_suffix_array": _oracle(50), "op10_substring_dedup": _oracle(13)}
