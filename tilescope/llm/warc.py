"""WARC archives of pages, and a chunked record table read back from them.

Writing: each task streams its rows into archives of their own, one gzip member a
record, payload in pieces, through the file system that the target's URI names
(``pyarrow.fs``).  A task's files carry a name of their own for every attempt and
count only once the attempt's row is in the manifest, which is checkpointed, so
retried and speculative attempts leave nothing double.

Reading: archives are streamed; a payload becomes rows of (record_id, chunk_no,
offset, data, digest so far, last) of at most ``chunk_bytes``.  The SHA-1 is carried
from piece to piece, so no record is ever held whole, and the last chunk's digest is
the payload's.

Which record is the response: among rows with equal payloads (SHA-1 and length) of
at least ``revisit_bytes``, the rows with the largest id; the others are revisits
of it.  Null text is an empty payload.  A null id is smaller than any other;
repeated rows that share the largest id are all responses.  An empty table gives no
archive and no rows.  Extra columns of the input are not written.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.config import scratch_path
from tilescope.llm.common import kept, read

PIECE = 1 << 16
FILE_BYTES = 256 << 20

CHUNKS = (
    "record_id long, record_type string, target_uri string, refers_to long, chunk_no long, offset long, "
    "data binary, digest string, last boolean, declared_bytes long, declared_digest string"
)


def classified(pages: DataFrame, page_id: str, payload: str, revisit_bytes: int) -> DataFrame:
    """Rows with the payload's size and digest, and the id of the response it revisits."""
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"),
        text.alias("payload"),
        F.octet_length(text).cast("long").alias("size"),
        F.sha1(F.encode(text, "UTF-8")).alias("digest"),
    )
    # one row a payload that occurs more than once, combined before it is shuffled
    repeated = (
        rows.where(F.col("size") >= revisit_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select(F.col("digest").alias("_d"), F.col("size").alias("_s"), "response")
    )
    joined = rows.join(repeated, (F.col("digest") == F.col("_d")) & (F.col("size") == F.col("_s")), "left")
    other = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select("page_id", "url", "payload", "size", "digest", F.when(other, F.col("response")).alias("refers_to"))


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def record_header(page_id, url: str | None, size: int, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {0 if revisit else size}",
    ]
    if url is not None:
        lines.insert(4, "WARC-Target-URI: " + "".join(c for c in url if c >= " "))
    if revisit:
        lines.insert(4, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.insert(5, f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>")
        lines.insert(6, f"WARC-Refers-To-Page-ID: {refers_to}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``classified`` rows below ``folder``; returns the manifest (path, records, bytes), checkpointed."""
    uri = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = _open(uri)
        context = TaskContext.get()
        name = f"{context.partitionId():06d}-{uuid.uuid4().hex}" if context else uuid.uuid4().hex
        out = path = None
        done: list[tuple[str, int, int]] = []
        records = written = 0

        def close():
            nonlocal out, records, written
            if out is not None:
                out.close()
                done.append((path, records, written))
                out, records, written = None, 0, 0

        for batch in batches:
            ids, urls, texts = batch.column("page_id"), batch.column("url"), batch.column("payload")
            sizes, digests, refers = batch.column("size"), batch.column("digest"), batch.column("refers_to")
            for i in range(batch.num_rows):
                if out is None:
                    target.create_dir(root, recursive=True)
                    path = f"{root}/part-{name}-{len(done):04d}.warc.gz"
                    out = target.open_output_stream(path, compression=None)  # ours is by record
                refers_to = refers[i].as_py()
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                head = record_header(ids[i].as_py(), urls[i].as_py(), sizes[i].as_py(), digests[i].as_py(), refers_to)
                pieces = [pack.compress(head)]
                if refers_to is None:
                    payload = memoryview(texts[i].as_buffer())
                    for at in range(0, len(payload), PIECE):
                        pieces.append(pack.compress(payload[at : at + PIECE]))
                        if sum(map(len, pieces)) >= PIECE:
                            written += out.write(b"".join(pieces)) or 0
                            pieces = []
                pieces += [pack.compress(b"\r\n\r\n"), pack.flush()]
                last = b"".join(pieces)
                out.write(last)
                written += len(last)
                records += 1
                if written >= file_bytes:
                    close()
        close()
        if done:
            a, b, c = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["path", "records", "bytes"])

    columns = rows.select("page_id", "url", "payload", "size", "digest", "refers_to")
    return kept(columns.mapInArrow(run, "path string, records long, bytes long"))


class _Stream:
    """Bytes of a .warc or .warc.gz file, a piece at a time."""

    def __init__(self, source):
        self.source, self.buffer, self.unpack, self.ended = source, bytearray(), None, False
        first = source.read(PIECE)
        self.gzip = first[:2] == b"\x1f\x8b"
        self._take(first)

    def _take(self, raw: bytes) -> None:
        if not raw:
            if self.unpack is not None:
                raise EOFError("archive ends inside a record")
            self.ended = True
        elif not self.gzip:
            self.buffer += raw
        while self.gzip and raw:
            self.unpack = self.unpack or zlib.decompressobj(31)
            self.buffer += self.unpack.decompress(raw, 16 * PIECE)
            raw = self.unpack.unconsumed_tail or self.unpack.unused_data
            if self.unpack.eof:
                self.unpack = None

    def fill(self, n: int) -> int:
        while len(self.buffer) < n and not self.ended:
            self._take(self.source.read(PIECE))
        return len(self.buffer)

    def take(self, n: int) -> bytes:
        self.fill(n)
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def head(self) -> dict[str, str] | None:
        """The next record's fields; None at the end."""
        while self.fill(4) >= 2 and self.buffer[:2] == b"\r\n":
            del self.buffer[:2]
        if not self.fill(1):
            return None
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            have = len(self.buffer)
            if self.fill(have + PIECE) == have:
                raise EOFError("archive ends inside a header")
        lines = self.take(end + 4).decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
        return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def record_chunks(stream: _Stream, chunk_bytes: int) -> Iterator[tuple]:
    """Rows of the chunked record table, in the archive's order."""
    while (head := stream.head()) is not None:
        left = int(head["content-length"])
        page, refers = head.get("warc-page-id") or None, head.get("warc-refers-to-page-id")
        sha, at, n = hashlib.sha1(), 0, 0
        declared = int(head.get("warc-payload-length", left))
        declared_digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
        while True:
            data = stream.take(min(chunk_bytes, left))
            if len(data) < min(chunk_bytes, left):
                raise EOFError("archive ends inside a payload")
            left -= len(data)
            sha.update(data)
            if not left and head["warc-type"] == "response" and declared_digest not in ("", sha.hexdigest()):
                raise ValueError(f"payload of record {page} does not match its digest")
            yield (
                None if page is None else int(page),
                head["warc-type"],
                head.get("warc-target-uri"),
                None if refers is None else int(refers),
                n,
                at,
                data,
                sha.hexdigest(),
                left == 0,
                declared,
                declared_digest,
            )
            at, n = at + len(data), n + 1
            if not left:
                break


def read_chunks(manifest: DataFrame, folder: str, chunk_bytes: int = 1 << 20, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives that the manifest lists.

    A record is at most one chunk in memory at a time; ``with_data=False`` leaves the
    bytes out of the rows (offsets and digests stay).
    """
    uri = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = _open(uri)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)

        for paths in batches:
            for path in paths.column("path").to_pylist():
                with source.open_input_stream(path, compression=None) as raw:
                    rows, size = [], 0
                    for row in record_chunks(_Stream(raw), chunk_bytes):
                        size += 200 + len(row[6]) * with_data
                        rows.append(row if with_data else (*row[:6], None, *row[7:]))
                        if size >= 4 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch(rows)

    # one task a file; the manifest is a few columns a file and already computed
    return manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(run, CHUNKS)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    rows = classified(read(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "html", revisit_bytes=1000)
    folder = scratch_path(spark, "warc")
    chunks = read_chunks(write_archives(rows, folder), folder, with_data=False).where("last")
    revisit = F.col("record_type") == "revisit"
    # a response's size and digest are those of the bytes that were read
    return chunks.select(
        F.col("record_id").alias("page_id"),
        F.col("declared_bytes").alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        (F.col("chunk_no") + 1).alias("chunks"),
    )



ORACLE_SQL = """
WITH t AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
d AS (SELECT page_id, octet_length(encode(p)) AS n, sha1(p) AS h FROM t),
m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h, n) ELSE page_id END AS r FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
  CASE WHEN r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN r <> page_id THEN r END AS refers_to,
  CASE WHEN r = page_id THEN greatest(1, (n + 1048575) // 1048576) ELSE 1 END::BIGINT AS chunks
FROM m
"""
