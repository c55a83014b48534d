"""Interaction of five quality filters, with exact duplicates found in radix tries of whole texts.

The filters of a text (null: empty), by letter: A under 50 words, B under 65 % distinct
words, C over 5 % capitals A-Z, D one of ``#$%&*|``, E equal to the text of a smaller id.

1. One pass over the documents decides A to D.  In each slice of rows that a task reads,
   equal texts keep their text once, in the row of the least id; the result is written to
   the shared folder, so a text with millions of copies travels once for each slice.
2. The texts are dealt out by adaptive prefixes.  Bytes are counted by the first two
   characters; a prefix with more than ``leaf_bytes`` grows by what all its texts have in
   common and two characters more, and so on until it is light or a single text.  The
   driver gets heavy prefixes only, at most total / leaf_bytes in each round (and never
   more than MAX_HEAVY: leaves grow instead).
3. The texts of one prefix go into a compressed trie that holds the least id at each
   terminal; a walk over it returns the rows that have a smaller one elsewhere.
4. Flags, labels and sources are joined by id, counted by (source, failures, labels), and
   all 120 orders are worked out on these counts: each source has 32 masks.

Null and empty sources are one part.  A null id is neither smaller nor larger than
another: its row never fails E nor makes others fail it.  Rows of the same least id do not
fail E.  Several label rows of an id count as one that has each mark of any of them.  An
empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import os.path
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescope.config import scratch_path
from tilescope.llm.common import kept, read
from tilescope.llm.textkit import slices

# Fixed values of the filters.
FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "#$%&*|"

CAPITALS = bytes(range(65, 91))
SLICE = 8 << 20
LEAF_BYTES = 16 << 20
TASK_BYTES = 32 << 20
MAX_HEAVY = 1_000_000
ENDED = "\uffff\uffff"
BLOCK = 1 << 20
FACTS = "doc_id long, source string, mask int, rep long, tag long, text string"


_symbol = re.compile(f"[{re.escape(SYMBOLS)}]".encode()).search
_separator = re.compile(rb"[\x20\x09-\x0d]").search


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some BLOCK bytes at a time."""
    at = 0
    while at < len(data):
        cut = _separator(data, at + BLOCK)
        to = cut.start() if cut else len(data)
        yield data[at:to].split()  # at 0x20 and 0x09-0x0D
        at = to


def failures(text: str) -> int:
    """Bits of the filters A to D that the text fails."""
    data = text.encode()
    words, seen = 0, set()
    for block in word_blocks(data):
        words += len(block)
        seen.update(block)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (
        (words < MIN_WORDS)
        | (100 * len(seen) < DISTINCT_PERCENT * words) << 1
        | (100 * capitals > CAPITAL_PERCENT * len(text)) << 2
        | (_symbol(data) is not None) << 3
    )


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(a, {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[b]) for a, b in (f.split() for f in FACTS.split(", "))])
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            ids = part.column("doc_id").to_pylist()
            first: dict[str, int] = {}  # row of the least id of each text
            texts = part.column("text").to_pylist()
            for row, text in enumerate(texts):
                if ids[row] is not None:
                    text = text or ""
                    if text not in first or ids[row] < ids[first[text]]:
                        first[text] = row
            masks = {t: failures(t) for t in {t or "" for t in texts}}
            tags = {t: int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "little", signed=True) for t in first}
            reps = [None if i is None else ids[first[t or ""]] for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("source"),
                    pa.array([masks[t or ""] for t in texts], pa.int32()),
                    pa.array(reps, pa.int64()),
                    pa.array([None if i is None else tags[t or ""] for i, t in zip(ids, texts)], pa.int64()),
                    pa.array([t or "" if first.get(t or "") == row else None for row, t in enumerate(texts)], pa.string()),
                ],
                schema=schema,
            )


# ---- adaptive prefixes


def leaf_of(text: str, heavy: dict[str, str]) -> tuple[str, str]:
    """The prefix whose range the text falls in, and the common prefix of the range above it.

    ``heavy`` maps a heavy prefix to what all its texts have in common.  A text that ends
    within the next two characters is a leaf of its own, marked by ENDED.
    """
    node = ""
    while True:
        end = len(node) + 2
        leaf = text[:end] if len(text) >= end else text + ENDED
        if leaf not in heavy:
            return leaf, node
        node = heavy[leaf]


def _reach(prefix: str) -> int:
    """Characters of a text that are compared to find what the texts of a prefix have in common."""
    return 2 * len(prefix) + 64


def _weigh(heavy: dict[str, str], last: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size: dict[str, int] = {}
        common: dict[str, str] = {}
        tags: dict[str, tuple[int, int]] = {}
        for batch in batches:
            for head, bytes_, tag in zip(*(batch.column(c).to_pylist() for c in ("head", "bytes", "tag"))):
                leaf, node = leaf_of(head, heavy)
                if node in last:
                    size[leaf] = size.get(leaf, 0) + bytes_
                    low, high = tags.get(leaf, (tag, tag))
                    tags[leaf] = min(low, tag), max(high, tag)
                    known = common.get(leaf)
                    here = head[: _reach(leaf)]
                    common[leaf] = here if known is None else os.path.commonprefix((known, here))
        leaves = list(size)
        columns = {
            "leaf": pa.array(leaves, pa.string()),
            "bytes": pa.array([size[x] for x in leaves], pa.int64()),
            "common": pa.array([common[x] for x in leaves], pa.string()),
            "low": pa.array([tags[x][0] for x in leaves], pa.int64()),
            "high": pa.array([tags[x][1] for x in leaves], pa.int64()),
        }
        yield pa.RecordBatch.from_pydict(columns)

    return run


def prefixes(texts: DataFrame, leaf_bytes: int = LEAF_BYTES) -> tuple[dict[str, str], int]:
    """Heavy prefixes with what their texts have in common, and the bytes of all texts.

    ``texts`` has tag (a hash of the text: copies of one text alone are not divided) and text.
    """
    total = texts.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
    limit = max(leaf_bytes, total // MAX_HEAVY)
    heavy: dict[str, str] = {}
    last = {""} if total > limit else set()
    while last:
        reach = _reach(max(last, key=len) + ENDED)
        heads = texts.select(F.substring("text", 1, reach).alias("head"), F.octet_length("text").cast("long").alias("bytes"), "tag")
        found = (
            heads.mapInArrow(_weigh(heavy, last), "leaf string, bytes long, common string, low long, high long")
            .groupBy("leaf")
            .agg(F.sum("bytes").alias("bytes"), F.min("common").alias("a"), F.max("common").alias("b"), F.min("low").alias("low"), F.max("high").alias("high"))
            .where((F.col("bytes") > limit) & (F.col("low") < F.col("high")) & ~F.col("leaf").endswith(ENDED))
            .collect()  # at most total / limit rows
        )
        grown = {r.leaf: os.path.commonprefix((r.a, r.b)) for r in found}
        heavy |= grown
        last = set(grown.values())
    return heavy, total


# ---- tries


class Trie:
    """Compressed trie of whole texts; each terminal has its least id and the rows that end there."""

    def __init__(self):
        self.root: dict = {}

    def insert(self, text: str, doc: int, row: tuple) -> None:
        node, at = self.root, 0
        while True:
            rest = text[at:]
            if not rest:
                break
            edge = node.get(rest[0])
            if edge is None:
                node[rest[0]] = edge = [rest, {}]
                node = edge[1]
                break
            label, below = edge
            if rest.startswith(label):
                node, at = below, at + len(label)
                continue
            same = len(os.path.commonprefix((label, rest)))
            split = {label[same]: [label[same:], below]}
            node[rest[0]] = [label[:same], split]
            node, at = split, at + same
        end = node.get("")
        if end is None:
            node[""] = [doc, [row]]
        else:
            end[0] = min(end[0], doc)
            end[1].append(row)

    def beaten(self) -> Iterator[tuple]:
        """Rows whose id is larger than the least one of their text."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            for key, edge in node.items():
                if key:
                    stack.append(edge[1])
                else:
                    yield from (row for row in edge[1] if row[0] > edge[0])


def _leaves(heavy: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = [leaf_of(t, heavy)[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.string())], names=[*batch.schema.names, "leaf"])

    return run


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of their prefix: one trie is in memory at a time."""

    def out(trie: Trie) -> pa.RecordBatch:
        rows = list(trie.beaten())
        return pa.RecordBatch.from_pydict({"rep": pa.array([r[0] for r in rows], pa.int64()), "tag": pa.array([r[1] for r in rows], pa.int64())})

    trie, now = Trie(), None
    for batch in batches:
        for rep, tag, text, leaf in zip(*(batch.column(c).to_pylist() for c in ("rep", "tag", "text", "leaf"))):
            if leaf != now:
                yield out(trie)
                trie, now = Trie(), leaf
            trie.insert(text, rep, (rep, tag))
    yield out(trie)


def repeated(texts: DataFrame, leaf_bytes: int = LEAF_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The (rep, tag) of ``texts`` (rep long, tag long, text string) whose text has a smaller rep."""
    heavy, total = prefixes(texts, leaf_bytes)
    tasks = max(1, -(-total // task_bytes))
    dealt = texts.mapInArrow(_leaves(heavy), "rep long, tag long, text string, leaf string")
    dealt = dealt.repartition(tasks, "leaf").sortWithinPartitions("leaf")
    return dealt.mapInArrow(_search, "rep long, tag long")


# ---- orders


def orders() -> list[dict]:
    """One entry for each step of each order: its bit, the bits before it, and its place."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, bit in enumerate(order, 1):
            out.append({"filter_order": name, "step": step, "bit": 1 << bit, "before": before})
            before |= 1 << bit
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """All orders on ``counts``: part, mask, good, toxic, rows."""
    every = 1 << len(FILTERS)

    def by_mask(value: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, value)), F.lit(0)).cast("long") for m in range(every)])

    n = F.col("rows")
    parts = counts.groupBy("part").agg(
        by_mask(n).alias("n"), by_mask(F.when(F.col("good"), n)).alias("g"), by_mask(F.when(F.col("toxic"), n)).alias("t")
    )
    literal = ", ".join(f"struct('{o['filter_order']}' AS filter_order, {o['step']} AS step, {o['bit']} AS bit, {o['before']} AS before)" for o in orders())
    rows = parts.select("*", F.explode(F.expr(f"array({literal})")).alias("s"))

    def total(array: str, condition: str) -> Column:
        return F.expr(f"aggregate(sequence(0, {every - 1}), 0L, (a, m) -> a + IF({condition}, {array}[m], 0L))")

    removed = "(m & s.bit) != 0 AND (m & s.before) = 0"
    # A filter is the first of a mask's failures in 120 / (number of failures) of the orders.
    shapley = F.expr(f"aggregate(sequence(0, {every - 1}), 0L, (a, m) -> a + IF((m & s.bit) != 0, n[m] * (120L div greatest(bit_count(m), 1)), 0L))")
    return rows.select(
        "part",
        F.col("s.filter_order").alias("filter_order"),
        F.col("s.step").alias("step"),
        total("n", "(m & (s.before | s.bit)) = 0").alias("kept"),
        total("n", removed).alias("removed"),
        total("n", "(m & s.bit) != 0 AND (m & s.before) != 0").alias("redundant"),
        total("n", "m = s.bit").alias("unique_fails"),
        total("g", removed).alias("good_lost"),
        total("t", removed).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def flagged(docs: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """doc_id, source, mask and rows: how many documents of an id and source fail exactly these filters."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    path = scratch_path(spark, "audit")
    rows.mapInArrow(_facts, FACTS).write.option("compression", "zstd").parquet(path)
    facts = spark.read.parquet(path)
    beaten = repeated(facts.where(F.col("text").isNotNull()).select("rep", "tag", "text"), leaf_bytes)
    beaten = beaten.distinct().withColumn("_found", F.lit(True))
    copy = F.coalesce(F.col("_found"), F.lit(False)) | F.coalesce(F.col("doc_id") > F.col("rep"), F.lit(False))
    mask = F.col("mask") + F.when(copy, F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    slim = facts.select("doc_id", "source", "mask", "rep", "tag").join(beaten, ["rep", "tag"], "left")
    return slim.groupBy("doc_id", "source", mask.alias("mask")).agg(F.count(F.lit(1)).alias("rows"))


def audited(docs: DataFrame, labels: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """The contribution of every filter at every step of all orders, by source."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    both = flagged(docs, leaf_bytes).join(marks, "doc_id", "left")
    counts = both.groupBy(
        F.coalesce("source", F.lit("")).alias("part"),
        "mask",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    ).agg(F.sum("rows").alias("rows"))
    return interactions(kept(counts))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audited(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLE_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), marks AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT doc_id, part,
    (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS mask
  FROM texts
), rows_of AS (
  SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM masks LEFT JOIN marks USING (doc_id)
), counts AS (
  SELECT part, mask, count(*) AS n, sum(good) AS g, sum(toxic) AS t FROM rows_of GROUP BY part, mask
), letters AS (
  SELECT chr(65 + i::INT) AS f, (1 << i)::INT AS bit FROM range(5) r(i)
), steps(filter_order, step, bit, before) AS (
  SELECT f, 1, bit, 0 FROM letters
  UNION ALL
  SELECT s.filter_order || l.f, s.step + 1, l.bit, s.before | s.bit
  FROM steps s JOIN letters l ON (s.before | s.bit) & l.bit = 0
), orders AS (
  SELECT DISTINCT o.filter_order, s.step, s.bit, s.before
  FROM steps o JOIN steps s ON o.step = 5 AND substr(o.filter_order, 1, s.step) = s.filter_order
)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(g) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(t) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & bit <> 0), 0)::BIGINT AS shapley
FROM counts, orders GROUP BY part, filter_order, step
"""
