"""Spelling variants: words at one edit of each other, by bidirectional FM-index search schemes.

Words: maximal runs of A-Z, a-z and U+00C0-U+00FF, only A-Z lower-cased.  In the query, the
run of a document loses one letter where the crc32 of id and run says so (``noise``); other
callers count runs as they are.

1. Counts by slice of text in the task that reads it, then by word in Spark.
2. Two words at one edit, the shorter of s letters, share the first s // 2 letters or the
   last s - s // 2.  So each word takes part, for s its length and one less, in the class
   of its first and in the class of its last part: four rows a word.  Classes are hashed
   into blocks of about BLOCK rows.  A class with more than BLOCK rows is cut into blocks
   of its own: each of its words is indexed in one and searched in all.
3. A block's distinct words, delimited, are indexed forward and backward (suffix arrays,
   wavelet matrices over both Burrows-Wheeler texts).  For each word one half is matched
   from the inside out, its delimiter is put in front, and the search turns round and
   extends across the other half with one error, all intervals of a block at once.  The
   class of s and the word's length say which errors: of the own length replacements and
   insertions, of one letter less deletions.  A pair that also shares the first part is
   left to that class, so each pair is found exactly once in each direction.
4. Counts and best neighbours are reduced by word.  Forms grow at least tenfold with each
   step, so doubling the steps ends after a few rounds.

Null texts have no runs; a null id is written as nothing before the colon; repeated rows
count again; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilescope.llm.common import kept, read, small
from tilescope.llm.textkit import slices

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
NOISE = 31
BLOCK = 1 << 16
QUERIES = 1 << 13
SLICE = 16 << 20

# ---- words


def noisy(run: bytes, seed: int, modulus: int) -> bytes:
    """The run without one letter if the hash says so; ``run`` is Latin-1."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(shortest: int, modulus: int):
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % shortest).findall  # a shorter run cannot become longer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                counts: Counter = Counter()
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    # One byte a code point; what is not Latin-1 becomes "?", no letter.
                    found = Counter(runs((text or "").encode("latin-1", "replace").lower()))
                    if not modulus:
                        counts.update(found)
                        continue
                    seed = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                    for word, n in found.items():
                        counts[noisy(word, seed, modulus)] += n
                words = [w for w in counts if len(w) >= shortest]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"]
                )

    return run


def vocabulary(docs: DataFrame, noise: int = 0, shortest: int = MIN_LETTERS, least: int = MIN_COUNT) -> DataFrame:
    """word, n: words of at least ``shortest`` letters and ``least`` occurrences."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_count(shortest, noise), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- FM-index


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order; ``text`` ends with a 0 that it has nowhere else."""
    n, packed = len(text), 8
    key = np.zeros(n, np.int64)
    for j in range(packed):  # the first 8 symbols at once, 7 bits each
        key <<= 7
        key[: max(0, n - j)] |= text[j:]
    width = packed
    while True:
        order = np.argsort(key, kind="stable")
        new = np.empty(n, bool)
        new[:1] = True
        np.not_equal(key[order[1:]], key[order[:-1]], out=new[1:])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            return order
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + behind
        width *= 2


class Index:
    """Wavelet matrix of a Burrows-Wheeler text: ranks, and counts of smaller symbols, of many intervals at once."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.suffixes = suffix_array(text)
        row = text[self.suffixes - 1]
        self.first = np.cumsum(np.bincount(text, minlength=symbols)) - np.bincount(text, minlength=symbols)
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = (row >> level) & 1
            self.ones.append(np.append(0, np.cumsum(bit)).astype(np.int32))
            self.zeros.append(len(row) - int(self.ones[-1][-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.start = np.zeros(1 << self.bits, np.int64)  # where each symbol's run starts in the last level
        seen, at = np.unique(row, return_index=True)
        self.start[seen] = at

    def step(self, low: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """(low, smaller symbols, size) of the intervals after one more symbol."""
        a, b, less = low, low + size, np.zeros(len(low), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            a1, b1 = ones[a].astype(np.int64), ones[b].astype(np.int64)
            less += np.where(up, (b - a) - (b1 - a1), 0)
            a, b = np.where(up, zeros + a1, a - a1), np.where(up, zeros + b1, b - b1)
        return self.first[symbol] + a - self.start[symbol], less, b - a

    def every(self, low: np.ndarray, size: np.ndarray):
        """All symbols that may follow: (interval, symbol, low, smaller symbols, size)."""
        owner, a, b = np.arange(len(low)), low, low + size
        symbol, less = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            a1, b1 = ones[a].astype(np.int64), ones[b].astype(np.int64)
            down, up = np.flatnonzero(b - b1 > a - a1), np.flatnonzero(b1 > a1)
            owner, symbol, less = (
                np.concatenate([owner[down], owner[up]]),
                np.concatenate([symbol[down] * 2, symbol[up] * 2 + 1]),
                np.concatenate([less[down], less[up] + ((b - a) - (b1 - a1))[up]]),
            )
            a, b = np.concatenate([(a - a1)[down], (zeros + a1)[up]]), np.concatenate([(b - b1)[down], (zeros + b1)[up]])
        return owner, symbol, self.first[symbol] + a - self.start[symbol], less, b - a


class Dictionary:
    """Distinct words (Latin-1 bytes, in order) as a delimited text, indexed in both directions.

    A bidirectional interval is (low in the forward index, low in the backward one, size).
    """

    DELIMITER = 1

    def __init__(self, words: list[bytes]):
        letters = np.zeros(256, np.int64)
        data = np.frombuffer(b"\n".join(words), np.uint8)
        used = np.setdiff1d(np.unique(data), [10])
        letters[used] = np.arange(len(used)) + 2
        letters[10] = self.DELIMITER
        body = np.concatenate([[self.DELIMITER], letters[data], [self.DELIMITER]])
        self.letters, self.symbols = letters, len(used) + 2
        self.begin = np.flatnonzero(body == self.DELIMITER)[: len(words)]  # each word's delimiter
        self.forward = Index(np.append(body, 0), self.symbols)
        self.backward = Index(np.append(body[::-1], 0), self.symbols)
        self.size = len(body) + 1

    def near(self, queries: list[bytes], half: np.ndarray, shorter: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for all words that have the query's first ``half`` letters and one error behind.

        ``shorter``: seek words of one letter less (deletions), else of as many or one more.
        ``own``: 1 if the query itself is among the words.
        """
        n = len(queries)
        length = np.fromiter(map(len, queries), np.int64, n)
        text = self.letters[np.frombuffer(b"\n".join(queries) + b"\n", np.uint8)]
        at = np.cumsum(length + 1) - length - 1
        q = np.arange(n)
        # The half, from its last letter to its first, then the delimiter in front.
        low, back, size = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.size)
        for j in range(1, int(half.max(initial=0)) + 2):
            on = np.flatnonzero(j <= half[q] + 1)
            where = np.maximum(half[q[on]] - j, 0)
            symbol = np.where(j > half[q[on]], self.DELIMITER, text[at[q[on]] + where])
            low[on], less, size[on] = self.forward.step(low[on], size[on], symbol)
            back[on] += less
            live = size > own[q]
            q, low, back, size = q[live], low[live], back[live], size[live]
        place = at + half  # the next letter to match
        end = at + length  # the closing delimiter
        err = [np.zeros(0, np.int64)] * 5  # query, place, low, back, size
        found = []
        t = 0
        while len(q) or len(err[0]):
            pools = []
            if len(q):
                here = place[q] + t
                letter = text[here]
                erase = shorter[q] & (letter != self.DELIMITER)
                erase &= letter != text[np.minimum(here + 1, len(text) - 1)]  # of a run of letters, the last
                pools.append([q[erase], here[erase] + 1, low[erase], back[erase], size[erase]])
                owner, symbol, b, less, s = self.backward.every(back, size)
                f = low[owner] + less
                other = (symbol != letter[owner]) & (symbol > self.DELIMITER) & ~shorter[q[owner]]
                o = owner[other]
                pools.append([q[o], here[o], f[other], b[other], s[other]])
                other &= letter[owner] != self.DELIMITER
                o = owner[other]
                pools.append([q[o], here[o] + 1, f[other], b[other], s[other]])
                on = (symbol == letter[owner]) & (symbol != self.DELIMITER) & (s > own[q[owner]])
                q, low, back, size = q[owner[on]], f[on], b[on], s[on]
            if len(err[0]):
                eq, ep, ef, eb, es = err
                symbol = text[ep]
                eb, less, es = self.backward.step(eb, es, symbol)
                ef = ef + less
                live = es > 0
                done = live & (ep == end[eq])
                found.append((eq[done], ef[done], es[done]))
                live &= ~done
                err = [eq[live], ep[live] + 1, ef[live], eb[live], es[live]]
            err = [np.concatenate(x) for x in zip(err, *pools)] if pools else err
            t += 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, low, size = (np.concatenate(x) for x in zip(*found))
        rows = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.repeat(query, size), np.searchsorted(self.begin, self.forward.suffixes[rows])


# ---- blocks


def _same_end(a: list[bytes], b: list[bytes], n: np.ndarray) -> np.ndarray:
    return np.fromiter((x[len(x) - k :] == y[len(y) - k :] for x, y, k in zip(a, b, n)), bool, len(a))


def _search(table: pa.Table) -> pa.Table:
    """All near pairs of one block, summed up by searched word."""
    last = table.column("side")[0].as_py() == 1
    table = table.sort_by("word")
    names = table.column("word").to_pylist()
    words = [w.encode("latin-1") for w in names]
    s = table.column("s").to_numpy()
    n = table.column("n").to_numpy()
    indexed, searched = (table.column(c).to_numpy(zero_copy_only=False) for c in ("indexed", "searched"))
    start = np.fromiter((i == 0 or words[i] != words[i - 1] for i in range(len(words))), bool, len(words))
    number = np.cumsum(start) - 1  # of each row's word among the distinct words, in order
    distinct, count = [words[i] for i in np.flatnonzero(start)], n[start]
    length = np.fromiter(map(len, distinct), np.int64, len(distinct))
    in_index = np.zeros(len(distinct), bool)
    in_index[number[indexed]] = True
    some = np.flatnonzero(in_index)
    turned = [w[::-1] for w in distinct] if last else distinct
    pairs = []
    if len(some):
        lookup = Dictionary([turned[i] for i in some])
        rows = np.flatnonzero(searched)
        for at in range(0, len(rows), QUERIES):
            part = rows[at : at + QUERIES]
            who, least = number[part], s[part]
            half = least - least // 2 if last else least // 2
            q, x = lookup.near([turned[i] for i in who], half, least < length[who], in_index[who].astype(np.int64))
            a, b, least = who[q], some[x], least[q]
            member = np.isin(b * 2 + (least < length[b]), number[indexed] * 2 + (s[indexed] < length[number[indexed]]))
            if last:  # those that share the first part are found by it
                member &= ~_same_end([turned[i] for i in a], [turned[i] for i in b], least // 2)
            pairs.append((a[member], b[member]))
    a, b = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    order = np.lexsort((b, -count[b], a))
    a, b = a[order], b[order]
    head = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    text = lambda i: pa.array([distinct[k].decode("latin-1") for k in i], pa.string())
    return pa.table(
        {
            "word": text(a[head]),
            "n_near": pa.array(np.diff(np.append(head, len(a))).astype(np.int64)),
            "best_n": pa.array(count[b[head]].astype(np.int64)),
            "best": text(b[head]),
        }
    )


def members(words: DataFrame, block: int = BLOCK, shortest: int = MIN_LETTERS) -> DataFrame:
    """word, n, side, s, block, indexed, searched: the rows of all blocks."""
    taken = f"""
      filter(array(
        struct(0 AS side, len AS s, substring(word, 1, len div 2) AS part),
        struct(1 AS side, len AS s, right(word, len - len div 2) AS part),
        struct(0 AS side, len - 1 AS s, substring(word, 1, (len - 1) div 2) AS part),
        struct(1 AS side, len - 1 AS s, right(word, len - 1 - (len - 1) div 2) AS part)), x -> x.s >= {shortest})
    """
    rows = words.withColumn("len", F.char_length("word")).select("word", "n", F.explode(F.expr(taken)).alias("c"))
    rows = rows.select("word", "n", "c.side", F.col("c.s").cast("int").alias("s"), F.xxhash64("c.side", "c.s", "c.part").alias("class"))
    total = 4 * words.count()
    blocks = max(1, total // (2 * block))
    plain = F.pmod("class", F.lit(blocks))
    large = kept(rows.groupBy("class").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block))  # at most total / block rows
    yes = F.lit(True)
    if large.isEmpty():
        return rows.select("word", "n", "side", "s", plain.alias("block"), yes.alias("indexed"), yes.alias("searched"))
    cuts = F.ceil(F.col("size") / F.lit(block)).cast("int")
    both = rows.join(small(large.select("class", cuts.alias("cuts"))), "class", "left")
    one = both.where(F.col("cuts").isNull()).select("word", "n", "side", "s", plain.alias("block"), yes.alias("indexed"), yes.alias("searched"))
    many = both.where(F.col("cuts").isNotNull()).withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    own = F.pmod(F.xxhash64("word"), F.col("cuts")) == F.col("cut")
    apart = F.lit(blocks) + F.pmod(F.xxhash64("class", "cut"), F.lit(1 << 40))  # of its own but for a rare chance
    return one.unionAll(many.select("word", "n", "side", "s", apart.alias("block"), own.alias("indexed"), yes.alias("searched")))


def neighbours(words: DataFrame, block: int = BLOCK, shortest: int = MIN_LETTERS) -> DataFrame:
    """word, n_near, best_n, best for each word that has a near word; ``words`` is computed already."""
    found = (
        members(words, block, shortest)
        .groupBy("side", "block")
        .applyInArrow(_search, "word string, n_near long, best_n long, best string")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b"))
    )
    return found.select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for (word, form): the last form that can be reached, in rounds that double the steps."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = kept(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def grouped(words: DataFrame, ratio: int = RATIO, block: int = BLOCK, shortest: int = MIN_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``words`` (word, n)."""
    words = kept(words.select("word", "n"))
    near = neighbours(words, block, shortest)
    good = F.col("best_n") >= F.lit(ratio) * F.col("n")
    table = kept(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")
        )
    )
    last = roots(table.where(F.col("form").isNotNull()).select("word", "form"))
    return table.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_variants(spark, sf_dir: str) -> DataFrame:
    return grouped(vocabulary(read(spark, sf_dir, "documents"), noise=NOISE))


ORACLE_SQL = """
WITH RECURSIVE crc(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), lowered AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY 1, 2
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS h
  FROM lowered, crc_table
), spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS top FROM pairs GROUP BY word
), near AS (
  SELECT b.word, any_value(n_near) AS n_near, any_value(top) AS top, min(other) AS other
  FROM best b JOIN pairs p ON p.word = b.word AND p.m = b.top GROUP BY b.word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top >= 10 * n THEN other END AS form, CASE WHEN top >= 10 * n THEN top END AS form_n
  FROM words w LEFT JOIN near USING (word)
), walk(word, here) AS (
  SELECT word, word FROM words
  UNION ALL
  SELECT walk.word, form FROM walk JOIN formed ON formed.word = walk.here WHERE form IS NOT NULL
), ends AS (
  SELECT walk.word, here AS root FROM walk JOIN formed ON formed.word = walk.here WHERE form IS NULL
)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN ends USING (word)
"""
