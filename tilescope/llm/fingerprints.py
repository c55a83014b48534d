"""Document fingerprints by Order MinHash.

The k-mers are runs of ``K`` words (a text of fewer words is one k-mer), numbered by
occurrence, so a k-mer's second occurrence is an element of its own.  Every element
is hashed once; the hash's first bits deal it to one of 2**BIN_BITS registers, the
rest order it there.  A register takes its ``TUPLE`` least elements, puts them back
into their order in the text and hashes that tuple.  Two texts agree in a register
if the same elements are minimal and stand in the same order, so the share of equal
registers among those that either text fills falls with the edit distance, not only
with the sets.

Everything is array functions on one row: nothing is exploded, sorted or grouped
across rows, and memory is bounded by the longest text.  DataFrame functions only.

Null text is empty, has an empty fingerprint, and two empty fingerprints have likeness
1.  Equal texts have equal fingerprints.  Order follows doc_id with null as the least;
rows that share an id share a next document, and an id with several rows stands, as a
next document, for the text with the least MD5.  A single document is its own next.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilescope.llm.common import kept, read

K = 2
TUPLE = 2
BIN_BITS = 5
POSITION_BITS = 31  # a text has fewer than 2**31 words
LEAST_ID = -(2**63)


def _last_bits(x: Column, bits: int) -> Column:
    return x.bitwiseAND(F.lit((1 << bits) - 1))


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the registers of ``text`` in column ``out``: an array of register << 32 | tuple hash."""
    w, kmers, order, firsts, nth, keyed, least, heads = (f"_{out}_{c}" for c in ("w", "k", "o", "f", "n", "e", "l", "h"))
    drop = [w, kmers, order, firsts, nth, keyed, least, heads]
    none = F.array().cast("array<bigint>")
    size = F.size(w)
    df = df.withColumn(w, F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), ""))

    # k-mer hash (33 bits) and position, as one number
    def numbered(i: Column) -> Column:
        h = F.xxhash64(*[F.get(F.col(w), i + F.lit(j)) for j in range(K)])
        return F.shiftleft(h, POSITION_BITS).bitwiseOR(i.cast("long"))

    last = F.greatest(size - F.lit(K), F.lit(0))
    df = df.withColumn(kmers, F.when(size > 0, F.transform(F.sequence(F.lit(0), last), numbered)).otherwise(none))
    # equal k-mers side by side, in text order
    df = df.withColumn(order, F.sort_array(kmers))
    kmer = lambda i: F.shiftright(F.get(F.col(order), i), POSITION_BITS)
    index = F.sequence(F.lit(0), F.size(order) - F.lit(1))
    df = df.withColumn(
        firsts,
        F.when(F.size(order) > 0, F.filter(index, lambda i: (i == 0) | (kmer(i) != kmer(i - F.lit(1))))).otherwise(F.array().cast("array<int>")),
    )
    # occurrence numbers 0, 1, ... inside each run
    until = lambda i: F.coalesce(F.get(F.col(firsts), i + F.lit(1)), F.size(order))
    df = df.withColumn(
        nth, F.flatten(F.transform(F.col(firsts), lambda start, i: F.sequence(F.lit(0), until(i) - start - F.lit(1))))
    )

    # element hash (register first) and position; a column that is used once is inlined where it
    # stands, so it must not stand inside a lambda
    def element(x: Column, n: Column) -> Column:
        h = F.xxhash64(F.shiftright(x, POSITION_BITS), n)
        return F.shiftleft(h, POSITION_BITS).bitwiseOR(_last_bits(x, POSITION_BITS))

    df = df.withColumn(keyed, F.sort_array(F.zip_with(F.col(order), F.col(nth), element)))
    register = lambda x: F.shiftrightunsigned(x, 64 - BIN_BITS)
    # the least TUPLE of each register
    df = df.withColumn(
        least,
        F.filter(
            F.col(keyed),
            lambda x, i: (i < TUPLE) | (register(F.get(F.col(keyed), i - F.lit(TUPLE))) != register(x)),
        ),
    )
    index = F.sequence(F.lit(0), F.size(least) - F.lit(1))
    at = lambda i: F.get(F.col(least), i)
    df = df.withColumn(
        heads,
        F.when(
            F.size(least) > 0, F.filter(index, lambda i: (i == 0) | (register(at(i)) != register(at(i - F.lit(1)))))
        ).otherwise(F.array().cast("array<int>")),
    )

    def hashed(i: Column) -> Column:
        # the tuple of the register that starts here, in text order
        there = F.filter(F.slice(F.col(least), i + F.lit(1), TUPLE), lambda x: register(x) == register(at(i)))
        by_place = F.sort_array(
            F.transform(
                there,
                lambda x: F.shiftleft(_last_bits(x, POSITION_BITS), 64 - POSITION_BITS).bitwiseOR(
                    F.shiftrightunsigned(x, POSITION_BITS)
                ),
            )
        )
        tuple_hash = F.xxhash64(F.transform(by_place, lambda x: _last_bits(x, 64 - POSITION_BITS)))
        return F.shiftleft(register(at(i)), 32).bitwiseOR(_last_bits(tuple_hash, 32))

    return df.withColumn(out, F.transform(F.col(heads), hashed)).drop(*drop)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal registers among those that either fills; 1 if none is filled."""
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 32))
    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def text_of(signature: Column) -> Column:
    """Registers as text: number and hash of each in hexadecimal."""
    return F.array_join(F.transform(signature, lambda v: F.lower(F.hex(v))), ".")


def neighbours(ids: DataFrame, key: str) -> DataFrame:
    """(key, next, previous) of the distinct values of ``key`` in a ring of ascending order."""
    spark = ids.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = 33  # monotonically_increasing_id: partition above, row below
    placed = ids.select(key).distinct().repartitionByRange(parts, key).sortWithinPartitions(key)
    placed = kept(placed.withColumn("_m", F.monotonically_increasing_id()))
    placed = placed.select(key, F.shiftright("_m", low).alias("_p"), _last_bits(F.col("_m"), low).alias("_i"))
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = placed.join(F.broadcast(sizes), "_p").select(key, (F.col("_before") + F.col("_i")).alias("_r"))
    total = placed.count()
    follow = rank.select(F.col(key).alias("next"), F.expr(f"(_r + {total} - 1) % {max(total, 1)}").alias("_r"))
    lead = rank.select(F.col(key).alias("previous"), F.expr(f"(_r + 1) % {max(total, 1)}").alias("_r"))
    return rank.join(follow, "_r").join(lead, "_r").select(key, "next", "previous")


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_ID)).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ring = neighbours(rows, "key")
    # the longest start of each document that the one before it asks for
    quarter = F.floor(F.length("text") / 4).cast("int")
    asked = rows.select("key", quarter.alias("_q")).groupBy("key").agg(F.max("_q").alias("_q"))
    ring = kept(
        ring.join(asked.select(F.col("key").alias("previous"), F.col("_q").alias("ask")), "previous").select(
            F.col("key").alias("_key"), "next", "previous", "ask"
        )
    )
    whole = rows.join(ring, F.col("key") == F.col("_key")).drop("_key")
    # doc_id is there only so that both uses of the texts share one shuffle of the same columns
    first = F.struct(F.md5("text").alias("m"), F.expr("substring(text, 1, ask)").alias("t"), "doc_id")
    starts = whole.groupBy(F.col("previous").alias("_of")).agg(F.min(first)["t"].alias("start"))
    both = whole.join(starts, F.col("key") == F.col("_of")).withColumn("n_chars", F.length("text").cast("long"))
    both = both.withColumn(
        "edited",
        F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 4 as int)), substring(start, 1, cast(n_chars div 4 as int)))"),
    )
    both = both.select("doc_id", "key", "next", "n_chars", F.md5("text").alias("m"), "text", "edited", F.sha2("edited", 256).alias("edited_sha256"))
    both = with_signature(both, "text", "own").drop("text")
    both = kept(with_signature(both, "edited", "changed").drop("edited"))
    ahead = both.groupBy(F.col("key").alias("_n")).agg(F.min(F.struct("m", "own"))["own"].alias("after"))
    return both.join(ahead, F.col("next") == F.col("_n")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_of(F.col("own")).alias("fingerprint"),
        text_of(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprinted(read(spark, sf_dir, "documents"))
