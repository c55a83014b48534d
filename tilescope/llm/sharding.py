"""Sharding by proportional stratified interleaving.

Rows of each source are put into a seeded random order and ranked; the row of rank
r of a source of n rows gets the fractional rank (2r + 1) / 2n.  All rows sorted by
it are cut into shards of equal row counts, so every shard holds every source in
its share (up to a row or so).  Both ranks are exact and come from counts by bucket
(``common.ranked``): no task holds a source, however large.

The law is ``rows``: shard sizes differ by one row at most.  Copies of a text are
rows like any other and need not meet in one shard.  Null and empty texts have 8
bytes and checksum 0; null ids and null sources are values like others; repeated
rows take a place each; an empty table gives no rows.  Of extra columns none is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescope.llm.common import ranked, read

BUCKET_ROWS = 20_000
KEY_BITS = 60


def bucket_bits(rows: int) -> int:
    """Bits so that about BUCKET_ROWS of the rows share a bucket."""
    return min(40, max(0, rows // BUCKET_ROWS).bit_length())


def seeded_key(seed: int, *parts: Column) -> Column:
    """60 random bits that depend on the seed and the parts (null counts as empty)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def interleaved(df: DataFrame, source: str, key: str, ties: list[str], rows: int, position: str) -> DataFrame:
    """``df`` with its place (from 0) in the interleaving of the sources by fractional rank."""
    bits = bucket_bits(rows)
    bucket = F.shiftright(key, KEY_BITS - bits)
    order = [F.col(key), *[F.col(c) for c in ties]]
    placed = ranked(df, [source], bucket, order, "_rank", total="_total")
    part = (F.lit(2) * F.col("_rank") + F.lit(1)).cast("double") / (F.lit(2) * F.col("_total"))
    placed = placed.withColumn("_part", part).drop("_rank", "_total")
    order = [F.col("_part"), F.col(source), *order]
    return ranked(placed, [], F.floor(F.col("_part") * F.lit(1 << bits)), order, position).drop("_part")


def facts_of(docs: DataFrame, doc_id: str, source: str, text: str, *more: Column) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        *more,
    )


def cut(placed: DataFrame, total: int, shards: int) -> DataFrame:
    """Shards of equal row counts of rows with their place ``_at`` among all."""
    shard = F.expr(f"_at * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("_at") - first).cast("long"))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "source",
        )
    )


def sharded(
    docs: DataFrame, shards: int = 24, seed: int = 17, doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, source for every row."""
    rows = facts_of(docs, doc_id, source, text)
    total = docs.count()
    keyed = rows.withColumn("_key", seeded_key(seed, F.col("doc_id"), F.col("text_crc32")))
    return cut(interleaved(keyed, "source", "_key", ["doc_id", "text_crc32", "size"], total, "_at"), total, shards)


def sharded_along(docs: DataFrame, mixture: dict, shards: int = 24) -> DataFrame:
    """As ``sharded``, but the rows are cut in the order of a mixture (arguments of ``mixing.mixed``)."""
    from tilescope.llm.mixing import BLOCK_ROWS, mixed, row_hash

    rows = facts_of(docs, "doc_id", "source", "text", row_hash(docs).alias("_content"))
    placed = mixed(rows, **mixture, repeat=False, content="_content")
    bucket = F.expr(f"slot div {max(1, BUCKET_ROWS // BLOCK_ROWS)}")
    placed = ranked(placed, [], bucket, [F.col("slot"), F.col("in_block")], "_at")
    return cut(placed, docs.count(), shards)


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    return sharded(read(spark, sf_dir, "documents"))


def shard_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the shard and slot of every document.

    Documents that went through the mixing stage are cut along their mixture: the first
    rows of the shards, taken in order, have the target weights until a source has given
    all its rows; what the other sources still have follows by their weights.
    """
    from tilescope.llm.mixing import mixture_of

    mixture = mixture_of(docs)
    return sharded(docs) if mixture is None else sharded_along(docs, mixture)


ORACLE_SQL = """
WITH RECURSIVE crc(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
rows_of AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) END AS text_crc32
  FROM documents, crc_table
), keyed AS (
  SELECT *, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32::VARCHAR), 1, 15))::BIGINT AS key
  FROM rows_of
), ranks AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, doc_id, text_crc32, size) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total
  FROM keyed
), placed AS (
  SELECT *, row_number() OVER (
    ORDER BY (2 * r + 1)::DOUBLE / (2 * n), source NULLS FIRST, key, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos
  FROM ranks
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (pos * 24 // total)::INTEGER AS shard,
  (pos - ((pos * 24 // total) * total + 23) // 24)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM placed
"""
