"""Benchmark decontamination: which documents hold most of a test item.

Size-partitioned MinHash containment search.  Texts become sets of hashes of ``k``
lower-case words in a row (words are runs of letters and digits; an item of fewer
words is one shingle of all of them).  Items are partitioned by the size of their
sets; an item's MinHash sketch is its smallest hashes, so many of them (n - need + 1
for a set of n of which ``need`` must be found) that a document with ``need`` of the
item's shingles holds at least one of the sketch: the search misses nothing.  A
document is probed with its own hashes, only in the partitions it is large enough for;
it need not resemble the item, so a short item is found in a document of any length.
Candidates are then verified by counting the item's shingles in the document exactly.

The benchmark is the stated query set and is hashed on its own; its tables are
broadcast only up to ``BROADCAST_ROWS`` rows of fixed width (counted first), and
joined by a shuffle beyond that, with the same result.

Null and empty texts hold nothing and are held by nothing, so such documents are
clean.  Documents are told apart by id and text: repeated rows give one result row,
rows with one id and different texts one each.  A null id is a value like others.
Ties cannot occur; empty tables give no rows; other columns are not read.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilescope.llm.common import BROADCAST_ROWS, kept, read, small, wrapped


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(w: Column, k: int) -> Column:
    """Distinct hashes of the k-word shingles; empty for fewer words."""
    at = F.sequence(F.lit(0), F.size(w) - F.lit(k))
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + F.lit(j)) for j in range(k)]))
    return F.when(F.size(w) >= k, F.array_distinct(hashes)).otherwise(F.array().cast("array<bigint>"))


def item_tables(items: DataFrame, item_id: str, text: str, k: int, percent: int) -> tuple[DataFrame, list[int]]:
    """(item, width, h, n, need, part, in_sketch) for every shingle of every item, and the widths in use."""
    w = kept(items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w"))).where(F.size("w") > 0)
    w = w.withColumn("width", F.least(F.size("w"), F.lit(k)))
    by_width = F.lit(None).cast("array<bigint>")
    for width in range(k, 0, -1):
        by_width = F.when(F.col("width") == width, shingles(F.col("w"), width)).otherwise(by_width)
    sets = w.select("item", "width", by_width.alias("s")).withColumn("n", F.size("s"))
    # an id that stands for several texts is several items
    sets = sets.distinct().withColumn("key", F.xxhash64("item", "width", "s"))
    sets = sets.withColumn("need", F.expr(f"(n * {percent} + 99) div 100").cast("int"))
    sets = sets.withColumn("part", F.floor(F.log2(F.col("n"))).cast("int"))
    rows = sets.select("item", "key", "width", "n", "need", "part", F.explode_outer("s").alias("h"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("h"))
    table = kept(rows.withColumn("in_sketch", rank <= F.col("n") - F.col("need") + F.lit(1)))
    return table, sorted(r.width for r in table.select("width").distinct().collect())


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    k: int = 5,
    percent: int = 75,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """doc_id, text_key, item_id, item_shingles, shared, containment for every document that
    holds at least ``percent`` of an item's shingles."""
    table, widths = item_tables(items, item_id, text, k, percent)
    sketch = small(table.where("in_sketch").select("h", "width", F.col("key").alias("item_key"), "need", "part"), limit)
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"), F.col(text).alias("text"))

    def probes(rows: DataFrame, carry: list[str]) -> DataFrame:
        """One row for each shingle of each width that items have."""
        w = rows.select(*carry, words(F.col("text")).alias("w"))
        out = None
        for width in widths:
            sets = w.select(*carry, shingles(F.col("w"), width).alias("s"))
            # a filter on the sets (also one inferred from a plain explode) would be pushed down
            # through their lambdas and tokenise the text once for each word
            one = sets.select(*carry, F.lit(width).alias("width"), F.size("s").alias("size"), F.explode_outer("s").alias("h"))
            out = one if out is None else out.unionByName(one)
        return out

    if not widths:
        return base.where("false").select(
            "doc_id", "text_key", F.lit(None).cast(items.schema[item_id].dataType).alias("item_id"),
            F.lit(0).alias("item_shingles"), F.lit(0).cast("long").alias("shared"), F.lit(0.0).alias("containment"),
        )
    # search: a partition is probed only by documents with the shingles that its items need
    found = probes(base, ["doc_id", "text_key"]).join(sketch, ["h", "width"]).where(F.col("size") >= F.col("need"))
    candidates = kept(found.select("doc_id", "text_key", "item_key").distinct())
    # verification of the candidate documents, each taken once
    hold = small(candidates.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).distinct(), limit)
    suspects = base.join(hold, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left_semi")
    full = small(table.select("h", "width", F.col("key").alias("item_key"), "item", "n", "need"), limit)
    hits = probes(suspects, ["doc_id", "text_key"]).join(full, ["h", "width"])
    # a repeated row would count its shingles again, so they are counted by hash
    counted = hits.groupBy("doc_id", "text_key", "item_key", "item", "n", "need").agg(F.count_distinct("h").alias("shared"))
    sure = counted.where(F.col("shared") >= F.col("need")).alias("s")
    same = (
        F.col("s.doc_id").eqNullSafe(F.col("c.doc_id"))
        & (F.col("s.text_key") == F.col("c.text_key"))
        & (F.col("s.item_key") == F.col("c.item_key"))
    )
    return sure.join(candidates.alias("c"), same, "left_semi").select(
        "doc_id", "text_key", F.col("item").alias("item_id"), F.col("n").alias("item_shingles"), "shared",
        (F.col("shared") / F.col("n")).alias("containment"),
    )


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    found = contaminated(docs, read(spark, sf_dir, "benchmark")).select("doc_id", "text_key").distinct()
    found = small(kept(found.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"))), BROADCAST_ROWS)
    rows = wrapped(docs, _id=F.col("doc_id"), _key=F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return rows.join(found, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_t")), "left_anti").select("row.*")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark),
bs AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
ks AS (SELECT DISTINCT k FROM bs),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks)),
hits AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, n::INTEGER AS item_shingles, shared::BIGINT AS shared, shared / n AS containment
FROM hits JOIN n USING (item_id) WHERE 100 * shared >= 75 * n
"""
