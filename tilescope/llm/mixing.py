"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Rows of a source, in a seeded random order, form blocks of ``block_rows``.  Block k
(from 0) of a source of weight w may be taken from slot floor(k / w) on, its release,
and must be taken before slot ceil((k + 1) / w), its deadline.  Earliest deadline first
over the released blocks meets every deadline, so after any number t of slots a
source has given less than one block more or less than w * t.

Releases and deadlines come from the target weights themselves, as exact fractions of
their decimal notation.  The driver makes the whole schedule, one entry a block, from a
heap of one block a source; ``CHUNK`` entries at a time go to the scratch folder if there
are more of them.  Spark ranks the rows within their sources and looks the slot up.

``weight`` is a source's target share and ``given`` its share of the schedule's slots.
``repeat=True``: sources start over (``epoch`` counts from 0) until every row of every
source was used at least once, and the schedule ends with that slot; the bound holds
all through it but for the shorter last block of a source.  ``repeat=False``: each
row once; a source that runs out leaves its slots empty, so the bound holds up to there.

Null texts are rows like others and a null source is a source; repeated rows count one
each; an empty table gives no rows; other columns are kept, those named as ours are
replaced.  More than ``MAX_SOURCES`` sources raise ValueError.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilescope.config import scratch_path
from tilescope.llm.common import BROADCAST_ROWS, ranked, read, wrapped
from tilescope.llm.sharding import KEY_BITS, bucket_bits, seeded_key

MAX_SOURCES = 10_000
CHUNK = 1 << 20
NOTE = "tilescope_mixture"
BLOCK_ROWS = 64
ADDED = ["slot", "in_block", "block", "epoch", "release", "deadline", "weight", "given"]


def shares(weights: list[float], period: int) -> list[int]:
    """Whole shares of the period, at least one each, by largest remainders.

    They are not the weights, so ``mixed`` does not use them.
    """
    total = sum(weights)
    exact = [w / total * (period - len(weights)) for w in weights]
    out = [1 + int(x) for x in exact]
    rest = sorted(range(len(weights)), key=lambda i: (int(exact[i]) - exact[i], i))
    for i in rest[: period - sum(out)]:
        out[i] += 1
    return out


def whole(weights: list[float]) -> list[int]:
    """Whole numbers in the exact proportions of the weights' decimal notation."""
    exact = [Fraction(str(w)) for w in weights]
    common = math.lcm(*[x.denominator for x in exact])
    out = [int(x * common) for x in exact]
    by = math.gcd(*out)
    return [x // by for x in out]


def entries(q: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, slot, release, deadline) of slot after slot, without end; source s has the share q[s] / sum(q)."""
    period = sum(q)
    release = lambda s, k: k * period // q[s]
    deadline = lambda s, k: -(-(k + 1) * period // q[s])
    waiting = [(0, s, 0) for s in range(len(q))]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # by deadline
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(s, k), s, k))
        due, s, k = heapq.heappop(ready)  # never empty: released work is at least the slots gone by
        yield s, k, slot, release(s, k), due
        heapq.heappush(waiting, (release(s, k + 1), s, k + 1))
        slot += 1


def schedule(q: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(source, block, slot, release, deadline) of the sum(q) slots after which all repeats."""
    return [e for _, e in zip(range(sum(q)), entries(q))]


def plan_of(spark, q: list[int], blocks: list[int], repeat: bool) -> tuple[DataFrame, list[int], int]:
    """The schedule until every source has given its blocks once, the blocks given by source, and the slots."""
    names = ["_s", "block", "slot", "release", "deadline"]
    kinds = [pa.int32(), *[pa.int64()] * 4]
    table = lambda rows: pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    given, rows, path, total = [0] * len(q), [], None, 0
    open_ = len(q)
    for entry in entries(q):
        s, k, slot = entry[:3]
        given[s] += 1
        open_ -= given[s] == blocks[s]
        if repeat or k < blocks[s]:
            rows.append(entry)
            total += 1
        if len(rows) == CHUNK and open_:
            path = path or scratch_path(spark, "schedule")
            spark.createDataFrame(table(rows)).write.mode("append").parquet(path)
            rows = []
        if not open_:
            break
    plan = spark.createDataFrame(table(rows))
    if path:
        plan.write.mode("append").parquet(path)
        plan = spark.read.parquet(path)
    return F.broadcast(plan) if total <= BROADCAST_ROWS else plan, given if repeat else list(blocks), slot + 1


def mixed(
    docs: DataFrame,
    weights: dict | None = None,
    alpha: float = 0.7,
    block_rows: int = BLOCK_ROWS,
    period: int = 1000,
    repeat: bool = True,
    seed: int = 5,
    doc_id: str = "doc_id",
    source: str = "source",
    content: str | None = None,
) -> DataFrame:
    """``docs`` with slot, in_block, block, epoch, release, deadline, weight and given.

    ``weights`` gives the target by source; without it, weights follow the sources' row
    counts to the power ``alpha``.  Sources without a weight raise ValueError.  ``period``
    has no effect any more: the schedule is as long as the input.  ``content`` names a
    column with a hash of the row, where its columns are not all there.
    """
    spark = docs.sparkSession
    base = docs.drop(*ADDED)
    counts = base.groupBy(F.col(source).alias("s")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    counts = sorted(counts, key=lambda r: (r.s is not None, str(r.s)))
    if weights is None:
        target = [r.n**alpha for r in counts]
    elif lost := [r.s for r in counts if not weights.get(r.s, 0) > 0]:
        raise ValueError(f"no weight for {lost[:5]}")
    else:
        target = [float(weights[r.s]) for r in counts]
    out_types = "slot long, in_block int, block long, epoch int, release long, deadline long, weight double, given double"
    if not counts:
        return base.select("*", *[F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in out_types.split(", ")])
    q = whole(target)
    blocks = [-(-r.n // block_rows) for r in counts]
    plan, take, slots = plan_of(spark, q, blocks, repeat)
    kind = base.schema[source].dataType.simpleString()
    facts = spark.createDataFrame(
        [(r.s, i, q[i] / sum(q), take[i] / slots, blocks[i], take[i]) for i, r in enumerate(counts)],
        f"_source {kind}, _s int, weight double, given double, _blocks long, _take long",
    )

    total = sum(r.n for r in counts)
    # rank the ids within their sources; ties are rows that are alike in every column
    rest = [F.col(content) if content else row_hash(base)]
    keyed = wrapped(base, _of=F.col(source), _key=seeded_key(seed, F.col(doc_id), *rest), _tie=rest[0])
    placed = ranked(
        keyed, ["_of"], F.shiftright("_key", KEY_BITS - bucket_bits(total)), [F.col("_key"), F.col("_tie")], "_rank"
    ).drop("_key", "_tie")
    rows = placed.join(F.broadcast(facts), F.col("_of").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_block", F.expr(f"_rank div {block_rows}"))
    rows = rows.withColumn("epoch", F.explode(F.expr("sequence(0, cast((_take - 1 - _block) div _blocks as int))")))
    rows = rows.withColumn("block", F.col("_block") + F.col("epoch") * F.col("_blocks")).join(plan, ["_s", "block"])
    return rows.select(
        "row.*",
        "slot",
        F.expr(f"cast(_rank % {block_rows} as int)").alias("in_block"),
        *ADDED[2:],
    )


def row_hash(docs: DataFrame) -> Column:
    """Hash of all columns; those that hold a map are taken as JSON."""
    plain = lambda f: F.to_json(f"`{f.name}`") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
    return F.coalesce(F.xxhash64(*[plain(f) for f in docs.schema.fields]), F.lit(0))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents").select("doc_id", "source"))


def mix_documents(spark, docs: DataFrame, sf_dir: str, weights: dict | None = None, alpha: float = 0.7, seed: int = 5) -> DataFrame:
    """Pipeline stage: all documents, each once, in the mixture's order.

    Part files and the rows in them follow the schedule, so a reader that takes the
    files in order sees the target weights as long as its sources last.  The mixture is
    noted with the source column, from which the sharding stage cuts along it.
    """
    mixture = {"weights": None if weights is None else [[k, w] for k, w in weights.items()], "alpha": alpha, "seed": seed}
    placed = mixed(docs, weights, alpha, seed=seed, repeat=False)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(parts, "slot", "in_block").sortWithinPartitions("slot", "in_block")
    noted = F.col("source").alias("source", metadata={NOTE: json.dumps(mixture)})
    return placed.select(*[noted if c == "source" else F.col(f"`{c}`") for c in docs.columns])


def mixture_of(docs: DataFrame) -> dict | None:
    """Arguments of ``mixed`` that the mixing stage noted with the documents."""
    if NOTE not in docs.schema["source"].metadata:
        return None
    noted = json.loads(docs.schema["source"].metadata[NOTE])
    return noted | {"weights": None if noted["weights"] is None else dict(map(tuple, noted["weights"]))}
