"""Whole jobs: what the operators once left out."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tilescope.llm import jaccard, languages, links, mixing, scoring, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def of_sources(spark, counts):
    rows = [(s, n) for s, c in counts.items() for n in range(c)]
    return spark.createDataFrame([(i, f"text {s} {n}", "en", s, 9) for i, (s, n) in enumerate(rows)], DOCS).repartition(3)


@pytest.mark.parametrize("repeat", [True, False])
@pytest.mark.parametrize("chunk", [1 << 20, 50])
def test_mixing_keeps_the_target_weights(spark, monkeypatch, repeat, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    target = {"s0": 0.5} | {f"s{i}": 0.5 / 19 for i in range(1, 20)}
    docs = of_sources(spark, {"s0": 120} | {f"s{i}": 6 for i in range(1, 20)})
    got = mixing.mixed(docs, weights=target, block_rows=1, repeat=repeat).collect()
    at = {r.slot: r.source for r in got}
    assert len(at) == len(got) and {r.doc_id for r in got} == set(range(234))
    given = Counter()
    for t in range(200):  # no source has run out by then
        given[at[t]] += 1
        assert all(abs(given[s] - w * (t + 1)) < 1 + 1e-9 for s, w in target.items())
    assert {r.source: round(r.weight, 9) for r in got} == {s: round(w, 9) for s, w in target.items()}


def test_schedule_of_many_and_of_rare_sources_keeps_the_target():
    for weights in ([0.5] + [0.5 / 999] * 999, [0.0001, 0.3, 0.3, 0.3999]):
        q, given = mixing.whole(weights), Counter()
        for t, (s, k, slot, release, due) in zip(range(12_000), mixing.entries(q)):
            assert slot == t and release <= slot < due and given[s] == k
            given[s] += 1
        assert all(abs(given[s] - w * 12_000) < 1 + 1e-9 for s, w in enumerate(weights))


def test_final_rows_follow_the_mixture(spark, tmp_path):
    counts = {"hot": 3000, "a": 1000, "b": 1000, None: 1000}
    docs = of_sources(spark, counts)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names[-2:] == ["mixing", "sharding"]
    total = sum(n**0.7 for n in counts.values())
    for weights in (None, {"hot": 0.1, "a": 0.3, "b": 0.4, None: 0.2}):
        mixing.mix_documents(spark, docs, "", weights).write.mode("overwrite").parquet(str(tmp_path))
        out = sharding.shard_documents(spark, spark.read.parquet(str(tmp_path)), "").collect()
        target = weights or {s: n**0.7 / total for s, n in counts.items()}
        assert {r.doc_id for r in out} == set(range(6000)) and len(out) == 6000
        size = Counter(r.shard for r in out)
        assert set(size.values()) == {250} and all(r.slot < 250 for r in out)
        rows = [r.source for r in sorted(out, key=lambda r: (r.shard, r.slot))]
        until = min(max(i for i, x in enumerate(rows) if x == s) for s in counts)
        assert until > 2000
        for t in range(250, until - 64, 250):
            for s, w in target.items():
                assert abs(rows[:t].count(s) - w * t) < 128


def test_stages_of_the_pipeline_hand_the_mixture_on(spark, tmp_path):
    docs = of_sources(spark, {"hot": 900, "a": 300, "b": 300})
    docs.write.parquet(f"{tmp_path}/in")
    mixed_ = mixing.mix_documents(spark, spark.read.parquet(f"{tmp_path}/in"), "")
    mixed_.write.parquet(f"{tmp_path}/mixed")
    again = spark.read.parquet(f"{tmp_path}/mixed")
    order = {r.doc_id: (r.slot, r.in_block) for r in mixing.mixed(docs, repeat=False).collect()}
    got = sharding.shard_documents(spark, again, "").collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))] == sorted(order, key=order.get)


def test_documents_stay_when_no_language_could_be_learned(spark):
    docs = of_sources(spark, {"a": 20}).selectExpr("doc_id", "if(doc_id = 3, '12', text) as text", "cast(null as string) as lang", "source", "n_chars")
    assert {r.doc_id for r in languages.keep_identified(spark, docs, "").collect()} == set(range(20)) - {3}


def components(rows):
    """(id, least id of its class) by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[a : a + 5]) for a in range(len(w) - 4)}
    root = {i: i for i in sets}
    top = lambda i: i if root[i] == i else top(root[i])
    for i in sets:
        for j in sets:
            if i < j and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}


def test_texts_of_one_template_do_not_meet_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 4)
    monkeypatch.setattr(links, "LEAF", 4)
    r = random.Random(4)
    base = [f"t{i}" for i in range(10)]
    rows = [" ".join([*base, f"x{i}", f"y{i}"]) for i in range(150)]  # 6 of 10 shingles shared: no links
    rows += [" ".join([*base, f"x{i}", f"y{i}", "z"]) for i in range(0, 150, 10)]  # each links with one of these
    rows += [" ".join([*base, *["u"] * (i % 2)]) + f" v{i}" * (i % 3 == 0) for i in range(12)]
    long = [f"l{i}" for i in range(40)]
    for i in range(90):  # parts of a longer template, with words of their own
        words = long[r.randint(0, 3) : 40 - r.randint(0, 3)] + [f"q{i}w{k}" for k in range(r.choice([0, 2, 5, 9]))]
        rows.append(" ".join(words))
    rows = list(dict.fromkeys(rows))
    r.shuffle(rows)
    rows = list(enumerate(rows))
    met, split = [], links.split

    def seen(*args):
        found, rest = split(*args)
        met.append(rest.distinct().count())
        return found, rest

    monkeypatch.setattr(links, "split", seen)
    got = links.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r.id: r.component_id for r in got.select("id", "component_id").collect()} == components(rows)
    assert met[0] < 150 * 149 / 4, met


@pytest.mark.parametrize("paired", [4096, 0])
def test_near_copies_that_meet_in_many_regions(spark, monkeypatch, paired):
    """Copies of one text with up to two fifths of the words changed: links, chains and texts apart."""
    monkeypatch.setattr(links, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    monkeypatch.setattr(links, "LEAF", 3)
    r = random.Random(9)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(110):
        at = r.randrange(120)
        span = r.choice([0, 3, 8, 14, 20, 30])  # changed words in a run, some elsewhere
        rows.append(" ".join(f"c{i}x{k}" if at <= k < at + span or r.random() < r.choice([0, 0.01, 0.02]) else w for k, w in enumerate(base)))
    rows = list(enumerate(dict.fromkeys(rows)))
    want = components(rows)
    assert 3 < len(set(want.values())) < len(rows) - 20
    got = links.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r.id: r.component_id for r in got.select("id", "component_id").collect()} == want


def test_bitmaps_of_several_sizes_bound_the_difference():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 1 << 62, n).astype(np.uint64)) for n in (10, 100, 100, 400)]
    sets.append(np.union1d(sets[3][:380], sets[1][:5]))
    maps = links._bitmaps(pa.chunked_array([pa.array([links.parity(x, links.NARROW) for x in sets])]))
    for i in range(5):
        for j in range(5):
            assert np.bitwise_count(maps[i] ^ maps[j]).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_small_tables_of_the_join_have_few_tasks(spark, monkeypatch):
    """With a task for each of 12 partitions, every table that is kept was as many files."""
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "u long, v long").repartition(6)
    tasks, kept = [], links.kept

    def seen(df):
        out = kept(df)
        tasks.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(links, "kept", seen)
    held = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert {r.set_id: r.root for r in links.classes(edges).collect()} == {i + 1: 0 for i in range(40)}
        assert links.fewer(spark.range(40).repartition(8), 40 * links.TASK_ROWS).rdd.getNumPartitions() == 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(tasks) > 2 and set(tasks) == {1}, tasks


def test_pairs_of_a_leaf_that_bitmaps_rule_out_stay_in_its_task():
    r = np.random.default_rng(7)
    sets = [np.unique(r.integers(0, 1 << 62, n).astype(np.uint64)) for n in (300, 310, 90, 100, 1200)]
    sets += [np.union1d(sets[0][5:], sets[1][:4]), sets[3][2:], sets[4][100:]]
    n = [len(x) for x in sets]
    table = pa.table({
        "region": [1] * 8, "s": list(range(8)), "n": pa.array(n, pa.int32()), "core": [True] * 8, "d": [0.0] * 8,
        "bits": [links.parity(x, links.NARROW) for x in sets],
    })
    got = links._leaf_pairs(75, 0.25)(table)
    # no pair but the three that link is left open
    assert {(a, b) for a, b in zip(got["a"].to_pylist(), got["b"].to_pylist())} == {(0, 5), (3, 6), (4, 7)}
    differ = links.differing(table["bits"])
    for i in range(8):
        each = differ(i, np.arange(8))
        assert all(each[j] <= len(np.setxor1d(sets[i], sets[j])) for j in range(8))


def test_every_letter_of_the_training_text_counts():
    r = random.Random(2)
    letters = [chr(0x4E00 + i) for i in range(4000)]
    # two languages in one script that differ in the order of letters only
    pairs = {"a": [x + y for x, y in zip(letters[::2], letters[1::2])], "b": [y + x for x, y in zip(letters[::2], letters[1::2])]}
    text = lambda lang, n: "".join(r.choice(pairs[lang]) for _ in range(n))
    train = {k: "".join(r.sample(v, len(v))) + text(k, 4000) for k, v in pairs.items()} | {"c": "abc xyz " * 40}
    model = languages.Model(train)
    lang = [x for x in "ab" for _ in range(20)]
    tests = [text(x, 30) for x in lang]
    assert model.predict(pa.array(tests), 512)[0] == lang
    some = {k: v[:900] for k, v in train.items()}  # all letters in the dense table, and few of them
    more = pa.array([*tests, "abc zzz 漢 xyz", "ああ", *(v[200:300] for v in some.values())])
    few, dense = (languages.Model(some, alphabet=n).phrases(more, 16)[0] for n in (5, 5000))
    assert np.array_equal(few, dense)


def test_every_training_row_trains_the_attention_model(spark, monkeypatch):
    docs = of_sources(spark, {"a": 60, "b": 30})
    held_out = docs.doc_id % 5 == 0
    trained, tokens, average, count_ids = [], [], scoring.average, scoring.count_ids

    def averaged(rows):
        rows = rows.cache()
        trained.extend(r.weight for r in rows.collect())
        return average(rows)

    def counted(*args):
        tokens.append(count_ids(*args))
        return tokens[0]

    monkeypatch.setattr(scoring, "average", averaged)
    monkeypatch.setattr(scoring, "count_ids", counted)
    assert scoring.scored(docs, held_out).count() == 90
    assert sum(trained) == sum(tokens[0].values()) > 0


def test_ranked_rows_move_once(spark):
    from pyspark.sql import functions as F

    from tilescope.llm.common import ranked

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
        got = ranked(df, ["g"], F.expr("id div 100"), [F.col("id")], "r", total="n")
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert {(r.id, r.r, r.n) for r in got.collect()} == {(i, i // 3, len(range(i % 3, 1000, 3))) for i in range(1000)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("leaf", [24, 4])
def test_only_pairs_that_may_link_become_candidates(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    r = random.Random(8)
    rows = []
    for g in range(40):
        base = [f"b{g}_{i}" for i in range(r.choice([30, 60, 90]))]
        for c in range(6):  # from near copies to texts with little in common
            cut_ = r.randrange(len(base))
            rows.append(" ".join(base[: cut_ if c % 2 else len(base) - c] + [f"x{g}_{c}_{i}" for i in range(r.randrange(2, 40))]))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    keyed = links._keyed(docs, "doc_id", "text")
    h, bounds = jaccard.shingle_sets(pa.array(rows), 5)
    sets = {s: h[a:b].tolist() for s, a, b in zip(jaccard.set_ids(h, bounds).tolist(), bounds, bounds[1:])}
    got = jaccard.regions(keyed, 5, 75, np.zeros(1 << jaccard.CELL_BITS, np.uint8), 3).collect()
    pairs = {(x.a, x.b) for x in got if x.b is not None}
    large = {}
    for x in got:
        if x.b is None:
            large.setdefault(x.region, {})[x.a] = x.core
    assert all(any(m.values()) for m in large.values())
    for a, b in pairs:  # what is left of both from some shared shingle on may reach the limit
        least = 3 / 7 * (len(sets[a]) + len(sets[b]))
        assert a < b and any(min(len(sets[s]) - 1.01 * sets[s].index(x) for s in (a, b)) >= least - 2 for x in set(sets[a]) & set(sets[b]))
    for a in sets:
        for b in sets:
            both = len(set(sets[a]) & set(sets[b]))
            if a < b and 4 * both >= 3 * (len(sets[a]) + len(sets[b]) - both):
                assert (a, b) in pairs or any(a in m and b in m and (m[a] or m[b]) for m in large.values())
