"""The corpus operators on small tables, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilescope.llm import attention, contamination, fingerprints, jaccard, languages, links, mixing, repeats, scoring, sharding, textkit, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = b" \t\n\r\x0b\x0c"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def texts(n=60, seed=3):
    """Random texts with copies, near copies, shared passages, blanks, nulls and one long text."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(r.choices(vocabulary, k=70))
    out = []
    for i in range(n):
        body = r.choices(vocabulary, k=r.randint(1, 120))
        kind = i % 8
        if kind == 1 and out:
            out.append(r.choice(out))
            continue
        if kind == 2 and out and (old := words(r.choice(out))):
            body = list(old)
            body[r.randrange(len(body))] = "changed"
        if kind == 3:
            body[len(body) // 2 : len(body) // 2] = passage.split()
        out.append(r.choice([" ", "\n", "  ", "\t"]).join(body))
    return [*out, "", None, "  \n", "One", "One", "two words", " ".join(r.choices(vocabulary, k=20_000)), "UPPER lower Été " * 9]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr"][i % 2], f"s{min(i % 7, 2)}", len(t or "")) for i, t in enumerate(texts())]
    rows += [(None, "null id text " * 8, None, None, 1), (5, rows[5][1], "en", "s0", 1)]  # a null id, a repeated row
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


def by_row(df, key="doc_id"):
    return {(r[key]): r for r in df.collect()}


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


# ---- words and hashes


def test_words_are_runs_between_ascii_blanks():
    data = ["a  b\tc", "", None, " x y \x1fz", "A é"]
    w = textkit.words_of(pa.array(data))
    got = [w.data[a:b].tobytes() for a, b in zip(w.starts, w.ends)]
    assert got == [x for t in data for x in (t or "").encode().split()]
    assert w.counts.tolist() == [len(words(t)) for t in data]
    assert len(textkit.words_of(pa.array([None, ""])).hashes) == 0


@pytest.mark.parametrize("k", [1, 2, 5, 13, 50])
def test_window_hash_tells_windows_apart(k):
    r = np.random.default_rng(k)
    h = textkit.mix(r.integers(0, 3, 300).astype(np.uint64))
    got = textkit.window_hash(h, k)
    seen = defaultdict(set)
    for i in range(300 - k + 1):
        seen[tuple(h[i : i + k])].add(int(got[i]))
    assert all(len(x) == 1 for x in seen.values()) and len(set().union(*seen.values())) == len(seen)


# ---- 10 and 5: repeated passages


def brute_repeats(rows, k):
    first = {}
    for i, t in rows:
        if i is not None:
            w = words(t)
            for a in range(len(w) - k + 1):
                g = tuple(w[a : a + k])
                first[g] = min(first.get(g, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for a in range(len(w) - k + 1):
            if i is not None and first[tuple(w[a : a + k])] < i:
                gone.update(range(a, a + k))
        out[i] = (len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone))
    return out


@pytest.mark.parametrize("find, k", [(repeats.fixed_block_anchors, 13), (repeats.sparse_suffixes, 50), (repeats.fixed_block_anchors, 6)])
def test_repeats_match_brute_force(docs, find, k):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_repeats(rows, k)
    found = find(docs.select("doc_id", "text", "lang"), k=k).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id]
        assert sum(s.words for s in r.spans) == r.n_removed
    assert any(r.n_removed for r in found)


def test_repeats_keep_other_columns_and_take_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c", 7), (2, None, 8)], "doc_id long, text string, n_words int")
    got = by_row(repeats.fixed_block_anchors(df))
    assert got[1].n_words == 3 and got[2].n_words == 0  # our column replaces one of its name
    assert repeats.sparse_suffixes(empty(spark)).count() == 0
    assert repeats.fixed_block_anchors(empty(spark)).count() == 0


# ---- 8: Jaccard join


def sets(text, k=5):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_classes(rows):
    s = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [(d, len(s[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)]


def test_jaccard_classes_match_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = links.jaccard_classes(docs).select("id", "n_shingles", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_classes(rows)))


@pytest.mark.parametrize("leaf", [2, 5])
def test_large_regions_split_by_document_pivots(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(links, "LEAF", leaf)
    r = random.Random(leaf)
    rows = []
    for g in range(3):
        body = [f"g{g}x{i}" for i in range(60)]
        for i in range(30):  # chains that drift away from their start
            body = list(body)
            for _ in range(r.randint(1, 2)):
                body[r.randrange(len(body))] = f"n{g}{i}{r.random()}"
            rows.append((len(rows), " ".join(body)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = links.jaccard_classes(df).select("id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_classes(rows))
    assert len({x[2] for x in brute_classes(rows)}) >= 3


def test_jaccard_empty_table_and_stage(spark, docs):
    assert links.jaccard_classes(empty(spark)).count() == 0
    stayed = [r.doc_id for r in links.one_per_class(spark, docs, "").collect()]
    want = {c if c is not None else None for d, n, c in brute_classes([(r.doc_id, r.text) for r in docs.collect()]) if n}
    blank = [r.doc_id for r in docs.collect() if not words(r.text)]
    assert sorted(map(str, stayed)) == sorted(map(str, [*want, *blank]))


# ---- 3: decontamination


def test_decontamination_matches_brute_force(spark, docs):
    import regex

    cut = lambda t: [x for x in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if x]
    all_texts = [r.text for r in docs.collect()]
    items = [(1, " ".join(words(all_texts[3])[:40])), (2, "nothing like it in there at all"), (3, "two, WORDS"), (4, ""), (5, None)]
    items += [(6, " ".join(words(all_texts[3])[:30] + ["zz"] * 5)), (2, "One")]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in items:
        w = cut(t)
        k = min(5, len(w))
        s = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if w else set()
        for r in docs.collect():
            d = cut(r.text)
            c = len(s & {tuple(d[a : a + k]) for a in range(len(d) - k + 1)})
            if s and 100 * c >= 75 * len(s):
                want.add((r.doc_id, i, len(s), c))
    for limit in (1_000_000, 0):  # broadcast and shuffled
        got = contamination.contaminated(docs, table, limit=limit)
        assert {(r.doc_id, r.item_id, r.item_shingles, r.shared) for r in got.collect()} == want
        assert got.count() == len(want)
    assert contamination.contaminated(empty(spark), table).count() == 0
    assert contamination.contaminated(docs, empty(spark, "item_id long, text string")).count() == 0


# ---- 6: language


def test_phrases_match_a_plain_parse():
    r = random.Random(1)
    text = lambda letters, n: "".join(r.choice(letters + " ") for _ in range(n))
    train = {"a": languages.reduced(text("abc", 300)), "b": languages.reduced(text("cde", 300))}
    model = languages.Model(train)
    tests = [text("abcde", 90), "", None, "12 !", "xyz", text("abc", 400)]
    count, chars = model.phrases(pa.array(tests), 64)
    for i, t in enumerate(tests):
        t = "".join(c if c.isalpha() else " " for c in (t or ""))
        t = " ".join(t.split()) + " " * bool(t.strip() and (t[-1] == " " or True))
        assert chars[i] in (len(t), max(0, len(t) - 1))
        for k, lang in enumerate(model.languages):
            want = 0
            for at in range(0, int(chars[i]), 64):
                block, j = t[: int(chars[i])][at : at + 64], 0
                while j < len(block):
                    n = 1
                    while j + n <= len(block) and block[j : j + n] in train[lang]:
                        n += 1
                    j += max(1, n - 1)
                    want += 1
            assert count[k, i] == want, (i, lang)


def test_language_accuracy_on_held_out_rows(spark):
    got = languages.op6_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, docs):
    model = languages.fit(docs)
    got = languages.identify(docs.withColumn("score", docs.n_chars), model).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert languages.identify(empty(spark), languages.fit(empty(spark))).count() == 0
    assert {r.lang_pred for r in languages.identify(docs, languages.fit(empty(spark))).collect()} == {"und"}


# ---- 1 and 4: mixing, sharding


def test_schedule_meets_every_deadline():
    for weights in ([5, 3, 2], [1] * 7, [90, 5, 3, 2], [1]):
        q = mixing.shares(weights, 100)
        assert sum(q) == 100 and min(q) >= 1
        given = Counter()
        for s, k, slot, release, due in mixing.schedule(q):
            assert release <= slot < due and given[s] == k
            given[s] += 1
            assert all(abs(given[x] - q[x] * (slot + 1) / 100) < 1 for x in range(len(q)))


@pytest.mark.parametrize("repeat", [True, False])
def test_mixing_uses_every_row_and_keeps_the_weights(spark, docs, repeat):
    got = mixing.mixed(docs, block_rows=3, period=20, repeat=repeat).collect()
    key = lambda r: str((r.doc_id, r.text))
    assert set(map(key, got)) == set(map(key, docs.collect()))
    if not repeat:
        assert len(got) == docs.count()
    slots = defaultdict(set)
    for r in got:
        slots[r.slot].add((r.source, r.block))
    assert all(len(x) == 1 for x in slots.values())
    weight = {r.source: r.weight for r in got}
    if repeat:
        assert sorted(slots) == list(range(len(slots)))
        given = Counter()
        for t in range(len(slots)):
            given[next(iter(slots[t]))[0]] += 1
            assert all(abs(given[s] - w * (t + 1)) < 1 for s, w in weight.items())
    assert mixing.mixed(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(docs, weights={"s0": 1.0})


def test_sharding_law_and_mixture(spark, docs):
    got = sharding.sharded(docs, shards=4).collect()
    assert len(got) == docs.count()
    count = Counter(r.shard for r in got)
    assert max(count.values()) - min(count.values()) <= 1
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))
        for source, n in Counter(r.source for r in got).items():
            assert abs(sum(r.source == source and r.shard == s for r in got) - n / 4) <= 2
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert sharding.sharded(empty(spark)).count() == 0


# ---- 7: fingerprints


def test_fingerprints(spark, docs):
    rows = [(r.doc_id, r.text or "") for r in docs.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = by_row(fingerprints.fingerprinted(df))
    order = sorted(rows)
    print_of = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert print_of.setdefault(t, r.fingerprint) == r.fingerprint
        print_of.setdefault(edited, r.edited_fingerprint)
        assert print_of[edited] == r.edited_fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.1
    one = fingerprints.fingerprinted(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first()
    assert one.near_next == 1.0
    assert fingerprints.fingerprinted(empty(spark)).count() == 0
    assert fingerprints.fingerprinted(docs).count() == docs.count()


def test_fingerprint_feels_order_and_occurrence(spark):
    base = [f"w{i}" for i in range(60)]
    turned = base[30:] + base[:30]
    data = [(1, " ".join(base)), (2, " ".join(turned)), (3, " ".join(base[::-1])), (4, " ".join(base + base))]
    df = fingerprints.with_signature(spark.createDataFrame(data, "doc_id long, text string"), "text", "own")
    own = {r.doc_id: set(r.own) for r in df.collect()}
    like = lambda a, b: len(own[a] & own[b]) / max(len(own[a]), len(own[b]))
    assert like(1, 2) < 0.9 and like(1, 3) < 0.2 and like(1, 4) < 0.9


# ---- 9: WARC


def test_warc_round_trip(spark, tmp_path):
    big = "x" * 3000
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/3", "é" * 500), (4, "u", "é" * 500), (5, "u", "same"), (6, "u", "same")]
    rows += [(7, "u", ""), (8, "u", None), (None, "u", big), (9, "a\r\nb", "WARC/1.1\r\n\r\n" * 200), (10, "u", "\n" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(warc.classified(pages, "page_id", "html", 1000), folder)
    assert sum(r.records for r in manifest.collect()) == len(rows)
    chunks = warc.read_chunks(manifest, folder, chunk_bytes=1000).collect()
    body = defaultdict(dict)
    for c in chunks:
        body[c.record_id][c.chunk_no] = c
    for page, _, html in rows:
        parts = [body[page][i] for i in range(len(body[page]))]
        raw = (html or "").encode()
        last = parts[-1]
        assert last.last and not any(p.last for p in parts[:-1]) and all(len(p.data) <= 1000 for p in parts)
        twins = [i for i, _, h in rows if h == html and len(raw) >= 1000 and i is not None]
        if twins and page != max(twins):
            assert last.record_type == "revisit" and last.refers_to == max(twins) and last.declared_bytes == len(raw)
            assert last.declared_digest == hashlib.sha1(raw).hexdigest()
        else:
            assert last.record_type == "response" and last.refers_to is None
            assert b"".join(p.data for p in parts) == raw and last.digest == hashlib.sha1(raw).hexdigest()
            at = 0
            for p in parts:
                at += len(p.data)
                assert p.digest == hashlib.sha1(raw[:at]).hexdigest()
    none = warc.classified(empty(spark, "page_id long, url string, html string"), "page_id", "html", 1000)
    m = warc.write_archives(none, folder + "2")
    assert m.count() == 0 and warc.read_chunks(m, folder + "2").count() == 0


# ---- 2: language model


def test_attention_derivatives():
    net = attention.Attention(6, width=4, context=5, seed=3)
    r = np.random.default_rng(0)
    ids, targets = r.integers(0, 7, (3, 5)), r.integers(0, 6, (3, 5))
    mask = r.random((3, 5)) < 0.7
    net.p = {n: x.astype(np.float64) for n, x in net.p.items()}
    _, g = net.gradients(ids, targets, mask)
    for name, p in net.p.items():
        at = tuple(r.integers(0, s) for s in p.shape)
        old, h = p[at], 1e-5
        p[at] = old + h
        up = net.gradients(ids, targets, mask)[0]
        p[at] = old - h
        down = net.gradients(ids, targets, mask)[0]
        p[at] = old
        assert abs((up - down) / (2 * h) - g[name][at]) < 1e-4, name


def test_attention_is_causal_and_normalised():
    net = attention.Attention(6, context=8)
    r = np.random.default_rng(1)
    ids = r.integers(0, 6, (1, 8))
    other = ids.copy()
    other[0, 5:] = (other[0, 5:] + 1) % 6
    rows = [np.exp(net.log_probs(ids, np.full((1, 8), c))) for c in range(6)]
    assert np.allclose(sum(rows), 1, atol=1e-5)
    assert np.allclose(net.log_probs(ids, ids)[0, :5], net.log_probs(other, ids)[0, :5])


def test_windows_score_each_token_once():
    for sizes in ([0, 1, 31, 32, 33, 60, 61, 500], [7], []):
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        classes = np.arange(first[-1]).astype(np.int32)
        before, targets, mask, flat = attention.windows(classes, first, 32, 28, -1)
        assert sorted(flat[mask].tolist()) == list(range(first[-1]))
        assert (targets[mask] == classes[flat[mask]]).all()
        starts = set(first[:-1].tolist())
        for f, b in zip(flat[mask], before[mask]):
            assert b == (-1 if f in starts else f - 1)


def test_scores_match_brute_force(spark, docs):
    held = docs.doc_id % 7 == 2
    got = scoring.scored(docs, held, rounds=1, every=1).collect()
    assert len(got) == docs.count()
    low = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + [None]
    count = Counter()
    for r in docs.collect():
        if r.doc_id is not None and r.doc_id % 7 != 2:
            count.update(low(r.text))
    n, v = sum(count.values()), len(count)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        t = low(text[r.doc_id])
        assert r.held_out == (r.doc_id is not None and r.doc_id % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(sum(np.log10((count[x] + 1) / (n + v + 1)) for x in t))
        assert r.score < 0
    assert scoring.scored(empty(spark), F.col("doc_id") == 1).count() == 0


def test_training_helps_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = scoring._rows(docs, "doc_id", "text", docs.doc_id % 7 == 2)
    total = []
    for rounds in (0, 1):
        model = scoring.fit(rows, scoring.TOKENIZER, 32, 28, rounds, 4)
        coder = scoring.Subwords(scoring.TOKENIZER)
        held = [r.text for r in rows.where("held_out").limit(60).collect()]
        total.append(model.score(*coder.ids(textkit.words_of(pa.array(held), lower=True))).sum())
    assert total[1] > 0.95 * total[0] and total[1] > total[0]
