"""Packing, spelling variants and the filter audit, against brute force."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilescope.llm import audit, packing, variants

DOCS = "doc_id long, text string, source string, word string, n long, leaf string, rep long, tag long"  # names used inside clash


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, s, "x", 1, "x", 1, 1) for i, t, s in rows], DOCS).repartition(parts)


# ---- packing


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def texts(seed=5):
    r = random.Random(seed)
    stems = ["and", "the", "öffnen", "queeau", "don't", "A.B,", "12a", "<|endoftext|>", "Σας", "é"]
    out = [r.choice([" ", "\n", "\t "]).join(r.choices(stems, k=r.choice([1, 7, 300, 900, 5000]))) for _ in range(40)]
    return [*out, out[0], "", None, " \n ", "x" * 3000, " ".join(r.choices(stems, k=40_000))]


def test_ids_are_those_of_whole_texts(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    data = texts()
    ids, bounds = packing.encoded(tokenizer, pa.array(data, pa.string()))
    for i, t in enumerate(data):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
    ids, bounds = packing.encoded(tokenizer, pa.array([], pa.string()))
    assert len(ids) == 0 and bounds.tolist() == [0]


def test_pieces_cover_every_id_once_without_padding(spark, vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    data = texts()
    docs = table(spark, [*[(i, t, "s") for i, t in enumerate(data)], (None, "null id", None)])
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in enumerate(data)}
    ids[None] = np.array(tokenizer.encode("null id", add_special_tokens=False).ids + [1], "<u4")
    rows = packing.packed(docs, vocabulary, max_open=3).collect()
    at, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(at) == set(ids)
    for group, whole in [*((at[i], len(ids[i])) for i in ids), *((s, None) for s in sequences.values())]:
        place = 0
        for start, length in sorted(group):
            assert start == place
            place += length
        if whole is None:
            assert place == 2048 or place & (place - 1) == 0 and place < 2048
        else:
            assert place == whole
    assert packing.packed(docs.limit(0), vocabulary).count() == 0


def test_level_has_the_least_sum_of_squares():
    r = np.random.default_rng(2)
    packer = packing.Packer(size=24)
    for _ in range(400):
        packer.counts[1:] = r.integers(0, 3, 23)
        rest = int(r.integers(1, 24))
        costs = {}
        for h in range(24 - rest + 1):
            if h and not packer.counts[h]:
                continue
            after = packer.counts.copy()
            if h:
                after[h] -= 1
            if h + rest < 24:
                after[h + rest] += 1
            costs[h] = int((after**2).sum())
        assert packer.level(rest) == max(h for h in costs if costs[h] == min(costs.values()))


def test_windows_stay_few_when_no_two_documents_fit():
    packer = packing.Packer(size=64, max_open=10)
    for i in range(1000):
        packer.add(i, np.full(33, i, "<u4"))
        assert packer.left <= 10
    packer.flush()
    assert sum(r[2] for r in packer.rows) == 33_000


# ---- spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def spellings(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def written(seed=8):
    r = random.Random(seed)
    letters = "abÀé÷"
    stems = ["".join(r.choices(letters, k=r.randint(6, 12))) for _ in range(25)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(40):
            w = stems[int(25 * r.random() ** 3)]
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1 :]])
            words += [w] * r.choice([1, 1, 1, 12])
        rows.append((i, r.choice([" ", "-", "1", "ß ", "ŵ"]).join(words)))
    rows += [(i, "chainaaaa " * 3000 + "chainaaab " * 200 + "chainaabb " * 10 + "chainabbb ") for i in range(70, 74)]
    return [*rows, rows[0], (None, "Aaaaaaaa bbbbbbbb aaaaaaaa"), (61, None), (62, ""), (63, "aé" * 5000 + " " + "aé" * 5000 + "b " + "aé" * 5000)]


@pytest.mark.parametrize("block", [1 << 16, 4])
def test_variants_are_those_of_all_pairs(spark, block):
    rows = written()
    docs = table(spark, [(i, t, "s") for i, t in rows])
    want = spellings(rows)
    assert sum(v[3] > 1 for v in want.values()) > 50 and any(v[0] and v[1] != v[0] for v in want.values())
    got = variants.grouped(variants.vocabulary(docs, noise=31), block=block).collect()
    assert len(got) == len(want)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want


def test_variants_of_nothing(spark):
    docs = table(spark, [(1, None, "s"), (2, "too short", "s")])
    assert variants.grouped(variants.vocabulary(docs)).count() == 0
    assert variants.grouped(variants.vocabulary(docs.limit(0))).count() == 0


def test_suffixes_are_sorted():
    r = np.random.default_rng(1)
    for n in (1, 2, 9, 400):
        text = np.append(r.integers(1, 3, n), 0)
        want = sorted(range(n + 1), key=lambda i: text[i:].tolist())
        assert variants.suffix_array(text).tolist() == want


def test_a_step_on_either_side_keeps_both_intervals():
    words = sorted({"".join(p).encode() for p in itertools.product("abc", repeat=4)})
    book = variants.Dictionary(words)
    body = b"|" + b"|".join(words) + b"|"
    for pattern in (b"ab", b"bca", b"|ab", b"c|a", b"|abca|"):
        codes = [book.letters[10] if c == 124 else book.letters[c] for c in pattern]
        low, back, size = (np.array([v]) for v in (0, 0, book.size))
        for c in reversed(codes):
            low, less, size = book.forward.step(low, size, np.array([c]))
            back = back + less
        b, f, s = np.array([0]), np.array([0]), np.array([book.size])
        for c in codes:
            b, less, s = book.backward.step(b, s, np.array([c]))
            f = f + less
        assert (low[0], back[0], size[0]) == (f[0], b[0], s[0])
        assert size[0] == sum(body.startswith(pattern, i) for i in range(len(body)))


# ---- filter audit


def audited(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    failed = []
    for i, t, s in rows:
        t = t or ""
        words = t.encode().split()
        f = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and least[t] < i,
        }
        failed.append((s or "", i, {k for k in f if f[k]}))
    out = {}
    for part in {f[0] for f in failed}:
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for step, k in enumerate(order):
                row = Counter()
                for _, i, bad in (f for f in failed if f[0] == part):
                    before = bad & set(order[:step])
                    row["kept"] += not bad & set(order[: step + 1])
                    row["redundant"] += k in bad and bool(before)
                    row["unique_fails"] += bad == {k}
                    if k in bad and not before:
                        row["removed"] += 1
                        row["good_lost"] += i in good
                        row["toxic_lost"] += i in toxic
                shapley[k] += row["removed"]
                out[part, "".join(order), step + 1] = row
        for (p, order, step), row in out.items():
            if p == part:
                row["shapley"] = shapley[order[step - 1]]
    return out


def documents():
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(90)] + ["UP", "Aé", "a|b", "$"]
    rows = []
    for i in range(90):
        t = " ".join(r.choices(vocabulary[: r.choice([5, 90, 90, 94])], k=r.choice([3, 60, 80])))
        rows.append((i, r.choice(rows)[1] if rows and r.random() < 0.3 else t, r.choice(["a", "b", None, ""])))
    long = "same start " * 3000
    return [*rows, (100, None, "a"), (101, "", "a"), (90, "", "b"), (None, rows[0][1], "a"), rows[3], (102, long, "a"), (103, long + "x", "a"), (7, long, "b")]


LABELS = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 95, 2)] + [(4, 1, 0), (6, None, None), (None, 1, 1), (999, 1, 1)]


@pytest.mark.parametrize("leaf", [1 << 24, 100])
def test_audit_counts_every_order(spark, leaf):
    labels = spark.createDataFrame([(*x, "clash") for x in LABELS], "doc_id long, quality long, toxic long, source string")
    rows = documents()
    got = audit.audited(table(spark, rows, 7), labels, leaf_bytes=leaf).collect()
    want = audited(rows, LABELS)
    assert len(got) == len(want)
    for r in got:
        row = want[r.part, r.filter_order, r.step]
        assert all(r[c] == row[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")), r


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert audit.audited(table(spark, documents()).limit(0), labels).count() == 0
    assert audit.audited(table(spark, documents()), labels).agg(F.sum("good_lost")).first()[0] == 0


def test_prefixes_divide_until_light_or_one_text(spark):
    r = random.Random(3)
    data = ["licence text that all share, " * 20 + "".join(r.choices("ab", k=30)) for _ in range(300)] + ["one text\n" * 50] * 200
    texts = spark.createDataFrame([(t,) for t in data], "text string").select(F.xxhash64("text").alias("tag"), "text")
    heavy, total = audit.prefixes(texts, 5000)
    assert total == sum(map(len, data))
    size, kinds = Counter(), defaultdict(set)
    for t in data:
        leaf, _ = audit.leaf_of(t, heavy)
        size[leaf] += len(t)
        kinds[leaf].add(t)
    assert all(n <= 5000 or len(kinds[leaf]) == 1 for leaf, n in size.items())


def test_tries_return_all_but_the_least_of_equal_texts():
    r = random.Random(6)
    rows = [("".join(r.choices("ab", k=r.randint(0, 6))), i) for i in range(300)]
    r.shuffle(rows)
    trie = audit.Trie()
    for t, i in rows:
        trie.insert(t, i, (i, 0))
    assert {i for i, _ in trie.beaten()} == {i for t, i in rows if any(u == t and j < i for u, j in rows)}
