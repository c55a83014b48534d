"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds labelled text.  A text is parsed
greedily into the longest phrases that occur in that training text; the language
whose phrases are longest, so whose count of phrases times log2(training size)
per character is least, wins.

Text is reduced to lower-case letters with one blank between words.  Parsing runs
over blocks of ``block`` characters (a phrase ends where a block ends), many
blocks in step, through one transition table per language, so a task needs
the tables and one slice of text and nothing that grows with the corpus.  Every letter
of the training text has a code: the transitions of the most frequent ``alphabet``
letters are in a dense table, those of all others in a sorted list of (state, letter).

The labelled sample is bounded: ``sample_docs`` documents a language, in the order of
a hash of the id, up to ``train_chars`` reduced characters.  Documents of over
``sample_length`` characters come after all others and give so many characters.  The
automata are built on the driver from it.

Nulls, empty texts and texts without a letter are ``und`` with score 0.  Repeated
rows are predicted alike; of rows with one id and language the least text is learned from.  A null id is neither held out nor learned from.  An
empty table gives no rows; without any label everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilescope.llm.common import fold, widened, wrapped
from tilescope.llm.textkit import slices, text_array

UNKNOWN = "und"
ALPHABET = 120  # letters in the dense table, if it has room for them
TABLE_BYTES = 160 << 20  # of the dense table


def letter_codes() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: 1 if it is a letter, and the code point of its lower case."""
    low = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            letter[c] = True
            t = s.lower()
            if len(t) == 1:
                low[c] = ord(t)
    return letter, low


def reduced(text: str) -> str:
    """Lower-case letters, one blank between the runs of them."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the automaton of all factors of ``text``; state 0 is the root."""
    nxt: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for ch in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and ch not in nxt[p]:
            nxt[p][ch] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][ch]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(ch) == q:
                    nxt[p][ch] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


def transitions(text: str) -> tuple[int, np.ndarray]:
    """States of the suffix automaton of ``text``, and (state, code point, next state) of its transitions."""
    auto = suffix_automaton(text)
    rows = [(s, ord(c), to) for s, steps in enumerate(auto) for c, to in steps.items()]
    return len(auto), np.array(rows, np.int64).reshape(-1, 3)


class Model:
    """Parsing tables of all languages: code of each code point, and next state and phrases by state and code.

    ``alphabet`` letters have a column in the dense table of all states, by default so many
    that it takes ``TABLE_BYTES`` at most.  It only saves time.
    """

    def __init__(self, texts: dict[str, str], alphabet: int | None = None):
        self.languages = sorted(texts)
        automata = [transitions(texts[k]) for k in self.languages]
        seen: dict[str, int] = {}
        for t in texts.values():
            for c in t:
                if c != " ":
                    seen[c] = seen.get(c, 0) + 1
        chars = sorted(sorted(seen), key=lambda c: -seen[c])
        if alphabet is None:
            alphabet = min(ALPHABET, max(0, TABLE_BYTES // (4 * max(1, sum(n for n, _ in automata))) - 2))
        code = {" ": 0} | {c: i + 1 for i, c in enumerate(chars[:alphabet])}
        self.width = len(code) + 1  # the last dense code: letters that no training text has
        # letters beyond the dense table follow
        code |= {c: self.width + i for i, c in enumerate(chars[alphabet:])}
        self.letters = self.width + len(chars[alphabet:])
        letter, low = letter_codes()
        table = np.zeros(0x110000, np.int32)
        of = np.full(0x110000, self.width - 1, np.int32)
        for c, i in code.items():
            of[ord(c)] = i
        table[letter] = of[low[letter]]
        self.codes = table
        parts, base = [], []
        at = states = 0
        first, keys, steps_to = [], [], []  # of the sparse part: a language's first state, (state, letter) and next state
        self.roots = np.full((len(self.languages), self.letters - self.width), -1, np.int32)
        for k, (size, steps) in enumerate(automata):
            state, symbol, to = steps[:, 0], of[steps[:, 1]].astype(np.int64), steps[:, 2]
            t = np.full((size, self.width), -1, np.int64)
            dense = symbol < self.width
            t[state[dense], symbol[dense]] = to[dense]
            keys.append((states + state[~dense]) * self.letters + symbol[~dense])
            steps_to.append(to[~dense].astype(np.int32))
            start = ~dense & (state == 0)
            self.roots[k, symbol[start] - self.width] = to[start]
            first.append(states)
            states += size
            root = t[0].copy()
            # the phrase ends before this character; a character unknown to the language is one more
            restart = np.where(root >= 0, root * 4 + 1, 2)
            full = np.where(t >= 0, t * 4, restart[None, :])
            full[0] = np.where(root >= 0, root * 4, 1)
            parts.append(full.astype(np.int32).ravel())
            base.append(at)
            at += full.size
        self.bits = np.array([np.log2(max(2, len(texts[k]))) for k in self.languages])
        # a character of random letters and blanks
        self.random = np.array([np.log2(max(2, len(set(texts[k])))) for k in self.languages])
        self.table = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.base = np.array(base, np.int64)[:, None]
        self.first = np.array(first, np.int64)[:, None]
        keys, steps_to = (np.concatenate([np.zeros(0, x), *c]).astype(x) for c, x in ((keys, np.int64), (steps_to, np.int32)))
        order = np.argsort(keys)
        self.keys, self.steps_to = keys[order], steps_to[order]

    @classmethod
    def of(cls, tables: dict) -> Model:
        """The model whose ``vars`` these are, so that only plain arrays are broadcast."""
        out = cls.__new__(cls)
        out.__dict__.update(tables)
        return out

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next states (times 4, plus the phrases that end) by language and text."""
        rare = np.flatnonzero(code >= self.width)
        if not len(rare):
            return self.table[self.base + state * self.width + code]
        out = self.table[self.base + state * self.width + np.minimum(code, self.width - 1)]
        at, code = state[:, rare], code[rare]
        key = (self.first + at) * self.letters + code
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        root = self.roots[:, code - self.width]
        ends = np.where(root >= 0, root * 4 + (at > 0), 1 + (at > 0))
        out[:, rare] = np.where(self.keys[place] == key, self.steps_to[place] * 4, ends)
        return out

    def phrases(self, column: pa.Array, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by language and document, and reduced characters of each document."""
        return self.parse(column, block)[:2]

    def parse(self, column: pa.Array, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``phrases`` gives, and each document's bits if every block takes its own best language."""
        texts = text_array(column).to_pylist()
        n_docs = len(texts)
        points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t) + 1 for t in texts], np.int64)
        code = self.codes[points]
        keep = code > 0
        keep[1:] |= (code[1:] == 0) & (code[:-1] > 0)  # one blank after each run of letters
        ends = np.cumsum(size)
        have = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
        code = code[keep].astype(np.int64)
        chars = np.diff(have)
        count = np.zeros((len(self.languages), n_docs), np.int64)
        blocks = -(-chars // block)
        doc = np.repeat(np.arange(n_docs), blocks)
        if not len(doc) or not self.languages:
            return count, chars, np.zeros(n_docs)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = have[:-1][doc] + nth * block
        length = np.minimum(block, have[1:][doc] - start)
        order = np.argsort(-length, kind="stable")
        start, length, doc = start[order], length[order], doc[order]
        active = np.searchsorted(-length, -np.arange(int(length[0])), "left")
        state = np.zeros((len(self.languages), len(doc)), np.int64)
        found = np.zeros_like(state, dtype=np.int32)
        for t, m in enumerate(active):
            step = self.step(state[:, :m], code[start[:m] + t])
            state[:, :m] = step >> 2
            found[:, :m] += step & 3
        found += state > 0  # the phrase that the end cuts
        for k in range(len(self.languages)):
            count[k] = np.bincount(doc, found[k], n_docs).astype(np.int64)
        return count, chars, np.bincount(doc, (found * self.bits[:, None]).min(0), n_docs)

    def predict(self, column: pa.Array, block: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, mean phrase length and excess bits of each text."""
        count, chars, least = self.parse(column, block)
        some = chars > 0
        if not self.languages:
            nothing = np.zeros(len(chars))
            return [UNKNOWN] * len(chars), nothing, nothing, nothing
        bits = count * self.bits[:, None]
        best = bits.argmin(0)
        # two-to-the-minus code lengths as odds, over at most 50 characters' worth of evidence
        gap = (bits - bits.min(0)) / np.maximum(chars, 1) * np.minimum(chars, 50)
        score = np.where(some, 1 / np.exp2(-np.minimum(gap, 1000)).sum(0), 0.0)
        phrase = np.where(some, chars / np.maximum(count.min(0), 1), 0.0)
        excess = np.where(some, least - chars * self.random[best], 0.0)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, some)], score, phrase, excess


def fit(labelled: DataFrame, train_chars: int = 30_000, sample_docs: int = 48, sample_length: int = 20_000) -> Model:
    """Learn from (doc_id, lang, text) rows; see the module's text for the bounds."""
    w = Window.partitionBy("lang").orderBy("_long", F.xxhash64("doc_id"), "doc_id")
    rows = labelled.where("lang is not null and doc_id is not null").where(F.length("text") > 0)
    rows = rows.select("lang", "doc_id", "text", (F.length("text") > sample_length).alias("_long"))
    # only ids are ranked; one text of each of the few chosen ones follows
    ids = rows.select("lang", "doc_id", "_long").distinct()
    chosen = ids.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= sample_docs).drop("_r")
    chosen = F.broadcast(chosen)  # languages * sample_docs rows at most
    body = F.substring("text", 1, sample_length)
    texts: dict[str, list[str]] = {}
    few = rows.join(chosen, ["lang", "doc_id", "_long"], "left_semi").groupBy("lang", "doc_id", "_long").agg(F.min(body).alias("text"))
    for r in sorted(few.collect(), key=lambda r: (r.lang, r._long, r.doc_id)):
        have = texts.setdefault(r.lang, [])
        if sum(map(len, have)) < train_chars:
            have.append(reduced(r.text))
    joined = {k: " ".join(x for x in v if x)[:train_chars] for k, v in texts.items()}
    return Model({k: v for k, v in joined.items() if v})


def identify(docs: DataFrame, model: Model, text: str = "text", block: int = 512) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), phrase_length (mean, in characters) and excess_bits.

    ``excess_bits`` is the length of the text's parse, each block in its best language, less
    that of as many random letters and blanks of the predicted one; text of the learned
    languages, also of several in turn, is far below 0.  Columns of those names in ``docs`` are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vars(model))  # TABLE_BYTES, and some 50 bytes for each character learned from
    added = ["lang_pred", "score", "phrase_length", "excess_bits"]
    base = docs.drop(*added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.of(shared.value)
        for batch in batches:
            for part in slices(batch, text):
                lang, *numbers = m.predict(part.column(text), block)
                new = [pa.array(lang, pa.string()), *[pa.array(x, pa.float64()) for x in numbers]]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *added])

    schema = widened(base.schema, "lang_pred string, score double, phrase_length double, excess_bits double")
    return base.mapInArrow(run, schema)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    rest = fold(F.col("doc_id"), 3)
    model = fit(docs.where(rest != 1))
    found = identify(docs.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "text"), model)
    return found.drop("text")


def keep_identified(spark, docs: DataFrame, sf_dir: str, margin_bits: float = 250.0) -> DataFrame:
    """Pipeline stage: documents without a letter go, and those in none of the learned languages.

    The latter are parsed, each block in its best language, into phrases no longer than
    those of random letters: their parse takes over ``margin_bits`` more than random
    letters and blanks would.  The margin spares texts too short to tell.  If no language could be
    learned, only the documents without a letter go.
    """
    model = fit(docs.where(fold(F.col("doc_id"), 3) != 1))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(wrapped(docs, text=F.col("text")), model)
    found = found.where(F.col("lang_pred") != UNKNOWN).where(F.col("excess_bits") <= margin_bits)
    return found.select("row.*")
