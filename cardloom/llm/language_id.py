"""Language ID (operator 1): a linear-chain conditional random field labels the words of code-switched text.

Each word has affix, character n-gram and lexicon features; transitions between the labels of neighbouring words are learned
with them.  A text's language is the one with the largest share of posterior label mass (forward-backward) over its words with letters.
Training sequences are made by switching between whole labelled documents every few words.

The model is fitted on the driver from a bounded sample of every label: at most SAMPLE_DOCS documents of each, fewer where there are
many labels, drawn by a hash of the text, so that copies of a text count once however many they are, and SAMPLE_CHARS characters from
anywhere in each at most, fewer where there are many labels.  All counts behind the draw cover all rows, and predictions cover every whole text.

Defined results.  Null text, or one without a letter: `und`, score 0.  No labelled row at all: every text is `und`, score 0.  Ties
go to the label first in alphabetical order.  Repeated rows are predicted each.  Empty table: no rows.  Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import bounded_rows, trim_memory, with_small_batches

SAMPLE_DOCS = 150
SAMPLE_CHARS = 20_000
#: Documents and characters of the sample over all labels, as long as each label has LEAST_DOCS of LEAST_CHARS.  Beyond SOME_LANGUAGES
#: labels the characters shrink in proportion, as each word then has that many more posteriors.
SAMPLE_TOTAL = 64 * SAMPLE_DOCS
SAMPLE_TOTAL_CHARS = 24_000_000
SOME_LANGUAGES = 8
LEAST_DOCS, LEAST_CHARS = 8, 200
LEXICON_WORDS = 300
WEIGHTS = 1 << 16
EPOCHS = 50
#: Words of a stretch of one language in a training sequence, and words of a sequence.
STRETCH = (2, 12)
SEQUENCE = 240
#: Word types above which a worker starts anew (between batches), and padded words it handles at once, of models of up to
#: MANY_LANGUAGES labels; of larger models so many fewer that memory stays the same.
CACHE_WORDS = 60_000
PADDED = 200_000
MANY_LANGUAGES = 64
UNKNOWN = "und"


def core(word: str) -> str:
    """The word without marks and digits, in lower case; empty if it has no letter."""
    return word.lower() if word.isalpha() else "".join([c for c in word if c.isalpha()]).lower()


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _hashed(tag: int, *letters: np.ndarray) -> np.ndarray:
    h = np.full(letters[0].shape, tag * 0x94D049BB133111EB % (1 << 64), np.uint64)
    for letter, m in zip(letters, _MIX):
        h = (h ^ letter.astype(np.uint64)) * m
        h ^= h >> np.uint64(29)
    return ((h * _MIX[3]) >> np.uint64(48)).astype(np.int32) % WEIGHTS


def features(words: list[str], lexicon: dict[str, int], languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of cores, word after word, and the number of each word's: affixes up to three letters, inner bigrams and
    trigrams, and the languages whose lexicon has the word.  Array operations over words of like length."""
    lengths = np.array([len(w) for w in words])
    counts = np.zeros(len(words), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    width, low = 8, 0
    while low < lengths.max(initial=0):
        own = np.flatnonzero((lengths > low) & (lengths <= width))
        if len(own):
            some = [words[i] for i in own.tolist()]
            n = lengths[own][:, None]
            letters = np.array(some, dtype=f"<U{width}").view(np.uint32).reshape(len(own), width)
            at = np.arange(width)
            ends = [np.take_along_axis(letters, np.maximum(n - k, 0), axis=1) for k in (1, 2, 3)]
            blank = np.zeros_like(ends[0])
            columns = [
                _hashed(1, letters[:, :1]), np.where(n > 1, _hashed(2, letters[:, :1], letters[:, 1:2]), -1), np.where(n > 2, _hashed(3, letters[:, :1], letters[:, 1:2], letters[:, 2:3]), -1),
                _hashed(4, ends[0]), np.where(n > 1, _hashed(5, ends[1], ends[0]), -1), np.where(n > 2, _hashed(6, ends[2], ends[1], ends[0]), -1),
                np.where(at[1:] < n, _hashed(7, letters[:, :-1], letters[:, 1:]), -1), np.where(at[2:] < n, _hashed(8, letters[:, :-2], letters[:, 1:-1], letters[:, 2:]), -1),
            ]
            found = np.array([lexicon.get(w, 0) for w in some], dtype=object if languages > 62 else np.int64)[:, None]
            for k in range(languages):
                columns.append(np.where((found >> k & 1).astype(bool), _hashed(9, blank + np.uint32(k)), -1))
            grid = np.concatenate(columns, axis=1)
            valid = grid >= 0
            counts[own] = valid.sum(axis=1)
            parts.append((np.repeat(own, counts[own]), grid[valid]))
        low, width = width, 2 * width
    if not parts:
        return np.zeros(0, np.int32), counts
    order = np.argsort(np.concatenate([x for x, _ in parts]), kind="stable")
    return np.concatenate([x for _, x in parts])[order], counts


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # WEIGHTS x languages
    transitions: np.ndarray  # log scores, from x to
    first: np.ndarray
    lexicon: dict[str, int]  # word -> bit set of languages


def posterior(e: np.ndarray, active: np.ndarray, counted: np.ndarray, trans: np.ndarray, first: np.ndarray, collect: bool = False):
    """Forward-backward over padded sequences, longest first.  e: steps x sequences x labels, positive emissions; active: sequences
    that have a step; counted: steps x sequences, weights.  Returns the weighted sum of posteriors of each sequence (and all of them)."""
    steps, width, labels = e.shape
    alpha = np.zeros_like(e)
    scale = np.ones((steps, width), e.dtype)
    a = first * e[0]
    s = a.sum(axis=1, keepdims=True)
    alpha[0], scale[0] = a / s, s[:, 0]
    for t in range(1, steps):
        n = active[t]
        a = (alpha[t - 1, :n] @ trans) * e[t, :n]
        s = a.sum(axis=1, keepdims=True)
        alpha[t, :n] = a / s
        scale[t, :n] = s[:, 0]
    total = np.zeros((width, labels), e.dtype)
    every = np.zeros_like(e) if collect else None
    pairs = np.zeros((labels, labels)) if collect else None
    beta = np.ones((active[-1], labels), e.dtype)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if t < steps - 1:
            ahead = e[t + 1, : active[t + 1]] * beta
            if collect:
                pairs += trans * (alpha[t, : active[t + 1]].T @ (ahead / scale[t + 1, : active[t + 1], None]))
            back = (ahead @ trans.T) / scale[t + 1, : active[t + 1], None]
            beta = np.ones((n, labels), e.dtype)
            beta[: len(back)] = back
        p = alpha[t, :n] * beta
        p /= p.sum(axis=1, keepdims=True)
        total[:n] += p * counted[t, :n, None]
        if collect:
            every[t, :n] = p
    return total, every, pairs, scale


def _sequences(texts: list[tuple[str, str]], languages: list[str]) -> tuple[list[list[str]], list[list[int]]]:
    """Code-switched word sequences and their labels from (language, text)."""
    rng = np.random.default_rng(20240229)
    waiting: dict[int, list[list[str]]] = {}
    for lang, text in texts:
        words = [w for w in map(core, text.split()) if w]
        if words:
            waiting.setdefault(languages.index(lang), []).append(words)
    words, labels = [], []
    now_words: list[str] = []
    now_labels: list[int] = []
    lang = None
    while waiting:
        if lang is None or lang not in waiting or rng.random() < 0.9:
            lang = sorted(waiting)[int(rng.integers(len(waiting)))]
        n = int(rng.integers(*STRETCH))
        own = waiting[lang][-1]
        now_words += own[:n]
        now_labels += [lang] * len(own[:n])
        del own[:n]
        if not own:
            waiting[lang].pop()
            if not waiting[lang]:
                del waiting[lang]
        if len(now_words) >= SEQUENCE or not waiting:
            words.append(now_words)
            labels.append(now_labels)
            now_words, now_labels = [], []
    return words, labels


def train(texts: list[tuple[str, str]]) -> Model | None:
    """Maximum likelihood by Adam over whole passes; None without a labelled word."""
    languages = sorted({lang for lang, _ in texts})
    words, labels = _sequences(texts, languages)
    if not words:
        return None
    seen: dict[int, Counter] = {}
    for ws, ls in zip(words, labels):
        for w, k in zip(ws, ls):
            seen.setdefault(k, Counter())[w] += 1
    lexicon: dict[str, int] = {}
    for k, counts in seen.items():
        for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            lexicon[w] = lexicon.get(w, 0) | 1 << k
    types = {w: i for i, w in enumerate(sorted({w for ws in words for w in ws}))}
    flat, sizes = features(list(types), lexicon, len(languages))
    starts = np.cumsum(sizes) - sizes
    type_of = np.repeat(np.arange(len(types)), sizes)
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    steps, width, k = len(words[order[0]]), len(order), len(languages)
    ids, gold = np.zeros((steps, width), np.int64), np.full((steps, width), -1)
    for j, i in enumerate(order):
        ids[: len(words[i]), j] = [types[w] for w in words[i]]
        gold[: len(words[i]), j] = labels[i]
    real = gold >= 0
    active = real.sum(axis=1)
    counted = np.zeros((steps, width))
    truth = np.zeros((len(types), k))
    np.add.at(truth, (ids[real], gold[real]), 1)
    true_pairs = np.zeros((k, k))
    follow = real[1:]
    np.add.at(true_pairs, (gold[:-1][follow], gold[1:][follow]), 1)
    true_first = np.bincount(gold[0], minlength=k).astype(float)
    n = real.sum()
    model = [np.zeros((WEIGHTS, k)), np.zeros((k, k)), np.zeros(k)]
    m1, m2 = [np.zeros_like(x) for x in model], [np.zeros_like(x) for x in model]
    for epoch in range(1, EPOCHS + 1):
        weights, trans, first = model
        emission = np.add.reduceat(weights[flat], starts)
        e = np.exp(emission - emission.max(axis=1, keepdims=True))[ids]
        _, every, pairs, _ = posterior(e, active, counted, np.exp(trans), np.exp(first), collect=True)
        expected = np.zeros((len(types), k))
        for c in range(k):
            expected[:, c] = np.bincount(ids[real], every[..., c][real], minlength=len(types))
        off = truth - expected
        g = np.stack([np.bincount(flat, off[type_of, c], minlength=WEIGHTS) for c in range(k)], axis=1)
        grads = [g / n - 1e-7 * weights, (true_pairs - pairs) / n - 1e-4 * trans, (true_first - every[0].sum(axis=0)) / n - 1e-4 * first]
        for x, g, a, b in zip(model, grads, m1, m2):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x += 0.15 * (a / (1 - 0.9**epoch)) / (np.sqrt(b / (1 - 0.99**epoch)) + 1e-9)
    weights, trans, first = model
    return Model(languages, weights.astype(np.float32), trans, first, lexicon)


def sample_sizes(languages: int) -> tuple[int, int]:
    """Documents of each label in the sample, and characters of each document."""
    each = max(LEAST_DOCS, min(SAMPLE_DOCS, SAMPLE_TOTAL // languages))
    total = SAMPLE_TOTAL_CHARS * SOME_LANGUAGES // max(SOME_LANGUAGES, languages)
    return each, max(LEAST_CHARS, min(SAMPLE_CHARS, total // (each * languages)))


def fit(rows: DataFrame) -> Model | None:
    """rows: doc_id, text and lang of the documents to learn from.  See the module's text for the bounds of the sample."""
    rows = rows.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()  # one row per label
    if not counts:
        return None
    each, chars = sample_sizes(len(counts))
    # some 16 texts more than needed, and twice as many, so that the smallest hashes of each label are among them
    chances = [(r["lang"], min(1.0, (2.0 * each + 16) / max(1, 0.9 * r["n"] - 1))) for r in counts]
    drawn_by = F.broadcast(rows.sparkSession.createDataFrame(chances, "lang string, chance double"))
    draw = F.pmod("h", F.lit(1 << 40))
    begin = 1 + F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.length("text") - chars + 1))
    window = F.substr("text", begin.cast("int"), F.lit(chars))  # of a long text, a part from anywhere in it
    drawn = rows.withColumn("draw", draw).join(drawn_by, "lang").filter(F.col("draw") < F.col("chance") * (1 << 40))
    once = drawn.groupBy("lang", "h").agg(F.first("draw").alias("draw"), F.first(window).alias("text"))  # partial: copies are few after each task
    by: dict[str, list] = {}
    for r in sorted(bounded_rows(once.select("lang", "draw", "text"), 4 * (2 * each + 16) * len(counts) + 1000, "the sample"), key=lambda r: (r["draw"], r["text"])):
        by.setdefault(r["lang"], []).append((r["lang"], r["text"]))
    return train([x for lang in sorted(by) for x in by[lang][:each]])


class Labeller:
    """Word types a worker has met, with their emissions.  Type 0 stands for words without letters, which favour no label."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.trans = np.exp(model.transitions).astype(np.float32)
        self.first = np.exp(model.first - model.first.max()).astype(np.float32)
        many = max(MANY_LANGUAGES, len(model.languages))
        self.cache_words, self.padded = CACHE_WORDS * MANY_LANGUAGES // many, PADDED * MANY_LANGUAGES // many
        self._clear()

    def _clear(self) -> None:
        self.types: dict[str, int] = {}
        self.cores: dict[str, int] = {}
        self.table = np.ones((1024, len(self.model.languages)), np.float32)
        self.used = 1

    def _learn(self, words: set[str]) -> None:
        fresh: dict[str, int] = {}
        for w in words:
            c = core(w)
            if not c:
                self.types[w] = 0
                continue
            at = self.cores.get(c)
            if at is None:
                at = self.cores[c] = fresh[c] = self.used
                self.used += 1
            self.types[w] = at
        if fresh:
            while len(self.table) < self.used:
                self.table = np.concatenate([self.table, np.ones_like(self.table)])
            at, every = self.used - len(fresh), list(fresh)
            for n in range(0, len(every), 10_000):
                flat, sizes = features(every[n : n + 10_000], self.model.lexicon, len(self.model.languages))
                scores = np.add.reduceat(self.model.weights[flat], np.cumsum(sizes) - sizes)
                self.table[at + n : at + n + len(sizes)] = np.maximum(np.exp(scores - scores.max(axis=1, keepdims=True)), 1e-12)

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean posteriors of each text's words with letters, and how many those are."""
        if len(self.types) > self.cache_words:
            self._clear()
        types, ids = self.types, []
        for at in range(0, len(texts), 250):  # words of few texts at a time: only their numbers are kept
            cut = [(x or "").split() for x in texts[at : at + 250]]
            self._learn({w for ws in cut for w in ws} - types.keys())
            ids += [np.array([types[w] for w in ws], np.int32) for ws in cut]
        total, counts = np.zeros((len(texts), len(self.model.languages))), np.array([np.count_nonzero(x) for x in ids])
        order = sorted((i for i in range(len(ids)) if len(ids[i])), key=lambda i: -len(ids[i]))
        at = 0
        while at < len(order):
            steps = len(ids[order[at]])
            some = order[at : at + max(1, self.padded // steps)]
            grid = np.zeros((steps, len(some)), np.int32)
            lengths = np.array([len(ids[i]) for i in some])
            for j, i in enumerate(some):
                grid[: lengths[j], j] = ids[i]
            active = np.searchsorted(-lengths, -np.arange(steps), "left")
            sums, *_ = posterior(self.table[grid], active, (grid > 0).astype(np.float32), self.trans, self.first)
            total[some] = sums
            at += len(some)
        return total / np.maximum(counts, 1)[:, None], counts


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and n_labelled (words with letters) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WEIGHTS numbers per label

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value) if shared.value is not None else None
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                some = batch.slice(at, 4000)
                n = some.num_rows
                if labeller is None:
                    langs, scores, counts = [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64)
                else:
                    shares, counts = labeller.shares(some.column(1).to_pylist())
                    best = shares.argmax(axis=1)
                    langs = [labeller.model.languages[b] if c else UNKNOWN for b, c in zip(best.tolist(), counts.tolist())]
                    scores = np.where(counts > 0, np.clip(shares[np.arange(n), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())], ["doc_id", "lang_pred", "score", "n_labelled"])
        del labeller
        trim_memory()

    return with_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(label, "doc_id long, lang_pred string, score double, n_labelled long")
