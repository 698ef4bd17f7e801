"""Toxicity (operator 5): compression-distance classification with separate zstandard dictionaries for toxic and ordinary text.

A text is cut into windows of WINDOW_WORDS words; each is compressed with the dictionary of either class, and the difference
of the two lengths tells which class it is closer to.  Words are lower-cased letters, each written as a fixed code of CODE_BYTES
bytes: compressed as letters, windows of text in several languages differ by more in chance matches of syllables than by a toxic word.
Dictionaries are trained by zstandard on the words typical of their class - those in more different contexts (the word before) than
the other class makes likely, so that copies of one text count once - and on the most frequent words, which both share; trained
on whole windows they do not tell the classes apart (figures in the README).  A window counts when its difference reaches a threshold; a logistic
fit over the number and share of such windows, the largest difference and the mean, with classes weighted as they are among all
labels, gives the score.  The threshold is the one of THRESHOLDS whose fit is best on windows that were compared by dictionaries trained on
other texts.

Fitted on the driver on a bounded sample: at most SAMPLE_DOCS different labelled texts of each class, those with the smallest hashes.
Texts are taken whole, as a label may be due to any part of one; those above SAMPLE_CHARS characters come after the others, as far as
all of a class stay within SAMPLE_DOCS * SAMPLE_CHARS (but one at least).  Scores cover every whole text.

Defined results.  Null, empty and wordless texts have no window, and score what the fit gives for none.  No labelled row of one
of the classes: every score is 0.  Different labels of a document count each, equal
ones once; labels of documents that are not there do not count.  Repeated rows are scored each.  Empty table: no
rows.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import staged, with_small_batches

SAMPLE_DOCS = 2000
SAMPLE_CHARS = 8_000
WINDOW_WORDS = 16
CODE_BYTES = 16
DICTIONARY_BYTES = 1 << 14
#: A typical word: how many standard deviations above chance, how many times the other class's rate; words that both dictionaries share.
TYPICAL_Z, TYPICAL_RATIO, COMMON_WORDS = 3.0, 4.0, 200
#: Bytes of difference from which a window may count.
THRESHOLDS = (2, 4, 8, 12, 16, 24, 32)
FOLDS = 3
#: Different words whose codes a scorer remembers before it starts anew.
CACHE_WORDS = 150_000


def plain(word: str) -> str:
    return word.lower() if word.isalpha() else "".join([c for c in word if c.isalpha()]).lower()


def coded(word: str) -> bytes:
    """The code of a word; nothing for one without letters."""
    letters = plain(word)
    return hashlib.md5(letters.encode(), usedforsecurity=False).digest()[:CODE_BYTES] if letters else b""


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    threshold: int
    weights: list[float]  # intercept, log count, share, largest, mean

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ np.array(self.weights[1:]), -30, 30)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=15, hash_log=15, chain_log=15, search_log=4, min_match=6, target_length=0, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary)


class Windows:
    """Compresses the windows of texts with both dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)
        self.codes: dict[str, bytes] = {}

    def cut(self, texts: list[str | None]) -> list[list[bytes]]:
        """The coded windows of each text."""
        words = [(text or "").split() for text in texts]
        if len(self.codes) > CACHE_WORDS:
            self.codes = {}
        codes = self.codes
        for w in {w for ws in words for w in ws} - codes.keys():
            codes[w] = coded(w)
        step = CODE_BYTES * WINDOW_WORDS
        joined = [b"".join([codes[w] for w in ws]) for ws in words]
        return [[x[i : i + step] for i in range(0, len(x), step)] for x in joined]

    def differences(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ordinary minus toxic length of each window of each text."""
        cut = self.cut(texts)
        flat = [w for windows in cut for w in windows]
        if not flat:
            return [np.zeros(0, np.int64) for _ in texts]
        lengths = [np.fromiter(map(len, compressor.multi_compress_to_buffer(flat, threads=0)), np.int64, len(flat)) for compressor in (self.ordinary, self.toxic)]
        return np.split(lengths[0] - lengths[1], np.cumsum([len(windows) for windows in cut])[:-1])


def _features(found: np.ndarray, threshold: int) -> tuple[float, float, float, float]:
    """Of a text's differences: the logarithm of how many count, their share, the largest and the mean."""
    if not len(found):
        return 0.0, 0.0, 0.0, 0.0
    many = int((found >= threshold).sum())
    return math.log1p(many), many / len(found), max(0.0, float(found.max())) / CODE_BYTES, float(found.mean()) / CODE_BYTES


def _contexts(texts: list[str]) -> Counter:
    """In how many different contexts (the word before) each word occurs."""
    pairs: set[tuple[str, str]] = set()
    for text in texts:
        words = [w for w in map(plain, text.split()) if w]
        pairs.update(zip(words, ["", *words]))
    return Counter(w for w, _ in pairs)


def _typical(own: Counter, other: Counter) -> list[tuple[float, str]]:
    """(standard deviations above chance, word) of the words typical of a class, most typical first."""
    a, b = sum(own.values()), sum(other.values())
    out = []
    for word, n in own.items():
        expected = (n + other[word]) * a / (a + b)
        z = (n - expected) / math.sqrt(expected + 1)
        if (n + 0.5) * b > TYPICAL_RATIO * (other[word] + 0.5) * a:
            out.append((z, word))
    return sorted(out, key=lambda x: (-x[0], x[1]))


def _dictionary(texts: list[str], words: set[str], typical: list[str]) -> bytes:
    """A dictionary trained on the class's windows reduced to the given words.  What the trainer cannot use (too little text)
    is replaced by the words themselves; the most typical stand last, nearest to the window."""
    samples = []
    for text in texts:
        kept = [w for w in map(plain, text.split()) if w in words]
        samples += [b"".join(map(coded, kept[i : i + 4])) for i in range(0, len(kept), 4)]
    try:
        content = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=CODE_BYTES, d=8).as_bytes()
    except zstandard.ZstdError:
        content = b""
    missing = [c for c in map(coded, reversed(typical)) if c not in content]
    return content + b"".join(missing) if content or missing else b"\0" * 8


def _dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Each: trained on the words typical of its class, then, nearest to the window and the same in both, on those that both use most."""
    contexts = _contexts(toxic), _contexts(ordinary)
    most = DICTIONARY_BYTES // CODE_BYTES
    bad, good = ([w for z, w in _typical(a, b) if z >= TYPICAL_Z][:most] for a, b in (contexts, contexts[::-1]))
    special = {*bad, *good}
    common = [w for _, w in sorted((-n, w) for w, n in contexts[1].items() if w not in special)[:COMMON_WORDS]]
    base = _dictionary(ordinary, set(common), common)
    return _dictionary(toxic, set(bad), bad) + base, _dictionary(ordinary, set(good), good) + base


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - 1e-3 * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), gradient)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def train(toxic: list[str], ordinary: list[str], n_toxic: int, n_ordinary: int) -> Model | None:
    """n_toxic and n_ordinary: how many labels there are, for the weights of the classes."""
    if not toxic or not ordinary:
        return None
    # each text's windows are compared by dictionaries that have not seen it; the last ones learn from all texts
    texts, y = [*toxic, *ordinary], np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    fold = np.concatenate([np.arange(len(toxic)), np.arange(len(ordinary))]) % FOLDS
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    for k in range(FOLDS):
        learn = [[t for t, c, f in zip(texts, y, fold) if c == label and (f != k or len(texts) < 2 * FOLDS)] for label in (1, 0)]
        windows = Windows(*_dictionaries(*learn))
        own = np.flatnonzero(fold == k).tolist()
        for at in range(0, len(own), 500):
            for i, x in zip(own[at : at + 500], windows.differences([texts[i] for i in own[at : at + 500]])):
                found[i] = x
    share = n_toxic / max(1, n_toxic + n_ordinary)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    best: tuple[float, int, list[float]] | None = None
    for threshold in THRESHOLDS:
        x = np.array([_features(d, threshold) for d in found])
        weights = _logistic(x, y, weight)
        p = np.clip(1 / (1 + np.exp(-np.clip(weights[0] + x @ np.array(weights[1:]), -30, 30))), 1e-9, 1 - 1e-9)
        loss = -float((weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())
        if best is None or loss < best[0] - 1e-9:
            best = loss, threshold, weights
    return Model(*_dictionaries(toxic, ordinary), best[1], best[2])


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """docs: doc_id, text; labels: doc_id, toxic, of the rows to learn from.  See the module's text for the bounds of the sample."""
    labels = labels.filter("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic")).distinct()
    # hashes and lengths of texts are shuffled, not texts; copies of a text, repeated labels and labels of no document count once or not at all
    draw = F.xxhash64("text")
    texts = docs.filter("text is not null and doc_id is not null").select(F.col("doc_id").cast("long"), draw.alias("draw"), F.length("text").alias("chars"))
    known = staged(texts.distinct().join(labels, "doc_id").groupBy("toxic", "draw").agg(F.first("chars").alias("chars")), "labelled-texts")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    chosen: list[tuple[int, int]] = []
    for toxic in (0, 1):
        # whole texts, as the label may be due to any part of one: the smallest hashes, long texts last and as far as there is room
        order = [F.col("chars") > SAMPLE_CHARS, F.col("draw")]
        room = SAMPLE_DOCS * SAMPLE_CHARS
        for n, r in enumerate(known.filter(F.col("toxic") == toxic).orderBy(*order).limit(SAMPLE_DOCS).collect()):
            if r["chars"] <= room or not n:
                room -= r["chars"]
                chosen.append((r["draw"], toxic))
    few = docs.sparkSession.createDataFrame(chosen, "draw long, toxic int")  # at most 2 * SAMPLE_DOCS rows
    held = docs.filter("text is not null").select(draw.alias("draw"), "text").join(F.broadcast(few.select("draw").distinct()), "draw")
    found = {r["draw"]: r["text"] for r in held.groupBy("draw").agg(F.first("text").alias("text")).collect()}
    by = {toxic: [found[d] for d, t in sorted(chosen) if t == toxic] for toxic in (0, 1)}
    return train(by[1], by[0], counts[1], counts[0])


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, n_windows and n_toxic_windows of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of at most twice DICTIONARY_BYTES

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        windows = Windows(model.toxic, model.ordinary) if model else None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                found = windows.differences(some.column(1).to_pylist()) if windows else [np.zeros(0, np.int64)] * some.num_rows
                n = [len(x) for x in found]
                many = [int((x >= model.threshold).sum()) if windows else 0 for x in found]
                x = [_features(x, model.threshold) if windows else (0.0, 0.0, 0.0, 0.0) for x in found]
                scores = model.score(np.array(x).reshape(-1, 4)) if model else np.zeros(some.num_rows)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scores, pa.float64()), pa.array(n, pa.int64()), pa.array(many, pa.int64())], ["doc_id", "score", "n_windows", "n_toxic_windows"])

    return with_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double, n_windows long, n_toxic_windows long")
