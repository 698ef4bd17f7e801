"""Hashes of words, word sequences and word shingles over Arrow text columns, by array operations on the bytes of many texts at once.

Words are runs of bytes other than 0x20 and 0x09-0x0D after A-Z are lower-cased.  A word's hash is a polynomial over its bytes
modulo 2^64, mixed; that of a shingle mixes those of its words.  Two different shingles of two texts share a hash with a
probability near 2^-64; nothing else here is approximate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text whose arrays are held at once (about 60 bytes of memory each).
BLOCK_BYTES = 1 << 20

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=_U)
_LENGTH = _U(0x1D8E4E27C47D124F)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(base: int, n: int) -> np.ndarray:
    found = _powers.get(str(base))
    if found is None or len(found) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base, dtype=_U)
        steps[0] = 1
        found = _powers[str(base)] = np.cumprod(steps, dtype=_U)
    return found


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its n rows, n + 1 of them; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word; words also end at bounds, the starts of texts inside data."""
    space = _SPACE[data]
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    edge[0] = edge[n] = True
    before = np.ones(n, dtype=bool)
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | edge[:n]))
    after = np.ones(n, dtype=bool)
    after[:-1] = space[1:]
    stops = np.flatnonzero(~space & (after | edge[1:])) + 1
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum((_LOWER[data].astype(_U) + _U(1)) * _power(_BASE, n)[:n], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * _power(_BASE_INVERSE, n)[starts] + (stops - starts).astype(_U) * _LENGTH), starts


def _long_word_hashes(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, cut at white space."""
    parts, at = [], 0
    while at < len(data):
        stop = min(len(data), at + BLOCK_BYTES)
        if stop < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # one word longer than a block
                gaps = np.flatnonzero(_SPACE[data[stop:]])
                stop = stop + int(gaps[0]) if len(gaps) else len(data)
        parts.append(_word_hashes(data[at:stop], np.zeros(0, np.int64))[0])
        at = stop
    return np.concatenate(parts) if parts else np.zeros(0, _U)


class TextHashes:
    """Of a run of texts: n_words, the first and second hash of each word sequence, and the sorted distinct shingles of each."""

    def __init__(self, hashes: np.ndarray, n_words: np.ndarray, size: int = 5) -> None:
        self.n_words = n_words
        first = np.concatenate([[0], np.cumsum(n_words)])
        place = (np.arange(len(hashes)) - np.repeat(first[:-1], n_words)).astype(_U)
        self.key1, self.key2 = np.zeros(len(n_words), _U), np.zeros(len(n_words), _U)
        full = np.flatnonzero(n_words)
        if len(full):
            self.key1[full] = np.add.reduceat(mixed(hashes + place * _U(_BASE)), first[:-1][full])
            self.key2[full] = np.add.reduceat(mixed(hashes ^ mixed(place + _LENGTH)), first[:-1][full])
        rolled = np.zeros(max(0, len(hashes) - size + 1), _U)
        for k in range(size):
            rolled += hashes[k : k + len(rolled)] * _STEPS[k]
        rolled = mixed(rolled + _U(size) * _LENGTH)
        self.shingles: list[np.ndarray] = []
        for f, n in zip(first.tolist(), n_words.tolist()):
            if n >= size:
                own = np.sort(rolled[f : f + n - size + 1])
                keep = np.ones(len(own), dtype=bool)
                keep[1:] = own[1:] != own[:-1]
                own = own[keep]
            elif n:
                own = mixed(np.array([(hashes[f : f + n] * _STEPS[:n]).sum(dtype=_U)]) + _U(n) * _LENGTH)
            else:
                own = np.zeros(0, _U)
            self.shingles.append(own)


def hashed_texts(column: pa.Array):
    """(first row, TextHashes) of consecutive runs of rows that together hold about BLOCK_BYTES."""
    data, offsets = text_buffers(column)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        own = data[offsets[at] : offsets[stop]]
        if stop == at + 1:
            hashes = _long_word_hashes(own)
            counts = np.array([len(hashes)])
        else:
            bounds = offsets[at : stop + 1] - offsets[at]
            hashes, starts = _word_hashes(own, bounds[:-1]) if len(own) else (np.zeros(0, _U), np.zeros(0, np.int64))
            counts = np.diff(np.searchsorted(starts, bounds))
        yield at, TextHashes(hashes, counts)
        at = stop
