"""Best-fit packing (operator 7): cut documents into token pieces and pack the pieces into fixed-length sequences.

Pieces are packed best-fit-decreasing inside groups of bounded size, then a swap-based local search exchanges pieces between
underfull bins (move, one-for-one, two-for-one and one-for-two), each step increasing the sum of squared fills, until bins empty
and no step is left.  All underfull bins are packed again with those of other groups, in rounds, until one group holds them all or
a round saves less than LEAST_SAVED of its sequences, so that what a group wastes does not add up.

Defined results.  Null or empty text: one piece that holds the end-of-document id alone.  Repeated rows and repeated or null
doc_ids: each row is packed on its own, and groups are drawn by a number of the row, so that many rows of one doc_id or none spread.
Empty table: no rows.  Further columns are ignored.  Very long texts: as many pieces as needed; they are encoded in parts.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import staged, trim_memory, with_small_batches

#: Pieces a group may hold on average.
GROUP_PIECES = 8000
#: A round over several groups that saves a smaller share of its sequences is the last one.
LEAST_SAVED = 1e-4

#: Characters of text that are encoded at once (some 40 bytes of memory each).
SLICE_CHARS = 500_000
#: Bytes of a word up to which it is encoded with all others of a batch.
WORD_BYTES = 64

#: White space to one of the split and the tokenizer, and not to the other: texts with it are encoded as they are.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: ASCII marks that are a pre-token of their own beside a letter (all but the apostrophe).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class PairMerger:
    """Byte-pair encoding of many words at once.  In each round every word merges the leftmost of its pairs of lowest rank, as the
    sequential rule does; after the first round only the pairs beside a merge are looked up again."""

    NONE = np.int32(1 << 30)

    def __init__(self, model: dict) -> None:
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        # bytes are written as characters: printable Latin-1 as itself, the others as those from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spelled = {x: chr(x) for x in plain} | {x: chr(256 + n) for n, x in enumerate(x for x in range(256) if x not in plain)}
        self.inner = np.array([vocab[spelled[x]] for x in range(256)], np.int32)
        self.last = np.array([vocab[spelled[x] + suffix] for x in range(256)], np.int32)
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        key = np.array([vocab[x] << 32 | vocab[y] for x, y in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys = key[order]
        self.ranks = order.astype(np.int32)
        self.merged = np.array([vocab[x + y] for x, y in merges], np.int32)  # by rank

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)

    def encode(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as the bytes of all and the number of bytes of each (at least 1), and how many ids each has."""
        stops = np.cumsum(sizes)
        ids = self.inner[data]
        ids[stops - 1] = self.last[data[stops - 1]]
        words = np.arange(len(sizes))  # those with pairs left
        ended: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank = np.full(len(ids), self.NONE)
        rank[:-1] = self.rank(ids[:-1], ids[1:])
        rank[stops - 1] = self.NONE  # no pair spans two words
        while len(words):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(rank, starts)
            going = least < self.NONE
            if not going.all():
                keep = np.repeat(going, sizes)
                ended.append((words[~going], sizes[~going], ids[~keep]))
                words, sizes, least = words[going], sizes[going], least[going]
                ids, rank = ids[keep], rank[keep]
                if not len(words):
                    break
                starts = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            owner = np.searchsorted(starts, hits, "right") - 1
            at = hits[np.concatenate([[True], owner[1:] != owner[:-1]])]  # the leftmost of each word
            ids[at] = self.merged[least]
            closes = at + 2 == starts + sizes  # nothing follows the pair
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, rank = ids[keep], rank[keep]
            at -= np.arange(len(at))
            sizes = sizes - 1
            starts = np.cumsum(sizes) - sizes
            after = at[~closes]
            rank[at[closes]] = self.NONE
            rank[after] = self.rank(ids[after], ids[after + 1])
            before = at[at > starts] - 1
            rank[before] = self.rank(ids[before], ids[before + 1])
        words = np.concatenate([x for x, _, _ in ended]) if ended else words
        sizes = np.concatenate([x for _, x, _ in ended]) if ended else sizes
        flat = np.concatenate([x for _, _, x in ended]) if ended else ids
        order = np.argsort(words)
        return _gathered(flat, np.cumsum(sizes) - sizes, sizes, order), sizes[order]


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The runs of flat (their starts and sizes) in the given order, one after the other."""
    wide = sizes[order]
    at = np.arange(wide.sum())
    at += np.repeat(starts[order] - (np.cumsum(wide) - wide), wide)
    return flat[at]


class WordEncoder:
    """Ids of a text as little-endian 32-bit integers.  Exact for vocabularies whose pre-tokens never span white space: ids of
    a text are those of its words in turn.  The different words of a slice are encoded once, and nothing is remembered after it.  Words of letters between
    marks go through PairMerger, all others through the tokenizer."""

    def __init__(self, path: str, slice_chars: int | None = None) -> None:
        import os

        self.slice_chars = slice_chars or SLICE_CHARS

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.merger = PairMerger(model) if model["type"] == "BPE" and model.get("end_of_word_suffix") else None
        self.specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = np.zeros(0x110000, np.int32)  # what a letter becomes; -1: not one letter that no neighbour changes; 0: not met yet

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _lowered(self, points: np.ndarray) -> np.ndarray:
        met = np.unique(points)
        for point in met[self.lower[met] == 0].tolist():
            one = self.tokenizer.normalizer.normalize_str(chr(point)) if self.tokenizer.normalizer else chr(point)
            joins = 0x1100 <= point < 0x1200 or unicodedata.combining(chr(point))  # composes with its neighbours
            self.lower[point] = ord(one) if len(one) == 1 and unicodedata.category(one)[0] == "L" and not joins else -1
        return self.lower[points]

    def _letters(self, heads: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words of letters: ids of all, how many each has, and which could not be encoded here."""
        text = "".join(heads.to_numpy(zero_copy_only=False).tolist())
        points = self._lowered(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"))
        chars = pc.utf8_length(heads).to_numpy().astype(np.int64)
        starts = np.cumsum(chars) - chars
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        sizes = np.add.reduceat(width, starts)
        odd = (np.minimum.reduceat(points, starts) < 0) | (sizes > WORD_BYTES)
        sizes = sizes[~odd]
        if not len(sizes):
            return np.zeros(0, "<u4"), np.zeros(len(odd), np.int64), odd
        fine = points[np.repeat(~odd, chars)].astype("<u4").tobytes().decode("utf-32-le").encode()
        ids, some = self.merger.encode(np.frombuffer(fine, dtype=np.uint8), sizes)
        many = np.zeros(len(odd), np.int64)
        many[~odd] = some
        return ids.astype("<u4"), many, odd

    def table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words: a flat array, and where in it each word starts and how many ids it has."""
        core = pc.utf8_trim(words, MARKS)
        plain = pc.utf8_is_alpha(core).to_numpy(zero_copy_only=False).astype(bool) if self.merger else np.zeros(len(words), dtype=bool)
        for special in self.specials:
            plain &= ~pc.match_substring(words, special).to_numpy(zero_copy_only=False).astype(bool)
        at = np.flatnonzero(plain)
        flats: list[np.ndarray] = []
        many = np.zeros(len(words), np.int64)
        order = [np.zeros(0, np.int64)]
        slow = np.flatnonzero(~plain)
        if len(at):
            own = words.take(pa.array(at))
            heads = core.take(pa.array(at)).dictionary_encode()
            length = pc.utf8_length(own).to_numpy().astype(np.int64)
            right = pc.utf8_length(pc.utf8_rtrim(own, MARKS)).to_numpy().astype(np.int64)
            lead = right - pc.utf8_length(core.take(pa.array(at))).to_numpy().astype(np.int64)
            marks: dict[str, np.ndarray] = {"": np.zeros(0, "<u4")}
            before, after = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            names = {"": 0}
            # most marks are one after the word: these are told apart in one go, all others one by one
            single = np.flatnonzero((lead == 0) & (length - right == 1))
            if len(single):
                last = pc.utf8_slice_codeunits(own.take(pa.array(single)), -1, 1 << 30).dictionary_encode()
                for mark in last.dictionary.to_pylist():
                    names[mark] = len(names)
                    marks[mark] = self.whole(mark)
                after[single] = np.array([names[m] for m in last.dictionary.to_pylist()], np.int64)[last.indices.to_numpy()]
            for i in np.flatnonzero((lead > 0) | (length - right > 1)).tolist():
                word = own[i].as_py()
                for side, mark in ((before, word[: lead[i]]), (after, word[right[i] :])):
                    if mark not in names:
                        names[mark] = len(names)
                        marks[mark] = self.whole(mark)
                    side[i] = names[mark]
            ids, sizes, odd = self._letters(heads.dictionary)
            index = heads.indices.to_numpy().astype(np.int64)
            slow = np.concatenate([slow, at[odd[index]]])
            # runs: first the heads, then the marks; each word is three of them
            run_sizes = np.concatenate([sizes, [len(x) for x in marks.values()]]).astype(np.int64)
            flat = np.concatenate([ids, *marks.values()])
            three = np.stack([before + len(sizes), index, after + len(sizes)], axis=1)[~odd[index]]
            flats.append(_gathered(flat, np.cumsum(run_sizes) - run_sizes, run_sizes, three.ravel()))
            good = at[~odd[index]]
            many[good] = run_sizes[three].sum(axis=1)
            order.append(good)
        if len(slow):
            for word, raw in zip(slow.tolist(), self.tokenizer.encode_batch_fast(words.take(pa.array(slow)).to_pylist(), add_special_tokens=False)):
                flats.append(np.array(raw.ids, dtype="<u4"))
                many[word] = len(flats[-1])
            order.append(slow)
        placed = np.concatenate(order)
        starts = np.zeros(len(words), np.int64)
        starts[placed] = np.cumsum(many[placed]) - many[placed]
        return np.concatenate(flats), starts, many

    def _slice(self, texts: list[str]) -> list[bytes]:
        parts = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
        words = parts.flatten()
        if not len(words):
            return [b""] * len(texts)
        coded = words.dictionary_encode()
        flat, starts, many = self.table(coded.dictionary)
        index = coded.indices.to_numpy()
        raw = _gathered(flat, starts, many, index).tobytes()
        cuts = 4 * np.concatenate([[0], np.cumsum(many[index])])[parts.offsets.to_numpy()]
        return [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order.  Long texts go in parts that end at white space."""
        waiting: list[str] = []
        owners: list[int] = []
        size = owner = given = 0
        done: dict[int, list[bytes]] = {}

        def flush() -> None:
            nonlocal size
            for one, raw in zip(owners, self._slice(waiting)):
                done[one].append(raw)
            waiting.clear()
            owners.clear()
            size = 0

        for owner, text in enumerate(texts):
            text = text or ""
            done[owner] = []
            if _ODD_SPACE.search(text):
                done[owner].append(self.whole(text).tobytes())
                continue
            at = 0
            while at < len(text):
                stop = at + self.slice_chars - size
                if stop < len(text):
                    stop = max((text.rfind(c, at, stop) for c in " \n\t"), default=-1)
                    if stop < at:  # no room for a word here
                        if size:
                            flush()
                            continue
                        after = re.compile(r"\s").search(text, at + self.slice_chars)
                        stop = after.start() if after else len(text)
                    stop += stop == at
                waiting.append(text[at:stop])
                owners.append(owner)
                size += min(stop, len(text)) - at
                at = stop
                if size >= self.slice_chars:
                    flush()
                    while given < owner:
                        yield b"".join(done.pop(given))
                        given += 1
        if waiting:
            flush()
        for one in range(given, len(texts)):
            yield b"".join(done.pop(one))


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start and ids (little-endian unsigned 32-bit, as binary) of every piece of every document."""
    width = 4 * max_tokens
    stop = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()  # what earlier stages have freed
        encoder = WordEncoder(tokenizer_path)
        trim_memory()  # the text of the vocabulary
        for batch in batches:
            ids, docs_, piece, start, size = [], [], [], [], 0

            def made() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "ids"])

            for doc, raw in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1).to_pylist())):
                raw += stop
                for n, x in enumerate(range(0, len(raw), width)):
                    docs_.append(doc)
                    piece.append(n)
                    start.append(x // 4)
                    ids.append(raw[x : x + width])
                size += len(raw)
                if size > 4 * SLICE_CHARS:
                    yield made()
                    ids, docs_, piece, start, size = [], [], [], [], 0
            if ids:
                yield made()
        del encoder
        trim_memory()

    return with_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, ids binary")


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers.  The tightest bin that takes an item is the lowest set bit of a mask of remaining capacities."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for item in sorted(range(len(sizes)), key=lambda x: (-sizes[x], x)):
        size = sizes[item]
        if fits := mask >> size:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            room, bin_ = capacity, len(bins)
            bins.append([])
        bins[bin_].append(item)
        by_room[room - size].append(bin_)
        if room > size:
            mask |= 1 << (room - size)
    return bins


def least_bins(sizes: list[int], capacity: int) -> int:
    """A lower bound of the bins that sizes need: for each size a up to half a bin, pieces above half a bin have bins of their own,
    those of up to capacity - a leave room there, and pieces from a to half a bin fill that room first."""
    every = np.sort(np.array(sizes, dtype=np.int64))
    sums = np.concatenate([[0], np.cumsum(every)])
    best = -(-int(sums[-1]) // capacity)
    half = np.searchsorted(every, capacity // 2, "right")
    for a in np.unique(np.concatenate([[0], every[:half]])).tolist():
        low, wide = np.searchsorted(every, a), np.searchsorted(every, capacity - a, "right")
        room = (wide - half) * capacity - (sums[wide] - sums[half])
        best = max(best, len(every) - int(half) + max(0, -(-int(sums[half] - sums[min(low, half)] - room) // capacity)))
    return best


class _Bin:
    """A bin in the search.  Sets of numbers are bit masks; those of what may come back are kept reversed (bit capacity - x for x)."""

    __slots__ = ("items", "fill", "sizes", "one", "two", "pairs")

    def __init__(self, items: list[int], sizes: list[int], capacity: int) -> None:
        self.items = items
        held = [sizes[i] for i in items]
        self.fill = sum(held)
        self.sizes = sorted(set(held), reverse=True)
        twice = {x for x in self.sizes if held.count(x) > 1} if len(held) > len(self.sizes) else set()
        self.one = self.two = self.pairs = 0
        for x in self.sizes:
            self.one |= 1 << (capacity - x)
        for x in self.sizes:  # sums of two pieces
            others = self.one if x in twice else self.one & ~(1 << (capacity - x))
            self.two |= others >> x
        for n, x in enumerate(self.sizes):
            for y in self.sizes[n if x in twice else n + 1 :]:
                self.pairs |= 1 << (x + y)

    def most(self, other: _Bin, capacity: int) -> int:
        """The most tokens that one step can take from this bin to another; 0 if none fits."""
        room = capacity - other.fill
        back = other.one | other.two
        gains = 0
        for x in self.sizes:
            gains |= 1 << x | back >> (capacity - x)
        if self.pairs:
            for x in other.sizes:
                gains |= self.pairs >> x
        gains &= (1 << (room + 1)) - 2
        return gains.bit_length() - 1 if gains else 0

    def step(self, other: _Bin, gain: int, sizes: list[int]) -> tuple[list[int], list[int]]:
        """Pieces that go and pieces that come back in a step of so many tokens."""
        own = {sizes[i]: i for i in self.items}
        if gain in own:
            return [own[gain]], []
        theirs = {sizes[i]: i for i in other.items}
        for x, i in own.items():
            if x - gain in theirs:
                return [i], [theirs[x - gain]]
        for x, i in own.items():
            for j in other.items:
                rest = x - gain - sizes[j]
                if rest in theirs and (k := next((k for k in other.items if sizes[k] == rest and k != j), None)) is not None:
                    return [i], [j, k]
        for n, i in enumerate(self.items):
            for j in self.items[n + 1 :]:
                if sizes[i] + sizes[j] - gain in theirs:
                    return [i, j], [theirs[sizes[i] + sizes[j] - gain]]
        raise AssertionError("a step was announced that is none")


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Empty bins by moves and swaps that each raise the sum of squared fills.  The emptiest bin gives: a piece moves to another
    bin; or goes in exchange for one smaller piece, or for two that are smaller together; or two of its pieces go for one.  Of all
    these the step that moves most is taken.  Ends in a local optimum: no bin has a step, or the bins are as few as any packing needs."""
    full = [b for b in bins if sum(sizes[i] for i in b) == capacity]
    live = {n: _Bin(b, sizes, capacity) for n, b in enumerate(x for x in bins if sum(sizes[i] for i in x) < capacity)}
    least = least_bins([sizes[i] for x in live.values() for i in x.items], capacity)
    emptied = len(bins) - len(full) - least  # bins that may still go
    by_fill: list[set[int]] = [set() for _ in range(capacity + 1)]
    for n, x in live.items():
        by_fill[x.fill].add(n)
    log: list[int] = []  # bins as they change
    tried: dict[int, int] = {}  # bins without a step, and how long the log was then: since, only what changed can take
    while emptied > 0:
        done = None
        for fill in range(1, capacity):
            for n in sorted(by_fill[fill]):
                giver = live[n]
                if n in tried:
                    takers = sorted({m for m in log[tried[n] :] if m in live and m != n and live[m].fill >= fill}, key=lambda m: (live[m].fill, m))
                else:
                    takers = (m for f in range(fill, capacity) for m in sorted(by_fill[f]) if m != n)
                best, most, upper = None, 0, max(giver.sizes[0], giver.pairs.bit_length() - 2)
                for m in takers:
                    if most >= min(upper, capacity - live[m].fill):
                        break  # emptier ones come first: no later one has the room for more
                    if (gain := giver.most(live[m], capacity)) > most:
                        best, most = m, gain
                if best is not None:
                    done = n, best, most
                    break
                tried[n] = len(log)
            if done:
                break
        if done is None:
            break
        n, m, gain = done
        out, back = live[n].step(live[m], gain, sizes)
        for at, gone, come in ((n, out, back), (m, back, out)):
            by_fill[live[at].fill].discard(at)
            changed = _Bin([i for i in live[at].items if i not in gone] + come, sizes, capacity)
            tried.pop(at, None)
            log.append(at)
            if 0 < changed.fill < capacity:
                live[at] = changed
                by_fill[changed.fill].add(at)
            else:
                del live[at]
                if changed.fill:
                    full.append(changed.items)
                else:
                    emptied -= 1
    return full + [x.items for x in live.values()]


def _pack_group(sizes: np.ndarray, capacity: int, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and whether its bin is underfull.  before: the sequences of an earlier round, which stay if
    packing anew takes more."""
    items = sizes.tolist()
    bins = best_fit_decreasing(items, capacity)
    if before is not None:
        held: dict[int, list[int]] = {}
        for i, s in enumerate(before.tolist()):
            held.setdefault(s, []).append(i)
        if len(held) < len(bins):
            bins = list(held.values())
    bins = local_search(bins, items, capacity)
    bin_of, offset, open_ = np.empty(len(items), np.int64), np.empty(len(items), np.int64), np.zeros(len(items), bool)
    for b, members in enumerate(bins):
        at = 0
        for i in sorted(members):
            bin_of[i], offset[i] = b, at
            at += items[i]
        open_[members] = at < capacity
    return bin_of, offset, open_


def _group_packer(level: int, capacity: int):
    def packed(keys, rows):
        rows = rows.take(pa.array(np.argsort(rows.column("_row").to_numpy()))).drop_columns(["_group"])
        before = rows.column("sequence_id").to_numpy() if level else None
        bin_of, offset, open_ = _pack_group(rows.column("length").to_numpy(), capacity, before)
        for name, values in (("sequence_id", (level << 56) + (keys[0].as_py() << 24) + bin_of), ("offset", offset), ("_open", open_)):
            at = rows.schema.get_field_index(name)
            rows = rows.append_column(name, pa.array(values)) if at < 0 else rows.set_column(at, name, pa.array(values))
        return rows

    return packed


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """sequence_id and offset for every row of pieces (doc_id, piece, start, length, and what else it has); length at most capacity."""
    names = pieces.columns
    left = staged(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")  # staged, so a row keeps its number
    many, sequences, level = left.count(), None, 0
    done: list[DataFrame] = []
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema) + ", sequence_id long, offset long, _open boolean"
    key = "_row"
    while True:
        groups = max(1, -(-many // GROUP_PIECES))
        grouped = left.withColumn("_group", F.pmod(F.xxhash64(key, F.lit(level)), F.lit(groups))).groupBy("_group")
        packed_ = staged(grouped.applyInArrow(_group_packer(level, capacity), schema), f"packed{level}")
        now, still, open_ = packed_.agg(F.count_if(F.expr("offset = 0")), F.count_if("_open"), F.count_if(F.expr("_open and offset = 0"))).first()
        if groups == 1 or still == 0 or sequences is not None and sequences - now <= LEAST_SAVED * sequences:
            done.append(packed_)
            break
        done.append(packed_.filter("not _open"))
        left, many, sequences, key = packed_.filter("_open").drop("_open"), still, open_, "sequence_id"
        level += 1
    out = done[0].select(*names, "sequence_id", "offset")
    for more in done[1:]:
        out = out.unionByName(more.select(*names, "sequence_id", "offset"))
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048) -> DataFrame:
    """The whole operator: doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    pieces = token_pieces(docs, tokenizer_path, max_tokens).select("doc_id", "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    return pack(pieces, max_tokens)
