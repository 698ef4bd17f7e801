from __future__ import annotations

import functools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.llm import packing as P
from cardloom.llm import sharding as S
from cardloom.llm.queries import tokenizer_path
from tests.llm.helpers import frame

TEXTS = ["It's here.", "", None, " \n", "Ünïcode Straße İstanbul ﬁ é x̸", "a\x1cb \x85c d e", "<|endoftext|> and<|startoftext|>x", "12'34 don't ***'' we've!!", "名前 は 😀 :) " * 5, "word " * 5000, "x" * 9000, "It's here."]


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def reference(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_hold_the_tokenizers_ids(spark):
    rows = list(enumerate(TEXTS))
    got = defaultdict(list)
    for r in P.token_pieces(frame(spark, rows), tokenizer_path(), 64).collect():
        got[r.doc_id].append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for i, text in rows:
        ids = reference(text)
        assert sorted(got[i]) == [(n, a, ids[a : a + 64]) for n, a in enumerate(range(0, len(ids), 64))]


ODD = ["<|endoftext|>x (foo) [bar]; a.b x_y _z_", "각 각 한국어 조선말 가́", "नमस्ते हिन्दी ไทย ''s 's a's", "²³ x² Ⅷ ⅷa ªº ½½x", "ΑΣ ΟΔΟΣ. ǅ ŉ ẞ ﬀ", "w" * 70 + " end"]


def test_encoder_against_the_tokenizer_in_any_slices(monkeypatch):
    encoder = P.WordEncoder(tokenizer_path())
    rng = random.Random(1)
    alphabet = "abcdefgXYZ éÉßǅİıΣσς'.,-(!½²각가\u1100\u1161\u0301名 \t\nаБ"
    texts = [*TEXTS, *ODD, *("".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(300)), " ".join(f"new{i} word{chr(97 + i % 26)}x" for i in range(3_000))]
    expected = [reference(x)[:-1] for x in texts]
    for size, some in ((P.SLICE_CHARS, len(texts)), (500, len(texts)), (7, 60)):
        monkeypatch.setattr(P, "SLICE_CHARS", size)
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(texts[:some])] == expected[:some]


def test_rows_without_a_doc_id_spread_over_the_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 50)
    keys: list[int] = []
    packer = P._group_packer

    def counted(level, capacity):
        if level == 0:
            keys.append(level)
        return packer(level, capacity)

    monkeypatch.setattr(P, "_group_packer", counted)
    pieces = spark.range(400).selectExpr("cast(null as long) as doc_id", "0 as piece", "0L as start", "30L as length", "7L as ids_crc32")
    out = P.pack(pieces, 100)
    first = {(r.sequence_id >> 24) & 0xFFFFFFFF for r in out.collect()}
    assert keys and len(first) > 1 and out.count() == 400 and 134 <= out.filter("offset = 0").count() <= 134 + 8  # no bin can be filled, so each group may hold one with room


def fewest(sizes, capacity):
    """Bins of an optimal packing, by trying every place of every item."""
    best = len(sizes)

    def place(n, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if n == len(sizes):
            best = len(bins)
            return
        for i in sorted({b: k for k, b in enumerate(bins) if b + sizes[n] <= capacity}.values()):
            place(n + 1, [*bins[:i], bins[i] + sizes[n], *bins[i + 1 :]])
        place(n + 1, [*bins, sizes[n]])

    place(0, [])
    return best


def test_search_against_exact_packings():
    rng = random.Random(11)
    exact = 0
    for _ in range(60):
        sizes = sorted((rng.randrange(5, 60) for _ in range(10)), reverse=True)
        found = P.local_search(P.best_fit_decreasing(sizes, 100), sizes, 100)
        best = fewest(sizes, 100)
        assert P.least_bins(sizes, 100) <= best <= len(found) <= best + 1
        exact += len(found) == best
    assert exact >= 57


def test_search_ends_where_no_step_is_left():
    rng = random.Random(12)
    sizes = [rng.randrange(20, 45) for _ in range(60)]
    bins = P.local_search(P.best_fit_decreasing(sizes, 100), sizes, 100)
    live = [P._Bin(b, sizes, 100) for b in bins if sum(sizes[i] for i in b) < 100]
    if len(bins) > P.least_bins(sizes, 100):
        for a in live:
            for b in live:
                if a is not b and b.fill >= a.fill:
                    gains = [s - t for s in a.sizes for t in [0, *b.sizes]] + [sizes[i] - sizes[j] - sizes[k] for i in a.items for n, j in enumerate(b.items) for k in b.items[n + 1 :]]
                    gains += [sizes[i] + sizes[j] - t for n, i in enumerate(a.items) for j in a.items[n + 1 :] for t in b.sizes]
                    assert not any(0 < g <= 100 - b.fill for g in gains)


def test_packing_is_gapless_and_tight(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 40)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(1, 90)))) for i in range(300)] + [(None, "one"), (5, "again"), (5, "again")]
    out = P.pack_documents(frame(spark, rows), tokenizer_path(), 64).collect()
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in out)
    assert total == sum(len(reference(t)) for _, t in rows)
    assert len(bins) <= -(-total // 64) + 1
    assert sum(zlib.crc32(np.array(reference("again"), "<u4").tobytes()) == r.ids_crc32 for r in out) == 2
    assert P.pack_documents(frame(spark, []), tokenizer_path(), 64).count() == 0


def test_local_search_empties_bins():
    sizes = [6, 4, 4, 3, 3]
    start = [[0, 3], [1, 2], [4]]  # 9, 8, 3 of 10
    best = P.local_search([list(b) for b in start], sizes, 10)
    assert len(best) == 2 and sorted(i for b in best for i in b) == list(range(5)) and all(sum(sizes[i] for i in b) <= 10 for b in best)
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randrange(1, 60) for _ in range(80)]
        first = P.best_fit_decreasing(sizes, 100)
        more = P.local_search([list(b) for b in first], sizes, 100)
        assert sorted(i for b in more for i in b) == list(range(80)) and len(more) <= len(first) and all(sum(sizes[i] for i in b) <= 100 for b in more)


def test_tree_and_bins():
    rng = random.Random(2)
    tree, kept = S.RoomTree(), []
    for step in range(3000):
        if rng.random() < 0.6:
            key = (rng.randrange(500), step)
            tree.insert(key)
            kept.append(key)
        else:
            room = rng.randrange(500)
            expected = min((k for k in kept if k[0] >= room), default=None)
            assert tree.pop_tightest(room) == expected
            if expected:
                kept.remove(expected)
    assert S.best_fit_decreasing([(5, 2), (4, 1), (3, 2)], 10) == [[(0, 2)], [(1, 1)], [(1, 2)]]
    sizes = [rng.randrange(1, 1000) for _ in range(2000)]
    runs = sorted(Counter(sizes).items(), reverse=True)
    load = Counter()
    for (size, count), parts in zip(runs, S.level_shards(runs, 24)):
        assert sum(n for _, n in parts) == count
        for b, n in parts:
            load[b] += n * size
    assert max(load.values()) <= 1.001 * sum(sizes) / 24 + 1 and min(load.values()) >= 0.97 * sum(sizes) / 24 and set(load) == set(range(24))
    assert S.level_shards([], 24) == [] and S.level_shards([(7, 1)], 24) == [[(0, 1)]]


def test_runs_are_placed_as_single_items_are():
    rng = random.Random(4)
    for _ in range(40):
        sizes = sorted((rng.randrange(1, 40) for _ in range(60)), reverse=True)
        single, rooms = [], []  # tightest room first, then the older bin
        for size in sizes:
            fit = min(((r, b) for b, r in enumerate(rooms) if r >= size), default=None)
            if fit is None:
                rooms.append(100 - size)
                single.append(len(rooms) - 1)
            else:
                rooms[fit[1]] -= size
                single.append(fit[1])
        load = Counter()
        for size, b in zip(sizes, single):
            load[b, size] += 1
        runs = sorted(Counter(sizes).items(), reverse=True)
        placed = Counter()
        for (size, _), parts in zip(runs, S.best_fit_decreasing(runs, 100)):
            for b, n in parts:
                placed[b, size] += n
        assert placed == load


def test_equal_sizes_and_equal_rows_spread_over_cells(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL_ROWS", 10)
    rows = [(1, "same")] * 90 + [(None, "null id")] * 30 + [(i, f"t{i:05}") for i in range(200)]
    out = S.shard_documents(frame(spark, rows), 4).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert len(out) == 320 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({r.shard for r in out if r.text_crc32 == zlib.crc32(b"same")}) == 1
    parts = S.numbered(spark.range(300).selectExpr("0 as key", "id"), "key", [F.col("id")])
    assert sorted(r._number for r in parts.collect()) == list(range(300)) and parts.select("_part").distinct().count() == 30


@pytest.mark.parametrize("n", [0, 3, 400])
def test_shards(spark, n):
    rng = random.Random(n)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)) + str(i % 97)) for i in range(n)] + [(10**6 + i, "hot " * 20) for i in range(n // 3)]
    rows += [(9001, None), (9002, ""), (9003, "dup"), (9003, "dup")] if n else []
    out = S.shard_documents(frame(spark, rows), 24).collect()
    assert len(out) == len(rows)
    text = dict(rows)
    slots, shards, load = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in out:
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 8, zlib.crc32(raw)) and 0 <= r.shard < 24
        slots[r.shard].append(r.slot)
        shards[raw].add(r.shard)
        load[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and all(len(v) == 1 for v in shards.values())
    if n == 400:
        hot = (len("hot " * 20) + 8) * (n // 3)
        assert max(load.values()) <= max(hot, 1.03 * sum(load.values()) / 24)
