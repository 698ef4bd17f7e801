"""Ranked search, the token store and vector codes against plain versions of the same contracts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cardloom.llm.queries import tokenizer_path
from cardloom.llm.ranked_search import Block, search_items, term_counts
from cardloom.llm.token_store import Dictionary, TokenFile, TokenFileWriter, fetch, open_store, read_digests, read_ids, write_store
from cardloom.llm.vector_codes import Codebooks, compressed_vectors, encode, fit, hex_code, kept_vectors, limit, nearest, quantized
from tests.llm.helpers import LOWER, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ranked search


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k=20):
    """(item_id, rank, doc_id, score) by scoring every document."""
    met = [(d, terms_of(t)) for d, t in docs]
    met = [(d, ts) for d, ts in met if ts]
    total, length = len(met), sum(len(ts) for _, ts in met)
    df = Counter(t for _, ts in met for t in set(ts))
    w = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * k_ + 1))) for t, k_ in df.items()}
    out = []
    for item, text in items:
        scored = []
        for d, ts in met:
            m, tf = 75 + 25 * len(ts) * total // length, Counter(ts)
            score = sum(w[t] * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms_of(text) if t in tf)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, n, d, -s) for n, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, k=20):
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as score", "1 as doc_id")
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in search_items(frame(spark, docs), asked, k).collect()), key=repr)


def test_search_equals_scoring_every_document(spark):
    rng = random.Random(3)
    words = [f"w{n}" for n in range(60)] + ["é", "naïve", "日本", "x1y2"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (n + 1) for n in range(64)], k=rng.randint(1, 80)))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # ties beyond the kth place
    docs += [(5, docs[5][1]), (5, docs[5][1]), (None, docs[9][1]), (None, docs[9][1]), (2000, None), (2001, ""), (2002, "... !"), (2003, "W1 w1,W1")]
    items = [(n, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for n in range(12)]
    items += [(3, "w1 W1 w1"), (3, "w1 W1 w1"), (50, docs[7][1]), (60, None), (61, "?!"), (62, "absent"), (None, "naïve é")]
    assert searched(spark, docs, items) == ranked(docs, items)
    assert searched(spark, docs, items, 3) == ranked(docs, items, 3)


def test_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, None)], [(1, "a")]) == []


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    from cardloom.llm import ranked_search

    docs = [(i, f"a{i % 7} b{i % 5} c") for i in range(60)]
    items = [(n, f"a{n % 7} b{n % 3} c c") for n in range(20)]
    monkeypatch.setattr(ranked_search, "BLOCK_CHARS", 300)
    monkeypatch.setattr(ranked_search, "BLOCK_ENTRIES", 20)
    monkeypatch.setattr(ranked_search, "MEETING_TASKS", 1)
    assert searched(spark, docs, items, 4) == ranked(docs, items, 4)


def test_threshold_stops_before_the_lists_end():
    rng = np.random.default_rng(1)
    n = 20_000
    cuts, terms = np.arange(n + 1) * 3, np.tile(np.arange(3), n)
    impact = (rng.pareto(2.0, 3 * n) * 1000).astype(np.int64) + 1
    block, asked = Block(np.ma.masked_array(np.arange(n), np.zeros(n, bool)), cuts, terms, impact), np.ones(3, np.int64)
    places, scores, read = block.search(np.arange(3), np.ones(3, np.int64), asked, 10, 0)
    best = np.sort(impact.reshape(n, 3).sum(axis=1))[::-1][:10]
    assert np.sort(scores)[::-1][:10].tolist() == best.tolist()
    assert read < n  # of 3 n entries


def test_terms_of_long_texts(monkeypatch):
    from cardloom.llm import ranked_search

    text = "Ab cd-éÉ " * 500
    whole = term_counts(text)
    monkeypatch.setattr(ranked_search, "SLICE_BYTES", 11)
    assert term_counts(text) == whole == {k.encode(): v for k, v in Counter(terms_of(text)).items()}


# token store


def plain_tokens(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [(d, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for d, t in rows]


def test_store_round_trip(spark, monkeypatch):
    from cardloom.llm import token_store

    monkeypatch.setattr(token_store, "FILE_DOCUMENTS", 7)
    monkeypatch.setattr(token_store, "CHUNK_BYTES", 200)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["the", "of", "Ünïcode", "token!", "日本", "x'y"], k=rng.randint(0, 60)))) for i in range(60)]
    rows += [(7, rows[7][1]), (8, "other"), (90, None), (91, ""), (None, "no id"), (None, None), (92, "word " * 30_000)]
    store = write_store(frame(spark, rows), tokenizer_path(), 2)
    got = sorted(read_ids(store).collect(), key=lambda r: r.start)
    want = sorted(plain_tokens(rows), key=lambda x: (x[0] is None, x[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in want]
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in got) == sorted((d is None, d or 0, x) for d, x in want)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    digests = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in read_digests(store).collect()}
    assert digests == {(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got}
    assert store.manifest.count() > 5
    by = {}
    for d, x in want:
        by.setdefault(d, []).append(x)
    again = open_store(spark, store.folder)
    found = sorted((r.doc_id, bytes(r.ids)) for r in fetch(again, [7, 8, 92, 12345]).collect())
    assert found == sorted((d, x) for d in (7, 8, 92) for x in by[d])
    assert fetch(again, []).count() == 0


def test_store_of_nothing_and_of_little(spark):
    store = write_store(frame(spark, []), tokenizer_path(), 2)
    assert read_ids(store).count() == 0 and store.manifest.count() == 0
    store = write_store(frame(spark, [(4, None)]), tokenizer_path(), 2)
    assert [(r.doc_id, r.start, bytes(r.ids)) for r in read_ids(store).collect()] == [(4, 0, b"\x02\0\0\0")]


def test_file_of_another_dictionary_is_refused(tmp_path):
    from pyarrow import fs

    own, other = Dictionary(b"a" * 64), Dictionary(b"b" * 64)
    path = str(tmp_path / "x.tokens")
    writer = TokenFileWriter(fs.LocalFileSystem().open_output_stream(path), own.sha256)
    pack = own.compressor()
    for doc, raw in ((3, b"\x01\0\0\0"), (3, b"\x05\0\0\0"), (9, b"\x07\0\0\0" * 5), (None, b"\x02\0\0\0")):
        writer.add(doc, len(raw) // 4, pack.compress(raw))
    writer.close()
    with fs.LocalFileSystem().open_input_file(path) as f:
        tokens = TokenFile(f, own)
        assert [list(tokens.places(x)) for x in (2, 3, 9, None)] == [[], [0, 1], [2], [3]]
        assert tokens.ids(2) == b"\x07\0\0\0" * 5 and tokens.doc_id(3) is None
        assert tokens.starts.tolist() == [0, 1, 2, 7, 8]
        with pytest.raises(ValueError, match="another dictionary"):
            TokenFile(f, other)
    (tmp_path / "y.tokens").write_bytes(b"z" * 200)
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "y.tokens")) as f, pytest.raises(ValueError, match="no token file"):
        TokenFile(f, own)


def test_dictionary_makes_short_documents_smaller():
    rng = np.random.default_rng(2)
    phrases = [rng.integers(0, 49_000, 12).astype("<u4").tobytes() for _ in range(50)]
    docs = [b"".join(phrases[i] for i in rng.integers(0, 50, 4)) for _ in range(2000)]
    import zstandard

    own, plain = Dictionary.trained(docs[:1000]).compressor(), zstandard.ZstdCompressor(level=3)
    assert sum(len(own.compress(x)) for x in docs[1000:]) < 0.6 * sum(len(plain.compress(x)) for x in docs[1000:])


# vector codes

VECTORS = "vec_id long, embedding array<float>, label int"


def coded(rows, parts=16, entries=64, rounds=2):
    """{position in rows: (code, error)} and the sha256, in plain integers."""
    ok = [(i, r) for i, r in enumerate(rows) if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    order = sorted(ok, key=lambda x: (x[1][0] is None, x[1][0] or 0, x[1][1]))
    each = len(order[0][1][1]) // parts
    cut = {i: [[math.floor(256 * float(x)) for x in r[1][p * each : (p + 1) * each]] for p in range(parts)] for i, r in ok}
    books = [[list(cut[i][p]) for i, _ in order[:entries]] for p in range(parts)]

    def closest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own: dict[int, list] = {}
            for i in cut:
                own.setdefault(closest(cut[i][p], books[p])[1], []).append(cut[i][p])
            for n, xs in own.items():
                books[p][n] = [sum(c) // len(xs) for c in zip(*xs)]
    out = {}
    for i in cut:
        best = [closest(cut[i][p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best))
    return out, hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()


def test_codes_equal_plain_integers(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(0, 0.2, 32).astype(np.float32).tolist(), int(i) % 4 or None) for i in rng.permutation(150)]
    rows += [(20, rows[3][1], 7), (20, rows[3][1], 7), (None, rows[5][1], None), (1001, None, 1), (1002, [None] + rows[0][1][1:], 1), (1003, [float("nan")] * 32, 1), (1004, [float("inf")] * 32, None), (1005, [], 2)]
    got = compressed_vectors(spark.createDataFrame(rows, VECTORS).repartition(3).selectExpr("*", "'x' as code", "1 as error", "2 as _l")).withColumn("code", hex_code()).collect()
    want, sha = coded(rows)
    by_label: dict = {}
    for i, (_, error) in want.items():
        by_label[rows[i][2]] = by_label.get(rows[i][2], 0) + error
    assert {r.codebooks_sha256 for r in got} == {sha}
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr) == sorted(((rows[i][0], *x, by_label[rows[i][2]]) for i, x in want.items()), key=repr)
    assert all(16 <= r.n_exact <= 16 * 65 for r in got)


def test_codes_of_few_vectors_none_and_odd_widths(spark):
    assert compressed_vectors(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    same = [(i, [0.5] * 32, 1) for i in range(3)]
    got = compressed_vectors(spark.createDataFrame(same, VECTORS)).collect()
    assert [(bytes(r.code), r.error, r.label_error) for r in got] == [(bytes(16), 0, 0)] * 3  # ties go to the lower index
    mixed = [(1, [0.25] * 20, 1), (2, [1.0] * 32, 1), (3, [0.5] * 20, 1)]  # another width is dropped; 20 components are filled up to 32
    assert sorted((r.vec_id, r.error) for r in compressed_vectors(spark.createDataFrame(mixed, VECTORS)).collect()) == [(1, 0), (3, 0)]


def test_bounds_never_drop_the_nearest_entry():
    rng = np.random.default_rng(6)
    for each, spread in ((1, 3), (2, 50), (3, 5), (5, 400), (8, 1000), (16, limit(256)), (64, 100)):
        x, entries = rng.integers(-spread, spread + 1, (500, each)), rng.integers(-spread, spread + 1, (40, each))
        entries[7] = entries[3]
        distance = np.square(x[:, None] - entries[None]).sum(axis=2)
        own, least, exact = nearest(x, entries)
        assert (own == distance.argmin(axis=1)).all() and (least == distance.min(axis=1)).all()
        assert exact <= 500 * 41
    smooth = np.repeat(rng.integers(-1000, 1000, (500, 1)), 16, axis=1)
    assert nearest(smooth, np.repeat(rng.integers(-1000, 1000, (64, 1)), 16, axis=1))[2] < 500 * 4  # means alone decide


def test_huge_components_and_decoding(spark):
    huge = [(1, [3.0e38] * 16, None), (2, [-3.0e38] * 16, None), (3, [0.1] * 16, None)]
    kept = kept_vectors(spark.createDataFrame(huge, VECTORS))
    books = fit(kept)
    rows = encode(kept, books).collect()
    assert [r.error for r in rows] == [0, 0, 0]
    back = books.decode(np.array([list(r.code) for r in rows]))
    assert sorted(back[:, 0].tolist()) == [-limit(16), 25, limit(16)]
    assert (quantized(np.array([[-0.001] * 16]))[0, 0] == -1).all()  # floors go down
    assert Codebooks(np.zeros((2, 1, 2), np.int64), 4).sha256 == hashlib.sha256(b"0,0,0,0").hexdigest()
