from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from cardloom.llm import ngram_join as N
from cardloom.llm.graph import connected_components
from tests.llm.helpers import LOWER, SPACE, frame, words_of


def shingles(text):
    w = tuple(SPACE.findall((text or "").translate(LOWER)))
    return frozenset(w[i : i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([w] if w else [])


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                common[j] += 1
            holders[x].append(i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus(seed=5):
    rng, rows, doc = random.Random(seed), [], 0
    passage = words_of("p", 60)
    for base in range(12):
        words = words_of(base, rng.choice([3, 5, 8, 40, 200]))
        if base % 4 == 0:
            words = passage + words
        for _ in range(rng.choice([1, 2, 6, 15])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                at = rng.randrange(len(copy))
                copy[at] = f"e{rng.randrange(10**6)}" if rng.random() < 0.7 else copy[at].upper()
            rows.append((doc, "\t \n"[doc % 3].join(copy)))
            doc += 1
    return rows + [(doc, None), (doc + 1, ""), (doc + 2, " \n\t"), (doc + 3, "a a a a a"), (doc + 4, "A a a a a a a a"), (doc + 5, "a a a")]


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_against_brute_force(spark):
    rows = corpus()
    assert result(N.ngram_components(frame(spark, rows))) == brute(rows)


def test_small_clusters_and_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(N, "CLUSTER_TEXTS", 4)
    monkeypatch.setattr(N, "LEAST_BUCKETS", 3)
    rows = corpus(9)
    assert result(N.ngram_components(frame(spark, rows))) == brute(rows)


def test_sides_visit_only_where_they_have_candidates(spark, monkeypatch):
    monkeypatch.setattr(N, "CLUSTER_TEXTS", 20)
    rng = random.Random(3)
    families = [words_of(f"f{k}", 60) for k in range(3)]
    rows = []
    for i in range(240):  # families that share passages, so that all fall in one cluster, with many copies at the edge of the threshold
        words = list(families[i % 3])
        if i % 2:
            words[:25] = families[(i + 1) % 3][:25]
        for _ in range(rng.choice([0, 1, 2, 4])):
            words[rng.randrange(60)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert result(N.ngram_components(frame(spark, rows))) == brute(rows)


def test_driver_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert result(N.ngram_components(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_a_bucket_without_repeated_shingles(spark):
    rows = [(1, " ".join(words_of("a", 200))), (2, " ".join(words_of("b", 200)))]  # one block, whose head is in one of many buckets
    assert result(N.ngram_components(frame(spark, rows, parts=1))) == {1: (196, 1), 2: (196, 2)}


def test_empty_repeated_null_and_long(spark):
    assert N.ngram_components(frame(spark, [])).count() == 0
    long = " ".join(words_of("l", 30_000))
    rows = [(1, "x y z u v w"), (1, "x y z u v w"), (None, "x y z u v w"), (None, "other"), (7, long), (8, long + " tail")]
    got = sorted(map(tuple, N.ngram_components(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (7, 29_996, 7), (8, 29_997, 7)], key=str)


def test_a_star_of_copies_is_one_component_without_all_pairs():
    base = np.arange(1, 401, dtype=np.uint64)
    rng = np.random.default_rng(1)
    sets = [base] + [np.sort(np.concatenate([np.delete(base, rng.choice(400, 30, replace=False)), rng.integers(10**6, 10**9, 30).astype(np.uint64)])) for _ in range(60)]
    links = N.verified_links(np.array([len(s) for s in sets]), sets, None, 75)
    assert len(links) == 60  # a spanning tree


def test_a_cluster_of_thousands_is_verified_by_few_pairs(monkeypatch):
    base = np.arange(1, 201, dtype=np.uint64)
    rng = np.random.default_rng(2)
    sets = [base] + [np.sort(np.concatenate([np.delete(base, rng.choice(200, 12, replace=False)), rng.integers(10**6, 10**9, 12).astype(np.uint64)])) for _ in range(3000)]
    sizes, calls = np.array([len(s) for s in sets]), []
    overlap = N._overlap
    monkeypatch.setattr(N, "_overlap", lambda a, b: calls.append(1) or overlap(a, b))
    assert len(N.verified_links(sizes, sets, None, 75)) == 3000
    assert len(calls) < 3 * 3000  # of 4.5 million pairs
    calls.clear()
    assert not N.verified_links(sizes, sets, (np.arange(3001) % 2), 75, np.zeros(3001, np.int64)) and not calls  # all known to be linked


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).unionByName(spark.createDataFrame([(900, 901), (900, 900)], "u long, v long"))
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[901] == 900


def test_a_block_takes_little_memory():
    """All tasks of an executor hold a block each."""
    import random
    import tracemalloc

    import pyarrow as pa

    from cardloom.llm import ngram_join as N

    rng = random.Random(5)
    words = [f"w{n}" for n in range(5000)]
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(N.BLOCK_BYTES // 3500)]
    list(N._block_rows(pa.array([1], pa.int64()), pa.array(texts[:1]), 0, 32))  # what is loaded once does not count
    tracemalloc.start()
    rows = sum(1 for _ in N._block_rows(pa.array(range(len(texts)), pa.int64()), pa.array(texts), 0, 32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 33 and peak < 60e6
