"""Cases that went wrong once: shards beside a huge group, labels in many copies, layouts that lost their article."""

from __future__ import annotations

import random

import pytest

from cardloom.llm.html_extract import foreign_name, grow, labelled_table, main_text
from cardloom.llm.sharding import level_shards, shard_documents
from tests.llm.helpers import frame


def loads(runs, shards):
    out = [0] * shards
    for (size, count), parts in zip(runs, level_shards(runs, shards)):
        assert sum(n for _, n in parts) == count and all(n > 0 for _, n in parts)
        for b, n in parts:
            out[b] += size * n
    return out


def test_huge_groups_leave_the_rest_level():
    out = loads([(1000, 1), (10, 900)], 24)
    assert max(out) == 1000 and sorted(out)[-2] <= 400 and min(out) >= 200
    rng = random.Random(1)
    sizes = sorted({rng.randint(20, 4000) for _ in range(3000)}, reverse=True)
    rest = [(s, rng.randint(1, 4)) for s in sizes]
    third = sum(s * n for s, n in rest) // 2
    out = sorted(loads([(third, 1), *rest], 24))
    assert out[-1] == third and out[-2] <= 1.03 * out[0]
    out = sorted(loads([(third, 2), (third // 10, 3), *rest], 24))
    assert out[-2:] == [third] * 2 and out[-6] <= 1.03 * out[0]


@pytest.mark.parametrize(("runs", "shards", "want"), [([(5, 1)], 3, [0, 0, 5]), ([], 2, [0, 0]), ([(100, 5)], 4, [100, 100, 100, 200]), ([(9, 2), (1, 1)], 1, [19]), ([(8, 1), (8, 0 + 1), (1, 1)], 5, [0, 0, 1, 8, 8])])
def test_few_groups(runs, shards, want):
    assert sorted(loads(runs, shards)) == want


def test_a_third_of_the_bytes_in_one_text(spark):
    rows = [(i, "hot " * 50) for i in range(200)] + [(1000 + i, f"text {i} " * (3 + i % 9)) for i in range(900)]
    got = shard_documents(frame(spark, rows), 8).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert len(got) == 1100 and set(by) == set(range(8))
    hot = {r.shard for r in got if r.doc_id < 200}
    assert len(hot) == 1
    rest = [sum(r.size for r in rs) for s, rs in by.items() if s not in hot]
    assert max(rest) <= 1.03 * min(rest)


def test_more_sizes_than_the_driver_takes(spark, monkeypatch):
    from cardloom.llm import sharding

    monkeypatch.setattr(sharding, "MAX_SIZES", 60)
    rows = [(i, "x" * i) for i in range(400)]
    got = shard_documents(frame(spark, rows), 5).collect()
    total = [sum(r.size for r in got if r.shard == s) for s in range(5)]
    assert len(got) == 400 and sorted(r.size for r in got) == [8 + i for i in range(400)] and max(total) <= 1.1 * min(total)


def letter_words(head, n):
    return [head + "".join("abcdefghij"[int(c)] for c in f"{i:03d}") for i in range(n)]


def toxic_corpus():
    rng = random.Random(2)
    mild, bad = letter_words("pl", 300), ["vilest", "horrid", "loathe", "wretch"]
    docs = []
    for i in range(400):
        words = rng.choices(mild, k=60)
        if i % 10 == 0:
            for at in rng.sample(range(60), 6):
                words[at] = rng.choice(bad)
        docs.append((i, " ".join(words)))
    return docs, [(i, int(i % 10 == 0)) for i in range(400)]


def separated(spark, docs, labels):
    from cardloom.llm.toxicity import fit, score_texts

    model = fit(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model is not None
    return {r.doc_id: r.score for r in score_texts(frame(spark, docs), model).collect()}


def test_labels_in_many_copies_and_of_absent_documents(spark):
    docs, labels = toxic_corpus()
    once = separated(spark, docs, labels)
    copied = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("doc_id", "toxic", "explode(sequence(1, 2000)) as n").drop("n")
    absent = spark.range(10_000, 60_000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    from cardloom.llm.toxicity import fit, score_texts

    model = fit(frame(spark, docs), copied.unionByName(absent))
    again = {r.doc_id: r.score for r in score_texts(frame(spark, docs), model).collect()}
    assert again == once
    assert sum(once[i] >= 0.5 for i in range(0, 400, 10)) >= 36 and sum(once[i] >= 0.5 for i in range(400) if i % 10) <= 10


def test_a_toxic_passage_far_into_a_text_is_learnt(spark):
    docs, labels = toxic_corpus()
    far = [(i, " ".join(letter_words("far", 200) * 20) + " " + t) for i, t in docs]
    scores = separated(spark, far, labels)
    toxic, plain = [scores[i] for i in range(0, 400, 10)], [scores[i] for i in range(400) if i % 10]
    assert sum(t > max(plain) for t in toxic) >= 30


TREE = grow(labelled_table())
TEXT = "<p>" + " ".join(f"word{i}" for i in range(72)) + ".</p>"
NAV = '<nav><a href="/">Home</a> <a href="/x">X</a></nav>'
LAYOUTS = {
    "name on article": (f'{NAV}<article class="post share-enabled">{TEXT}</article>', 72), "name on main": (f'{NAV}<main class="legal">{TEXT}</main>', 72),
    "around article": (f'{NAV}<div class="related-work"><article>{TEXT}</article></div>', 72), "lone container": (f'{NAV}<div class="legal-text">{TEXT}</div>', 72),
    "section of an article": (f'<article>{TEXT}<section id="discussion">{TEXT}</section></article>', 144), "part of an article": (f'<article>{TEXT}<div class="social-history">{TEXT}</div></article>', 144),
    "legal news": (f'<main><div class="notice legal">{TEXT}</div></main>', 72), "an alert of weather": (f'<article><section class="alerts">{TEXT}{TEXT}</section></article>', 144),
    "follow the river": (f'<article>{TEXT}<div class="follow-the-river">{TEXT}</div></article>', 144), "share of the market": (f'<main><section id="market-share-analysis">{TEXT}</section></main>', 72),
    "advertising history": (f'<main><section class="advertising-history">{TEXT}</section></main>', 72), "consent in medicine": (f'<article><section id="consent">{TEXT}</section></article>', 72),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_articles_are_kept(name):
    page, words = LAYOUTS[name]
    assert len(main_text(f"<html><body>{page}</body></html>", TREE).split()) == words


@pytest.mark.parametrize("name", ["comments", "comment-list", "related-posts", "social-share", "cookie-banner", "newsletter-signup", "ad-slot", "sidebar-ad", "share-buttons", "promo", "advertisement", "subscribe-box", "recommended"])
def test_text_of_others_is_dropped(name):
    assert foreign_name(name) == "yes"
    page = f"<html><body><article>{TEXT}<div class='{name}'>{TEXT}</div></article></body></html>"
    assert len(main_text(page, TREE).split()) == 72


def test_a_teaser_is_not_the_page():
    page = f'<html><body>{NAV}<div>{TEXT}{TEXT}</div><article><h3><a href="/t">Teaser</a></h3><p><a href="/t">Read on here</a></p></article><article class="comment"><p>{"I agree with this. " * 20}</p></article></body></html>'
    text = main_text(page, TREE)
    assert text.count("word71") == 2 and "Read on" not in text and "agree" not in text
