from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest

from cardloom.llm import decontaminate as D
from cardloom.llm import html_extract as H
from cardloom.llm import language_id as L
from cardloom.llm import license_scan as C
from cardloom.llm import quality_rules as Q
from cardloom.llm import toxicity as T
from cardloom.llm import url_filter as U
from tests.llm.helpers import SPACE, frame, words_of

ENGLISH, SPANISH = "the of and to with thing that was from".split(), "el de que las con para niño está los".split()


def bilingual(n, seed=1):
    rng = random.Random(seed)
    make = lambda words, salt: " ".join(rng.choice(words) + rng.choice(["", salt]) for _ in range(rng.randrange(20, 60)))
    return [(i, make(ENGLISH, "ing"), "en", f"s{i % 3}") if i % 2 else (i, make(SPANISH, "ción"), "es", f"s{i % 3}") for i in range(n)]


# language


def test_languages_and_code_switching(spark):
    rows = bilingual(120)
    docs = frame(spark, rows)
    model = L.fit(docs.filter("doc_id < 100"))
    extra = [(500, None), (501, ""), (502, "123 !! ..."), (503, "THE THING, that was!"), (504, "el niño está con las cosas. " * 3000), (505, "the thing that was from the house el de que")]
    got = {r.doc_id: r for r in L.predict(frame(spark, [*rows[100:], *extra]), model).collect()}
    assert all(got[r[0]].lang_pred == r[2] and 0 <= got[r[0]].score <= 1 for r in rows[100:])
    assert [got[i].lang_pred for i in (500, 501, 502, 503, 504, 505)] == ["und", "und", "und", "en", "es", "en"]
    assert got[500].score == 0 and got[505].score < got[503].score
    assert L.fit(docs.limit(0)) is None
    assert L.predict(docs.limit(2), None).first().lang_pred == "und"


def test_every_label_is_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "EPOCHS", 3)
    rows = [(i, " ".join(f"{chr(97 + k // 26)}{chr(97 + k % 26)}{w}" for w in ("na", "bel", "tor", "is")), f"l{k:02}", "s") for k in range(70) for i in (2 * k, 2 * k + 1)]
    assert L.fit(frame(spark, rows)).languages == [f"l{k:02}" for k in range(70)]
    books = [(i, " ".join(ENGLISH) + " ", "en", "s") for i in range(40)] + [(100 + i, " ".join(SPANISH) + f" {i}" + " el niño está con las cosas" * 2000, "es", "s") for i in range(3)]
    model = L.fit(frame(spark, books))
    assert model.languages == ["en", "es"] and L.predict(frame(spark, [(1, "los que está para el niño")]), model).first().lang_pred == "es"


def test_the_sample_is_bounded():
    assert L.sample_sizes(4) == (L.SAMPLE_DOCS, L.SAMPLE_CHARS)
    for k in (1, 8, 64, 65, 200, 1000):
        each, chars = L.sample_sizes(k)
        assert each >= L.LEAST_DOCS and chars >= L.LEAST_CHARS and each * k <= max(L.SAMPLE_TOTAL, L.LEAST_DOCS * k)
        assert each * chars * k <= max(L.SAMPLE_TOTAL_CHARS, L.LEAST_CHARS * each * k)


def test_forward_backward_against_enumeration():
    from itertools import product

    import numpy as np

    rng = np.random.default_rng(0)
    e, trans, first = rng.random((4, 1, 2)) + 0.1, rng.random((2, 2)) + 0.1, rng.random(2) + 0.1
    total, every, _, _ = L.posterior(e, np.ones(4, int), np.ones((4, 1)), trans, first, collect=True)
    weight = np.zeros((4, 2))
    for path in product(range(2), repeat=4):
        p = first[path[0]] * np.prod([e[t, 0, k] for t, k in enumerate(path)]) * np.prod([trans[a, b] for a, b in zip(path, path[1:])])
        for t, k in enumerate(path):
            weight[t, k] += p
    assert np.allclose(every[:, 0], weight / weight[0].sum()) and np.allclose(total[0], (weight / weight[0].sum()).sum(axis=0))


# licences


def test_licences(spark):
    mit = C.TEMPLATES[4][1]
    rows = [(1, "Some text of many words that go on and on.\nLicensed under the Apache License, version 2.0!\nmore of it follows"), (2, None), (3, ""), (4, "\n\n"), (5, mit.upper()), (6, "intro\n\n" + mit.replace(", ", ",\n") + "\n\nend"), (7, "nothing by the way " * 9000), (8, "released  under the\tMIT license"), (8, "released  under the\tMIT license"), (9, "under the license of others we are all equal")]
    got = sorted((r.doc_id, r.kind, r.number, r.license) for r in C.scan_licenses(frame(spark, rows)).collect())
    assert got == [(1, "line", 1, "Apache-2.0"), (5, "line", 0, "MIT"), (6, "paragraph", 1, "MIT"), (8, "line", 0, "MIT"), (8, "line", 0, "MIT")]
    assert C.scan_licenses(frame(spark, [])).count() == 0


def test_a_licence_in_a_comment_block(spark):
    parts = [t for n, t in C.TEMPLATES if n == "MIT"][1:]
    block = "/*\n * Copyright (c) A. Writer\n *\n" + "\n *\n".join(" * " + " ".join(p.split()[:12]) + "\n * " + " ".join(p.split()[12:]) for p in parts) + "\n */\ncode();"
    got = sorted((r.kind, r.license, r.dice) for r in C.scan_licenses(frame(spark, [(1, block)])).collect())
    assert [x[:2] for x in got if x[0] == "paragraph"] == [("paragraph", "MIT")] * len(parts)
    assert {n for n, _ in C.TEMPLATES} == {r.license for r in C.scan_licenses(frame(spark, [(n, t) for n, (_, t) in enumerate(C.TEMPLATES)])).collect()}


def test_anchors_never_miss():
    rng = random.Random(4)
    for _, text in C.TEMPLATES:
        words = C.template_words(text)
        anchored = C.anchors(words, C.THRESHOLD)
        held = Counter(zip(words, words[1:]))
        for _ in range(200):
            unit = [w if rng.random() < 0.9 else "zzz" for w in words]
            own = Counter(zip(unit, unit[1:]))
            dice = 2 * sum((own & held).values()) / (len(unit) + len(words) - 2)
            assert dice < C.THRESHOLD or anchored & set(unit)


# quality


def counts(text):
    w = SPACE.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["ab", "cde", "fghi", "jk", "l"]) + str(rng.randrange(900)) for _ in range(rng.randrange(60, 200))), "en", f"s{i % 2}") for i in range(400)]
    junk = [(1000 + i, " ".join(w + "###$$$" for w in words_of(i, 90)), "en", "s0") for i in range(20)]
    odd = [(2000, None, None, None), (2001, "", "en", "s0"), (2002, "a b a b a b a b " * 20, "en", "s0"), (2003, "x y\n\nx y\r\nx y\n z\x0bz", "en", "s0"), (2004, " ".join(words_of("big", 40_000)), "xx", None), (2005, "é ñ 😀 q", "en", None)]
    got = {r.doc_id: r for r in Q.quality_verdicts(frame(spark, [*rows, *junk, *odd])).collect()}
    for i, text, *_ in [*rows, *junk, *odd]:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert all(got[r[0]].kept for r in rows) and not any(got[r[0]].kept for r in junk)
    assert not got[2000].kept and got[2004].kept
    assert Q.quality_verdicts(frame(spark, [])).count() == 0
    assert abs(Q.CUTOFF - 28.47) < 0.01


def test_rare_sources_are_judged_by_their_language(spark):
    rng = random.Random(9)
    make = lambda tail="": " ".join(rng.choice(["ab", "cde", "fghi", "jk", "l"]) + str(rng.randrange(900)) + tail for _ in range(rng.randrange(60, 200)))
    large = [(i, make(), "en", "large") for i in range(300)]
    junk = [(1000 + i, make("###$$$"), "en", "new") for i in range(60)]
    fair = [(2000 + i, make(), "en", "fair") for i in range(10)]
    small = [(3000 + i, make("zzz"), "xx", f"s{i % 3}") for i in range(40)]
    odd = [(4000 + i, make("zzz###$$$"), "xx", f"s{i}") for i in range(3)]
    lone = [(5000, make("y" * 12), None, None), (5001, make("w" * 30), "yy", "a"), (5002, make(), "yy", "b")]
    got = {r.doc_id: r for r in Q.quality_verdicts(frame(spark, [*large, *junk, *fair, *small, *odd, *lone])).collect()}
    assert not any(got[r[0]].kept for r in [*junk, *odd])
    assert all(got[r[0]].kept for r in [*large, *fair, *small, *lone])
    few = {r.doc_id: r for r in Q.quality_verdicts(frame(spark, [*small, *odd])).collect()}
    assert not any(few[r[0]].kept for r in odd) and all(few[r[0]].kept for r in small)


# toxicity


def test_toxicity(spark):
    rng = random.Random(2)
    bad = ("vilest", "rotter", "blockhead")
    word = lambda i, k: rng.choice(bad) if i % 4 == 0 and k % 12 == 5 else rng.choice(ENGLISH + SPANISH) + rng.choice("abcdefghij") * (k % 2)
    rows = [(i, " ".join(word(i, k) for k in range(60))) for i in range(400)]
    rng.shuffle(rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows if i < 300] + [(None, 1), (1, None), (99999, 1)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    model = T.fit(docs, labels)
    got = {r.doc_id: r.score for r in T.score_texts(frame(spark, [*rows, (900, None), (901, ""), (902, "12 ??"), (903, "Blockhead! " * 4000)]), model).collect()}
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i, _ in rows if i >= 300)
    assert got[900] == got[901] == got[902] < 0.3 <= got[903]
    assert T.fit(docs, labels.filter("toxic = 1")) is None and T.score_texts(docs, None).first().score == 0


# decontamination


def edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[:], i
        for j, b in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b))
    return min(row)


def test_matching_against_dynamic_programming():
    rng = random.Random(6)
    items = [(k, "".join(rng.choice("abcde ") for _ in range(rng.randrange(30, 90))).strip()) for k in range(8)]
    items = [(k, D.normalised(t)) for k, t in items]
    matcher = D.Matcher(items)
    for _ in range(60):
        k, item = rng.choice(items)
        noisy = list(item)
        for _ in range(rng.randrange(0, 7)):
            at = rng.randrange(len(noisy))
            rng.choice([lambda: noisy.__setitem__(at, "z"), lambda: noisy.insert(at, "y"), lambda: noisy.pop(at)])()
        text = D.normalised("".join(rng.choice("abcde ") for _ in range(80)) + " ".join(["", "".join(noisy), ""]) + "".join(rng.choice("abcde ") for _ in range(50)))
        found = {n: d for n, d, _, _ in matcher.find(text)}
        for n, t in items:
            if len(t) >= D.LEAST_CHARS:
                d = edit_distance_inside(t, text)
                assert found.get(n) == (d if d <= len(t) // D.CHARS_PER_ERROR else None)


def test_decontamination(spark):
    item = "The quick brown foxes jump over sixteen lazy dogs, near the old river bank."
    bench = spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, item.upper())], "item_id long, text string")
    rows = [(1, f"before {item} after"), (2, item.replace("lazy", "lasy").replace(", near", " near")), (3, None), (4, ""), (5, "unrelated " * 20_000), (6, f"{item} {item}"), (7, item[:30])]
    got = sorted((r.doc_id, r.item_id, r.distance) for r in D.contaminated(frame(spark, rows), bench).collect())
    assert got == sorted([(1, 1, 0), (1, 4, 0), (2, 1, 1), (2, 4, 1), (6, 1, 0), (6, 1, 0), (6, 4, 0), (6, 4, 0)])
    one = next(r for r in D.contaminated(frame(spark, rows), bench).collect() if r.doc_id == 1)
    assert rows[0][1][one.start : one.end] == item[:-1]  # without the last mark
    assert D.contaminated(frame(spark, []), bench).count() == 0 and D.contaminated(frame(spark, rows), bench.limit(0)).count() == 0


# urls


@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    ("http://Example.ORG/en/17?q", "example.org", "/en/17", "example.org/en/1", "block"), ("http://a.b.org/x", "a.b.org", "/x", "org/", "allow"), ("http://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
    ("http://example.org/es", "example.org", "/es", "org/", "allow"), ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"), ("http://org", "org", "", None, "allow"), ("ftp://x.com/de/a#t", "x.com", "/de/a", "com/de/", "block"),
    ("http://x.com?u=://y.org/", "x.com", "", None, "allow"), ("nothing", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://x.org:80/a", "x.org:80", "/a", None, "allow"), ("://a.org/b\nc", "a.org", "/b\nc", "org/", "allow"),
])
def test_urls(spark, url, host, path, rule, verdict):
    from cardloom.llm.queries import URL_RULES

    r = U.judge_urls(spark.createDataFrame([(1, url, "v", "r")], "page_id long, url string, verdict string, rule string"), URL_RULES).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_url_trie_against_a_scan():
    rng = random.Random(7)
    part = lambda alphabet, n, sep: sep.join(rng.choice(alphabet) for _ in range(rng.randrange(1, n)))
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((part("abc", 4, "."), "/" + part(["a", "b", "ab"], 4, "/")) for _ in range(60))}.values())
    trie = U.RuleTrie(rules)
    for _ in range(2000):
        host, path = part("abcd", 6, "."), "/" + part(["a", "b", "ab", "abb"], 6, "/")
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: (r[1].count("."), len(r[2])), default=None)
        assert trie.match(host, path) == (best and (best[1] + best[2], best[0]))


# html

PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy now</div>
<article><h1>News &amp; more</h1><p><b>One<br>two&nbsp;three.<p>A &lt;tag&gt; &#233;</p><ul><li>item</li></ul><form><p>Sign up</p></form><div class="comments"><p>First!</p></div></article><aside>Related</aside><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "just  text"), (5, "u", "<p>" + "word " * 50_000), (6, "u", "<div id='content'><p>Long enough to be the text of a page.</p></div><div class='sidebar'>x</div>"), (6, "u", "<p>a</p"), (7, "u", "<p>x < y</p><p unclosed")]
    got = {(r.page_id, r.text): r.n_chars for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as text", "1 as n_chars")).collect()}
    texts = {}
    for (i, t), n in got.items():
        assert n == len(t)
        texts.setdefault(i, []).append(t)
    assert texts[1] == ["News & more\n\nOne two three.\n\nA <tag> é\n\nitem"]
    assert texts[2] == texts[3] == [""] and texts[4] == ["just text"] and len(texts[5][0]) == 249_999
    assert sorted(texts[6]) == ["Long enough to be the text of a page.", "a"] and texts[7] == ["x < y"]
    assert H.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(("attributes", "hidden"), [
    ("style=\"overflow:hidden\"", False), ("style='overflow: hidden'", False), ("data-hidden=false", False), ("data-x=\"not hidden\"", False), ("title='class=\"sidebar\"'", False), ("data-class=sidebar", False), ("style=\"overflow: hidden", False),
    ("hidden", True), ("HIDDEN", True), ("id=a hidden=\"\"", True), ("class=\"x\"hidden", True), ("style=\"a:b\" hidden", True), ("aria-hidden = 'true'", True), ("aria-hidden=false", False), ("class = sidebar", True),
])
def test_only_the_attribute_named_hidden_hides(attributes, hidden):
    opened = H._opened("div", " " + attributes)
    assert (opened.hidden or opened.layout) == hidden
    if attributes.count('"') % 2 == 0:
        page = f"<body><div {attributes}><p>This paragraph is long enough to be the text of a page, one would say.</p></div></body>"
        assert (H.main_text(page, H.grow(H.labelled_table())) == "") == hidden


@pytest.mark.parametrize(("page", "text"), [
    ("<html><head><title>T</title><p>Hello there, this is a page.", "Hello there, this is a page."),
    ("<html><head><title>T</title><article><p>Hello", "Hello"), ("<head><script>var a='<p>x';</script><style>p{}</style>Body text", "Body text"),
    ("<article><svg><circle><path d='m'><p>after the drawing</p></article>", "after the drawing"), ("<article><math><mi>x</mi><p>after the formula", "after the formula"),
    ("<div class='layout-sidebar-right'><article><p>Kept.</p></article></div>", "Kept."), ("<div class=side><main><h2>Kept</h2><p>too</p></main></div>", "Kept\n\ntoo"), ("<form id='form-page'><article>Kept.</article></form>", "Kept."),
    ("<article><p>One.</p><p class='legal'>By law this paragraph says quite a lot of things, as a real one does here.</p></article>", "One.\n\nBy law this paragraph says quite a lot of things, as a real one does here."),
    ("<article><p>One.</p><p class='share'>Share this</p></article>", "One."), ("<article><p>One.</p><section class='comments'><h2>Comments</h2><article><p>Mine.</p></article></section></article>", "One."),
    ("<section id=comments><article><p>First!</p></article></section><article><p>One.</p></article>", "One."), ("<article><header><h1>Title</h1></header><p>One.</p><footer>By me</footer></article>", "Title\n\nOne."),
])
def test_left_out_tags_wrappers_and_unclosed_elements(page, text):
    assert H.main_text(page, H.grow(H.labelled_table())) == text


def test_unmarked_pages_are_told_by_words_and_links():
    """Held-out layouts without article or main: blocks labelled by hand (+ main text, - furniture)."""
    long = " ".join(f"word{i}" for i in range(60))
    links = lambda *xs: "".join(f"<li><a href=/{x}>{x}</a></li>" for x in xs)
    layouts = [
        [("-", f"<ul>{links('Home', 'News', 'About')}</ul>"), ("+", "<h1>A title</h1>"), ("+", f"<p>{long}</p>"), ("+", f"<p>{long}</p>"), ("-", f"<ul>{links('Older', 'Newer')}</ul>")],
        [("-", f"<div class=menu><ul>{links('a', 'b')}</ul></div>"), ("+", f"<div class='form-page'><p>{long}</p></div>"), ("+", f"<div class='form-page'><p>{long} and on</p></div>"), ("-", "<div class=copyright>All rights reserved by us</div>")],
        [("+", f"<table><tr><td>{long}</td></tr></table>"), ("+", "<p>Short line.</p>"), ("+", f"<p>{long} <a href=x>link</a></p>"), ("-", "<p><a href=1>1</a> <a href=2>2</a> <a href=3>next page</a></p>")],
        [("-", "<div class='cookie-bar'>We use cookies to make this page better, do you agree with that at all?</div>"), ("+", f"<blockquote>{long}</blockquote>"), ("+", "<h3>Then</h3>"), ("+", f"<pre>{long}</pre>"), ("-", "<div id=sidebar><p>Join us</p></div>")],
    ]
    tree, right, total = H.grow(H.labelled_table()), 0, 0
    for layout in layouts:
        page = "<body>" + "".join(x for _, x in layout) + "</body>"
        kept = {b.text: H.decide(tree, f) >= 0.5 for b, f in zip(H.blocks_of(page), H.block_features(H.blocks_of(page)))}
        for label, part in layout:
            for b in H.blocks_of(part):
                total += 1
                right += kept[b.text] == (label == "+")
    assert total >= 22 and right / total >= 0.95
    used = set()

    def walk(node):
        if isinstance(node, tuple):
            used.add(H.FEATURES[node[0]])
            walk(node[2])
            walk(node[3])

    walk(tree)
    assert {"words", "link_density", "words_before", "words_after"} <= used or {"words", "link_density", "link_density_before", "link_density_after"} <= used


def test_articles_of_the_driver_pages(spark, sf):
    import html
    import re

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert H.main_text(r.html, H.grow(H.labelled_table())) == "\n\n".join(x for x in parts if x)


def test_folds(spark):
    from cardloom.llm.common import crc_mod

    assert [r[0] for r in spark.createDataFrame([(1,), (77,), (None,)], "doc_id long").select(crc_mod("doc_id", 5)).collect()] == [zlib.crc32(b"1") % 5, zlib.crc32(b"77") % 5, 0]
