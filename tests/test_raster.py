"""Pixels: profiles and grids of whole pages, connected components, closing and strips against plain versions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.operators import geometry as G
from cardloom.operators import raster as P
from cardloom.operators import strips as S
from cardloom.schema import LAYOUT, Layout


def graymap(grey):
    return b"P5\n# made up\n%d %d\n255\n" % grey.shape[::-1] + grey.tobytes()


def ruled_page(w=1983, h=2806, filled=lambda i: True):
    """A page of 3 x 10 ruled cells, with some ink in those that are filled."""
    grey = np.full((h, w), 255, np.uint8)
    left, right, top, bottom = int(0.0237 * w), int(0.9743 * w), int(0.0335 * h), int(0.9701 * h)
    wide, high = (right - left) / 3, (bottom - top) / 10
    for r in range(11):
        y = int(top + r * high)
        grey[max(0, y - 1) : y + 2, left:right] = 0
    for c in range(4):
        x = int(left + c * wide)
        grey[top:bottom, max(0, x - 1) : x + 2] = 0
    for i in range(30):
        if filled(i):
            y, x = int(top + i // 3 * high), int(left + i % 3 * wide)
            grey[y + 60 : y + 160 : 7, x + 40 : x + 560 : 3] = 30
            grey[y + 61 : y + 161 : 7, x + 40 : x + 560 : 3] = 30
    return grey


def frame_of(spark, *pages):
    return spark.createDataFrame([("d", n, bytearray(graymap(g) if isinstance(g, np.ndarray) else g)) for n, g in enumerate(pages, 1)], "doc string, page int, content binary").repartition(2)


def test_thirty_cells_of_a_ruled_page(spark):
    odd = lambda i: i % 2 == 1
    got = {r.page: r for r in P.grid_cards(frame_of(spark, ruled_page(), ruled_page(filled=odd), b"P5\n3", b""), ["doc", "page"]).collect()}
    assert len(got[1].cells) == 30 and all(c.occupied for c in got[1].cells) and len({c.x for c in got[1].cells}) == 3
    assert [c.card_index for c in got[2].cells if c.occupied] == [i for i in range(30) if odd(i)]
    assert got[1].frame.asDict() == {"x": 46, "y": 94, "w": 1886, "h": 2628} and got[1].error is None
    assert got[3].cells is None and "ValueError" in got[3].error and got[4].error


def test_the_margin_of_a_cell_is_no_ink(spark):
    """Ink beside the ruling, inside the inset but outside the inner part of a cell, does not fill it; without a margin it would."""
    grey = ruled_page(filled=lambda i: i == 4)
    left, top = int(0.0237 * 1983), int(0.0335 * 2806)
    for r in range(10):
        y = int(top + r * 262.8)
        grey[y + 7 : y + 16, left + 12 : left + 600 : 2] = 20
        grey[y + 247 : y + 256, left + 12 : left + 600 : 2] = 20
    count = lambda layout: [c.card_index for c in P.grid_cards(frame_of(spark, grey), ["doc", "page"], layout).first().cells if c.occupied]
    assert count(LAYOUT) == [4] and len(count(Layout(probe_margin=0))) == 11


def test_profiles_and_lines_equal_a_scan(spark):
    rng = np.random.default_rng(1)
    grey = rng.integers(0, 256, (90, 70)).astype(np.uint8)
    grey[10:13, 5:60] = 0
    grey[40, 0:65] = 0
    r = P.lined(P.profiled(frame_of(spark, grey))).first()
    assert r.column_dark == (grey < 120).sum(axis=0).tolist() and r.row_dark == (grey < 120).sum(axis=1).tolist() and r.ink == pytest.approx((grey < 140).mean())
    rows = np.flatnonzero((grey < 120).sum(axis=1) >= 0.4 * 70).tolist()
    groups = [[rows[0]]]
    for y in rows[1:]:
        groups[-1].append(y) if y - groups[-1][-1] <= 4 else groups.append([y])
    assert r.row_lines == [(g[0] + g[-1]) // 2 for g in groups]


def test_lines_far_from_the_frame_divide_nothing(spark):
    grey = ruled_page()
    grey[20:23, 46:1932] = 0  # above the frame by more than the reach, but too high to be its top
    assert P.grid_cards(frame_of(spark, grey), ["doc", "page"]).first().cells == P.grid_cards(frame_of(spark, ruled_page()), ["doc", "page"]).first().cells


def test_clusters_and_peaks_of_arrays(spark):
    rng = np.random.default_rng(2)
    for _ in range(4):
        values = np.sort(rng.integers(0, 200, 25)).tolist()
        groups = [[values[0]]]
        for v in values[1:]:
            groups[-1].append(v) if v - groups[-1][-1] <= 5 else groups.append([v])
        got = spark.createDataFrame([(values[::-1],)], "v array<int>").select(G.cluster_medians(F.col("v"), 5).alias("m"), G.cluster_medians(F.array().cast("array<int>"), 5).alias("n")).first()
        assert got.m == [int(np.median(g)) for g in groups] and got.n == []


def flood(mask, diagonal):
    left, out = {tuple(p) for p in np.argwhere(mask)}, []
    while left:
        todo = [min(left)]
        left.discard(todo[0])
        part = []
        while todo:
            y, x = todo.pop()
            part.append((y, x))
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    if (diagonal or not (dy and dx)) and (y + dy, x + dx) in left:
                        left.discard((y + dy, x + dx))
                        todo.append((y + dy, x + dx))
        ys, xs = zip(*part)
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1))
    return sorted(out)


@pytest.mark.parametrize("share", [0.0, 0.1, 0.35, 0.5, 0.65, 0.9, 1.0])
def test_components_equal_flood_fill(share):
    rng = np.random.default_rng(int(share * 100))
    for shape in ((1, 1), (1, 30), (30, 1), (37, 41)):
        mask = rng.random(shape) < share
        for diagonal in (True, False):
            assert sorted(map(tuple, P.component_boxes(mask, diagonal).tolist())) == flood(mask, diagonal)


def test_components_of_spirals_and_combs():
    spiral = np.zeros((60, 60), bool)
    for k in range(0, 28, 4):
        spiral[k, k : 60 - k] = spiral[k : 60 - k, 59 - k] = spiral[59 - k, k : 60 - k] = True
        spiral[k + 4 : 60 - k, k] = True
        spiral[k + 4, k : k + 5] = True
    comb = np.zeros((40, 81), bool)
    comb[:, ::2] = True
    comb[39, :] = True
    for mask in (spiral, comb, ~comb):
        assert sorted(map(tuple, P.component_boxes(mask).tolist())) == flood(mask, True)


def test_holes_are_outlines_of_their_own():
    mask = np.zeros((30, 40), bool)
    mask[5:25, 4:36] = True
    mask[8:22, 7:33] = False
    assert sorted(map(tuple, P.outline_boxes(mask).tolist())) == [(4, 5, 32, 20), (6, 7, 28, 16)]
    assert len(P.outline_boxes(np.zeros((5, 5), bool))) == 0


def test_closing_equals_its_definition():
    rng = np.random.default_rng(3)
    mask = rng.random((26, 33)) < 0.08

    def spread(m, every):
        out = np.zeros_like(m)
        for y in range(m.shape[0]):
            for x in range(m.shape[1]):
                window = m[max(0, y - 3) : y + 4, max(0, x - 4) : x + 5]
                out[y, x] = window.all() if every else window.any()
        return out

    plain = spread(spread(spread(spread(mask, False), False), True), True)
    assert (P.closed(mask) == plain).all()


def test_local_threshold_equals_its_definition():
    rng = np.random.default_rng(4)
    grey = rng.integers(0, 256, (40, 50)).astype(np.uint8)
    at = np.arange(-15, 16)
    w = np.exp(-at * at / 50.0)
    w /= w.sum()
    padded = np.pad(grey.astype(float), 15, mode="edge")
    mean = np.array([[w @ padded[y : y + 31, x : x + 31] @ w for x in range(50)] for y in range(40)])
    sure = np.abs(mean - np.rint(mean)) < 0.499
    assert (P.local_dark(grey) == (grey <= np.rint(mean) - 8))[sure].all()
    assert not P.local_dark(np.full((20, 20), 90, np.uint8)).any()


def test_cards_by_their_outlines(spark):
    grey = np.full((1100, 900), 255, np.uint8)
    boxes = [(20 + 290 * (i % 3), 30 + 120 * (i // 3), 270, 105) for i in range(9)] + [(30, 600, 700, 110), (40, 800, 60, 60)]
    for x, y, w, h in boxes:
        grey[y : y + h, x : x + w] = 0
        grey[y + 2 : y + h - 2, x + 2 : x + w - 2] = 255
    got = {r.page: r for r in P.contour_cards(frame_of(spark, grey, np.full((60, 60), 255, np.uint8), b"x"), ["doc", "page"]).collect()}
    assert [tuple(b) for b in got[1].cards] == boxes[:9] and got[2].cards == [] and got[3].error and got[3].cards is None


def test_pages_are_classified_and_their_detector_chosen(spark):
    lines = np.full((800, 600), 255, np.uint8)
    lines[40:760:60, 20:580] = 0  # twelve rules, no cells
    few = ruled_page(filled=lambda i: i in (3, 8))
    got = {r.page: r for r in P.detected(frame_of(spark, ruled_page(), np.full((400, 300), 255, np.uint8), lines, few, b"-"), ["doc", "page"]).collect()}
    assert (got[1].page_type, got[1].method, len(got[1].cards)) == ("voter", "grid", 30)
    assert got[2].page_type == "blank" and got[3].page_type == "header"
    assert (got[4].method, len(got[4].cards)) == ("contour", 30)  # the rules of all cells are seen, the ink of two
    assert got[5].page_type is None and got[5].error


CARDS = "doc string, page int, card_index long, x int, y int, w int, h int"


def test_strips_keep_text_and_wipe_the_rest(spark):
    rng = np.random.default_rng(5)
    grey = rng.integers(0, 200, (260, 700)).astype(np.uint8)
    boxes = {0: (10, 12, 200, 81), 1: (216, 10, 203, 83), 2: (415, 15, 199, 80), 4: (220, 120, 180, 75), 5: (420, 118, 3, 3)}
    cards = spark.createDataFrame([("d", 1, i, *b) for i, b in boxes.items()], CARDS)
    got = {r.row: np.frombuffer(r.grey, np.uint8).reshape(r.h, r.w) for r in P.strip_images(frame_of(spark, grey), cards, ["doc", "page"]).collect()}
    assert set(got) == {0, 1}
    for row, image in got.items():
        own = {i: b for i, b in boxes.items() if i // 3 == row}
        x0, y0 = min(b[0] for b in own.values()), min(b[1] for b in own.values())
        want = np.full((max(b[1] + b[3] for b in own.values()) - y0, max(b[0] + b[2] for b in own.values()) - x0), 255, np.uint8)
        for _, (x, y, w, h) in sorted(own.items()):
            card = np.full((h, w), 255, np.uint8)
            for name in ("text", "epic", "epic_fallback"):
                bx, by, bw, bh = LAYOUT.boxes[name]
                a, b = min(w - 1, round(bx * w)), min(h - 1, round(by * h))
                c, d = min(max(1, round(bw * w)), w - a), min(max(1, round(bh * h)), h - b)
                card[b : b + d, a : a + c] = grey[y : y + h, x : x + w][b : b + d, a : a + c]
            card[:3], card[-3:], card[:, :3], card[:, -3:] = 255, 255, 255, 255
            want[y - y0 : y - y0 + h, x - x0 : x - x0 + w] = card
        assert (image == want).all()


def test_positions_in_strips_go_back_to_cards(spark):
    rng = np.random.default_rng(6)
    boxes = {0: (10, 12, 200, 81), 1: (190, 10, 203, 83), 2: (415, 15, 199, 80), 4: (220, 120, 180, 75)}
    cards = spark.createDataFrame([("d", 1, i, *b) for i, b in boxes.items()], CARDS)
    points = [("d", 1, int(row), n, int(x), int(y)) for n, (row, x, y) in enumerate(zip(rng.integers(0, 3, 400), rng.integers(-20, 640, 400), rng.integers(-5, 100, 400)))]
    got = S.located(spark.createDataFrame(points, "doc string, page int, row long, seq int, sx int, sy int"), cards, "doc", "page")
    assert "CartesianProduct" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    regions = {(w, h): spark.range(1).select(S.kept_regions(F.lit(w), F.lit(h)).alias("r")).first().r for _, _, w, h in boxes.values()}
    for r in got.collect():
        own = [(i, b) for i, b in sorted(boxes.items()) if i // 3 == r.row]
        found = None
        for i, (x, y, w, h) in own:
            dx, dy = x - min(b[0] for _, b in own), y - min(b[1] for _, b in own)
            if dx <= r.sx < dx + w and dy <= r.sy < dy + h:
                cx, cy = r.sx - dx, r.sy - dy
                inside = [q.region for q in regions[w, h] if q.x <= cx < q.x + q.w and q.y <= cy < q.y + q.h]
                found = (i, inside[0] if inside else None, cx, cy)
        assert (r.card_index, r.region, r.card_x, r.card_y) == (found or (None,) * 4)


def test_colours_become_grey():
    rgb = np.array([[[255, 0, 0], [0, 255, 0]], [[0, 0, 255], [10, 20, 30]]], np.uint8)
    grey = P.decoded(b"P6 2 2 255\n" + rgb.tobytes())
    assert grey.tolist() == [[76, 150], [29, 18]]
    for bad in (b"P5 2 2 255\nx", b"P4 1 1 255\n0", b"P5 1 1 65535\n00"):
        with pytest.raises(ValueError):
            P.decoded(bad)


def test_pages_of_small_tables_are_dealt_to_many_tasks(spark, sf):
    """A table of some kilobytes is one split, but each of its rows becomes a page of pixels."""
    from cardloom.plans import raster as plans

    tasks = []
    plain = P.contour_cards
    P.contour_cards = lambda pages, key: tasks.append(pages.rdd.getNumPartitions()) or plain(pages, key)
    try:
        plans.contour_boxes(spark, sf)
    finally:
        P.contour_cards = plain
    assert tasks[0] >= 16 and plans._ruled_pages(spark, sf).rdd.getNumPartitions() >= 16


def test_dark_pixels_are_the_same_where_few_are_looked_at():
    rng = np.random.default_rng(7)
    weights = np.exp(-np.square(np.arange(-15, 16)) / 50.0)
    weights = (weights / weights.sum()).astype(np.float32)
    sparse = 0
    for n in range(60):
        grey = np.full((int(rng.integers(1, 120)), int(rng.integers(1, 120))), rng.integers(0, 256), np.uint8)
        if n % 3 == 0:
            grey[:] = rng.integers(0, 256, grey.shape)
        grey[rng.random(grey.shape) < 0.003] = rng.integers(0, 256)
        sparse += P._stretched(grey <= max(int(grey.max()) - P.DARKER, -1), P.WINDOW, 1).mean() <= P.SPARSE
        assert (P.local_dark(grey) == (grey.astype(np.int16) <= np.rint(P._means(grey, weights)).astype(np.int16) - P.DARKER)).all()
    assert 10 < sparse < 60
    assert P.local_dark(np.zeros((0, 5), np.uint8)).shape == (0, 5)


def test_errors_and_large_pages_between_others(spark):
    big = b"P5 2100 2000 255\n" + bytes(2100 * 2000)  # more bytes than are looked at together
    rows = [(0, b"P5 2 1 255\n\x00\xff"), (1, None), (2, big), (3, b"P5 0"), (4, b"P5 1 2 255\n\x00\x00")]
    got = {r.page: r for r in P.profiled(spark.createDataFrame(rows, "page long, content binary").coalesce(1)).collect()}
    assert [got[0].column_dark, got[0].row_dark, got[4].row_dark, sum(got[2].row_dark)] == [[1, 0], [1], [1, 1], 2100 * 2000]
    assert got[1].column_dark is None and got[1].error and got[3].page_w is None and got[3].error and not got[0].error and not got[2].error


def test_profiled_pages_are_dealt_to_many_tasks(spark, sf):
    from cardloom.plans import raster as plans

    assert plans.raster_profile(spark, sf).rdd.getNumPartitions() >= 16
