"""Geometry of pages: boxes, clusters of positions, runs and bands, card grids, and the choice of detector and page class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.schema import LAYOUT, Layout


def box_columns(x: str = "x", y: str = "y", w: str = "w", h: str = "h") -> dict[str, Column]:
    return {"x2": F.col(x) + F.col(w), "y2": F.col(y) + F.col(h), "area": F.col(w) * F.col(h)}


def clipped(width: Column, height: Column, x: str = "x", y: str = "y", w: str = "w", h: str = "h") -> dict[str, Column]:
    """The box inside a page: the near corner is moved to 0 at least, the far one to the page's far edges at most.  A box wholly
    beyond the page keeps its near corner and is empty."""
    left, top = F.greatest(F.col(x), F.lit(0)), F.greatest(F.col(y), F.lit(0))
    right, bottom = F.least(F.col(x) + F.col(w), width), F.least(F.col(y) + F.col(h), height)
    return {"cx": left, "cy": top, "cw": F.greatest(right - left, F.lit(0)), "ch": F.greatest(bottom - top, F.lit(0))}


def pixel_box(box: tuple[float, ...], width: Column, height: Column) -> Column:
    """A relative box in pixels: place and extent are each rounded half to even, the extent is at least 1, and the box is cut at
    the far edges of its parent."""
    bx, by, bw, bh = map(float, box)
    whole = lambda share, side: F.rint(F.lit(share) * side).cast("int")
    left = F.greatest(F.lit(0), F.least(F.greatest(F.lit(0), width - 1), whole(bx, width)))
    top = F.greatest(F.lit(0), F.least(F.greatest(F.lit(0), height - 1), whole(by, height)))
    wide, high = F.greatest(F.lit(1), whole(bw, width)), F.greatest(F.lit(1), whole(bh, height))
    return F.struct(left.alias("x"), top.alias("y"), F.least(wide, width - left).alias("w"), F.least(high, height - top).alias("h"))


def token_centre(bbox: Column) -> dict[str, Column]:
    side = lambda i: F.transform(bbox, lambda p: p[i])
    mean = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, v: a + v) / F.size(xs)
    return {"tcx": mean(side(0)), "tcy": mean(side(1)), "tx0": F.array_min(side(0)), "ty0": F.array_min(side(1))}


def quad(points: Column) -> Column:
    """Two corners become four points, four stay, anything else is all zeros."""
    zero = F.array(*[F.array(F.lit(0.0), F.lit(0.0))] * 4)
    a, b = points[0], points[1]
    two = F.array(F.array(a[0], a[1]), F.array(b[0], a[1]), F.array(b[0], b[1]), F.array(a[0], b[1]))
    return F.when(F.size(points) == 2, two).when(F.size(points) >= 4, F.slice(points, 1, 4)).otherwise(zero)


def rescaled(bbox: Column, scale: Column, dx: Column | int = 0, dy: Column | int = 0) -> Column:
    return F.transform(bbox, lambda p: F.array(p[0] / scale + dx, p[1] / scale + dy))


def clusters(df: DataFrame, key: str, value: str, gap: Column | float) -> DataFrame:
    """key, position, n: chains of sorted values no more than gap apart, at their median (cut to a whole number)."""
    w = Window.partitionBy(key).orderBy(value)
    first = F.col(value) - F.lag(value).over(w) > gap
    marked = df.withColumn("_new", F.coalesce(first.cast("int"), F.lit(0))).withColumn("_island", F.sum("_new").over(w))
    return marked.groupBy(key, "_island").agg(F.floor(F.median(value)).cast("long").alias("position"), F.count("*").alias("n")).drop("_island")


def peaks(df: DataFrame, key: str, index: str, value: str, least: Column | float, gap: int) -> DataFrame:
    """key, position: runs of indices with at least so high a value and steps of at most gap, at the middle of their ends."""
    high = df.filter(F.col(value) >= least)
    w = Window.partitionBy(key).orderBy(index)
    marked = high.withColumn("_island", F.sum(F.coalesce((F.col(index) - F.lag(index).over(w) > gap).cast("int"), F.lit(0))).over(w))
    return marked.groupBy(key, "_island").agg(F.expr(f"(min(`{index}`) + max(`{index}`)) div 2").cast("long").alias("position")).drop("_island")


def runs(df: DataFrame, key: str, index: str, on: Column, least: int) -> DataFrame:
    """key, low, high: maximal runs of consecutive indices that are on, at least so long; high is the first index after the run."""
    lit = df.filter(on)
    island = F.col(index) - F.row_number().over(Window.partitionBy(key).orderBy(index))
    out = lit.withColumn("_island", island).groupBy(key, "_island").agg(F.min(index).alias("low"), (F.max(index) + 1).alias("high")).drop("_island")
    return out.filter(F.col("high") - F.col("low") >= least)


def body_runs(bands: DataFrame, top: Column | int) -> DataFrame:
    """Runs whose centre is not above the top of the body."""
    return bands.filter((F.col("low") + F.col("high")) / 2 >= top)


def padded_bands(bands: DataFrame, key: str, pad: Column | int, top: Column | int, bottom: Column | int) -> DataFrame:
    """Bands widened by pad, but not into their neighbours: the first one not above top, the last one not below bottom; what would
    be empty keeps its own bounds."""
    w = Window.partitionBy(key).orderBy("low")
    whole = lambda c: c if isinstance(c, Column) else F.lit(c)
    start = F.greatest(F.coalesce(F.lag("high").over(w), whole(top)), F.col("low") - pad)
    stop = F.least(F.coalesce(F.lead("low").over(w), whole(bottom)), F.col("high") + pad)
    out = bands.withColumns({"_a": start, "_b": stop})
    return out.withColumns({"padLow": F.when(F.col("_b") > F.col("_a"), F.col("_a")).otherwise(F.col("low")), "padHigh": F.when(F.col("_b") > F.col("_a"), F.col("_b")).otherwise(F.col("high"))}).drop("_a", "_b")


def cell_boxes(x: Column, w: Column, dividers: Column, page_w: Column, page_h: Column, layout: Layout = LAYOUT) -> Column:
    """array<struct<card_index, cell_x, cell_y, cell_w, cell_h>>: cells of the card grid of a content frame (x, w) with its row dividers
    (see row_dividers), inset on all sides, at least one pixel large, and cut at the page."""
    edge = lambda n: F.rint(x + n * (w / layout.columns)).cast("long")

    def cell(i: Column) -> Column:
        row, col = F.floor(i / layout.columns).cast("int"), i % layout.columns
        x0, x1 = edge(col) + layout.inset, edge(col + 1) - layout.inset
        y0, y1 = F.get(dividers, row) + layout.inset, F.get(dividers, row + 1) - layout.inset
        left, top = F.greatest(x0, F.lit(0)), F.greatest(y0, F.lit(0))
        right, bottom = F.least(x0 + F.greatest(x1 - x0, F.lit(1)), page_w), F.least(y0 + F.greatest(y1 - y0, F.lit(1)), page_h)
        sides = {"cell_x": left, "cell_y": top, "cell_w": F.greatest(right - left, F.lit(0)), "cell_h": F.greatest(bottom - top, F.lit(0))}
        return F.struct(i.cast("int").alias("card_index"), *[c.cast("long").alias(n) for n, c in sides.items()])

    return F.transform(F.sequence(F.lit(0), F.lit(layout.rows * layout.columns - 1)), cell)


def grid_cells(pages: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """A row for every cell of the grid of each page.  pages: page, x, w (its content frame), dividers, page_w and page_h."""
    cells = cell_boxes(F.col("x"), F.col("w"), F.col("dividers"), F.col("page_w"), F.col("page_h"), layout)
    return pages.select("page", F.inline(cells))


def peak_positions(profile: Column, least: Column, gap: int) -> Column:
    """Peaks of one profile (an array): runs of indices with at least so high a value and steps of at most gap, at the middle of their ends."""
    high = F.filter(F.transform(profile, lambda v, i: F.when(v >= least, i)), lambda i: i.isNotNull())
    return _islands(high, gap, lambda ends, at: F.floor((F.get(ends, at["a"]) + F.get(ends, at["b"])) / 2).cast("long"))


def cluster_medians(values: Column, gap: int) -> Column:
    """Chains of sorted values no more than gap apart, at their median (cut to a whole number)."""
    middle = lambda v, at: F.floor((F.get(v, F.floor((at["a"] + at["b"]) / 2).cast("int")) + F.get(v, F.floor((at["a"] + at["b"] + 1) / 2).cast("int"))) / 2).cast("long")
    return _islands(F.array_sort(values), gap, middle)


def _islands(ordered: Column, gap: int, value) -> Column:
    """value(ordered, struct<a, b>) of every chain of the ordered array, a and b being the indices of its ends."""

    def of(v: Column) -> Column:
        starts = F.filter(F.transform(v, lambda x, i: F.when((i == 0) | (x - F.get(v, i - 1) > gap), i)), lambda i: i.isNotNull())
        stops = F.filter(F.transform(v, lambda x, i: F.when((i == F.size(v) - 1) | (F.get(v, i + 1) - x > gap), i)), lambda i: i.isNotNull())
        return F.transform(F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda at: value(v, at))

    return F.element_at(F.transform(F.array(ordered), of), 1)  # the array is named once, not repeated in the plan


def row_dividers(lines: Column, top: Column, height: Column, rows: int = LAYOUT.rows) -> Column:
    """The first rows + 1 of the clustered lines if there are so many, else equal steps, rounded half to even."""
    steps = F.transform(F.sequence(F.lit(0), F.lit(rows)), lambda i: F.rint(top + i * (height / rows)).cast("long"))
    return F.when(F.size(lines) >= rows + 1, F.slice(lines, 1, rows + 1).cast("array<long>")).otherwise(steps)


def content_frame(vertical: Column, horizontal: Column, width: Column, height: Column, layout: Layout = LAYOUT) -> Column:
    """struct<x, y, w, h> of the printable table, from the peaks of dark columns and rows (arrays): the outermost peaks in the
    margins where such lines are expected, else fixed shares of the page; those also if the two horizontal ones are not 50 apart."""
    left_share, right_share, top_share, bottom_share = layout.frame
    share = lambda side, part: F.floor(side * part).cast("long")
    left = F.coalesce(F.array_min(F.filter(vertical, lambda p: p < width * 0.08)), share(width, left_share))
    right = F.coalesce(F.array_max(F.filter(vertical, lambda p: p > width * 0.92)), share(width, right_share))
    top = F.coalesce(F.array_min(F.filter(horizontal, lambda p: (p > height * 0.015) & (p < height * 0.12))), share(height, top_share))
    bottom = F.coalesce(F.array_max(F.filter(horizontal, lambda p: p > height * 0.85)), share(height, bottom_share))
    near = bottom <= top + 50
    top, bottom = F.when(near, share(height, top_share)).otherwise(top), F.when(near, share(height, bottom_share)).otherwise(bottom)
    return F.struct(left.alias("x"), top.alias("y"), F.greatest(right - left, F.lit(1)).alias("w"), F.greatest(bottom - top, F.lit(1)).alias("h"))


def dark_profile(pixels: DataFrame, key: str, axis: str, value: str = "grey", limit: int = 120) -> DataFrame:
    """key, axis, dark: how many pixels of each column (axis x) or row (axis y) are darker than the limit."""
    return pixels.groupBy(key, axis).agg(F.count_if(F.col(value) < limit).alias("dark"))


def crop_rectangle(box: tuple[float, ...], x: Column, y: Column, w: Column, h: Column) -> Column:
    """A relative box of a card in pixels of its page."""
    inner = pixel_box(box, w, h)
    return F.struct((x + inner["x"]).alias("x"), (y + inner["y"]).alias("y"), inner["w"].alias("w"), inner["h"].alias("h"))


def card_shaped(w: Column, h: Column, page_w: Column, page_h: Column, layout: Layout = LAYOUT) -> Column:
    return (F.abs(w / h - layout.aspect) <= layout.aspect_slack) & (w / page_w).between(0.26, 0.36) & (h / page_h).between(0.07, 0.12)


def contour_sized(w: Column, h: Column, page_w: Column, page_h: Column) -> Column:
    return (w * h / (page_w * page_h)).between(0.012, 0.07) & (w / h).between(1.6, 3.6) & (h >= 70) & (w >= 180)


def occupied(ink_share: Column, layout: Layout = LAYOUT) -> Column:
    return F.coalesce(ink_share, F.lit(0.0)) >= layout.occupancy


def ink_share(dark: Column) -> Column:
    """Share of dark pixels as an aggregate; 0 without pixels."""
    return F.coalesce(F.avg(dark.cast("int")), F.lit(0.0))


def suppressed(boxes: Column, reach: int = 18) -> Column:
    """Of an array of struct<x, y, w, h> the boxes kept by greedy suppression: large before small, a box goes if both its
    corners' offsets to a kept one are under reach; in reading order (bands of 20 pixels, then left to right)."""
    by_area = F.array_sort(F.transform(boxes, lambda b: F.struct((-b["w"] * b["h"]).alias("a"), b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("w"), b["h"].alias("h"))))
    start = F.slice(by_area, 1, 0)
    near = lambda b: lambda k: (F.abs(b["x"] - k["x"]) < reach) & (F.abs(b["y"] - k["y"]) < reach)
    kept = F.aggregate(by_area, start, lambda acc, b: F.when(F.exists(acc, near(b)), acc).otherwise(F.concat(acc, F.array(b))))
    ordered = F.array_sort(F.transform(kept, lambda b: F.struct(F.floor(b["y"] / 20).alias("band"), b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("w"), b["h"].alias("h"))))
    return F.transform(ordered, lambda b: F.struct(b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("w"), b["h"].alias("h")))


def page_class(ink: Column, cards: Column, vertical: Column, horizontal: Column, cells: Column, layout: Layout = LAYOUT) -> Column:
    return (
        F.when(ink < 0.004, "blank").when(cards >= 1, "voter").when((vertical >= 8) & (horizontal >= 16) & (cells >= layout.full_page_cards), "voter")
        .when(horizontal >= 10, "header").when(horizontal <= 3, "map").otherwise("supplement")
    )


def detector(grid: Column, contour: Column, layout: Layout = LAYOUT) -> Column:
    return F.when(grid >= layout.full_page_cards, "grid").when(grid == 0, "contour").when(contour > grid + 3, "contour").otherwise("grid")


def reading_scale(median_height: Column) -> Column:
    return F.when(median_height > 180, 1.0).when(median_height > 150, 1.5).otherwise(2.0)


def row_unions(cards: DataFrame, *key: str, columns: int = LAYOUT.columns) -> DataFrame:
    """Bounding box and reading scale of each row of cards, which are numbered along rows."""
    rows = cards.withColumn("row", F.expr(f"card_index div {columns}")).groupBy(*key, "row")
    out = rows.agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("w")).alias("x2"), F.max(F.col("y") + F.col("h")).alias("y2"), F.count("*").alias("cards"), F.median("h").alias("median_h"))
    return out.withColumn("scale", reading_scale(F.col("median_h")))
