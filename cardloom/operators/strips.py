"""Row strips: a row of cards as one image to read, made of the parts of each card that hold text.

A strip is the bounding box of a row.  It is white but for the text regions of its cards, each without a border ring; gutters, photos and
card frames are wiped.  All of that is algebra on rectangles: `pastes` says which rectangle of the page goes where in the strip, and
`located` takes a position in a strip back to its card and region, by an equi join on bins of x and not by comparing every position with
every card of the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.operators.geometry import pixel_box, reading_scale
from cardloom.schema import LAYOUT, Layout

#: Regions of a card that a strip keeps, in order.
KEPT_REGIONS = ("text", "epic", "epic_fallback")
#: Pixels along the edges of a card that are wiped.
BORDER = 3
#: Width of the bins of x in which positions meet cards.
BIN = 64


def strip_cards(cards: DataFrame, *key: str, columns: int = LAYOUT.columns) -> DataFrame:
    """cards (key, card_index, x, y, w, h) with row, the row's box (strip_x, strip_y, strip_w, strip_h), the card's place in it
    (dx, dy), and the scale to read the row at.  Rows without a card do not exist."""
    row = Window.partitionBy(*key, "row")
    out = cards.withColumn("row", F.expr(f"card_index div {columns}"))
    out = out.withColumns({"strip_x": F.min("x").over(row), "strip_y": F.min("y").over(row), "_x2": F.max(F.col("x") + F.col("w")).over(row), "_y2": F.max(F.col("y") + F.col("h")).over(row), "scale": reading_scale(F.median("h").over(row))})
    return out.withColumns({"strip_w": F.col("_x2") - F.col("strip_x"), "strip_h": F.col("_y2") - F.col("strip_y"), "dx": F.col("x") - F.col("strip_x"), "dy": F.col("y") - F.col("strip_y")}).drop("_x2", "_y2")


def kept_regions(w: Column, h: Column, layout: Layout = LAYOUT, border: int = BORDER) -> Column:
    """array<struct<region, x, y, w, h>>: what is kept of a card of that size, in pixels of the card, without its border ring; regions of
    which nothing is left are missing."""

    def cut(name: str) -> Column:
        box = pixel_box(layout.boxes[name], w, h)
        x, y = F.greatest(box["x"], F.lit(border)), F.greatest(box["y"], F.lit(border))
        x2, y2 = F.least(box["x"] + box["w"], w - border), F.least(box["y"] + box["h"], h - border)
        whole = [(F.lit(name), "region"), *[(c.cast("int"), n) for c, n in ((x, "x"), (y, "y"), (x2 - x, "w"), (y2 - y, "h"))]]
        return F.struct(*[c.alias(n) for c, n in whole])

    return F.filter(F.array(*[cut(name) for name in KEPT_REGIONS]), lambda r: (r["w"] > 0) & (r["h"] > 0))


def pastes(cards: DataFrame, *key: str, layout: Layout = LAYOUT, border: int = BORDER) -> DataFrame:
    """key, row, card_index, region, src_x, src_y (on the page), dst_x, dst_y (in the strip), w, h of every rectangle that is pasted.
    Cards of a row are pasted in order, each over what lies below it."""
    placed = strip_cards(cards, *key, columns=layout.columns)
    each = placed.withColumn("r", F.explode(kept_regions(F.col("w"), F.col("h"), layout, border)))
    return each.select(
        *key, "row", "card_index", "r.region", (F.col("x") + F.col("r.x")).alias("src_x"), (F.col("y") + F.col("r.y")).alias("src_y"),
        (F.col("dx") + F.col("r.x")).alias("dst_x"), (F.col("dy") + F.col("r.y")).alias("dst_y"), "r.w", "r.h",
    )


def located(points: DataFrame, cards: DataFrame, *key: str, point: str = "seq", layout: Layout = LAYOUT, border: int = BORDER) -> DataFrame:
    """points (key, row, point, sx, sy: a position in a strip) with card_index, region (null where the strip was wiped) and the position on
    the card (card_x, card_y); null where no card is.  Of cards that overlap the last one is on top."""
    placed = strip_cards(cards, *key, columns=layout.columns).select(*key, "row", "card_index", "dx", "dy", "w", "h")
    last = F.floor((F.col("dx") + F.greatest("w", F.lit(1)) - 1) / BIN)
    binned = placed.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("dx") / BIN), last)))
    inside = (F.col("sx") >= F.col("dx")) & (F.col("sx") < F.col("dx") + F.col("w")) & (F.col("sy") >= F.col("dy")) & (F.col("sy") < F.col("dy") + F.col("h"))
    met = points.withColumn("_bin", F.floor(F.col("sx") / BIN)).join(binned, [*key, "row", "_bin"]).filter(inside)
    card_x, card_y = F.col("sx") - F.col("dx"), F.col("sy") - F.col("dy")
    held = F.filter(kept_regions(F.col("w"), F.col("h"), layout, border), lambda r: (card_x >= r["x"]) & (card_x < r["x"] + r["w"]) & (card_y >= r["y"]) & (card_y < r["y"] + r["h"]))
    found = met.select(*key, "row", point, F.struct("card_index", F.get(held, F.lit(0))["region"].alias("region"), card_x.alias("card_x"), card_y.alias("card_y")).alias("_at"))
    top = found.groupBy(*key, "row", point).agg(F.max_by("_at", F.col("_at.card_index")).alias("_at"))
    return points.join(top, [*key, "row", point], "left").select(*points.columns, "_at.card_index", "_at.region", "_at.card_x", "_at.card_y")
