"""Tokens to cards.  Both joins have the page as equi key, so a page's tokens meet that page's cards alone (30 at most)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardloom.schema import LAYOUT, Layout


def by_overlap(tokens: DataFrame, cards: DataFrame, key: list[str], layout: Layout = LAYOUT) -> DataFrame:
    """key, seq, card_index: the card that covers most of the token, if at least the layout's share of it and, of equals, the
    first; else the first card around its centre; else no row.  tokens: key, seq, x0, y0, x1, y1; cards: key, card_index, x, y, w, h.
    What lies in a card's photo strip, below the guard, is not that card's."""
    t, c = F.col, F.col
    both = tokens.join(cards, key)
    width = F.greatest(F.lit(0.0), F.least("x1", c("x") + c("w")) - F.greatest("x0", "x"))
    height = F.greatest(F.lit(0.0), F.least("y1", c("y") + c("h")) - F.greatest("y0", "y"))
    area = F.greatest(F.lit(1.0), (t("x1") - t("x0")) * (t("y1") - t("y0")))
    cx, cy = (t("x0") + t("x1")) / 2, (t("y0") + t("y1")) / 2
    px, _, pw, _ = layout.photo
    photo = cx.between(c("x") + c("w") * px, c("x") + c("w") * (px + pw)) & (cy >= c("y") + c("h") * layout.photo_guard) & (cy <= c("y") + c("h"))
    share = F.when(photo, 0.0).otherwise(width * height / area)
    inside = cx.between(c("x"), c("x") + c("w")) & cy.between(c("y"), c("y") + c("h")) & ~photo
    tier = F.when(share >= layout.overlap, 0).when(inside, 1)
    scored = both.withColumns({"_tier": tier, "_share": F.when(share >= layout.overlap, share).otherwise(0.0)}).filter("_tier is not null")
    best = Window.partitionBy(*key, "seq").orderBy("_tier", F.desc("_share"), "card_index")
    return scored.withColumn("_n", F.row_number().over(best)).filter("_n = 1").select(*key, "seq", "card_index")


def tokens_of_cards(tokens: DataFrame, cards: DataFrame, key: list[str], layout: Layout = LAYOUT) -> DataFrame:
    """key, card_index, width, height and tokens (in their order, in pixels of the card) of every card, also of those without a token.  tokens:
    key, seq, text, confidence, bbox (of the page); those without text or box are no one's."""
    read = tokens.filter("text is not null and bbox is not null")
    side = lambda i, best: best(F.transform("bbox", lambda p: p[i]))
    boxed = read.select(*key, "seq", "text", "confidence", "bbox", side(0, F.array_min).alias("x0"), side(1, F.array_min).alias("y0"), side(0, F.array_max).alias("x1"), side(1, F.array_max).alias("y1"))
    own = by_overlap(boxed.select(*key, "seq", "x0", "y0", "x1", "y1"), cards, key, layout).join(boxed, [*key, "seq"]).join(cards.select(*key, "card_index", "x", "y"), [*key, "card_index"])
    local = F.transform("bbox", lambda p: F.array(p[0] - F.col("x"), p[1] - F.col("y")))
    held = own.groupBy(*key, "card_index").agg(F.array_sort(F.collect_list(F.struct("seq", "text", "confidence", local.alias("bbox")))).alias("tokens"))  # a card's
    out = cards.join(held, [*key, "card_index"], "left")
    kept = F.transform("tokens", lambda t: F.struct(t["text"].alias("text"), t["confidence"].alias("confidence"), t["bbox"].alias("bbox")))
    return out.select(*key, "card_index", F.col("w").cast("double").alias("width"), F.col("h").cast("double").alias("height"), F.coalesce(kept, F.slice(kept, 1, 0), F.array().cast("array<struct<text:string,confidence:double,bbox:array<array<double>>>>")).alias("tokens"))


def by_column(tokens: DataFrame, cards: DataFrame, key: list[str]) -> DataFrame:
    """key, seq, card_index: the first card of the row whose span holds the token's centre, else the one with the nearest middle.
    tokens: key, seq, cx; cards: key, card_index, x, w.  Every token of a row with cards is assigned."""
    both = tokens.join(cards, key)
    held = F.col("cx").between(F.col("x"), F.col("x") + F.col("w"))
    far = F.abs(F.col("cx") - (F.col("x") + F.col("w") / 2))
    best = Window.partitionBy(*key, "seq").orderBy(~held, F.when(held, 0.0).otherwise(far), "card_index")
    return both.withColumn("_n", F.row_number().over(best)).filter("_n = 1").select(*key, "seq", "card_index")
