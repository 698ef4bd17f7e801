"""Queries on pixels and strips: pages are drawn by Spark from suppliers and parts, strips are those of line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions.text import bound
from cardloom.operators import raster as P
from cardloom.operators import strips as S
from cardloom.plans.geometry import _boxes
from cardloom.plans.registry import dealt, query, table


def _graymap(width: Column, height: Column, rows: Column) -> Column:
    """A graymap of rows written as hexadecimal text."""
    head = F.format_string("P5 %d %d 255\n", width.cast("int"), height.cast("int"))
    return F.concat(F.to_binary(head, F.lit("utf-8")), F.unhex(rows))


def _run(n: Column | int, black: bool) -> Column:
    return F.repeat(F.lit("00" if black else "FF"), (n if isinstance(n, Column) else F.lit(n)).cast("int"))


@query("""WITH p AS (SELECT p_partkey, 60 + p_size AS w, 40 + p_size % 7 AS h, p_partkey % 20 AS x, 20 + p_size % 11 AS bw, p_partkey % 9 AS y, 10 + p_size % 13 AS bh FROM part)
SELECT p_partkey, w AS page_w, h AS page_h, bw * bh / (w * h)::DOUBLE AS ink, bw * bh AS dark, x AS first_column, y AS first_row,
  CASE WHEN bh >= 0.40::DOUBLE * h THEN [x + (bw - 1) // 2] ELSE []::BIGINT[] END::VARCHAR AS column_lines, CASE WHEN bw >= 0.40::DOUBLE * w THEN [y + (bh - 1) // 2] ELSE []::BIGINT[] END::VARCHAR AS row_lines FROM p""")
def raster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dark rectangle on each page."""
    from cardloom.operators import geometry as G

    s, k = F.col("p_size"), F.col("p_partkey").cast("int")
    w, h, x, bw, y, bh = 60 + s, 40 + s % 7, k % 20, 20 + s % 11, k % 9, 10 + s % 13
    dark = F.concat(_run(x, False), _run(bw, True), _run(w - x - bw, False))
    pages = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey").select("p_partkey", _graymap(w, h, F.concat(_run(w * y, False), F.repeat(dark, bh), _run(w * (h - y - bh), False))).alias("content"))
    seen = P.profiled(pages)
    first = lambda c: (F.array_position(F.transform(c, lambda v: v > 0), F.lit(True)) - 1).cast("int")
    shown = lambda c: F.concat(F.lit("["), F.array_join(c.cast("array<string>"), ", "), F.lit("]"))
    return seen.select(
        "p_partkey", "page_w", "page_h", "ink", F.aggregate("row_dark", F.lit(0), lambda a, v: a + v).alias("dark"), first("column_dark").alias("first_column"), first("row_dark").alias("first_row"),
        shown(G.peak_positions(F.col("column_dark"), F.col("page_h") * 0.40, 6)).alias("column_lines"), shown(G.peak_positions(F.col("row_dark"), F.col("page_w") * 0.40, 4)).alias("row_lines"),
    )


#: Size of a drawn page, and height of its grid rows.
_W, _H, _PITCH = 300, 400, 36


def _ruled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid page for each supplier.  Cell i is filled where (s_suppkey + i) % 4 <> 0; the others have ink along their upper edge only,
    inside the inset and outside the inner part."""
    k = F.col("s_suppkey").cast("int")
    left, right, top = 10 + k % 7, _W - 12 - k % 5, 12 + k % 9
    rules = [F.floor(left + c * ((right - left) / 3)).cast("int") for c in range(4)]

    def line(fill: list[Column | None]) -> Column:
        """One row of pixels: rules, and between two of them dashes, or nothing."""
        parts = [_run(left, False)]
        for c in range(3):
            gap = rules[c + 1] - rules[c] - 1
            dashes = F.substring(F.repeat(F.lit("FFFFFF00"), 40), 1, 2) if fill[c] is None else F.when(fill[c], F.repeat(F.lit("FFFFFF00"), 40)).otherwise(F.repeat(F.lit("FF"), 160))
            parts += [_run(1, True), _run(gap, False) if fill[c] is None else F.concat(_run(12, False), F.substring(dashes, F.lit(1), 2 * (gap - 24)), _run(12, False))]
        return F.concat(*parts, _run(1, True), _run(_W - right - 1, False))

    ruler = F.concat(_run(left, False), _run(right - left + 1, True), _run(_W - right - 1, False))
    blank = line([None, None, None])
    body = []
    for r in range(10):
        filled = [(k + 3 * r + c) % 4 != 0 for c in range(3)]
        edge, ink = line([~f for f in filled]), line(filled)
        body += [ruler, F.repeat(blank, 6), F.repeat(edge, 4), F.repeat(blank, 6), F.repeat(ink, 4), F.repeat(blank, _PITCH - 21)]
    rows = F.concat(_run(_W * top, False), *body, ruler, _run(_W * (_H - top - 10 * _PITCH - 1), False))
    return dealt(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey").select(k.cast("long").alias("page"), _graymap(F.lit(_W), F.lit(_H), rows).alias("content"))


@query(f"""WITH s AS (SELECT s_suppkey AS page, 10 + s_suppkey % 7 AS l, {_W} - 12 - s_suppkey % 5 AS r, 12 + s_suppkey % 9 AS t FROM supplier),
c AS (SELECT page, i, round_even(l + (i % 3) * ((r - l) / 3::DOUBLE), 0)::BIGINT + 6 AS x, round_even(l + (i % 3 + 1) * ((r - l) / 3::DOUBLE), 0)::BIGINT - 6 AS x2, t + i // 3 * {_PITCH} + 6 AS y, (page + i) % 4 <> 0 AS occupied FROM s, (SELECT unnest(range(30)) AS i))
SELECT page, i::INT AS card_index, x, y, x2 - x AS w, {_PITCH - 12} AS h, occupied FROM c""")
def raster_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = P.grid_cards(_ruled_pages(spark, sf_dir), ["page"])
    return cards.select("page", F.explode("cells").alias("c")).select("page", "c.card_index", "c.x", "c.y", "c.w", "c.h", "c.occupied")


@query("""WITH c AS (SELECT s_suppkey AS page, i, 24 + i % 2 * 330 + s_suppkey % 5 AS x, 16 + i // 2 * 105 + s_suppkey % 3 AS y, 190 + (s_suppkey + i) % 8 AS w, 72 + (s_suppkey + i) % 6 AS h FROM supplier, (SELECT unnest(range(6)) AS i))
SELECT page, count(*) AS cards, sum(x)::BIGINT AS sum_x, sum(y)::BIGINT AS sum_y, sum(w * h)::BIGINT AS area FROM c WHERE (page + i) % 5 <> 0 GROUP BY page""")
def contour_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlined cards in two columns, two pixels thick; those of which (s_suppkey + i) % 5 is 0 are not drawn."""
    k, width = F.col("s_suppkey").cast("int"), 600
    blank = _run(width // 2, False)

    def outline(i: Column) -> Column:
        """The rows of a card's left or right half of the page: at its upper or lower edge, and between them."""
        w, x, drawn = 190 + (k + i) % 8, 24 + i % 2 * 30 + k % 5, (k + i) % 5 != 0
        edge = F.concat(_run(x, False), _run(w, True), _run(width // 2 - x - w, False))
        side = F.concat(_run(x, False), _run(2, True), _run(w - 4, False), _run(2, True), _run(width // 2 - x - w, False))
        return F.struct((72 + (k + i) % 6).alias("h"), F.when(drawn, edge).otherwise(blank).alias("edge"), F.when(drawn, side).otherwise(blank).alias("side"))

    def band(cards: Column) -> Column:
        """Two cards side by side, and what is below them."""
        row = lambda part: F.array_join(F.transform(cards, part), "")
        ends = F.transform(F.sequence(F.lit(70), F.lit(77)), lambda n: row(lambda c: F.when(c["h"] <= n, blank).when(c["h"] - 2 <= n, c["edge"]).otherwise(c["side"])))  # where cards of different heights end
        return F.concat(F.repeat(row(lambda c: c["edge"]), 2), F.repeat(row(lambda c: c["side"]), 68), F.array_join(ends, ""), _run(width * 27, False))

    bands = F.transform(F.sequence(F.lit(0), F.lit(4), F.lit(2)), lambda i: bound(F.transform(F.array(i, i + 1), outline), band))
    rows = F.concat(_run(width * (16 + k % 3), False), F.array_join(bands, ""), _run(width * (369 - k % 3), False))
    pages = dealt(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey").select(k.cast("long").alias("page"), _graymap(F.lit(width), F.lit(700), rows).alias("content"))
    found = P.contour_cards(pages, ["page"]).select("page", F.explode("cards").alias("b"))
    return found.groupBy("page").agg(F.count("*").alias("cards"), F.sum("b.x").alias("sum_x"), F.sum("b.y").alias("sum_y"), F.sum(F.col("b.w") * F.col("b.h")).alias("area"))


_STRIPS = """WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1 AS i, l_quantity::BIGINT AS q, l_partkey AS p FROM lineitem),
b AS (SELECT l_orderkey AS page, i AS card_index, i // 3 AS row, i % 3 * 270 AS x, i // 3 * 120 + q % 10 % 4 AS y, 280 + q % 10 AS w, 100 + q % 30 AS h FROM l),
u AS (SELECT *, x - min(x) OVER (PARTITION BY page, row) AS dx, y - min(y) OVER (PARTITION BY page, row) AS dy FROM b),
k(rank, region, bx, bw, bh) AS (VALUES (0, 'text', 0.01::DOUBLE, 0.74::DOUBLE, 0.99::DOUBLE), (1, 'epic', 0.5::DOUBLE, 0.48::DOUBLE, 0.18::DOUBLE), (2, 'epic_fallback', 0.55::DOUBLE, 0.44::DOUBLE, 0.28::DOUBLE)),
r AS (SELECT u.*, rank, region, round_even(bx * w, 0)::BIGINT AS left_, least(w - round_even(bx * w, 0)::BIGINT, round_even(bw * w, 0)::BIGINT) AS wide, least(h, round_even(bh * h, 0)::BIGINT) AS high FROM u, k),
c AS (SELECT *, greatest(left_, 3) AS rx, 3 AS ry, least(left_ + wide, w - 3) - greatest(left_, 3) AS rw, least(high, h - 3) - 3 AS rh FROM r) """


def _strip_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cards that overlap their neighbours by some pixels, and a position for each of them in the strip of its row."""
    cards, tokens = _boxes(spark, sf_dir)
    i, w = F.col("card_index"), F.col("w").cast("int")
    boxes = cards.select("page", "card_index", (i % 3 * 270).cast("int").alias("x"), (F.col("y").cast("int") + (w - 280) % 4).alias("y"), w.alias("w"), F.col("h").cast("int").alias("h"))
    return boxes, tokens.select("page", "seq", F.expr("seq div 3").alias("row"), F.col("x0").cast("int").alias("sx"), (F.col("y0") % 130).cast("int").alias("sy"))


@query(_STRIPS + "SELECT page, row, card_index, region, x + rx AS src_x, y + ry AS src_y, dx + rx AS dst_x, dy + ry AS dst_y, rw AS w, rh AS h FROM c")
def strip_pastes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.pastes(_strip_rows(spark, sf_dir)[0], "page")


@query(_STRIPS + """, t AS (SELECT l_orderkey AS page, i AS seq, i // 3 AS row, p * 37 % 900 AS sx, p * 53 % 400 % 130 AS sy FROM l),
top AS (SELECT page, seq, max(card_index) AS card_index FROM t JOIN u USING (page, row) WHERE sx >= dx AND sx < dx + w AND sy >= dy AND sy < dy + h GROUP BY ALL),
reg AS (SELECT page, seq, arg_min(region, rank) AS region FROM top JOIN t USING (page, seq) JOIN c USING (page, card_index) WHERE sx - dx >= rx AND sx - dx < rx + rw AND sy - dy >= ry AND sy - dy < ry + rh GROUP BY ALL)
SELECT t.page, t.row, t.seq, t.sx, t.sy, top.card_index, reg.region, t.sx - u.dx AS card_x, t.sy - u.dy AS card_y
FROM t LEFT JOIN top ON top.page = t.page AND top.seq = t.seq LEFT JOIN u ON u.page = top.page AND u.card_index = top.card_index LEFT JOIN reg ON reg.page = t.page AND reg.seq = t.seq""")
def strip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, points = _strip_rows(spark, sf_dir)
    return S.located(points, cards, "page").select("page", "row", "seq", "sx", "sy", "card_index", "region", "card_x", "card_y")
