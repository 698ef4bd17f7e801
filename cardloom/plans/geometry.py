"""Geometry queries: positions come from events, boxes and tokens from line items by arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import assign as A
from cardloom.operators import geometry as G
from cardloom.operators import records as R
from cardloom.plans.registry import query, table


def _seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", F.expr("unix_date(cast(ts as date)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)").alias("t"), "event_id", "value")


_SECONDS = "WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS t, event_id, value FROM events) "


@query(_SECONDS + """, g AS (SELECT *, sum((t - before > 30000)::INT) OVER (PARTITION BY user_id ORDER BY t) AS island FROM (SELECT *, lag(t, 1, t) OVER (PARTITION BY user_id ORDER BY t) AS before FROM e))
SELECT user_id, floor(median(t))::BIGINT AS position, count(*) AS n FROM g GROUP BY user_id, island""")
def cluster_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.clusters(_seconds(spark, sf_dir), "user_id", "t", 30000)


@query("""WITH h AS (SELECT user_id, (hour(ts) + 24 * (day(ts) - 1))::BIGINT AS i, count(*) AS n FROM events GROUP BY ALL),
g AS (SELECT *, sum((i - before > 3)::INT) OVER (PARTITION BY user_id ORDER BY i) AS island FROM (SELECT *, lag(i, 1, i) OVER (PARTITION BY user_id ORDER BY i) AS before FROM h WHERE n >= 1))
SELECT user_id, (min(i) + max(i)) // 2 AS position FROM g GROUP BY user_id, island""")
def line_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = (F.hour("ts") + 24 * (F.dayofmonth("ts") - 1)).cast("long")
    hours = table(spark, sf_dir, "events").groupBy("user_id", i.alias("i")).agg(F.count("*").alias("n"))
    return G.peaks(hours, "user_id", "i", "n", 1, 3)


_RUNS = """WITH h AS (SELECT event_type, (hour(ts) + 24 * (day(ts) - 1))::BIGINT AS i, count(*) AS n FROM events GROUP BY ALL),
g AS (SELECT *, i - row_number() OVER (PARTITION BY event_type ORDER BY i) AS island FROM h WHERE n >= 3),
r AS (SELECT event_type, min(i) AS low, max(i) + 1 AS high FROM g GROUP BY event_type, island HAVING count(*) >= 2) """


def _bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = (F.hour("ts") + 24 * (F.dayofmonth("ts") - 1)).cast("long")
    hours = table(spark, sf_dir, "events").groupBy("event_type", i.alias("i")).agg(F.count("*").alias("n"))
    return G.runs(hours, "event_type", "i", F.col("n") >= 3, 2)


@query(_RUNS + "SELECT * FROM r")
def ink_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(spark, sf_dir)


@query(_RUNS + """, body AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY low) AS k FROM r WHERE low + high >= 240),
p AS (SELECT b.*, CASE WHEN before.high IS NULL THEN 120 ELSE before.high END AS floor_, CASE WHEN after.low IS NULL THEN 700 ELSE after.low END AS ceiling_
  FROM body b LEFT JOIN body before ON before.event_type = b.event_type AND before.k = b.k - 1 LEFT JOIN body after ON after.event_type = b.event_type AND after.k = b.k + 1),
q AS (SELECT *, CASE WHEN low - 2 < floor_ THEN floor_ ELSE low - 2 END AS a, CASE WHEN high + 2 > ceiling_ THEN ceiling_ ELSE high + 2 END AS b FROM p)
SELECT event_type, low, high, CASE WHEN b <= a THEN low ELSE a END AS "padLow", CASE WHEN b <= a THEN high ELSE b END AS "padHigh" FROM q""")
def band_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.padded_bands(G.body_runs(_bands(spark, sf_dir), 120), "event_type", 2, 120, 700)


@query("""
WITH RECURSIVE t AS (SELECT user_id, floor(epoch(ts) / 86400)::BIGINT AS day, event_id, (event_id * 7 % 97)::DOUBLE AS cy, row_number() OVER (PARTITION BY user_id, floor(epoch(ts) / 86400) ORDER BY event_id * 7 % 97 - 6, event_id % 50, event_id * 7 % 97, 'e' || event_id) AS n FROM events),
f AS (SELECT user_id, day, n, cy, cy AS anchor, 1 AS line FROM t WHERE n = 1
  UNION ALL SELECT t.user_id, t.day, t.n, t.cy, CASE WHEN abs(t.cy - f.anchor) <= 8 THEN f.anchor ELSE t.cy END, CASE WHEN abs(t.cy - f.anchor) <= 8 THEN f.line ELSE f.line + 1 END FROM f JOIN t ON t.user_id = f.user_id AND t.day = f.day AND t.n = f.n + 1),
g AS (SELECT f.user_id, f.day, f.line, string_agg('e' || t.event_id, ' ' ORDER BY t.event_id % 50, t.n) AS text FROM f JOIN t ON t.user_id = f.user_id AND t.day = f.day AND t.n = f.n GROUP BY ALL)
SELECT user_id, day, string_agg(text, '|' ORDER BY line) AS lines FROM g GROUP BY user_id, day""")
def anchor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's day is a page, so that an array holds one page's tokens, however many rows a user has."""
    cy = (F.col("event_id") * 7 % 97).cast("double")
    token = F.struct((cy - 6).alias("y0"), (F.col("event_id") % 50).cast("double").alias("x0"), cy.alias("cy"), F.lit(12.0).alias("height"), F.concat(F.lit("e"), "event_id").alias("text"))
    tokens = _days(spark, sf_dir).groupBy("user_id", "day").agg(F.collect_list(token).alias("tokens"))
    return tokens.select("user_id", "day", F.array_join(R.grouped_lines(F.col("tokens")), "|").alias("lines"))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.unix_date(F.to_date("ts")).cast("long"))


@query("""WITH p AS (SELECT p_partkey, 40 + p_size AS fx, 60 AS fy, 1800 + p_size AS fw, 2600 + p_size % 7 AS fh FROM part),
d AS (SELECT *, CASE WHEN p_partkey % 4 = 0 THEN list_transform(range(11), lambda i: 62 + i * 259) ELSE list_transform(range(11), lambda i: round_even(fy + i * (fh / 10::DOUBLE), 0)::BIGINT) END AS ys FROM p),
e AS (SELECT p_partkey AS page, r * 3 + c AS card_index, round_even(fx + c * (fw / 3::DOUBLE), 0)::BIGINT + 6 AS x0, round_even(fx + (c + 1) * (fw / 3::DOUBLE), 0)::BIGINT - 6 AS x1, ys[r + 1] + 6 AS y0, ys[r + 2] - 6 AS y1 FROM d, unnest(range(10)) a(r), unnest(range(3)) b(c))
SELECT page, card_index, x0 AS cell_x, y0 AS cell_y, CASE WHEN x1 > 1900 THEN 1900 ELSE x1 END - x0 AS cell_w, CASE WHEN y1 > 2655 THEN 2655 ELSE y1 END - y0 AS cell_h FROM e""")
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.when(F.col("p_partkey") % 4 == 0, F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: 62 + i * 259)).otherwise(F.array(F.lit(1), F.lit(2)))
    top, height = F.lit(60), 2600 + F.col("p_size") % 7
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), (F.col("p_size") + 40).alias("x"), (F.col("p_size") + 1800).alias("w"), G.row_dividers(lines, top, height).alias("dividers"), F.lit(1900).alias("page_w"), F.lit(2655).alias("page_h"))
    return G.grid_cells(pages).withColumn("card_index", F.col("card_index").cast("long"))


@query("""WITH p AS (SELECT p_partkey AS k, 1900 + p_size AS w, 2800 + p_size % 9 AS h FROM part),
v AS (SELECT *, CASE WHEN k % 3 = 0 THEN NULL ELSE 10 + k % 400 END AS l, CASE WHEN k % 5 = 0 THEN NULL ELSE w - k % 300 END AS r, CASE WHEN k % 7 = 0 THEN NULL ELSE 20 + k % 500 END AS t, CASE WHEN k % 2 = 0 THEN NULL ELSE h - k % 900 END AS b FROM p),
c AS (SELECT *, CASE WHEN l < 0.08::DOUBLE * w THEN l ELSE floor(0.0237::DOUBLE * w) END::BIGINT AS x, CASE WHEN r > 0.92::DOUBLE * w THEN r ELSE floor(0.9743::DOUBLE * w) END::BIGINT AS x2,
  CASE WHEN t > 0.015::DOUBLE * h AND t < 0.12::DOUBLE * h THEN t ELSE floor(0.0335::DOUBLE * h) END::BIGINT AS y, CASE WHEN b > 0.85::DOUBLE * h THEN b ELSE floor(0.9701::DOUBLE * h) END::BIGINT AS y2 FROM v)
SELECT k AS p_partkey, x, y, x2 - x AS w, y2 - y AS h FROM c""")
def content_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, w, h = F.col("p_partkey"), F.col("p_size") + 1900, 2800 + F.col("p_size") % 9
    some = lambda *xs: F.array_compact(F.array(*xs))
    vertical = some(F.when(k % 3 != 0, 10 + k % 400), w / 2, F.when(k % 5 != 0, w - k % 300))
    horizontal = some(F.when(k % 7 != 0, 20 + k % 500), h / 2, F.when(k % 2 != 0, h - k % 900))
    frame = G.content_frame(vertical.cast("array<long>"), horizontal.cast("array<long>"), w, h)
    return table(spark, sf_dir, "part").select("p_partkey", frame.alias("f")).select("p_partkey", "f.*")


_BOXES = """WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1 AS i, l_quantity::BIGINT AS q, l_partkey AS p FROM lineitem),
cards AS (SELECT l_orderkey AS page, i AS card_index, (i % 3 * 300)::DOUBLE AS x, (i // 3 * 120)::DOUBLE AS y, (280 + q % 10)::DOUBLE AS w, (100 + q % 30)::DOUBLE AS h FROM l),
tokens AS (SELECT l_orderkey AS page, i AS seq, (p * 37 % 900)::DOUBLE AS x0, (p * 53 % 400)::DOUBLE AS y0, (p * 37 % 900 + 40)::DOUBLE AS x1, (p * 53 % 400 + 12)::DOUBLE AS y1 FROM l) """


def _boxes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    rows = table(spark, sf_dir, "lineitem").withColumn("i", (F.row_number().over(order) - 1).cast("long")).withColumn("q", F.col("l_quantity").cast("long"))
    cards = rows.select(F.col("l_orderkey").alias("page"), F.col("i").alias("card_index"), (F.col("i") % 3 * 300).cast("double").alias("x"), F.expr("i div 3 * 120").cast("double").alias("y"), (280 + F.col("q") % 10).cast("double").alias("w"), (100 + F.col("q") % 30).cast("double").alias("h"))
    x, y = F.col("l_partkey") * 37 % 900, F.col("l_partkey") * 53 % 400
    tokens = rows.select(F.col("l_orderkey").alias("page"), F.col("i").alias("seq"), x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + 40).cast("double").alias("x1"), (y + 12).cast("double").alias("y1"))
    return cards, tokens


@query(_BOXES + """, m AS (
  SELECT page, seq, card_index, x, y, w, h, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy,
    greatest(0, least(x1, x + w) - greatest(x0, x)) * greatest(0, least(y1, y + h) - greatest(y0, y)) / greatest(1, (x1 - x0) * (y1 - y0)) AS part FROM tokens JOIN cards USING (page)
), s AS (SELECT *, cx >= x + w * 0.76::DOUBLE AND cx <= x + w * (0.76::DOUBLE + 0.24::DOUBLE) AND cy >= y + h * 0.22::DOUBLE AND cy <= y + h AS photo FROM m),
c AS (SELECT page, seq, card_index, CASE WHEN NOT photo AND part >= 0.35 THEN part ELSE 0 END AS share, CASE WHEN NOT photo AND part >= 0.35 THEN 0 WHEN NOT photo AND cx BETWEEN x AND x + w AND cy BETWEEN y AND y + h THEN 1 END AS tier FROM s)
SELECT page, seq, card_index FROM (SELECT *, row_number() OVER (PARTITION BY page, seq ORDER BY tier, share DESC, card_index) AS n FROM c WHERE tier IS NOT NULL) WHERE n = 1""")
def bbox_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, tokens = _boxes(spark, sf_dir)
    return A.by_overlap(tokens, cards, ["page"])


@query(_BOXES + """, m AS (SELECT page, seq, card_index, (x0 + x1) / 2 BETWEEN x AND x + w AS held, abs((x0 + x1) / 2 - (x + w / 2)) AS far FROM tokens JOIN cards USING (page))
SELECT page, seq, card_index FROM (SELECT *, row_number() OVER (PARTITION BY page, seq ORDER BY held DESC, CASE WHEN held THEN 0 ELSE far END, card_index) AS n FROM m) WHERE n = 1""")
def x_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards, tokens = _boxes(spark, sf_dir)
    return A.by_column(tokens.select("page", "seq", ((F.col("x0") + F.col("x1")) / 2).alias("cx")), cards, ["page"])


@query(_BOXES + """SELECT page, card_index // 3 AS row, min(x) AS x, min(y) AS y, max(x + w) AS x2, max(y + h) AS y2, count(*) AS cards, median(h) AS median_h,
  CASE WHEN median(h) > 180 THEN 1.0 WHEN median(h) > 150 THEN 1.5 ELSE 2.0 END::DOUBLE AS scale FROM cards GROUP BY ALL""")
def row_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.row_unions(_boxes(spark, sf_dir)[0], "page")


@query("SELECT l_orderkey, median(l_quantity * 5) AS height, CASE WHEN median(l_quantity * 5) > 180 THEN 1.0 WHEN median(l_quantity * 5) > 150 THEN 1.5 ELSE 2.0 END::DOUBLE AS scale FROM lineitem GROUP BY ALL")
def median_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.median(F.col("l_quantity") * 5).alias("height"))
    return out.withColumn("scale", G.reading_scale(F.col("height")))


@query("""
WITH RECURSIVE b AS (SELECT user_id, floor(epoch(ts) / 86400)::BIGINT AS day, (event_id * 31 % 120) AS x, (event_id * 17 % 90) AS y, 200 + event_id % 7 AS w, 80 + event_id % 5 AS h, event_id FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY -w * h, x, y, w, h) AS n FROM b),
f AS (SELECT user_id, day, 1 AS n, [{'x': x, 'y': y}] AS kept FROM o WHERE n = 1
  UNION ALL SELECT o.user_id, o.day, (f.n + 1)::INT, CASE WHEN len(list_filter(kept, lambda k: abs(k.x - o.x) < 18 AND abs(k.y - o.y) < 18)) > 0 THEN kept ELSE list_append(kept, {'x': o.x, 'y': o.y}) END FROM f JOIN o ON o.user_id = f.user_id AND o.day = f.day AND o.n = f.n + 1)
SELECT user_id, day, len(kept)::INT AS kept, list_sum(list_transform(kept, lambda k: k.x))::BIGINT AS sum_x FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY n DESC) AS r FROM f) WHERE r = 1""")
def nms_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's day is a page, so that an array holds one page's boxes."""
    e = F.col("event_id")
    box = F.struct((e * 31 % 120).alias("x"), (e * 17 % 90).alias("y"), (200 + e % 7).alias("w"), (80 + e % 5).alias("h"))
    boxes = _days(spark, sf_dir).groupBy("user_id", "day").agg(F.collect_list(box).alias("boxes"))
    kept = boxes.select("user_id", "day", G.suppressed(F.col("boxes")).alias("kept"))
    return kept.select("user_id", "day", F.size("kept").alias("kept"), F.aggregate("kept", F.lit(0).cast("long"), lambda a, b: a + b["x"]).alias("sum_x"))


@query("""WITH b AS (SELECT p_partkey, p_size - 5 AS x, p_partkey % 100 - 4 AS y, p_size AS w, 7 AS h FROM part), n AS (SELECT *, CASE WHEN x < 0 THEN 0 ELSE x END AS cx, CASE WHEN y < 0 THEN 0 ELSE y END AS cy FROM b),
f AS (SELECT *, CASE WHEN x + w > 40 THEN 40 ELSE x + w END - cx AS cw, CASE WHEN y + h > 90 THEN 90 ELSE y + h END - cy AS ch FROM n)
SELECT p_partkey, x + w AS x2, y + h AS y2, w * h AS area, cx, cy, CASE WHEN cw < 0 THEN 0 ELSE cw END AS cw, CASE WHEN ch < 0 THEN 0 ELSE ch END AS ch FROM f""")
def box_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") - 5).alias("x"), (F.col("p_partkey") % 100 - 4).alias("y"), F.col("p_size").alias("w"), F.lit(7).alias("h"))
    out = rows.withColumns(G.box_columns()).withColumns(G.clipped(F.lit(40), F.lit(90)))
    return out.select("p_partkey", "x2", "y2", "area", "cx", "cy", "cw", "ch")


@query("SELECT user_id, floor(hour(ts) / 4)::BIGINT AS band, count(*) FILTER (value < 30) AS dark, avg((value < 30)::INT) AS share, avg((value < 30)::INT) >= 0.03 AS occupied FROM events GROUP BY ALL")
def dark_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = table(spark, sf_dir, "events").withColumn("band", F.floor(F.hour("ts") / 4).cast("long"))
    ink = pixels.groupBy("user_id", "band").agg(G.ink_share(F.col("value") < 30).alias("share"))
    return G.dark_profile(pixels, "user_id", "band", "value", 30).join(ink, ["user_id", "band"]).withColumn("occupied", G.occupied(F.col("share")))


@query("""WITH e AS (SELECT event_id, event_id % 300 AS x, event_id % 70 AS y FROM events)
SELECT event_id, x + 20.0::DOUBLE AS tcx, y + 6.0::DOUBLE AS tcy, x::DOUBLE AS tx0, y::DOUBLE AS ty0, x / 2.0::DOUBLE + 11 AS moved_x, y / 2.0::DOUBLE + 7 AS moved_y FROM e""")
def token_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (F.col("event_id") % 300).cast("double"), (F.col("event_id") % 70).cast("double")
    box = F.array(F.array(x, y), F.array(x + 40, y), F.array(x + 40, y + 12), F.array(x, y + 12))
    rows = table(spark, sf_dir, "events").select("event_id", box.alias("bbox")).withColumn("moved", G.rescaled(F.col("bbox"), F.lit(2.0), F.lit(11), F.lit(7)))
    return rows.withColumns(G.token_centre(F.col("bbox"))).select("event_id", "tcx", "tcy", "tx0", "ty0", F.col("moved")[0][0].alias("moved_x"), F.col("moved")[0][1].alias("moved_y"))


@query("""WITH c AS (SELECT p_partkey, 100 + p_size AS x, 50 AS y, 500 + p_size AS w, 200 + p_size % 20 AS h FROM part)
SELECT p_partkey, x + round_even(0.5::DOUBLE * w, 0)::INT AS cx, y AS cy, round_even(0.48::DOUBLE * w, 0)::INT AS cw, round_even(0.18::DOUBLE * h, 0)::INT AS ch FROM c""")
def crop_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.schema import LAYOUT

    s = F.col("p_size")
    crop = G.crop_rectangle(LAYOUT.boxes["epic"], 100 + s, F.lit(50), 500 + s, 200 + s % 20)
    return table(spark, sf_dir, "part").select("p_partkey", crop.alias("b")).select("p_partkey", *[F.col(f"b.{c}").alias(f"c{c}") for c in "xywh"])


@query("""WITH f AS (SELECT p_partkey, p_size / 5000.0 AS ink, p_size % 3 // 2 AS cards, p_size % 11 AS v, p_size % 23 AS h, p_partkey % 31 AS cells FROM part)
SELECT p_partkey, CASE WHEN ink < 0.004 THEN 'blank' WHEN cards >= 1 THEN 'voter' WHEN v >= 8 AND h >= 16 AND cells >= 25 THEN 'voter' WHEN h >= 10 THEN 'header' WHEN h <= 3 THEN 'map' ELSE 'supplement' END AS page_type,
  CASE WHEN cells >= 25 THEN 'grid' WHEN cells = 0 THEN 'contour' WHEN v * 3 > cells + 3 THEN 'contour' ELSE 'grid' END AS method FROM f""")
def page_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, cells = F.col("p_size"), F.col("p_partkey") % 31
    return table(spark, sf_dir, "part").select("p_partkey", G.page_class(s / 5000.0, F.expr("p_size % 3 div 2"), s % 11, s % 23, cells).alias("page_type"), G.detector(cells, s % 11 * 3).alias("method"))
