"""Queries of page bookkeeping and of boxes in pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import geometry as G
from cardloom.operators import pages as P
from cardloom.plans.registry import query, table
from cardloom.schema import LAYOUT


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN value END AS v FROM events)
SELECT user_id, event_id, coalesce(v, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS v FROM e""")
def carried_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "signup", F.col("value")).alias("v"))
    return P.carried_header(rows, "user_id", "event_id", ["v"])


@query("""WITH r AS (SELECT o_custkey AS doc, month(o_orderdate) AS page, o_orderkey, o_orderpriority FROM orders), w AS (SELECT DISTINCT doc, page % 6 + 1 AS page FROM r)
SELECT doc, page, coalesce((SELECT arg_min(o_orderpriority, o_orderkey) FROM r WHERE r.doc = w.doc AND r.page = w.page), (SELECT arg_min(o_orderpriority, o_orderkey) FROM r WHERE r.doc = w.doc)) AS o_orderpriority FROM w""")
def metadata_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.month("o_orderdate").alias("page"), "o_orderkey", "o_orderpriority")
    wanted = rows.select("doc", (F.col("page") % 6 + 1).alias("page")).distinct()
    return P.metadata_for(wanted, rows, "doc", "page", "o_orderkey", ["o_orderpriority"])


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'map' ELSE 'voter' END AS one, 'blank' AS two, CASE WHEN p_size % 2 = 0 THEN 'voter' END AS three FROM part""")
def merged_page_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.create_map(F.lit(1), F.lit("voter"), F.lit(2), F.lit("blank"))
    new = F.when(F.col("p_size") % 2 == 0, F.create_map(F.lit(1), F.lit("map"), F.lit(3), F.lit("voter"))).otherwise(F.create_map().cast("map<int,string>"))
    return table(spark, sf_dir, "part").select("p_partkey", P.merged_page_types(old, new).alias("m")).select("p_partkey", *[F.try_element_at("m", F.lit(k)).alias(n) for k, n in ((1, "one"), (2, "two"), (3, "three"))])


_IMAGES = """WITH r AS (SELECT o_custkey AS doc, month(o_orderdate) AS page, o_orderkey % 30 AS card, o_orderstatus <> 'P' AS valid FROM orders),
i AS (SELECT DISTINCT doc, 'd/page' || page || '_card' || card || '.png' AS path, page, card FROM r UNION SELECT DISTINCT doc, 'd/page' || page || '.png', page, NULL FROM r UNION SELECT doc, 'd/notes.txt', NULL, NULL FROM r) """


@query(_IMAGES + """SELECT doc, path, CASE WHEN page IS NULL THEN false WHEN card IS NULL THEN EXISTS (FROM r WHERE r.doc = i.doc AND r.page = i.page AND NOT valid) ELSE EXISTS (FROM r WHERE r.doc = i.doc AND r.page = i.page AND r.card = i.card AND NOT valid) END AS keep FROM i""")
def image_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.month("o_orderdate").cast("long").alias("page"), (F.col("o_orderkey") % 30).alias("card"), (F.col("o_orderstatus") != "P").alias("valid"))
    names = [F.concat(F.lit("d/page"), "page", F.lit("_card"), "card", F.lit(".png")), F.concat(F.lit("d/page"), "page", F.lit(".png")), F.lit("d/notes.txt")]
    images = rows.select("doc", F.explode(F.array(*names)).alias("path")).distinct()
    return P.image_verdicts(images, rows)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("o_custkey"))
    return P.not_done(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, ["o_custkey"])


@query("""WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_size % 5 + 1 ELSE 600 + p_size END AS w, CASE WHEN p_partkey % 4 = 0 THEN p_size % 3 + 1 ELSE 250 + p_size END AS h FROM part),
r AS (SELECT *, round_even(0.01::DOUBLE * w, 0)::INT AS x, round_even(0.415::DOUBLE * h, 0)::INT AS y, round_even(0.74::DOUBLE * w, 0)::INT AS bw, round_even(0.125::DOUBLE * h, 0)::INT AS bh FROM s)
SELECT p_partkey, x, y, CASE WHEN bw = 0 THEN 1 WHEN x + bw > w THEN w - x ELSE bw END AS w, CASE WHEN bh = 0 THEN 1 WHEN y + bh > h THEN h - y ELSE bh END AS h FROM r""")
def pixel_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = F.col("p_partkey") % 4 == 0
    box = G.pixel_box(LAYOUT.boxes["house"], F.when(small, F.col("p_size") % 5 + 1).otherwise(F.col("p_size") + 600), F.when(small, F.col("p_size") % 3 + 1).otherwise(F.col("p_size") + 250))
    return table(spark, sf_dir, "part").select("p_partkey", box.alias("b")).select("p_partkey", "b.*")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '1,2|9,2|9,5|1,5' WHEN 1 THEN '0,0|1,0|1,1|0,1' ELSE '0,0|0,0|0,0|0,0' END AS quad FROM part""")
def quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("p_partkey") % 3, lambda *xy: F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in xy])
    points = F.when(k == 0, p((1, 2), (9, 5))).when(k == 1, p((0, 0), (1, 0), (1, 1), (0, 1), (7, 7))).otherwise(p((3, 3)))
    shown = F.transform(G.quad(points), lambda q: F.array_join(F.transform(q, lambda v: v.cast("int").cast("string")), ","))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(shown, "|").alias("quad"))


@query("""SELECT p_partkey, abs(w / h - 2.47::DOUBLE) <= 0.35::DOUBLE AND w / 1983 BETWEEN 0.26::DOUBLE AND 0.36::DOUBLE AND h / 2806 BETWEEN 0.07::DOUBLE AND 0.12::DOUBLE AS card, w * h / (1983 * 2806) BETWEEN 0.012::DOUBLE AND 0.07::DOUBLE AND w / h BETWEEN 1.6::DOUBLE AND 3.6::DOUBLE AND h >= 70 AND w >= 180 AS contour
FROM (SELECT p_partkey, (480 + p_size * 5)::DOUBLE AS w, (150 + p_partkey % 160)::DOUBLE AS h FROM part)""")
def card_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = (F.col("p_size") * 5 + 480).cast("double"), (F.col("p_partkey") % 160 + 150).cast("double")
    pw, ph = F.lit(1983.0), F.lit(2806.0)
    return table(spark, sf_dir, "part").select("p_partkey", G.card_shaped(w, h, pw, ph).alias("card"), G.contour_sized(w, h, pw, ph).alias("contour"))
