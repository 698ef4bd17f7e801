"""Coverage queries: regions are nations, parts are customers' and suppliers' numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.operators import coverage as C
from cardloom.plans.registry import query, table

_BASE = """
WITH regions AS (SELECT r_name AS "districtName", n_nationkey AS "asmblyNo", n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey),
scanned AS (SELECT DISTINCT s_nationkey AS "asmblyNo", s_suppkey % 13 + 1 AS "partNo" FROM supplier WHERE s_nationkey % 4 <> 0),
downloaded AS (SELECT DISTINCT c_nationkey AS "asmblyNo", c_custkey % 17 + 1 AS "partNo" FROM customer WHERE c_nationkey % 3 = 1),
totals AS (
  SELECT r.*, coalesce(s.n, 0) AS scanned, coalesce(d.n, 0) AS downloaded,
    CASE WHEN coalesce(d.n, 0) > 0 THEN d.n WHEN coalesce(s.n, 0) = 0 THEN 700 ELSE s.most END::BIGINT AS total
  FROM regions r LEFT JOIN (SELECT "asmblyNo", count(DISTINCT "partNo") AS n, max("partNo") AS most FROM scanned GROUP BY ALL) s USING ("asmblyNo")
  LEFT JOIN (SELECT "asmblyNo", count(DISTINCT "partNo") AS n FROM downloaded GROUP BY ALL) d USING ("asmblyNo")
) """


def _frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    regions = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = regions.select(F.col("r_name").alias("districtName"), F.col("n_nationkey").alias("asmblyNo"), F.col("n_name").alias("name"))
    scanned = table(spark, sf_dir, "supplier").filter("s_nationkey % 4 <> 0").select(F.col("s_nationkey").alias("asmblyNo"), (F.col("s_suppkey") % 13 + 1).alias("partNo"))
    downloaded = table(spark, sf_dir, "customer").filter("c_nationkey % 3 = 1").select(F.col("c_nationkey").alias("asmblyNo"), (F.col("c_custkey") % 17 + 1).alias("partNo"))
    return regions, scanned, downloaded


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.assembly_totals(*_frames(spark, sf_dir), ["asmblyNo"])


@query(_BASE + 'SELECT "districtName", "asmblyNo", name, scanned, downloaded, total, greatest(0, total - scanned) AS pending FROM totals')
def coverage_ac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(spark, sf_dir).select("districtName", "asmblyNo", "name", "scanned", "downloaded", "total", "pending")


@query(_BASE + """SELECT "districtName", name, sum(scanned)::BIGINT AS scanned, sum(total)::BIGINT AS total, greatest(0, sum(total) - sum(scanned))::BIGINT AS pending,
  CASE WHEN sum(total) = 0 THEN 0 ELSE round(100.0 * sum(scanned) / sum(total)) END::BIGINT AS pct FROM totals GROUP BY ROLLUP ("districtName", name)""")
def coverage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.rolled_up(_totals(spark, sf_dir), ["districtName", "name"])
    return out.select("districtName", "name", "scanned", "total", "pending", C.percent(F.col("scanned"), F.col("total")).alias("pct"))


@query(_BASE + """SELECT "districtName", sum(scanned)::BIGINT AS scanned, sum(total)::BIGINT AS total, string_agg("asmblyNo" || ':' || scanned || '/' || total, ',' ORDER BY "asmblyNo") AS assemblies FROM totals GROUP BY ALL""")
def coverage_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = C.coverage_tree(_totals(spark, sf_dir).withColumn("districtCd", F.lit("d")))
    shown = F.transform("assemblies", lambda a: F.concat(a["asmblyNo"].cast("string"), F.lit(":"), a["scanned"].cast("string"), F.lit("/"), a["total"].cast("string")))
    return tree.select("districtName", "scanned", "total", F.array_join(shown, ",").alias("assemblies"))


@query(_BASE + """, marked AS (SELECT t.*, EXISTS (FROM downloaded d WHERE d."asmblyNo" = t."asmblyNo") AS has_any FROM totals t),
cells AS (
  SELECT "asmblyNo", unnest(range(1, total + 1)) AS "partNo" FROM marked WHERE NOT has_any
  UNION ALL SELECT * FROM (SELECT "asmblyNo", "partNo" FROM downloaded UNION SELECT "asmblyNo", "partNo" FROM scanned) WHERE "asmblyNo" IN (SELECT "asmblyNo" FROM marked WHERE has_any)
)
SELECT "asmblyNo", "partNo", EXISTS (FROM scanned s WHERE s."asmblyNo" = c."asmblyNo" AND s."partNo" = c."partNo") AS scanned,
  CASE WHEN EXISTS (FROM scanned s WHERE s."asmblyNo" = c."asmblyNo" AND s."partNo" = c."partNo") THEN CASE WHEN "partNo" % 2 = 0 THEN "partNo" + 1 ELSE 9 END ELSE 0 END AS "invalidCount",
  EXISTS (FROM downloaded d WHERE d."asmblyNo" = c."asmblyNo" AND d."partNo" = c."partNo") AS "hasPdf" FROM cells c""")
def coverage_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _totals(spark, sf_dir)
    _, scanned, downloaded = _frames(spark, sf_dir)
    done = scanned.distinct()
    counts = done.filter("partNo % 2 = 0").withColumn("invalid", F.col("partNo") + 1)
    return C.part_cells(totals.select("asmblyNo", "total"), scanned, downloaded, counts, done.withColumn("invalid", F.lit(9).cast("long")), ["asmblyNo"])


@query("""
WITH l AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name WHEN c_custkey % 3 = 1 THEN lower(replace(n_name, '_', ' ')) ELSE 'none' END AS folder, n_nationkey AS no FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, CASE WHEN folder = 'none' THEN NULL ELSE no + 100 END AS code FROM l""")
def lookup_two_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    k = F.col("c_custkey") % 3
    left = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    left = left.select("c_custkey", F.when(k == 0, F.col("n_name")).when(k == 1, F.lower(F.translate("n_name", "_", " "))).otherwise("none").alias("folder"))
    right = nation.select(F.col("n_name").alias("folder"), (F.col("n_nationkey") + 100).alias("code"))
    return C.two_tier(left, right, ["folder"], [(X.spaced(F.col("folder")), "trim(lower(translate(folder, '_', ' ')))")], "code").select("c_custkey", "code")


@query("SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey = 7 AND s_suppkey % 4 <> 1")
def ledger_of_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.col("s_nationkey").alias("asmblyNo"), F.when(F.col("s_suppkey") % 4 == 0, "FAR_East").when(F.col("s_suppkey") % 4 == 1, "West").when(F.col("s_suppkey") % 4 == 2, " ").alias("districtFolder"))
    return rows.filter(C.in_assembly(7, "Far_East")).select("s_suppkey", "s_nationkey")
