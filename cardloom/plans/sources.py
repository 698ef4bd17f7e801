"""Queries on sources and sinks: tables are written as files first, and read back as a user's files would be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.plans.registry import dealt, query, table
from cardloom.sources.staging import new_folder
from cardloom.sources.tables import csv_report, tables_by_header, tables_of, typed, widened

_KNOWN = T.StructType([T.StructField("serialNo", T.LongType()), T.StructField("epic", T.StringType()), T.StructField("name", T.StringType()), T.StructField("age", T.LongType()), T.StructField("houseNo", T.StringType())])
#: Columns of each kind of file, in their order.
_KINDS = (("name", "epic", "serialNo", "age"), ("serialNo", "houseNo", "name"), ("note", "age", "name", "serialNo"))


def _csv_files(spark: SparkSession, sf_dir: str) -> str:
    """Customers as CSV files of three kinds, with other columns in another order each; every 50th age of the first kind is no number."""
    folder, k = new_folder(spark, "csv"), F.col("c_custkey")
    cells = {"name": F.col("c_name"), "epic": F.concat(F.lit("E"), k), "serialNo": k, "age": F.when(k % 50 == 0, F.lit("n/a")).otherwise((k % 90).cast("string")), "houseNo": F.lpad((k % 1000).cast("string"), 4, "0"), "note": k / 2}
    for n, names in enumerate(_KINDS):
        table(spark, sf_dir, "customer").filter(k % 3 == n).select(*[cells[c].alias(c) for c in names]).write.option("header", True).csv(f"{folder}/kind{n}")
    return folder


@query("""SELECT c_custkey AS "serialNo", CASE WHEN c_custkey % 3 = 0 THEN 'E' || c_custkey END AS epic, c_name AS name, CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 50 <> 0 THEN c_custkey % 90 END AS age,
  CASE WHEN c_custkey % 3 = 1 THEN lpad((c_custkey % 1000)::VARCHAR, 4, '0') END AS "houseNo", CASE WHEN c_custkey % 3 = 2 THEN c_custkey / 2 END AS note FROM customer""")
def csv_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables_by_header(spark, _csv_files(spark, sf_dir), known=tuple(_KNOWN.fieldNames()))
    return widened(typed(rows, _KNOWN), keep=("epic", "name", "houseNo")).drop("_corrupt_record", "_file")


@query("SELECT 'kind' || c_custkey % 3 AS kind, count(*) AS rows, 0 AS corrupt, count(*) FILTER (c_custkey % 3 <> 1 AND c_custkey % 50 = 0) AS bad_cells FROM customer GROUP BY ALL")
def csv_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables_by_header(spark, _csv_files(spark, sf_dir), known=tuple(_KNOWN.fieldNames()))
    kind = F.element_at(F.split("_file", "/"), -2)
    return csv_report(rows, _KNOWN).groupBy(kind.alias("kind")).agg(*[F.sum(c).alias(c) for c in ("rows", "corrupt", "bad_cells")])


@query("""WITH p AS (SELECT p_partkey AS k FROM part)
SELECT k AS p_partkey, 0 AS seq, 'A' || k AS text, 0.5::DOUBLE AS confidence, 0.0::DOUBLE AS x0, 0.0::DOUBLE AS y0, 10.0::DOUBLE AS x2, 5.0::DOUBLE AS y2 FROM p WHERE k % 4 = 0
UNION ALL SELECT k, 1, 'B' || k, 0.0, 1.0, 2.0, 11.0, 7.0 FROM p WHERE k % 4 = 0
UNION ALL SELECT k, 0, 'C' || k, 1.0, k % 7, 1.0, k % 7 + 9, 6.0 FROM p WHERE k % 4 = 1
UNION ALL SELECT k, 0, 'D' || k, 0.25, 0.0, 0.0, 4.0, 2.0 FROM p WHERE k % 4 = 2
UNION ALL SELECT k, 1, 'E' || k, 1.0, 1.0, 1.0, 2.0, 2.0 FROM p WHERE k % 4 = 2""")
def result_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of three shapes, and some that are none; texts of white space have no token."""
    from cardloom.sources.results import tokens_from_results

    k = F.col("p_partkey")
    result = (
        F.when(k % 4 == 0, F.format_string('[{"rec_texts": ["A%d", "  ", " B%d "], "rec_scores": [0.5, 0.9], "rec_polys": [[[0, 0], [10, 0], [10, 5], [0, 5]], null, [1, 2, 11, 7]]}]', k, k))
        .when(k % 4 == 1, F.format_string('{"str": ["C%d"], "dt_polys": [[[%d, 1], [%d, 6]]]}', k, k % 7, k % 7 + 9))
        .when(k % 4 == 2, F.format_string('[[[[[0, 0], [4, 0], [4, 2], [0, 2]], ["D%d", 0.25]], [[[1, 1], [2, 2]], "E%d"], [[[0, 0], [1, 1]], ["", 0.1]]]]', k, k))
        .otherwise(F.when(k % 8 == 3, "no result"))
    )
    found = tokens_from_results(dealt(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey").select("p_partkey", result.alias("result")), "p_partkey")
    corner = lambda n, i: F.get(F.get("bbox", F.lit(n)), F.lit(i))
    return found.select("p_partkey", "seq", "text", "confidence", corner(0, 0).alias("x0"), corner(0, 1).alias("y0"), corner(2, 0).alias("x2"), corner(2, 1).alias("y2"))


def _ladder(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    from cardloom.operators.ladder import card_ranks

    texts = {
        "epic": lambda k: F.when(k % 4 == 0, F.concat(F.lit("ABC"), F.lpad(k.cast("string"), 7, "0"))).otherwise("unclear"),
        "epic_fallback": lambda k: F.when(k % 7 != 0, F.concat(F.lit("XYZ"), F.lpad(k.cast("string"), 7, "0"))),
        "house": lambda k: F.when(k % 8 != 0, F.concat(F.lit("House Number : 12-"), k)), "age": lambda k: F.when(k % 25 == 0, "Gender : Male").otherwise("unclear"),
        "age_fallback": lambda k: F.concat(F.lit("Age : "), 20 + k % 60), "age_crowded": lambda k: F.lit("Age : 99 Gender : Female"),
    }
    k, has = F.col("c_custkey"), lambda when, value: F.when(when, value)
    records = table(spark, sf_dir, "customer").select("c_custkey", has(k % 3 != 0, F.lit("own")).alias("epic"), has(k % 2 != 0, F.lit("own")).alias("houseNo"), has(k % 5 != 0, F.lit(30)).cast("long").alias("age"), has(k % 10 != 0, F.lit("Others")).alias("gender"))
    return records, card_ranks(lambda region: texts[region], ("c_custkey",))


_LADDER = """WITH a AS (SELECT c_custkey AS k, k % 3 = 0 AS e0, k % 2 = 0 AS h0, k % 5 = 0 AS a0, k % 10 = 0 AS g0 FROM customer),
b AS (SELECT *, e0 AND k % 4 <> 0 AS e1, (a0 OR g0) AS g1 FROM a),
c AS (SELECT *, a0 OR (g0 AND k % 25 <> 0) AS g2 FROM b),
d AS (SELECT *, g0 AND k % 25 <> 0 AS g3 FROM c) """


@query(_LADDER + """SELECT k AS c_custkey, CASE WHEN NOT e0 THEN 'own' WHEN k % 4 = 0 THEN 'ABC' || lpad(k::VARCHAR, 7, '0') WHEN k % 7 <> 0 THEN 'XYZ' || lpad(k::VARCHAR, 7, '0') END AS epic,
  CASE WHEN NOT h0 THEN 'own' WHEN k % 8 <> 0 THEN '12-' || k END AS "houseNo", CASE WHEN a0 THEN 20 + k % 60 ELSE 30 END::BIGINT AS age,
  CASE WHEN NOT g0 THEN 'Others' WHEN k % 25 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  concat_ws(' ', CASE WHEN e0 THEN 'epic' END, CASE WHEN e1 AND k % 7 <> 0 THEN 'epic_fallback' END, CASE WHEN h0 AND k % 8 <> 0 THEN 'house' END, CASE WHEN g1 THEN 'age' END, CASE WHEN g2 THEN 'age_fallback' END, CASE WHEN g3 THEN 'age_crowded' END) AS consulted FROM d""")
def refill_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.operators.ladder import climbed

    records, ranks = _ladder(spark, sf_dir)
    return climbed(records, ranks).withColumn("consulted", F.array_join("consulted.rank", " "))


@query(_LADDER + """SELECT rank, place, read FROM (SELECT count(*) FILTER (e0) AS r0, count(*) FILTER (e1 AND k % 7 <> 0) AS r1, count(*) FILTER (h0 AND k % 8 <> 0) AS r2, count(*) FILTER (g1) AS r3, count(*) FILTER (g2) AS r4, count(*) FILTER (g3) AS r5 FROM d),
LATERAL (VALUES ('epic', 0, r0), ('epic_fallback', 1, r1), ('house', 2, r2), ('age', 3, r3), ('age_fallback', 4, r4), ('age_crowded', 5, r5)) t(rank, place, read)""")
def refill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.operators.ladder import climbed, rank_counts

    records, ranks = _ladder(spark, sf_dir)
    return rank_counts(climbed(records, ranks), ranks)


@query("""SELECT 'doc=' || s_nationkey AS doc, count(*) AS tokens, coalesce(sum(s_suppkey % 300) FILTER (s_suppkey % 40 <> 7), 0)::DOUBLE AS sum_x, count(*) FILTER (s_suppkey % 40 = 7) AS failed FROM supplier WHERE s_nationkey < 20 GROUP BY ALL""")
def page_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each supplier in a folder for each nation; nations under 20 are asked for, and some files are no pages."""
    from cardloom.sources.token_source import read_pages

    folder, k = new_folder(spark, "pages"), F.col("s_suppkey")
    line = F.when(k % 40 == 7, F.lit("broken")).otherwise(F.concat_ws(" ", k % 300, k % 50, F.concat(F.lit("t"), k)))
    lines = dealt(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").select(F.col("s_nationkey").alias("doc"), line.alias("value"))
    lines.write.partitionBy("doc").option("maxRecordsPerFile", 1).text(folder)
    tokens = read_pages(spark, folder, pattern=r"part-(\d+)-.*\.txt").filter(F.col("doc").isin([f"doc={n}" for n in range(20)]))
    x = F.get(F.get("bbox", F.lit(0)), F.lit(0))
    return tokens.groupBy("doc").agg(F.count("*").alias("tokens"), F.coalesce(F.sum(x), F.lit(0.0)).alias("sum_x"), F.count_if(F.col("error").isNotNull()).alias("failed"))


@query("""WITH s AS (SELECT s_nationkey AS n, s_suppkey AS k FROM supplier), saved AS (SELECT n, k, '/out/Far_East/' || n || '_Elm/part_' || k AS path FROM s WHERE k % 2 = 0),
asked AS (SELECT DISTINCT n, NULL::BIGINT AS k, CASE WHEN n % 3 = 0 THEN '/out/Far_East/' || n || '_Elm/' ELSE 'file:///downloads/Far_East/' || n || '_Elm' END AS asked FROM s WHERE n % 3 <> 2
  UNION ALL SELECT n, k, '/out/Far_East/' || n || '_Elm/part_' || k FROM s WHERE n % 3 = 2)
SELECT asked, path, 'part_' || saved.k AS part FROM asked JOIN saved ON saved.n = asked.n AND (asked.k IS NULL OR asked.k = saved.k OR asked.k % 2 = 1)""")
def resolved_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of assemblies, of downloads, and of parts; a part without saved records stands for those of its assembly."""
    from cardloom.sources import parts as P

    n, k = F.col("s_nationkey"), F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier")
    assembly = F.concat(F.lit("/Far_East/"), n, F.lit("_Elm"))
    listing = rows.filter(k % 2 == 0).select(F.concat(F.lit("/out"), assembly, F.lit("/part_"), k, F.lit("/json/voters.json")).alias("path"))
    asked = rows.select(F.when(n % 3 == 0, F.concat(F.lit("/out"), assembly, F.lit("/"))).when(n % 3 == 1, F.concat(F.lit("file:///downloads"), assembly)).otherwise(F.concat(F.lit("/out"), assembly, F.lit("/part_"), k)).alias("asked"))
    return P.resolved_parts(asked, listing, "file:///out/")


@query("""WITH s AS (SELECT s_suppkey AS k, s_suppkey - 2 AS "partNo", CASE WHEN s_suppkey % 7 = 0 THEN '..' WHEN s_suppkey % 7 = 1 THEN 'a/b' ELSE '4_Elm' END AS ac FROM supplier)
SELECT k, "partNo", CASE WHEN "partNo" >= 1 AND ac = '4_Elm' AND "partNo" % 3 <> 0 THEN '/d/Far_East/4_Elm/part_' || "partNo" || '.pdf' END AS "pdfPath" FROM s""")
def resolved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.sources import parts as P

    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(k.alias("k"), (k - 2).alias("partNo"))
    asked = rows.withColumns({"districtFolder": F.lit("Far East"), "acFolder": F.when(F.col("k") % 7 == 0, "..").when(F.col("k") % 7 == 1, "a/b").otherwise("4_Elm")})
    listing = rows.filter("partNo % 3 <> 0").select(F.concat(F.lit("file:///d/Far_East/4_Elm/part_"), "partNo", F.lit(".pdf")).alias("path"))
    return P.resolved_files(asked, listing, "/d").select("k", "partNo", "pdfPath")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey % 4 = 0 OR s_suppkey % 9 = 0")
def files_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.sources import parts as P

    files = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("file:///d/"), "s_nationkey", F.lit("/x/part_"), "s_suppkey", F.lit(".pdf")).alias("path"))
    nations = table(spark, sf_dir, "nation").filter("n_nationkey % 4 = 0").select(F.concat(F.lit("/d/"), "n_nationkey", F.lit("/")).alias("asked"))
    return P.below(files, nations.unionByName(files.filter("s_suppkey % 9 = 0").select(F.col("path").alias("asked")))).select("s_suppkey")


@query("""WITH r AS (SELECT o_custkey AS part, o_orderkey AS k FROM orders WHERE o_custkey % 4 <> 0), n AS (SELECT part, count(*) AS voters, sum(k)::BIGINT AS keys, count(*) FILTER (k % 3 = 0) AS valid FROM r GROUP BY part)
SELECT 'D/1_X/part_' || c_custkey AS path, c_custkey AS "partNo", coalesce(voters, 0) AS voters, coalesce(keys, 0) AS keys, coalesce(valid, 0) AS valid, coalesce(voters, 0) AS table_rows, coalesce(keys, 0) AS table_keys FROM customer LEFT JOIN n ON part = c_custkey WHERE c_custkey % 10 < 2""")
def payload_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of their customers' parts, a tenth of them without any, written as files and read back."""
    from cardloom.sources import files
    from cardloom.sources.many_files import listed
    from cardloom.sources.payload_sink import write_parts

    folder, k = new_folder(spark, "parts"), F.col("o_orderkey")
    path = lambda c: F.concat(F.lit("D/1_X/part_"), c)
    records = table(spark, sf_dir, "orders").filter("o_custkey % 4 <> 0").select(path("o_custkey").alias("path"), k.alias("serialNo"), F.concat(F.lit('na"me, '), k).alias("name"), (k % 3 == 0).alias("valid"))
    parts = table(spark, sf_dir, "customer").filter("c_custkey % 10 < 2").select(path("c_custkey").alias("path"), F.col("c_custkey").alias("partNo"), F.concat(F.lit("s"), "c_custkey").alias("source"))
    write_parts(records, parts, folder)
    below = lambda c: F.regexp_extract(c, "(D/1_X/part_[0-9]+)/", 1)
    found = listed(spark, folder, "voters.*")
    saved = files.payloads_of(found.filter("path like '%.json'"))
    sums = saved.select(below(F.col("path")).alias("path"), "partNo", F.size("voters").cast("long").alias("voters"), F.aggregate("voters", F.lit(0).cast("long"), lambda a, v: a + v["serialNo"]).alias("keys"), F.size(F.filter("voters", lambda v: v["valid"])).cast("long").alias("valid"))
    rows = tables_of(found.filter("path like '%.csv'"))
    csv = rows.filter(F.col("name") == F.concat(F.lit('na"me, '), F.col("serialNo"))).groupBy(below(F.col("_file")).alias("path")).agg(F.count("*").alias("table_rows"), F.sum(F.col("serialNo").cast("long")).alias("table_keys"))
    return sums.join(csv, "path", "left").fillna(0, ["table_rows", "table_keys"])
