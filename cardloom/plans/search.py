"""Search and path queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.operators import coverage as C
from cardloom.operators import search as S
from cardloom.plans.registry import query, table
from cardloom.sources.files import part_number

_PART = ("p_name", "p_brand", "p_type")
_HAY = "lower(concat_ws(' ', p_name, p_brand, p_type))"


@query(f"SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE contains({_HAY}, 'ring') AND contains({_HAY}, 'brand#1')")
def search_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(S.matches("Ring  BRAND#1", _PART)).select("p_partkey", *_PART)


@query(f"SELECT count(*) AS matches FROM part WHERE contains({_HAY}, 'widget') AND contains({_HAY}, 'economy')")
def search_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(S.matches("widget ECONOMY", _PART)).agg(F.count("*").alias("matches"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE contains(lower(concat_ws(' ', c_name, c_mktsegment)), 'customer#0') AND contains(lower(concat_ws(' ', c_name, c_mktsegment)), 'house') ORDER BY c_name, c_custkey LIMIT 200")
def search_top200(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "customer").filter(S.matches("customer#0 house", ("c_name", "c_mktsegment")))
    return found.select("c_custkey", "c_name", "c_mktsegment").orderBy("c_name", "c_custkey").limit(S.PAGE)


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their nations as registry rows."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    part = F.pmod("s_suppkey", F.lit(7)) + 1
    path = F.concat_ws("/", F.initcap("r_name"), F.concat("n_nationkey", F.lit("_"), F.initcap("n_name")), F.concat(F.lit("part_"), part, F.lit(".pdf")))
    return rows.select(
        F.col("s_suppkey").alias("serialNo"), F.lit(None).cast("string").alias("epic"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("relativeName"),
        F.lit(None).cast("string").alias("houseNo"), F.lit(None).cast("string").alias("section"), F.lit(1).cast("long").alias("page"), part.cast("long").alias("partNo"),
        F.initcap(F.translate("n_name", "_", " ")).alias("constituency"), F.when(F.pmod("s_suppkey", F.lit(5)) == 0, F.concat(F.lit("part_"), part, F.lit(".pdf"))).otherwise(path).alias("sourcePdf"),
    )


_REGISTRY_SQL = """
WITH reg AS (
  SELECT s_suppkey AS "serialNo", s_name AS name, 'Nation ' || n_nationkey AS constituency, s_suppkey % 7 + 1 AS "partNo",
    CASE WHEN s_suppkey % 5 = 0 THEN 'part_' || (s_suppkey % 7 + 1) || '.pdf'
    ELSE array_to_string(list_transform(string_split(r_name, ' '), lambda w: upper(w[1]) || lower(substr(w, 2))), ' ') || '/' || n_nationkey || '_' || 'Nation_' || n_nationkey || '/part_' || (s_suppkey % 7 + 1) || '.pdf' END AS "sourcePdf"
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
) """


@query(_REGISTRY_SQL + """SELECT "serialNo", name, "sourcePdf" FROM reg WHERE "sourcePdf" LIKE 'Asia/%'""")
def search_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search(_registry(spark, sf_dir), "", district="Asia")[0].select("serialNo", "name", "sourcePdf")


@query(_REGISTRY_SQL + """SELECT "serialNo", name, "sourcePdf" FROM reg WHERE constituency = 'Nation 7' AND (regexp_matches("sourcePdf", '^Asia/') OR "sourcePdf" NOT LIKE '%/%')""")
def search_district_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare file names pass the district, as the assembly - given with spaces here - is theirs."""
    return S.search(_registry(spark, sf_dir), "", district="Asia", ac="7 Nation 7")[0].select("serialNo", "name", "sourcePdf")


@query(_REGISTRY_SQL + """SELECT "serialNo", name, "sourcePdf" FROM reg WHERE (contains("sourcePdf", '/7_Nation_7/') OR contains(lower(constituency), 'nation 7')) AND contains(lower(name || ' ' || "sourcePdf"), 'supplier')""")
def search_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search(_registry(spark, sf_dir), "supplier", ac="7_Nation_7")[0].select("serialNo", "name", "sourcePdf")


@query(_REGISTRY_SQL + """SELECT "serialNo", name, "sourcePdf" FROM reg WHERE contains("sourcePdf", '/2_')""")
def search_assembly_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search(_registry(spark, sf_dir), None, assembly=2)[0].select("serialNo", "name", "sourcePdf")


@query(_REGISTRY_SQL + """SELECT "serialNo", name, "sourcePdf" FROM reg WHERE ends_with("sourcePdf", '/part_3.pdf') OR "sourcePdf" = 'part_3.pdf' OR "partNo" = 3 ORDER BY "sourcePdf", "serialNo" LIMIT 500""")
def search_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search(_registry(spark, sf_dir), "", part=3)[1].select("serialNo", "name", "sourcePdf")


@query("SELECT count(*) AS matches FROM part WHERE false")
def search_empty_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search(_registry(spark, sf_dir), "  ")[0].agg(F.count("*").alias("matches"))


@query("SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')")
def hier_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").filter(F.col("url").startswith("https://")).select("page_id", "url")


@query("SELECT page_id, url FROM pages WHERE contains(url, '/en/') OR contains(lower(url), 'blog')")
def hier_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").filter(F.col("url").contains("/en/") | F.lower("url").contains("blog")).select("page_id", "url")


@query("SELECT page_id, url FROM pages WHERE ends_with(url, '.html') OR url = 'http://example.com' OR page_id = 7")
def hier_suffix_or_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").filter(u.endswith(".html") | (u == "http://example.com") | (F.col("page_id") == 7)).select("page_id", "url")


@query("SELECT count(*) FILTER (contains(url, '/e_/')) AS literal, count(*) FILTER (url LIKE '%/e_/%') AS wildcard FROM pages")
def like_vs_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").agg(F.count_if(F.col("url").contains("/e_/")).alias("literal"), F.count_if(F.col("url").like("%/e_/%")).alias("wildcard"))


@query("""SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS folder, try_cast(nullif(regexp_extract(url, '/(\\d+)(?:[^/]*)/?$', 1), '') AS BIGINT) AS number FROM pages""")
def path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.split("url", "/")
    return table(spark, sf_dir, "pages").select("page_id", F.try_element_at(cut, F.lit(3)).alias("host"), F.try_element_at(cut, F.lit(4)).alias("folder"), F.regexp_extract("url", r"/(\d+)(?:[^/]*)/?$", 1).try_cast("long").alias("number"))


@query("""
SELECT s_suppkey, 'Asia' AS district, n::BIGINT AS "asmblyNo", 'Nation ' || n AS "acName", p AS "partNo", 'Asia/' || n || '_Nation_' || n || '/part_' || p || '.pdf' AS path, 'Asia|' || n || '|' || p AS key
FROM (SELECT s_suppkey, s_nationkey AS n, s_suppkey % 11 AS p FROM supplier) WHERE s_suppkey % 4 <> 0
UNION ALL SELECT s_suppkey, NULL, NULL, NULL, NULL, 'loose/part_' || s_suppkey || '.pdf', NULL FROM supplier WHERE s_suppkey % 4 = 0""")
def roll_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, p = F.col("s_nationkey"), F.pmod("s_suppkey", F.lit(11))
    path = F.when(F.pmod("s_suppkey", F.lit(4)) == 0, F.concat(F.lit("loose/part_"), "s_suppkey", F.lit(".pdf"))).otherwise(C.part_path(F.lit("Asia"), C.assembly_folder(n, F.concat(F.lit("Nation "), n)), p))
    at = table(spark, sf_dir, "supplier").withColumn("path", path).withColumn("at", C.roll_location(F.col("path")))
    return at.select("s_suppkey", "at.district", "at.asmblyNo", "at.acName", "at.partNo", "path", F.when(F.col("at").isNotNull(), C.ledger_key(F.col("at.districtFolder"), F.col("at.asmblyNo"), F.col("at.partNo"))).alias("key"))


@query("""SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN NULL WHEN p_size % 6 = 1 THEN NULL WHEN p_size % 6 = 2 THEN NULL ELSE 'part_' || p_size END AS segment FROM part""")
def safe_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.pmod("p_size", F.lit(6))
    raw = F.when(k == 0, "..").when(k == 1, "a/b").when(k == 2, " ").otherwise(F.concat(F.lit(" part_"), "p_size", F.lit(" ")))
    return table(spark, sf_dir, "part").select("p_partkey", X.safe_segment(raw).alias("segment"))


@query("""
WITH f AS (SELECT s_suppkey, s_suppkey // 700 AS folder, CASE WHEN s_suppkey % 9 = 0 THEN 'cover' || s_suppkey WHEN s_suppkey % 2 = 0 THEN 'Part-' || s_suppkey ELSE 'part_' || s_suppkey END || '.pdf' AS file FROM supplier)
SELECT file, folder, row_number() OVER (PARTITION BY folder ORDER BY coalesce(try_cast(nullif(regexp_extract(file, '(?i)part[_\\-]?(\\d+)', 1), '') AS BIGINT), 1000000000), lower(file), file) AS place FROM f""")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    k = F.col("s_suppkey")
    file = F.concat(F.when(F.pmod(k, F.lit(9)) == 0, F.concat(F.lit("cover"), k)).when(F.pmod(k, F.lit(2)) == 0, F.concat(F.lit("Part-"), k)).otherwise(F.concat(F.lit("part_"), k)), F.lit(".pdf"))
    files = table(spark, sf_dir, "supplier").select(file.alias("file"), F.expr("s_suppkey div 700").alias("folder"))
    return files.withColumn("place", F.row_number().over(Window.partitionBy("folder").orderBy(part_number(F.col("file")), F.lower("file"), "file")).cast("long"))


@query("""
SELECT p_partkey, array_to_string(list_filter(list_sort(list_distinct([3, 14, p_size] || range(22, 27))), lambda p: p >= 1 AND p <= 25), ',') AS pages FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, array_to_string(range(1, p_size + 1), ',') FROM part WHERE p_partkey % 2 = 1""")
def page_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.pmod("p_partkey", F.lit(2)) == 0
    spec = F.when(even, F.concat(F.lit("3, 14,22-26,"), F.col("p_size").cast("string"))).otherwise("")
    pages = X.page_set(spec, F.when(even, F.lit(25)).otherwise(F.col("p_size")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(pages.cast("array<string>"), ",").alias("pages"))


@query(f"SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE contains({_HAY}, 'ring') AND contains({_HAY}, 'brand#1') AND contains({_HAY}, 'e')")
def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings narrow the rows by two words; a third one is too short for them."""
    from cardloom.operators import postings
    from cardloom.sources.staging import new_folder

    index = postings.build(table(spark, sf_dir, "part"), new_folder(spark, "index"), _PART, "p_partkey")
    return index.search("Ring BRAND#1 e").select("p_partkey", *_PART)


@query(f"""SELECT q AS query, n AS candidates, n AS found, (SELECT count(*) FROM part) AS total FROM (
  SELECT 'economy' AS q, count(*) FILTER (contains({_HAY}, 'economy')) AS n FROM part UNION ALL SELECT 'brand#3 econ', count(*) FILTER (contains({_HAY}, 'brand#3') AND contains({_HAY}, 'econ')) FROM part
  UNION ALL SELECT 'absent', 0)""")
def search_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the postings leave; here each of them matches."""
    from cardloom.operators import postings
    from cardloom.sources.staging import new_folder

    return postings.build(table(spark, sf_dir, "part"), new_folder(spark, "index"), _PART, "p_partkey").report(["economy", "brand#3 econ", "absent"])
