"""Queries of whole jobs: parts are customers, records are orders, pages are their numbers modulo 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import jobs as J
from cardloom.operators import records as R
from cardloom.plans.registry import query, table
from cardloom.sources import files

_ORDERS = """WITH o AS (SELECT o_orderkey AS k, o_custkey AS part, o_orderkey % 9 AS page, o_orderkey % 4 <> 1 AS valid, CASE WHEN o_orderkey % 4 <> 1 THEN 'none' WHEN o_orderkey % 8 = 1 THEN 'clip' ELSE 'other' END AS kind FROM orders),
again AS (SELECT DISTINCT part, page FROM o WHERE kind = 'other'),
later AS (SELECT k, part, page, valid OR k % 3 = 0 AS valid FROM o JOIN again USING (part, page)) """


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    errors = F.when(k % 4 != 1, F.array().cast("array<string>")).when(k % 8 == 1, F.array(F.lit("missing_gender"), F.lit("missing_age"))).otherwise(F.array(F.lit("missing_epic"), F.lit("missing_age")))
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.col("o_custkey").alias("part"), (k % 9).alias("page"), (k % 4 != 1).alias("valid"), errors.alias("errors"))


def _again(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    pages = J.retry_pages(records)
    return pages, records.join(pages, ["part", "page"], "left_semi").withColumn("valid", F.col("valid") | (F.col("k") % 3 == 0))


@query(_ORDERS + "SELECT part, page FROM again")
def retry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.retry_pages(_records(spark, sf_dir))


@query(_ORDERS + "SELECT k, part, page, CASE WHEN EXISTS (FROM again a WHERE a.part = o.part AND a.page = o.page) THEN valid OR k % 3 = 0 ELSE valid END AS valid FROM o")
def retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return J.retried(records, _again(records)[1].select(*records.columns)).select("k", "part", "page", "valid")


@query(_ORDERS + """, t AS (SELECT part, count(*) AS pages FROM again GROUP BY part),
b AS (SELECT part, count(*) FILTER (valid) AS valid_before, count(*) FILTER (kind = 'clip') AS clip_skipped FROM o GROUP BY part),
d AS (SELECT part, count(*) FILTER (valid AND k % 4 = 1) AS valid_delta FROM later GROUP BY part),
r AS (SELECT part, pages, valid_before, valid_before + valid_delta AS valid_after, valid_delta, clip_skipped FROM t JOIN b USING (part) JOIN d USING (part))
SELECT * FROM r UNION ALL SELECT NULL, sum(pages)::BIGINT, sum(valid_before)::BIGINT, sum(valid_after)::BIGINT, sum(valid_delta)::BIGINT, sum(clip_skipped)::BIGINT FROM r""")
def retry_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    pages, again = _again(records)
    return J.retry_report(records, J.retried(records, again.select(*records.columns)), pages)


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 1 THEN o_custkey % 2 = 0 ELSE true END AS valid FROM orders")
def replaced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir).select("k", "valid", "part")
    second = records.filter(~F.col("valid")).withColumn("valid", F.col("part") % 2 == 0)
    return J.replaced_records(records, second, "k").select("k", "valid")


@query("""WITH c AS (SELECT c_custkey AS k FROM customer)
SELECT k, CASE WHEN k % 3 = 0 THEN 'KEPT' WHEN k % 2 = 0 THEN 'B' || k ELSE 'C' || k END AS "houseNo", CASE WHEN k % 4 = 0 THEN 99 WHEN k % 5 = 0 THEN 41 ELSE 20 + k % 50 END::BIGINT AS age, CASE WHEN k % 5 = 0 THEN 'Female' ELSE 'Male' END AS gender FROM c""")
def refill_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ranked texts per card: the first one that a rule can read fills the field."""
    k = F.col("c_custkey")
    cards = table(spark, sf_dir, "customer").select(k.alias("k"), F.lit(None).cast("string").alias("epic"), F.when(k % 3 == 0, "KEPT").alias("houseNo"), F.when(k % 4 == 0, 99).cast("long").alias("age"), F.lit(None).cast("string").alias("gender"))
    text = lambda band, rank, value: table(spark, sf_dir, "customer").select(k.alias("k"), F.lit(band).alias("band"), F.lit(rank).alias("rank"), value.alias("text"))
    tried = [
        text("houseNo", 1, F.when(k % 2 == 0, F.concat(F.lit("House Number : B"), k))), text("houseNo", 2, F.concat(F.lit("House Number : C"), k)),
        text("age", 1, F.when(k % 5 == 0, F.lit("Age : 41 Gender : Female"))), text("age", 2, F.concat(F.lit("Age : "), 20 + k % 50, F.lit(" Gender : Male"))), text("epic", 1, F.lit("nothing")),
    ]
    candidates = tried[0]
    for more in tried[1:]:
        candidates = candidates.unionByName(more)
    return J.filled_by_rank(cards, candidates, "k").select("k", "houseNo", "age", "gender")


@query("""SELECT 'Nation_' || s_nationkey AS folder, s_suppkey AS part, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS valid FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0""")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Nation_"), "s_nationkey").alias("folder"), F.col("s_suppkey").alias("part"))
    old = rows.filter("part % 2 = 0").withColumn("valid", F.lit(1))
    found = rows.withColumns({"valid": F.lit(2), "ok": F.when(F.col("part") % 3 == 0, True).when(F.col("part") % 3 == 1, False)})
    return J.ledger_upsert(old, found.unionByName(found.filter("ok").withColumn("folder", F.lit(None).cast("string"))), ["folder", "part"])


@query("""WITH p AS (SELECT user_id, event_type, count(*) AS n, count(*) FILTER (value > 50) AS v, round(sum(value), 2) AS s FROM events GROUP BY ALL)
SELECT user_id, count(*) AS pages, sum(n)::BIGINT AS extracted, sum(v)::BIGINT AS valid, sum(n % 3)::BIGINT AS missing_epic, sum(n % 4)::BIGINT AS missing_age, sum(n % 5)::BIGINT AS missing_house, round(sum(s), 2) AS seconds FROM p GROUP BY user_id""")
def page_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("extracted"), F.count_if(F.col("value") > 50).alias("valid"), F.round(F.sum("value"), 2).alias("seconds"))
    pages = pages.withColumns({f"missing_{n}": F.col("extracted") % m for n, m in (("epic", 3), ("age", 4), ("house", 5))})
    return J.page_report(pages, "user_id").withColumn("seconds", F.round("seconds", 2))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'Far East / 7 Elm / part ' || s_suppkey WHEN s_suppkey % 3 = 1 THEN 'Elm / part 4' ELSE 'Elm' END AS label FROM supplier""")
def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(k, F.when(k % 3 == 0, F.concat(F.lit("Far_East/7_Elm/part_"), k, F.lit(".pdf"))).otherwise("part_4.pdf").alias("sourcePdf"), F.lit("Elm").alias("constituency"), F.when(k % 3 == 1, 4).alias("partNo"))
    return rows.select("s_suppkey", J.part_label().alias("label"))


@query("SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS name FROM customer")
def shown_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), "c_custkey")
    return J.shown(J.existing(rows, ("c_custkey", "epic", "name")))


@query("""SELECT c_custkey, 'Anu' AS name, 'Father' AS "relationType", 'Ravi' AS "relativeName", '12-' || c_custkey AS "houseNo", (20 + c_custkey % 60)::BIGINT AS age, 'Male' AS gender FROM customer""")
def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.concat_ws("\n", F.lit("Name : Anu"), F.lit("Father Name: Ravi"), F.concat(F.lit("House Number : 12-"), k), F.concat(F.lit("Age : "), 20 + k % 60, F.lit(" Gender : Male")))
    return table(spark, sf_dir, "customer").select("c_custkey", J.labelled_text(text).alias("f")).select("c_custkey", "f.*")


@query("""SELECT s_suppkey, (s_suppkey % 200)::BIGINT AS "partNo", 3::BIGINT AS page, 31::BIGINT AS "totalPages" FROM supplier""")
def header_and_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = lambda *texts: F.array(*[F.struct(t.alias("text")) for t in texts])
    blob = J.page_blob(tokens(F.lit("Part No. :"), (F.col("s_suppkey") % 200).cast("string")), tokens(F.lit("Total Pages 31"), F.lit("- Page 3")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", R.page_header(blob, F.lit(1)).alias("h")).select("s_suppkey", "h.partNo", "h.page", "h.totalPages")


@query("""SELECT s_nationkey AS "asmblyNo", s_suppkey AS "partNo" FROM supplier s WHERE s_nationkey % 3 <> 2 OR (SELECT count(DISTINCT o.s_suppkey % 2) FROM supplier o WHERE o.s_nationkey = s.s_nationkey) = 1""")
def downloads_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders named as asked (0), by another name but the only one of their number (1), and two of one number (2: none is taken, unless there is one after all)."""
    n = F.col("s_nationkey")
    name = F.when(n % 3 == 0, "Elm_Town").when(n % 3 == 1, "Old_Elm").otherwise(F.concat(F.lit("Elm"), F.col("s_suppkey") % 2))
    found = table(spark, sf_dir, "supplier").select(F.concat(F.lit("/d/Far_East/"), n, F.lit("_"), name, F.lit("/part_"), F.col("s_suppkey"), F.lit(".pdf")).alias("path"))
    asked = table(spark, sf_dir, "nation").select(F.lit("Far East").alias("districtFolder"), F.col("n_nationkey").alias("asmblyNo"), F.lit("Elm Town").alias("name"))
    return files.downloads_of(found, asked).select(F.col("asmblyNo").cast("int").alias("asmblyNo"), "partNo")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '/a/x/page' || c_custkey || '.png' WHEN c_custkey % 4 = 1 THEN '/b/page' || c_custkey || '.png' END AS "cropFile" FROM customer""")
def crop_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    listed = table(spark, sf_dir, "customer").filter(k % 4 < 2).select(F.concat(F.when(k % 4 == 0, "file:///a/x/page").otherwise("/b/page"), k, F.lit(".png")).alias("path"))
    records = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("/a/x/page"), k, F.lit(".png")).alias("cropPath"))
    return files.crop_files(records, listed).select("c_custkey", "cropFile")


@query("SELECT c_name AS name, c_custkey AS \"serialNo\", 'part_1.pdf' AS \"sourcePdf\" FROM customer WHERE c_custkey % 2 = 0")
def imported_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with rows stays as it is; an empty one takes the import."""
    from cardloom.operators.store import conformed

    half = lambda r: conformed(table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == r).select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("serialNo"), F.lit("part_1.pdf").alias("sourcePdf")))
    once = J.imported_once(half(0).limit(0), half(0))
    return J.imported_once(once, half(1)).select("name", "serialNo", "sourcePdf")


@query("SELECT o_orderkey AS k, nullif(o_orderkey % 3, 0) IS NULL OR o_orderkey % 5 = 0 AS needs, nullif(o_orderkey % 7, 0) IS NOT NULL OR o_orderkey % 2 = 0 AS held FROM orders")
def needs_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    row = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 3 != 0, "e").alias("epic"), F.when(k % 5 != 0, "h").alias("houseNo"), *[F.lit("x").alias(c) for c in ("age", "gender", "relationType", "relativeName", "name")])
    cells = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 7 != 0, "e").alias("epic"), F.when(k % 2 == 0, "n").alias("name")).select("k", R.not_empty_cell().alias("held"))
    return row.select("k", R.needs_fill().alias("needs")).join(cells, "k")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE '2' END AS "houseNo", CASE WHEN c_custkey % 2 = 0 THEN 30 ELSE 40 END::BIGINT AS age, 'Male' AS gender FROM customer""")
def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", *[none.alias(f"{p}{c}") for p in ("a", "b") for c in ("name", "relativeName", "relationType")], F.when(k % 3 == 0, "1").alias("ahouseNo"), F.lit("2").alias("bhouseNo"),
        F.when(k % 2 == 0, 30).cast("long").alias("aage"), F.lit(40).cast("long").alias("bage"), none.alias("agender"), F.lit("Male").alias("bgender"),
    )
    return rows.select("c_custkey", *R.merged_record("a", "b")).select("c_custkey", "houseNo", "age", "gender")


@query("""WITH r AS (SELECT o_custkey AS doc, count(*) AS extracted, count(*) FILTER (o_orderkey % 10 <> 3) AS valid FROM orders GROUP BY ALL),
t AS (SELECT doc, count(*) FILTER (bad) AS failed FROM (SELECT o_custkey AS doc, o_orderkey % 9 AS page, bool_or(o_orderkey % 40 = 7) AS bad FROM orders GROUP BY ALL) GROUP BY doc),
x AS (SELECT c_custkey AS doc, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 30 END::BIGINT AS expected FROM customer),
j AS (SELECT coalesce(x.doc, r.doc) AS doc, coalesce(extracted, 0) AS extracted, coalesce(valid, 0) AS valid, expected, coalesce(failed, 0) AS failed FROM x FULL JOIN r ON x.doc = r.doc LEFT JOIN t ON t.doc = r.doc)
SELECT doc, extracted AS "extractedTotal", valid AS "validCount", expected AS "expectedTotal", failed AS failed_pages,
  valid > 0 AND extracted > 0 AND failed = 0 AND valid >= CASE WHEN coalesce(expected, 0) > 0 THEN expected * 9 // 10 ELSE greatest(1, extracted * 9 // 10) END AS ok FROM j""")
def part_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, orders = F.col("o_orderkey"), table(spark, sf_dir, "orders")
    records = orders.select(F.col("o_custkey").alias("doc"), (k % 10 != 3).alias("valid"))
    tokens = orders.select(F.col("o_custkey").alias("doc"), (k % 9).alias("page"), F.when(k % 40 == 7, "failed").alias("error"))
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 30).alias("expectedTotal"))
    return J.part_outcomes(records, tokens, expected)
