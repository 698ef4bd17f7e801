"""Scan, coercion, registry and ledger queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.operators import quality as Q
from cardloom.operators import store as R
from cardloom.plans.registry import query, table
from cardloom.sources.staging import new_folder, shared_root


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN 'x' || event_id WHEN event_id % 5 = 2 THEN ' ' || event_id || ' ' WHEN event_id % 5 = 3 THEN event_id || '.0' ELSE event_id::VARCHAR END AS raw FROM events)
SELECT event_id, CASE WHEN regexp_matches(raw, '^\\s*[+-]?\\d+\\s*$') THEN try_cast(raw AS BIGINT) END AS number, nullif(raw, '') AS text FROM e""")
def coerce_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, e = F.pmod("event_id", F.lit(5)), F.col("event_id").cast("string")
    raw = F.when(k == 0, "").when(k == 1, F.concat(F.lit("x"), e)).when(k == 2, F.concat(F.lit(" "), e, F.lit(" "))).when(k == 3, F.concat(e, F.lit(".0"))).otherwise(e)
    return table(spark, sf_dir, "events").select("event_id", X.as_integer(raw).alias("number"), X.as_text(raw).alias("text"))


@query("SELECT event_id, event_type, (props->>'$.k')::BIGINT AS k FROM events")
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT event_id, '{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}' AS json FROM events")
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("json"))


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey % 10 <> 3
UNION ALL SELECT o_orderkey + 1000000, o_custkey, o_totalprice + 1 FROM orders WHERE o_custkey % 10 = 3 AND o_custkey % 20 <> 3""")
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    keys = old.filter(F.col("o_custkey") % 10 == 3).select("o_custkey")
    new = old.filter((F.col("o_custkey") % 10 == 3) & (F.col("o_custkey") % 20 != 3)).select((F.col("o_orderkey") + 1000000).alias("o_orderkey"), "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return R.replaced(old, new, keys, "o_custkey")


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 3 = 0
UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 2 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 3 = 0)""")
def append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    old = orders.filter(F.col("o_custkey") % 3 == 0)
    return R.appended_once(old, orders.filter(F.col("o_custkey") % 2 == 0), old, "o_custkey")


@query("""
WITH bad AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice < 20000)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (FROM bad)
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice * 2 FROM orders WHERE o_custkey IN (FROM bad)""")
def replace_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    pages = rows.filter("o_totalprice < 20000").select("o_custkey").distinct()
    again = rows.join(pages, "o_custkey", "left_semi").withColumn("o_totalprice", F.col("o_totalprice") * 2).select("o_orderkey", "o_custkey", "o_totalprice")
    return R.replaced_pages(rows, again, pages, "o_custkey")


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_diagonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return R.diagonal(a, b)


@query("SELECT NULL::BIGINT AS \"serialNo\", NULL::VARCHAR AS epic, nullif(c_name, '') AS name, c_nationkey::BIGINT AS \"partNo\", CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'p' || c_custkey END AS \"sourcePdf\" FROM customer")
def conform_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(F.pmod("c_custkey", F.lit(3)) != 0, F.concat(F.lit("p"), "c_custkey"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("partNo"), source.alias("sourcePdf"))
    return R.conformed(rows).select("serialNo", "epic", "name", "partNo", "sourcePdf")


@query("""SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderkey % 7, 0) IS NULL, coalesce(nullif(o_orderkey % 7, 0), 0), year(o_orderdate), o_orderkey) AS place FROM orders""")
def record_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.nullif(F.col("o_orderkey") % 7, F.lit(0)).alias("serialNo"), F.year("o_orderdate").alias("page"))
    return rows.select("o_orderkey", "o_custkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*R.record_order("serialNo", "page", "o_orderkey"))).cast("long").alias("place"))


@query("""
SELECT count(*) FILTER (k IS NOT NULL AND k % 2 = 1) AS added, count(*) FILTER (k IS NOT NULL AND k % 2 = 0) AS updated, count(*) FILTER (k IS NULL) AS skipped FROM (SELECT nullif(s_suppkey % 5, 0) * 0 + s_suppkey AS k FROM supplier)""")
def ledger_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 5 != 0, F.col("s_suppkey")).alias("k"))
    return R.ledger_changes(rows.filter(F.col("k") % 2 == 0), rows, ["k"])


@query("SELECT user_id, arg_min(CASE WHEN event_type = 'purchase' THEN value END, ts) FILTER (event_type = 'purchase') AS purchase, arg_min(value, ts) FILTER (value > 50) AS large FROM events GROUP BY user_id")
def merge_first_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.operators.coverage import first_known

    rows = table(spark, sf_dir, "events").withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value"))).withColumn("v", F.when(F.col("value") > 50, F.col("value")))
    return rows.groupBy("user_id").agg(first_known("p", "ts").alias("purchase"), first_known("v", "ts").alias("large"))


@query("""
WITH o AS (SELECT o_custkey, o_orderstatus = 'F' AS valid, nullif(o_custkey % 3, 0) AS a, nullif(o_orderkey % 4, 0) AS b FROM orders)
SELECT o_custkey, count(*) AS extracted, count(*) FILTER (valid) AS valid, count(*) FILTER (a IS NULL) AS missing_age, count(*) FILTER (b IS NULL) AS missing_house FROM o GROUP BY ALL""")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(*Q.summary(F.col("o_orderstatus") == "F", age=F.nullif(F.col("o_custkey") % 3, F.lit(0)), house=F.nullif(F.col("o_orderkey") % 4, F.lit(0))))


@query("""
SELECT o_orderpriority, count(*) FILTER (o_orderkey % 3 = 0 AND o_custkey % 2 <> 0) AS house_filled, count(*) FILTER (o_orderkey % 5 = 0 AND o_custkey % 3 <> 0) AS age_filled FROM orders GROUP BY ALL""")
def fill_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = lambda c, k: F.nullif(F.col(c) % k, F.lit(0))
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        Q.fill_delta(null("o_orderkey", 3), F.coalesce(null("o_orderkey", 3), null("o_custkey", 2))).alias("house_filled"),
        Q.fill_delta(null("o_orderkey", 5), F.coalesce(null("o_orderkey", 5), null("o_custkey", 3))).alias("age_filled"),
    )


@query("""
WITH c AS (SELECT o_custkey, count(*) FILTER (o_orderstatus <> 'P') AS valid, count(*) AS extracted, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey % 12 END AS expected FROM orders GROUP BY o_custkey)
SELECT o_custkey, valid > 0 AND extracted > 0 AND valid >= CASE WHEN expected > 0 THEN expected * 9 // 10 ELSE greatest(1, extracted * 9 // 10) END AS ok FROM c""")
def success_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") != "P").alias("valid"), F.count("*").alias("extracted"))
    expected = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 12)
    return c.select("o_custkey", Q.successful(F.col("valid"), F.col("extracted"), expected).alias("ok"))


@query("""
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'P') AS attempted, count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 3 = 0) AS fixed, count(*) FILTER (o_orderstatus <> 'P') AS valid_before,
  count(*) FILTER (o_orderstatus <> 'P' OR o_orderkey % 3 = 0) AS valid_after, count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 3 = 0) AS valid_delta FROM orders GROUP BY ALL""")
def retry_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.col("o_orderstatus") != "P"
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(*Q.retry_effect(before, before | (F.col("o_orderkey") % 3 == 0)))


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS rows_, count(*) FILTER (l_returnflag = 'R') AS bad FROM lineitem GROUP BY ALL)
SELECT o_orderkey, coalesce(greatest(0, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 9 - o_orderkey % 5 END), bad, CASE WHEN o_custkey % 2 = 0 THEN 4 END, 0) AS invalid
FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def invalid_count_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_if(F.col("l_returnflag") == "R").alias("bad"))
    rows = table(spark, sf_dir, "orders").join(bad, "o_orderkey", "left")
    extracted = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 9)
    return rows.select("o_orderkey", Q.invalid_count(extracted, F.col("o_orderkey") % 5, F.col("bad"), F.when(F.col("o_custkey") % 2 == 0, F.lit(4))).alias("invalid"))


@query("""
WITH s AS (SELECT event_type AS phase, round(sum(value), 2) AS seconds, count(*) AS n FROM events GROUP BY ALL)
SELECT phase, seconds, n, round(100 * seconds / sum(seconds) OVER (), 1) AS pct, row_number() OVER (ORDER BY seconds DESC, phase) AS rank FROM s""")
def phase_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = table(spark, sf_dir, "events").select(F.col("event_type").alias("phase"), F.col("value").alias("seconds"), F.lit(1).alias("count"))
    out = Q.phase_profile(cents)
    return out.select("phase", F.round("seconds", 2).alias("seconds"), F.col("count").alias("n"), "pct", F.col("rank").cast("long").alias("rank"))


@query("""
SELECT user_id, count(*) FILTER (event_type = 'view') AS card, count(*) FILTER (event_type = 'click') AS row_, round(count(*) FILTER (event_type = 'view')::DOUBLE / nullif(count(*) FILTER (event_type = 'click'), 0), 4) AS ratio FROM events GROUP BY user_id""")
def mode_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    card, row = F.count_if(F.col("event_type") == "view"), F.count_if(F.col("event_type") == "click")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(card.alias("card"), row.alias("row_"), F.round(F.try_divide(card, row), 4).alias("ratio"))


@query("SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderkey % 40)), ',') AS pages FROM orders WHERE o_totalprice < 90000 GROUP BY ALL")
def invalid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = table(spark, sf_dir, "orders").filter("o_totalprice < 90000").withColumn("page", F.col("o_orderkey") % 40)
    return bad.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("page")).cast("array<string>"), ",").alias("pages"))


@query("""WITH e AS (SELECT *, event_id % 3 = 0 AND user_id % 4 <> 1 AS late FROM events), k AS (SELECT user_id, bool_or(late) AS again FROM e GROUP BY user_id)
SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM e JOIN k USING (user_id) WHERE late = again GROUP BY user_id""")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one table: what the second one holds of a user replaces what the first one left, also where it is older.
    The second one starts without the first one's checkpoint, so its batches count from 0 again."""
    from cardloom.streaming.ingest import ingest

    at = f"{shared_root(spark)}/ingest-{spark.sparkContext.applicationId}-{spark._jvm.System.nanoTime()}"
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/events.parque[t]").select("user_id", "event_id", "event_type", "value")
    late = F.expr("event_id % 3 = 0 and user_id % 4 <> 1")
    ingest(stream.filter(~late), f"{at}/table", f"{at}/log1", "user_id", ["event_id"])
    return ingest(stream.filter(late), f"{at}/table", f"{at}/log2", "user_id", ["event_id"])


@query("""WITH e AS (SELECT user_id % 50 AS part, event_id, round(value)::BIGINT AS v FROM events WHERE event_type <> 'view' AND event_id % 11 <> 0)
SELECT part AS "partNo", v AS "validCount", event_id AS "readAt" FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY event_id DESC) AS n FROM e) WHERE n = 1""")
def streaming_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as outcomes of parts in two streams, the later half of them first; the second run goes on from the first one's checkpoint
    with outcomes that are older, and so change only parts that had none."""
    from cardloom.streaming import ledger

    at, k = new_folder(spark, "ledger"), F.col("event_id")
    schema = table(spark, sf_dir, "events").schema
    value = F.round("value").cast("long")

    def outcomes(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit("D").alias("districtFolder"), F.lit(1).alias("asmblyNo"), F.when(k % 11 != 0, F.col("user_id") % 50).alias("partNo"), value.alias("validCount"), value.alias("extractedTotal"), F.lit(None).cast("long").alias("expectedTotal"), k.alias("readAt"), (F.col("event_type") != "view").alias("ok"))

    events = table(spark, sf_dir, "events")
    half = events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    events.filter(k > half).write.mode("append").parquet(f"{at}/in")
    stream = outcomes(spark.readStream.schema(schema).parquet(f"{at}/in"))
    ledger.run(stream, f"{at}/table", f"{at}/log")
    events.filter(k <= half).write.mode("append").parquet(f"{at}/in")
    return ledger.run(stream, f"{at}/table", f"{at}/log").select("partNo", "validCount", "readAt")
