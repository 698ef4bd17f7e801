"""Record queries: card lines are written from known columns, with noise, and parsed back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.operators import records as R
from cardloom.plans.registry import dealt, query, table


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey and the known values of a card."""
    k = F.col("c_custkey")
    letters = F.translate(F.lpad((k % 1000).cast("string"), 3, "0"), "0123456789", "ABCDEFGHIJ")
    return dealt(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").select(
        "c_custkey", (k % 900 + 1).alias("serialNo"), F.concat(letters, F.lpad((k * 7919 % 10000000).cast("string"), 7, "0")).alias("epic"),
        F.concat(F.lit("Anu "), F.initcap(F.translate("c_mktsegment", "_", " "))).alias("name"), F.element_at(F.array(*map(F.lit, ("Father", "Mother", "Husband", "Wife"))), (k % 4 + 1).cast("int")).alias("relationType"),
        F.concat(F.lit("Ravi "), F.initcap("c_mktsegment")).alias("relativeName"), F.concat_ws("-", (k % 90 + 1).cast("string"), (k % 7).cast("string")).alias("houseNo"), (k % 80 + 18).alias("age"), F.when(k % 2 == 0, "Male").otherwise("Female").alias("gender"),
    )


_PEOPLE = """WITH p AS (SELECT c_custkey, c_custkey % 900 + 1 AS "serialNo", translate(lpad((c_custkey % 1000)::VARCHAR, 3, '0'), '0123456789', 'ABCDEFGHIJ') || lpad((c_custkey * 7919 % 10000000)::VARCHAR, 7, '0') AS epic,
  'Anu ' || upper(c_mktsegment[1]) || lower(substr(c_mktsegment, 2)) AS name, ['Father', 'Mother', 'Husband', 'Wife'][(c_custkey % 4 + 1)::INT] AS "relationType", 'Ravi ' || upper(c_mktsegment[1]) || lower(substr(c_mktsegment, 2)) AS "relativeName",
  (c_custkey % 90 + 1) || '-' || (c_custkey % 7) AS "houseNo", c_custkey % 80 + 18 AS age, CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender FROM customer) """


def _lines(noise: bool = True):
    """The lines of a card: labels by number of the card, some misread, some in capitals, some broken over two lines."""
    k, c = F.col("c_custkey"), F.col
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (k % len(xs) + 1).cast("int"))
    upper = lambda x: F.when(k % 3 == 0, F.upper(x)).otherwise(x)
    first, second = F.split(c("name"), " ")[0], F.split(c("name"), " ")[1]
    relation = F.concat(c("relationType"), pick("s Name: ", "'s Name :", "s Name -"), upper(c("relativeName")))
    return F.array_compact(F.array(
        F.concat(c("serialNo").cast("string"), F.lit(" "), c("epic")),
        F.when(k % 5 == 0, F.concat(F.lit("Name : "), upper(first))).otherwise(F.concat(F.lit("Name : "), upper(c("name")))),
        F.when(k % 5 == 0, upper(second)), relation, F.when(k % 11 == 0, F.lit("12")), F.lit("Photo"),
        F.concat(pick("House Number : ", "Houae Number : ", "H.No "), c("houseNo")),
        F.concat(pick("Age : ", "Aae: ", "A ge :"), c("age").cast("string"), pick(" Gender : ", " Cender : ", " Gondor • "), F.when(c("gender") == "Male", pick("Male", "Mele", "Molo")).otherwise(pick("Female", "Femcle", "Eomolo"))),
    ))


@query(_PEOPLE + 'SELECT c_custkey, name, "relationType", "relativeName", "houseNo", age, gender FROM p')
def label_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _people(spark, sf_dir).select("c_custkey", _lines().alias("lines"))
    return lines.select("c_custkey", R.labelled_fields(F.col("lines")).alias("f")).select("c_custkey", "f.*")


@query(_PEOPLE + 'SELECT c_custkey, "serialNo", epic, name, "relationType", "relativeName", "houseNo", age, gender, 0.99::DOUBLE AS confidence FROM p')
def parse_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    def token(text, n):
        x, y = (n % 2 * 0 + 10).cast("double"), (n * 28 + 8).cast("double")
        return F.struct(text.alias("text"), F.lit(0.99).alias("confidence"), F.array(F.array(x, y), F.array(x + 40, y), F.array(x + 40, y + 12), F.array(x, y + 12)).alias("bbox"))

    cards = _people(spark, sf_dir).select("c_custkey", F.lit(700.0).alias("width"), F.lit(280.0).alias("height"), F.transform(_lines(), token).alias("tokens"))
    out = R.parsed_cards(cards)
    return out.select("c_custkey", "serialNo", "epic", "name", "relationType", "relativeName", "houseNo", "age", "gender", F.round("confidence", 4).alias("confidence"))


@query(_PEOPLE + "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE epic END AS epic FROM p")
def epic_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, e = F.col("c_custkey"), F.col("epic")
    swapped = F.concat(F.translate(F.substring(e, 1, 3), "OI", "01"), F.translate(F.substring(e, 4, 7), "01", "OI"))
    raw = F.when(k % 7 == 0, F.substring(e, 1, 8)).when(k % 3 == 0, swapped).when(k % 3 == 1, F.concat(F.lit("12 - "), F.lower(e), F.lit("/x"))).otherwise(F.concat_ws(" ", F.substring(e, 1, 3), F.substring(e, 4, 7)))
    return _people(spark, sf_dir).select("c_custkey", X.identifier(raw).alias("epic"))


@query(_PEOPLE + "SELECT c_custkey, age FROM p")
def age_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    label = F.element_at(F.array(*map(F.lit, ("Age : ", "Aae: ", "Ace:", "A.ae :", "Aqe - "))), (k % 5 + 1).cast("int"))
    return _people(spark, sf_dir).select("c_custkey", X.age(F.concat(label, F.translate(F.col("age").cast("string"), "01", "Ol"))).alias("age"))


@query(_PEOPLE + "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'Others' ELSE gender END AS gender FROM p")
def gender_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (k % len(xs) + 1).cast("int"))
    value = F.when(k % 9 == 0, pick("Other", "Third Gender")).when(F.col("gender") == "Male", pick("Male", "Mele", "Molo")).otherwise(pick("Female", "Femele", "Femcle", "Femole", "Eomolo", "Femaie"))
    return _people(spark, sf_dir).select("c_custkey", X.gender(F.concat(pick("Gender : ", "Cender", "Condor :"), F.lit(" "), value)).alias("gender"))


@query(_PEOPLE + """SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN 'H NO ' || "houseNo" ELSE "houseNo" END AS house FROM p""")
def house_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, h = F.col("c_custkey") % 6, F.col("houseNo")
    line = (
        F.when(k == 0, "House Number :").when(k == 1, F.concat(F.lit("House Number : H NO "), h, F.lit(" A ao : 22 Condor"))).when(k == 2, F.concat(F.lit("Houae Numbe - "), h, F.lit(" Aao :41 Condor :Molo")))
        .when(k == 3, F.concat(F.lit("H.No. "), h)).when(k == 4, F.concat(F.lit("House Number : "), h, F.lit(" Age : 33"))).otherwise(F.concat(F.lit(" "), h, F.lit(" ")))
    )
    return _people(spark, sf_dir).select("c_custkey", X.house(line).alias("house"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(substr(w, 2))), ' ') ELSE p_name END AS name FROM part")
def title_if_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", X.person(F.concat(F.lit(": "), F.regexp_replace(raw, " ", "   "), F.lit(" -"))).alias("name"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' x' WHEN p_partkey % 3 = 1 THEN p_name ELSE p_name END AS name FROM part""")
def prefer_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey") % 3, F.col("p_name")
    new = F.when(k == 0, F.concat(F.upper(F.substring(n, 1, 0)), n, F.lit(" x"))).when(k == 1, F.lit("quite another, and longer, name"))
    return table(spark, sf_dir, "part").select("p_partkey", X.preferred_person(F.concat(n, F.lit(" 17")), new).alias("name"))


@query("""
WITH l AS (SELECT l_orderkey, list(l_quantity::BIGINT ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) AS q FROM lineitem GROUP BY ALL)
SELECT l_orderkey, CASE WHEN len(q) >= 4 THEN q[-4] END AS male, CASE WHEN len(q) >= 4 THEN q[-3] END AS female, CASE WHEN len(q) >= 4 THEN q[-2] END AS others, CASE WHEN len(q) >= 4 THEN q[-1] END AS total FROM l""")
def tail_four(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(order)).alias("o"))
    texts = F.flatten(F.transform("o", lambda x: F.array(F.lit("Total"), x["l_quantity"].cast("long").cast("string"))))
    return rows.select("l_orderkey", R.cover_totals(texts).alias("t")).select("l_orderkey", "t.male", "t.female", "t.others", "t.total")


@query("""SELECT n_nationkey, n_nationkey::BIGINT AS "constituencyNo", 'Nation ' || n_nationkey AS constituency, (n_nationkey + 5)::BIGINT AS "partNo", (n_nationkey % 4)::BIGINT AS "sectionNo", 'Main Road' AS section, 31::BIGINT AS "totalPages", (n_nationkey % 9)::BIGINT AS page, '01-01-2024' AS "qualifyingDate", CASE WHEN n_nationkey % 2 = 0 THEN '05-02-2024' END AS "publicationDate" FROM nation""")
def page_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    s = lambda x: x.cast("string")
    blob = F.concat(
        F.lit("Assembly Constituency No and Name : "), s(n), F.lit("-NATION "), s(n), F.lit(" Part No. : "), s(n + 5), F.lit(" Section No and Name "), s(n % 4), F.lit(" - Main Road 12 ABC1234567 x Age as on 01-01-2024"),
        F.when(n % 2 == 0, F.lit(" Date of Publication - 05-02-2024")).otherwise(""), F.lit(" Total Pages 31 - Page "), s(n % 9),
    )
    return table(spark, sf_dir, "nation").select("n_nationkey", R.page_header(blob, F.lit(1)).alias("h")).select("n_nationkey", "h.*")


_BAD = _PEOPLE + """, b AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN 'AB1' ELSE epic END AS epic, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 12 ELSE age END AS age,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN 'Unknown' ELSE gender END AS gender, nullif(c_custkey % 13, 0) AS name, nullif(c_custkey % 17, 0) AS serial, CASE WHEN c_custkey % 19 = 0 THEN 'Uncle' ELSE "relationType" END AS relation FROM p),
v AS (SELECT c_custkey, list_filter([CASE WHEN epic IS NULL THEN 'missing_epic' WHEN NOT regexp_full_match(epic, '[A-Z]{3}[0-9]{7}') THEN 'invalid_epic' END, CASE WHEN age IS NULL THEN 'missing_age' WHEN age NOT BETWEEN 18 AND 120 THEN 'invalid_age' END,
  CASE WHEN gender IS NULL THEN 'missing_gender' WHEN gender NOT IN ('Male', 'Female', 'Others') THEN 'invalid_gender' END, CASE WHEN name IS NULL THEN 'missing_name' END, CASE WHEN serial IS NULL THEN 'missing_serial' END,
  CASE WHEN relation NOT IN ('Father', 'Mother', 'Husband', 'Wife', 'Other') THEN 'invalid_relation' END], lambda e: e IS NOT NULL) AS errors FROM b) """


def _bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("c_custkey"), F.col
    rows = _people(spark, sf_dir).withColumns({
        "epic": F.when(k % 7 == 0, None).when(k % 7 == 1, "AB1").otherwise(c("epic")), "age": F.when(k % 5 == 0, None).when(k % 5 == 1, 12).otherwise(c("age")),
        "gender": F.when(k % 11 == 0, None).when(k % 11 == 1, "Unknown").otherwise(c("gender")), "name": F.when(k % 13 != 0, c("name")), "serialNo": F.when(k % 17 != 0, c("serialNo")),
        "relationType": F.when(k % 19 == 0, "Uncle").otherwise(c("relationType")),
    })
    return R.validated(rows)


@query(_BAD + "SELECT c_custkey, array_to_string(errors, ',') AS errors, len(errors) = 0 AS valid, list_sort(list_distinct(errors)) = ['missing_age', 'missing_gender'] AS clip_only FROM v")
def validate_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bad(spark, sf_dir).select("c_custkey", F.array_join("errors", ",").alias("errors"), "valid", R.clip_only().alias("clip_only"))


@query(_BAD + "SELECT error, count(*) AS records FROM (SELECT unnest(errors) AS error FROM v) GROUP BY ALL")
def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bad(spark, sf_dir).select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("records"))


@query(_PEOPLE + """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN epic ELSE 'ABC0000001' END AS epic, CASE WHEN c_custkey % 3 = 0 THEN "houseNo" ELSE '9' END AS "houseNo", CASE WHEN c_custkey % 4 = 0 THEN age ELSE 51 END AS age, CASE WHEN c_custkey % 5 = 0 THEN gender ELSE 'Female' END AS gender,
  'top' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '|ABC OOOOOO1' END || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '|House Number : 9' END || CASE WHEN c_custkey % 20 = 0 THEN '' ELSE '|Age : 51 Gender : Female' END AS raw FROM p""")
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("c_custkey"), F.col
    rows = _people(spark, sf_dir).withColumns({
        "epic": F.when(k % 2 == 0, c("epic")), "houseNo": F.when(k % 3 == 0, c("houseNo")), "age": F.when(k % 4 == 0, c("age")), "gender": F.when(k % 5 == 0, c("gender")),
        "raw": F.array(F.lit("top")), "house_text": F.lit("House Number : 9"), "age_text": F.lit("Age : 51 Gender : Female"), "epic_text": F.lit("ABC OOOOOO1"),
    })
    return R.filled(rows).select("c_custkey", "epic", "houseNo", "age", "gender", F.array_join("raw", "|").alias("raw"))


@query("SELECT p_partkey, 'a|' || p_name || CASE WHEN p_partkey % 2 = 0 THEN '|b|b' ELSE '' END AS raw FROM part")
def merge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("b"), F.lit("a"), F.lit(""), F.lit("b"))).otherwise(F.array(F.col("p_name")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(R.merged_lines(F.array(F.lit("a"), F.col("p_name")), extra), "|").alias("raw"))


@query("SELECT o_custkey, coalesce(min(o_orderkey) FILTER (o_orderstatus = 'F'), max(o_orderkey)) AS o_orderkey FROM orders GROUP BY ALL")
def best_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderstatus") == "F").alias("valid"), F.col("o_orderkey").alias("rank"))
    return R.best_reading(rows, "o_custkey").select("o_custkey", "o_orderkey")
