"""The thin queries of the operators, with their production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import crc_mod, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.language_id import fit, predict

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(crc_mod("doc_id", 5) != 0))
    return predict(docs, model).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "n_labelled")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_sql() -> str:
    """The same in SQL: units, words, bigrams with their counts, and the best template at or above the threshold."""
    from cardloom.llm.license_scan import TEMPLATES, THRESHOLD

    values = ", ".join(f"({n}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for n, (name, text) in enumerate(TEMPLATES))
    words = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
    return f"""
    WITH lines AS (
      SELECT doc_id, 'line' AS kind, generate_subscripts(p, 1) - 1 AS number, unnest(p) AS unit FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)
    ), parts AS (
      SELECT doc_id, 'paragraph' AS kind, generate_subscripts(p, 1) - 1 AS number, unnest(p) AS unit FROM (SELECT doc_id, string_split_regex(text, '\\n(?:[^\\p{{L}}\\p{{N}}\\n]*\\n)+') AS p FROM documents WHERE text IS NOT NULL)
    ), units AS (
      SELECT doc_id, kind, number, {words.format("unit")} AS w FROM (SELECT * FROM lines UNION ALL SELECT * FROM parts WHERE contains(trim(unit, chr(10)), chr(10)))
    ), sized AS (SELECT row_number() OVER () AS u, *, len(w) - 1 AS n_bigrams FROM units WHERE len(w) >= 2),
    templates AS (SELECT template, license, {words.format("text")} AS w FROM (VALUES {values}) t(template, license, text)),
    own AS (SELECT u, a || ' ' || b AS bigram, count(*) AS k FROM (SELECT u, unnest(w[1:len(w) - 1]) AS a, unnest(w[2:]) AS b FROM sized) GROUP BY ALL),
    held AS (SELECT template, a || ' ' || b AS bigram, count(*) AS k FROM (SELECT template, unnest(w[1:len(w) - 1]) AS a, unnest(w[2:]) AS b FROM templates) GROUP BY ALL),
    shared AS (SELECT u, template, sum(least(own.k, held.k)) AS common FROM own JOIN held USING (bigram) GROUP BY ALL),
    scored AS (
      SELECT doc_id, kind, number, license, template, n_bigrams, common::BIGINT AS common, 2.0::DOUBLE * common / (n_bigrams + len(t.w) - 1) AS dice, u
      FROM shared JOIN sized USING (u) JOIN templates t USING (template)
    )
    SELECT doc_id, kind, number::INT AS number, license, template, n_bigrams, common, dice
    FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY dice DESC, template) AS r FROM scored WHERE dice >= {THRESHOLD} - 1e-9) WHERE r = 1
    """


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.quality_rules import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.ngram_join import ngram_components

    return ngram_components(table(spark, sf_dir, "documents"), 75)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.toxicity import fit, score_texts

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 4) != 2))
    scored = score_texts(docs, model)
    return scored.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_windows", "n_toxic_windows")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: Fixed values of the contract: (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP8_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR NOT contains(url, '://') THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(verdict, rhost, rpath) AS (VALUES ('allow','org','/'), ('block','example.org','/es/'), ('block','example.org','/en/1'), ('allow','com','/fr/'), ('block','com','/de/')
), fits AS (
  SELECT page_id, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY len(string_split(rhost, '.')) DESC, length(rpath) DESC) AS n
  FROM split JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND f.n = 1
"""


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), 24).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.html_extract import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.ranked_search import search_items

    return search_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20).select("item_id", "rank", "doc_id", "score")


OP11_SQL = r"""
WITH worded AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL
), sized AS (SELECT d, doc_id, len(w)::BIGINT AS n, w FROM worded WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS terms FROM sized),
held AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(w) AS term FROM sized) GROUP BY ALL),
frequent AS (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term),
weighed AS (SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM frequent, whole),
lengths AS (SELECT d, doc_id, 100 - 25 + ((25 * n * total) // terms) AS m FROM sized, whole),
items AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), asked AS (SELECT i, item_id, term, count(*)::BIGINT AS times FROM (SELECT i, item_id, unnest(w) AS term FROM items) GROUP BY ALL),
scored AS (
  SELECT i, item_id, doc_id, d, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN lengths USING (d) GROUP BY ALL
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, d) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.token_store import read_digests, write_store

    return read_digests(write_store(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardloom.llm.vector_codes import compressed_vectors, hex_code

    return compressed_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", hex_code("code").alias("code"), "error", "label_error", "codebooks_sha256")


def op13_sql() -> str:
    """The same in SQL: every part against every entry of its codebook, twice to move the entries and once to assign."""
    from cardloom.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

    steps = []
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
      SELECT row, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance FROM (
        SELECT x.row, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v))::BIGINT AS distance FROM parts x JOIN b{n} b USING (part, place) GROUP BY ALL
      ) GROUP BY ALL
    )""")
        if n < ROUNDS:
            steps.append(f"""b{n + 1} AS MATERIALIZED (
      SELECT b.part, b.entry, b.place, coalesce(m.v, b.v) AS v FROM b{n} b LEFT JOIN (
        SELECT part, entry, place, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM a{n} JOIN parts USING (row, part) GROUP BY ALL
      ) m USING (part, entry, place)
    )""")
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, embedding FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), flat AS (SELECT row, generate_subscripts(embedding, 1) - 1 AS i, floor({SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS v, len(embedding) // {PARTS} AS each FROM kept),
    parts AS MATERIALIZED (SELECT row, i // each AS part, i % each AS place, v FROM flat),
    b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, place, v FROM parts WHERE row <= {ENTRIES}),
    {", ".join(steps)},
    coded AS (
      SELECT row, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error FROM a{ROUNDS} GROUP BY row
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
      (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) FROM b{ROUNDS}) AS codebooks_sha256
    FROM kept JOIN coded USING (row)
    """


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_language_id, op2_license_scan, op3_quality_rules, op4_ngram_join, op5_toxicity, op6_decontaminate, op7_packing, op8_url_filter, op9_sharding, op10_html_extract, op11_ranked_search, op12_token_store, op13_vector_codes]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": op2_sql(), "op8_url_filter": OP8_SQL, "op11_ranked_search": OP11_SQL, "op13_vector_codes": op13_sql()}
