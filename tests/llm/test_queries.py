"""The opN queries themselves: columns, folds and what their contracts fix, on the smallest tables."""

from __future__ import annotations

import zlib

import duckdb
import pytest

from cardloom.llm import queries as Q
from tests.llm.test_index_operators import plain_tokens
from tests.llm.test_ngram_join import brute
from tests.llm.test_text_operators import counts

COLUMNS = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op4_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op8_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op9_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op10_html_extract": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op11_ranked_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_token_store": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op13_vector_codes": {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"},
}


def fold(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % k


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, sf, documents, name):
    out = Q.queries()[name](spark, sf)
    kinds = dict(out.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    rows = out.collect()
    if name == "op1_language_id":
        assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows) and len(rows) == len(documents)
        held = [r for r in rows if r.held_out and documents[r.doc_id].lang and r.lang_pred != "und"]
        assert sum(r.lang_pred == documents[r.doc_id].lang for r in held) / len(held) >= 0.97
    elif name == "op3_quality_rules":
        for r in rows:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(documents[r.doc_id].text)
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    elif name == "op4_ngram_join":
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute([(d, r.text) for d, r in documents.items()])
    elif name == "op5_toxicity":
        assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows) and len(rows) == len(documents)
    elif name == "op9_sharding":
        assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24 for r in rows) and len(rows) == len(documents)
        assert all((r["size"], r.text_crc32) == (len((documents[r.doc_id].text or "").encode()) + 8, zlib.crc32((documents[r.doc_id].text or "").encode())) for r in rows)
    elif name == "op10_html_extract":
        assert all(r.n_chars == len(r.text) for r in rows)
    elif name == "op12_token_store":
        want, start = [], 0
        for d, ids in plain_tokens([(d, documents[d].text) for d in sorted(documents)]):
            want.append((d, start, len(ids) // 4, zlib.crc32(ids)))
            start += len(ids) // 4
        assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == want


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = Q.queries()[name](spark, sf)
    columns = sorted(df.columns)
    key = lambda r: tuple(f"{v:.9f}" if isinstance(v, float) else str(v) for v in r)
    assert sorted(key(r) for r in df.select(*columns).collect()) == sorted(key(r) for r in con.sql(Q.oracle_sql()[name]).select(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_every_item_is_found_where_it_stands(spark, sf, documents):
    """Recall over all items of the benchmark, short ones too: what holds an item's words in a row is found without an error."""
    from cardloom.llm.decontaminate import LEAST_CHARS, contaminated, normalised

    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    words = {10**6 + n: w for n, w in enumerate(("the", "le", "Apache License", "not there at all"))}
    bench = spark.createDataFrame([*items.items(), *words.items(), (None, "Version 2.0")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in contaminated(spark.read.parquet(f"{sf}/documents.parquet"), bench).collect()}
    for d, row in documents.items():
        text = f" {normalised(row.text)} "
        for i, item in [*words.items(), (None, "Version 2.0"), *items.items()]:
            if f" {normalised(item)} " in text:
                assert found[d, i].distance == 0
            elif len(normalised(item)) < LEAST_CHARS:
                assert (d, i) not in found
    assert all(r.distance <= r.budget for r in found.values())
