from __future__ import annotations

import re

SPACE = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA, parts=3):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with a column that an operator must not trip over."""
    full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] else None) for r in rows]
    return spark.createDataFrame(full, schema).repartition(parts).selectExpr("*", "'clash' as score", "7 as piece", "'x' as n", "0 as shard", "'k' as key")


def words_of(i, n, salt="w"):
    """n words that no other text has."""
    return [f"{salt}{i}x{k}" for k in range(n)]
