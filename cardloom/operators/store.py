"""The registry as a table: replace by key, append once, replace by page, and the ledger of what was read.

A replacement is an anti-join and a union, so that an empty one clears its key; the write goes to a new folder, and the caller swaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.schema import INTEGERS, REGISTRY, SOURCE_KEY


def conformed(rows: DataFrame) -> DataFrame:
    """Registry rows of any frame: missing columns are null, integers are tried, empty strings are null, the key is never null."""
    have = set(rows.columns)
    columns = []
    for f in REGISTRY.fields:
        if f.name == SOURCE_KEY:
            columns.append(F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name) if f.name in have else F.lit("").alias(f.name))
        elif f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            columns.append((X.as_integer(F.col(f.name)) if f.name in INTEGERS else X.as_text(F.col(f.name))).alias(f.name))
    return rows.select(*columns)


def replaced(old: DataFrame, new: DataFrame, keys: DataFrame, on: str | list[str] = SOURCE_KEY) -> DataFrame:
    """old without the keys, and new.  keys says what is replaced, also where new has no row of it."""
    on = [on] if isinstance(on, str) else on
    return old.join(keys.select(*on).distinct(), on, "left_anti").select(*old.columns).unionByName(new, allowMissingColumns=True).select(*old.columns)


def appended_once(old: DataFrame, new: DataFrame, known: DataFrame, on: str = SOURCE_KEY) -> DataFrame:
    """old and those rows of new whose key is not known yet."""
    return old.unionByName(new.join(known.select(on).distinct(), on, "left_anti").select(*new.columns), allowMissingColumns=True)


def replaced_pages(records: DataFrame, read_again: DataFrame, pages: DataFrame, page: str = "page") -> DataFrame:
    """Records of other pages, and what was read again."""
    return replaced(records, read_again, pages, page)


def diagonal(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def record_order(serial: str = "serialNo", page: str = "page", *ties: str) -> list[Column]:
    return [F.col(serial).isNull(), F.coalesce(F.col(serial), F.lit(0)), F.col(page), *[F.col(t) for t in ties]]


def ledger_changes(old: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """One row: added, updated and skipped entries when found (rows with a null key are skipped) is merged into the ledger."""
    known = old.select(*key).distinct().withColumn("_known", F.lit(True))
    usable = F.lit(True)
    for k in key:
        usable = usable & F.col(k).isNotNull()
    merged = found.withColumn("_usable", usable).join(known, key, "left")
    return merged.agg(
        F.count_if(F.col("_usable") & F.col("_known").isNull()).alias("added"), F.count_if(F.col("_usable") & F.col("_known").isNotNull()).alias("updated"), F.count_if(~F.col("_usable")).alias("skipped"),
    )


def merged_ledger(old: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    return replaced(old, found.dropna(subset=key), found.dropna(subset=key), key)
