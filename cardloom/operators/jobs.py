"""Whole jobs over many parts: reading again what failed, filling from ranked texts, and importing into the registry.

Every job takes and returns frames.  Parts are a column, so a job over a folder of parts is one plan, not a loop over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.operators import quality as Q
from cardloom.operators import records as R
from cardloom.operators import store
from cardloom.schema import REGISTRY, SOURCE_KEY

#: Fields that a ranked text may fill, with the rule that reads them.
FILLS: dict[str, Callable[[Column], Column]] = {"epic": X.identifier, "houseNo": X.house, "age": X.age, "gender": X.gender}


def filled_by_rank(records: DataFrame, candidates: DataFrame, key: str, rank: str = "rank", band: str = "band", text: str = "text") -> DataFrame:
    """records (key, epic, houseNo, age, gender and more) with each missing field read from the first of the key's candidate texts
    that has it, by rank.  candidates: key, band (the field it may fill; `age` fills age and gender), rank, text.  Nothing is overwritten."""
    own = candidates.select(key, rank, *[F.when(F.col(band) == ("age" if field == "gender" else field), rule(F.col(text))).alias(field) for field, rule in FILLS.items()])
    first = own.groupBy(key).agg(*[F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(rank))).alias(f"_{f}") for f in FILLS])
    return records.join(first, key, "left").withColumns({f: F.coalesce(f, f"_{f}") for f in FILLS}).drop(*[f"_{f}" for f in FILLS])


def retry_pages(records: DataFrame, part: str = "part", page: str = "page", skip_clipped: bool = True) -> DataFrame:
    """part, page of the pages with an invalid record; records that only lack age and gender don't count (they were cut off)."""
    again = ~F.col("valid") & F.col(page).isNotNull()
    return records.filter(again & ~R.clip_only() if skip_clipped else again).select(part, page).distinct()


def retried(records: DataFrame, read_again: DataFrame, part: str = "part", page: str = "page") -> DataFrame:
    """Records of all parts, with those of each page that was read again replaced by its new ones."""
    return store.replaced(records, read_again, read_again, [part, page])


def retry_report(before: DataFrame, after: DataFrame, pages: DataFrame, part: str = "part") -> DataFrame:
    """part, pages, valid_before, valid_after, valid_delta and clip_skipped of the parts that had pages to read again; the last row, with
    a null part, sums them up."""
    touched = pages.groupBy(part).agg(F.count("*").alias("pages"))
    old = before.groupBy(part).agg(F.count_if("valid").alias("valid_before"), F.count_if(R.clip_only()).alias("clip_skipped"))
    new = after.groupBy(part).agg(F.count_if("valid").alias("valid_after"))
    out = touched.join(old, part, "left").join(new, part, "left").fillna(0).withColumn("valid_delta", F.col("valid_after") - F.col("valid_before"))
    names = ["pages", "valid_before", "valid_after", "valid_delta", "clip_skipped"]
    return out.select(part, *names).unionByName(out.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).withColumn(part, F.lit(None).cast(out.schema[part].dataType)))


def replaced_records(records: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """A record that was read a second time is replaced by that reading, even if it is still invalid."""
    return store.replaced(records, second, second, key)


def imported(rows: DataFrame) -> DataFrame:
    """The registry as a bulk import makes it: nothing of an older table stays."""
    return store.conformed(rows)


def imported_once(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The table if it has rows, else the import.  Decided inside the plan, so both sides stay lazy."""
    some = table.limit(1).select(F.lit(True).alias("_some"))
    return table.select(*REGISTRY.fieldNames()).unionByName(imported(rows).join(F.broadcast(some), F.lit(True), "left_anti"))


def ledger_upsert(ledger: DataFrame, found: DataFrame, key: list[str], ok: str = "ok") -> DataFrame:
    """The ledger with the entries of parts that were read well: those with ok true and a whole key replace their older entry."""
    usable = found.filter(F.coalesce(F.col(ok), F.lit(False))).dropna(subset=key).drop(ok)
    return store.merged_ledger(ledger, usable, key)


def page_report(pages: DataFrame, group: str) -> DataFrame:
    """Sums over the pages of each group: pages, extracted, valid, missing fields and seconds."""
    sums = ("extracted", "valid", "missing_epic", "missing_age", "missing_house", "seconds")
    return pages.groupBy(group).agg(F.count("*").alias("pages"), *[F.sum(c).alias(c) for c in sums])


def part_label(path: str = SOURCE_KEY, constituency: str = "constituency", part: str = "partNo", asked: Column | None = None) -> Column:
    """How a part is shown: district, assembly and part of its path, else the path asked for, else constituency and part."""
    whole = F.regexp_extract(path, r"^(.*)\.pdf$", 1)
    pretty = F.translate(F.regexp_replace(whole, "/", " / "), "_", " ")
    known = F.when(F.col(path).contains("/"), pretty)
    named = F.concat_ws(" / ", F.col(constituency), F.when(F.col(part).isNotNull(), F.concat(F.lit("part "), F.col(part).cast("string"))))
    return F.coalesce(known, asked if asked is not None else F.lit(None).cast("string"), named)


def shown(df: DataFrame) -> DataFrame:
    """Every cell as text, empty for null."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def existing(df: DataFrame, columns: tuple[str, ...] = tuple(REGISTRY.fieldNames())) -> DataFrame:
    """Those of the columns that the frame has, in their order."""
    return df.select(*[c for c in columns if c in df.columns])


def labelled_text(text: Column) -> Column:
    """Fields of a card given as one text with line breaks."""
    return R.labelled_fields(F.split(text, "\n"))


def page_blob(header: Column, footer: Column) -> Column:
    """The joined text of a page's header and footer tokens (arrays of structs with text)."""
    return F.array_join(F.transform(F.concat(F.coalesce(header, F.array_repeat(F.lit(None), 0)), F.coalesce(footer, F.array_repeat(F.lit(None), 0))), lambda t: t["text"]), " ")


def in_order(records: DataFrame, part: str) -> DataFrame:
    """place of each record in its part, in the order of records."""
    return records.withColumn("place", F.row_number().over(Window.partitionBy(part).orderBy(*store.record_order())))


def part_outcomes(records: DataFrame, tokens: DataFrame, expected: DataFrame, part: str = "doc") -> DataFrame:
    """part, extractedTotal, validCount, expectedTotal, failed_pages and ok of every part that was read or expected: how many records of it
    there are, how many are valid, and whether that is enough.  A part with a page that could not be read is not ok, however many of
    its records are valid.  records: part, valid; tokens: part, page, error; expected: part, expectedTotal."""
    counts = records.groupBy(part).agg(F.count("*").alias("extractedTotal"), F.count_if("valid").alias("validCount"))
    failed = tokens.groupBy(part, "page").agg(F.max(F.col("error").isNotNull()).alias("bad")).groupBy(part).agg(F.count_if("bad").alias("failed_pages"))
    out = failed.join(counts, part, "full").join(expected.select(part, F.col("expectedTotal").cast("long").alias("expectedTotal")), part, "full")
    out = out.fillna(0, ["extractedTotal", "validCount", "failed_pages"])
    return out.withColumn("ok", Q.successful(F.col("validCount"), F.col("extractedTotal"), F.coalesce("expectedTotal", F.lit(0))) & (F.col("failed_pages") == 0))
