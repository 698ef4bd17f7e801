"""Counts that tell how well a reading went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def summary(valid: Column, **missing: Column) -> list[Column]:
    """Aggregates: extracted, valid, and missing_<name> for each column."""
    return [F.count("*").alias("extracted"), F.count_if(valid).alias("valid"), *[F.count_if(c.isNull()).alias(f"missing_{n}") for n, c in missing.items()]]


def fill_delta(before: Column, after: Column) -> Column:
    return F.count_if(before.isNull() & after.isNotNull())


def successful(valid: Column, extracted: Column, expected: Column) -> Column:
    """At least 90 % of what was expected is valid, or of what was extracted where the expectation is unknown; whole numbers."""
    need = F.when(expected > 0, F.floor(expected * 9 / 10)).otherwise(F.greatest(F.lit(1), F.floor(extracted * 9 / 10)))
    return (valid > 0) & (extracted > 0) & (valid >= need)


def invalid_count(extracted: Column, valid: Column, counted: Column, ledger: Column) -> Column:
    """From a part's totals, else from its rows, else from the ledger, else 0."""
    return F.coalesce(F.greatest(F.lit(0), F.when(extracted.isNotNull() & valid.isNotNull(), extracted - valid)), counted, ledger, F.lit(0))


def retry_effect(before: Column, after: Column) -> list[Column]:
    """Aggregates over records joined with their second reading."""
    return [
        F.count_if(~before).alias("attempted"), F.count_if(~before & after).alias("fixed"), F.count_if(before).alias("valid_before"),
        F.count_if(after).alias("valid_after"), (F.count_if(after) - F.count_if(before)).alias("valid_delta"),
    ]


def phase_profile(phases: DataFrame, phase: str = "phase", seconds: str = "seconds", count: str = "count") -> DataFrame:
    """phase, seconds, count, pct of the total, and rank: longest first, then by name."""
    sums = phases.groupBy(phase).agg(F.sum(seconds).alias("seconds"), F.sum(count).alias("count"))
    total = F.sum("seconds").over(Window.partitionBy())
    pct = F.when(total > 0, F.round(100 * F.col("seconds") / total, 1)).otherwise(0.0)
    ranked = F.row_number().over(Window.orderBy(F.desc("seconds"), phase))
    return sums.withColumns({"pct": pct, "rank": ranked})
