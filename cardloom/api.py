"""Entry points: one function per job, from a folder or a frame to frames.  Nothing here runs a loop over parts, and only
import_csv writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import assign as A
from cardloom.operators import coverage as C
from cardloom.operators import jobs as J
from cardloom.operators import pages as P
from cardloom.operators import quality as Q
from cardloom.operators import records as R
from cardloom.operators import store
from cardloom.operators.search import search
from cardloom.schema import LEDGER
from cardloom.sources import files

__all__ = ["backfill", "cleanup", "coverage", "import_csv", "ingest", "parse", "profile", "refill", "registry", "retry", "search"]

KEY = ["districtFolder", "asmblyNo", "partNo"]


def ingest(cards: DataFrame) -> DataFrame:
    """Validated records of cards (card_id, width, height, tokens), without empty cells."""
    return R.validated(R.parsed_cards(cards).filter(R.not_empty_cell()))


@dataclass(frozen=True)
class Parsed:
    """What a parse job gives: the records of all parts, the outcome of each part, the ledger with the parts that went well, and for each image
    whether it is still needed (those of parts that did not go well always are)."""

    records: DataFrame
    outcomes: DataFrame
    ledger: DataFrame
    images: DataFrame


def parse(tokens: DataFrame, cards: DataFrame, parts: DataFrame, ledger: DataFrame, images: DataFrame) -> Parsed:
    """The whole job over any number of parts, as one plan.  tokens: doc, page, seq, text, confidence, bbox, error; cards: doc, page, card_index,
    x, y, w, h; parts: doc, expectedTotal and the fields of a ledger's entry; images: doc, path.  A part is ok if enough of its records
    are valid and none of its pages failed; only ok parts get into the ledger, and only theirs of the images may go."""
    read = A.tokens_of_cards(tokens, cards.select("doc", "page", "card_index", "x", "y", "w", "h"), ["doc", "page"])
    records = ingest(read)
    outcomes = J.part_outcomes(records, tokens, parts)
    entries = outcomes.drop("expectedTotal").join(parts, "doc")
    after = J.ledger_upsert(ledger, entries.select(*[F.col(f.name).cast(f.dataType) if f.name in entries.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER.fields], "ok"), KEY)
    verdicts = cleanup(images, records.withColumn("card", F.col("card_index") + 1)).join(outcomes.select("doc", "ok"), "doc", "left")
    kept = verdicts.withColumn("keep", F.col("keep") | ~F.coalesce("ok", F.lit(False))).drop("ok")
    return Parsed(records, outcomes, after, kept)


def refill(records: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Records with missing fields read from ranked texts, validated again; those that lack nothing stay as they are."""
    return R.validated(J.filled_by_rank(records.drop("errors", "valid"), candidates, key))


def retry(records: DataFrame, read_again: DataFrame, part: str = "part", page: str = "page") -> tuple[DataFrame, DataFrame]:
    """(records with the pages that failed replaced by their second reading, the report of the parts).  Of read_again only pages that
    failed count, so a reading of more pages does no harm."""
    pages = J.retry_pages(records, part, page)
    again = read_again.join(pages, [part, page], "left_semi").select(*records.columns)
    after = J.retried(records, again, part, page)
    return after, J.retry_report(records, after, pages, part)


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry as the CSV files below a folder hold it."""
    return files.read_registry_csv(spark, folder)


def import_csv(spark: SparkSession, csv: str, table: str, only_if_empty: bool = False) -> DataFrame:
    return files.import_registry(spark, csv, table, only_if_empty)


def backfill(spark: SparkSession, folder: str, ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(the ledger with an entry for each part that has saved records below the folder, how many entries were added, updated and
    skipped).  Totals that a payload lacks are counted from its records; a path that names no part is skipped."""
    saved = files.read_payloads(spark, folder).withColumn("pdfPath", F.regexp_replace("path", r"/json/[^/]*\.json$", ".pdf"))
    at = saved.withColumn("at", C.roll_location(F.col("pdfPath")))
    counted = F.size(F.filter(F.coalesce("voters", F.array_repeat(F.element_at("voters", 1), 0)), lambda v: F.coalesce(v["valid"], F.lit(True))))
    found = at.select(
        "at.districtFolder", "at.asmblyNo", "at.acName", "at.acFolder", "at.partNo", F.coalesce("validCount", counted.cast("long")).alias("validCount"),
        F.coalesce("extractedTotal", F.greatest(F.size("voters"), F.lit(0)).cast("long")).alias("extractedTotal"), "expectedTotal", "pdfPath",
    )
    old = ledger if ledger is not None else spark.createDataFrame([], LEDGER)
    return store.merged_ledger(old, found, KEY), store.ledger_changes(old, found, KEY)


def coverage(regions: DataFrame, ledger: DataFrame, listed: DataFrame) -> DataFrame:
    """One row per district with its assemblies, from regions, the ledger and a listing of downloaded files."""
    asked = regions.select(F.translate("districtName", " ", "_").alias("districtFolder"), "asmblyNo", "name", "districtName", "districtCd")
    have = files.downloads_of(listed, asked.select("districtFolder", "asmblyNo", "name").dropna())
    totals = C.assembly_totals(asked, C.ledger_as_asked(ledger, asked), have, ["districtFolder", "asmblyNo"])
    return C.coverage_tree(totals)


def cleanup(images: DataFrame, records: DataFrame, doc: str = "doc") -> DataFrame:
    """images with keep; deleting is left to the caller."""
    return P.image_verdicts(images, records, doc)


def profile(phases: DataFrame) -> DataFrame:
    return Q.phase_profile(phases)
