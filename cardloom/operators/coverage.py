"""Coverage: which parts of which assemblies were read, rolled up from assembly to district to state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.schema import LAYOUT


def roll_location(path: Column) -> Column:
    """struct of district, folder, number and name of the assembly, and part of .../District/NN_Name/part_N.pdf; else null."""
    cut = F.split(path, "/")
    folder, assembly = F.try_element_at(cut, F.lit(-3)), F.try_element_at(cut, F.lit(-2))
    part = F.regexp_extract(F.element_at(cut, -1), r"^part_(\d+)(?:\.[^.]*)?$", 1).try_cast("long")
    number = F.regexp_extract(assembly, r"^(\d+)_(.+)$", 1).try_cast("long")
    name = F.translate(F.regexp_extract(assembly, r"^(\d+)_(.+)$", 2), "_", " ")
    found = F.struct(F.translate(folder, "_", " ").alias("district"), folder.alias("districtFolder"), number.alias("asmblyNo"), name.alias("acName"), assembly.alias("acFolder"), part.alias("partNo"))
    return F.when((F.size(cut) >= 3) & number.isNotNull() & part.isNotNull(), found)


def source_key(path: Column) -> Column:
    """The registry's key of a part: District/NN_Name/part_N.pdf where the path says so, else the file's name without its ending, and .pdf."""
    at = roll_location(path)
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    return F.when(at.isNotNull(), part_path(at["districtFolder"], at["acFolder"], at["partNo"])).otherwise(F.concat(stem, F.lit(".pdf")))


def ledger_as_asked(ledger: DataFrame, asked: DataFrame) -> DataFrame:
    """districtFolder, asmblyNo, partNo of the ledger under the folder names of asked (districtFolder, asmblyNo, districtName).  An assembly
    without an entry under its own folder takes those of a folder whose name differs in case and underscores only."""
    found = ledger.select("districtFolder", F.col("asmblyNo").cast("long").alias("asmblyNo"), F.col("partNo").cast("long").alias("partNo"), F.col("districtFolder").alias("_held"))
    known = asked.select("districtFolder", F.col("asmblyNo").cast("long").alias("asmblyNo"), "districtName").dropna().distinct()
    loose = [(F.lower("districtName"), "lower(translate(districtFolder, '_', ' '))"), (F.col("asmblyNo"), "asmblyNo")]
    at = two_tier(known, found, ["districtFolder", "asmblyNo"], loose, "_held").select("districtFolder", "asmblyNo", "_held")
    return at.join(found.select("_held", "asmblyNo", "partNo"), ["_held", "asmblyNo"]).select("districtFolder", "asmblyNo", "partNo").distinct()


def part_path(folder: Column, assembly: Column, part: Column) -> Column:
    return F.concat_ws("/", folder, assembly, F.concat(F.lit("part_"), part.cast("string"), F.lit(".pdf")))


def assembly_folder(number: Column, name: Column) -> Column:
    return F.concat(number.cast("string"), F.lit("_"), F.translate(name, " ", "_"))


def ledger_key(folder: Column, number: Column, part: Column) -> Column:
    return F.concat_ws("|", folder, number.cast("string"), part.cast("string"))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0).otherwise(F.round(100 * part / whole)).cast("long")


def two_tier(left: DataFrame, right: DataFrame, exact: list[str], loose: list[tuple[Column, str]], value: str) -> DataFrame:
    """left with value from right: by exact keys, else by loose ones ((expression on left, same name's expression in right)).
    right is grouped per tier, so that no row of left is multiplied; of several loose matches the least value stands."""
    first = right.groupBy(*exact).agg(F.min(value).alias("_first"))
    second = right.groupBy(*[F.expr(e).alias(f"_k{i}") for i, (_, e) in enumerate(loose)]).agg(F.min(value).alias("_second"))
    out = left.join(first, exact, "left")
    for i, (c, _) in enumerate(loose):
        out = out.withColumn(f"_l{i}", c)
    on = [F.col(f"_l{i}") == F.col(f"_k{i}") for i in range(len(loose))]
    return out.join(second, on, "left").withColumn(value, F.coalesce("_first", "_second")).drop("_first", "_second", *[f"_{x}{i}" for i in range(len(loose)) for x in "lk"])


def assembly_totals(regions: DataFrame, scanned: DataFrame, downloaded: DataFrame, key: list[str], default: int = LAYOUT.parts_per_assembly) -> DataFrame:
    """regions (key, and what else they have) with scanned, downloaded, total and pending parts.  total: the parts downloaded, else
    the default where nothing was scanned, else the highest part scanned."""
    s = scanned.groupBy(*key).agg(F.count_distinct("partNo").alias("scanned"), F.max("partNo").alias("_most"))
    d = downloaded.groupBy(*key).agg(F.count_distinct("partNo").alias("downloaded"))
    out = regions.join(s, key, "left").join(d, key, "left").fillna(0, ["scanned", "downloaded"])
    total = F.when(F.col("downloaded") > 0, F.col("downloaded")).when(F.col("scanned") == 0, default).otherwise(F.col("_most"))
    return out.withColumn("total", total.cast("long")).drop("_most").withColumn("pending", F.greatest(F.lit(0), F.col("total") - F.col("scanned")))


def rolled_up(totals: DataFrame, levels: list[str]) -> DataFrame:
    """Sums per prefix of the levels (null: all); pending is cut at 0 after each sum, so it is not additive."""
    out = totals.rollup(*levels).agg(F.sum("scanned").alias("scanned"), F.sum("total").alias("total"), F.grouping_id().alias("level"))
    return out.withColumn("pending", F.greatest(F.lit(0), F.col("total") - F.col("scanned")))


def coverage_tree(totals: DataFrame) -> DataFrame:
    """One row per district (districtName, districtCd) with its assemblies in order as an array of structs."""
    assembly = F.struct("asmblyNo", "name", "scanned", "total", "pending", "downloaded")
    out = totals.groupBy("districtName", "districtCd").agg(F.sum("scanned").alias("scanned"), F.sum("total").alias("total"), F.array_sort(F.collect_list(assembly)).alias("assemblies"))
    return out.withColumn("pending", F.greatest(F.lit(0), F.col("total") - F.col("scanned"))).withColumn("folder", F.translate("districtName", " ", "_"))


def part_cells(assemblies: DataFrame, scanned: DataFrame, downloaded: DataFrame, counts: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """key, partNo, scanned, invalidCount, hasPdf of each part of each assembly (with its total): the downloaded and scanned ones if
    anything was downloaded, else 1 to total."""
    have = downloaded.select(*key, "partNo").distinct()
    done = scanned.select(*key, "partNo").distinct()
    some = have.select(*key).distinct().withColumn("_some", F.lit(True))
    marked = assemblies.join(some, key, "left")
    numbered = marked.filter("_some is null and total >= 1").select(*key, F.explode(F.sequence(F.lit(1).cast("long"), F.col("total"))).alias("partNo"))
    listed = have.unionByName(done).distinct().join(marked.filter("_some").select(*key), key, "left_semi")
    parts = numbered.unionByName(listed)
    on = [*key, "partNo"]
    out = parts.join(done.withColumn("_done", F.lit(True)), on, "left").join(have.withColumn("_pdf", F.lit(True)), on, "left")
    out = out.join(counts.select(*on, F.col("invalid").alias("_counted")), on, "left").join(ledger.select(*on, F.col("invalid").alias("_ledger")), on, "left")
    return out.select(*on, F.coalesce("_done", F.lit(False)).alias("scanned"), F.coalesce("_counted", "_ledger", F.lit(0)).alias("invalidCount"), F.coalesce("_pdf", F.lit(False)).alias("hasPdf"))


def in_assembly(number: int, district: str | None, folder: str = "districtFolder") -> Column:
    """Ledger rows of an assembly; a row without a district belongs to any."""
    held = X.spaced(F.coalesce(F.col(folder), F.lit("")))
    return (F.col("asmblyNo") == number) & ((held == "") | (held == (district or "").replace("_", " ").strip().lower()))


def first_known(value: str, order: str) -> Column:
    """Aggregate: the first value that is not null."""
    return F.min_by(F.when(F.col(value).isNotNull(), F.col(value)), F.when(F.col(value).isNotNull(), F.col(order)))
