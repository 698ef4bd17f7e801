"""From paths that a user names to part folders and files that exist: every question is a join of paths with one listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions import text as X


def plain_path(path: Column) -> Column:
    """A path without its scheme, doubled and final slashes."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"^\w+:/+", "/"), "/+", "/"), "(?<=.)/$", "")


def ancestors(path: Column) -> Column:
    """array of a path and all folders above it."""
    cut = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(cut)), lambda n: F.array_join(F.slice(cut, 1, n), "/"))


def assembly_of(path: Column) -> Column:
    """District/NN_Name of a path to an assembly's folder, or to a part or file in it; null if it names none."""
    cut = F.split(path, "/")
    whole = F.size(cut)
    at = lambda n: F.get(cut, n)
    own = F.filter(F.sequence(F.lit(1), whole), lambda n: at(n).rlike(r"^\d+_.+$") & ((n == whole - 1) | (n == whole - 2) & at(n + 1).rlike(r"^part_\d+(\.[^.]*)?$") | (n == whole - 3) & at(n + 1).rlike(r"^part_\d+$")))
    return F.when(F.size(own) > 0, F.concat_ws("/", at(F.element_at(own, -1) - 1), at(F.element_at(own, -1))))


def saved_parts(listing: DataFrame) -> DataFrame:
    """path, part: the folders in which the listing (path) has saved records."""
    found = listing.select(F.regexp_extract(plain_path(F.col("path")), r"^(.*)/json/voters\.json$", 1).alias("path")).filter("path <> ''")
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("part")).distinct()


def resolved_parts(asked: DataFrame, listing: DataFrame, out: str) -> DataFrame:
    """asked, path, part: the part folders that paths (column asked) stand for.  A folder with saved records is itself one; of another folder
    those named part_N directly in it; and where there are none, those below the output folder in the same district and assembly, so
    that a folder of downloads leads to what was read from them."""
    parts = saved_parts(listing)
    want = asked.select("asked").distinct().withColumn("_at", plain_path(F.col("asked")))
    own = want.join(parts, F.col("_at") == F.col("path")).select("asked", "path", "part")
    numbered = parts.filter(F.col("part").rlike("^part_"))
    above = numbered.withColumn("_above", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    inside = want.join(own.select("asked"), "asked", "left_anti").join(above, F.col("_at") == F.col("_above")).select("asked", "path", "part")
    direct = own.unionByName(inside)
    root = plain_path(F.lit(out))
    mapped = want.join(direct.select("asked").distinct(), "asked", "left_anti").withColumn("_above", F.concat(root, F.lit("/"), assembly_of(F.col("_at"))))
    return direct.unionByName(mapped.join(above, "_above").select("asked", "path", "part"))


def resolved_files(asked: DataFrame, listing: DataFrame, root: str) -> DataFrame:
    """asked (district, assembly folder, part: any columns, with districtFolder, acFolder and partNo) with pdfPath: the listed file
    root/district/assembly/part_N.pdf, or null.  Segments that could leave the root, and part numbers under 1, name no file; what is
    not listed does not exist."""
    district = X.safe_segment(F.translate(F.coalesce(F.col("districtFolder"), F.lit("")), " ", "_"))
    number = F.col("partNo").cast("string").try_cast("long")
    want = F.when(number >= 1, F.concat(plain_path(F.lit(root)), F.lit("/"), district, F.lit("/"), X.safe_segment(F.col("acFolder")), F.lit("/part_"), number.cast("string"), F.lit(".pdf")))
    have = listing.select(plain_path(F.col("path")).alias("pdfPath")).filter(F.col("pdfPath").rlike(r"/part_\d+\.pdf$")).distinct()
    return asked.withColumn("_want", want).join(have, F.col("_want") == F.col("pdfPath"), "left").drop("_want")


def below(files: DataFrame, asked: DataFrame, path: str = "path") -> DataFrame:
    """The files that lie at or below one of the asked paths (column asked): a semi-join of every file's folders with them, not a
    comparison of every file with every path."""
    keyed = files.withColumn("_row", F.monotonically_increasing_id()).withColumn("_at", F.explode(ancestors(plain_path(F.col(path)))))
    met = keyed.join(asked.select(plain_path(F.col("asked")).alias("_at")).distinct(), "_at", "left_semi")
    return met.drop("_at").dropDuplicates(["_row"]).drop("_row")
