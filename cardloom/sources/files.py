"""Files: part tables as CSV, saved payloads as JSON, region metadata, listings by name, and their writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.operators.coverage import roll_location
from cardloom.operators.store import conformed
from cardloom.schema import LEDGER, PAYLOAD, PUBLIC, REGIONS, REGISTRY
from cardloom.sources.many_files import contents
from cardloom.sources.tables import tables_by_header, typed


def read_parts_csv(spark: SparkSession, *paths: str, combined: bool = False) -> DataFrame:
    """Part tables by their headers: columns in any order, missing ones null, others left out; leading zeros stay, bad cells are null,
    long lines are cut, short ones padded."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in (REGISTRY if combined else PUBLIC).fields])
    return typed(tables_by_header(spark, *paths, known=tuple(schema.fieldNames())), schema).select(*schema.fieldNames())


def write_parts_csv(records: DataFrame, path: str) -> None:
    records.select(*PUBLIC.fieldNames()).write.mode("overwrite").option("header", True).csv(path)


def read_payloads(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(PAYLOAD).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(list(paths)).withColumn("path", F.col("_metadata.file_path"))


def payloads_of(files: DataFrame) -> DataFrame:
    """The rows of `read_payloads`, for listed files (`many_files.listed`) of which there may be millions."""
    read = contents(files).filter(F.octet_length("content") > 0)
    return read.select(F.from_json(F.col("content").cast("string"), PAYLOAD).alias("payload"), "path").select("payload.*", "path")


def saved_records(payloads: DataFrame) -> DataFrame:
    """One row per saved record, with defaults: page 0, valid unless it says otherwise, tokens without text dropped."""
    rows = payloads.select("source", F.explode("voters").alias("v")).select("source", "v.*")
    return rows.withColumns({
        "page": F.coalesce("page", F.lit(0)), "valid": F.coalesce("valid", F.lit(True)), "errors": F.coalesce("errors", F.array().cast("array<string>")),
        "boundingBoxes": F.filter(F.coalesce("boundingBoxes", F.array().cast(PAYLOAD["voters"].dataType.elementType["boundingBoxes"].dataType)), lambda t: F.coalesce(t["text"], F.lit("")) != ""),
    })


#: Bytes up to which a part table is a header at most.
EMPTY_CSV = 20


def _bytes(spark: SparkSession, path: str) -> int | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).getLen() if fs.exists(p) and fs.getFileStatus(p).isFile() else None


def read_registry_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The registry as CSV files hold it: the combined file if there is one, else every part table below the folder, without those of
    at most EMPTY_CSV bytes.  Columns go by the header of each file; a file may lack some and have others."""
    combined = f"{folder.rstrip('/')}/csv/all_voters.csv"
    size = _bytes(spark, combined)
    if size is not None:
        return conformed(read_parts_csv(spark, combined, combined=True)) if size > EMPTY_CSV else spark.createDataFrame([], REGISTRY)
    return conformed(tables_by_header(spark, folder, glob="voters.csv", known=tuple(REGISTRY.fieldNames()), least_bytes=EMPTY_CSV))


def import_registry(spark: SparkSession, csv: str, table: str, only_if_empty: bool = False) -> DataFrame:
    """Write a combined CSV file as the registry table and read that.  It replaces the table, or (only_if_empty) is written only where
    the table is missing or empty and the file holds rows."""
    size = _bytes(spark, csv)
    if only_if_empty and _bytes(spark, f"{table}/_SUCCESS") is not None:
        now = spark.read.schema(REGISTRY).parquet(table)
        if not now.isEmpty() or size is None or size <= EMPTY_CSV:
            return now
    if only_if_empty and (size is None or size <= EMPTY_CSV):
        return spark.createDataFrame([], REGISTRY)
    conformed(read_parts_csv(spark, csv, combined=True)).write.mode("overwrite").parquet(table)
    return spark.read.schema(REGISTRY).parquet(table)


def part_folders(spark: SparkSession, root: str) -> DataFrame:
    """part, path: the part folders below a root that hold saved records, or the root itself."""
    files = listing(spark, root, "voters.json").select(F.regexp_extract("path", r"^(.*)/json/voters\.json$", 1).alias("path")).filter("path <> ''")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("part"), "path").distinct()


def page_files(spark: SparkSession, folder: str, wanted: DataFrame | None = None, glob: str = "page*.png") -> tuple[DataFrame, DataFrame]:
    """(doc, page, path, content of the page files below a folder; the wanted pages that have none).  wanted: doc, page; without
    it every page is read.  Contents are read after the files are filtered."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    cut = F.split("path", "/")
    pages = files.select(F.try_element_at(cut, F.lit(-2)).alias("doc"), F.regexp_extract(F.element_at(cut, -1), r"page(\d+)", 1).try_cast("int").alias("page"), "path", "content").filter("page is not null")
    if wanted is None:
        return pages, pages.limit(0).select("doc", "page")
    wanted = wanted.select("doc", F.col("page").cast("int").alias("page")).distinct()
    return pages.join(wanted, ["doc", "page"], "left_semi"), wanted.join(pages.select("doc", "page"), ["doc", "page"], "left_anti")


def crop_files(records: DataFrame, files: DataFrame, path: str = "cropPath") -> DataFrame:
    """records with cropFile: the listed file of their crop's whole path, else the only one of its name; null if there is none."""
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    whole = files.select(F.regexp_replace("path", "^file:/*", "/").alias("_whole")).distinct()
    named = files.groupBy(name(F.col("path")).alias("_name")).agg(F.min("path").alias("_any"), F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    keyed = records.withColumns({"_path": F.regexp_replace(path, "^file:/*", "/"), "_name": name(F.col(path))})
    out = keyed.join(whole, F.col("_path") == F.col("_whole"), "left").join(named, "_name", "left")
    return out.select(*records.columns, F.coalesce("_whole", F.regexp_replace("_any", "^file:/*", "/")).alias("cropFile"))


def downloads_of(files: DataFrame, assemblies: DataFrame) -> DataFrame:
    """districtFolder, asmblyNo, partNo of the downloaded parts of assemblies (districtFolder, asmblyNo, name).  The district's folder
    is the one of its name, or with underscores; the assembly's is number_Name, else the only one that begins with its number."""
    cut = F.split("path", "/")
    have = files.select(F.try_element_at(cut, F.lit(-3)).alias("_district"), F.try_element_at(cut, F.lit(-2)).alias("_folder"), F.regexp_extract(F.element_at(cut, -1), r"^part_(\d+)\.pdf$", 1).try_cast("long").alias("partNo")).filter("partNo is not null").distinct()
    folders = have.select("_district", "_folder").distinct()
    numbered = folders.groupBy("_district", F.regexp_extract("_folder", r"^(\d+)_", 1).try_cast("long").alias("_no")).agg(F.min("_folder").alias("_only"), F.count("*").alias("_n")).filter("_n = 1 and _no is not null").drop("_n")
    want = F.concat(F.col("asmblyNo").cast("string"), F.lit("_"), F.translate("name", " ", "_"))
    asked = assemblies.select("districtFolder", F.col("asmblyNo").cast("long").alias("asmblyNo"), want.alias("_want"))
    districts = folders.select("_district").distinct()
    at = asked.join(districts.select(F.col("_district").alias("_given")), F.col("districtFolder") == F.col("_given"), "left")
    at = at.withColumn("_district", F.coalesce("_given", F.translate("districtFolder", " ", "_"))).drop("_given")
    named = folders.withColumn("_named", F.col("_folder"))
    found = at.join(named, (at["_district"] == named["_district"]) & (at["_want"] == named["_folder"]), "left").select(at["districtFolder"], at["asmblyNo"], at["_district"], "_named")
    found = found.join(numbered, (found["_district"] == numbered["_district"]) & (found["asmblyNo"] == numbered["_no"]), "left").select("districtFolder", "asmblyNo", found["_district"].alias("_d"), F.coalesce("_named", "_only").alias("_f"))
    return found.join(have, (F.col("_d") == F.col("_district")) & (F.col("_f") == F.col("_folder"))).select("districtFolder", "asmblyNo", "partNo").distinct()


def write_payload(records: DataFrame, path: str) -> None:
    """Full records, confidence to four places."""
    records.withColumn("confidence", F.bround("confidence", 4)).write.mode("overwrite").json(path)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """state, districtName, districtCd, asmblyNo, name: one row per assembly; a district without any has one of nulls."""
    rows = spark.read.schema(REGIONS).option("multiLine", True).json(path)
    rows = rows.select("state", "stateName", F.explode_outer("districts").alias("d")).select("state", "stateName", "d.*")
    return rows.select("state", "stateName", "districtName", "districtCd", F.explode_outer("assemblies").alias("a")).select("state", "stateName", "districtName", "districtCd", "a.*")


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The ledger table; an empty one where none was written yet."""
    return spark.read.schema(LEDGER).parquet(path) if path else spark.createDataFrame([], LEDGER)


def listing(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """path and length of the files below a folder, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path", "length")


def part_number(name: Column) -> Column:
    """Number of a part file; files without one sort last."""
    return F.coalesce(F.regexp_extract(name, r"(?i)part[_\-]?(\d+)", 1).try_cast("long"), F.lit(10**9).cast("long"))


def naturally_sorted(files: DataFrame, name: str = "path", first: int | None = None) -> DataFrame:
    out = files.orderBy(part_number(F.element_at(F.split(name, "/"), -1)), F.lower(name), name)
    return out.limit(first) if first else out


def downloaded_parts(files: DataFrame) -> DataFrame:
    return files.select(roll_location(F.col("path")).alias("at")).filter("at is not null").select("at.*").distinct()
