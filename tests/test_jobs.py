"""Whole jobs, sources of parts, and ingestion without its checkpoint."""

from __future__ import annotations

import json
import shutil

from pyspark.sql import functions as F

from cardloom.operators import geometry as G
from cardloom.operators import jobs as J
from cardloom.operators import search as S
from cardloom.sources import files
from cardloom.streaming.ingest import ingest


def test_registry_csv_prefers_the_combined_file_and_skips_empty_ones(spark, tmp_path):
    head = "serialNo,epic,name,relationType,relativeName,houseNo,age,gender,page,partNo,constituency,section"
    for part, text in (("part_1", head + "\n1,,Anu,,,007,20,,1,1,,\n"), ("part_2", head + "\nx,,Bo,,,,30,,1,2,,\n"), ("part_3", "serialNo\n")):
        (tmp_path / part / "csv").mkdir(parents=True)
        (tmp_path / part / "csv" / "voters.csv").write_text(text)
    got = {r.name: r for r in files.read_registry_csv(spark, str(tmp_path)).collect()}
    assert set(got) == {"Anu", "Bo"} and got["Anu"].houseNo == "007" and got["Bo"].serialNo is None and got["Bo"].sourcePdf == ""
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "all_voters.csv").write_text(head + ",sourcePdf\n5,,Cy,,,,40,,1,3,,,D/1_A/part_3.pdf\n")
    assert [(r.name, r.sourcePdf) for r in files.read_registry_csv(spark, str(tmp_path)).collect()] == [("Cy", "D/1_A/part_3.pdf")]


def test_imports_replace_or_only_fill_an_empty_table(spark, tmp_path):
    head = "serialNo,epic,name,relationType,relativeName,houseNo,age,gender,page,partNo,constituency,section,sourcePdf"
    csv, table = tmp_path / "all.csv", str(tmp_path / "table")
    assert files.import_registry(spark, str(csv), table, only_if_empty=True).isEmpty()  # nothing to import
    csv.write_text(head + "\n1,,Anu,,,,20,,1,1,,,a.pdf\n")
    assert [r.name for r in files.import_registry(spark, str(csv), table, only_if_empty=True).collect()] == ["Anu"]
    csv.write_text(head + "\n2,,Bo,,,,20,,1,1,,,b.pdf\n")
    assert [r.name for r in files.import_registry(spark, str(csv), table, only_if_empty=True).collect()] == ["Anu"]
    assert [r.name for r in files.import_registry(spark, str(csv), table).collect()] == ["Bo"]


def test_part_folders_pages_and_crops(spark, tmp_path):
    for part in ("part_1", "part_2"):
        (tmp_path / part / "json").mkdir(parents=True)
    (tmp_path / "part_1" / "json" / "voters.json").write_text("{}")
    assert [r.part for r in files.part_folders(spark, str(tmp_path)).collect()] == ["part_1"]
    assert files.part_folders(spark, str(tmp_path / "part_1")).first().path.endswith("/part_1")
    for n in (1, 2, 12):
        (tmp_path / "part_1" / f"page{n}.png").write_bytes(bytes([n]))
    wanted = spark.createDataFrame([("part_1", 2), ("part_1", 3)], "doc string, page long")
    pages, missing = files.page_files(spark, str(tmp_path), wanted)
    assert [(r.page, bytes(r.content)) for r in pages.collect()] == [(2, b"\x02")] and [tuple(r) for r in missing.collect()] == [("part_1", 3)]
    assert files.page_files(spark, str(tmp_path))[0].count() == 3


def test_ranked_texts_never_overwrite(spark):
    records = spark.createDataFrame([(1, None, "4", None, None), (2, "ABC1234567", None, 30, None), (3, None, None, None, None)], "k long, epic string, houseNo string, age long, gender string")
    texts = spark.createDataFrame([(1, "houseNo", 1, "House Number : 9"), (1, "age", 2, "Age : 40 Gender : Male"), (1, "age", 1, "Gender : Female"), (2, "epic", 1, "XYZ7654321"), (2, "houseNo", 1, None)], "k long, band string, rank int, text string")
    got = {r.k: tuple(r)[1:] for r in J.filled_by_rank(records, texts, "k").collect()}
    assert got == {1: (None, "4", 40, "Female"), 2: ("ABC1234567", None, 30, None), 3: (None, None, None, None)}


def test_frames_and_dividers(spark):
    def frame(v, h, w=2000, height=2800):
        kind = "array<long>"
        return tuple(spark.range(1).select(G.content_frame(F.lit(v).cast(kind) if v else F.array().cast(kind), F.lit(h).cast(kind) if h else F.array().cast(kind), F.lit(w), F.lit(height)).alias("f")).first().f)

    assert frame([30, 100, 1000, 1950], [60, 90, 1400, 2700]) == (30, 60, 1920, 2640)
    assert frame([], []) == (47, 93, 1901, 2623)
    one = spark.range(1).select(G.row_dividers(F.array(F.lit(1)), F.lit(10), F.lit(25)).alias("d")).first().d
    assert one == [10, 12, 15, 18, 20, 22, 25, 28, 30, 32, 35]  # halves go to the even number


def test_a_search_worth_asking():
    assert not S.worth_asking("a") and not S.worth_asking(" ", None, "") and S.worth_asking("ab") and S.worth_asking("", None, 3)


def test_a_lost_checkpoint_loses_nothing(spark, tmp_path):
    a = spark.createDataFrame([("k", 1, "old"), ("m", 1, "m")], "key string, n long, v string")
    a.coalesce(1).write.parquet(str(tmp_path / "in/a"))
    read = lambda part: spark.readStream.schema(a.schema).parquet(str(tmp_path / f"in/{part}"))
    run = lambda part: {r.key: r.v for r in ingest(read(part), str(tmp_path / "t"), str(tmp_path / "log"), "key", ["n"]).collect()}
    assert run("*") == {"k": "old", "m": "m"}
    spark.createDataFrame([("k", 2, "new")], a.schema).coalesce(1).write.parquet(str(tmp_path / "in/b"))
    assert run("*") == {"k": "new", "m": "m"}
    shutil.rmtree(tmp_path / "log")
    spark.createDataFrame([("m", 5, "late")], a.schema).coalesce(1).write.parquet(str(tmp_path / "in/c"))
    assert run("c") == {"k": "new", "m": "late"}


def test_entry_points_over_a_folder(spark, tmp_path):
    from cardloom import api

    for part, voters in ((1, [{"name": "A"}, {"name": "B", "valid": False}]), (2, [])):
        folder = tmp_path / "Far_East" / "7_Elm_Town" / f"part_{part}" / "json"
        folder.mkdir(parents=True)
        (folder / "voters.json").write_text(json.dumps({"source": "s", "voters": voters} | ({"validCount": 5, "extractedTotal": 6, "expectedTotal": 9} if part == 2 else {})))
    (tmp_path / "loose").mkdir()
    (tmp_path / "loose" / "x.json").write_text(json.dumps({"source": "s", "voters": []}))
    ledger, changes = api.backfill(spark, str(tmp_path))
    assert sorted((r.districtFolder, r.asmblyNo, r.partNo, r.validCount, r.extractedTotal, r.expectedTotal) for r in ledger.collect()) == [("Far_East", 7, 1, 1, 2, None), ("Far_East", 7, 2, 5, 6, 9)]
    assert tuple(changes.first()) == (2, 0, 1)
    assert tuple(api.backfill(spark, str(tmp_path), ledger)[1].first()) == (0, 2, 1)
    regions = spark.createDataFrame([("S", "State", "Far East", "1", 7, "Elm Town"), ("S", "State", "Far East", "1", 8, "Oak")], "state string, stateName string, districtName string, districtCd string, asmblyNo long, name string")
    listed = spark.createDataFrame([(f"/d/Far_East/7_Elm/part_{n}.pdf",) for n in (1, 2, 3)], "path string")
    tree = api.coverage(regions, ledger, listed).first()
    assert (tree.scanned, tree.total, tree.pending, [a.total for a in tree.assemblies]) == (2, 703, 701, [3, 700])
    records = spark.createDataFrame([(1, "p", 1, False, ["missing_epic"]), (2, "p", 2, True, []), (3, "q", 1, False, ["missing_age", "missing_gender"])], "k long, part string, page long, valid boolean, errors array<string>")
    after, report = api.retry(records, records.withColumn("valid", F.lit(True)))
    assert {r.k: r.valid for r in after.collect()} == {1: True, 2: True, 3: False}
    assert sorted(map(tuple, report.collect()), key=str) == sorted([("p", 1, 1, 2, 1, 0), (None, 1, 1, 2, 1, 0)], key=str)
