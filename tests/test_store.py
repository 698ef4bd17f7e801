"""Files, the registry, tokens and ingestion."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cardloom.operators import search as S
from cardloom.operators import store as R
from cardloom.sources import files, tokens
from cardloom.streaming.ingest import ingest


def registry(spark):
    rows = [(1, "ABC1234567", "Anu Rao", "Father", "Ravi Rao", "001", 30, "Male", 2, 3, "Elm Town", "A", "Some_District/52_Elm/part_3.pdf"), (None, None, "50% off_er", None, None, None, None, None, 1, 4, "Oak", None, "part_4.pdf")]
    return R.conformed(spark.createDataFrame(rows, "serialNo long, epic string, name string, relationType string, relativeName string, houseNo string, age long, gender string, page long, partNo long, constituency string, section string, sourcePdf string"))


def test_csv_round_trip_keeps_leading_zeros(spark, tmp_path):
    files.write_parts_csv(registry(spark), str(tmp_path / "csv"))
    back = files.read_parts_csv(spark, str(tmp_path / "csv")).orderBy(F.desc("serialNo")).collect()
    assert back[0].houseNo == "001" and back[1].serialNo is None and len(back) == 2


def test_bad_cells_long_and_short_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text("serialNo,epic,name,relationType,relativeName,houseNo,age,gender,page,partNo,constituency,section\nx,E,N\n1,E,N,F,R,H,20,Male,1,2,C,S,more\n")
    got = files.read_parts_csv(spark, str(tmp_path)).orderBy("page").collect()
    assert (got[0].serialNo, got[0].name, got[0].section) == (None, "N", None) and (got[1].serialNo, got[1].section) == (1, "S")


def test_payload(spark, tmp_path):
    box = {"text": "t", "confidence": 0.5, "bbox": [[0.0, 0.0]]}
    (tmp_path / "v.json").write_text(json.dumps({"source": "p", "voters": [{"name": "A", "boundingBoxes": [box, box | {"text": ""}]}, {"name": "B", "page": 4, "valid": False}]}))
    got = files.saved_records(files.read_payloads(spark, str(tmp_path))).orderBy("name").collect()
    assert (got[0].page, got[0].valid, len(got[0].boundingBoxes)) == (0, True, 1) and (got[1].page, got[1].valid, got[1].boundingBoxes) == (4, False, [])


def test_regions_and_listing(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"state": "S", "districts": [{"districtName": "D", "assemblies": [{"asmblyNo": 1, "name": "A"}]}, {"districtName": "E", "assemblies": []}]}))
    assert [(r.districtName, r.asmblyNo) for r in files.read_regions(spark, str(tmp_path / "m.json")).orderBy("districtName").collect()] == [("D", 1), ("E", None)]
    folder = tmp_path / "D" / "1_A"
    folder.mkdir(parents=True)
    for n in ("part_10.pdf", "part_2.pdf", "cover.pdf"):
        (folder / n).write_bytes(b"x")
    listed = files.listing(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[1] for r in files.naturally_sorted(listed).collect()] == ["part_2.pdf", "part_10.pdf", "cover.pdf"]
    assert {r.partNo for r in files.downloaded_parts(listed).collect()} == {2, 10}
    assert files.read_ledger(spark, None).isEmpty()


def test_empty_replacement_clears_its_key(spark):
    old = registry(spark)
    keys = spark.createDataFrame([("part_4.pdf",)], "sourcePdf string")
    assert [r.sourcePdf for r in R.replaced(old, old.limit(0), keys).collect()] == ["Some_District/52_Elm/part_3.pdf"]


def test_search_is_literal(spark):
    reg = registry(spark)
    assert S.search(reg, "50% OFF_er")[0].count() == 1
    assert S.search(reg, "a_u")[0].count() == 0
    assert S.search(reg, "")[0].count() == 0
    assert S.search(reg, "", district="Some District")[1].count() == 1
    assert S.search(reg, "", assembly=5)[0].count() == 0  # 52 is another assembly
    assert S.search(reg, "rao elm", part=3)[0].count() == 1


def test_token_source(spark):
    pages = spark.createDataFrame([("d", 1, b"10 20 Name : Anu\n10 40 Age : 20"), ("d", 2, b"broken")], "doc string, page int, content binary")
    got = tokens.tokens_from(pages, tokens.text_card_source).orderBy("page", "seq").collect()
    assert [(r.page, r.text) for r in got] == [(1, "Name : Anu"), (1, "Age : 20"), (2, None)]


def test_ingest_is_idempotent(spark, tmp_path):
    a = spark.createDataFrame([("k", 1, "old"), ("m", 1, "m")], "key string, n long, v string")
    a.coalesce(1).write.parquet(str(tmp_path / "in/a"))
    read = lambda: spark.readStream.schema(a.schema).parquet(str(tmp_path / "in/*"))
    run = lambda: {r.key: r.v for r in ingest(read(), str(tmp_path / "t"), str(tmp_path / "log"), "key", ["n"]).collect()}
    assert run() == {"k": "old", "m": "m"}
    spark.createDataFrame([("k", 2, "new"), ("k", 3, "newest")], a.schema).coalesce(1).write.parquet(str(tmp_path / "in/b"))
    assert run() == {"k": "newest", "m": "m"}
    assert run() == {"k": "newest", "m": "m"}
