"""Payload files: envelopes, order, empty parts, and what a failed task leaves."""

from __future__ import annotations

import csv
import json
import os

import pytest

from cardloom import api
from cardloom.operators import coverage as C
from cardloom.schema import FULL, PUBLIC
from cardloom.sources import files
from cardloom.sources.payload_sink import PartWriter, write_parts
from pyspark.sql import Row
from pyspark.sql import functions as F

RECORDS = "path string, serialNo long, name string, page long, confidence double, boundingBoxes array<struct<text:string,confidence:double,bbox:array<array<double>>>>, valid boolean, errors array<string>"


def test_parts_are_files_with_envelopes(spark, tmp_path):
    rows = [("D/1_X/part_1", 2, 'quo"te, comma', 1, 0.98765, [("t", 0.12345, [[1.0, 2.0]])], True, []), ("D/1_X/part_1", None, "no serial", 1, None, None, False, ["missing_serial"]), ("D/1_X/part_1", 1, "línea\nzwei", 2, 0.5, [], True, []), ("elsewhere", 9, "x", 1, 1.0, [], True, [])]
    parts = spark.createDataFrame([("D/1_X/part_1", "a.pdf", 1, {"1": "voter"}), ("D/1_X/part_2", "b.pdf", 2, None)], "path string, source string, partNo long, pageTypes map<string,string>")
    write_parts(spark.createDataFrame(rows, RECORDS), parts, str(tmp_path))
    payload = json.loads((tmp_path / "D/1_X/part_1/json/voters.json").read_text())
    assert {k: v for k, v in payload.items() if k != "voters"} == {"source": "a.pdf", "partNo": 1, "pageTypes": {"1": "voter"}}
    assert [v["name"] for v in payload["voters"]] == ["línea\nzwei", 'quo"te, comma', "no serial"]
    assert list(payload["voters"][1]) == FULL.fieldNames() and payload["voters"][1]["confidence"] == 0.9876 and payload["voters"][1]["boundingBoxes"] == [{"text": "t", "confidence": 0.1234, "bbox": [[1.0, 2.0]]}]
    with open(tmp_path / "D/1_X/part_1/csv/voters.csv", newline="") as f:
        table = list(csv.reader(f))
    assert table[0] == PUBLIC.fieldNames() and [r[2] for r in table[1:]] == ["línea\nzwei", 'quo"te, comma', "no serial"]
    assert json.loads((tmp_path / "D/1_X/part_2/json/voters.json").read_text()) == {"source": "b.pdf", "partNo": 2, "pageTypes": None, "voters": []}
    assert (tmp_path / "D/1_X/part_2/csv/voters.csv").read_text() == ",".join(PUBLIC.fieldNames()) + "\n"
    assert not [f for _, _, fs in os.walk(tmp_path) for f in fs if f.startswith(".voters")] and not (tmp_path / "elsewhere").exists()
    back = files.saved_records(files.read_payloads(spark, str(tmp_path)))
    assert sorted((r.serialNo or 0, r.valid) for r in back.collect()) == [(0, False), (1, True), (2, True)]
    assert files.read_registry_csv(spark, str(tmp_path / "D/1_X/part_2")).count() == 0
    write_parts(spark.createDataFrame([], RECORDS), parts.filter("partNo = 1"), str(tmp_path))  # a part that is written again replaces its files
    assert json.loads((tmp_path / "D/1_X/part_1/json/voters.json").read_text())["voters"] == []


def test_a_failed_task_leaves_nothing(tmp_path):
    def lines():
        yield Row(path="p", json="{}", csv="h")
        yield Row(path="p", json='{"a":1}', csv="1")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        PartWriter(str(tmp_path)).write(lines())
    assert not [f for _, _, fs in os.walk(tmp_path) for f in fs]
    writer = PartWriter(f"file://{tmp_path}")
    done = writer.write(iter([Row(path="p", json="{}", csv="h"), Row(path="p", json="1", csv="1"), Row(path="q", json='{"x": 2}', csv="h")]))
    assert len(done.files) == 4 and not (tmp_path / "p/json/voters.json").exists()
    writer.commit([done, None])
    assert json.loads((tmp_path / "p/json/voters.json").read_text()) == {"voters": [1]} and json.loads((tmp_path / "q/json/voters.json").read_text()) == {"x": 2, "voters": []}


def test_source_keys_and_folders_that_differ_in_case(spark):
    keys = spark.createDataFrame([("/d/Far_East/7_Elm/part_3.pdf",), ("/x/roll.v2.pdf",), ("bare",), (".hidden",), (None,)], "p string").select(C.source_key(F.col("p")).alias("k"))
    assert [r.k for r in keys.collect()] == ["Far_East/7_Elm/part_3.pdf", "roll.v2.pdf", "bare.pdf", ".hidden.pdf", None]
    regions = spark.createDataFrame([("S", "State", "Far East", "1", n, f"Elm {n}") for n in (7, 8)], "state string, stateName string, districtName string, districtCd string, asmblyNo long, name string")
    ledger = spark.createDataFrame([("FAR_EAST", 7, 1), ("far_east", 7, 2), ("Far_East", 8, 1), ("FAR_EAST", 8, 2)], "districtFolder string, asmblyNo long, partNo long")
    tree = api.coverage(regions, ledger, spark.createDataFrame([], "path string")).first()
    assert {a.asmblyNo: a.scanned for a in tree.assemblies} == {7: 1, 8: 1}  # one folder stands for 7, its own for 8
