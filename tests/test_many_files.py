"""Folders listed and read by tasks: the same rows as Spark's readers give, and no name of a file in the driver."""

from __future__ import annotations

import json
import pickle

from cardloom.plans import sources
from cardloom.sources import files
from cardloom.sources.many_files import listed
from cardloom.sources.payload_sink import PartWriter
from cardloom.sources.tables import tables_by_header, tables_of
from pyspark.sql import Row

TABLES = {
    "a/one.csv": 'name,epic\nAnu,007\n"Rao, ""R""",8\n\n   \nshort\nlong,1,2,3\n"",x\n', "a/two.csv": "epic,Name,name\r\n9,N,n\r\n,,\r\n", "b/c/three.csv": "﻿name,epic\nÄ,é\n",
    "b/c/head.csv": "note,name\n", "b/empty.csv": "", "b/tiny.csv": "epic\n1\n", "b/last.csv": "name,epic\nno end of line,5", "b/_left.csv": "name\nx\n", "_gone/four.csv": "name\ny\n", ".h/five.csv": "name\nz\n", "b/_k=1/six.csv": "name,epic\nkept,6\n", "b/other.txt": "name\nno\n",
}


def _folder(tmp_path) -> str:
    for name, text in TABLES.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    return f"file:{tmp_path}"


def test_listing_is_that_of_sparks_readers(spark, tmp_path):
    folder = _folder(tmp_path)
    for glob in ("*.csv", "t*.csv", "*"):
        own = {(f"{r.folder}/{r.path}", r.length) for r in listed(spark, folder, glob).filter("length > 0").collect()}  # Spark's leaves out empty files
        assert own == {(r.path, r.length) for r in files.listing(spark, folder, glob).collect()}
        assert len(own) > 1
    plain = listed(spark, f"{tmp_path}/", "*.csv").collect()
    assert {r.path for r in plain} == {n for n in TABLES if n.endswith(".csv") and not n.startswith(("_gone", ".h", "b/_left"))}
    (tmp_path / "none").mkdir()
    assert listed(spark, str(tmp_path / "none")).count() == 0 and files.payloads_of(listed(spark, str(tmp_path / "none"))).count() == 0 and tables_of(listed(spark, str(tmp_path / "none")), known=("name",)).columns == ["name", "_corrupt_record", "_file"]


def test_tables_of_listed_files_are_those_by_header(spark, tmp_path):
    folder = _folder(tmp_path)
    rows = lambda d: sorted(map(repr, d.select(sorted(d.columns)).collect()))
    for least in (0, 10):
        got = tables_of(listed(spark, folder, "*.csv"), known=("name", "epic"), least_bytes=least)
        want = tables_by_header(spark, folder, known=("name", "epic"), least_bytes=least)
        assert got.columns == want.columns and rows(got) == rows(want) and got.count() >= 8


def test_payloads_of_listed_files(spark, tmp_path):
    texts = {"p/1.json": json.dumps({"source": "a", "partNo": 1, "pageTypes": {"1": "voter"}, "other": 3, "voters": [{"name": "línea\nzwei", "serialNo": 7, "valid": True}, {"name": None}]}, indent=1), "p/2.json": '{"partNo": "no number", "source": "b", "voters": []}', "q/3.json": "no json", "q/4.json": "", "q/5.json": "{}"}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    folder = f"file:{tmp_path}"
    got, want = files.payloads_of(listed(spark, folder, "*.json")).orderBy("path"), files.read_payloads(spark, folder).orderBy("path")
    assert got.columns == want.columns and got.collect() == want.collect() and got.count() == 4


def test_a_tasks_message_does_not_grow_with_its_parts(tmp_path):
    writer, sizes = PartWriter(str(tmp_path)), []
    for n in (1, 300):
        done = writer.write(iter([Row(path=f"D/part_{k}", json="{}", csv="h") for k in range(n)]))
        assert len(done.files) == 2 * n
        sizes.append(len(pickle.dumps(done)))
        if n == 1:
            writer.abort([done, None])
            assert not [p for p in tmp_path.rglob("*") if p.is_file()]
        else:
            writer.commit([done, None, writer.write(iter([]))])
    assert sizes[0] == sizes[1]
    assert {p.name for p in tmp_path.rglob("*") if p.is_file()} == {"voters.json", "voters.csv"} and len(list(tmp_path.rglob("voters.json"))) == 300


def test_part_files_are_not_known_to_the_driver(spark, sf):
    assert not [f for f in sources.payload_round_trip(spark, sf).inputFiles() if "voters." in f]
