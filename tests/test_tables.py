"""CSV tables by their headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.schema import PUBLIC, REGISTRY
from cardloom.sources import files
from cardloom.sources.tables import CORRUPT, csv_report, header_names, tables_by_header, typed, widened


def part(folder, name, text):
    path = folder / name / "csv"
    path.mkdir(parents=True)
    (path / "voters.csv").write_text(text)


def orders(tmp_path):
    """Three orders of columns, one without age, one with a column of its own."""
    part(tmp_path, "p1", "name,epic,serialNo,age\nAnu,ABC1,5,41\nBo,,6,x\n")
    part(tmp_path, "p2", 'serialNo,houseNo,name\n7,007,"Cy, ""the"" elder"\n')
    part(tmp_path, "p3", "note,age,name,serialNo\n12,30,Di,8\n1.5,31,Ed,9\n")
    part(tmp_path, "p4", "name,epic,serialNo,age\nFi,DEF2,10,50\n")
    part(tmp_path, "p5", "name\n")


def test_columns_go_by_name_in_any_order(spark, tmp_path):
    orders(tmp_path)
    got = {r.name: r for r in files.read_registry_csv(spark, str(tmp_path)).collect()}
    assert {n: (r.serialNo, r.epic, r.age, r.houseNo, r.relationType) for n, r in got.items()} == {
        "Anu": (5, "ABC1", 41, None, None), "Bo": (6, None, None, None, None), 'Cy, "the" elder': (7, None, None, "007", None), "Di": (8, None, 30, None, None), "Ed": (9, None, 31, None, None), "Fi": (10, "DEF2", 50, None, None),
    }
    part_rows = files.read_parts_csv(spark, str(tmp_path))
    assert part_rows.columns == PUBLIC.fieldNames() and {r.name for r in part_rows.collect()} == set(got)


def test_a_scan_per_header_and_supertypes(spark, tmp_path):
    orders(tmp_path)
    rows = tables_by_header(spark, str(tmp_path), known=("epic",))
    assert set(rows.columns) == {"epic", "name", "serialNo", "age", "houseNo", "note", CORRUPT, "_file"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 4  # p1 and p4 are one
    kinds = dict(widened(rows, keep=("houseNo",)).dtypes)
    assert (kinds["serialNo"], kinds["note"], kinds["age"], kinds["houseNo"]) == ("bigint", "double", "string", "string")
    assert {r.name: r.note for r in widened(rows).filter("note is not null").collect()} == {"Di": 12.0, "Ed": 1.5}
    assert widened(rows.select(CORRUPT)).columns == [CORRUPT]


def test_rows_of_another_length_are_kept_and_counted(spark, tmp_path):
    part(tmp_path, "p1", "serialNo,name,age\n1,Anu,20\n2,Bo\n3,Cy,30,more\nx,Di,y\n")
    part(tmp_path, "p2", "age,serialNo,name\n40,5,Ed\n")
    rows = tables_by_header(spark, str(tmp_path))
    got = {r.name: (r.serialNo, r.age) for r in typed(rows, REGISTRY).collect()}
    assert got == {"Anu": (1, 20), "Bo": (2, None), "Cy": (3, 30), "Di": (None, None), "Ed": (5, 40)}
    report = {r._file.split("/")[-3]: (r.rows, r.corrupt, r.bad_cells) for r in csv_report(rows, REGISTRY).collect()}
    assert report == {"p1": (4, 2, 2), "p2": (1, 0, 0)}


def test_odd_headers(spark, tmp_path):
    assert header_names('﻿a,"b,c",,a,a') == ["a", "b,c", "column_3", "a_duplicated_0", "a_duplicated_1"]
    assert header_names("") == []
    (tmp_path / "x.csv").write_text("﻿name,Name,a.b,name\nAnu,other,1,twice\n")
    (tmp_path / "y.csv").write_text("NAME,_file\nupper,z\n")
    row = {r.name: r for r in tables_by_header(spark, str(tmp_path), known=("name",)).collect()}
    assert row["Anu"].Name_3 == "other" and row["Anu"]["a.b"] == "1" and row["Anu"].name_duplicated_0 == "twice"
    assert row[None].NAME_2 == "upper" and row[None]._file_2 == "z" and row[None]._file.endswith("y.csv")


def test_no_files_and_long_lines(spark, tmp_path):
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "a.txt").write_text("x")
    assert tables_by_header(spark, str(tmp_path), known=("name",)).count() == 0
    assert files.read_registry_csv(spark, str(tmp_path)).schema.fieldNames() == REGISTRY.fieldNames()
    (tmp_path / "m.csv").write_text('name,epic\n"two\nlines",E\n')
    assert [r.name for r in tables_by_header(spark, str(tmp_path), multiline=True).collect()] == ["two\nlines"]


def test_split_files_have_one_header(spark, tmp_path):
    text = "name,serialNo\n" + "".join(f"n{i},{i}\n" for i in range(5000))
    (tmp_path / "big.csv").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = tables_by_header(spark, str(tmp_path))
        assert rows.agg(F.count("*"), F.sum(F.col("serialNo").cast("long"))).first()[:] == (5000, 4999 * 2500)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
