"""Search by postings gives the rows of a scan."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cardloom.operators import postings as P
from cardloom.operators import search as S

SCHEMA = "name string, relativeName string, epic string, houseNo string, section string, sourcePdf string, n long"


def rows(count=400):
    rng = random.Random(4)
    syllables = ["an", "ra", "vi", "ku", "İz", "ß", "日本", "o'", "%", "_", "sha", "ELM"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    return [(word(), rng.choice([None, word()]), f"ABC{rng.randint(0, 99):07d}", rng.choice([None, "", str(rng.randint(1, 30))]), word() + " " + word(), f"D/{i % 7}_X/part_{i % 5}.pdf", i) for i in range(count)]


def test_same_rows_as_a_scan(spark, tmp_path):
    registry = spark.createDataFrame(rows() + rows(30), SCHEMA).repartition(3)
    index = P.build(registry, str(tmp_path / "index"))
    queries = ["ravi", "RAVI an", "abc000001", "part_3 elm", "%", "_", "an", "a b", "日本", "日本ra", "o'", "x" * 40, "izra", "ßan", "7_x/part_3.pdf", "ABC0000012 ra", "ra  ra", "vi\tku"]
    for q in queries:
        want = sorted(r.n for r in registry.filter(S.matches(q)).collect())
        assert sorted(r.n for r in index.search(q).collect()) == want, q
    assert index.search("").count() == 0 and index.search(None).count() == 0 and index.search("  ").count() == 0
    assert index.search("", (F.col("n") < 5,)).count() == 10 and index.search("elm", (F.col("n") < 100,)).count() == registry.filter(S.matches("elm")).filter("n < 100").count()
    assert index.search("elm").columns == registry.columns


def test_candidates_are_few(spark, tmp_path):
    registry = spark.createDataFrame([(f"common name{i:04d}", None, None, None, None, f"D/1_X/part_{i % 9}.pdf", i) for i in range(3000)], SCHEMA)
    index = P.build(registry, str(tmp_path / "index"))
    report = {r.query: r for r in index.report(["name0042", "common", "na", "name0042 common", "nothing here"]).collect()}
    assert (report["name0042"].found, report["name0042 common"].found, report["common"].found) == (1, 1, 3000)
    assert report["name0042"].candidates <= 60 and report["name0042 common"].candidates <= 60 and report["common"].candidates == 3000
    assert report["na"].candidates is None and report["na"].found == 3000 and report["nothing here"].candidates == 0
    plan = index.search("name0042")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()  # slices without candidates are not read


def test_an_empty_registry(spark, tmp_path):
    index = P.build(spark.createDataFrame([], SCHEMA), str(tmp_path / "index"))
    assert index.search("anything").count() == 0
