"""Versions of an ingested table: what a batch touches, what is kept, and what a batch that runs again does."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cardloom.streaming import ingest as I

SCHEMA = "key string, n long, v string"


def put(spark, table, batch, rows, stream="s"):
    I.replace_batch(spark.createDataFrame(rows, SCHEMA), batch, table, "key", ["n"], stream)
    return {r.key: r.v for r in I.read_table(spark, table, spark.createDataFrame([], SCHEMA).schema).collect()}


def test_batches_touch_their_buckets_only(spark, tmp_path):
    table = str(tmp_path / "t")
    every = {f"k{i}": "old" for i in range(200)}
    assert put(spark, table, 0, [(k, 1, v) for k, v in every.items()]) == every
    for n in range(1, 7):
        every["k7"] = f"new{n}"
        assert put(spark, table, n, [("k7", n, f"new{n}"), ("k7", n - 1, "older")]) == every
    held = {name: sorted(x for x in os.listdir(f"{table}/{name}") if x.startswith("_bucket")) for name in os.listdir(table)}
    assert len(held["v0_s_0"]) == I.BUCKETS - 1  # all but the bucket that newer versions have replaced
    assert sorted(len(v) for k, v in held.items() if k != "v0_s_0") == [1] * I.KEPT


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, 0, [("a", 1, "a0"), ("b", 1, "b0")])
    once = put(spark, table, 1, [("a", 2, "a1"), ("c", 1, "c1")])
    assert put(spark, table, 1, [("a", 2, "a1"), ("c", 1, "c1")]) == once == {"a": "a1", "b": "b0", "c": "c1"}
    assert put(spark, table, 0, [("a", 9, "restarted")], "other") == {"a": "restarted", "b": "b0", "c": "c1"}


def test_an_unfinished_version_does_not_count(spark, tmp_path):
    table = str(tmp_path / "t")
    put(spark, table, 0, [("a", 1, "a0")])
    put(spark, table, 1, [("a", 2, "a1")])
    os.remove(f"{table}/v1_s_1/_SUCCESS")
    assert {r.v for r in I.read_table(spark, table, spark.createDataFrame([], SCHEMA).schema).collect()} == {"a0"}
    assert put(spark, table, 1, [("a", 2, "a1")]) == {"a": "a1"}


def test_last_rows_of_hot_keys_and_null_keys(spark):
    rows = spark.createDataFrame([("k", n, f"v{n}") for n in range(500)] + [(None, 1, "x"), (None, None, "y"), ("m", None, "z")], SCHEMA)
    got = {(r.key, r.v) for r in I.latest(rows, "key", ["n"]).collect()}
    assert got == {("k", "v499"), (None, "x"), ("m", "z")}
    plan = I.latest(rows, "key", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") >= 2
    assert I.latest(rows.select("key", "n", F.array("v").alias("v")), "key", ["n"]).count() == 3


OUTCOMES = "districtFolder string, asmblyNo long, partNo long, validCount long, extractedTotal long, expectedTotal long, readAt long, ok boolean"


def test_the_ledger_as_a_stream_equals_the_batch(spark, tmp_path):
    from cardloom.streaming import ledger

    import random

    rng = random.Random(3)
    schema = spark.createDataFrame([], OUTCOMES).schema
    rows = [("D", 1, rng.randint(1, 30), rng.randint(0, 3), 9, rng.choice([None, 10]), n, rng.random() < 0.8) for n in range(400)]
    rows += [(None, 1, 1, 1, 1, 1, 900, True), ("D", None, 1, 1, 1, 1, 901, True), ("D", 1, 31, 1, 1, 1, 902, None), ("E", 1, 1, None, None, None, 903, True)]
    rng.shuffle(rows)
    table, log = str(tmp_path / "t"), str(tmp_path / "log")
    put = lambda part, some: spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{part}"))
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    names = ["entry", "validCount", "extractedTotal", "expectedTotal"]
    shown = lambda df: sorted((tuple(r) for r in df.select(*names).collect()), key=str)
    for n in range(3):
        put(f"a{n}", rows[n::4])
    ledger.run(stream(), table, log)
    put("b", rows[3::4])
    after = shown(ledger.run(stream(), table, log))
    assert after == shown(ledger.from_batch(spark.createDataFrame(rows, schema)))
    assert len(after) == 31
    before = sorted(os.listdir(table))
    put("c", [("D", 1, 5, 99, 99, 99, 1, True), ("D", 1, 5, 1, 1, 1, 10_000, False)])  # older, and not ok: nothing changes
    assert shown(ledger.run(stream(), table, log)) == after
    held = lambda name: [x for x in os.listdir(f"{table}/{name}") if x.startswith("_bucket")]
    assert all(not held(v) for v in set(os.listdir(table)) - set(before))
    assert shown(ledger.run(stream(), table, str(tmp_path / "new log"))) == after  # a lost checkpoint
