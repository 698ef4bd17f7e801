"""Incremental, idempotent ingestion: each micro-batch of files replaces the keys it holds.

A table is a folder of versions, and a version holds only the buckets (by a hash of the key) that its batch touched; the table is the
newest version of every bucket.  So a batch reads and writes the buckets of its keys and not the table, and buckets that KEPT newer versions
have replaced are deleted."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardloom.operators.store import replaced

#: Buckets of a table, and versions of a bucket that stay: the newest, and the one that a batch which runs again starts from.
BUCKETS, KEPT = 32, 2

Version = tuple[int, str, int]


def _folders(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _path(table: str, version: Version) -> str:
    return f"{table}/v{version[0]}_{version[1]}_{version[2]}"


def _versions(spark: SparkSession, table: str) -> dict[Version, set[int]]:
    """(number, stream, batch) of the finished versions of a table, in order, with the buckets that each holds."""
    names = [re.fullmatch(r"v(\d+)_([^_]+)_(\d+)", name) for name in _folders(spark, table)]
    out = {}
    for version in sorted((int(n[1]), n[2], int(n[3])) for n in names if n):
        inside = _folders(spark, _path(table, version))
        if "_SUCCESS" in inside:
            out[version] = {int(x.split("=")[1]) for x in inside if x.startswith("_bucket=")}
    return out


def _newest(known: dict[Version, set[int]], table: str, buckets: set[int] | None = None) -> list[str]:
    """The folders of the newest version of each bucket."""
    last = {b: v for v, held in known.items() for b in held}
    return [f"{_path(table, v)}/_bucket={b}" for b, v in sorted(last.items()) if buckets is None or b in buckets]


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of each key the last row by order.  Tasks keep one row a key before the shuffle, so a key of many rows is no large task."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(whole, F.struct(*[F.col(c) for c in order])).alias("_row")).select("_row.*")


def replace_batch(batch: DataFrame, batch_id: int, table: str, key: str, order: list[str], stream: str = "batch") -> None:
    """The next version of the buckets that the batch touches: those before without the batch's keys, and of each key in the batch its last
    row by order.  A version is named by its number, the stream (the id in its checkpoint) and the batch.  A batch of a stream that runs
    again replaces its own version; a stream that starts anew, as its checkpoint was lost, goes on after the last version of all.  So a
    lost driver or checkpoint loses and doubles nothing."""
    spark = batch.sparkSession
    last = latest(batch, key, order)
    touched = {r[0] for r in batch.select(_bucket(key)).distinct().collect()}  # BUCKETS at most
    known = _versions(spark, table)
    own = next((v for v in known if v[1:] == (stream, batch_id)), None)
    before = {v: held for v, held in known.items() if own is None or v[0] < own[0]}
    paths = _newest(before, table, touched)
    out = replaced(spark.read.schema(batch.schema).parquet(*paths), last, last, key) if paths else last
    number = own[0] if own else max((v[0] for v in known), default=-1) + 1
    out.withColumn("_bucket", _bucket(key)).write.mode("overwrite").partitionBy("_bucket").parquet(_path(table, (number, stream, batch_id)))
    _clean(spark, table)


def _clean(spark: SparkSession, table: str) -> None:
    """Delete what KEPT newer versions of its bucket have replaced."""
    newer: dict[int, int] = {}
    known = _versions(spark, table)
    for version in reversed(known):
        for b in known[version]:
            newer[b] = newer.get(b, 0) + 1
            if newer[b] > KEPT:
                _delete(spark, f"{_path(table, version)}/_bucket={b}")
        if known[version] and all(newer[b] > KEPT for b in known[version]):
            _delete(spark, _path(table, version))


def read_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    paths = _newest(_versions(spark, table), table)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def ingest(files: DataFrame, table: str, checkpoint: str, key: str, order: list[str]) -> DataFrame:
    """Run a streaming frame to its end into the table, and read the table."""
    spark = files.sparkSession

    def batch(df: DataFrame, n: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]  # one line, written when the stream began
        replace_batch(df, n, table, key, order, stream)

    query = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_table(spark, table, files.schema)
