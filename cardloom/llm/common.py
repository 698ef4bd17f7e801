"""What the operators of this subpackage share: reading tables, staging results in the shared folder, and small checks."""

from __future__ import annotations

import ctypes
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.sources.staging import shared_root

#: The white space between words, as a Java character class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data folder, by a path that only Spark has to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs neither repeat its work nor depend on executors that may go."""
    spark = df.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all that staged() has written for this application.  Results that read staged tables end with this."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a column's text, modulo: the split into folds that the queries fix.  Null counts as the empty string."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table that must be small; raises beyond the limit instead of flooding the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is not small enough to broadcast")
    return rows


#: Keys that are joined by broadcast, at most: those that hold more than one in HOT_KEYS of all rows.
HOT_KEYS = 4096
#: Rows that one task may get under one key: tables of no more rows are joined as they are.
TASK_ROWS = 1_000_000


def spread_join(left: DataFrame, counted: DataFrame, key: str | list[str], total: int, count: str = "k") -> DataFrame:
    """left with the columns of counted, which has one row per key and, as count, how many of left's rows (total, or fewer) have it.
    Beyond TASK_ROWS, keys of more than total / HOT_KEYS rows - so at most HOT_KEYS keys - are broadcast; only the rows of the others are
    shuffled."""
    key = [key] if isinstance(key, str) else key
    values = [c for c in counted.columns if c not in (*key, count)]
    if total <= TASK_ROWS:
        return left.join(counted.select(*key, *values), key)
    hot = F.col(count) * HOT_KEYS > total
    marked = left.join(F.broadcast(counted.filter(hot).select(*key, F.lit(True).alias("_hot"), *values)), key, "left")
    rest = marked.filter("_hot is null").drop("_hot", *values).join(counted.filter(~hot).select(*key, *values), key)
    return marked.filter("_hot").drop("_hot").unionByName(rest)


#: Rows of texts in an Arrow batch.  Batches are held at once by a task's JVM side and its Python worker.
TEXT_BATCH_ROWS = 500


def with_small_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Arrow batches have at most TEXT_BATCH_ROWS rows: texts are long, and the session's default of 10,000
    rows would cost each task some 100 MB on either side.  Spark reads the setting when the plan runs, so it has to outlast this
    call: it stays lowered in the session."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_BATCH_ROWS:
        conf.set(name, str(TEXT_BATCH_ROWS))
    return df


def trim_memory() -> None:
    """Give freed memory of this Python worker back to the system: workers live on, and share an executor's memory with its JVM."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
