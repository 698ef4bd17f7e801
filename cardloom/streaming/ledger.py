"""The ledger as a stream: outcomes of parts come in, in any order and more than once, and only what changes is written.

The last good reading of every part is state, kept in the checkpoint.  An outcome counts if it is ok, its part is known and no later one
has been seen; one that only repeats the figures moves the state on and writes nothing.  Changes go to a table by
`ingest.replace_batch`, which rewrites the buckets they touch, so a micro-batch costs what it changes, whatever the size of the ledger.  A
stream that is started again goes on from its checkpoint; one whose checkpoint was lost reads everything again and ends with the same table."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardloom.operators.coverage import ledger_key
from cardloom.streaming.ingest import latest, read_table, replace_batch

KEY = ["districtFolder", "asmblyNo", "partNo"]
FIGURES = ["validCount", "extractedTotal", "expectedTotal"]
#: The table of the ledger: `entry` is the key in one piece, `readAt` says which of two outcomes is later, `change` what became of it.
ENTRIES = T.StructType([
    T.StructField("districtFolder", T.StringType()), T.StructField("asmblyNo", T.LongType()), T.StructField("partNo", T.LongType()),
    *[T.StructField(f, T.LongType()) for f in FIGURES], T.StructField("readAt", T.LongType()), T.StructField("change", T.StringType()), T.StructField("entry", T.StringType()),
])


def _whole(x: object) -> int | None:
    return None if pd.isna(x) else int(x)


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The newest of a part's outcomes in this batch, against the one in its state; a part's rows come in pieces, of which one row is held."""
    old = state.get if state.exists else None
    new = old
    for frame in frames:
        row = frame.loc[frame["readAt"].idxmax()]
        if new is None or int(row["readAt"]) > new[-1]:
            new = (*[_whole(row[f]) for f in FIGURES], int(row["readAt"]))
    if new is None or new == old:
        return
    state.update(new)
    if old is None or new[:-1] != old[:-1]:
        names = [*KEY, *FIGURES, "readAt", "change"]
        values = [*key, *new, "added" if old is None else "updated"]
        yield pd.DataFrame({n: pd.Series([v], dtype=object if isinstance(v, str) else "Int64") for n, v in zip(names, values)})


def usable(outcomes: DataFrame) -> DataFrame:
    """The outcomes that a ledger takes: ok ones of a whole key, with a time."""
    figures = [F.col(f).cast("long").alias(f) for f in FIGURES]
    rows = outcomes.filter("ok").dropna(subset=[*KEY, "readAt"])
    return rows.select("districtFolder", F.col("asmblyNo").cast("long").alias("asmblyNo"), F.col("partNo").cast("long").alias("partNo"), *figures, F.col("readAt").cast("long").alias("readAt"))


def changes(outcomes: DataFrame) -> DataFrame:
    """Of a stream of outcomes (KEY, FIGURES, readAt, ok) the entries that are new or have other figures than before."""
    shape = T.StructType([f for f in ENTRIES.fields if f.name != "entry"])
    kept = T.StructType([f for f in ENTRIES.fields if f.name in (*FIGURES, "readAt")])
    found = usable(outcomes).groupBy(*KEY).applyInPandasWithState(_step, shape, kept, "update", GroupStateTimeout.NoTimeout)
    return found.withColumn("entry", ledger_key(F.col("districtFolder"), F.col("asmblyNo"), F.col("partNo")))


def run(outcomes: DataFrame, table: str, checkpoint: str) -> DataFrame:
    """Take a stream of outcomes to its end into the ledger's table, and read that."""
    spark = outcomes.sparkSession

    def batch(df: DataFrame, n: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        replace_batch(df, n, table, "entry", ["readAt"], stream)

    changes(outcomes).writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return read_table(spark, table, ENTRIES)


def from_batch(outcomes: DataFrame) -> DataFrame:
    """What a stream of all these outcomes leaves, without `change`, in one go."""
    keyed = usable(outcomes).withColumn("entry", ledger_key(F.col("districtFolder"), F.col("asmblyNo"), F.col("partNo")))
    return latest(keyed, "entry", ["readAt"])
