"""The refill ladder: missing fields are read again by rank, from cheap to dear, and a rank is asked only for what is still missing.

A rank reads with a function of columns, which may be a Python one (character recognition, say).  For records that lack nothing it could
give, it gets nulls: such a function has nothing to do for them, and its results are not looked at.  So a ladder is one projection after
the other over the same rows: no record is joined, shuffled or read twice, and the work of a rank shrinks with what the ones before it found."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions import text as X

#: Fields that a text may fill, with the rule that reads them.
RULES: dict[str, Callable[[Column], Column]] = {"epic": X.identifier, "houseNo": X.house, "age": X.age, "gender": X.gender}
#: What is kept of every text that was read.
CONSULTED = "array<struct<rank:string,text:string>>"


@dataclass(frozen=True)
class Rank:
    """name: of the rank.  fields: what it may fill.  read: its text, from the columns of `source`; each is null where nothing is to be read."""

    name: str
    fields: tuple[str, ...]
    read: Callable[..., Column]
    source: tuple[str, ...]

    def lacking(self) -> Column:
        """Whether a record lacks a field that this rank could fill."""
        out = F.lit(False)
        for f in self.fields:
            out = out | F.col(f).isNull()
        return out


def climbed(records: DataFrame, ranks: list[Rank]) -> DataFrame:
    """records (epic, houseNo, age, gender, what the ranks read from, and more) with missing fields filled rank by rank, nothing being
    overwritten; `consulted` has the rank and text of everything that was read, also where it filled nothing, and those texts
    join `raw`, if there is one."""
    out = records if "consulted" in records.columns else records.withColumn("consulted", F.array().cast(CONSULTED))
    for n, rank in enumerate(ranks):
        asked, text = f"_asked{n}", f"_text{n}"
        out = out.withColumn(asked, rank.lacking())
        # a condition that is always true but not deterministic: the text is read once, and not again wherever it is used
        once = F.col(asked) & (F.monotonically_increasing_id() >= 0)
        out = out.withColumn(text, F.when(once, X.as_text(rank.read(*[F.when(F.col(asked), F.col(c)) for c in rank.source]))))
        some = F.when(F.col(text).isNotNull(), F.array(F.struct(F.lit(rank.name).alias("rank"), F.col(text).alias("text")))).otherwise(F.array().cast(CONSULTED))
        new = {f: F.coalesce(F.col(f), F.when(F.col(asked), RULES[f](F.col(text)))) for f in rank.fields}
        if "raw" in records.columns:
            new["raw"] = F.concat(F.coalesce("raw", F.array().cast("array<string>")), F.array_compact(F.array(F.col(text))))
        out = out.withColumns(new | {"consulted": F.concat("consulted", some)}).drop(asked, text)
    return out


def rank_counts(records: DataFrame, ranks: list[Rank]) -> DataFrame:
    """rank, place, read: how many texts each rank read, also the ones that read none."""
    every = records.sparkSession.createDataFrame([(r.name, n) for n, r in enumerate(ranks)], "rank string, place int")
    read = records.select(F.explode("consulted.rank").alias("rank")).groupBy("rank").agg(F.count("*").alias("read"))
    return F.broadcast(every).join(read, "rank", "left").select("rank", "place", F.coalesce("read", F.lit(0)).alias("read"))


def card_ranks(read: Callable[[str], Callable[..., Column]], source: tuple[str, ...]) -> list[Rank]:
    """The ranks of a card: strips of the identifier, then of the house and age lines, then further down where a long card has its age.
    read(region) gives the reader of a region of LAYOUT.boxes."""
    steps = [("epic", ("epic",)), ("epic_fallback", ("epic",)), ("house", ("houseNo",)), ("age", ("age", "gender")), ("age_fallback", ("age", "gender")), ("age_crowded", ("age", "gender"))]
    return [Rank(name, fields, read(name), source) for name, fields in steps]
