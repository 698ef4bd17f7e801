"""Cards to records: lines of positioned tokens, the labelled-line fold, merging of readings, headers, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.schema import LAYOUT, Layout

_TEXT = "cast(null as string)"


def grouped_lines(tokens: Column) -> Column:
    """Lines of an array of tokens (x0, y0, cy, height, text): a token joins the last line if its centre is near the centre of
    that line's first token (not its latest: lines don't drift); within a line tokens go from left to right."""
    tolerance = F.greatest(F.lit(8.0), F.element_at(F.array_sort(F.transform(tokens, lambda t: t["height"])), (F.floor(F.size(tokens) / 2) + 1).cast("int")) * 0.6)
    ordered = F.array_sort(F.transform(tokens, lambda t: F.struct(t["y0"].alias("y0"), t["x0"].alias("x0"), t["cy"].alias("cy"), t["text"].alias("text"))))

    def fold(tol: Column) -> Column:
        start = F.array().cast("array<struct<cy:double,of:array<struct<x0:double,n:int,text:string>>>>")

        def step(lines: Column, t: Column) -> Column:
            last = F.try_element_at(lines, F.lit(-1))
            one = lambda n: F.struct(t["x0"].cast("double").alias("x0"), n.alias("n"), t["text"].alias("text"))
            joined = F.concat(F.slice(lines, 1, F.size(lines) - 1), F.array(F.struct(last["cy"].alias("cy"), F.concat(last["of"], F.array(one(F.size(last["of"])))).alias("of"))))
            return F.when((F.size(lines) > 0) & (F.abs(t["cy"] - last["cy"]) <= tol), joined).otherwise(
                F.concat(lines, F.array(F.struct(t["cy"].cast("double").alias("cy"), F.array(one(F.lit(0))).alias("of"))))
            )

        return F.aggregate(ordered, start, step)

    lines = X.bound(tolerance, fold)
    return F.when(F.size(tokens) > 0, F.transform(lines, lambda ln: F.array_join(F.transform(F.array_sort(ln["of"]), lambda t: t["text"]), " "))).otherwise(F.array().cast("array<string>"))


#: What a line may say, in the order in which it is asked: the first that holds is all that counts.
FACTS = {"skip": "boolean", "name": "string", "relation": "string", "relative": "string", "house": "string", "age": "bigint", "gender": "string", "wrap": "string"}
#: Parts a label from its value in a replaced line.
_MARK = "\x01"


def line_facts(line: Column) -> Column:
    """What one line says, whatever stands around it: struct of FACTS.  Each pattern is tried once, and only on lines that none before it fits."""

    def fact(**known: Column) -> Column:
        return F.struct(*[known.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in FACTS.items()])

    def facts(s: Column) -> Column:
        def figures(g: Column) -> Column:
            wrap = F.when(~X.wrap_junk(s), X.without_trailing_serial(X.person(s)))
            return F.when(g["age"].isNotNull() | g["gender"].isNotNull(), fact(skip=F.lit(False), age=g["age"], gender=g["gender"])).otherwise(fact(skip=F.lit(False), wrap=wrap))

        def housed(h: Column) -> Column:
            return F.when(h.isNotNull(), fact(skip=F.lit(False), house=h)).otherwise(X.bound(F.struct(X.age(s).alias("age"), X.gender(s).alias("gender")), figures))

        def related(r: Column) -> Column:
            value = F.substring_index(r, _MARK, -1)
            label = F.initcap(F.substring_index(r, _MARK, 1))
            house = F.when(s.rlike(X.HOUSE) | s.rlike(X.HOUSE_SHORT), X.house(s))
            return F.when(r != s, fact(skip=F.lit(False), relation=label, relative=F.nullif(X.person(value), F.lit("")))).otherwise(X.bound(house, housed))

        named = s.rlike(X.NAME) & ~s.rlike(X.RELATIVE_WORD)
        relation = X.bound(F.regexp_replace(s, X.RELATION, f"$1$2{_MARK}$3"), related)
        return F.when(X.skipped_line(s), fact(skip=F.lit(True))).when(named, fact(skip=F.lit(False), name=X.person(F.regexp_extract(s, X.NAME, 1)))).otherwise(relation)

    return X.bound(F.trim(line), facts)


def labelled_fields(lines: Column) -> Column:
    """struct<name, relationType, relativeName, houseNo, age, gender> of a card's lines.  The first value of a field wins; a line
    without a label continues the name or relative that the last labelled line began."""
    start = F.struct(
        F.expr(_TEXT).alias("name"), F.expr(_TEXT).alias("relationType"), F.expr(_TEXT).alias("relativeName"), F.expr(_TEXT).alias("houseNo"),
        F.expr("cast(null as bigint)").alias("age"), F.expr(_TEXT).alias("gender"), F.lit("").alias("state"),
    )

    def step(acc: Column, f: Column) -> Column:
        def now(**changed: Column | str) -> Column:
            names = ("name", "relationType", "relativeName", "houseNo", "age", "gender", "state")
            return F.struct(*[(F.lit(changed[n]) if isinstance(changed.get(n), str) else changed.get(n, acc[n])).alias(n) for n in names])

        first = acc["relationType"].isNull()
        return (
            F.when(f["skip"], now())
            .when(f["name"].isNotNull(), now(name=F.coalesce(acc["name"], f["name"]), state="name"))
            .when(f["relation"].isNotNull(), now(relationType=F.coalesce(acc["relationType"], f["relation"]), relativeName=F.when(first, f["relative"]).otherwise(acc["relativeName"]), state="relative"))
            .when(f["house"].isNotNull(), now(houseNo=F.coalesce(acc["houseNo"], f["house"]), state="house"))
            .when(f["age"].isNotNull() | f["gender"].isNotNull(), now(age=F.coalesce(acc["age"], f["age"]), gender=F.coalesce(acc["gender"], f["gender"]), state="age"))
            .when((acc["state"] == "name") & f["wrap"].isNotNull(), now(name=F.when(acc["name"].isNull(), f["wrap"]).otherwise(X.wrapped(acc["name"], f["wrap"]))))
            .when((acc["state"] == "relative") & f["wrap"].isNotNull(), now(relativeName=F.when(acc["relativeName"].isNull(), f["wrap"]).otherwise(X.wrapped(acc["relativeName"], f["wrap"]))))
            .otherwise(now())
        )

    return F.aggregate(F.transform(lines, line_facts), start, step, lambda acc: acc.dropFields("state"))


def serial_number(tokens: Column, lines: Column, width: Column, height: Column, layout: Layout = LAYOUT) -> Column:
    """From the top left corner of the card, else from the first four lines: one to four digits, alone or before the identifier."""
    number = lambda s: F.coalesce(F.nullif(F.regexp_extract(s, X.SERIAL, 1), F.lit("")), F.nullif(F.regexp_extract(s, X.SERIAL_AND_ID, 1), F.lit("")))
    corner = F.filter(tokens, lambda t: (t["x0"] <= width * layout.serial_corner[0]) & (t["y0"] <= height * layout.serial_corner[1]) & ~t["text"].rlike("(?i)age|gender|name|house"))
    first = lambda xs: F.try_element_at(F.filter(xs, lambda x: x.isNotNull()), F.lit(1))
    return F.coalesce(first(F.transform(corner, lambda t: number(F.trim(t["text"])))), first(F.transform(F.slice(lines, 1, 4), lambda s: number(F.trim(s))))).cast("long")


def parsed_cards(cards: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """cards (card_id, width, height, tokens: array of struct<text, confidence, bbox> in emission order) to records."""
    ys = lambda t: F.transform(t["bbox"], lambda p: p[1])
    xs = lambda t: F.transform(t["bbox"], lambda p: p[0])
    placed = F.transform(
        "tokens",
        lambda t: F.struct(
            t["text"].alias("text"), F.array_min(xs(t)).alias("x0"), F.array_min(ys(t)).alias("y0"),
            (F.aggregate(ys(t), F.lit(0.0), lambda a, y: a + y) / F.size(t["bbox"])).alias("cy"), (F.array_max(ys(t)) - F.array_min(ys(t))).alias("height"),
        ),
    )
    df = cards.withColumn("_placed", placed)
    df = df.withColumn("raw", F.filter(grouped_lines(F.col("_placed")), lambda s: ~s.rlike("(?i)photo|available")))
    ids = F.filter(F.transform("_placed", lambda t: X.identifier(t["text"])), lambda x: x.isNotNull())
    df = df.withColumns({
        "epic": F.coalesce(F.try_element_at(ids, F.lit(1)), X.identifier(F.array_join("raw", " "))),
        "serialNo": serial_number(F.col("_placed"), F.col("raw"), F.col("width"), F.col("height"), layout),
        "fields": labelled_fields(F.col("raw")),
        "confidence": mean_confidence(F.col("tokens")),
    })
    return df.select(*[c for c in cards.columns if c != "tokens"], "serialNo", "epic", "fields.*", "raw", "confidence")


def mean_confidence(tokens: Column) -> Column:
    return F.when(F.size(tokens) > 0, F.aggregate(tokens, F.lit(0.0), lambda a, t: a + F.coalesce(t["confidence"], F.lit(0.0))) / F.size(tokens)).otherwise(F.lit(0.0))


def merged_lines(raw: Column, extra: Column) -> Column:
    """raw and the lines of extra that it lacks; repeats inside extra stay."""
    return F.concat(raw, F.filter(extra, lambda x: (x != "") & ~F.array_contains(raw, x)))


def merged_record(old: str, new: str) -> list[Column]:
    """Columns of a record prefixed by old, completed by a second reading prefixed by new."""
    o, n = (lambda c: F.col(f"{old}{c}")), (lambda c: F.col(f"{new}{c}"))
    return [X.preferred_person(o(c), n(c)).alias(c) for c in ("name", "relativeName")] + [F.coalesce(o(c), n(c)).alias(c) for c in ("relationType", "houseNo", "age", "gender")]


def filled(df: DataFrame, house_text: str = "house_text", age_text: str = "age_text", id_text: str = "epic_text") -> DataFrame:
    """Fills missing epic, houseNo, age and gender from further texts, never overwriting; consulted texts are added to raw."""
    used = F.array_compact(F.array(
        F.when(F.col("epic").isNull(), X.as_text(F.col(id_text))), F.when(F.col("houseNo").isNull(), X.as_text(F.col(house_text))),
        F.when(F.col("age").isNull() | F.col("gender").isNull(), X.as_text(F.col(age_text))),
    ))
    new = {
        "epic": F.coalesce("epic", X.identifier(F.col(id_text))), "houseNo": F.coalesce("houseNo", X.house(F.col(house_text))),
        "age": F.coalesce("age", X.age(F.col(age_text))), "gender": F.coalesce("gender", X.gender(F.col(age_text))),
    }
    return df.withColumns(new | ({"raw": F.concat("raw", used)} if "raw" in df.columns else {}))


def needs_fill() -> Column:
    return F.col("epic").isNull() | F.greatest(*[F.col(c).isNull() for c in ("houseNo", "age", "gender", "relationType", "relativeName", "name")])


def best_reading(readings: DataFrame, key: str, valid: str = "valid", rank: str = "rank") -> DataFrame:
    """Of ranked readings of a record the first valid one, else the last."""
    order = Window.partitionBy(key).orderBy(F.desc(valid), F.when(F.col(valid), F.col(rank)).otherwise(-F.col(rank)))
    return readings.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


#: Header patterns.
ASSEMBLY = r"(?i)Assembly\s+Constituency\s+No\s+and\s+Name\s*[:\-]?\s*(\d+)\s*[-–]\s*(.+)"
PART = r"(?i)Part\s*No\.?\s*[:\-]?\s*(\d+)"
SECTION = r"(?i)Section\s+No\s+and\s+Name\s*[:\-]?\s*(\d+)\s*[-–]\s*(.+)"
PAGES = r"(?i)Total\s+Pages\s+(\d+)\s*[-–]?\s*Page\s+(\d+)"
AGE_ON = r"(?i)Age\s+as\s+on\s+(\d{2}-\d{2}-\d{4})"
PUBLISHED = r"(?i)Date\s+of\s+Publication\s*[-:]?\s*(\d{2}-\d{2}-\d{4})"


def page_header(blob: Column, fallback_page: Column) -> Column:
    """The page's metadata from the joined text of its header and footer."""
    part = lambda p, g: F.nullif(F.regexp_extract(blob, p, g), F.lit(""))
    name = F.split(part(ASSEMBLY, 2), r"\s+Part\s+No|\s+Section\s+No", 2)[0]
    section = F.split(part(SECTION, 2), r"\s+\d+\s+[A-Z]{3}\d{7}|\s+Part\s+No|\s+Age\s+as|\s+Total\s+Pages|\s+Date\s+of", 2)[0]
    return F.struct(
        part(ASSEMBLY, 1).try_cast("long").alias("constituencyNo"), X.place(name).alias("constituency"), part(PART, 1).try_cast("long").alias("partNo"),
        part(SECTION, 1).try_cast("long").alias("sectionNo"), F.btrim(section, F.lit(" :|-")).alias("section"), part(PAGES, 1).try_cast("long").alias("totalPages"),
        F.coalesce(part(PAGES, 2).try_cast("long"), fallback_page.cast("long")).alias("page"), part(AGE_ON, 1).alias("qualifyingDate"), part(PUBLISHED, 1).alias("publicationDate"),
    )


def cover_totals(texts: Column) -> Column:
    """male, female, others and total: the last four numbers of at most five digits, if there are four."""
    numbers = F.transform(F.filter(texts, lambda t: t.rlike(r"^\d{1,5}$")), lambda t: t.cast("long"))

    def named(last: Column) -> Column:
        return F.struct(*[last[i].alias(n) for i, n in enumerate(("male", "female", "others", "total"))])

    return X.bound(F.when(F.size(numbers) >= 4, F.slice(numbers, -4, 4)), named)


#: Error names in their order, and the allowed values.
GENDERS = ("Male", "Female", "Others")
RELATION_TYPES = ("Father", "Mother", "Husband", "Wife", "Other")


def validation_errors(layout: Layout = LAYOUT) -> Column:
    """Errors of a record in a fixed order; a missing house, relative or relation is none."""
    c = F.col
    return F.array_compact(F.array(
        F.when(c("epic").isNull(), "missing_epic").when(~c("epic").rlike(f"^{X.ID}$"), "invalid_epic"),
        F.when(c("age").isNull(), "missing_age").when(~c("age").between(*layout.age), "invalid_age"),
        F.when(c("gender").isNull(), "missing_gender").when(~c("gender").isin(*GENDERS), "invalid_gender"),
        F.when(c("name").isNull(), "missing_name"), F.when(c("serialNo").isNull(), "missing_serial"),
        F.when(~c("relationType").isin(*RELATION_TYPES), "invalid_relation"),
    ))


def validated(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", validation_errors()).withColumn("valid", F.size("errors") == 0)


def clip_only(valid: str = "valid", errors: str = "errors") -> Column:
    """Invalid for a missing age and gender alone, as the set of errors says."""
    return ~F.col(valid) & (F.array_sort(F.array_distinct(errors)) == F.array(F.lit("missing_age"), F.lit("missing_gender")))


def not_empty_cell() -> Column:
    return F.col("epic").isNotNull() | F.col("name").isNotNull()
