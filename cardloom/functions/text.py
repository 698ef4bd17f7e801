"""Normalisation of what was read on a card, as Column expressions: identifiers, house lines, ages, genders, names, places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Label patterns as read from noisy cards.
ID = r"[A-Z]{3}[0-9]{7}"
AGE = r"(?i)(?:Age|Aae|Aao|Ace|Aqe|A\.?\s*ae|A\s*ge)\s*[:\-·•.]?\s*([0-9OoIl]{1,3})"
GENDER = r"(?i)(?:Gender|Cender|Condor|Gondor|Gend[eo]r|Ccnder)\s*[:\-·•.]?\s*(Male|Female|Mele|Femele|Femcle|Femole|Eomolo|Molo|Femaie|Others?|Third\s*Gender)"
HOUSE = r"(?i)Hou[a-z]{0,3}\s*Num[a-z]{0,4}\s*[:\-]?\s*(.+)$"
HOUSE_SHORT = r"(?i)H\.?\s*No\.?\s*[:\-]?\s*(.+)$"
HOUSE_LABEL = r"(?i)^(?:Hou[a-z]{0,3}\s*Num[a-z]{0,4}|H\.?\s*No\.?)\s*[:\-]?$"
FIELD_WORD = r"(?i)name|age|gender|father|mother|husband|wife|photo|available"
NAME = r"(?i)^(?:Name)\s*[:\-]\s*(.+)$"
SERIAL = r"^(\d{1,4})$"
SERIAL_AND_ID = r"(?i)^(\d{1,4})\s+[A-Z]{3}\d{7}$"
RELATIVE_WORD = r"(?i)father|mother|husband|wife"
RELATION = r"(?i)^(?:(Father|Mother|Husband|Wife)'?s?\s*Name\s*[:\-]?|(Other)s?\s*[:\-])\s*(.*)$"
FEMALE = ("femele", "femcle", "femole", "eomolo", "femaie")
MALE = ("mele", "molo")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def squeezed(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s+", " ")


def cleaned(x: Column, edges: str = " :-\t") -> Column:
    """Without label marks at the edges, white space squeezed."""
    return F.trim(squeezed(F.btrim(x, F.lit(edges))))


def titled(x: Column) -> Column:
    """Every run of letters with a capital first: also after marks, unlike initcap."""
    return F.array_join(F.transform(F.regexp_extract_all(x, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), F.initcap), "")


def titled_if_capitals(x: Column) -> Column:
    return F.when((x == F.upper(x)) & (x != F.lower(x)), titled(x)).otherwise(x)


def person(x: Column) -> Column:
    return bound(cleaned(x), titled_if_capitals)


def place(x: Column) -> Column:
    return bound(squeezed(F.btrim(x, F.lit(" :|-"))), titled_if_capitals)


def identifier(x: Column) -> Column:
    """Three letters and seven digits found in a noisy string, or repaired from its first ten characters; else null."""

    def found(compact: Column) -> Column:
        head = F.translate(F.substring(compact, 1, 3), "01", "OI")
        tail = F.translate(F.substring(compact, 4, 7), "OIL", "011")
        repaired = bound(F.concat(head, tail), lambda y: F.when((F.length(compact) >= 10) & y.rlike(f"^{ID}$"), y))
        return F.coalesce(F.nullif(F.regexp_extract(compact, f"({ID})", 1), F.lit("")), repaired)

    return bound(F.regexp_replace(F.upper(x), "[^A-Z0-9]", ""), found)


def house(x: Column) -> Column:
    """The house number of a line, with or without its label; null where the line is a bare label or another field."""
    before_age = lambda y: F.split(y, r"(?i)\s+Age\s*[:\-]", 2)[0]

    def value(y: Column) -> Column:
        inner = before_age(cleaned(y))
        inner = F.split(inner, r"\s+[A-Za-z]{2,8}\s*[:\-]\s*\d{1,3}\b", 2)[0]
        return F.nullif(F.regexp_replace(cleaned(inner), r"\s+A$", ""), F.lit(""))

    def parsed(line: Column) -> Column:
        labelled = [F.when(line.rlike(p), value(F.regexp_extract(line, p, 1))) for p in (HOUSE, HOUSE_SHORT)]
        return (
            F.when(line.rlike(HOUSE), labelled[0]).when(line.rlike(HOUSE_SHORT), labelled[1])
            .when(line.rlike(FIELD_WORD), None).when(line.rlike(r"\d"), line)
        )

    def checked(blob: Column) -> Column:
        return F.when((blob != "") & ~blob.rlike(HOUSE_LABEL), bound(cleaned(before_age(blob)), parsed))

    return bound(cleaned(F.coalesce(x, F.lit(""))), checked)


def age_digits(x: Column) -> Column:
    return F.regexp_replace(F.translate(F.upper(x), "OÓÒIL", "00011"), r"\D", "").try_cast("long")


def age(x: Column) -> Column:
    return age_digits(F.regexp_extract(squeezed(F.coalesce(x, F.lit(""))), AGE, 1))


def gender_name(x: Column) -> Column:
    def named(v: Column) -> Column:
        return F.when(v.startswith("female") | v.isin(*FEMALE), "Female").when(v.startswith("male") | v.isin(*MALE), "Male").otherwise("Others")

    return bound(F.regexp_replace(F.lower(F.trim(x)), "[^a-z]", ""), named)


def gender(x: Column) -> Column:
    return bound(F.regexp_extract(squeezed(F.coalesce(x, F.lit(""))), GENDER, 1), lambda m: F.when(m != "", gender_name(m)))


def skipped_line(line: Column) -> Column:
    return (line == "") | line.rlike("(?i)photo|available") | line.rlike(SERIAL) | line.rlike(SERIAL_AND_ID)


def wrap_junk(line: Column) -> Column:
    return bound(cleaned(line), lambda s: (s == "") | s.rlike(SERIAL) | s.rlike(SERIAL_AND_ID) | s.rlike(r"^[\d./\-]+$"))


def without_trailing_serial(x: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(x, r"\s+\d{1,4}$", "")), F.lit(""))


def wrapped(base: Column, extra: Column) -> Column:
    """base continued by extra, unless it has it already; extra must be a wrap value (see records.line_facts)."""
    return F.when(extra.isNull() | F.contains(F.lower(base), F.lower(extra)), base).otherwise(F.concat_ws(" ", base, extra))


def preferred_person(old: Column, new: Column) -> Column:
    """The longer reading of a name, if it has the shorter one in it."""
    new = F.nullif(new, F.lit(""))

    def chosen(o: Column) -> Column:
        return F.when(new.isNull(), o).when(o.isNull(), new).when((F.length(new) > F.length(o)) & F.contains(F.lower(new), F.lower(o)), new).otherwise(o)

    return bound(without_trailing_serial(old), chosen)


def as_integer(x: Column) -> Column:
    return F.trim(x.cast("string")).try_cast("long")


def as_text(x: Column) -> Column:
    return F.nullif(x.cast("string"), F.lit(""))


def spaced(x: Column) -> Column:
    """A folder name as a name: lower case, underscores as spaces."""
    return F.trim(F.lower(F.translate(x, "_", " ")))


def safe_segment(x: Column) -> Column:
    """A path segment that cannot leave its folder; else null."""
    t = F.trim(x)
    return F.when((t == "") | t.isin(".", "..") | t.rlike(r"[/\\\x00]"), None).otherwise(t)


def page_set(spec: Column, pages: Column) -> Column:
    """Pages of a specification such as 3,14,22-30, in range and sorted; all pages for an empty one."""
    def numbers(part: Column) -> Column:
        low = F.trim(F.split(part, "-", 2)[0]).try_cast("int")
        high = F.coalesce(F.trim(F.try_element_at(F.split(part, "-", 2), F.lit(2))).try_cast("int"), low)
        return F.when(low.isNull() | (high < low), F.array().cast("array<int>")).otherwise(F.sequence(F.least(low, pages + 1), F.least(high, pages + 1)))

    every = F.flatten(F.transform(F.split(spec, ","), numbers))
    chosen = F.array_sort(F.array_distinct(F.filter(every, lambda p: (p >= 1) & (p <= pages))))
    return F.when(F.coalesce(F.trim(spec), F.lit("")) == "", F.when(pages >= 1, F.sequence(F.lit(1), pages)).otherwise(F.array().cast("array<int>"))).otherwise(chosen)
