"""Rules of card parsing on invented values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardloom.functions import text as X
from cardloom.operators import records as R


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


LABELS = ("House Number", "HOUSE NUMBER", "Hous Numbr", "Houxe Num", "Hou Numer")


@pytest.mark.parametrize("mark", [" : ", " - ", ":", " "])
@pytest.mark.parametrize("value", ["7", "12-B", "3/4-1", "Flat 6", "00121"])
def test_house_by_label_mark_and_value(spark, mark, value):
    texts = [f"{label}{mark}{value}" for label in LABELS] + [f"H.No{mark}{value}", f"h no.{mark}{value}", f"  {LABELS[0]} {mark} {value} -"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(X.house(F.col("t")).alias("h")).collect()
    assert [r.h for r in got] == [value] * len(texts)


@pytest.mark.parametrize(("line", "expected"), [
    ("45/2 Age : 70", "45/2"), ("House Number : 45/2 Sex : 4", "45/2"), ("House Number : 5 A", "5"), ("5 A", "5 A"), ("H No", None), ("House Number", None), ("Wife 3", None), ("Name 12", None), ("Oak Lane", None), (" - ", None), (None, None),
])
def test_house_edges(spark, line, expected):
    assert one(spark, h=X.house(F.lit(line).cast("string"))).h == expected


@pytest.mark.parametrize(("digits", "years"), [("18", 18), ("I9", 19), ("6o", 60), ("1O1", 101), ("ll", 11)])
@pytest.mark.parametrize("label", ["Age", "AGE", "Aqe", "A ge", "A. ae"])
def test_ages_with_letters_for_digits(spark, label, digits, years):
    for mark in (" : ", "-", " ", " • "):
        assert one(spark, a=X.age(F.lit(f"xx {label}{mark}{digits} yy"))).a == years


@pytest.mark.parametrize(("word", "gender"), [("MALE", "Male"), ("molo", "Male"), ("Female", "Female"), ("FEMOLE", "Female"), ("Femaie", "Female"), ("Others", "Others"), ("Third Gender", "Others")])
def test_genders(spark, word, gender):
    for label in ("Gender : ", "Gendor-", "Ccnder ", "GENDER·"):
        x = F.lit(f"Age : 44 {label}{word}")
        assert tuple(one(spark, a=X.age(x), g=X.gender(x))) == (44, gender)
    assert one(spark, g=X.gender(F.lit(word))).g is None  # without its label


def test_age_and_gender_of_other_lines(spark):
    for line in (None, "", "Aged 5", "Engagement : 3", "Gender :"):
        x = F.lit(line).cast("string")
        assert one(spark, g=X.gender(x)).g is None
    assert one(spark, a=X.age(F.lit("Address : 12"))).a is None


@pytest.mark.parametrize(("text", "expected"), [("ABC1234567", "ABC1234567"), ("ABC123O567", "ABC1230567"), ("a0c l23456o", "AOC1234560"), ("12 ABC1234567", "ABC1234567"), ("AB1", None), ("", None), (None, None)])
def test_identifier(spark, text, expected):
    assert one(spark, x=X.identifier(F.lit(text).cast("string"))).x == expected


def fields(spark, *lines):
    return one(spark, f=R.labelled_fields(F.array(*map(F.lit, lines)))).f


def test_wrapped_names(spark):
    f = fields(spark, "Name : ANU", "KUMARI", "Fathers Name: RAVI", "SHANKAR", "House Number : 001", "Age : 25 Gender : Male")
    assert (f.name, f.relationType, f.relativeName, f.houseNo, f.age, f.gender) == ("Anu Kumari", "Father", "Ravi Shankar", "001", 25, "Male")


def test_repeated_and_junk_continuations_are_ignored(spark):
    f = fields(spark, "Name : Anu", "Husband's Name: Ravi Shankar", "SHANKAR", "1", "12/3", "Photo Available")
    assert (f.name, f.relationType, f.relativeName) == ("Anu", "Husband", "Ravi Shankar")
    assert fields(spark, "Others: Xan Yel").relationType == "Other"
    assert fields(spark).name is None


def token(text, x, y):
    return (text, 0.99, [[x, y], [x + 40, y], [x + 40, y + 12], [x, y + 12]])


def test_whole_card(spark):
    tokens = [token("1", 8.0, 8.0), token("ABC1234567", 220.0, 8.0), token("Name : Anu", 10.0, 50.0), token("Fathers Name: Ravi", 10.0, 78.0), token("House Number : 001", 10.0, 106.0), token("Age : 25", 10.0, 134.0), token("Gender : Male", 90.0, 136.0)]
    schema = "card_id int, width double, height double, tokens array<struct<text:string,confidence:double,bbox:array<array<double>>>>"
    r = R.validated(R.parsed_cards(spark.createDataFrame([(1, 400.0, 160.0, tokens), (2, 400.0, 160.0, [])], schema))).orderBy("card_id").collect()
    assert (r[0].serialNo, r[0].epic, r[0].name, r[0].relationType, r[0].relativeName, r[0].houseNo, r[0].age, r[0].gender, r[0].valid) == (1, "ABC1234567", "Anu", "Father", "Ravi", "001", 25, "Male", True)
    assert r[0].raw[-1] == "Age : 25 Gender : Male"
    assert not r[1].valid and r[1].confidence == 0.0


def test_lines_keep_their_first_token_as_anchor(spark):
    tokens = F.array(*[F.struct(F.lit(float(y)).alias("y0"), F.lit(0.0).alias("x0"), F.lit(float(y)).alias("cy"), F.lit(10.0).alias("height"), F.lit(str(y)).alias("text")) for y in (0, 5, 9, 13)])
    assert one(spark, x=R.grouped_lines(tokens)).x == ["0 5", "9 13"]


def test_filling_never_overwrites(spark):
    row = {"epic": F.lit("ABC1234567"), "houseNo": F.lit("1"), "age": F.lit(30), "gender": F.lit("Male"), "raw": F.array(F.lit("x")), "house_text": F.lit("House Number : 9"), "age_text": F.lit("Age : 9"), "epic_text": F.lit("")}
    df = spark.range(1).select(*[c.alias(n) for n, c in row.items()])
    got = R.filled(df).first()
    assert (got.epic, got.houseNo, got.age, got.gender, got.raw) == ("ABC1234567", "1", 30, "Male", ["x"])


def test_page_sets(spark):
    assert one(spark, p=X.page_set(F.lit("3,14, 22-24,99"), F.lit(23))).p == [3, 14, 22, 23]
    assert one(spark, p=X.page_set(F.lit(""), F.lit(3))).p == [1, 2, 3]


def test_titles(spark):
    assert one(spark, p=X.person(F.lit(": O'NEIL  SMITH-JONES -"))).p == "O'Neil Smith-Jones"
    assert one(spark, p=X.person(F.lit("mcDonald"))).p == "mcDonald"
