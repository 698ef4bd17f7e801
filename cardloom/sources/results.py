"""Results of character recognition as tokens, from the JSON that engines leave, without Python.

Three shapes are known, and may stand in one column.  (a) A list whose first item is an object, or an object alone: parallel lists of texts,
scores and boxes under one of several names.  (b) The same with texts under `str`.  (c) A list with the list
of lines first, or, where that is null, the lines after it: pairs of a box and either a text or a list of text and score.  Boxes are four points or more, two corners, or the numbers of
either in one list.  A result that is no JSON, or of another shape, has no tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.operators.geometry import quad

#: Names of the lists, in the order in which they are looked for.
TEXTS, SCORES, BOXES = ("rec_texts", "rec_text", "str"), ("rec_scores", "rec_score"), ("rec_polys", "dt_polys", "rec_boxes")


def _list(v: Column, *names: str) -> Column:
    """The first of the lists of these names that is not empty; null if there is none."""
    lists = [F.try_variant_get(v, f"$.{n}", "array<variant>") for n in names]
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _text(v: Column) -> Column:
    return F.when(_is(v, "STRING"), F.try_variant_get(v, "$", "string"))


def box_quad(v: Column) -> Column:
    """The four points of a box; zeros if it is none."""
    flat = F.try_variant_get(v, "$", "array<double>")
    pairs = F.transform(F.sequence(F.lit(1), F.floor(F.size(flat) / 2).cast("int")), lambda i: F.array(F.get(flat, 2 * i - 2), F.get(flat, 2 * i - 1)))
    points = F.when(_is(v, "ARRAY<ARRAY"), F.try_variant_get(v, "$", "array<array<double>>")).when(_is(v, "ARRAY") & (F.size(flat) >= 4) & (F.size(flat) % 2 == 0), pairs)
    known = (F.size(points) == 2) | (F.size(points) >= 4)
    return F.when(known & ~F.exists(points, lambda p: p.isNull() | (F.size(p) < 2) | F.exists(p, lambda c: c.isNull())), quad(points)).otherwise(quad(F.array().cast("array<array<double>>")))


def _token(text: Column, confidence: Column, box: Column) -> Column:
    return F.struct(F.trim(text).alias("text"), F.coalesce(confidence, F.lit(0.0)).alias("confidence"), box_quad(box).alias("bbox"))


def _from_lists(v: Column) -> Column:
    scores, boxes = _list(v, *SCORES), _list(v, *BOXES)
    score = lambda i: F.when(scores.isNull(), F.lit(1.0)).otherwise(F.try_variant_get(F.get(scores, i), "$", "double"))
    return F.transform(_list(v, *TEXTS), lambda t, i: _token(_text(t), score(i), F.get(boxes, i)))


def _from_lines(v: Column) -> Column:
    lines = F.when(_is(F.try_variant_get(v, "$[0]", "variant"), "ARRAY"), F.try_variant_get(v, "$[0]", "array<variant>")).otherwise(F.try_variant_get(v, "$", "array<variant>"))

    def one(x: Column) -> Column:
        payload = F.try_variant_get(x, "$[1]", "variant")
        listed = _is(payload, "ARRAY")
        text = F.when(listed, _text(F.try_variant_get(x, "$[1][0]", "variant"))).otherwise(_text(payload))
        return _token(text, F.when(listed, F.try_variant_get(x, "$[1][1]", "double")).otherwise(1.0), F.try_variant_get(x, "$[0]", "variant"))

    return F.transform(lines, one)


def result_tokens(v: Column) -> Column:
    """array<struct<text, confidence, bbox>> of a result (a variant): tokens with text, in the order of the result.  A score that is missing
    beside others is 0, and 1 where there are none at all."""
    first = F.try_variant_get(v, "$[0]", "variant")
    tokens = F.when(_is(first, "OBJECT"), _from_lists(first)).when(_is(v, "OBJECT"), _from_lists(v)).when(_is(v, "ARRAY"), _from_lines(v))
    return F.filter(tokens, lambda t: F.coalesce(t["text"], F.lit("")) != "")


def tokens_from_results(rows: DataFrame, *key: str, result: str = "result") -> DataFrame:
    """key, seq, text, confidence, bbox of the results of rows (key, result: JSON text)."""
    parsed = rows.select(*key, F.try_parse_json(result).alias("_v"))
    return parsed.select(*key, F.posexplode(result_tokens(F.col("_v"))).alias("seq", "t")).select(*key, "seq", "t.*")
