"""Schemas of the engine's tables, and the constants of the card layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Public columns of a record, in export order.
PUBLIC = T.StructType([
    T.StructField("serialNo", T.LongType()), T.StructField("epic", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("relationType", T.StringType()), T.StructField("relativeName", T.StringType()), T.StructField("houseNo", T.StringType()),
    T.StructField("age", T.LongType()), T.StructField("gender", T.StringType()), T.StructField("page", T.LongType()),
    T.StructField("partNo", T.LongType()), T.StructField("constituency", T.StringType()), T.StructField("section", T.StringType()),
])
SOURCE_KEY = "sourcePdf"
#: The registry: public columns and the replace key.
REGISTRY = T.StructType([*PUBLIC.fields, T.StructField(SOURCE_KEY, T.StringType(), False)])
INTEGERS = ("serialNo", "age", "page", "partNo")
SEARCH_FIELDS = ("name", "relativeName", "epic", "houseNo", "section", SOURCE_KEY)

TOKEN = T.StructType([T.StructField("text", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("bbox", T.ArrayType(T.ArrayType(T.DoubleType())))])
#: Saved records as exported in full.
FULL = T.StructType([
    *PUBLIC.fields, T.StructField("rawOcr", T.ArrayType(T.StringType())), T.StructField("confidence", T.DoubleType()),
    T.StructField("boundingBoxes", T.ArrayType(TOKEN)), T.StructField("cropPath", T.StringType()), T.StructField("valid", T.BooleanType()),
    T.StructField("errors", T.ArrayType(T.StringType())),
])
PAYLOAD = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("partNo", T.LongType()), T.StructField("constituency", T.StringType()),
    T.StructField("expectedTotal", T.LongType()), T.StructField("extractedTotal", T.LongType()), T.StructField("validCount", T.LongType()),
    T.StructField("pageTypes", T.MapType(T.StringType(), T.StringType())), T.StructField("voters", T.ArrayType(FULL)),
])
LEDGER = T.StructType([
    T.StructField("districtFolder", T.StringType()), T.StructField("asmblyNo", T.LongType()), T.StructField("acName", T.StringType()),
    T.StructField("acFolder", T.StringType()), T.StructField("partNo", T.LongType()), T.StructField("validCount", T.LongType()),
    T.StructField("extractedTotal", T.LongType()), T.StructField("expectedTotal", T.LongType()), T.StructField("pdfPath", T.StringType()),
])
REGIONS = T.StructType([
    T.StructField("state", T.StringType()), T.StructField("stateName", T.StringType()),
    T.StructField("districts", T.ArrayType(T.StructType([
        T.StructField("districtName", T.StringType()), T.StructField("districtCd", T.StringType()),
        T.StructField("assemblies", T.ArrayType(T.StructType([T.StructField("asmblyNo", T.LongType()), T.StructField("name", T.StringType())]))),
    ]))),
])


@dataclass(frozen=True)
class Layout:
    """Fixed values of the card layout.  Boxes are (x, y, width, height) as shares of the card."""

    columns: int = 3
    rows: int = 10
    full_page_cards: int = 25
    aspect: float = 2.47
    aspect_slack: float = 0.35
    inset: int = 6
    probe_margin: int = 10
    frame: tuple[float, ...] = (0.0237, 0.9743, 0.0335, 0.9701)
    occupancy: float = 0.03
    overlap: float = 0.35
    photo: tuple[float, ...] = (0.76, 0.02, 0.24, 0.96)
    photo_guard: float = 0.22
    serial_corner: tuple[float, float] = (0.28, 0.30)
    body_top: float = 0.18
    age: tuple[int, int] = (18, 120)
    parts_per_assembly: int = 700
    boxes: dict[str, tuple[float, ...]] = field(default_factory=lambda: {
        "serial": (0, 0, 0.16, 0.28), "epic": (0.50, 0, 0.48, 0.18), "epic_fallback": (0.55, 0, 0.44, 0.28), "text": (0.01, 0, 0.74, 0.99),
        "house": (0.01, 0.415, 0.74, 0.125), "age": (0.01, 0.530, 0.74, 0.145), "age_fallback": (0.01, 0.640, 0.74, 0.16), "age_crowded": (0.01, 0.780, 0.74, 0.20),
    })


LAYOUT = Layout()
