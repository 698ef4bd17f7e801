"""A parse job from page files to records, ledger and images."""

from __future__ import annotations

from cardloom import api
from cardloom.schema import LEDGER
from cardloom.sources.token_source import read_pages


def card_lines(x, y, serial, good=True):
    lines = [(x + 6, y + 4, str(serial)), (x + 190, y + 4, f"ABC{serial:07d}"), (x + 8, y + 30, "Name : Anu Rao"), (x + 8, y + 48, "Father Name: Ravi Rao"), (x + 8, y + 66, f"House Number : {serial}")]
    return lines + ([(x + 8, y + 84, "Age : 40 Gender : Male")] if good else [])


def test_pages_to_ledger(spark, tmp_path):
    boxes = [(10 + 320 * (i % 3), 10 + 130 * (i // 3), 300, 120) for i in range(6)]
    for part, bad, broken in ((1, (), False), (2, (0, 1, 2), False), (3, (), True)):
        (tmp_path / f"part_{part}").mkdir()
        for page in (1, 2):
            lines = [line for i, (x, y, _, _) in enumerate(boxes) for line in card_lines(x, y, 100 * part + 10 * page + i, i not in bad)]
            text = "\n".join(f"{x} {y} {t}" for x, y, t in lines)
            (tmp_path / f"part_{part}" / f"page{page}.txt").write_text("broken" if broken and page == 2 else text)
    tokens = read_pages(spark, str(tmp_path))
    cards = spark.createDataFrame([(f"part_{p}", page, i, *map(float, b)) for p in (1, 2, 3) for page in (1, 2) for i, b in enumerate(boxes)] + [("part_1", 1, 6, 10.0, 500.0, 300.0, 120.0)], "doc string, page int, card_index int, x double, y double, w double, h double")
    parts = spark.createDataFrame([(f"part_{n}", 12, "Far_East", 7, n) for n in (1, 2, 3, 4)], "doc string, expectedTotal int, districtFolder string, asmblyNo int, partNo int")
    images = spark.createDataFrame([(f"part_{p}", f"/i/page1_card{c}.png") for p in (1, 2) for c in (1, 4)] + [("part_3", "/i/page1.png"), ("part_2", "/i/page1.png"), ("part_1", "/i/page1.png")], "doc string, path string")
    old = spark.createDataFrame([("Far_East", 7, None, None, 2, 3, 4, 5, None)], LEDGER)
    job = api.parse(tokens, cards, parts, old, images)
    records = {(r.doc, r.page, r.card_index): r for r in job.records.collect()}
    assert len(records) == 30  # the empty cell of part 1 and the unread page of part 3 have none
    one = records["part_1", 2, 4]
    assert (one.serialNo, one.epic, one.name, one.relationType, one.relativeName, one.houseNo, one.age, one.gender, one.valid) == (124, "ABC0000124", "Anu Rao", "Father", "Ravi Rao", "124", 40, "Male", True)
    assert records["part_2", 1, 0].errors == ["missing_age", "missing_gender"]
    outcomes = {r.doc: (r.extractedTotal, r.validCount, r.failed_pages, r.ok) for r in job.outcomes.collect()}
    assert outcomes == {"part_1": (12, 12, 0, True), "part_2": (12, 6, 0, False), "part_3": (6, 6, 1, False), "part_4": (0, 0, 0, False)}
    ledger = {r.partNo: (r.validCount, r.expectedTotal) for r in job.ledger.collect()}
    assert ledger == {1: (12, 12), 2: (3, 5)}  # part 2 keeps its older entry
    keep = {(r.doc, r.path): r.keep for r in job.images.collect()}
    assert {p for (d, p), k in keep.items() if d == "part_1" and k} == set() and all(k for (d, _), k in keep.items() if d != "part_1")
