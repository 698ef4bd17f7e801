"""Queries cover whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardloom.plans import registry
from tests.conftest import SF

SF = SF.replace("sf0.001", "sf0.01")


def test_every_event_is_in_a_line_and_boxes_match_brute_force(spark):
    q = registry.queries()
    events: dict = {}
    for r in spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_id", F.unix_date(F.to_date("ts")).alias("day")).collect():
        events.setdefault((r.user_id, r.day), []).append(r.event_id)
    assert sum(map(len, events.values())) > 3000
    lines = {(r.user_id, r.day): r.lines for r in q["anchor_lines"](spark, SF).collect()}
    assert {u: sorted(x.replace("|", " ").split()) for u, x in lines.items()} == {u: sorted(f"e{e}" for e in es) for u, es in events.items()}
    expected = {}
    for page, es in events.items():
        boxes = sorted((-(200 + e % 7) * (80 + e % 5), e * 31 % 120, e * 17 % 90, 200 + e % 7, 80 + e % 5) for e in es)
        kept: list = []
        for _, x, y, _, _ in boxes:
            if not any(abs(x - a) < 18 and abs(y - b) < 18 for a, b in kept):
                kept.append((x, y))
        expected[page] = (len(kept), sum(x for x, _ in kept))
    assert {(r.user_id, r.day): (r.kept, r.sum_x) for r in q["nms_greedy"](spark, SF).collect()} == expected


def test_every_part_and_every_assembly_has_its_cells(spark):
    q = registry.queries()
    parts = spark.read.parquet(f"{SF}/part.parquet").count()
    cells = q["grid_cells"](spark, SF)
    assert parts > 50 and cells.count() == 30 * parts and cells.select("page").distinct().count() == parts
    empty = {r.asmblyNo for r in q["coverage_ac"](spark, SF).collect() if r.scanned == r.downloaded == 0}
    counts = {r.asmblyNo: r["count"] for r in q["coverage_cells"](spark, SF).groupBy("asmblyNo").count().collect()}
    assert empty and all(counts[a] == 700 for a in empty)
    assert counts.keys() == {r.asmblyNo for r in q["coverage_ac"](spark, SF).collect()}


def test_result_tokens_are_read_by_many_tasks(spark, sf):
    """A table of some megabytes is one split, however long its rows take."""
    from cardloom.plans import sources

    assert sources.result_tokens(spark, sf).rdd.getNumPartitions() >= 16


def test_cards_are_parsed_by_many_tasks(spark, sf):
    from cardloom.plans import records

    assert records.parse_cards(spark, sf).rdd.getNumPartitions() >= 16


def test_page_files_are_written_by_many_tasks(spark, sf):
    """The files of a doc, each of one page, come from several tasks."""
    import glob
    import re

    from cardloom.plans import sources

    folders = []
    plain = sources.new_folder
    sources.new_folder = lambda s, tag: folders.append(plain(s, tag)) or folders[-1]
    try:
        sources.page_tokens(spark, sf)
    finally:
        sources.new_folder = plain
    files = glob.glob(re.sub("^file:/*", "/", folders[0]) + "/*/part-*.txt")
    assert len(files) == 10 and len({re.search(r"part-(\d+)-", f)[1] for f in files}) > 1
