from __future__ import annotations

import zlib
from collections import defaultdict

import corpus_pipeline as C
import numpy as np
import pytest

from cardloom.llm.decontaminate import normalised
from cardloom.llm.language_id import fit, predict
from cardloom.llm.quality_rules import quality_verdicts
from tests.llm.helpers import frame
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing_sharding import reference

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def kept_rows(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_run_against_a_brute_force_pipeline(spark, sf):
    """Verdicts of the learned stages come from their operators on exactly the rows that a loop over Python rows has kept; near
    duplicates, decisions and packing are computed without Spark."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*C.COLUMNS).collect()]
    docs = kept_rows(spark, rows)
    verdict = {r.doc_id: r.lang_pred != "und" and r.score >= C.LEAST_SCORE for r in predict(docs, fit(docs)).collect()}
    rows = [r for r in rows if verdict[r[0]]]
    verdict = {r.doc_id: r.kept for r in quality_verdicts(kept_rows(spark, rows)).collect()}
    rows = [r for r in rows if verdict[r[0]]]
    roots = brute([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if roots[r[0]][1] == r[0]]
    items = [normalised(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    exact = {r[0] for r in rows if any(t in normalised(r[1]) for t in items)}
    out = C.run(spark, sf).collect()
    found = {r.doc_id for r in out}
    assert found <= {r[0] for r in rows} - exact
    lost = {r[0] for r in rows} - exact - found  # these hold an item with errors: half of its four-word runs at least
    for r in rows:
        if r[0] in lost:
            text = normalised(r[1])
            runs = [[" ".join(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)] for t in items]
            assert any(sum(x in text for x in some) >= len(some) / 2 for some in runs)
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for r in rows:
        if r[0] in found:
            ids = reference(r[1])
            expected = [(n, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for n, a in enumerate(range(0, len(ids), 2048))]
            assert sorted(pieces[r[0]]) == expected


TEXT = " ".join(f"the {chr(97 + i % 26)}{chr(97 + i // 26)}ing of" for i in range(30))
ROWS = [
    (1, TEXT, "en", "a"), (1, TEXT, "en", "a"), (2, TEXT + " tail", "en", "a"), (None, TEXT.upper(), "en", None), (3, None, "en", "a"), (4, "", None, "a"), (5, "12 34", "en", "b"),
    (6, " ".join(f"el {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}o de" for i in range(12_000)), "es", "b"),
]


@pytest.mark.parametrize(("name", "stage"), C.STAGES[:-1])
def test_each_stage_on_edge_rows_and_on_none(spark, sf, name, stage):
    none = stage(spark, frame(spark, []), sf)
    assert none.count() == 0 and tuple(none.columns) == C.COLUMNS
    got = sorted((r.doc_id or 0, len(r.text or "")) for r in stage(spark, frame(spark, ROWS), sf).collect())
    every = sorted((r[0] or 0, len(r[1] or "")) for r in ROWS)
    expected = {
        "language ID": [x for x in every if x[0] not in (3, 4, 5)], "quality rules": [x for x in every if x[0] not in (3, 4, 5)],
        "n-gram Jaccard join": [x for n, x in enumerate(every) if x[0] != 2 and (x[0] != 1 or n == every.index(x))], "benchmark decontamination": every,
    }
    assert got == expected[name]


def test_packing_stage_on_edge_rows_and_on_none(spark, sf):
    assert C.packing_stage(spark, frame(spark, []), sf).count() == 0
    out = C.packing_stage(spark, frame(spark, ROWS), sf).collect()
    assert sum(r.length for r in out) == sum(len(reference(r[1])) for r in ROWS) and sum(r.piece == 0 for r in out) == len(ROWS)
