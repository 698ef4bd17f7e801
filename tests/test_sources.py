"""Results, tokens, ladders and paths."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardloom.operators import jobs as J
from cardloom.operators.ladder import card_ranks, climbed, rank_counts
from cardloom.sources import parts as P
from cardloom.sources.results import tokens_from_results
from cardloom.sources.token_source import read_pages

SQUARE = [[0.0, 0.0]] * 4
RESULTS = [
    ('[{"rec_texts":["A","  "," B "],"rec_scores":[0.5,0.9],"rec_polys":[[[0,0],[10,0],[10,5],[0,5],[9,9]],null,[1,2,11,7]]}]', [("A", 0.5, [[0, 0], [10, 0], [10, 5], [0, 5]]), ("B", 0.0, [[1, 2], [11, 2], [11, 7], [1, 7]])]),
    ('[{"rec_texts":[],"rec_text":["one"],"rec_scores":[],"dt_polys":[]},{"rec_texts":["second"]}]', [("one", 1.0, SQUARE)]),
    ('{"str":["C","D"],"dt_polys":[[[3,1],[12,6]]]}', [("C", 1.0, [[3, 1], [12, 1], [12, 6], [3, 6]]), ("D", 1.0, SQUARE)]),
    ('[[[[[0,0],[4,0],[4,2],[0,2]],["D",0.25]],[[[1,1],[2,2]],"E"],[[[0,0],[1,1]],["",0.1]],[],null,[[[1,1]]]]]', [("D", 0.25, [[0, 0], [4, 0], [4, 2], [0, 2]]), ("E", 1.0, [[1, 1], [2, 1], [2, 2], [1, 2]])]),
    ('[null,[[[1,1],[2,2]],["F",0.5]]]', [("F", 0.5, [[1, 1], [2, 1], [2, 2], [1, 2]])]), ('[[[[1,2,3],["G"]]]]', [("G", 0.0, SQUARE)]),
    ("nope", []), (None, []), ("[]", []), ("[[]]", []), ("7", []), ('[{"other":1}]', []), ("null", []), ('""', []),
]


def test_results_of_all_shapes(spark):
    rows = spark.createDataFrame([(n, r) for n, (r, _) in enumerate(RESULTS)], "n int, result string")
    got: dict = {n: [] for n in range(len(RESULTS))}
    for r in sorted(tokens_from_results(rows, "n").collect(), key=lambda r: (r.n, r.seq)):
        assert r.seq == len(got[r.n])
        got[r.n].append((r.text, r.confidence, r.bbox))
    assert got == {n: want for n, (_, want) in enumerate(RESULTS)}


def pages(tmp_path, **docs):
    for doc, texts in docs.items():
        (tmp_path / doc).mkdir()
        for n, text in texts.items():
            (tmp_path / doc / f"page{n}.txt").write_bytes(text)


@pytest.fixture
def source(spark):
    return lambda path: read_pages(spark, str(path))


def test_pages_become_tokens_and_failures_stay_pages(spark, source, tmp_path):
    pages(tmp_path, part_1={1: b"10 20 one\n50 20 two words\n", 2: b"no numbers\n", 12: b""}, part_2={1: b"1 2 x\n"})
    (tmp_path / "part_2" / "notes.md").write_text("no page")
    got = sorted(((r.doc, r.page, r.seq, r.text, r.error and r.error.split(":")[0]) for r in source(tmp_path).collect()), key=str)
    assert got == [("part_1", 1, 0, "one", None), ("part_1", 1, 1, "two words", None), ("part_1", 2, 0, None, "ValueError"), ("part_2", 1, 0, "x", None)]
    assert source(tmp_path / "absent").count() == 0


def test_filters_reach_the_source(spark, source, tmp_path):
    pages(tmp_path, a={n: b"1 1 t\n" for n in range(1, 9)}, b={3: b"1 1 t\n", 4: b"bad\n"})
    some = source(tmp_path).filter((F.col("page") >= 3) & (F.col("page") < 5) & (F.col("text") == "t") & F.col("doc").isin("a", "b"))
    assert sorted((r.doc, r.page) for r in some.collect()) == [("a", 3), ("a", 4), ("b", 3)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("Filter", 1)[1].split("BatchScan")[0] if "Filter" in plan else ""
    assert "page#" not in pushed and "text#" in pushed  # Spark checks the text alone: the rest was decided by the source
    assert source(tmp_path).filter("doc = 'b' and page = 9").count() == 0


def test_tasks_are_bounded(monkeypatch, tmp_path):
    from cardloom.sources import token_source as S

    pages(tmp_path, a={n: b"1 1 " + b"t" * n + b"\n" for n in range(1, 40)})
    monkeypatch.setattr(S, "TASK_FILES", 7)
    monkeypatch.setattr(S, "TASK_BYTES", 100)
    tasks = S.PageReader(str(tmp_path), f"{S.__name__}:text_lines", r"page(\d+)\.txt").partitions()
    assert sorted(p for t in tasks for _, p, _ in t.files) == list(range(1, 40)) and max(len(t.files) for t in tasks) <= 7
    assert all(len(t.files) == 1 or sum(5 + p for _, p, _ in t.files) <= 100 for t in tasks)


def test_a_failed_page_keeps_its_part_out_of_the_ledger(spark, source, tmp_path):
    pages(tmp_path, p1={1: b"1 1 a\n", 2: b"bad\n"}, p2={1: b"1 1 b\n"}, p3={1: b"1 1 c\n"})
    tokens = source(tmp_path)
    records = spark.createDataFrame([("p1", True)] * 10 + [("p2", True)] * 10 + [("p3", True), ("p3", False)], "doc string, valid boolean")
    expected = spark.createDataFrame([("p1", 10), ("p2", 11), ("p4", 3)], "doc string, expectedTotal int")
    out = J.part_outcomes(records, tokens, expected)
    assert {r.doc: (r.extractedTotal, r.validCount, r.failed_pages, r.ok) for r in out.collect()} == {"p1": (10, 10, 1, False), "p2": (10, 10, 0, True), "p3": (2, 1, 0, True), "p4": (0, 0, 0, False)}
    ledger = spark.createDataFrame([("p1", 7)], "doc string, validCount long")
    after = J.ledger_upsert(ledger, out.select("doc", "validCount", "ok"), ["doc"])
    assert {r.doc: r.validCount for r in after.collect()} == {"p1": 7, "p2": 10, "p3": 1}


def test_a_rank_reads_only_what_is_still_missing(spark, tmp_path):
    """A Python reader writes down what it was given: nulls, but for records that still lack a field of its rank."""
    log = tmp_path / "log"
    log.mkdir()

    def read(region):
        folder = str(log)

        @F.pandas_udf("string")
        def reader(card: pd.Series) -> pd.Series:
            import uuid

            with open(f"{folder}/{region}-{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(card.dropna()))
            texts = {"epic": "ABC0000001", "epic_fallback": "XYZ0000002", "house": "House Number : 4", "age": "Age : 40", "age_fallback": "Gender : Male", "age_crowded": "Age : 50 Gender : Female"}
            bad = {"epic": "c", "age": "d", "age_fallback": "d"}
            return card.map(lambda c: None if c is None else "?" if c == bad.get(region) else texts[region], na_action="ignore")

        return reader

    rows = [("a", "own", "1", 30, "Others", ["x"]), ("b", None, "1", 30, "Male", []), ("c", None, None, 30, "Male", []), ("d", "own", "1", None, None, []), ("e", "own", None, 30, None, None)]
    records = spark.createDataFrame(rows, "card string, epic string, houseNo string, age long, gender string, raw array<string>")
    ranks = card_ranks(read, ("card",))
    out = climbed(records, ranks)
    got = {r.card: r for r in out.collect()}
    assert {k: (r.epic, r.houseNo, r.age, r.gender) for k, r in got.items()} == {
        "a": ("own", "1", 30, "Others"), "b": ("ABC0000001", "1", 30, "Male"), "c": ("XYZ0000002", "4", 30, "Male"), "d": ("own", "1", 50, "Female"), "e": ("own", "4", 30, "Male"),
    }
    assert [(t.rank, t.text) for t in got["c"].consulted] == [("epic", "?"), ("epic_fallback", "XYZ0000002"), ("house", "House Number : 4")]
    assert got["a"].raw == ["x"] and got["d"].raw == ["?", "?", "Age : 50 Gender : Female"] and got["e"].raw == ["House Number : 4", "Age : 40", "Gender : Male"]
    asked: dict = {}
    for f in log.iterdir():
        asked.setdefault(f.name.split("-")[0], set()).update(f.read_text().split())
    assert asked == {"epic": {"b", "c"}, "epic_fallback": {"c"}, "house": {"c", "e"}, "age": {"d", "e"}, "age_fallback": {"d", "e"}, "age_crowded": {"d"}}
    assert {r.rank: r.read for r in rank_counts(out, ranks).collect()} == {"epic": 2, "epic_fallback": 1, "house": 2, "age": 2, "age_fallback": 2, "age_crowded": 1}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_paths_to_parts_and_files(spark):
    listing = spark.createDataFrame([(p,) for p in ("file:/o/D/7_Elm/part_2/json/voters.json", "/o/D/7_Elm/part_10/json/voters.json", "/o/D/7_Elm/loose/json/voters.json", "/o/D/8_Oak/part_1/json/other.json", "/o/single/json/voters.json")], "path string")
    asked = ["/o/D/7_Elm", "/o//D/7_Elm/part_2/", "/o/single", "/downloads/D/7_Elm", "file:///downloads/D/7_Elm/part_9.pdf", "/o/D/8_Oak", "/o/D/7_Elm/loose", "/o/D", ""]
    got: dict = {a: set() for a in asked}
    for r in P.resolved_parts(spark.createDataFrame([(a,) for a in asked * 2], "asked string"), listing, "/o").collect():
        assert r.path not in got[r.asked]
        got[r.asked].add(r.path)
    both = {"/o/D/7_Elm/part_2", "/o/D/7_Elm/part_10"}
    assert got == {"/o/D/7_Elm": both, "/o//D/7_Elm/part_2/": {"/o/D/7_Elm/part_2"}, "/o/single": {"/o/single"}, "/downloads/D/7_Elm": both, "file:///downloads/D/7_Elm/part_9.pdf": both, "/o/D/8_Oak": set(), "/o/D/7_Elm/loose": {"/o/D/7_Elm/loose"}, "/o/D": set(), "": set()}
    files = spark.createDataFrame([("/d/Far_East/7_Elm/part_3.pdf",), ("/d/x.pdf",)], "path string")
    wanted = [("Far East", "7_Elm", "3"), ("Far_East", "7_Elm", "4"), ("..", "7_Elm", "3"), ("Far_East", "../7_Elm", "3"), ("Far_East", "7_Elm", "x"), ("Far_East", "7_Elm", "0"), (None, None, None)]
    found = P.resolved_files(spark.createDataFrame(wanted, "districtFolder string, acFolder string, partNo string"), files, "file:///d/").collect()
    assert len(found) == 7 and [tuple(r)[:3] for r in found if r.pdfPath] == [("Far East", "7_Elm", "3")]
