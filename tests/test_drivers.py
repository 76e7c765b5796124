"""Whole runs on small tables: outcomes by hand, empty tables, nulls, projects that fail alone."""

import pytest

from quillspark.operators import drivers


def test_each_project_fails_alone():
    def step(p):
        if p == "b":
            raise ValueError("gone")
        return p != "c"

    done, code = drivers.each_project(["a", "b", "c", "d"], step)
    assert [(s.project, s.ok) for s in done] == [("a", True), ("b", False), ("c", False), ("d", True)]
    assert done[1].message == "ValueError: gone" and code == 1
    assert drivers.each_project(["a"], lambda p: "12 rows") == ([drivers.Step("a", True, "12 rows")], 0)
    assert drivers.each_project([], step) == ([], 0)


FILES, QUEUE, LIBRARIES = "file string, text_doi string, stand_in string", "at int, doi string, projects string", "project string, library string"


def test_plan_ingest_by_hand(spark):
    files = [("s40279-1-z.pdf", None, None), ("s40279-1-z (1).pdf", None, None), ("x.pdf", "10.1/short", None), ("y.pdf", "10.1/none", None), ("run_data_y.pdf", None, None), ("s99999-2.pdf", None, "permissions"), ("y.pdf", "10.1/none", None)]
    queue = [(1, "10.1007/s40279-1-z", "none, run"), (2, "10.1/short", "none"), (3, "10.1/s99999-2", "run"), (4, None, "run"), (5, "", "run")]
    plan = drivers.plan_ingest(spark.createDataFrame(files, FILES), spark.createDataFrame(queue, QUEUE), spark.createDataFrame([("run", "lib/run"), ("big/run_data", "lib/data")], LIBRARIES))
    assert {r.file: (r.outcome, r.doi, r.library) for r in plan.collect()} == {
        "s40279-1-z.pdf": ("FILE", "10.1007/s40279-1-z", "lib/run"), "s40279-1-z (1).pdf": ("DUP", "10.1007/s40279-1-z", "lib/run"), "x.pdf": ("UNMATCHED", "10.1/short", None),
        "y.pdf": ("UNMATCHED", "", None), "run_data_y.pdf": ("FILE", "", "lib/data"), "s99999-2.pdf": ("BOILERPLATE", "10.1/s99999-2", None),
    }


@pytest.mark.parametrize("commit", [False, True])
def test_record_backfill_of_nulls(spark, commit):
    rows = spark.createDataFrame([("a.pdf", None, None, None), ("b.x.PDF", False, None, "10.1/B"), ("c.pdf", True, "10.1/c", None), (None, None, "10.1/b", "10.1/z")], "pdf string, has_record boolean, sidecar_doi string, pdf_doi string")
    got = drivers.record_backfill(rows, spark.createDataFrame([("10.1/b",), ("10.1/b",)], "doi string"), commit).collect()
    said = lambda src: "WROTE" if commit else f"DRY:{src}"
    assert sorted((str(r.pdf), r.status, r.out) for r in got) == [("None", said("sidecar"), None), ("a.pdf", "NO_DOI", ""), ("b.x.PDF", said("pdf"), "b.x.ris"), ("c.pdf", "EXISTS_SKIP", "c.ris")]


PARSED = "src string, fmt string, read boolean, doi string, pmid string, lastname string, title string, year string"
META = "doi string, lastname string, title string, year string"


def test_harvest_by_hand(spark):
    parsed = [("a.ris", "ris", True, "10.1/X", None, "Own", "Own title", "1990"), ("b.ris", "ris", True, "10.1/x", None, None, None, None), ("c.nbib", "nbib", True, None, "7", "P", "T", None), ("d.enw", "enw", True, "", None, "", None, "1"), ("e.enw", None, False, None, None, None, None, None), ("f.enw", "enw", True, None, None, "Roe", "", "2003")]
    args = [spark.createDataFrame(parsed, PARSED), spark.createDataFrame([("10.1/x", "Smith", "Heat and cold", "2001")], META), spark.createDataFrame([], "src string, " + META), spark.createDataFrame([("7", "10.1/p")], "pmid string, doi string")]
    got = {r.src: r for r in drivers.harvest(*args).collect()}
    assert {k: r.status for k, r in got.items()} == {"a.ris": "DRY:crossref-doi", "b.ris": "DUP_SKIP", "c.nbib": "DRY:fallback-nbib", "d.enw": "NO_METADATA", "e.enw": "PARSE_FAIL", "f.enw": "DRY:fallback-enw"}
    assert got["b.ris"].out == got["a.ris"].out and got["a.ris"].out.startswith("2001_Smith_") and got["c.nbib"].doi == "10.1/p"
    present = spark.createDataFrame([(got["a.ris"].out,)], "out string")
    kept = {r.src: r.status for r in drivers.harvest(*args, present).collect()}
    assert kept["a.ris"] == "EXISTS_SKIP" and kept["f.enw"] == "WROTE"
    assert {r.src: r.status for r in drivers.harvest(*args, present, overwrite=True).collect()}["a.ris"] == "WROTE"


def test_empty_tables(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    assert drivers.plan_ingest(none(FILES), none(QUEUE), none(LIBRARIES)).count() == 0
    assert drivers.harvest(none(PARSED), none(META), none("src string, " + META), none("pmid string, doi string")).count() == 0
    assert drivers.queue_status(none("doi string"), none("doi string"), none("doi string")).first() == (0, 0, 0, 0)
    pairs = none("doi string, pmcid string")
    assert drivers.text_backfill(none("filename string, has_sidecar boolean"), none("at int, filename string, doi string"), none("filename string, pmcid string"), pairs, pairs).count() == 0
    assert drivers.text_recheck(none("filename string, head string"), pairs).count() == 0
    plan = drivers.plan_ingest(none(FILES), none(QUEUE), none(LIBRARIES))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan
