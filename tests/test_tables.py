"""Maintenance invariants, sinks and the incremental run."""

from pyspark.sql import functions as F

from quillspark.operators import citations, queues, tables
from quillspark.sources import readers, sinks
from quillspark.streaming import incremental


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_keeps_the_abstract_and_is_idempotent(spark):
    target = spark.createDataFrame([("a", "old", "KEPT"), ("b", "b", None)], "doi string, title string, abstract string")
    new = spark.createDataFrame([("a", "new"), ("c", "c")], "doi string, title string")
    once = tables.upsert_keeping(target, new, ["doi"], ["abstract"])
    assert pairs(once.na.fill("")) == [("a", "new", "KEPT"), ("b", "b", ""), ("c", "c", "")]
    assert pairs(tables.upsert_keeping(once, new, ["doi"], ["abstract"]).na.fill("")) == pairs(once.na.fill(""))


def test_insert_missing_never_overwrites(spark):
    target = spark.createDataFrame([("a", 1)], "doi string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 2)], "doi string, v int")
    assert pairs(tables.insert_missing(target, new, ["doi"])) == [("a", 1), ("b", 2)]


def test_empty_scopes(spark):
    target = spark.createDataFrame([("a", "p"), ("b", "q")], "doi string, project string")
    none = target.limit(0)
    assert pairs(tables.replace_where(target, none, F.col("project") == "p")) == [("b", "q")]
    assert pairs(tables.prune_missing(target, none, ["doi"], F.col("project") == "q")) == [("a", "p")]


def test_garbage(spark):
    meta = spark.createDataFrame([("a",), ("b",), ("c",)], "doi string")
    pins = [(spark.createDataFrame([("a",)], "x string"), "x"), (spark.createDataFrame([("b", None)], "x string, y string"), "y")]
    assert pairs(tables.unreferenced(meta, "doi", pins)) == [("b",), ("c",)]
    assert pairs(tables.collect_garbage(meta, "doi", pins)) == [("a",)]


def test_residual_chain(spark):
    queue = spark.createDataFrame([("10.1/A",), ("10.1/b",), ("10.1/c",), ("10.1/d",)], "doi string")
    report = lambda *r: spark.createDataFrame(list(r), "doi string, downloaded string, status string")
    left = queues.residual(queue, [report(("10.1/a", "True", "")), report(("10.1/B", "False", "ALREADY_EXISTS"), ("10.1/c", "False", "CLOSED"))])
    assert pairs(left) == [("10.1/c",), ("10.1/d",)]


def test_snowball_stops():
    sizes = {0: 100, 1: 150, 2: 151, 3: 300}
    state, log, done = citations.snowball(lambda s: s + 1, sizes.__getitem__, 0)
    assert (state, done) == (2, True) and log[0]["growth_pct"] == 50.0
    assert citations.snowball(lambda s: 1 / 0, lambda s: 5, 0)[2] is False
    assert citations.snowball(lambda s: s + 1, lambda s: s, 0, max_rounds=1)[1][0]["growth_pct"] == float("inf")


def test_swap_and_reports(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for v in (1, 2):
        sinks.swap(spark.createDataFrame([(v,)], "v int"), path)
        assert pairs(spark.read.parquet(path)) == [(v,)]
    sinks.write_report(spark.createDataFrame([("Périard JD; Mølmen Ø", 1)], "authors string, extra int"), f"{path}.csv", ["authors"])
    assert pairs(readers.read_csv(spark, f"{path}.csv", readers.strings("authors"))) == [("Périard JD; Mølmen Ø",)]
    assert readers.first_existing(spark, [f"{path}.none", path]) == path


def test_commented_csv(spark, tmp_path):
    (tmp_path / "p1").mkdir()
    (tmp_path / "p1" / "q.csv").write_text("# draft\ndoi,title,authors,year,destination,notes\n10.1/a,T,,2001,,\n# x\n")
    df = readers.with_project(readers.read_csv(spark, f"file://{tmp_path}/*/q.csv", readers.QUEUE, comments=True), r"/([^/]+)/q\.csv")
    assert [(r.doi, r.year, r.project) for r in df.collect()] == [("10.1/a", "2001", "p1")]


def test_files_without_contents(spark, tmp_path):
    (tmp_path / "a.b.pdf").write_bytes(b"%PDF-1")
    df = readers.list_files(spark, f"file://{tmp_path}")
    assert [(r.stem, r.length) for r in df.collect()] == [("a.b", 6)]


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"q{i}.csv").write_text(f"doi,title\nhttps://doi.org/10.1234/A.{i},t{i}\n10.1234/abc,bad\n")
    seen = []
    stream = incremental.queue_stream(spark, f"file://{tmp_path}/in", readers.strings("doi", "title"), per_trigger=1)
    incremental.run_available(stream, lambda df, _: seen.extend(df.collect()), f"file://{tmp_path}/ck")
    assert sorted(r.doi for r in seen) == ["10.1234/a.0", "10.1234/a.1", "10.1234/a.2"]
    incremental.run_available(stream, lambda df, _: seen.extend(df.collect()), f"file://{tmp_path}/ck")
    assert len(seen) == 3


MML = '<math xmlns="http://www.w3.org/1998/Math/MathML"><mi>x</mi></math>'
PAPER = f"""<article xmlns:mml="http://www.w3.org/1998/Math/MathML"><front><article-meta><article-title>T</article-title><abstract><p>A <xref>1</xref>b</p></abstract></article-meta></front>
<body><sec><title>One</title><p>See <inline-formula><mml:math><mml:mi>x</mml:mi></mml:math></inline-formula><fig><label>F</label><caption><p>cap <xref>2</xref>tion</p></caption></fig> now</p>
<list><list-item><p>item</p></list-item></list><disp-formula><label>(1)</label>plain</disp-formula><table-wrap><label>T1</label><table><th>h</th></table></table-wrap></sec><sec><title>References</title><p>gone</p></sec></body></article>"""


def test_jats_keeps_the_body(spark):
    """Texts, captions, cells and formulas, with and without recorded LaTeX; the recorded key is the MathML with its own name space."""
    df = spark.createDataFrame([(PAPER,)], "xml string")
    b = df.select(readers.parse_jats(F.col("xml"))["body"].alias("b")).first().b
    assert [tuple(s) for s in b.sections] == [("One", "See [FORMULA] now\n\n  - item\n\n[FORMULA]")]
    assert [(f.label, f.caption) for f in b.figures] == [("F", "cap tion")] and [tuple(t) for t in b.tables] == [("T1", "", "h")]
    assert [(f.kind, f.label, f.latex, f.status) for f in b.formulas] == [("display", "(1)", "", "no-converter"), ("inline", "", "", "no-converter")]
    assert b.n_formulas == 2 and b.text.startswith("# T\n\n## Abstract\n\nA b\n\n## One\n\nSee [FORMULA] now")
    b = df.select(readers.parse_jats(F.col("xml"), F.create_map(F.lit(MML), F.lit("{T r e c}")))["body"].alias("b")).first().b
    assert [(f.latex, f.status) for f in b.formulas] == [("", "no-mathml"), ("{Trec}", "ok")]
    assert b.sections[0].text.startswith("See ${Trec}$ now")


def test_suffix_match_has_all_keys(spark, tmp_path):
    """More keys than a registry may have that is broadcast: the last ones in order match too."""
    from quillspark.plans.catalog import QUERIES

    rows = [(i, "zz" if i % 2 else None, f"site{i:05}" if i % 3 else f"s{i}") for i in range(9000)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.k for r in QUERIES["j11_suffix_match"](spark, str(tmp_path)).collect()}
    assert got == {i: f"zz_{s}" for i, lang, s in rows if lang and len(f"zz_{s}") >= 6}
