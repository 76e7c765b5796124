"""Scalar functions by tables of input and expected value."""

import difflib
import unicodedata

import pytest
from pyspark.sql import functions as F

from quillspark.functions import doi as D
from quillspark.functions import match as M
from quillspark.functions import names as N
from quillspark.functions import text as X
from quillspark.operators import audit
from quillspark.sources import readers as R
from quillspark.sources import sinks as K


def check(spark, f, cases, kind="string"):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], f"i int, x {kind}")
    got = [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]
    assert got == [c[1] for c in cases]


def test_coerce_int(spark):
    check(spark, D.coerce_int, [("1,234", 1234), ("  12 ", 12), ("2020.0", 2020), ("2020.7", 2020), ("42", 42), ("in press", 0), ("2020a", 0), ("n/a", 0), ("", 0), (None, 0), ("inf", 0)])
    check(spark, lambda c: D.coerce_int(c, -1), [("x", -1), ("5", 5)])
    check(spark, D.safe_int, [("12.0", 0), ("1,234", 0), ("7", 7), (None, 0)])


def test_doi(spark):
    check(spark, D.normalize_doi, [("https://doi.org/10.1/A", "10.1/a"), ("http://dx.doi.org/10.1/A.", "10.1/a"), (" doi:10.1/a).", "10.1/a"), (None, "")])
    check(spark, D.extract_doi, [("10.1002/cphy.\nc140066", "10.1002/cphy.c140066"), ("10.1001/archinte\nmed", ""), ("10.1152/jappl.1972.32.6.812).", "10.1152/jappl.1972.32.6.812"), ("10.1234/ abc", ""), (None, "")])
    check(spark, D.is_suspicious_doi, [("10.1002/cphy", True), ("10.1002/cphy.c1", False), ("x", True)])


def test_safe_ascii(spark):
    cases = [("Périard", "Periard"), ("Müller-García", "Muller-Garcia"), ("Lüthi", "Luthi"), ("Mølmen", "Molmen"), ("Hjørnevik", "Hjornevik"), ("ß", "ss"), ("Ø", "O"), ("", ""), (None, ""), ("a中b", "ab")]
    check(spark, N.safe_ascii, cases)
    check(spark, N.safe_ascii_exact, cases)
    for c in map(chr, range(0xC0, 0x250)):
        folded = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if c in N.ACCENTED:
            assert N.FOLDED[N.ACCENTED.index(c)] == folded


def test_names(spark):
    check(spark, N.last_name, [("J Smith; K Jones", "Smith"), ("Smith J; Jones K", "Smith"), ("Cramer MN, Jay O", "Cramer"), ("Smith, John; Doe, Jane", "Smith"), ("Hoffman GE; Roussos P", "Hoffman"), ("Malchaire J, Piette A, et al", "Malchaire"), ("T. Gabbett", "Gabbett"), ("Périard JD", "Periard"), ("", "Unknown"), (None, "Unknown")])
    check(spark, N.slug, [("<i>In vivo</i> heat acclimation", "VivoHeatAcclimation"), ("", "Untitled"), (None, "Untitled")])
    check(spark, lambda c: N.build_filename(F.lit("2019"), F.lit("García-López J"), c), [("Heat acclimation review", "2019_Garcia-Lopez_HeatAcclimationReview.pdf")])
    check(spark, lambda c: N.companion(c, ".ris"), [("2010_Smith_Heat.4.26.pdf", "2010_Smith_Heat.4.26.ris"), ("a.PDF", "a.ris")])
    check(spark, lambda c: N.is_bundle(c, F.lit("")), [("2007_IJCSS_Vol6_Edition2.pdf", True), ("2006_Hellard_Banister_Limitations.pdf", False)])
    check(spark, lambda c: N.filename_hints(c)["kind"], [("2010_Smith_HeatMap.pdf", "canonical"), ("2010_Smith_heat_map.pdf", "canonical-loose"), ("smith_2010_heat.pdf", "legacy"), ("scan.pdf", "gibberish")])
    check(spark, lambda c: N.filename_hints(c)["year"], [("0000_Smith_HeatMap.pdf", ""), ("1999_Smith_HeatMap.pdf", "1999")])


def score(spark, hint_year, hint_author, top, runner=(None, None, None), demoted=False):
    cols = lambda t: {"score": F.lit(t[0]).cast("double"), "family": F.lit(t[1]).cast("string"), "year": F.lit(t[2]).cast("string")}
    return spark.range(1).select(M.score_match(F.lit(hint_year), F.lit(hint_author), cols(top), cols(runner), F.lit(demoted))).first()[0]


def test_score_match(spark):
    assert score(spark, "2020", "Mølmen", (90, "Molmen", "2020"), (50, "X", "2020")) == "HIGH"
    assert score(spark, "2020", "Smith", (90, "Smith", "2020"), (89, "Smith", "2020")) == "HIGH"  # near twins
    assert score(spark, "2020", "Smith", (90, "Smith", "2020"), (89, "Jones", "2020")) == "AMBIG"
    assert score(spark, "", "Smith", (90, "Smith", "2020"), (50, "Y", "2020")) == "MED_NO_YEAR"
    assert score(spark, "2010", "Smith", (90, "Smith", "2020")) == "MED_AUTHOR_YEAR_MISMATCH"
    assert score(spark, "2019", "Smith", (90, "Smith", "2020")) == "MED_AUTHOR_ONLY"
    assert score(spark, "2020", "", (90, "", "2020"), (50, "", "2020")) == "MED_TITLE_STRONG"
    assert score(spark, "2011", "Other", (90, "Smith", "2020"), (50, "Y", "2020")) == "LOW_TITLE_ONLY"
    assert score(spark, "2020", "Smith", (90, "Smith", "1990"), demoted=True) == "MED_TYPE_MISMATCH"
    assert score(spark, "2020", "Smith", (90, "Jones", "1990"), demoted=True) == "AMBIG"
    assert score(spark, "2020", "Smith", (None, None, None)) == "NO_RESULT"


def test_similarity_is_difflibs(spark):
    pairs = [("heat stress", "heat strain"), ("", "a"), ("abc", "abc"), (None, "x")]
    got = [r[0] for r in spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i").select(M.title_similarity("a", "b")).collect()]
    assert got == pytest.approx([difflib.SequenceMatcher(None, a or "", b or "").ratio() for a, b in pairs])


def test_clean_text(spark):
    check(spark, X.clean_pdf_text, [("eﬃcient ﬁt core-\nbody\n12\n", "efficient fit core-\nbody\n12\n")])
    check(spark, lambda c: X.clean_pdf_text(c, dehyphenate=True), [("core-\n body", "corebody")])
    check(spark, lambda c: X.clean_pdf_text(c, page_numbers=True), [("a\n 12 \nb", "a\nb")])
    check(spark, lambda c: X.clean_pdf_text(c, typography=True), [("“x” – y — z", '"x" - y -- z')])


def test_references(spark):
    numbered = "".join(f"\n[{i}] {'Smith, J. (2001) Some long enough reference text ' + str(i)}" for i in range(1, 7))
    check(spark, lambda c: F.size(X.split_references(c)), [(numbered, 6), ("\n[1] short\n\n" + "x" * 40, 1)])
    check(spark, lambda c: X.parse_reference(c)["title_snippet"], [("Smith, J. (2001). A title here. Journal 3", "A title here")])


def test_upper_median(spark):
    df = spark.createDataFrame([("even", v) for v in (1, 2, 3, 4)] + [("odd", v) for v in (5, 6, 7)], "k string, v int")
    assert {r.k: r.median for r in audit.upper_median(df, ["k"], "v").collect()} == {"even": 3, "odd": 6}


def test_ris_records(spark):
    text = "TY  - JOUR\nTI  - A wrapped\n   title\nAU  - \nUR  - https://doi.org/10.1234/ab.1\nPY  - 2001/02\n"
    row = spark.createDataFrame([(text,), (None,)], "x string").select(R.parse_ris(F.col("x")).alias("r")).select("r.*").first()
    assert (row.title, row.doi, row.year, row.lastname) == ("A wrapped title", "10.1234/ab.1", 2001, "")
    check(spark, lambda c: K.page_span(c)["ep"], [("812-822", "822"), ("e5", ""), (None, "")])
    assert [K.archive_number(n, "q") for n in ([], ["q.processed.csv"], ["q.processed.csv", "q.processed.2.csv"])] == ["q.processed.csv", "q.processed.2.csv", "q.processed.3.csv"]


def test_filename_hints_take_the_first_year(spark):
    """A legacy name's year, else the first four digits that can be one, dropped wherever they stand, as in the reference."""
    names = [("scan_1903__2005_final.pdf", ("1903", " 2005 final")), ("Scan_1903__2005_final.pdf", ("1903", "Scan 2005 final")), ("scan_20051__2005_final.pdf", ("2005", "scan 1 final")), ("scan_21903__2005.PDF", ("2005", "scan 21903")), ("scan.pdf", ("", "scan"))]
    check(spark, lambda c: F.concat_ws("|", N.filename_hints(c)["year"], N.filename_hints(c)["title"]), [(n, "|".join(w)) for n, w in names])


def test_filename_hints_query_at_all_ids(spark, tmp_path):
    """Against the twin: ids that look like years, or that hold the digits of the year of the name."""
    import duckdb

    from conftest import SF, TABLES
    from quillspark.plans import catalog
    from test_catalog import rows

    ids = [*range(1890, 2110), 20051, 20055, 20059, 120051, 200503, 120200503, 20052003, 200520051, 2020050511, 20050520059]
    docs = spark.createDataFrame([(i,) for i in ids], "doc_id long").selectExpr("doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{f'{tmp_path}/documents.parquet/*.parquet' if t == 'documents' else f'{SF}/{t}.parquet'}'")
    got = catalog.QUERIES["f15_filename_hints"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.execute(catalog.ORACLE["f15_filename_hints"]).df()) and len(got) == len(ids)
