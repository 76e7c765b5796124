"""Source and sink queries: citation records, sidecars, registries, recorded API responses, report strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import queues
from ..sources import connectors as C
from ..sources import readers as R
from ..sources import sinks as K
from .projection import Domain
from .registry import query


@query("s09_parse_ris", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '10.1000/x.' || p_partkey ELSE '10.2000/u.' || p_partkey END AS doi, 1970 + p_size AS year, 'Smith' AS lastname, p_name || ' continued ' || p_type AS title, p_brand AS venue, 2 AS n_authors FROM part", views=False)
def ris(d: Domain):
    text = F.expr("concat('TY  - JOUR\nAU  - Smith, ', p_brand, '\nAU  - Jones K\nTI  - ', p_name, '\n   continued ', p_type, '\nJO  - ', p_brand, '\nPY  - ', 1970 + p_size, '/05\n', case when p_partkey % 2 = 0 then concat('DO  - 10.1000/X.', p_partkey) else concat('UR  - https://doi.org/10.2000/u.', p_partkey) end, '\nER  - \n')")
    return d.table("part").select("p_partkey", R.parse_ris(text).alias("r")).select("p_partkey", "r.doi", "r.year", "r.lastname", "r.title", "r.venue", F.size("r.authors").alias("n_authors"))


@query("s10_s13_parse_any", "SELECT p_partkey, '10.1000/x.' || p_partkey AS doi, CAST(1970 + p_size AS VARCHAR) AS year, CASE p_partkey % 3 WHEN 2 THEN 'Doe' ELSE 'Smith' END AS lastname, CASE p_partkey % 3 WHEN 2 THEN p_name || ' wrapped' ELSE p_name END AS title FROM part", views=False)
def any_format(d: Domain):
    name = F.expr("concat('r', p_partkey, element_at(array('.ris', '.enw', '.NBIB'), cast(p_partkey % 3 + 1 as int)))")
    text = F.expr("case p_partkey % 3 when 0 then concat('TY  - JOUR\nAU  - Smith, J\nT1  - ', p_name, '\n  ignored\nY1  - ', 1970 + p_size, '///\nDO  - 10.1000/X.', p_partkey, '\nER  - ') when 1 then concat('%0 Journal Article\n%A Smith, J\n%T ', p_name, '\n%D ', 1970 + p_size, '\n%U https://doi.org/10.1000/x.', p_partkey) else concat('PMID- 12\nTI  - ', p_name, '\n      wrapped\nLID - 10.1000/x.', p_partkey, ' [doi]\nDP  - ', 1970 + p_size, ' May\nFAU - Doe, Jane\nAU  - Doe J') end")
    return d.table("part").select("p_partkey", R.parse_any(name, text).alias("r")).select("p_partkey", "r.*")


@query("s08_x14_sidecars", "SELECT doc_id, doc_id % 5 <> 0 AS readable, CASE WHEN doc_id % 5 <> 0 THEN lang END AS title, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE length(source) + length(lang) END AS text_len, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN 'A B|C D' ELSE 'Smith, J|Doe, K' END AS authors FROM documents", views=False)
def sidecars(d: Domain):
    text = F.expr("""case when doc_id % 5 = 0 then '{"title": "x", broken' else concat('{"title": "', lang, '", "text": "', source, '", "abstract": "', lang, '", "authors": ', case when doc_id % 2 = 0 then '["A B", "C D"]' else '[{"surname": "Smith", "given": "J"}, {"surname": "Doe", "given": "K"}]' end, '}') end""")
    rows = d.table("documents").select("doc_id", text.alias("t"))
    readable = R.is_json(F.col("t"))
    return rows.select("doc_id", readable.alias("readable"), F.when(readable, R.sidecar(F.col("t"))["title"]).alias("title"), R.sidecar_info(F.col("t")).alias("text_len"), F.when(readable, F.array_join(R.sidecar_authors(F.col("t")), "|")).alias("authors"))


@query("s14_f43_parse_jats", "SELECT p_partkey, '10.1000/j.' || p_partkey AS doi, 'PMC' || p_partkey AS pmcid, p_name AS title, CAST(1970 + p_size AS VARCHAR) AS year, 'Smith|Doe' AS surnames, 'Effects of ' || p_type || ' seen.' AS abstract, 'Methods' AS sections, 2 AS n_figures, 1 AS n_tables FROM part", views=False)
def jats(d: Domain):
    xml = F.expr("""concat('<article xmlns:mml="http://www.w3.org/1998/Math/MathML"><front><journal-meta><journal-title>J</journal-title></journal-meta><article-meta><article-id pub-id-type="doi">10.1000/J.', p_partkey, '</article-id><article-id pub-id-type="pmc">', p_partkey, '</article-id><title-group><article-title>', p_name, '</article-title></title-group><contrib-group><contrib contrib-type="author"><name><surname>Smith</surname></name></contrib><contrib contrib-type="author"><name><surname>Doe</surname></name></contrib></contrib-group><pub-date><year>', 1970 + p_size, '</year></pub-date><abstract><p>Effects of ', p_type, ' <xref>[1]</xref>seen.</p></abstract></article-meta></front><body><sec><title>Methods</title><p>x</p><fig/><fig/><table-wrap/></sec></body></article>')""")
    r = d.table("part").select("p_partkey", R.parse_jats(xml).alias("j")).select("p_partkey", "j.*")
    return r.select("p_partkey", "doi", "pmcid", "title", "year", F.array_join("surnames", "|").alias("surnames"), "abstract", F.array_join("body.sections.title", "|").alias("sections"), F.size("body.figures").alias("n_figures"), F.size("body.tables").alias("n_tables"))


@query("s14_x10_x11_jats_body", "SELECT p_partkey, 'Methods' AS titles, 'Heat of ' || p_name || ' is [FORMULA] .' || chr(10) || chr(10) || chr(10) || '## Sub' || chr(10) || p_type AS texts, 'Fig 1: Plot of ' || p_brand || ' (f1.jpg)' AS figure, 'Table 1: Sizes: ' || p_size || ' | b' AS tab, 'inline: no-converter' AS formula FROM part", views=False)
def jats_body(d: Domain):
    xml = F.expr("""concat('<article xmlns:mml="http://www.w3.org/1998/Math/MathML" xmlns:xlink="http://www.w3.org/1999/xlink"><body><sec><title>Methods</title><p>Heat of ', p_name, ' <xref>[1]</xref>is <inline-formula><mml:math><mml:mi>x</mml:mi></mml:math></inline-formula>.</p><sec><title>Sub</title><p>', p_type, '</p></sec><fig><label>Fig 1</label><caption><p>Plot of ', p_brand, '</p></caption><graphic xlink:href="f1.jpg"/></fig><table-wrap><label>Table 1</label><caption><p>Sizes</p></caption><table><tr><td>', p_size, '</td><td>b</td></tr></table></table-wrap></sec><sec><title>References</title><p>gone</p></sec></body></article>')""")
    r = d.table("part").select("p_partkey", R.parse_jats(xml)["body"].alias("b")).select("p_partkey", "b.*")
    shown = lambda c, f: F.array_join(F.transform(c, f), "|")
    return r.select(
        "p_partkey", F.array_join("sections.title", "|").alias("titles"), F.array_join("sections.text", "|").alias("texts"),
        shown("figures", lambda x: F.concat(x["label"], F.lit(": "), x["caption"], F.lit(" ("), x["graphic_href"], F.lit(")"))).alias("figure"),
        shown("tables", lambda x: F.concat_ws(": ", x["label"], x["caption"], x["text"])).alias("tab"),
        shown("formulas", lambda x: F.concat_ws(": ", x["kind"], x["status"])).alias("formula"),
    )


@query("s15_s16_registry", "SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'parent/x' ELSE n_name || '/x' END AS library, CASE WHEN n_nationkey % 3 = 0 THEN 75 ELSE 90 END AS ris_threshold, n_nationkey % 5 <> 0 AS active FROM nation", views=False)
def registry(d: Domain):
    text = F.expr("""concat('{"', n_name, '": {"tier": 1', case when n_nationkey % 2 = 0 then ', "parent": "parent"' else '' end, case when n_nationkey % 3 = 0 then ', "ris_threshold": 75' else '' end, case when n_nationkey % 5 = 0 then ', "active": false' else '' end, ', "lib_dir": "x"}}')""")
    return R.registry_rows(d.table("nation").select(text.alias("text"))).select("name", "library", "ris_threshold", "active")


@query("s17_pmcid_map", "SELECT doc_id, '10.1/' || doc_id AS doi, 'PMC' || doc_id AS pmcid FROM documents", views=False)
def pmcid_map(d: Domain):
    text = F.expr("""case doc_id % 3 when 0 then concat('{"10.1/', doc_id, '": "PMC', doc_id, '"}') when 1 then concat('{"map": {"10.1/', doc_id, '": "PMC', doc_id, '"}}') else concat('[{"doi": "DOI:10.1/', doc_id, '", "pmcid": "PMC', doc_id, '"}]') end""")
    return d.table("documents").select("doc_id", F.explode(R.pmcid_map(text)).alias("p")).select("doc_id", "p.doi", "p.pmcid")


@query("s05_latest_report", "SELECT doc_id FROM (SELECT doc_id, source, doc_id % 6 AS stamp, max(doc_id % 6) OVER (PARTITION BY source) AS newest FROM documents) WHERE stamp = newest", views=False)
def latest_report(d: Domain):
    rows = d.table("documents").select("doc_id", "source", F.expr("doc_id % 6").alias("stamp"))
    return R.latest(rows, "stamp", ["source"]).select("doc_id")


@query("s22_doi_sources", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'ris.' WHEN doc_id % 4 = 1 THEN 'sidecar.' ELSE 'pdf.' END || doc_id AS doi FROM documents", views=False)
def doi_sources(d: Domain):
    docs = d.table("documents").select("doc_id")
    ris = docs.filter("doc_id % 4 = 0").select("doc_id", F.expr("concat('ris.', doc_id)").alias("r"))
    side = docs.filter("doc_id % 4 < 3").select("doc_id", F.expr("case when doc_id % 4 = 2 then '' else concat('sidecar.', doc_id) end").alias("s"))
    return docs.join(ris, "doc_id", "left").join(side, "doc_id", "left").select("doc_id", F.coalesce(F.nullif("r", F.lit("")), F.nullif("s", F.lit("")), F.expr("concat('pdf.', doc_id)")).alias("doi"))


@query("j15_j16_pmcid_lookup", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'api' WHEN doc_id % 3 = 0 THEN 'exact' WHEN doc_id % 5 = 0 THEN 'folded' END AS pmcid FROM documents", views=False)
def pmcid_lookup(d: Domain):
    from ..functions.names import safe_ascii

    docs = d.table("documents").select("doc_id", F.expr("concat('é', doc_id, '.pdf')").alias("name"))
    api = docs.filter("doc_id % 2 = 0").select("name", F.lit("api").alias("a"))
    exact = docs.filter("doc_id % 3 = 0").select("name", F.lit("exact").alias("x"))
    folded = docs.filter("doc_id % 5 = 0").select(safe_ascii(F.col("name")).alias("key"), F.lit("folded").alias("f"))
    j = docs.withColumn("key", safe_ascii(F.col("name"))).join(api, "name", "left").join(exact, "name", "left").join(folded, "key", "left")
    return j.select("doc_id", F.coalesce("a", "x", "f").alias("pmcid"))


# ------------------------------------------------------------------------------------------------ recorded responses


def _recorded(d: Domain, api: str, body: str, key: str = "concat('10.1/', doc_id)"):
    return d.table("documents").select(F.lit(api).alias("api"), F.expr(key).alias("key"), F.expr("case when doc_id % 10 = 9 then 404 else 200 end").alias("status"), F.expr(body).alias("body"))


WORK = """concat('{"message": {"DOI": "10.1/', upper(lang), doc_id, '", "title": ["T ', source, '"], "container-title": ["J"], "page": "812-822", "volume": "3", "type": "', case when doc_id % 4 = 0 then 'posted-content' else 'journal-article' end, '", "ISSN": ["1-2"], "author": [{"family": "Givoni", "given": "B"}, {"family": "Plato"}], ', case when doc_id % 3 = 0 then '"published-print": {"date-parts": [[2001, 5]]}, ' else '' end, '"issued": {"date-parts": [[1999]]}, "abstract": "<p>a &lt;b ', lang, '</p>"}}')"""


@query("c02_f24_works", "SELECT '10.1/' || doc_id AS key, '10.1/' || lang || doc_id AS doi, 'T ' || source AS title, CASE WHEN doc_id % 3 = 0 THEN '2001' ELSE '1999' END AS year, CASE WHEN doc_id % 3 = 0 THEN '2001/05' ELSE '1999' END AS date, 'Givoni' AS lastname, 'J' AS container, '812-822' AS page, CASE WHEN doc_id % 4 = 0 THEN 'posted-content' ELSE 'journal-article' END AS type FROM documents WHERE doc_id % 10 <> 9", views=False)
def works(d: Domain):
    return C.works(_recorded(d, "crossref", WORK)).select("key", "doi", "title", "year", "date", "lastname", "container", "page", "type")


@query("k03_build_ris", "SELECT '10.1/' || doc_id AS key, 'TY  - ' || CASE WHEN doc_id % 4 = 0 THEN 'UNPD' ELSE 'JOUR' END || chr(10) || 'AU  - Givoni, B' || chr(10) || 'AU  - Plato' || chr(10) || 'TI  - T ' || source || chr(10) || 'JO  - J' || chr(10) || 'PY  - ' || CASE WHEN doc_id % 3 = 0 THEN '2001' || chr(10) || 'DA  - 2001/05' ELSE '1999' || chr(10) || 'DA  - 1999' END || chr(10) || 'VL  - 3' || chr(10) || 'SP  - 812' || chr(10) || 'EP  - 822' || chr(10) || 'DO  - 10.1/' || lang || doc_id || chr(10) || 'SN  - 1-2' || chr(10) || 'UR  - https://doi.org/10.1/' || lang || doc_id || chr(10) || 'AB  - a &lt;b ' || lang || chr(10) || 'ER  - ' || chr(10) AS ris FROM documents WHERE doc_id % 10 <> 9", views=False)
def build_ris(d: Domain):
    m = C.works(_recorded(d, "crossref", WORK))
    return m.select("key", K.build_ris({c: F.col(c) for c in m.columns}).alias("ris"))


@query("c05_abstracts", "SELECT '10.1/' || doc_id AS doi, 'a <b ' || lang AS abstract FROM documents WHERE doc_id % 10 <> 9", views=False)
def recorded_abstracts(d: Domain):
    return C.abstracts(_recorded(d, "crossref", WORK))


HITS = """concat('{"message": {"items": [{"score": 90.5, "DOI": "10.1/A', doc_id, '", "type": "dataset"}, {"score": ', 50 + doc_id % 30, ', "DOI": "10.1/B', doc_id, '", "type": "journal-article"}]}}')"""


@query("c04_work_hits", "SELECT '10.1/' || doc_id AS key, CAST(k AS INTEGER) AS at, CASE k WHEN 0 THEN 90.5 ELSE CAST(50 + doc_id % 30 AS DOUBLE) END AS score, CASE k WHEN 0 THEN '10.1/a' ELSE '10.1/b' END || doc_id AS doi FROM documents, (SELECT unnest([0, 1]) AS k) WHERE doc_id % 10 <> 9", views=False)
def work_hits(d: Domain):
    return C.work_hits(_recorded(d, "crossref_query", HITS)).select("key", "at", "score", "doi")


OA = """concat('{"is_oa": true, "oa_locations": [{"host_type": "publisher", "version": "publishedVersion", "url_for_pdf": "p.pdf", "url": "p"}, {"host_type": "repository", "version": null, "url_for_pdf": "r', doc_id % 7, '.pdf", "url": "r"}, {"host_type": "repository", "version": "acceptedVersion", "url_for_pdf": null, "url": "', case when doc_id % 2 = 0 then 'r' else 'q' end, '"}]}')"""


@query("c01_t04_locations", "SELECT '10.1/' || doc_id AS doi, CAST(i AS INTEGER) AS rank, url FROM (SELECT doc_id, unnest(l) AS url, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN ['r', 'r' || (doc_id % 7) || '.pdf', 'p.pdf', 'p'] ELSE ['q', 'r' || (doc_id % 7) || '.pdf', 'r', 'p.pdf', 'p'] END AS l FROM documents WHERE doc_id % 10 <> 9))", views=False)
def locations(d: Domain):
    return queues.best_locations(C.open_locations(_recorded(d, "unpaywall", OA)))


CITING = """concat('{"data": [{"citingPaper": {"paperId": "p', doc_id, '", "title": "T", "year": 2001, "citationCount": ', doc_id % 50, ', "authors": [{"name": "A B"}, {"name": "C D"}], "externalIds": {"DOI": "10.5/X.', doc_id, '"}}}, {"citingPaper": {"paperId": "q", "title": "U", "authors": []}}]}')"""


@query("c06_x15_citing", "SELECT '10.1/' || doc_id AS seed_doi, CASE WHEN k = 0 THEN '10.5/x.' || doc_id ELSE '' END AS citing_doi, CASE WHEN k = 0 THEN 'A B; C D' ELSE '' END AS citing_authors, CASE WHEN k = 0 THEN CAST(doc_id % 50 AS INTEGER) ELSE 0 END AS citing_cited_by FROM documents, (SELECT unnest([0, 1]) AS k) WHERE doc_id % 10 <> 9", views=False)
def citing(d: Domain):
    return C.citing_rows(_recorded(d, "citations", CITING)).select("seed_doi", "citing_doi", "citing_authors", "citing_cited_by")


RECS = """concat('{"recommendedPapers": [{"title": "a"}, {"title": "b", "externalIds": {"DOI": "10.7/B', doc_id, '"}}, {"title": "c", "externalIds": {"DOI": "10.7/c"}}]}')"""


@query("c07_w02_recommended", "SELECT '10.1/' || doc_id AS seed_doi, CASE k WHEN 2 THEN '10.7/b' || doc_id ELSE '10.7/c' END AS recommended_doi, CAST(k AS INTEGER) AS rank FROM documents, (SELECT unnest([2, 3]) AS k) WHERE doc_id % 10 <> 9", views=False)
def recommended(d: Domain):
    return C.recommendations(_recorded(d, "recommendations", RECS))


IDS = """concat('{"records": [{"doi": "10.8/', doc_id, '", "pmcid": "PMC', doc_id, '"}, {"requested-id": "10.9/Z', doc_id, '"}]}')"""


@query("c08_id_records", "SELECT '10.8/' || doc_id AS doi, 'PMC' || doc_id AS pmcid FROM documents WHERE doc_id % 10 <> 9", views=False)
def id_records(d: Domain):
    return C.id_records(_recorded(d, "idconv", IDS))


@query("c15_download_status", "SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'HTTP_403' WHEN doc_id % 6 = 1 THEN 'EMPTY' WHEN doc_id % 6 = 2 THEN 'HTML' WHEN doc_id % 6 = 3 THEN 'TOO_SMALL' WHEN doc_id % 6 = 4 THEN 'TOO_LARGE' ELSE 'OK' END AS status FROM documents", views=False)
def download_status(d: Domain):
    e = F.expr
    status = C.download_status(e("case when doc_id % 6 = 0 then 403 else 200 end"), e("case when doc_id % 6 = 2 then ' <html' else '%PDF-1' end"), e("element_at(array(9L, 0L, 20000L, 500L, 60000000L, 20000L), cast(doc_id % 6 + 1 as int))"), F.lit(None).cast("string"))
    return d.table("documents").select("doc_id", status.alias("status"))


@query("c12_atom_entries", "SELECT doc_id, 'T ' || lang || '|U' AS titles FROM documents", views=False)
def atom(d: Domain):
    xml = F.expr("""concat('<feed xmlns="http://www.w3.org/2005/Atom"><title>x</title><entry><title>T ', lang, '</title></entry><entry><title>U</title></entry></feed>')""")
    return d.table("documents").select("doc_id", F.array_join(C.atom_entries(xml), "|").alias("titles"))


# ----------------------------------------------------------------------------------------------------- sink strings


@query("k04_only_new", "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 4 <> 0", views=False)
def only_new(d: Domain):
    rows = d.table("documents").select("doc_id", F.col("doc_id").alias("stem"), F.expr("case when doc_id % 3 = 0 then '' else lang end").alias("text"))
    return K.only_new(rows, rows.filter("doc_id % 4 = 0")).select("doc_id")


@query("k07_f39_markdown", "SELECT doc_id, '- [ ] **' || CASE WHEN doc_id % 5 = 0 THEN '(no title)' ELSE lang END || '**' || CASE WHEN doc_id % 2 = 0 THEN ' (2001)' ELSE '' END || ' — DOI `10.1/' || doc_id || '` — ' || CASE WHEN doc_id % 3 = 0 THEN 'oa_status=CLOSED; pmc=no_report' ELSE 'unknown' END AS line FROM documents", views=False)
def markdown(d: Domain):
    rows = d.table("documents").select("doc_id", F.expr("case when doc_id % 5 = 0 then '' else lang end").alias("title"), F.expr("case when doc_id % 2 = 0 then '2001' else '' end").alias("year"), F.expr("concat('10.1/', doc_id)").alias("doi"), F.expr("case when doc_id % 3 = 0 then 'CLOSED' end").alias("oa_status"), F.lit("").alias("error"), F.expr("case when doc_id % 3 = 0 then 'no_report' else 'skip' end").alias("stage_pmc"), F.lit("skip").alias("stage_preprint"))
    return rows.select("doc_id", K.markdown_item(F.col("title"), F.col("year"), F.col("doi"), queues.stage_trace(rows)).alias("line"))


@query("k10_rename_plan", "SELECT 'a' || doc_id || s AS current, 'b' || doc_id || s AS proposed FROM documents, (SELECT unnest(['.pdf', '.ris', '.fulltext.json']) AS s) WHERE doc_id % 4 = 0", views=False)
def rename_plan(d: Domain):
    docs = d.table("documents")
    plan = docs.filter("doc_id % 4 = 0").select(F.expr("concat('a', doc_id)").alias("stem"), F.expr("concat('b', doc_id)").alias("new_stem"))
    files = docs.select(F.expr("concat('a', doc_id)").alias("stem"), F.explode(F.array(*[F.lit(s) for s in (".pdf", ".ris", ".fulltext.json")])).alias("suffix"))
    return K.rename_plan(plan, files)


@query("f29_f30_pages_types", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '267' ELSE 'e12' END AS sp, CASE WHEN doc_id % 2 = 0 THEN '277' ELSE '' END AS ep, CASE doc_id % 3 WHEN 0 THEN 'CHAP' WHEN 1 THEN 'JOUR' ELSE 'THES' END AS type FROM documents", views=False)
def pages_types(d: Domain):
    page, kind = F.expr("case when doc_id % 2 = 0 then '267 – 277' else 'e12' end"), F.expr("case doc_id % 3 when 0 then 'book-chapter' when 1 then 'whatever' else 'thesis' end")
    return d.table("documents").select("doc_id", K.page_span(page).alias("p"), K.ris_type(kind).alias("type")).select("doc_id", "p.sp", "p.ep", "type")
