"""Queries of whole runs.  The inputs are one SQL text that both engines run; the outcomes are computed by each in its own way."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import drivers
from .projection import Domain
from .registry import query

FILES = """SELECT CASE WHEN doc_id % 8 IN (0, 5, 6, 7) THEN 'art-' || lang || '-s' || lpad(CAST(doc_id AS STRING), 9, '0') || 'Z.pdf' WHEN doc_id % 8 = 1 THEN 'art-' || lang || '-s' || lpad(CAST(doc_id - 1 AS STRING), 9, '0') || 'z (1).PDF'
  WHEN doc_id % 8 = 3 THEN upper(source) || '_x' || doc_id || '.pdf' ELSE 'get' || doc_id || '.pdf' END AS file,
  CASE WHEN doc_id % 8 = 2 THEN '10.1/s' || lpad(CAST(doc_id AS STRING), 9, '0') || 'z' WHEN doc_id % 8 = 4 THEN '10.9/none' END AS text_doi, CASE WHEN doc_id % 8 = 5 AND doc_id % 3 > 0 THEN 'permissions' END AS stand_in FROM documents"""
QUEUE = """SELECT doc_id AS at, '10.1/' || CASE WHEN doc_id % 11 = 0 THEN 's' || doc_id % 10 ELSE 's' || lpad(CAST(doc_id AS STRING), 9, '0') || 'z' END AS doi,
  CASE WHEN doc_id % 8 = 6 THEN 'other, none' WHEN doc_id % 8 = 7 THEN 'none,' || source || ', ' || lang ELSE source END AS projects FROM documents WHERE doc_id % 8 NOT IN (1, 3, 4)"""
LIBRARIES = "SELECT DISTINCT CASE WHEN length(source) % 2 = 0 THEN 'group/' || source ELSE source END AS project, 'lib/' || source AS library FROM documents UNION SELECT DISTINCT source, 'own/' || source FROM documents WHERE length(source) % 2 = 0 UNION SELECT DISTINCT lang, 'lang/' || lang FROM documents"

PARSED = """SELECT 'f' || lpad(CAST(doc_id AS STRING), 7, '0') AS src, CASE WHEN doc_id % 3 = 0 THEN 'ris' ELSE 'nbib' END AS fmt, doc_id % 13 <> 0 AS read, CASE WHEN doc_id % 4 = 0 THEN '10.1/H' || doc_id % 90 ELSE '' END AS doi, CAST(doc_id % 70 AS STRING) AS pmid,
  CASE WHEN doc_id % 17 < 2 THEN '' ELSE 'Smith' || lang END AS lastname, CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'Heat of ' || source || ' runners' END AS title, CAST(1990 + doc_id % 30 AS STRING) AS year FROM documents"""
WORKS = "SELECT DISTINCT '10.1/h' || doc_id % 90 AS doi, 'Jones' AS lastname, 'Cold swimmers ' || doc_id % 90 AS title, '2001' AS year FROM documents WHERE doc_id % 90 > 20"
SEARCHED = "SELECT 'f' || lpad(CAST(doc_id AS STRING), 7, '0') AS src, '10.2/T' || doc_id % 40 AS doi, 'Doe' AS lastname, 'Found ' || source AS title, '1999' AS year FROM documents WHERE doc_id % 5 = 1"
PMIDS = "SELECT DISTINCT CAST(doc_id % 70 AS STRING) AS pmid, '10.1/h' || doc_id % 70 AS doi FROM documents WHERE doc_id % 70 < 40"
RECORDS = "SELECT 'p' || doc_id || '.pdf' AS pdf, doc_id % 7 = 0 AS has_record, CASE WHEN doc_id % 3 = 0 THEN ' 10.1/H' || doc_id % 90 WHEN doc_id % 3 = 1 THEN ' ' END AS sidecar_doi, CASE WHEN doc_id % 5 > 1 THEN '10.1/h' || doc_id % 50 ELSE '' END AS pdf_doi FROM documents"
TEXTS = "SELECT CASE WHEN doc_id % 6 = 0 THEN 'é' ELSE '' END || 'p' || doc_id || '.pdf' AS filename, doc_id % 9 = 0 AS has_sidecar FROM documents"
NAMES = "SELECT doc_id AS at, CASE WHEN doc_id % 12 = 0 THEN 'é' ELSE '' END || 'p' || doc_id || '.pdf' AS filename, CASE WHEN doc_id % 10 = 0 THEN '' ELSE '10.1/t' || doc_id % 300 END AS doi FROM documents WHERE doc_id % 4 < 3"
BY_FILE = "SELECT 'p' || doc_id || '.pdf' AS filename, 'PMC9' || doc_id AS pmcid FROM documents WHERE doc_id % 4 = 3 AND doc_id % 5 > 0"
IDS = "SELECT DISTINCT '10.1/t' || doc_id % 300 AS doi, 'PMC' || doc_id % 300 AS pmcid FROM documents WHERE doc_id % 300 % 3 > 0"
BY_DOI = "SELECT DISTINCT '10.1/t' || doc_id % 300 AS doi, 'PMC0' || doc_id % 300 AS pmcid FROM documents WHERE doc_id % 300 % 2 > 0"
FETCHED = "SELECT DISTINCT 'PMC' || doc_id % 300 AS pmcid, CASE WHEN doc_id % 300 % 5 = 0 THEN 'HTTP_503' ELSE 'OK' END AS status FROM documents WHERE doc_id % 300 % 4 > 0"


def _in(d: Domain, sql: str) -> DataFrame:
    return d.spark.sql(sql.replace("FROM documents", "FROM {documents}"), documents=d.table("documents"))


def _with(**inputs: str) -> str:
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in inputs.items()) + " "


HELD = "SELECT '10.1/s' || lpad(CAST(doc_id AS STRING), 9, '0') || 'z' AS doi FROM documents WHERE doc_id % 3 = 0"
OPENED = "SELECT '10.1/s' || lpad(CAST(doc_id AS STRING), 9, '0') || 'z' AS doi FROM documents WHERE doc_id % 5 = 0"


@query("o13_queue_status", _with(q=QUEUE, h=HELD, o=OPENED) + "SELECT count(*) AS total, count(*) FILTER (WHERE doi IN (SELECT doi FROM h)) AS held, count(*) FILTER (WHERE doi NOT IN (SELECT doi FROM h)) AS pending, count(DISTINCT doi) FILTER (WHERE doi NOT IN (SELECT doi FROM h) AND doi IN (SELECT doi FROM o)) AS opened FROM q", views=False)
def queue_status(d: Domain):
    return drivers.queue_status(_in(d, QUEUE), _in(d, HELD), _in(d, OPENED))


@query("o12_plan_ingest", _with(files=FILES, queue=QUEUE, libraries=LIBRARIES) + """, f AS (SELECT *, lower(regexp_replace(file, '\\.[^.]*$', '')) AS stem FROM files),
suffixes AS (SELECT split_part(doi, '/', 2) AS suffix, arg_max(doi, "at") AS named FROM queue GROUP BY 1), requests AS (SELECT doi, arg_max(projects, "at") AS projects FROM queue GROUP BY 1),
hits AS (SELECT file, named, row_number() OVER (PARTITION BY file ORDER BY length(suffix) DESC, suffix) AS n FROM f JOIN suffixes ON length(suffix) >= 6 AND contains(stem, suffix)),
m AS (SELECT f.*, coalesce(named, text_doi) AS d, r.doi IS NOT NULL AS asked, projects FROM f LEFT JOIN (SELECT * FROM hits WHERE n = 1) USING (file) LEFT JOIN requests r ON r.doi = coalesce(named, text_doi)),
own AS (SELECT file, arg_min(l.project, i) AS project, arg_min(library, i) AS library FROM (SELECT file, generate_subscripts(string_split(projects, ','), 1) AS i, trim(unnest(string_split(projects, ','))) AS project FROM m WHERE asked) JOIN libraries l USING (project) GROUP BY 1),
names AS (SELECT project, library, lower(project) AS name FROM libraries UNION SELECT project, library, lower(split_part(project, '/', -1)) FROM libraries),
routed AS (SELECT file, project, library FROM (SELECT file, project, library, row_number() OVER (PARTITION BY file ORDER BY length(name) DESC, project, library) AS n FROM m JOIN names ON NOT asked AND starts_with(stem, name || '_')) WHERE n = 1),
o AS (SELECT file, CASE WHEN asked THEN d ELSE '' END AS doi, CASE WHEN asked AND stand_in IS NOT NULL THEN 'BOILERPLATE' WHEN library IS NULL THEN 'UNMATCHED' ELSE 'FILE' END AS outcome, project, library FROM m LEFT JOIN (SELECT * FROM own UNION ALL SELECT * FROM routed) USING (file)),
k AS (SELECT *, row_number() OVER (PARTITION BY outcome, CASE WHEN doi = '' THEN file ELSE doi END ORDER BY length(file), file) AS n FROM o)
SELECT file, CASE WHEN outcome = 'FILE' AND n > 1 THEN 'DUP' ELSE outcome END AS outcome, doi, CASE WHEN outcome = 'FILE' THEN project END AS project, CASE WHEN outcome = 'FILE' THEN library END AS library FROM k""", views=False)
def plan_ingest(d: Domain):
    return drivers.plan_ingest(_in(d, FILES), _in(d, QUEUE), _in(d, LIBRARIES))


@query("o12_cleared_ledger", _with(q=QUEUE, h=HELD, o=OPENED) + "SELECT DISTINCT doi FROM o WHERE doi NOT IN (SELECT q.doi FROM q JOIN h USING (doi) WHERE coalesce(list_filter(list_transform(string_split(projects, ','), lambda x: trim(x)), lambda x: x IN ('src1', 'src2', 'src3', 'en'))[1], '') <> 'src2')", views=False)
def cleared_ledger(d: Domain):
    libraries = d.spark.createDataFrame([(p, p) for p in ("src1", "src2", "src3", "en")], "project string, library string")
    return drivers.cleared_ledger(_in(d, OPENED), _in(d, QUEUE), _in(d, HELD), libraries, ["src2"])


@query("o15_record_backfill", _with(files=RECORDS, works=WORKS) + """SELECT pdf, doi, status, CASE WHEN status IN ('NO_DOI', 'CROSSREF_FAIL') THEN '' ELSE replace(pdf, '.pdf', '.ris') END AS out FROM (
  SELECT pdf, doi, CASE WHEN has_record THEN 'EXISTS_SKIP' WHEN doi = '' THEN 'NO_DOI' WHEN lower(doi) NOT IN (SELECT doi FROM works) THEN 'CROSSREF_FAIL' ELSE 'DRY:' || CASE WHEN side <> '' THEN 'sidecar' ELSE 'pdf' END END AS status
  FROM (SELECT *, CASE WHEN has_record THEN '' WHEN side <> '' THEN side ELSE pdf_doi END AS doi FROM (SELECT *, trim(coalesce(sidecar_doi, '')) AS side FROM files)))""", views=False)
def record_backfill(d: Domain):
    return drivers.record_backfill(_in(d, RECORDS), _in(d, WORKS))


@query("o15_text_backfill", _with(files=TEXTS, names=NAMES, by_file=BY_FILE, ids=IDS, by_doi=BY_DOI, fetched=FETCHED) + """, a AS (SELECT f.*, CASE WHEN has_sidecar THEN '' ELSE coalesce((SELECT arg_max(n.doi, n."at") FROM names n WHERE n.filename = f.filename AND n.doi <> ''),
  (SELECT arg_max(n.doi, n."at") FROM names n WHERE replace(n.filename, 'é', '') = replace(f.filename, 'é', '') AND n.doi <> ''), '') END AS doi FROM files f),
b AS (SELECT a.*, b.pmcid AS own, coalesce(i.pmcid, x.pmcid, '') AS found FROM a LEFT JOIN by_file b USING (filename) LEFT JOIN ids i ON i.doi = a.doi LEFT JOIN by_doi x ON x.doi = a.doi),
c AS (SELECT *, CASE WHEN has_sidecar THEN 'ALREADY_EXISTS' WHEN doi <> '' THEN 'csv_doi' WHEN own IS NOT NULL THEN 'fallback_pmcid' ELSE 'NO_LOOKUP' END AS source FROM b),
e AS (SELECT *, CASE source WHEN 'csv_doi' THEN found WHEN 'fallback_pmcid' THEN own ELSE '' END AS id FROM c),
g AS (SELECT filename, doi, id AS pmcid, CASE WHEN has_sidecar THEN 'EXISTS' WHEN id = '' THEN 'NO_PMCID' ELSE coalesce(t.status, 'NOT_AVAILABLE') END AS status, source FROM e LEFT JOIN fetched t ON t.pmcid = id)
SELECT filename, doi, pmcid, status IN ('EXISTS', 'OK') AS sidecar, status, source FROM g""", views=False)
def text_backfill(d: Domain):
    return drivers.text_backfill(*[_in(d, s) for s in (TEXTS, NAMES, BY_FILE, IDS, BY_DOI, FETCHED)])


HEADS = "SELECT 'p' || doc_id || '.pdf' AS filename, CASE WHEN doc_id % 4 = 0 THEN 'no number ' || lang WHEN doc_id % 4 = 1 THEN 'see 10.12/x' || doc_id ELSE 'doi:10.1000/t' || doc_id % 300 || ' and ' || lang END AS head FROM documents"
HEAD_IDS = "SELECT DISTINCT '10.1000/t' || doc_id % 300 AS doi, 'PMC' || doc_id % 300 AS pmcid FROM documents WHERE doc_id % 300 % 3 > 0"
HEAD_GOT = "SELECT 'p' || doc_id || '.pdf' AS filename, CASE WHEN doc_id % 7 = 0 THEN 'TITLE_MISMATCH' ELSE 'OK' END AS status FROM documents WHERE doc_id % 5 > 0"


@query("o15_text_recheck", _with(files=HEADS, ids=HEAD_IDS, got=HEAD_GOT) + """, a AS (SELECT filename, regexp_extract(head, '10\\.\\d{4,9}/\\w+') AS doi FROM files)
SELECT a.filename, a.doi, coalesce(pmcid, '') AS pmcid, pmcid IS NOT NULL AND coalesce(status, '') = 'OK' AS sidecar, CASE WHEN a.doi = '' THEN 'NO_DOI_IN_PDF_TEXT' WHEN pmcid IS NULL THEN 'NO_PMCID' ELSE coalesce(status, 'NOT_AVAILABLE') END AS status FROM a LEFT JOIN ids USING (doi) LEFT JOIN got USING (filename)""", views=False)
def text_recheck(d: Domain):
    return drivers.text_recheck(*[_in(d, s) for s in (HEADS, HEAD_IDS, HEAD_GOT)])


@query("o14_harvest", _with(parsed=PARSED, works=WORKS, searched=SEARCHED, pmids=PMIDS) + """, a AS (SELECT p.* EXCLUDE (doi), CASE WHEN p.doi <> '' THEN p.doi WHEN fmt = 'nbib' THEN coalesce(n.doi, '') ELSE '' END AS doi FROM parsed p LEFT JOIN pmids n USING (pmid)),
b AS (SELECT a.*, w.doi IS NOT NULL AS by_doi, s.src IS NOT NULL AND a.title <> '' AS by_title, w.doi AS wd, w.title AS wt, s.doi AS sd, s.title AS st FROM a LEFT JOIN works w ON w.doi = lower(a.doi) LEFT JOIN searched s ON s.src = a.src),
c AS (SELECT *, CASE WHEN by_doi THEN 'crossref-doi' WHEN by_title THEN 'crossref-search' ELSE 'fallback-' || fmt END AS kind, lower(CASE WHEN by_doi THEN wd WHEN by_title THEN sd ELSE doi END) AS md, CASE WHEN by_doi THEN 'Jones' WHEN by_title THEN 'Doe' ELSE lastname END AS ml,
  CASE WHEN by_doi THEN wt WHEN by_title THEN st ELSE title END AS mt, CASE WHEN by_doi THEN '2001' WHEN by_title THEN '1999' ELSE year END AS my FROM b),
e AS (SELECT *, read AND (mt <> '' OR ml <> '') AS usable FROM c),
g AS (SELECT *, CASE WHEN usable AND md <> '' THEN min(CASE WHEN usable THEN src END) OVER (PARTITION BY md) END AS lead FROM e)
SELECT src, fmt, CASE WHEN NOT read THEN '' WHEN NOT usable THEN doi ELSE md END AS doi, CASE WHEN NOT read THEN 'PARSE_FAIL' WHEN NOT usable THEN 'NO_METADATA' WHEN lead <> src THEN 'DUP_SKIP' ELSE 'DRY:' || kind END AS status,
  CASE WHEN NOT read THEN '' WHEN usable THEN mt ELSE title END AS title, CASE WHEN NOT read THEN '' WHEN usable THEN my ELSE year END AS year, lead IS NOT NULL AND lead <> src AS points FROM g""", views=False)
def harvest(d: Domain):
    from pyspark.sql import functions as F

    rows = drivers.harvest(_in(d, PARSED), _in(d, WORKS), _in(d, SEARCHED), _in(d, PMIDS))
    return rows.withColumn("points", F.col("status") == "DUP_SKIP").drop("out")
