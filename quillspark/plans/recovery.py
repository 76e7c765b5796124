"""Queries of recovery, audits, lookups and maintenance over generated records, each with the same computed in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import doi as doi_functions
from ..functions import match, names
from ..operators import audit, index, queues, recovery, tables
from ..sources import connectors, sinks
from .projection import Domain
from .registry import query
from .relational import _new, _top

STEMS = "SELECT source AS project, 'p' || doc_id AS stem, doc_id FROM documents"


@query("f02_extract_doi_wrapped", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '10.1234/ab.c' || doc_id WHEN 2 THEN '10.1234/x' || doc_id ELSE '10.1234/a-' || doc_id || '/7' END AS doi FROM documents", views=False)
def extract_wrapped(d: Domain):
    """A slash of the prefix alone joins no line; a dot, dash or slash of the body does."""
    text = F.expr("case doc_id % 4 when 0 then concat('see 10.1234/ abc', doc_id) when 1 then concat('see 10.1234/ab.\\nc', doc_id, ' and') when 2 then concat('see 10.1234/x', doc_id, ' 5 more') else concat('10.1234/a-\\r\\n ', doc_id, '/\\n7, then') end")
    return d.table("documents").select("doc_id", doi_functions.extract_doi(text).alias("doi"))


@query("p07_still_wanted", "SELECT doc_id FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE '10.1/' || (doc_id % 500) END AS doi, doc_id % 3 = 0 AS got, doc_id % 5 = 0 AS there FROM documents) WHERE NOT got AND NOT there AND doi <> '' AND CAST(split_part(doi, '/', 2) AS INTEGER) % 2 = 1", views=False)
def still_wanted(d: Domain):
    rows = d.table("documents").select("doc_id", F.expr("case when doc_id % 4 = 0 then ' ' else concat(' 10.1/', doc_id % 500) end").alias("doi"), F.expr("case when doc_id % 3 = 0 then 'True' else 'False' end").alias("downloaded"), F.expr("case when doc_id % 5 = 0 then 'SKIP_EXISTS' end").alias("status"))
    listed = d.spark.range(500).filter("id % 2 = 1").select(F.concat(F.lit("10.1/"), F.col("id").cast("string")).alias("doi"))
    return queues.still_wanted(rows, listed).select("doc_id")


@query("p09_orphans", f"SELECT project, stem, CASE WHEN doc_id % 3 = 0 THEN 'no-sidecar' ELSE 'no-doi' END AS why FROM ({STEMS}) WHERE doc_id % 3 = 0 OR (doc_id % 3 = 1 AND doc_id % 7 <> 0 AND doc_id % 4 = 1)", views=False)
def orphans(d: Domain):
    rows = d.table("documents").select(F.col("source").alias("project"), F.concat(F.lit("p"), "doc_id").alias("stem"), "doc_id")
    told = rows.filter("doc_id % 3 <> 0").select("project", "stem", F.expr("doc_id % 7 <> 0").alias("parsed"), F.expr("case when doc_id % 3 = 1 and doc_id % 4 = 1 then ' ' else '10.1/x.1' end").alias("doi"))
    return recovery.orphans(rows.select("project", "stem"), told)


@query("p14_bypass", "SELECT doc_id, doc_id % 5 IN (0, 1, 2) AND doc_id % 2 = 0 AS skip FROM documents", views=False)
def bypass(d: Domain):
    doi = F.concat(F.element_at(F.array(*[F.lit(p) for p in ("10.1249/", "10.1519/", "10.2196/", "10.12490/", "10.1101/")]), (F.col("doc_id") % 5 + 1).cast("int")), "doc_id")
    return d.table("documents").select("doc_id", doi_functions.bypasses_publisher(doi, F.expr("case when doc_id % 2 = 1 then 'https://x/y.pdf' when doc_id % 4 = 0 then '' end")).alias("skip"))


@query("p17_inside_root", "SELECT doc_id, doc_id % 6 IN (0, 1, 4) AS inside FROM documents", views=False)
def inside_root(d: Domain):
    path = F.expr("case doc_id % 6 when 0 then concat('literature/', source) when 1 then concat('a/../', source) when 2 then concat('../', source) when 3 then concat('a/../../', source, '/b') when 4 then './a/./b/..' else concat('/', source) end")
    return d.table("documents").select("doc_id", audit.inside_root(path).alias("inside"))


@query("p18_queue_state", "SELECT source AS project, CASE WHEN count(*) FILTER (WHERE doc_id % 25 = 1) > 1 THEN 'PENDING_QUEUE' ELSE 'READY' END AS state FROM documents GROUP BY 1", views=False)
def queue_state(d: Domain):
    rows = d.table("documents").select(F.col("source").alias("project"), F.expr("case when doc_id % 25 = 1 then concat('10.1/', doc_id) when doc_id % 2 = 0 then concat('  # ', doc_id) else '  ' end").alias("line"))
    return audit.queue_state(rows, ["project"], "line")


@query("p19_title_gate", "SELECT doc_id, doc_id % 4 <> 2 AS same FROM documents", views=False)
def title_gate(d: Domain):
    """Contained, like enough, neither, and a title too short to judge."""
    title = F.expr("case doc_id % 4 when 0 then concat('Heat and <i>Hydration</i> in sport ', doc_id) when 1 then concat('Heat, hydration in sport ', doc_id) when 2 then 'Zyx qvw jkpb uuu' else 'Heat' end")
    head = F.expr("concat('Journal 12. Heat and hydration in sport ', doc_id, '. Smith J, Doe K.')")
    return d.table("documents").select("doc_id", match.title_gate(title, F.when(F.col("doc_id") % 4 == 1, F.expr("concat('Heat and hydration in sports ', doc_id)")).otherwise(head)).alias("same"))


@query("j18_name_history", "SELECT '10.1/' || min(doc_id) AS doi, 'paper_' || (doc_id % 300) || '.pdf' AS filename FROM documents WHERE doc_id % 6 <> 0 GROUP BY 2", views=False)
def name_history(d: Domain):
    rows = d.table("documents").withColumn("doi", F.expr("case when doc_id % 6 = 0 then ' ' else concat(' 10.1/', doc_id) end"))
    return queues.name_history(rows, F.expr("concat('paper_', doc_id % 300, '.pdf')"), "doc_id")


@query("j19_figures", "SELECT 'p' || doc_id AS stem, 1 AS \"at\", 'p' || doc_id || '.fig2.jpg' AS file, 'https://cdn/a/' || doc_id || '-2.JPG' AS url FROM documents WHERE doc_id % 3 <> 0", views=False)
def figures(d: Domain):
    rows = d.table("documents")
    asked = rows.select(F.concat(F.lit("p"), "doc_id").alias("stem"), F.posexplode(F.expr("array('', concat(doc_id, '-2.JPG'), 'unknown.png')")).alias("at", "href"))
    pages = rows.select(F.concat(F.lit("p"), "doc_id").alias("stem"), F.expr("if(doc_id % 3 = 0, 20000, 60000)").alias("length"), F.expr("array(concat('https://cdn/a/', doc_id, '-2.JPG'), concat('https://cdn/b/', doc_id, '-2.JPG'))").alias("urls"))
    return connectors.figure_files(asked, pages)


@query("j21_doi_conflicts", "SELECT source AS project, 'p' || doc_id AS stem, doc_id % 4 = 1 AS mismatch, CASE WHEN doc_id % 6 = 0 THEN 'sidecar=10.12/bad' ELSE '' END AS malformed FROM documents WHERE doc_id % 4 = 1 OR doc_id % 6 = 0", views=False)
def doi_conflicts(d: Domain):
    said = F.expr("array(struct('ris' as source, case when doc_id % 6 = 0 then '' else concat('10.1000/x', doc_id) end as doi), struct('sidecar' as source, case when doc_id % 6 = 0 and doc_id % 4 <> 1 then '10.12/bad' when doc_id % 4 = 1 then concat('10.1000/y', doc_id) else concat('10.1000/x', doc_id) end as doi))")
    rows = d.table("documents").select(F.col("source").alias("project"), F.concat(F.lit("p"), "doc_id").alias("stem"), F.explode(said).alias("s")).select("project", "stem", F.col("s.source").alias("source"), F.col("s.doi").alias("doi"))
    return audit.doi_conflicts(rows).withColumn("malformed", F.array_join("malformed", ","))


@query("a04_totals", "SELECT (SELECT count(*) FROM paper_metadata) AS n_metadata, (SELECT count(*) FROM paper_metadata WHERE coalesce(abstract, '') <> '') AS n_abstracts, (SELECT count(*) FROM paper_locations) AS n_locations, (SELECT count(DISTINCT l.doi) FROM paper_locations l JOIN paper_metadata m ON m.doi = l.doi) AS n_papers, (SELECT count(*) FROM (SELECT l.doi FROM paper_locations l JOIN paper_metadata m ON m.doi = l.doi GROUP BY 1 HAVING count(*) > 1)) AS n_cross_project, (SELECT count(*) FROM documents WHERE doc_id % 9 = 0) AS n_without_doi, (SELECT count(DISTINCT doi) FROM candidates) AS n_candidates, (SELECT count(*) FROM all_edges) AS n_edges, (SELECT count(DISTINCT doi) FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = c.doi)) AS n_unowned")
def totals(d: Domain):
    from ..operators import citations

    return index.totals(d.metadata, d.locations, d.candidates, citations.edges(d.candidates), d.table("documents").filter("doc_id % 9 = 0"))


@query("a12_same_project_copies", "SELECT CAST(l_partkey AS VARCHAR) AS doi, r_name AS project, count(*) AS n_files FROM lineitem JOIN regions USING (l_suppkey) GROUP BY 1, 2 HAVING count(*) > 1")
def same_project_copies(d: Domain):
    files = d.table("lineitem").join(d._regions(), "l_suppkey").select(F.col("l_partkey").cast("string").alias("doi"), F.col("r_name").alias("project"))
    return audit.same_project_copies(files)


@query("a21_table_counts", "SELECT count(*) FILTER (WHERE doc_id % 5 > 1) AS n_papers, CAST(sum(greatest(doc_id % 5 - 1, 0)) AS BIGINT) AS n_tables FROM documents", views=False)
def table_counts(d: Domain):
    return audit.table_counts(d.table("documents").select(F.expr("greatest(doc_id % 5 - 1, 0)").alias("n_tables")))


@query("f31_split_authors", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Van Dyke|Ann ' || lang WHEN 1 THEN upper(lang) || '|John ' || source WHEN 2 THEN source || '|' ELSE lang || '|, Jr.' END AS authors FROM documents", views=False)
def split_authors(d: Domain):
    raw = F.expr("case doc_id % 4 when 0 then array(concat(' Van Dyke , Ann ', lang, ' '), '   ') when 1 then array(concat('John  ', source, ' ', upper(lang))) when 2 then array(source) else array(concat(lang, ',, Jr.')) end")
    return d.table("documents").select("doc_id", F.array_join(F.transform(names.split_authors(raw), lambda a: F.concat_ws("|", a["family"], a["given"])), ";").alias("authors"))


@query("f27_fill_record", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE '10.1000/n' || doc_id || '|' || CASE WHEN doc_id % 2 = 0 THEN 'Found' ELSE 'Own' END || '|' || CASE WHEN doc_id % 3 = 0 THEN '2020' ELSE '1999' END END AS record FROM documents", views=False)
def fill_record(d: Domain):
    own = {"doi": F.lit("10.1/old"), "title": F.expr("case when doc_id % 4 = 0 then '' when doc_id % 2 = 1 then 'Own' end"), "year": F.expr("if(doc_id % 3 = 0, 0, 1999)")}
    found = {"doi": F.expr("if(doc_id % 5 = 0, 'broken', concat('10.1000/n', doc_id))"), "title": F.lit("Found"), "year": F.lit(2020)}
    r = match.fill_record(own, found)
    return d.table("documents").select("doc_id", F.when(r.isNotNull(), F.concat_ws("|", r["doi"], r["title"], r["year"])).alias("record"))


@query("f28_merge_record", """SELECT doc_id, 'authors=' || CASE WHEN doc_id % 2 = 0 THEN '["A"]' ELSE '["B"]' END || ',text="new",title=' || CASE WHEN doc_id % 3 = 0 THEN '"Old"' ELSE '"New"' END || CASE WHEN doc_id % 5 < 2 THEN ',year=1990' ELSE ',year=' || CASE WHEN doc_id % 5 = 2 THEN '0' ELSE '2001' END END AS record FROM documents""", views=False)
def merge_record(d: Domain):
    """Empty strings, lists and zeros give way to an old value, other fields don't; an old value that is empty is not kept."""
    old = F.expr("""map('title', '"Old"', 'authors', '["A"]', 'year', if(doc_id % 5 = 2, '""', '1990'), 'text', '"old"')""")
    new = F.expr("""map('title', if(doc_id % 3 = 0, '""', '"New"'), 'authors', if(doc_id % 2 = 0, '[]', '["B"]'), 'year', case when doc_id % 5 < 3 then '0' else '2001' end, 'text', '"new"')""")
    return d.table("documents").select("doc_id", F.array_join(F.array_sort(F.transform(F.map_entries(match.merge_records(old, new)), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias("record"))


@query("k08_draft_queue", "SELECT rank + 5 AS \"at\", doi || ',\"' || title || ', \"\"x\"\"\",,' || year || ',literature,n_seeds=' || n_seeds || ' cites=' || max_cited_by || ' src=' || CASE WHEN source_types LIKE '%,%' THEN source_types ELSE source_types END AS line FROM (SELECT *, row_number() OVER (ORDER BY n_seeds DESC, max_cited_by DESC, doi) AS rank FROM top_candidates WHERE title IS NOT NULL AND source_types NOT LIKE '%,%') WHERE rank <= 40 UNION ALL SELECT 5, 'doi,title,authors,year,destination,notes' UNION ALL SELECT 4, '# Total rows: ' || least(40, (SELECT count(*) FROM top_candidates WHERE title IS NOT NULL AND source_types NOT LIKE '%,%')) UNION ALL SELECT 1, '# REVIEW BEFORE SWEEP — drop irrelevant rows, then rename to lit_pull_queue.csv' UNION ALL SELECT 2, '# Source: top_candidates view, project=EUROPE' UNION ALL SELECT 3, '# Filters: limit=40'")
def draft_queue(d: Domain):
    best = _top(d).filter("title is not null and not contains(source_types, ',')").orderBy(F.desc("n_seeds"), F.desc("max_cited_by"), "doi").limit(40)
    rows = tables.numbered(best, [-F.col("n_seeds"), -F.col("max_cited_by"), F.col("doi")], "rank").withColumn("title", F.concat("title", F.lit(', "x"'))).withColumn("authors", F.lit(None).cast("string"))
    return sinks.draft_queue(rows, "EUROPE", "literature", "limit=40")


@query("k16_rebuild", "SELECT (SELECT count(*) FROM paper_metadata WHERE coalesce(abstract, '') <> '') AS discarded, (SELECT count(*) FROM part WHERE p_partkey % 5 = 2) AS n_rows, 0 AS n_abstracts")
def rebuild(d: Domain):
    fresh, lost = tables.rebuilt(d.metadata, _new(d))
    return lost.join(F.broadcast(fresh.agg(F.count(F.lit(1)).alias("n_rows"), F.count("abstract").cast("int").alias("n_abstracts"))))


@query("x08_stored_references", "SELECT 'p' || doc_id AS stem, 0 AS \"at\", 'Smith' AS first_author, '2011' AS year, left(repeat('Title ' || doc_id || ' ', 30), 200) AS title_snippet, CASE WHEN doc_id % 2 = 0 THEN '' ELSE '10.1000/r' || doc_id END AS doi, 'Smith 2011' AS raw FROM documents UNION ALL SELECT 'p' || doc_id, 1, 'Doe', CAST(1990 + doc_id % 30 AS VARCHAR), 'On ' || lang || ' things', '', 'Doe J. (' || (1990 + doc_id % 30) || ') On ' || lang || ' things. Journal.' FROM documents", views=False)
def stored_references(d: Domain):
    refs = F.expr("""array(concat('{"first_author":"Smith","year":2011,"title":"', repeat(concat('Title ', doc_id, ' '), 30), '","doi":"', if(doc_id % 2 = 0, '10.1000/broken', concat('https://doi.org/10.1000/R', doc_id, '.')), '","text":"Smith 2011"}'), concat('Doe J. (', 1990 + doc_id % 30, ')\\n On ', lang, ' things. Journal.'))""")
    return recovery.stored_references(d.table("documents").select(F.concat(F.lit("p"), "doc_id").alias("stem"), refs.alias("references")))


@query("c09_pmid_dois", "SELECT CAST(doc_id AS VARCHAR) AS pmid, '10.1000/p' || doc_id AS doi FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 7 <> 0", views=False)
def pmid_dois(d: Domain):
    body = F.expr("""case when doc_id % 3 = 0 then '{"records":[{"pmcid":"PMC1"}]}' else concat('{"records":[{"doi":""},{"doi":"10.1000/P', doc_id, '"},{"doi":"10.1/later"}]}') end""")
    return connectors.pmid_dois(d.table("documents").select(F.lit("pmid").alias("api"), F.col("doc_id").cast("string").alias("key"), F.expr("if(doc_id % 7 = 0, 500, 200)").alias("status"), body.alias("body")))


@query("c13_preprints", """SELECT CAST(doc_id AS VARCHAR) AS key, "at", CASE "at" WHEN 0 THEN 'epmc-preprint-pmc' WHEN 1 THEN 'biorxiv-medrxiv' ELSE 'epmc:10.5555' END AS source, CASE "at" WHEN 0 THEN 'PMC' || doc_id ELSE 'PPR' || "at" END AS id, 'T ' || lang AS title, CASE WHEN "at" = 0 THEN '2020' ELSE '' END AS year, CASE "at" WHEN 0 THEN '' WHEN 1 THEN '10.1101/b' || doc_id ELSE '10.5555/c' || doc_id END AS doi,
  CASE "at" WHEN 0 THEN 'https://epmc/PMC' || doc_id || '.pdf' WHEN 1 THEN 'https://www.biorxiv.org/content/10.1101/b' || doc_id || '.full.pdf' ELSE 'https://doi.org/10.5555/c' || doc_id END AS pdf_url, "at" = 3 AS needs_scrape FROM documents, (SELECT unnest([0, 1, 3]) AS "at")""", views=False)
def preprints(d: Domain):
    body = F.expr("""concat('{"resultList":{"result":[{"id":"PPR0","pmcid":"PMC', doc_id, '","title":"T ', lang, '","pubYear":"2020"},{"id":"PPR1","doi":"10.1101/b', doc_id, '","title":"T ', lang, '"},{"id":"PPR2","title":"none"},{"id":"PPR3","doi":"10.5555/c', doc_id, '","title":"T ', lang, '"}]}}')""")
    rows = d.table("documents").select(F.lit("preprints").alias("api"), F.col("doc_id").cast("string").alias("key"), F.lit(200).alias("status"), body.alias("body"))
    return connectors.preprints(rows, "https://epmc/{pmcid}.pdf").drop("authors")


@query("c14_osf_preprints", "SELECT CAST(doc_id AS VARCHAR) AS key, CAST(\"at\" AS INTEGER) AS \"at\", CASE \"at\" WHEN 0 THEN 'osf:psyarxiv' ELSE 'osf:osf' END AS source, lang AS title, CASE WHEN \"at\" = 0 THEN '2021' ELSE '' END AS year, 'https://api.osf.io/v2/files/f' || doc_id || '/?action=download' AS pdf_url FROM documents, (SELECT unnest([0, 2]) AS \"at\")", views=False)
def osf(d: Domain):
    body = F.expr("""concat('{"data":[{"id":"a","attributes":{"title":"', lang, '","date_published":"2021-05-06"},"relationships":{"primary_file":{"data":{"id":"f', doc_id, '"}},"provider":{"data":{"id":"psyarxiv"}}}},{"id":"b","attributes":{"title":"none"}},{"id":"c","attributes":{"title":"', lang, '"},"relationships":{"primary_file":{"data":{"id":"f', doc_id, '"}}}}]}')""")
    rows = d.table("documents").select(F.lit("osf").alias("api"), F.col("doc_id").cast("string").alias("key"), F.lit(200).alias("status"), body.alias("body"))
    return connectors.osf_preprints(rows).select("key", "at", "source", "title", "year", "pdf_url")


@query("c10_full_text", "SELECT CASE doc_id % 4 WHEN 0 THEN 'NOT_AVAILABLE' WHEN 1 THEN 'HTTP_503' WHEN 2 THEN 'EMPTY_OR_NON_XML' ELSE 'OK' END AS state, count(*) AS n FROM documents GROUP BY 1", views=False)
def full_text(d: Domain):
    state = connectors.full_text(F.expr("case doc_id % 4 when 0 then 404 when 1 then 503 else 200 end"), F.expr("if(doc_id % 4 = 3, concat(' \\n<article>', lang), if(doc_id % 8 = 2, lang, null))"))
    return d.table("documents").select(state.alias("state")).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("c16_first_download", "SELECT CAST(doc_id AS VARCHAR) AS doi, CASE WHEN doc_id % 5 IN (1, 2, 3) THEN 'p' || (doc_id % 5) WHEN doc_id % 5 = 0 THEN 'direct' END AS url, CAST(5 AS BIGINT) AS n_tried FROM documents", views=False)
def first_download(d: Domain):
    links = F.expr("transform(sequence(1, 5), i -> struct(concat('p', i) as url, if(i = doc_id % 5, 'OK', 'ERROR') as status))")
    tries = F.expr("array(struct(0 as rank, 'page' as url, 'HTML' as status), struct(1 as rank, 'direct' as url, if(doc_id % 5 < 3, 'OK', 'HTTP_403') as status))")
    rows = d.table("documents").select(F.col("doc_id").cast("string").alias("doi"), F.explode(tries).alias("t"), links.alias("links")).select("doi", "t.rank", "t.url", "t.status", "links")
    return connectors.first_download(rows)


@query("c17_image_kind", "SELECT CASE doc_id % 5 WHEN 0 THEN 'jpg' WHEN 1 THEN 'png' WHEN 2 THEN 'gif' END AS kind, count(*) AS n FROM documents GROUP BY 1", views=False)
def image_kind(d: Domain):
    head = F.expr("element_at(array('FFD8FFE0', '89504E47', '47494638', '3C68746D', 'FFD8FFE0'), int(doc_id % 5 + 1))")
    return d.table("documents").select(connectors.image_kind(head, F.expr("if(doc_id % 5 = 4, 40000000, 5000)")).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("c03_title_lookup", "SELECT CAST(doc_id AS VARCHAR) AS key, '10.1/b' AS doi FROM documents WHERE doc_id % 6 IN (0, 3)", views=False)
def title_lookup(d: Domain):
    """Found; too far in years; too short; no year given; like enough only beyond the fifth; unlike."""
    rows = d.table("documents")
    asked = rows.select(F.col("doc_id").cast("string").alias("key"), F.expr("case when doc_id % 6 = 2 then 'Heat' else concat('Effects of heat on ', source, ' runners') end").alias("title"), F.expr("if(doc_id % 6 = 3, '', '2015')").alias("year"))
    hit = lambda at, doi, title, year: F.struct(F.lit(at).alias("at"), F.lit(doi).alias("doi"), F.expr(title).alias("found"), F.expr(year).alias("found_year"))
    own = "concat('Effects of <i>Heat</i> on ', source, ' runners')"
    hits = F.array(hit(0, "10.1/a", "'Zyx qvw'", "'2015'"), hit(1, "10.1/b", f"case when doc_id % 6 in (4, 5) then 'Quite unlike' when doc_id % 6 = 2 then 'Heat' else {own} end", "if(doc_id % 6 = 1, '2011', '2016')"), hit(5, "10.1/c", f"if(doc_id % 6 = 4, {own}, 'no')", "'2015'"))
    return recovery.title_lookup(asked, rows.select(F.col("doc_id").cast("string").alias("key"), F.explode(hits).alias("h")).select("key", "h.*")).select("key", "doi")


@query("t05_ranked_candidates", "SELECT key, \"at\", row_number() OVER (PARTITION BY key ORDER BY sim DESC, coalesce(year = found_year, false) DESC, needs_scrape, \"at\") AS rank FROM (SELECT doc_id % 400 AS key, doc_id AS \"at\", (doc_id % 3) / 4.0 AS sim, 2000 + doc_id % 4 AS year, CASE WHEN doc_id % 5 > 0 THEN 2000 + doc_id % 3 END AS found_year, doc_id % 2 = 0 AS needs_scrape FROM documents) WHERE found_year IS NULL OR abs(year - found_year) <= 1", views=False)
def ranked_candidates(d: Domain):
    rows = d.table("documents").select(F.expr("doc_id % 400").alias("key"), F.col("doc_id").alias("at"), F.expr("(doc_id % 3) / 4.0D").alias("sim"), F.expr("cast(2000 + doc_id % 4 as string)").alias("year"), F.expr("case when doc_id % 5 > 0 then cast(2000 + doc_id % 3 as string) else 'n.d.' end").alias("found_year"), F.expr("doc_id % 2 = 0").alias("needs_scrape"))
    return recovery.ranked_candidates(rows).select("key", "at", "rank")


@query("o16_recovery_status", "SELECT CASE doc_id % 5 WHEN 0 THEN 'NO_MATCH' WHEN 1 THEN 'BAD_DOI' WHEN 2 THEN 'LOW_CONFIDENCE' WHEN 3 THEN 'ALREADY_HELD' ELSE 'FILLED' END AS status, count(*) AS n FROM documents GROUP BY 1", views=False)
def recovery_status(d: Domain):
    status = recovery.recovery_status(F.expr("case doc_id % 5 when 0 then '' when 1 then '10.1000/broken' else concat('10.1000/x', doc_id) end"), F.expr("if(doc_id % 5 = 2, 1, 4)"), F.lit(3), F.expr("doc_id % 5 = 3"))
    return d.table("documents").select(status.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("o11_checks", "SELECT label, count(*) AS n, sum((NOT ok)::INT) AS n_failed, bool_and(ok) AS ok FROM (SELECT 'sidecar' AS label, has_sidecar AS ok FROM paper_locations UNION ALL SELECT 'record', has_ris OR NOT has_pdf FROM paper_locations UNION ALL SELECT 'name', starts_with(pdf_filename, 'paper_') FROM paper_locations) GROUP BY label")
def checks(d: Domain):
    return audit.checks(d.locations, {"sidecar": F.col("has_sidecar"), "record": F.col("has_ris") | ~F.col("has_pdf"), "name": F.col("pdf_filename").startswith("paper_")})
