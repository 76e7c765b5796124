"""Relational queries: views, joins, aggregates, ranks, sets, graph steps and table maintenance over the projection."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import audit, citations, index, queues, tables
from .projection import Domain
from .registry import query

TOP = "SELECT * FROM top_candidates"


def _top(d: Domain):
    return index.top_candidates(d.candidates, d.metadata, d.locations)


@query("a01_top_candidates", TOP)
def top_candidates(d: Domain):
    return _top(d)


@query("a02_papers", "SELECT m.*, projects, n_projects, any_pdf, any_sidecar, any_ris FROM paper_metadata m JOIN (SELECT doi, string_agg(DISTINCT project, ',' ORDER BY project) AS projects, count(DISTINCT project) AS n_projects, bool_or(has_pdf) AS any_pdf, bool_or(has_sidecar) AS any_sidecar, bool_or(has_ris) AS any_ris FROM paper_locations GROUP BY doi) l ON l.doi = m.doi")
def papers(d: Domain):
    return index.papers(d.metadata, d.locations)


@query("a03_cross_project_papers", "SELECT m.doi, title, year, count(*) AS n_projects, string_agg(project, ',' ORDER BY project) AS projects FROM paper_metadata m JOIN paper_locations l ON l.doi = m.doi GROUP BY 1, 2, 3 HAVING count(*) > 1")
def cross_project(d: Domain):
    return index.cross_project_papers(d.metadata, d.locations)


@query("a04_counts", "SELECT (SELECT count(*) FROM paper_metadata) AS n_metadata, (SELECT count(*) FROM paper_locations) AS n_locations, (SELECT count(DISTINCT doi) FROM paper_locations) AS n_papers, (SELECT count(*) FROM candidates) AS n_candidate_rows, (SELECT count(DISTINCT doi) FROM candidates) AS n_candidates, (SELECT count(*) FROM all_edges) AS n_edges, (SELECT count(DISTINCT doi) FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = c.doi)) AS n_unowned")
def counts(d: Domain):
    return index.counts(d.metadata, d.locations, d.candidates, citations.edges(d.candidates))


@query("a05_coverage_by_project", "SELECT project, count(*) AS n FROM paper_locations GROUP BY project")
def coverage_by_project(d: Domain):
    return d.locations.groupBy("project").agg(F.count(F.lit(1)).alias("n"))


@query("a06_candidate_count", "SELECT count(DISTINCT doi) AS n FROM (SELECT doi FROM candidates WHERE source_project = 'EUROPE' UNION SELECT recommended_doi FROM recommendations WHERE seed_doi IN (SELECT doi FROM paper_locations WHERE project = 'EUROPE')) x WHERE NOT EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = x.doi)")
def candidate_count(d: Domain):
    return index.candidate_count(d.candidates, d.recommendations, d.locations, "EUROPE")


@query("a07_recommendation_counts", "SELECT count(*) AS total, count(DISTINCT recommended_doi) AS n_distinct, count(DISTINCT CASE WHEN NOT EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = recommended_doi) THEN recommended_doi END) AS novel FROM recommendations")
def recommendation_counts(d: Domain):
    held = d.locations.select(F.col("doi").alias("recommended_doi")).distinct().withColumn("held", F.lit(True))
    rows = d.recommendations.join(held, "recommended_doi", "left")
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_distinct("recommended_doi").alias("n_distinct"), F.count_distinct(F.when(F.col("held").isNull(), F.col("recommended_doi"))).alias("novel"))


@query("a08_residual_groups", "SELECT doi, max(cites) AS cites_csv, string_agg(DISTINCT project, ',' ORDER BY project) AS projects, min_by(title, doc_id) FILTER (WHERE title <> '') AS title, min_by(year, doc_id) FILTER (WHERE year <> '') AS year FROM (SELECT '10.1000/' || (doc_id % 300) AS doi, CAST(citation_count AS INTEGER) AS cites, project, title, year, doc_id FROM queue) GROUP BY doi")
def residual_groups(d: Domain):
    rows = d.queue.withColumn("doi", F.expr("concat('10.1000/', doc_id % 300)")).withColumn("cites", F.col("citation_count").cast("int"))
    return queues.residual_groups(rows, "doc_id")


@query("a09_stage_tallies", "SELECT 'unpaywall' AS stage, count(*) FILTER (WHERE d1) AS downloaded FROM report UNION ALL SELECT 'pmc', count(*) FILTER (WHERE d2) FROM report UNION ALL SELECT 'preprint', count(*) FILTER (WHERE d3) FROM report UNION ALL SELECT 'total', CAST(sum(d1::INT + d2::INT + d3::INT) AS BIGINT) FROM report")
def stage_tallies(d: Domain):
    return queues.stage_tallies({"unpaywall": d.report(1), "pmc": d.report(2), "preprint": d.report(3)})


@query("a10_status_histogram", "SELECT CASE WHEN doc_id % 13 = 0 THEN 'ALREADY_EXISTS' WHEN doc_id % 17 = 0 THEN 'SKIP_EXISTS' ELSE 'CLOSED' END AS status, count(*) AS n FROM documents GROUP BY 1")
def status_histogram(d: Domain):
    return d.report(1).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("a11_library_counts", "SELECT year, count(*) AS n, count(DISTINCT venue) AS n_venues, count(*) FILTER (WHERE length(title) >= 30) AS n_long FROM paper_metadata GROUP BY year")
def library_counts(d: Domain):
    return d.metadata.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("venue").alias("n_venues"), F.count_if(F.length("title") >= 30).alias("n_long"))


@query("a12_project_overlap", "SELECT doi, count(DISTINCT project) AS n_projects FROM paper_locations GROUP BY doi HAVING count(DISTINCT project) > 1")
def project_overlap(d: Domain):
    return audit.overlap(d.locations)


@query("a13_text_lengths", "SELECT project, min(sidecar_text_len) AS least, max(CASE WHEN r = c // 2 + 1 THEN sidecar_text_len END) AS median, max(sidecar_text_len) AS greatest, count(*) FILTER (WHERE sidecar_text_len < 1000) AS n_short FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY sidecar_text_len) AS r, count(*) OVER (PARTITION BY project) AS c FROM paper_locations) GROUP BY project")
def text_lengths(d: Domain):
    return audit.upper_median(d.locations, ["project"], "sidecar_text_len")


COVERAGE = "SELECT project, count(*) AS n, 100.0::DOUBLE * count(*) FILTER (WHERE has_pdf) / greatest(1, count(*)) AS pct_has_pdf, 100.0::DOUBLE * count(*) FILTER (WHERE has_sidecar) / greatest(1, count(*)) AS pct_has_sidecar, 100.0::DOUBLE * count(*) FILTER (WHERE has_ris) / greatest(1, count(*)) AS pct_has_ris FROM paper_locations GROUP BY project"


@query("a14_coverage_percent", COVERAGE)
def coverage_percent(d: Domain):
    return audit.coverage(d.locations, ["project"], ["has_pdf", "has_sidecar", "has_ris"])


@query("a15_project_verdicts", "SELECT project, CASE WHEN sum(CASE WHEN NOT has_pdf AND has_sidecar THEN 1 ELSE 0 END) > 40 THEN 'BREAK' WHEN count(*) FILTER (WHERE NOT has_ris) > 0 THEN 'WARN' ELSE 'none' END AS verdict FROM paper_locations GROUP BY project")
def project_verdicts(d: Domain):
    per = d.locations.groupBy("project").agg(F.count_if(~F.col("has_pdf") & F.col("has_sidecar")).alias("orphans"), F.count_if(~F.col("has_ris")).alias("bare"))
    return per.select("project", audit.verdict(F.col("orphans") - 40, F.col("bare")).alias("verdict"))


@query("a16_distinct_dois", "SELECT DISTINCT doi FROM candidates")
def distinct_dois(d: Domain):
    return d.candidates.select("doi").distinct()


@query("a17_seeds_with_citers", "SELECT count(DISTINCT source_seed_doi) AS n_seeds, count(*) AS n_rows FROM candidates WHERE source_type = 'forward'")
def seeds_with_citers(d: Domain):
    return d.candidates.filter("source_type = 'forward'").agg(F.count_distinct("source_seed_doi").alias("n_seeds"), F.count(F.lit(1)).alias("n_rows"))


@query("a18_failure_histogram", "SELECT CASE WHEN s LIKE 'conv-error:%' THEN 'conv-error' ELSE s END AS status, count(*) AS n FROM (SELECT unnest(['ok', CASE WHEN doc_id % 3 = 0 THEN 'conv-error:' || lang ELSE 'no-mathml' END]) AS s FROM documents) GROUP BY 1")
def failure_histogram(d: Domain):
    rows = d.table("documents").select(F.explode(F.expr("array('ok', case when doc_id % 3 = 0 then concat('conv-error:', lang) else 'no-mathml' end)")).alias("s"))
    return rows.groupBy(F.when(F.col("s").startswith("conv-error:"), "conv-error").otherwise(F.col("s")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("a19_first_wins", "SELECT doc_id, project FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY doc_id) AS n FROM queue) WHERE n = 1")
def first_wins(d: Domain):
    return tables.first_wins(d.queue, ["project"], ["doc_id"]).select("doc_id", "project")


@query("a20_shortest_name_wins", "SELECT doi, pdf_filename FROM (SELECT doi, pdf_filename, row_number() OVER (PARTITION BY doi ORDER BY length(pdf_filename), pdf_filename) AS n FROM (SELECT doi, replace(pdf_filename, '.pdf', repeat(' (1)', length(project) % 3) || '.pdf') AS pdf_filename FROM paper_locations)) WHERE n = 1")
def shortest_name(d: Domain):
    files = d.locations.select("doi", F.expr("replace(pdf_filename, '.pdf', concat(repeat(' (1)', length(project) % 3), '.pdf'))").alias("pdf_filename"))
    return tables.first_wins(files, ["doi"], [F.length("pdf_filename"), "pdf_filename"])


@query("a22_harvest_status", "SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY doc_id % 400 ORDER BY doc_id) > 1 THEN 'DUP_SKIP' ELSE 'OK' END AS status FROM documents")
def harvest_status(d: Domain):
    rows = d.table("documents").select("doc_id", F.expr("doc_id % 400").alias("k"), F.lit("OK").alias("status"))
    return tables.duplicate_status(rows, ["k"], ["doc_id"], "status").select("doc_id", "status")


# ------------------------------------------------------------------------------------------------------------ joins


@query("j01_candidate_metadata", "SELECT c.doi, source_project, year, title FROM candidates c LEFT JOIN paper_metadata m ON c.doi = m.doi WHERE source_type = 'reverse'")
def candidate_metadata(d: Domain):
    return d.candidates.filter("source_type = 'reverse'").join(d.metadata, "doi", "left").select("doi", "source_project", "year", "title")


@query("j02_unowned_recommendations", "SELECT recommended_doi, count(*) AS n FROM recommendations r WHERE NOT EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = r.recommended_doi) GROUP BY 1")
def unowned_recommendations(d: Domain):
    return index.unowned(d.recommendations, d.locations, "recommended_doi").groupBy("recommended_doi").agg(F.count(F.lit(1)).alias("n"))


@query("j03_owned_papers", "SELECT doi, title FROM paper_metadata m WHERE EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = m.doi)")
def owned_papers(d: Domain):
    return index.owned(d.metadata, d.locations).select("doi", "title")


@query("j05_located_papers", "SELECT m.doi, project, venue, has_pdf FROM paper_metadata m JOIN paper_locations l ON l.doi = m.doi")
def located_papers(d: Domain):
    return d.metadata.join(d.locations, "doi").select("doi", "project", "venue", "has_pdf")


@query("j06_project_recommendations", "SELECT project, count(*) AS n FROM recommendations r JOIN paper_locations l ON l.doi = r.seed_doi AND project IN ('ASIA', 'EUROPE') GROUP BY project")
def project_recommendations(d: Domain):
    held = d.locations.filter(F.col("project").isin("ASIA", "EUROPE")).select(F.col("doi").alias("seed_doi"), "project")
    return d.recommendations.join(held, "seed_doi").groupBy("project").agg(F.count(F.lit(1)).alias("n"))


GONE = "NOT EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = m.doi) AND NOT EXISTS (SELECT 1 FROM candidates c WHERE c.doi = m.doi AND source_type = 'reverse') AND NOT EXISTS (SELECT 1 FROM recommendations r WHERE r.seed_doi = m.doi OR r.recommended_doi = m.doi AND r.rank > 5)"


def _pins(d: Domain):
    return [(d.locations, "doi"), (d.candidates.filter("source_type = 'reverse'"), "doi"), (d.recommendations, "seed_doi"), (d.recommendations.filter("rank > 5"), "recommended_doi")]


@query("j07_unreferenced_metadata", f"SELECT doi FROM paper_metadata m WHERE {GONE}")
def unreferenced_metadata(d: Domain):
    return tables.unreferenced(d.metadata, "doi", _pins(d)).select("doi")


@query("j08_residual_chain", "SELECT doc_id, lower(doi) AS doi FROM report WHERE NOT (d1 OR d2 OR d3 OR there)")
def residual_chain(d: Domain):
    queue = d.table("documents").select("doc_id", F.expr("concat('10.', 1000 + doc_id % 9000, '/X.', doc_id)").alias("doi"))
    return queues.residual(queue, [d.report(1), d.report(2), d.report(3)])


@query("j09_markdown_dedup", "SELECT doc_id, lower(doi) AS doi FROM report WHERE doc_id % 4 <> 0")
def markdown_dedup(d: Domain):
    from ..sources.sinks import markdown_dois

    rows = d.report(1).join(d.table("documents").select("doc_id", F.expr("concat('10.', 1000 + doc_id % 9000, '/X.', doc_id)").alias("doi")), "doi")
    listed = rows.filter("doc_id % 4 = 0").select(F.explode(markdown_dois(F.concat(F.lit("- [ ] **T** — DOI `"), "doi", F.lit("` — x")))).alias("doi"))
    return rows.select("doc_id", F.lower("doi").alias("doi")).join(listed, "doi", "left_anti")


@query("j11_suffix_match", "SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY length(k) DESC, k) AS n FROM (SELECT doc_id, 'download_' || lang || '_' || source || '_final' AS stem FROM documents) JOIN (SELECT DISTINCT source AS k FROM documents UNION SELECT DISTINCT lang || '_' || source FROM documents) ON contains(stem, k) AND length(k) >= 6) WHERE n = 1")
def suffix_match(d: Domain):
    docs = d.table("documents")
    keys = docs.select(F.col("source").alias("k")).union(docs.select(F.concat("lang", F.lit("_"), "source"))).distinct()
    stems = docs.select("doc_id", F.concat(F.lit("download_"), "lang", F.lit("_"), "source", F.lit("_final")).alias("stem"))
    return tables.longest_inside(stems, "stem", keys, "k", 6).select("doc_id", "k")


@query("j12_prefix_route", "SELECT doc_id, name FROM (SELECT doc_id, name, row_number() OVER (PARTITION BY doc_id ORDER BY length(name) DESC, name) AS n FROM (SELECT doc_id, lower(source || '_' || lang || '_paper') AS stem FROM documents) JOIN (SELECT 'src1' AS name UNION SELECT 'src1_en' UNION SELECT 'src2' UNION SELECT 'src2_de') ON starts_with(stem, name || '_')) WHERE n = 1")
def prefix_route(d: Domain):
    names = d.spark.createDataFrame([("src1",), ("src1_en",), ("src2",), ("src2_de",)], "name string")
    stems = d.table("documents").select("doc_id", F.lower(F.concat_ws("_", "source", "lang", F.lit("paper"))).alias("stem"))
    return tables.longest_match(stems, names, F.col("stem").startswith(F.concat("name", F.lit("_"))), ["doc_id"], F.length("name"), ["name"]).select("doc_id", "name")


@query("j13_primary_project", "SELECT doc_id, CASE WHEN source IN ('src1', 'src2', 'src3') THEN source WHEN lang = 'en' THEN 'en' END AS library FROM documents WHERE source IN ('src1', 'src2', 'src3') OR lang = 'en'")
def primary_project(d: Domain):
    known = d.spark.createDataFrame([("src1",), ("src2",), ("src3",), ("en",)], "library string")
    parts = d.table("documents").select("doc_id", F.posexplode(F.split(F.concat_ws(", ", "source", "lang"), ",")).alias("pos", "p")).withColumn("library", F.trim("p"))
    return parts.join(F.broadcast(known), "library").groupBy("doc_id").agg(F.min_by("library", "pos").alias("library"))


@query("j14_companion_pairing", "SELECT project, doi AS stem, has_pdf AS pdf, has_sidecar AS sidecar, has_ris AS ris FROM paper_locations WHERE has_pdf OR has_sidecar OR has_ris")
def companion_pairing(d: Domain):
    have = lambda c: d.locations.filter(c).select("project", F.col("doi").alias("stem"))
    return audit.pairing(have("has_pdf"), have("has_sidecar"), have("has_ris"))


@query("j17_signal_join", "SELECT DISTINCT r.recommended_doi AS doi, coalesce(t.n_seeds, 0) AS n_seeds, coalesce(t.max_cited_by, 0) AS max_cited_by, m.title FROM recommendations r LEFT JOIN top_candidates t ON t.doi = r.recommended_doi LEFT JOIN paper_metadata m ON m.doi = r.recommended_doi")
def signal_join(d: Domain):
    dois = d.recommendations.select(F.col("recommended_doi").alias("doi")).distinct()
    joined = dois.join(_top(d).select("doi", "n_seeds", "max_cited_by"), "doi", "left").join(d.metadata.select("doi", "title"), "doi", "left")
    return joined.select("doi", F.coalesce("n_seeds", F.lit(0)).cast("long").alias("n_seeds"), F.coalesce("max_cited_by", F.lit(0)).alias("max_cited_by"), "title")


@query("j20_record_check", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN abs((1970 + p_size) - (1970 + p_size + p_partkey % 4)) > 1 THEN 'YEAR' WHEN NOT (starts_with(lower(p_brand), lower(left(p_brand, 4 + CAST(p_partkey % 3 AS INT)))) OR starts_with(lower(left(p_brand, 4 + CAST(p_partkey % 3 AS INT))), lower(p_brand))) THEN 'NAME' ELSE 'OK' END AS status FROM part) GROUP BY status")
def record_check(d: Domain):
    year = F.col("p_size") + 1970
    short = F.expr("left(p_brand, 4 + cast(p_partkey % 3 as int))")
    return d.table("part").select(audit.record_check(year, year + F.col("p_partkey") % 4, F.col("p_brand"), short).alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------------------------- ranks, sorts, sets, filters


@query("p05_t01_seed_queue", "SELECT doi, year, title, abstract, n_seeds, max_cited_by, source_types, via_projects FROM top_candidates WHERE list_contains(string_split(via_projects, ','), 'EUROPE') AND year >= 2000 AND n_seeds >= 30 AND max_cited_by >= 1 AND regexp_matches(title, '^[A-Za-z]') ORDER BY n_seeds DESC, max_cited_by DESC, doi LIMIT 50")
def seed_queue(d: Domain):
    return index.seed_queue(_top(d), "EUROPE", 2000, 30, 1, 50)


@query("p08_missing_abstracts", "SELECT doi, title FROM paper_metadata m WHERE coalesce(abstract, '') = '' AND EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = m.doi) ORDER BY doi LIMIT 200")
def missing_abstracts(d: Domain):
    return index.missing_abstracts(d.metadata, d.locations, 200).select("doi", "title")


PRIORITY = "SELECT g.doi, g.title, g.year, g.projects, coalesce(n_seeds, 0) AS seeds, greatest(cites_csv, coalesce(max_cited_by, 0))::BIGINT AS cites FROM (SELECT CAST(doc_id % 1500 AS VARCHAR) AS doi, max(CAST(citation_count AS INTEGER)) AS cites_csv, string_agg(DISTINCT project, ',' ORDER BY project) AS projects, min_by(title, doc_id) FILTER (WHERE title <> '') AS title, min_by(year, doc_id) FILTER (WHERE year <> '') AS year FROM queue GROUP BY 1) g LEFT JOIN top_candidates t ON t.doi = g.doi"
YEAR = "coalesce(CAST(trunc(TRY_CAST(replace(trim(year), ',', '') AS DOUBLE)) AS INTEGER), 0)"


@query("t02_priority_queue", f"SELECT *, CASE WHEN rank <= 50 THEN 'A' ELSE 'B' END AS priority FROM (SELECT *, row_number() OVER (ORDER BY score DESC, {YEAR} DESC, doi) AS rank FROM (SELECT *, seeds * 10 + cites AS score FROM ({PRIORITY})))")
def priority_queue(d: Domain):
    rows = d.queue.withColumn("doi", F.expr("cast(doc_id % 1500 as string)")).withColumn("cites", F.col("citation_count").cast("int"))
    return queues.priority_queue(queues.residual_groups(rows, "doc_id"), _top(d).select("doi", "n_seeds", "max_cited_by"))


@query("t06_next_pending", "SELECT doc_id, doi FROM (SELECT doc_id, doi, coalesce(TRY_CAST(CASE WHEN doc_id % 10 = 3 THEN 'x' ELSE CAST(doc_id AS VARCHAR) END AS INTEGER), 1000000000) AS rank FROM report WHERE NOT (d1 OR there) AND NOT d2) ORDER BY rank, doi LIMIT 40")
def next_pending(d: Domain):
    rows = d.table("documents").select("doc_id", F.expr("concat('10.', 1000 + doc_id % 9000, '/X.', doc_id)").alias("doi"), F.expr("case when doc_id % 10 = 3 then 'x' else cast(doc_id as string) end").alias("rank"))
    done = d.report(1).filter(queues.is_true("downloaded") | F.col("status").isin(*queues.RESOLVED)).select("doi")
    opened = d.report(2).filter(queues.is_true("downloaded")).select("doi")
    return queues.next_pending(rows, done, opened, 40).select("doc_id", "doi")


@query("t08_batches", "SELECT doi, (row_number() OVER (ORDER BY doi) - 1) // 100 AS batch FROM paper_metadata")
def batches(d: Domain):
    return queues.batches(d.metadata.select("doi"), "doi", 100)


@query("w02_recommendation_rank", "SELECT seed_doi, recommended_doi, rank FROM (SELECT seed_doi, recommended_doi, row_number() OVER (PARTITION BY seed_doi ORDER BY rank, recommended_doi) AS rank FROM recommendations) WHERE rank <= 20")
def recommendation_rank(d: Domain):
    w = Window.partitionBy("seed_doi").orderBy(F.col("rank"), "recommended_doi")
    return d.recommendations.withColumn("n", F.row_number().over(w)).filter("n <= 20").select("seed_doi", "recommended_doi", F.col("n").alias("rank"))


@query("w03_top_two", "SELECT source_project, max(CASE WHEN r = 1 THEN n END) AS top1, max(CASE WHEN r = 2 THEN n END) AS top2 FROM (SELECT source_project, n, row_number() OVER (PARTITION BY source_project ORDER BY n DESC, doi) AS r FROM (SELECT source_project, doi, count(*) AS n FROM candidates GROUP BY 1, 2)) WHERE r <= 2 GROUP BY 1")
def top_two(d: Domain):
    n = d.candidates.groupBy("source_project", "doi").agg(F.count(F.lit(1)).alias("n"))
    r = n.withColumn("r", F.row_number().over(Window.partitionBy("source_project").orderBy(F.desc("n"), "doi"))).filter("r <= 2")
    return r.groupBy("source_project").agg(F.max(F.when(F.col("r") == 1, F.col("n"))).alias("top1"), F.max(F.when(F.col("r") == 2, F.col("n"))).alias("top2"))


@query("w04_growth", "SELECT day, n_after, n_before, CASE WHEN n_before = 0 THEN 'inf'::DOUBLE ELSE 100.0::DOUBLE * (n_after - n_before) / n_before END AS growth_pct, coalesce(100.0::DOUBLE * (n_after - n_before) / n_before < 1.0 AND n_before > 0, false) AS converged FROM (SELECT day, n_after, lag(n_after) OVER (ORDER BY day) AS n_before FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_after FROM events GROUP BY 1))")
def growth(d: Domain):
    log = d.table("events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n_after"))
    return citations.growth(log, "day", "n_after")


@query("u01_union_candidates", "SELECT doi FROM candidates WHERE source_project = 'ASIA' UNION SELECT recommended_doi FROM recommendations WHERE rank = 1")
def union_candidates(d: Domain):
    return d.candidates.filter("source_project = 'ASIA'").select("doi").union(d.recommendations.filter("rank = 1").select("recommended_doi")).distinct()


@query("u02_pdf_without_sidecar", "SELECT doi, project FROM paper_locations WHERE has_pdf EXCEPT SELECT doi, project FROM paper_locations WHERE has_sidecar")
def pdf_without_sidecar(d: Domain):
    have = lambda c: d.locations.filter(c).select("doi", "project")
    return have("has_pdf").exceptAll(have("has_sidecar"))


@query("u03_pdf_with_record", "SELECT doi, project FROM paper_locations WHERE has_pdf INTERSECT SELECT doi, project FROM paper_locations WHERE has_ris")
def pdf_with_record(d: Domain):
    have = lambda c: d.locations.filter(c).select("doi", "project")
    return have("has_pdf").intersect(have("has_ris"))


@query("u04_ledger", "SELECT doi FROM report WHERE (d1 OR d2) AND NOT d3")
def ledger(d: Domain):
    opened = lambda k: d.report(k).filter(queues.is_true("downloaded")).select("doi")
    return opened(1).union(opened(2)).distinct().join(opened(3), "doi", "left_anti")


@query("u05_union_reports", "SELECT stage, count(*) AS n FROM (SELECT 1 AS stage FROM report UNION ALL SELECT 2 FROM report UNION ALL SELECT 3 FROM report) GROUP BY stage")
def union_reports(d: Domain):
    rows = [d.report(k).withColumn("stage", F.lit(k)) for k in (1, 2, 3)]
    return rows[0].unionByName(rows[1].drop("status"), allowMissingColumns=True).unionByName(rows[2]).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query("p21_coverage_floor", f"SELECT *, n = 0 OR pct_has_ris >= CASE WHEN project = 'ASIA' THEN 90 ELSE 75 END AS ok FROM ({COVERAGE})")
def coverage_floor(d: Domain):
    share = audit.coverage(d.locations, ["project"], ["has_pdf", "has_sidecar", "has_ris"])
    return audit.floor_check(share, F.when(F.col("project") == "ASIA", 90).otherwise(75))


# ------------------------------------------------------------------------------------------------ graph, maintenance


@query("g03_edges", "SELECT * FROM all_edges")
def edges(d: Domain):
    return citations.edges(d.candidates)


@query("g05_in_degree", "SELECT cited_doi AS doi, count(DISTINCT citing_doi) AS n_citing FROM all_edges GROUP BY 1")
def in_degree(d: Domain):
    return citations.in_degree(citations.edges(d.candidates))


@query("g04_reach", ", hop AS (SELECT DISTINCT citing_doi, cited_doi FROM all_edges), d0 AS (SELECT DISTINCT doi FROM paper_locations WHERE project = 'ASIA' AND doi IN ('1', '2', '3', '5', '8', '13', '21', '34', '55')), d1 AS (SELECT DISTINCT cited_doi AS doi FROM hop WHERE citing_doi IN (SELECT doi FROM d0)), d2 AS (SELECT DISTINCT cited_doi AS doi FROM hop WHERE citing_doi IN (SELECT doi FROM d1 WHERE doi NOT IN (SELECT doi FROM d0))) SELECT doi, min(distance) AS distance FROM (SELECT doi, 0 AS distance FROM d0 UNION ALL SELECT doi, 1 FROM d1 UNION ALL SELECT doi, 2 FROM d2) GROUP BY doi")
def reach(d: Domain):
    seeds = d.locations.filter((F.col("project") == "ASIA") & F.col("doi").isin("1", "2", "3", "5", "8", "13", "21", "34", "55"))
    return citations.reach(citations.edges(d.candidates), seeds, 2)


@query("g04_reach_all", ", hop AS (SELECT DISTINCT citing_doi, cited_doi FROM all_edges), d0 AS (SELECT DISTINCT doi FROM paper_locations WHERE project = 'ASIA'), d1 AS (SELECT DISTINCT cited_doi AS doi FROM hop WHERE citing_doi IN (SELECT doi FROM d0)), d2 AS (SELECT DISTINCT cited_doi AS doi FROM hop WHERE citing_doi IN (SELECT doi FROM d1 WHERE doi NOT IN (SELECT doi FROM d0))) SELECT doi, min(distance) AS distance FROM (SELECT doi, 0 AS distance FROM d0 UNION ALL SELECT doi, 1 FROM d1 UNION ALL SELECT doi, 2 FROM d2) GROUP BY doi")
def reach_all(d: Domain):
    """From all papers of the project."""
    return citations.reach(citations.edges(d.candidates), d.locations.filter("project = 'ASIA'"), 2)


RANKS = ", hop AS (SELECT DISTINCT citing_doi AS s, cited_doi AS t FROM all_edges), deg AS (SELECT s, count(*) AS d FROM hop GROUP BY s), nodes AS (SELECT s AS doi FROM hop UNION SELECT t FROM hop), r0 AS (SELECT doi, 1.0::DOUBLE AS rank FROM nodes)"
for _i in range(1, 6):
    RANKS += f", r{_i} AS (SELECT n.doi, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(g, 0) AS rank FROM nodes n LEFT JOIN (SELECT t, sum(rank / d) AS g FROM hop JOIN deg USING (s) JOIN r{_i - 1} ON r{_i - 1}.doi = hop.s GROUP BY t) x ON x.t = n.doi)"


@query("g06_pagerank", RANKS + " SELECT doi, round(rank, 9) AS rank FROM r5")
def pagerank(d: Domain):
    return citations.pagerank(citations.edges(d.candidates), 5).withColumn("rank", F.round("rank", 9))


@query("g07_centroid", ", q AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT i, avg(x) AS m FROM q WHERE vec_id < 5 GROUP BY i) SELECT vec_id, round(sum(x * m) / sqrt(sum(x * x) * sum(m * m)), 6) AS likeness FROM q JOIN c USING (i) GROUP BY vec_id ORDER BY likeness DESC, vec_id LIMIT 50")
def centroid(d: Domain):
    vectors = d.table("embeddings")
    return citations.centroid_likeness(vectors, vectors.filter("vec_id < 5").select("vec_id"), 50)


NEW = "SELECT CAST(p_partkey AS VARCHAR) AS doi, 2000 + p_size AS year, 'New' AS lastname, upper(p_name) AS title, p_type AS venue, p_brand AS authors FROM part WHERE p_partkey % 5 = 2"


def _new(d: Domain):
    return d.table("part").filter("p_partkey % 5 = 2").select(F.col("p_partkey").cast("string").alias("doi"), (F.col("p_size") + 2000).alias("year"), F.lit("New").alias("lastname"), F.upper("p_name").alias("title"), F.col("p_type").alias("venue"), F.col("p_brand").alias("authors"))


@query("k11_insert_missing", f", n AS ({NEW}) SELECT * FROM paper_metadata UNION ALL SELECT *, NULL FROM n WHERE doi NOT IN (SELECT doi FROM paper_metadata)")
def insert_missing(d: Domain):
    return tables.insert_missing(d.metadata, _new(d), ["doi"])


@query("k12_upsert_keeping", f", n AS ({NEW}) SELECT coalesce(m.doi, n.doi) AS doi, coalesce(n.year, m.year) AS year, coalesce(n.lastname, m.lastname) AS lastname, coalesce(n.title, m.title) AS title, coalesce(n.venue, m.venue) AS venue, coalesce(n.authors, m.authors) AS authors, m.abstract FROM paper_metadata m FULL JOIN n ON n.doi = m.doi")
def upsert_keeping(d: Domain):
    return tables.upsert_keeping(d.metadata, _new(d), ["doi"], ["abstract"])


@query("k13_replace_by_seed", "SELECT * FROM recommendations WHERE CAST(seed_doi AS INTEGER) % 4 <> 0 UNION ALL SELECT seed_doi, CAST(CAST(recommended_doi AS INTEGER) % 50 AS VARCHAR), max(rank) FROM recommendations WHERE CAST(seed_doi AS INTEGER) % 4 = 0 GROUP BY 1, 2")
def replace_by_seed(d: Domain):
    recs = d.recommendations
    new = recs.filter("cast(seed_doi as int) % 4 = 0").withColumn("recommended_doi", F.expr("cast(cast(recommended_doi as int) % 50 as string)"))
    return tables.replace_by_key(recs, new, ["seed_doi", "recommended_doi"], ["seed_doi"], [F.desc("rank")])


@query("k14_replace_where", "SELECT source_project, source_type, count(*) AS n FROM candidates WHERE NOT (source_project = 'ASIA' AND source_type = 'forward') GROUP BY 1, 2")
def replace_where(d: Domain):
    c = d.candidates
    return tables.replace_where(c, c.limit(0), (F.col("source_project") == "ASIA") & (F.col("source_type") == "forward")).groupBy("source_project", "source_type").agg(F.count(F.lit(1)).alias("n"))


@query("k15_prune_missing", "SELECT doi, project FROM paper_locations WHERE project <> 'ASIA' OR has_pdf")
def prune_missing(d: Domain):
    there = d.locations.filter("has_pdf")
    return tables.prune_missing(d.locations, there, ["doi", "project"], F.col("project") == "ASIA").select("doi", "project")


@query("k16_garbage_collected", f"SELECT doi, title FROM paper_metadata m WHERE NOT ({GONE})")
def garbage_collected(d: Domain):
    return tables.collect_garbage(d.metadata, "doi", _pins(d)).select("doi", "title")


@query("k17_fill_abstracts", "SELECT m.doi, coalesce(CASE WHEN p.p_partkey % 6 = 0 THEN upper(p.p_type) END, m.abstract) AS abstract FROM paper_metadata m JOIN part p ON CAST(p.p_partkey AS VARCHAR) = m.doi")
def fill_abstracts(d: Domain):
    found = d.table("part").filter("p_partkey % 6 = 0").select(F.col("p_partkey").cast("string").alias("doi"), F.upper("p_type").alias("abstract"))
    return tables.fill_column(d.metadata, found, "doi", "abstract").select("doi", "abstract")


@query("x_event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
def event_windows(d: Domain):
    from ..streaming.incremental import event_windows as windows

    return windows(d.table("events"))
