"""Text queries: cleaning, titles, abstracts, references, formulas, links, over all documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from .projection import Domain
from .registry import query

#: A text with ligatures, broken lines and page numbers, from a document's own.
DIRTY = "concat('eﬃcient ﬁeld ', text, ' core-\n  body\n 12 \nend “x” — y')"
DIRTY_SQL = "'eﬃcient ﬁeld ' || text || ' core-' || chr(10) || '  body' || chr(10) || ' 12 ' || chr(10) || 'end “x” — y'"


@query("x01_clean_text", "SELECT doc_id, sha256('efficient field ' || text || ' core-' || chr(10) || '  body' || chr(10) || ' 12 ' || chr(10) || 'end “x” — y') AS plain FROM documents", views=False)
def clean(d: Domain):
    return d.table("documents").select("doc_id", F.sha2(X.clean_pdf_text(F.expr(DIRTY)), 256).alias("plain"))


@query("x01_clean_text_all", "SELECT doc_id, 'efficient corebody' || chr(10) || 'end \"x\" -- ' || lang AS cleaned FROM documents", views=False)
def clean_all(d: Domain):
    text = F.expr("concat('eﬃcient core-\n  body\n 12 \nend “x” — ', lang)")
    return d.table("documents").select("doc_id", X.clean_pdf_text(text, dehyphenate=True, page_numbers=True, typography=True).alias("cleaned"))


@query("x02_text_issues", "SELECT doc_id, CAST(len(regexp_extract_all(t, '[ﬀﬁﬂﬃﬄﬅﬆ]')) AS INTEGER) AS ligatures, CAST(len(regexp_extract_all(t, '[A-Za-z0-9_]+-\\s*\\n\\s*[A-Za-z0-9_]+')) AS INTEGER) AS linebreak_hyphens FROM (SELECT doc_id, " + DIRTY_SQL + " AS t FROM documents)", views=False)
def issues(d: Domain):
    return d.table("documents").select("doc_id", X.text_issues(F.expr(DIRTY)).alias("i")).select("doc_id", "i.ligatures", "i.linebreak_hyphens")


@query("f19_normalize_title", "SELECT doc_id, trim(regexp_replace(regexp_replace(lower(regexp_replace(title, '<[^>]+>', '', 'g')), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS title FROM queue")
def titles(d: Domain):
    return d.queue.select("doc_id", X.normalize_title(F.col("title")).alias("title"))


@query("f37_clean_abstract", "SELECT page_id, sha256(trim(regexp_replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g'))) AS abstract FROM pages", views=False)
def abstracts(d: Domain):
    return d.table("pages").select("page_id", F.sha2(X.clean_abstract(F.col("html")), 256).alias("abstract"))


@query("x03_extract_abstract")
def extract_abstract(d: Domain):
    return d.table("documents").select("doc_id", X.extract_abstract(F.expr("concat(case when doc_id % 2 = 0 then 'Abstract: ' else '' end, text, '\n\nKeywords: x')")).alias("abstract"))


@query("x04_infer_venue", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'J Sports Sci' WHEN 1 THEN 'Bull Math Biol' WHEN 2 THEN 'PLOS One/CompBio' ELSE '' END AS venue FROM documents", views=False)
def venues(d: Domain):
    head = F.expr("concat(case doc_id % 4 when 0 then 'Journal of Sports Sciences ' when 1 then 'Bulletin Mathematical Biology. ' when 2 then 'PLOS ONE ' else '' end, lang)")
    return d.table("documents").select("doc_id", X.infer_venue(head).alias("venue"))


REFS = "concat('Intro text.\nReferences\n', array_join(transform(sequence(1, cast(4 + doc_id % 5 as int)), i -> concat('\n[', i, '] Smith, J. A study of ', lang, ' and heat. (', 1990 + i, '). A long title number ', i, '. Journal 10.1234/ab.', doc_id, i)), ''), '\nAcknowledgments\nThanks to all.')"


@query("x05_x06_references", "SELECT doc_id, CASE WHEN 4 + doc_id % 5 >= 5 THEN 4 + doc_id % 5 ELSE 1 END AS n FROM documents", views=False)
def references(d: Domain):
    parts = X.split_references(F.concat(F.lit("\n"), X.locate_references(F.expr(REFS))))
    return d.table("documents").select("doc_id", F.size(parts).cast("long").alias("n"))


@query("x07_parse_references", "SELECT doc_id, i, 'Smith' AS first_author, CAST(1990 + i AS VARCHAR) AS year, 'A long title number ' || i AS title_snippet, '10.1234/ab.' || doc_id || i AS doi FROM (SELECT doc_id, unnest(range(1, CAST(5 + doc_id % 5 AS BIGINT))) AS i FROM documents WHERE doc_id % 5 > 0)", views=False)
def parse_references(d: Domain):
    parts = X.split_references(F.concat(F.lit("\n"), X.locate_references(F.expr(REFS))))
    rows = d.table("documents").filter("doc_id % 5 > 0").select("doc_id", F.posexplode(parts).alias("at", "raw"))
    return rows.select("doc_id", (F.col("at") + 1).cast("long").alias("i"), X.parse_reference(F.col("raw")).alias("p")).select("doc_id", "i", "p.first_author", "p.year", "p.title_snippet", "p.doi")


@query("x07_parse_references_all", "SELECT doc_id, i, 'Smith' AS first_author, CAST(1990 + i AS VARCHAR) AS year, 'A long title number ' || i AS title_snippet, '10.1234/ab.' || doc_id || i AS doi FROM (SELECT doc_id, unnest(range(1, CAST(5 + doc_id % 5 AS BIGINT))) AS i FROM documents WHERE doc_id % 5 > 0) UNION ALL SELECT doc_id, 1, '', '1991', 'A long title number 1', '10.1234/ab.' || doc_id || '1' FROM documents WHERE doc_id % 5 = 0", views=False)
def parse_all_references(d: Domain):
    """Of all documents: the four references of every fifth are too few for a rule and stay one part, of which the first is read."""
    parts = X.split_references(F.concat(F.lit("\n"), X.locate_references(F.expr(REFS))))
    rows = d.table("documents").select("doc_id", F.posexplode(parts).alias("at", "raw"))
    return rows.select("doc_id", (F.col("at") + 1).cast("long").alias("i"), X.parse_reference(F.col("raw")).alias("p")).select("doc_id", "i", "p.first_author", "p.year", "p.title_snippet", "p.doi")


@query("x09_math_status", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'skipped_pdf_extractor_no_eqn_support_but_xml_sibling_available' WHEN doc_id % 3 = 1 THEN 'skipped_no_math_indicators' ELSE 'skipped_pdf_extractor_no_eqn_support' END AS status, CASE WHEN doc_id % 3 = 2 THEN 'latex_cmd,equation_label' ELSE '' END AS indicators FROM documents", views=False)
def math(d: Domain):
    text = F.when(F.expr("doc_id % 3 = 2"), F.concat(F.lit("as in \\frac{a}{b}, see Eq. (3) "), "lang")).otherwise(F.col("lang"))
    return d.table("documents").select("doc_id", X.math_status(text, F.expr("doc_id % 3 = 0")).alias("m")).select("doc_id", "m.status", F.array_join("m.indicators", ",").alias("indicators"))


@query("p12_boilerplate", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'lww_author_permission_guidelines' WHEN doc_id % 5 = 1 THEN 'jmlr_misfetch' END AS tag FROM documents", views=False)
def boilerplate(d: Domain):
    text = F.expr("concat(case doc_id % 5 when 0 then 'Lippincott Journal Portfolio ' when 1 then 'Scikit-learn: Machine Learning in Python ' else '' end, text)")
    return d.table("documents").select("doc_id", X.boilerplate(F.md5("text"), text).alias("tag"))


@query("f22_title_hint", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'A good title ' || lang ELSE 'the first real line ' || lang END AS hint FROM documents", views=False)
def title_hints(d: Domain):
    title = F.expr("case when doc_id % 2 = 0 then concat('A good title ', lang) else lang end")
    text = F.expr("concat('12 34 - 5 6\n\nshort\n the first real line ', lang, '\nmore words than four here')")
    return d.table("documents").select("doc_id", X.title_hint(title, text).alias("hint"))


@query("f35_page_links", "SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<a[^>]+href=[\"'']([^\"'']+)')) AS INTEGER) AS n_links, 'https://x.org/' || page_id || '.pdf' AS first_pdf FROM pages", views=False)
def page_links(d: Domain):
    page = F.concat("html", F.lit('<a class="x" href="https://x.org/'), "page_id", F.lit('.pdf">pdf</a>'))
    return d.table("pages").select("page_id", F.regexp_count("html", F.lit("(?i)<a[^>]+href=[\"']([^\"']+)")).alias("n_links"), F.get(X.pdf_links(page), F.lit(0)).alias("first_pdf"))


@query("f36_image_urls", "SELECT page_id, 'fig' || page_id || '.jpg' AS name FROM pages", views=False)
def image_urls(d: Domain):
    page = F.concat("html", F.lit('<img src="https://cdn.example.org/blobs/ab/fig'), "page_id", F.lit('.jpg">'))
    found = F.regexp_extract_all(page, F.lit(r'https://cdn\.example\.org/blobs/[^"]*?/([^/"]+\.(?:jpg|png|gif))'), F.lit(1))
    return d.table("pages").select("page_id", F.get(found, F.lit(0)).alias("name"))


@query("p13_real_tables", "SELECT doc_id, doc_id % 4 <> 0 AND doc_id % 3 <> 0 AS real FROM documents", views=False)
def real_tables(d: Domain):
    table = F.expr("case when doc_id % 4 = 0 then array(array('a', 'b'), array('', ' ')) when doc_id % 3 = 0 then array(array(repeat('x', 600), 'b'), array('c', 'd'), array('e', 'f')) else array(array('a', lang), array('1', '2'), array('3', '')) end")
    return d.table("documents").select("doc_id", X.real_table(table).alias("real"))


@query("x12_assembly", "SELECT doc_id, sha256('# ' || source || chr(10) || chr(10) || '## Abstract' || chr(10) || chr(10) || lang || chr(10) || chr(10) || '## Body' || chr(10) || chr(10) || text) AS assembled FROM documents", views=False)
def assembly(d: Domain):
    sections = F.array(F.struct(F.lit("Abstract").alias("t"), F.col("lang").alias("b")), F.struct(F.lit("Body").alias("t"), F.col("text").alias("b")))
    body = F.array_join(F.transform(sections, lambda s: F.concat(F.lit("## "), s["t"], F.lit("\n\n"), s["b"])), "\n\n")
    return d.table("documents").select("doc_id", F.sha2(F.concat(F.lit("# "), "source", F.lit("\n\n"), body), 256).alias("assembled"))


@query("x13_density", "SELECT doc_id, n_chars / greatest(1, doc_id % 12)::DOUBLE AS chars_per_page, left(text, 400) AS snippet, printf('%.2f', n_chars / 100.0::DOUBLE) AS shown FROM documents", views=False)
def density(d: Domain):
    return d.table("documents").select("doc_id", (F.col("n_chars") / F.greatest(F.lit(1), F.expr("doc_id % 12")).cast("double")).alias("chars_per_page"), F.substring("text", 1, 400).alias("snippet"), F.format_string("%.2f", F.col("n_chars") / 100.0).alias("shown"))
