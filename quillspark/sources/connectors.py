"""API payloads from recorded responses: one table (api, key, status, body) feeds every connector.

There is no network here.  A live fetch would fill the same table, throttled in one partition; what follows reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.doi import normalize_doi, preprint_pdf_url
from ..functions.text import clean_abstract

WORK = (
    "struct<DOI:string,title:array<string>,`container-title`:array<string>,volume:string,issue:string,page:string,type:string,abstract:string,ISSN:array<string>,score:double,"
    "author:array<struct<family:string,given:string>>,`published-print`:struct<`date-parts`:array<array<int>>>,`published-online`:struct<`date-parts`:array<array<int>>>,issued:struct<`date-parts`:array<array<int>>>>"
)
LOCATIONS = "struct<is_oa:boolean,oa_locations:array<struct<host_type:string,version:string,url_for_pdf:string,url:string>>>"
CITING = "struct<data:array<struct<citingPaper:struct<paperId:string,title:string,abstract:string,year:int,venue:string,citationCount:int,authors:array<struct<name:string>>,externalIds:struct<DOI:string>>>>>"
RECOMMENDED = "struct<recommendedPapers:array<struct<title:string,year:int,citationCount:int,authors:array<struct<name:string>>,externalIds:struct<DOI:string>>>>"
ID_RECORDS = "struct<records:array<struct<doi:string,`requested-id`:string,pmcid:string>>>"


def responses(recorded: DataFrame, api: str) -> DataFrame:
    """The good responses of one API."""
    return recorded.filter((F.col("api") == api) & (F.col("status") == 200)).select("key", "body")


def _first(c: Column) -> Column:
    return F.coalesce(F.get(c, F.lit(0)), F.lit(""))


def work_meta(w: Column) -> Column:
    """A work, flattened; the year from print, else online, else issue, never from the record's creation."""
    parts = F.coalesce(*[F.get(w[k]["date-parts"], F.lit(0)) for k in ("published-print", "published-online", "issued")])
    date = F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x.cast("string")).otherwise(F.lpad(x.cast("string"), 2, "0"))), "/")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(
        F.lower(blank(w["DOI"])).alias("doi"),
        _first(w["title"]).alias("title"),
        blank(F.get(parts, F.lit(0)).cast("string")).alias("year"),
        blank(date).alias("date"),
        F.trim(blank(F.get(w["author"], F.lit(0))["family"])).alias("lastname"),
        w["author"].alias("authors"),
        _first(w["container-title"]).alias("container"),
        blank(w["volume"]).alias("volume"),
        blank(w["issue"]).alias("issue"),
        blank(w["page"]).alias("page"),
        _first(w["ISSN"]).alias("issn"),
        F.regexp_replace(blank(w["abstract"]), "<[^>]+>", "").alias("abstract"),
        F.coalesce(w["type"], F.lit("journal-article")).alias("type"),
    )


def works(recorded: DataFrame, api: str = "crossref") -> DataFrame:
    body = F.from_json("body", f"struct<message:{WORK}>")
    return responses(recorded, api).select("key", work_meta(body["message"]).alias("m")).select("key", "m.*")


def work_hits(recorded: DataFrame, api: str = "crossref_query") -> DataFrame:
    """Hits of a bibliographic query with their rank."""
    body = F.from_json("body", f"struct<message:struct<items:array<{WORK}>>>")
    return responses(recorded, api).select("key", F.posexplode(body["message"]["items"]).alias("at", "w")).select("key", "at", F.col("w.score").alias("score"), work_meta(F.col("w")).alias("m")).select("key", "at", "score", "m.*")


def abstracts(recorded: DataFrame) -> DataFrame:
    """key, abstract ('' where the record has none); failed responses give no row, so they are not taken for 'none'."""
    body = F.from_json("body", f"struct<message:{WORK}>")
    return responses(recorded, "crossref").select(F.col("key").alias("doi"), clean_abstract(F.coalesce(body["message"]["abstract"], F.lit(""))).alias("abstract"))


def open_locations(recorded: DataFrame) -> DataFrame:
    return responses(recorded, "unpaywall").select(F.col("key").alias("doi"), F.from_json("body", LOCATIONS).alias("b")).select("doi", "b.*")


def citing_rows(recorded: DataFrame) -> DataFrame:
    """One row for each citing paper; authors joined, the abstract cut at 1,500 characters."""
    rows = responses(recorded, "citations").select(F.col("key").alias("seed_doi"), F.explode(F.from_json("body", CITING)["data"]).alias("d")).select("seed_doi", "d.citingPaper.*")
    names = F.array_join(F.transform("authors", lambda a: a["name"]), "; ")
    return rows.select("seed_doi", F.col("paperId").alias("citing_paper_id"), normalize_doi(F.col("externalIds.DOI")).alias("citing_doi"), F.col("title").alias("citing_title"), F.col("year").alias("citing_year"), names.alias("citing_authors"), F.col("venue").alias("citing_venue"), F.coalesce("citationCount", F.lit(0)).alias("citing_cited_by"), F.substring("abstract", 1, 1500).alias("citing_abstract"))


def recommendations(recorded: DataFrame, top: int = 20) -> DataFrame:
    """Recommended DOIs with their rank, counted before those without a DOI go."""
    rows = responses(recorded, "recommendations").select(F.lower("key").alias("seed_doi"), F.posexplode(F.from_json("body", RECOMMENDED)["recommendedPapers"]).alias("at", "p"))
    return rows.filter(F.col("at") < top).select("seed_doi", normalize_doi(F.col("p.externalIds.DOI")).alias("recommended_doi"), (F.col("at") + 1).alias("rank")).filter("recommended_doi <> ''")


def id_records(recorded: DataFrame) -> DataFrame:
    rows = responses(recorded, "idconv").select(F.explode(F.from_json("body", ID_RECORDS)["records"]).alias("r"))
    return rows.select(F.lower(F.coalesce(F.col("r.doi"), F.col("r.requested-id"))).alias("doi"), F.col("r.pmcid").alias("pmcid")).filter("pmcid is not null")


def pmid_dois(recorded: DataFrame) -> DataFrame:
    """For each requested PMID the DOI of the first record that has one."""
    rows = responses(recorded, "pmid").select("key", F.filter(F.from_json("body", ID_RECORDS)["records"], lambda r: F.coalesce(r["doi"], F.lit("")) != "").alias("r"))
    return rows.filter(F.size("r") > 0).select(F.col("key").alias("pmid"), F.lower(F.col("r")[0]["doi"]).alias("doi"))


# Preprint servers by DOI prefix.
SERVERS = {"10.1101": "biorxiv-medrxiv", "10.21203": "researchsquare", "10.31219": "osf-preprints", "10.20944": "preprints.org", "10.31234": "psyarxiv"}
PREPRINTS = "struct<resultList:struct<result:array<struct<id:string,pmcid:string,doi:string,title:string,pubYear:string,authorString:string>>>>"
OSF = "struct<data:array<struct<id:string,attributes:struct<title:string,date_published:string,doi:string>,relationships:struct<primary_file:struct<data:struct<id:string>>,provider:struct<data:struct<id:string>>>>>>"


def preprints(recorded: DataFrame, pdf_of_pmcid: str) -> DataFrame:
    """Preprints of a search by position: deposited ones have a PDF of their own, others are found by their DOI; the rest is left out."""
    hits = responses(recorded, "preprints").select("key", F.posexplode(F.from_json("body", PREPRINTS)["resultList"]["result"]).alias("at", "p")).select("key", "at", "p.*")
    hits = hits.na.fill("", ["id", "pmcid", "doi", "title", "pubYear", "authorString"])
    prefix = F.when(F.instr("doi", "/") > 0, F.substring_index("doi", "/", 1)).otherwise("epmc")
    tag = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SERVERS.items() for x in kv]), prefix), F.concat(F.lit("epmc:"), prefix))
    own, found = F.col("pmcid") != "", preprint_pdf_url(F.col("doi"))
    return hits.filter("pmcid <> '' or doi <> ''").select(
        "key", "at", F.when(own, "epmc-preprint-pmc").otherwise(tag).alias("source"), F.when(own, F.col("pmcid")).otherwise(F.col("id")).alias("id"), "title", F.col("pubYear").alias("year"),
        F.col("authorString").alias("authors"), "doi", F.when(own, F.replace(F.lit(pdf_of_pmcid), F.lit("{pmcid}"), F.col("pmcid"))).otherwise(found["url"]).alias("pdf_url"), (~own & found["scrape"]).alias("needs_scrape"),
    )


def osf_preprints(recorded: DataFrame, top: int = 5) -> DataFrame:
    """Preprints of a search of the open-science server: those of the first hits that have a file."""
    hits = responses(recorded, "osf").select("key", F.posexplode(F.from_json("body", OSF)["data"]).alias("at", "p")).filter(F.col("at") < top)
    file, host = F.col("p.relationships.primary_file.data.id"), F.coalesce("p.relationships.provider.data.id", F.lit("osf"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return hits.filter(F.coalesce(file, F.lit("")) != "").select(
        "key", "at", F.concat(F.lit("osf:"), host).alias("source"), text("p.id").alias("id"), text("p.attributes.title").alias("title"), F.substring(text("p.attributes.date_published"), 1, 4).alias("year"),
        F.lit("").alias("authors"), text("p.attributes.doi").alias("doi"), F.concat(F.lit("https://api.osf.io/v2/files/"), file, F.lit("/?action=download")).alias("pdf_url"), F.lit(False).alias("needs_scrape"),
    )


def full_text(status: Column, body: Column) -> Column:
    """What a full-text request gave: the XML's state."""
    return F.when(status == 404, "NOT_AVAILABLE").when(status != 200, F.concat(F.lit("HTTP_"), status.cast("string"))).when(~F.coalesce(body, F.lit("")).rlike(r"^\s*<"), "EMPTY_OR_NON_XML").otherwise("OK")


def first_download(attempts: DataFrame, hops: int = 3) -> DataFrame:
    """From attempts (doi, rank, url, status, links) and what the links of pages gave (hop): each DOI's first URL that is a
    PDF, in order of the candidates, a page's first links right after it."""
    direct = attempts.select("doi", "rank", F.lit(0).alias("hop"), "url", "status")
    linked = attempts.filter("status = 'HTML'").select("doi", "rank", F.posexplode("links").alias("at", "l")).filter(F.col("at") < hops)
    tried = direct.union(linked.select("doi", "rank", F.col("at") + 1, "l.url", "l.status"))
    return tried.groupBy("doi").agg(F.min(F.when(F.col("status") == "OK", F.struct("rank", "hop", "url"))).alias("b"), F.count(F.lit(1)).alias("n_tried")).select("doi", "n_tried", F.col("b.url").alias("url"))


def figure_files(figures: DataFrame, pages: DataFrame, least_page: int = 30_000) -> DataFrame:
    """From figures (stem, at, href) and pages (stem, length, urls): the files to save, by the first URL of each name; a page too
    short for an article is an interstitial and has none."""
    links = pages.filter(F.col("length") >= least_page).select("stem", F.posexplode("urls").alias("i", "url")).withColumn("href", F.substring_index("url", "/", -1))
    first = links.groupBy("stem", "href").agg(F.min_by("url", "i").alias("url"))
    name = F.concat("stem", F.lit(".fig"), F.col("at") + 1, F.lit("."), F.lower(F.substring_index("href", ".", -1)))
    return figures.filter("href <> ''").join(first, ["stem", "href"]).select("stem", "at", name.alias("file"), "url")


def image_kind(head: Column, length: Column, most: int = 30_000_000) -> Column:
    """The kind of an image by its first bytes (in hexadecimal), null for anything else or too large."""
    kind = F.when(head.startswith("FFD8FF"), "jpg").when(head.startswith("89504E47"), "png").when(head.startswith("47494638"), "gif")
    return F.when(length <= most, kind)


def download_status(status: Column, head: Column, length: Column, stand_in: Column, most: int = 50_000_000, least: int = 10_000) -> Column:
    """What a download is, first rule that holds."""
    return (
        F.when(status != 200, F.concat(F.lit("HTTP_"), status.cast("string")))
        .when(F.coalesce(length, F.lit(0)) == 0, "EMPTY")
        .when(length > most, "TOO_LARGE")
        .when(F.lower(F.ltrim(head)).startswith("<"), "HTML")
        .when(~head.startswith("%PDF"), "ERROR")
        .when(length < least, "TOO_SMALL")
        .when(stand_in.isNotNull(), "BOILERPLATE")
        .otherwise("OK")
    )


def atom_entries(xml: Column) -> Column:
    """Titles of an Atom feed's entries."""
    return F.xpath(xml, F.lit("//*[local-name()='entry']/*[local-name()='title']/text()"))
